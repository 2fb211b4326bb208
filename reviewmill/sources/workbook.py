"""Spreadsheet workbooks (.xlsx): cell values of every sheet.

The format limits a sheet to about a million rows, so one task per workbook is
enough; many workbooks are read in parallel.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schema import REVIEW_COLUMNS, SEQ, WORKBOOK_SOURCE, scan_seq

# XML names of the workbook format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

ROWS_PER_BATCH = 2_000


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Sheet names with the part that holds each, in workbook order."""
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {link.get("Id"): link.get("Target").lstrip("/") for link in links}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    parts = [(s.get("name"), target[s.get(LINK)]) for s in root.iter(MAIN + "sheet")]
    return [(name, part if part.startswith("xl/") else "xl/" + part) for name, part in parts]


def _text(node) -> str:
    """Plain and rich text of a string item, without its phonetic runs."""
    runs = [node.find(MAIN + "t"), *(r.find(MAIN + "t") for r in node.findall(MAIN + "r"))]
    return "".join(t.text or "" for t in runs if t is not None)


def _cell(cell, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        inline = cell.find(MAIN + "is")
        return "" if inline is None else _text(inline)
    value = cell.findtext(MAIN + "v")
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    return value


def _column(reference: str) -> int:
    """Column number of a cell reference such as ``AB12``."""
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def _rows(book: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[dict[str, str | None]]:
    header: dict[int, str] | None = None
    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag != MAIN + "row":
                continue
            cells, at = {}, 0
            for c in node.iter(MAIN + "c"):
                at = _column(c.get("r")) if c.get("r") else at + 1  # references may be left out
                cells[at] = _cell(c, shared)
            node.clear()
            if header is None:
                header = {k: v for k, v in cells.items() if v is not None}
            else:
                yield {header[k]: v for k, v in cells.items() if k in header}


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            book = zipfile.ZipFile(io.BytesIO(content))
            shared = []
            if "xl/sharedStrings.xml" in book.namelist():
                strings = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
                shared = [_text(item) for item in strings.iter(MAIN + "si")]
            for name, part in _sheets(book):
                held = []
                for cells in _rows(book, part, shared):
                    held.append((path, name, cells))
                    if len(held) == ROWS_PER_BATCH:
                        yield pd.DataFrame(held, columns=["path", "sheet", "cells"])
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=["path", "sheet", "cells"])


def read_workbooks(spark: SparkSession, folder: str, pattern: str = "*.xlsx") -> DataFrame:
    """Rows of all sheets as ``(path, sheet, seq, cells)``; ``cells`` maps header to value."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "content")
    )
    rows = files.mapInPandas(_read, "path string, sheet string, cells map<string,string>")
    return rows.select("path", "sheet", scan_seq(WORKBOOK_SOURCE).alias(SEQ), "cells")


def workbook_reviews(rows: DataFrame) -> DataFrame:
    """The eleven review columns by name; a column a sheet lacks is null."""
    cells = [F.col("cells").getItem(c).alias(c) for c in REVIEW_COLUMNS]
    return rows.select(*cells, SEQ)
