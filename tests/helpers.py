"""Small inputs and brute-force answers."""

import random
import re
import zipfile
from collections import Counter, defaultdict

from reviewmill.functions.porter import stem
from reviewmill.functions.tokens import STOPWORDS

TYPES = "parent_product_id string, seq long, review_text string"

WORDS = "battery batteries glue strong strongly smell works working the and quick quickly broke again tape sticky day".split()


def random_texts(n, products=8, seed=1, hot_share=0.34):
    """``n`` reviews; product ``p0`` holds a third of them, runs are crossed."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        pid = "p0" if rnd.random() < hot_share else f"p{rnd.randrange(1, products)}"
        text = " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(0, 9)))
        seq = (rnd.randrange(4) << 20) * 3 + i
        rows.append((pid, seq, text if rnd.random() > 0.1 else "12 34"))
    return rows


def token_list(text):
    found = re.findall("[a-z]+", text.lower())
    return [stem(t) for t in found if t not in STOPWORDS and len(t) >= 3]


def brute_vocabulary(rows, low, high, min_count, top):
    lists = [(pid, seq, token_list(text)) for pid, seq, text in sorted(rows, key=lambda r: r[1])]
    products = {pid for pid, _, _ in lists}
    owners = defaultdict(set)
    for pid, _, tokens in lists:
        for t in tokens:
            owners[t].add(pid)
    band = {t for t, o in owners.items() if low * len(products) <= len(o) < high * len(products)}
    unigrams, pairs = Counter(), Counter()
    for _, _, tokens in lists:
        kept = [t for t in tokens if t in band]
        unigrams.update(kept)
        pairs.update(zip(kept, kept[1:]))
    strong = [(n / (unigrams[a] * unigrams[b]), a, b) for (a, b), n in pairs.items() if n >= min_count]
    best = [f"{a}_{b}" for _, a, b in sorted(strong, key=lambda x: (-x[0], x[1], x[2]))[:top]]
    terms = {t: i for i, t in enumerate(sorted(list(band) + best))}
    texts = defaultdict(list)
    for pid, _, tokens in lists:
        texts[pid] += tokens
    vectors = {}
    for pid, tokens in texts.items():
        used = tokens + [f"{a}_{b}" for a, b in zip(tokens, tokens[1:])]
        vectors[pid] = {terms[t]: n for t, n in Counter(t for t in used if t in terms).items()}
    return band, dict(pairs), best, terms, vectors


def write_workbook(path, sheets):
    """A minimal workbook: ``{sheet: [header, row, ...]}``; strings shared, numbers plain."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared = []
    parts, names, links = {}, "", ""
    for number, (name, rows) in enumerate(sheets.items(), 1):
        body = ""
        for r, row in enumerate(rows, 1):
            cells = ""
            for c, value in enumerate(row):
                at = f"{chr(65 + c)}{r}"
                if value is None:
                    continue
                if isinstance(value, bool):
                    cells += f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
                elif isinstance(value, str) and value.startswith("inline:"):
                    cells += f'<c r="{at}" t="inlineStr"><is><t>{value[7:]}</t></is></c>'
                elif isinstance(value, str):
                    shared.append(value)
                    cells += f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
                else:
                    cells += f'<c r="{at}"><v>{value}</v></c>'
            body += f'<row r="{r}">{cells}</row>'
        parts[f"xl/worksheets/sheet{number}.xml"] = f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>"
        names += f'<sheet name="{name}" sheetId="{number}" r:id="rId{number}"/>'
        links += f'<Relationship Id="rId{number}" Type="{rel}/worksheet" Target="worksheets/sheet{number}.xml"/>'
    strings = "".join(f"<si><t>{s}</t></si>" for s in shared)
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f"<sst {main}>{strings}</sst>")
        for part, text in parts.items():
            book.writestr(part, text)
