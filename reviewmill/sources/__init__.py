"""Readers: tagged text, workbooks, nested JSON, dictionaries and vectors."""
