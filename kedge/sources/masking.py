"""Secrets in raw bodies, masked without changing the rest."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of sensitive fields and what replaces their values.
HTML_NAMES = "token|csrf|secret|password|authorization|session|activation"
JSON_NAMES = "csrf|token|secret|password|authorization|cookie|phpsessid|activation|start_(?:id|uuid|code)"
MASK = b"REDACTED_SECRET"
# End of fixed values.


class _Inputs(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.values: set[str] = set()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        held = "value" if tag == "input" else "content" if tag == "meta" else None
        if held in a and re.search(HTML_NAMES, " ".join(a.get(k, "") for k in ("name", "id", "type")), re.I):
            self.values.add(a[held])

    handle_startendtag = handle_starttag


def _json_values(text: str) -> set[str]:
    try:
        todo = [(json.loads(text), False)]
    except ValueError:
        return set()
    out = set()
    while todo:
        value, marked = todo.pop()
        if isinstance(value, dict):
            todo += [(v, marked or bool(re.search(JSON_NAMES, k, re.I))) for k, v in value.items()]
        elif isinstance(value, list):
            todo += [(v, marked) for v in value]
        elif marked and isinstance(value, str):
            out.add(value)
    return out


def masked(body: bytes, known: tuple[str, ...] = (), *, is_html: bool) -> bytes:
    """``body`` with every form (plain, HTML, URL, JSON) of its secrets replaced, longest first."""
    text = body.decode("utf-8", "replace")
    if is_html:
        parser = _Inputs()
        parser.feed(text)
        values = parser.values
    else:
        values = _json_values(text)
    for v in sorted({*values, *known} - {""}, key=lambda v: (-len(v), v)):
        for form in {v, html.escape(v), quote(v, safe=""), json.dumps(v)[1:-1]}:
            body = body.replace(form.encode(), MASK)
    return body


def mask_secrets(df: DataFrame, *, body: str, is_html: Column, known: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with secrets in the binary column ``body`` masked; null bodies stay null."""

    @F.pandas_udf(T.BinaryType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for raw, pages in batches:
            yield pd.Series([None if b is None else masked(bytes(b), known, is_html=bool(h)) for b, h in zip(raw, pages)], dtype=object)

    return df.withColumn(body, run(F.col(body), is_html))


def leaks(df: DataFrame, *, id: str, text: str, pattern: str) -> DataFrame:
    """``id`` of rows whose text matches what must not be published (paths, secrets, passing URLs)."""
    return df.where(F.col(text).rlike(pattern)).select(id)
