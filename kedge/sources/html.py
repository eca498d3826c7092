"""HTML as a table of elements, so that selecting is filtering and joining.

``elements`` parses each page once (Arrow batches, the standard library's parser) into
one row per element with its span of positions; a descendant is a row whose position
lies in the span. Everything after that is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Elements(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.pieces: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = len(self.rows)
        self.rows.append([at, at, tag, {k: v or "" for k, v in attrs}, len(self.pieces), len(self.pieces)])
        if tag not in _VOID:
            self.open.append(at)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[i]][2] == tag:
                for at in self.open[i:]:
                    self._end(at)
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)

    def _end(self, at: int) -> None:
        self.rows[at][1] = len(self.rows) - 1
        self.rows[at][5] = len(self.pieces)

    def finish(self) -> list[tuple]:
        self.close()
        for at in self.open:
            self._end(at)
        return [(at, last, tag, attrs, "".join(self.pieces[lo:hi])) for at, last, tag, attrs, lo, hi in self.rows]


def elements(df: DataFrame, *, id: str, html: str) -> DataFrame:
    """``id, at, last, tag, attrs, text`` of every element of every page, in document order.

    ``html`` is text or UTF-8 bytes; broken bytes become replacement marks, tags left
    open end with the page. Null and empty pages have no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, page in zip(pdf["id"], pdf["html"]):
                if page is None:
                    continue
                parser = _Elements()
                parser.feed(page.decode("utf-8", "replace") if isinstance(page, bytes | bytearray) else page)
                rows += [(key, *r) for r in parser.finish()]
            yield pd.DataFrame(rows, columns=["id", "at", "last", "tag", "attrs", "text"])

    key = T.StructField("id", df.schema[id].dataType)
    schema = T.StructType([key, *T._parse_datatype_string("at int, last int, tag string, attrs map<string,string>, text string").fields])
    return df.select(F.col(id).alias("id"), F.col(html).alias("html")).mapInPandas(run, schema).withColumnRenamed("id", id)


def attr(name: str) -> Column:
    """Attribute of an element, null without it."""
    return F.try_element_at("attrs", F.lit(name))


def has_class(name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(attr("class"), r"\s+"), name), F.lit(False))


def inside(outer: DataFrame, inner: DataFrame, *, id: str) -> DataFrame:
    """Pairs of an element and one inside it: ``id, outer_at`` and the columns of ``inner``."""
    o = outer.select(F.col(id).alias("_id"), F.col("at").alias("outer_at"), F.col("last").alias("_last"))
    return inner.join(o, (F.col(id) == F.col("_id")) & (F.col("at") > F.col("outer_at")) & (F.col("at") <= F.col("_last"))).drop("_id", "_last")


@F.pandas_udf(T.StringType())
def url_join(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Absolute URL of a reference on a page."""
    for base, ref in batches:
        yield pd.Series([None if b is None or r is None else urljoin(b, r) for b, r in zip(base, ref)], dtype=object)


@F.pandas_udf(T.StringType())
def url_unquoted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(unquote, na_action="ignore")


def required(df: DataFrame, column: str, what: str) -> DataFrame:
    """``df``, failing when evaluated on a row where ``column`` is null."""
    return df.withColumn(column, F.when(F.col(column).isNull(), F.raise_error(F.lit(f"missing {what}"))).otherwise(F.col(column)))


def forms(els: DataFrame, *, id: str) -> DataFrame:
    """``id, at, action, fields``: forms with their hidden inputs by name."""
    form = els.where("tag = 'form'")
    hidden = els.where((F.col("tag") == "input") & (F.lower(attr("type")) == "hidden") & attr("name").isNotNull())
    found = inside(form, hidden, id=id).groupBy(id, "outer_at").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(attr("name").alias("k"), F.coalesce(attr("value"), F.lit("")).alias("v"))))).alias("fields"))
    return form.select(id, "at", attr("action").alias("action")).join(found.withColumnRenamed("outer_at", "at"), [id, "at"], "left")


def media(els: DataFrame, base: Column, *, id: str) -> DataFrame:
    """``id, at, url``: absolute sources of pictures, sound and video, in document order."""
    tags = els.where(F.col("tag").isin("img", "video", "audio", "source") & (attr("src") != ""))
    return tags.select(id, "at", url_join(base, attr("src")).alias("url"))


def document_links(els: DataFrame, *, id: str, base: Column, card: str = "doc-item", heading: str = "doc-item__title", uploads: str = "/uploads/document/") -> DataFrame:
    """Links of landing pages: ``id, at, href, target, link_text, topic_text, topic_code, topic_title, reason``.

    A link to a PDF counts; the topic is read from the heading of the card it lies in,
    else from its own text. Links left out keep a ``reason`` (``non_pdf`` for other
    uploads, ``no_explicit_topic`` outside cards); those that count have none.
    """
    from kedge.functions.text import topic_of

    a = els.where((F.col("tag") == "a") & attr("href").isNotNull()).select(id, "at", F.col("last").alias("_l"), attr("href").alias("href"), F.col("text").alias("link_text"))
    cards = els.where(has_class(card)).select(id, F.col("at").alias("card"), F.col("last").alias("card_last"))
    heads = els.where(has_class(heading)).select(F.col(id).alias("_id"), F.col("at").alias("_h"), F.col("text").alias("heading"))
    titled = cards.join(heads, (F.col(id) == F.col("_id")) & (F.col("_h") > F.col("card")) & (F.col("_h") <= F.col("card_last"))).groupBy(id, "card", "card_last").agg(F.min_by("heading", "_h").alias("heading"))
    t = titled.select(F.col(id).alias("_i"), "card", "card_last", "heading")
    held = a.join(t, (F.col(id) == F.col("_i")) & (F.col("at") > F.col("card")) & (F.col("at") <= F.col("card_last")), "left").groupBy(id, "at", "href", "link_text").agg(F.max_by("heading", "card").alias("heading"))
    held = held.withColumn("target", url_join(base, F.col("href"))).withColumn("topic_text", F.coalesce("heading", "link_text"))
    code, title = topic_of(F.col("topic_text"))
    pdf = F.lower(F.regexp_extract("target", r"^[^?#]*", 0)).endswith(".pdf")
    reason = F.when(~pdf, F.when(F.col("href").contains(uploads), "non_pdf").otherwise("other")).when(F.col("heading").isNull() & code.isNull(), "no_explicit_topic")
    out = held.select(id, "at", "href", "target", "link_text", "topic_text", code.alias("topic_code"), F.coalesce(title, F.trim("topic_text")).alias("topic_title"), reason.alias("reason"))
    return out.where("reason is null or reason <> 'other'")


def question_page(els: DataFrame, *, id: str) -> DataFrame:
    """The question of a page of the sequential source: ``id, position, total, passed, remain, text,
    multiple, correct_answer_ids, answers`` (id, text; in page order).

    Selected by the page's data attributes; missing parts are null, to be checked with ``required``.
    """
    number = F.max(F.when(attr("data-name") == "question-number", F.trim("text")))
    pick = lambda name: F.max(F.when(attr("data-name") == name, F.trim("text")))
    heads = els.groupBy(id).agg(
        F.regexp_extract(number, r"(\d+)\s*/\s*(\d+)", 1).try_cast("int").alias("position"), F.regexp_extract(number, r"(\d+)\s*/\s*(\d+)", 2).try_cast("int").alias("total"),
        pick("questions-passed").try_cast("int").alias("passed"), pick("questions-remain").try_cast("int").alias("remain"), pick("current-question-content").alias("text"),
        (F.max(F.when(attr("id") == "step-form", attr("data-multiple-answers"))).isin("1", "true", "True")).alias("multiple"),
        F.transform(F.split(F.max(F.when(attr("id") == "step-form", attr("data-valid-answers"))), ","), lambda x: F.trim(x)).alias("correct_answer_ids"),
    )
    inputs = els.where((F.col("tag") == "input") & attr("name").isin("answer", "answer[]")).select(id, F.col("at"), attr("value").alias("answer_id"), attr("id").alias("dom"))
    labels = els.where((F.col("tag") == "label") & attr("for").isNotNull()).select(F.col(id).alias("_i"), attr("for").alias("_for"), F.trim("text").alias("label"))
    answers = inputs.join(labels, (F.col(id) == F.col("_i")) & (F.col("dom") == F.col("_for")), "left").groupBy(id).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "answer_id", "label"))), lambda x: F.struct(x["answer_id"].alias("id"), x["label"].alias("text"))).alias("answers"))
    return heads.join(answers, id, "left")
