"""Groups, taxonomies, memberships and audits of matched corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedge import scratch
from kedge.functions import text as tx
from kedge.functions.identity import short_id
from kedge.operators.layout import nearest


def ordered_distinct(values: Column, key: Column, order: Column) -> Column:
    """Aggregate: distinct ``values`` by ``key`` in the order of first occurrence."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), key.alias("k"), values.alias("v"))))
    fold = F.aggregate(
        rows, F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.when(x["k"].isNull() | F.array_contains(acc["seen"], x["k"]), acc).otherwise(F.struct(F.array_append(acc["seen"], x["k"]).alias("seen"), F.array_append(acc["out"], x["v"]).alias("out"))),
    )
    return fold["out"]


def reference_groups(rows: DataFrame, *, key: Sequence[str], order: str, row_id: str, answers: str, answer_key: Column, prefix: str = "group:") -> DataFrame:
    """Rows of one key as a group: key, ``group_id``, ``rows``, ``row_ids`` (in order), ``answers`` (distinct by ``answer_key``, first spelling), ``answer_rows``.

    ``answer_key`` is an expression over the exploded answer ``answer``. Null key parts
    are a value. The number of answers a group collects is bounded by its distinct ones:
    they are aggregated by answer first.
    """
    each = rows.select(*key, order, F.explode_outer(answers).alias("answer")).withColumn("_k", answer_key)
    firsts = each.where("_k is not null").groupBy(*key, "_k").agg(F.min_by("answer", order).alias("v"), F.min(order).alias("o"), F.count("*").alias("n"))
    kept = firsts.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "_k", "v"))), lambda x: x["v"]).alias("answers"), F.sum("n").alias("answer_rows"))
    heads = rows.groupBy(*key).agg(F.count("*").alias("rows"), F.transform(F.array_sort(F.collect_list(F.struct(order, row_id))), lambda x: x[row_id]).alias("row_ids"))
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"a.{k}")) for k in key]
    j = heads.alias("h").join(kept.alias("a"), same, "left")
    return j.select(*[F.col(f"h.{k}").alias(k) for k in key], short_id(prefix, *[F.col(f"h.{k}").cast("string") for k in key]).alias("group_id"), "rows", "row_ids", F.coalesce("answers", F.array().cast("array<string>")).alias("answers"), F.coalesce("answer_rows", F.lit(0).cast("bigint")).alias("answer_rows"))


def json_key(*parts: Column) -> Column:
    """JSON array of texts and arrays of texts, without blanks; null texts are empty."""
    one = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    return F.concat(F.lit("["), F.concat_ws(",", *[one(p) for p in parts]), F.lit("]"))


def question_groups(rows: DataFrame, *, prefix: str = "group:") -> tuple[DataFrame, DataFrame]:
    """(groups, rows with their ``group_id``): published rows that ask the same, of one document, category and topic.

    Rows have id, document_id, dimension, category, topic_code, question_text,
    raw_question_text, published_answers, correctness_known, published_correct_answer,
    answer_structure, pictures, graphics, masked, incomplete, position. A group is a document,
    dimension, category, topic code, wording (``text.cased_text``) and, where the question needs
    its picture, sorted picture hashes ("no-image" without any). Its first row gives text,
    readings and incompleteness; ``answers`` are the distinct correct ones (by
    ``text.words_text``) in row order. A full list of options is no list of correct answers. Pictures keep how
    often they occur (up to 1,000). Rows of a group are not listed in it, so a group can hold any
    number; each row carries its group. Null parts of the key are empty.
    """
    text = tx.cased_text(F.col("question_text"))
    needs = tx.needs_picture(F.col("question_text"), tx.words_texts("published_answers"), narrow=True)
    right = F.when(F.col("correctness_known") & F.col("published_correct_answer").isNotNull(), F.array("published_correct_answer")).when(F.col("answer_structure") == "published_answer_only", F.col("published_answers")).otherwise(F.array().cast("array<string>"))
    held = rows.withColumns({"text": F.coalesce(text, F.lit("")), "needs_picture": needs, "right": right}).withColumn("keys", tx.words_texts("right"))
    shown = F.when(~F.col("needs_picture"), F.array().cast("array<string>")).when(F.size("pictures") > 0, F.array_sort("pictures")).otherwise(F.array(F.lit("no-image")))
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("document_id", "dimension", "category", "topic_code", "text")]
    held = held.withColumn("group_id", F.concat(F.lit(prefix), F.substring(F.sha2(json_key(*parts, shown), 256), 1, 24)))
    held = scratch.table(held, "grouped")
    order = F.struct("position", "id")
    firsts = held.groupBy("group_id").agg(
        F.min_by(F.struct("document_id", "dimension", "category", "topic_code", "text", "needs_picture", F.col("question_text").alias("as_printed"), F.col("raw_question_text").alias("raw"), "incomplete"), order).alias("x"),
        F.count("*").alias("rows"), F.bool_or("graphics").alias("graphics"), F.bool_or("masked").alias("masked"),
    )
    each = held.select("group_id", order.alias("o"), F.posexplode(F.arrays_zip("right", "keys")).alias("nth", "z")).select("group_id", F.struct("o", "nth").alias("o"), F.col("z.right").alias("answer"), F.col("z.keys").alias("key"))
    answers = each.groupBy("group_id", "key").agg(F.min_by("answer", "o").alias("answer"), F.min("o").alias("o"))
    answers = answers.groupBy("group_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "key", "answer"))), lambda x: x["answer"]).alias("answers"), F.array_sort(F.collect_set("key")).alias("answer_keys"))
    seen = held.select("group_id", F.explode("pictures").alias("sha")).groupBy("group_id", "sha").agg(F.least(F.count("*"), F.lit(1000)).cast("int").alias("n"))
    seen = seen.groupBy("group_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("sha", "n"))), lambda x: F.array_repeat(x["sha"], x["n"]))).alias("pictures"))
    none = F.array().cast("array<string>")
    g = firsts.join(answers, "group_id", "left").join(seen, "group_id", "left")
    g = g.select(F.col("group_id").alias("id"), "x.*", "rows", "graphics", "masked", *[F.coalesce(c, none).alias(c) for c in ("answers", "answer_keys", "pictures")])
    return g.withColumn("variants", tx.text_variants(F.col("raw"))), held


def canonical_titles(rows: DataFrame, *, title: str, key: Column) -> DataFrame:
    """``topic_id, title_key, title, spellings, rows``: titles of one normalised key; the most frequent spelling, ties alphabetical."""
    n = rows.where(F.col(title).isNotNull()).withColumn("title_key", key).groupBy("title_key", title).agg(F.count("*").alias("n"))
    best = F.min_by(title, F.struct((-F.col("n")).alias("n"), F.col(title)))
    return n.groupBy("title_key").agg(best.alias("title"), F.count("*").alias("spellings"), F.sum("n").alias("rows")).select(F.concat(F.lit("topic_"), F.substring(F.sha2("title_key", 256), 1, 16)).alias("topic_id"), "title_key", "title", "spellings", "rows")


def membership_rollup(rows: DataFrame, *, id: str, memberships: str) -> DataFrame:
    """``id, dimension, categories, topics, documents``: sorted distinct memberships of each record by dimension."""
    m = rows.select(F.col(id).alias(id), F.explode(memberships).alias("m")).select(id, "m.*")
    return m.groupBy(id, "dimension").agg(F.array_sort(F.collect_set("category")).alias("categories"), F.array_sort(F.collect_set("topic_title")).alias("topics"), F.countDistinct("membership_id").alias("links"))


def code_tree(rows: DataFrame, *, code: str, separator: str = ".") -> DataFrame:
    """``node, parent, depth, rows``: every leading part of dotted codes, with the rows below it. Codes of one part are roots only."""
    parts = rows.where(F.col(code).isNotNull()).select(F.split(code, F.lit(f"\\Q{separator}\\E")).alias("p"))
    nodes = parts.select(F.explode(F.sequence(F.lit(1), F.size("p"))).alias("depth"), "p").select("depth", F.array_join(F.slice("p", F.lit(1), F.col("depth")), separator).alias("node"), F.when(F.col("depth") > 1, F.array_join(F.slice("p", F.lit(1), F.col("depth") - 1), separator)).alias("parent"))
    return nodes.groupBy("node", "parent", "depth").agg(F.count("*").alias("rows"))


def first_links(links: DataFrame, *, key: str, order: str) -> DataFrame:
    """The first row of each key in ``order`` and how often the key occurs: ``occurrences``."""
    rest = [c for c in links.columns if c != key]
    return links.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r"), F.count("*").alias("occurrences")).select(key, "r.*", "occurrences")


def with_all(counts: DataFrame, *, key: str, values: Sequence[str]) -> DataFrame:
    """Counts by ``key`` with a row for each of ``values``, 0 where there is none."""
    spark = counts.sparkSession
    every = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"nth int, {key} string")
    return every.join(counts, key, "left").fillna(0).drop("nth")


def coverage(df: DataFrame, *, tier: str, usable: Sequence[str]) -> DataFrame:
    """``tier, rows, percent, usable`` of a decision; percents half-even to two places."""
    n = df.groupBy(F.col(tier).alias("tier")).agg(F.count("*").alias("rows"))
    every = F.sum("rows").over(Window.partitionBy(F.lit(0)))  # one row per tier
    return n.select("tier", "rows", F.bround(100.0 * F.col("rows") / every, 2).alias("percent"), F.col("tier").isin(*usable).alias("usable"))


def order_audit(rows: DataFrame, *, by: Sequence[str], order: str, topic: str, tier: str, anchors: Sequence[str], targets: Sequence[str], k: int = 5) -> DataFrame:
    """What the neighbours of unresolved rows say: of each target the topics of ``k`` anchors on
    either side, whether a full side is unanimous, and whether both sides agree or conflict.

    Rows in neither tier take no part. A side with fewer than ``k`` anchors is never unanimous.
    """
    a = rows.where(F.col(tier).isin(*anchors) & F.col(topic).isNotNull()).select(*by, order, topic)
    t = rows.where(F.col(tier).isin(*targets)).select(*by, order).distinct()
    got = nearest(t, a, by=by, order=order, k=k, carry=topic)
    lone = lambda c: (F.size(c) == k) & (F.size(F.array_distinct(c)) == 1)
    return got.select(
        *by, order, "before", "after", lone(F.col("before")).alias("same_before"), lone(F.col("after")).alias("same_after"),
        (lone(F.col("before")) & lone(F.col("after")) & (F.get("before", F.lit(0)) == F.get("after", F.lit(0)))).alias("same_both"),
        (lone(F.col("before")) & lone(F.col("after")) & (F.get("before", F.lit(0)) != F.get("after", F.lit(0)))).alias("transition"),
    )


def answer_support(live: Column, published: Column, live_keys: Column, published_keys: Column) -> Column:
    """How the published answers support the one correct live answer: supported_exact,
    supported_normalized, unsupported, or not_comparable without exactly one and at least one."""
    one = F.get(live, F.lit(0))
    return F.when((F.size(live) != 1) | (F.coalesce(F.size(published), F.lit(0)) < 1), "not_comparable").when(F.array_contains(published, one), "supported_exact").when(F.array_contains(published_keys, F.get(live_keys, F.lit(0))), "supported_normalized").otherwise("unsupported")


def answer_check(live: Column, media: Column, published: Column, known: Column, raw: Column) -> Column:
    """What became of a row's published answer: unknown_correctness, not_comparable, same, wording_changed or different.

    ``live`` are the correct live answers, ``media`` whether live answers have any,
    ``published`` the correct printed answer, ``known`` whether it is, ``raw`` its text as printed, whose
    readings count as the same. Null flags count as false.
    """
    one = F.get(live, F.lit(0))
    readings = F.transform(tx.text_variants(F.coalesce(raw, F.lit(""))), tx.unquoted)
    comparable = (F.coalesce(F.size(live), F.lit(0)) == 1) & published.isNotNull() & ~F.coalesce(media, F.lit(False))
    return (
        F.when(~F.coalesce(known, F.lit(False)), "unknown_correctness").when(~comparable, "not_comparable").when(one == published, "same")
        .when(F.array_contains(readings, tx.answer_key(one)), "wording_changed").otherwise("different")
    )


def annotated(pairs: DataFrame, titles: DataFrame, *, title: str, key: Column) -> DataFrame:
    """``pairs`` with ``topic``, the row of ``canonical_titles`` their title belongs to, and ``membership``, where they come from.

    A title without a canonical topic fails the job. ``key`` is the title's normal form, an
    expression over ``pairs``; prefix and position are kept if there are such columns.
    """
    held = titles.select(F.col("title_key").alias("_k"), F.struct("topic_id", "title", "title_key").alias("topic"))
    out = pairs.withColumn("_t", key).join(held, F.col("_t") == F.col("_k"), "left")
    topic = F.when(F.col("topic").isNull(), F.raise_error(F.lit("a title has no canonical topic"))).otherwise(F.col("topic"))
    source = [F.col(c) for c in ("prefix", "position") if c in pairs.columns] + [F.col(title).alias("printed")]
    return out.withColumn("topic", topic).withColumn("membership", F.struct(*source)).drop("_t", "_k")
