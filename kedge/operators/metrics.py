"""Metrics of inventories, parsed corpora and crosswalks as rows (metric, value), and checks that recompute them.

Every metric is an aggregate; histograms are one row a value. Checks give one row per
violation, so a sound artifact gives none, and compose by union.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedge.operators.compare import nonequal_rows
from kedge.operators.quality import duplicate_profile, position_gaps, violations

_SCHEMA = "metric string, value bigint"


def rows_of(df: DataFrame) -> DataFrame:
    """The columns of a one-row table as ``metric, value``."""
    each = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("bigint").alias("value")) for c in df.columns])
    return df.select(F.explode(each).alias("m")).select("m.*")


def histogram(df: DataFrame, prefix: str, of: Column) -> DataFrame:
    """``metric, value``: how often each value occurs, named ``prefix:value``; nulls are left out."""
    return df.select(F.concat(F.lit(f"{prefix}:"), of.cast("string")).alias("metric")).where("metric is not null").groupBy("metric").agg(F.count("*").alias("value"))


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("value", F.col("value").cast("bigint"))


def inventory_metrics(m: DataFrame) -> DataFrame:
    """Metrics of the links to documents: how many, of how many urls and contents, repeated urls, contents under several urls, links by category."""
    urls = m.groupBy("pdf_url").agg(F.count("*").alias("n"))
    shas = m.where("source_pdf_sha256 is not null").groupBy("source_pdf_sha256").agg(F.countDistinct("pdf_url").alias("n"))
    facts = m.agg(F.count("*").alias("memberships"), F.countDistinct("pdf_url").alias("urls"), F.countDistinct("source_pdf_sha256").alias("documents"), F.coalesce(F.sum(F.col("link_occurrences") - 1), F.lit(0)).alias("repeated_links"))
    return _union(
        rows_of(facts), rows_of(urls.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("memberships_of_repeated_urls"))),
        rows_of(shas.agg(F.count_if(F.col("n") > 1).alias("documents_of_several_urls"))), histogram(m, "category", F.concat_ws("/", "dimension", "category")),
    )


def parse_metrics(p: DataFrame) -> DataFrame:
    """Metrics of published rows: repeated texts and their excess, texts of several categories or topics, exact duplicates, pictures, known answers, and histograms of structures, issues and answer counts."""
    texts = rows_of(duplicate_profile(p, key=["normalized_question_text"]).select(F.col("rows").alias("questions"), F.col("unique").alias("unique_texts"), F.col("duplicate_groups").alias("repeated_text_groups"), F.col("excess").alias("excess_texts")))
    pictures = F.transform(F.coalesce("illustration_refs", F.array()), lambda r: r["sha256"])
    exact = p.select(F.sha2(F.to_json(F.struct("question_text", "published_answers", F.array_sort(pictures).alias("p")), {"ignoreNullFields": "false"}), 256).alias("k"))
    m = p.select("normalized_question_text", F.explode("memberships").alias("m"))
    spans = m.groupBy("normalized_question_text").agg(F.countDistinct("m.category").alias("categories"), F.countDistinct(F.concat_ws("\u0001", F.col("m.dimension"), F.col("m.category"), F.coalesce("m.topic_code", F.lit("")))).alias("topics"))
    facts = p.agg(F.countDistinct("document_id").alias("documents"), F.count_if("correctness_known").alias("correctness_known"))
    return _union(
        texts, rows_of(facts), rows_of(duplicate_profile(exact, key=["k"]).select(F.col("excess").alias("exact_duplicates"))),
        rows_of(spans.agg(F.count_if(F.col("categories") > 1).alias("texts_in_several_categories"), F.count_if(F.col("topics") > 1).alias("texts_in_several_topics"))),
        rows_of(p.select(F.explode(pictures).alias("h")).agg(F.countDistinct("h").alias("unique_pictures"))),
        histogram(p, "structure", F.col("answer_structure")), histogram(p.select(F.explode("issues").alias("i")), "issue", F.col("i")), histogram(p, "answers", F.greatest(F.coalesce(F.size("published_answers"), F.lit(0)), F.lit(0))),
    )


def crosswalk_metrics(records: DataFrame, pairs: DataFrame, *, tiers: Sequence[str] = ("exact", "strong", "probable", "ambiguous", "unmatched"), flags: Mapping[str, Column] | None = None) -> DataFrame:
    """Metrics of decisions: records by tier (every tier, 0 where there is none), records with several accepted pairs, matched partners, and per flag the records with any accepted pair that has it.

    ``records`` are ``id, tier``; ``pairs`` ``l, r, accepted``. A null flag counts as false.
    """
    flags = flags or {}
    per = pairs.where("accepted").groupBy("l").agg(F.count("*").alias("n"), *[F.max(F.coalesce(c, F.lit(False))).alias(f"f{i}") for i, c in enumerate(flags.values())])
    shown = per.agg(F.count_if(F.col("n") > 1).alias("several_accepted"), *[F.count_if(f"f{i}").alias(name) for i, name in enumerate(flags)])
    by_tier = records.agg(F.count("*").alias("records"), *[F.count_if(F.col("tier") == t).alias(f"tier:{t}") for t in tiers])
    return _union(rows_of(by_tier), rows_of(shown), rows_of(pairs.where("accepted").agg(F.countDistinct("r").alias("matched_partners"))))


def reconciliation(before: DataFrame, after: DataFrame, *, id: str, usable: str) -> DataFrame:
    """``before, after, n``: records by whether they were usable and are now: the 2 x 2 of recovered and downgraded ones; null on a side that lacks the record."""
    a, b = before.select(id, F.col(usable).alias("before")), after.select(id, F.col(usable).alias("after"))
    return a.join(b, id, "full_outer").groupBy("before", "after").agg(F.count("*").alias("n"))


def by_category(rows: DataFrame, *, category: str, values: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One row per category, those without rows included: ``category, rows`` and the measures (0 without rows)."""
    n = rows.groupBy(F.col(category).alias("category")).agg(F.count("*").alias("rows"), *[c.alias(k) for k, c in measures.items()])
    every = rows.sparkSession.createDataFrame([(v,) for v in values], "category string")
    return every.join(n, "category", "left").fillna(0)


def top_reviews(records: DataFrame, *, tiers: Sequence[str], score: str, position: str, k: int = 10) -> DataFrame:
    """The ``k`` records of each tier with the best score, then in the order of position: a report."""
    parts = [records.where(F.col("tier") == t).orderBy(F.desc_nulls_last(score), position).limit(k) for t in tiers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def last_by_identity(pairs: DataFrame, *, identity: Sequence[str], order: str) -> DataFrame:
    """Of several rows of one identity the one that comes last in ``order``; map-side combined."""
    rest = [c for c in pairs.columns if c not in identity]
    return pairs.groupBy(*identity).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*identity, "r.*").select(*pairs.columns)


# ---- checks


def check(name: str, df: DataFrame, detail: Column | str | None = None) -> DataFrame:
    """Every row of ``df`` as a violation: ``check_name, detail``."""
    d = F.lit(None) if detail is None else F.col(detail) if isinstance(detail, str) else detail
    return df.select(F.lit(name).alias("check_name"), d.cast("string").alias("detail"))


def all_checks(*parts: DataFrame) -> DataFrame:
    """The violations of several checks."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_inventory(memberships: DataFrame, objects: DataFrame, *, metrics: DataFrame | None = None) -> DataFrame:
    """Violations of an inventory: repeated membership ids, links without a document, documents without their object (``sha256``), metrics that don't recompute."""
    m = memberships
    parts = [
        check("membership_id_repeated", m.groupBy("membership_id").agg(F.count("*").alias("n")).where("n > 1"), "membership_id"),
        check("document_missing", m.where("document_id is null or source_pdf_sha256 is null"), "membership_id"),
        check("document_is_source", m.where("document_id <> source_pdf_sha256"), "membership_id"),
        check("object_missing", m.select("source_pdf_sha256").distinct().join(objects.select(F.col("sha256").alias("source_pdf_sha256")).distinct(), "source_pdf_sha256", "left_anti"), "source_pdf_sha256"),
    ]
    if metrics is not None:
        parts.append(check("metric", nonequal_rows(metrics.select("metric", "value"), inventory_metrics(m)), "metric"))
    return all_checks(*parts)


def verify_parsed(parsed: DataFrame, memberships: DataFrame, *, rules: Mapping[str, Column], metrics: DataFrame | None = None) -> DataFrame:
    """Violations of parsed rows: broken row constraints, repeated ids, positions that don't run 1..n in their document, documents outside the inventory, metrics that don't recompute."""
    parts = [
        check("rule", violations(parsed, id="reference_id", rules=rules), F.concat_ws("|", "rule", "reference_id")),
        check("reference_id_repeated", parsed.groupBy("reference_id").agg(F.count("*").alias("n")).where("n > 1"), "reference_id"),
        check("position", position_gaps(parsed, by=["document_id"], position="order_no"), "document_id"),
        check("document_unknown", parsed.select("document_id").distinct().join(memberships.select("document_id").distinct(), "document_id", "left_anti"), "document_id"),
    ]
    if metrics is not None:
        parts.append(check("metric", nonequal_rows(metrics.select("metric", "value"), parse_metrics(parsed)), "metric"))
    return all_checks(*parts)


def verify_crosswalk(records: DataFrame, live: DataFrame, *, id: str = "id", position: str | None = None, written: Mapping[str, DataFrame], recomputed: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of a crosswalk: live records without exactly one row, rows out of live order, artifacts that don't recompute.

    ``written`` and ``recomputed`` are tables by name with the same columns, compared as
    bags. With ``position`` (a column of both) a row must stand where its live record does.
    """
    n = live.select(id).distinct().join(records.groupBy(id).agg(F.count("*").alias("n")), id, "full_outer")
    known = live.select(id, F.lit(True).alias("_live")).distinct()
    parts = [check("not_one_row", n.join(known, id, "left").where("n is null or n <> 1 or _live is null"), id)]
    if position:
        at = live.select(id, F.col(position).alias("_at")).distinct()
        parts.append(check("order", records.join(at, id).where(~F.col(position).eqNullSafe(F.col("_at"))), id))
    for name in written:
        both = nonequal_rows(written[name], recomputed[name].select(*written[name].columns))
        parts.append(check(f"recomputed:{name}", both, "side"))
    return all_checks(*parts)


def guard(hashes: DataFrame) -> DataFrame:
    """``path, sha256`` of inputs that must not change while something is computed from them; write or keep it, and compare with ``changed``."""
    return hashes.select("path", "sha256").distinct()


def changed(before: DataFrame, now: DataFrame) -> DataFrame:
    """Violations: inputs that changed, vanished or came since their ``guard``."""
    a, b = before.select("path", F.col("sha256").alias("a")), now.select("path", F.col("sha256").alias("b"))
    return check("input_changed", a.join(b, "path", "full_outer").where("not a <=> b"), "path")
