"""Row constraints as columns, their violations as rows, and summaries of a record set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(df: DataFrame, *, id: str, rules: Mapping[str, Column]) -> DataFrame:
    """``id, rule`` of every rule a row breaks. A rule that is null for a row is broken."""
    broken = F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.select(F.col(id).alias(id), F.explode(F.array_compact(broken)).alias("rule"))


def question_rules(*, url_allowed: Column | None = None) -> dict[str, Column]:
    """Constraints of a nested question row (id, answers with ids and correctness, flags)."""
    ids = F.transform("answers", lambda a: a["id"])
    right = F.transform(F.filter("answers", lambda a: a["correct"]), lambda a: a["id"])
    given = F.col("correct_answer_ids")
    rules = {
        "content": (F.length("text") > 0) | (F.size("resources") > 0),
        "official_id": F.when(F.col("official_id").isNull(), (F.col("position_no") == 1) & (F.col("id_status") == "unresolved_initial_html")).otherwise(F.col("id_status") == "official"),
        "answer_ids_unique": F.size(F.array_distinct(ids)) == F.size(ids),
        "at_least_two_answers": F.size("answers") >= 2,
        "correct_ids_unique": F.size(F.array_distinct(given)) == F.size(given),
        "correct_ids_known": F.size(F.array_except(given, ids)) == 0,
        "correct_flags": F.array_sort(right) == F.array_sort(given),
        "multiple_flag": F.col("multiple") == (F.col("question_type") == "multiple"),
        "correct_count": F.when(F.col("question_type") == "multiple", F.size(given) >= 2).otherwise(F.size(given) == 1),
        "position": F.col("position_no") > 0,
    }
    if url_allowed is not None:
        rules["resource_urls"] = url_allowed
    return rules


def published_rules() -> dict[str, Column]:
    """Constraints of a published row: its identity and its correctness."""
    known, at = F.col("correctness_known"), F.col("published_correct_answer_indexes")
    return {
        "document_is_source": F.col("document_id") == F.col("source_pdf_sha256"),
        "reference_id": F.col("reference_id") == F.concat_ws(":", "document_id", F.col("order_no").cast("string")),
        "positions": (F.col("page") >= 1) & (F.col("order_no") >= 1),
        "memberships": F.size("memberships") >= 1,
        "known_has_indexes": known == at.isNotNull(),
        "indexes": F.when(at.isNull(), F.lit(True)).otherwise((F.size(at) > 0) & (F.size(F.array_distinct(at)) == F.size(at)) & F.forall(at, lambda i: (i >= 0) & (i < F.size("published_answers")))),
        "single_index": F.when(F.size(at) == 1, F.get("published_answers", F.get(at, 0)) == F.col("published_correct_answer")).otherwise(F.lit(True)),
    }


def url_rule(url: Column, *, host: str, port: int | None, prefix: str = "/", query: bool = True) -> Column:
    """Whether a URL is HTTPS of one host and port below a path, without credentials,
    fragment, back slashes, control characters, dot segments or escaped per cents."""
    at = f"{host}:{port}" if port else host
    path = F.regexp_extract(url, r"^https://[^/?#]*([^?#]*)", 1)
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), F.lit("%"))
    ok = (
        (F.lower(F.regexp_extract(url, r"^(https)://([^/?#]*)", 2)) == at)
        & plain.startswith(prefix) & (plain != prefix if prefix != "/" else F.lit(True))
        & ~url.contains("\\") & ~url.contains("#") & ~url.rlike(r"[\x00-\x1f]")
        & ~plain.rlike(r"(^|/)\.{1,2}(/|$)") & ~plain.contains("%")
    )
    return ok if query else ok & ~url.contains("?")


def media_signature(kind: Column, body: Column) -> Column:
    """Whether the first bytes of ``body`` are those of the media type; false for other types and empty bodies."""
    head = lambda start, n: F.hex(F.substring(body, start, n))
    text = F.lower(F.decode(F.substring(body, 1, 4096), "ISO-8859-1"))
    # Signatures by type.
    by_type = {
        "image/jpeg": head(1, 3) == "FFD8FF",
        "image/png": head(1, 8) == "89504E470D0A1A0A",
        "image/gif": head(1, 6).isin("474946383761", "474946383961"),
        "image/webp": (head(1, 4) == "52494646") & (head(9, 4) == "57454250"),
        "image/bmp": head(1, 2) == "424D",
        "image/svg+xml": text.contains("<svg") & ~text.contains("<html"),
        "application/pdf": head(1, 5) == "255044462D",
        "video/mp4": head(5, 4) == "66747970",
        "audio/mpeg": (head(1, 3) == "494433") | head(1, 2).isin("FFFB", "FFF3", "FFF2"),
        "audio/ogg": head(1, 4) == "4F676753",
        "image/avif": (head(5, 4) == "66747970") & head(1, 40).contains("61766966"),
    }
    # End of fixed values.
    out = None
    for name, test in by_type.items():
        out = F.when(kind == name, test) if out is None else out.when(kind == name, test)
    return F.coalesce(out.otherwise(F.lit(False)), F.lit(False))


def duplicate_profile(df: DataFrame, *, key: Sequence[str]) -> DataFrame:
    """One row: rows, unique, duplicate_groups, in_groups (rows of such groups), excess (beyond one each). Nulls are a key."""
    sizes = df.groupBy(*key).agg(F.count("*").alias("n"))
    many = F.col("n") > 1
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("unique"), F.count_if(many).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("in_groups"), F.coalesce(F.sum(F.when(many, F.col("n") - 1)), F.lit(0)).alias("excess"),
    )


def repeated_keys(df: DataFrame, *, key: str) -> DataFrame:
    """``key, n`` of non-null keys that occur more than once."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def record_summary(df: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Counts of a question set: positions, ids, types, questions and answers with media; and whether positions are 1..n."""
    media = F.exists("answers", lambda a: F.size(a["resources"]) > 0)
    return df.groupBy(*by).agg(
        F.count("*").alias("positions"), F.count("official_id").alias("with_official_id"), F.count_if(F.col("official_id").isNull()).alias("without_official_id"),
        F.countDistinct("official_id").alias("unique_official_ids"), F.countDistinct("stable_key").alias("unique_keys"),
        F.count_if(F.col("question_type") == "single").alias("single"), F.count_if(F.col("question_type") == "multiple").alias("multiple"),
        F.count_if(F.size("resources") > 0).alias("question_media"), F.count_if(media).alias("answer_media"),
        (F.coalesce(F.max("position_no") == F.count("*"), F.lit(False)) & (F.min("position_no") == 1) & (F.countDistinct("position_no") == F.count("*"))).alias("consecutive"),
    )


def position_gaps(df: DataFrame, *, by: Sequence[str], position: str) -> DataFrame:
    """Breaks in positions that should run 1..n per group: the group, the position before (0: start) and after the gap."""
    w = Window.partitionBy(*by).orderBy(position)
    seen = df.where(F.col(position).isNotNull()).select(*by, position).distinct()
    step = seen.withColumn("before", F.coalesce(F.lag(position).over(w), F.lit(0)))
    return step.where(F.col(position) != F.col("before") + 1).select(*by, "before", F.col(position).alias("after"))


def orphans(child: DataFrame, parent: DataFrame, *, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``child`` whose non-null key has no row in ``parent``."""
    keys = parent.select(*[F.col(p).alias(f"_k{i}") for i, p in enumerate(on.values())]).distinct()
    cond = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(on)]
    for c in on:
        child = child.where(F.col(c).isNotNull())
    return child.join(keys, cond, "left_anti")
