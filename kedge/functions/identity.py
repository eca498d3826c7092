"""Content identities: digests of canonical JSON.

Canonical JSON has sorted keys, no blanks and non-ASCII characters as they are; Spark's
``to_json`` of a struct whose fields are in alphabetical order is exactly that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH_ALGORITHM, REVISION_ALGORITHM = "match-fingerprint-v1", "revision-fingerprint-v2"


def digest(*fields: Column) -> Column:
    """SHA-256 of the canonical JSON of named columns, which must come in alphabetical order. Nulls are kept."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def _urls(c: Column) -> Column:
    return F.transform(c, lambda r: r["url"])


def _answers(c: Column, ids: bool) -> Column:
    def one(a: Column) -> Column:
        named = [a["id"].alias("id")] if ids else []
        return F.struct(*named, _urls(a["resources"]).alias("resources"), a["text"].alias("text"))

    return F.transform(c, one)


def content_fingerprint(text: Column, resources: Column, answers: Column) -> Column:
    """Ordered content without ids."""
    return digest(_answers(answers, False).alias("answers"), _urls(resources).alias("resources"), text.alias("text"))


def match_fingerprint(text: Column, resources: Column, answers: Column) -> Column:
    """Ordered content with answer ids."""
    return digest(F.lit(MATCH_ALGORITHM).alias("algorithm"), _answers(answers, True).alias("answers"), _urls(resources).alias("resources"), text.alias("text"))


def revision_fingerprint(match: Column, kind: Column, multiple: Column, additional: Column, correct_ids: Column, answers: Column) -> Column:
    """Everything of a revision: its content, its flags and which answers are correct. Null flags are values."""
    return digest(
        F.lit(REVISION_ALGORITHM).alias("algorithm"),
        F.array_sort(correct_ids).alias("correct_answer_ids"),
        F.transform(answers, lambda a: a["correct"]).alias("correct_flags"),
        additional.alias("is_additional"),
        match.alias("match"),
        multiple.alias("multiple"),
        kind.alias("type"),
    )


def stable_key(official: Column, match: Column) -> Column:
    """``official:<id>``, or ``fallback:<match fingerprint>`` without one."""
    return F.when(official.isNotNull(), F.concat(F.lit("official:"), official)).otherwise(F.concat(F.lit("fallback:"), match))


def short_id(prefix: str, *parts: Column, length: int = 24, separator: str = "\n") -> Column:
    """Prefix and the first characters of the SHA-256 of the parts, null parts as empty."""
    joined = F.concat_ws(separator, *[F.coalesce(p, F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, length))


def content_key(text: Column, answers: Column, images: Column) -> Column:
    """JSON identity of text, answers in order and sorted images; without images null stands for them."""
    return F.to_json(F.struct(text.alias("t"), answers.alias("a"), F.when(F.size(images) > 0, F.array_sort(images)).alias("i")), {"ignoreNullFields": "false"})


def is_uuid(c: Column) -> Column:
    """Whether the text is a canonical lower-case UUID."""
    return c.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")


def run_id(c: Column) -> Column:
    """Run identifier of an instant in UTC."""
    return F.date_format(F.to_utc_timestamp(c.cast("timestamp"), F.current_timezone()), "yyyyMMdd'T'HHmmss.SSSSSS'Z'")
