"""Queries p2 and p3, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedge.functions.instants import instant_us
from kedge.operators.history import bitemporal_ledger, current_versions
from kedge.operators.snapshot_delta import snapshot_delta, snapshot_pairs

#: Fields of a live question that p2_changed_fields compares.
QUESTION_FIELDS = ("revision_fingerprint", "position_no", "text", "question_type", "multiple", "is_additional", "resources", "answers", "correct_answer_ids")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = snapshot_pairs(spark.read.parquet(f"{d}/manifest.parquet"))
    delta = snapshot_delta(spark.read.parquet(f"{d}/questions.parquet"), pairs, snapshot="snapshot_id", key="stable_key", fields=["revision_fingerprint"])
    return delta.select("snapshot_id", F.col("key").alias("stable_key"), "change_kind")


def p2_changed_fields(spark: SparkSession, d: str) -> DataFrame:
    pairs = snapshot_pairs(spark.read.parquet(f"{d}/manifest.parquet"))
    delta = snapshot_delta(spark.read.parquet(f"{d}/questions.parquet"), pairs, snapshot="snapshot_id", key="stable_key", fields=QUESTION_FIELDS)
    return delta.select("snapshot_id", F.col("key").alias("stable_key"), "change_kind", F.array_join("changed_fields", ",").alias("changed_fields"))


def media_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Bitemporal ledger of the sha256 behind each url, from every check."""
    media = spark.read.parquet(f"{d}/media_records.parquet")
    blank = lambda c: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))
    obs = media.select(
        blank("url").alias("url"), F.lower(blank("sha256")).alias("sha256"), instant_us(F.col("retrieved_at")).alias("t"),
        F.unix_micros(F.col("delivered_at").cast("timestamp")).alias("r"),
    )
    return bitemporal_ledger(obs, key="url", value="sha256", valid="t", recorded="r")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    now = current_versions(media_ledger(spark, d))
    return now.select(F.col("key").alias("url"), F.col("value").alias("sha256"), F.col("valid_from").alias("valid_from_us"), F.coalesce("valid_to", F.lit(-1).cast("bigint")).alias("valid_to_us"))


def p3_ledger(spark: SparkSession, d: str) -> DataFrame:
    rows = media_ledger(spark, d)
    return rows.select(F.col("key").alias("url"), F.col("value").alias("sha256"), *[F.coalesce(c, F.lit(-1).cast("bigint")).alias(f"{c}_us") for c in ("valid_from", "valid_to", "recorded_from", "recorded_to")])


_PAIRS_SQL = """
  pairs AS (SELECT DISTINCT m.snapshot_id AS later, m.previous_snapshot AS earlier FROM manifest m
            WHERE m.complete AND m.previous_snapshot <> m.snapshot_id
              AND m.previous_snapshot IN (SELECT snapshot_id FROM manifest WHERE snapshot_id IS NOT NULL))"""

P2_SQL = f"""
WITH {_PAIRS_SQL},
  r AS (SELECT DISTINCT snapshot_id, stable_key, revision_fingerprint AS fp FROM questions WHERE stable_key IS NOT NULL),
  n AS (SELECT snapshot_id, stable_key, count(*) AS n, min(fp) AS fp FROM r GROUP BY 1, 2),
  a AS (SELECT p.later, n.* FROM pairs p JOIN n ON n.snapshot_id = p.later),
  b AS (SELECT p.later, n.* FROM pairs p JOIN n ON n.snapshot_id = p.earlier),
  j AS (SELECT coalesce(a.later, b.later) AS snapshot_id, coalesce(a.stable_key, b.stable_key) AS stable_key, a.n AS an, b.n AS bn, a.fp AS afp, b.fp AS bfp
        FROM a FULL OUTER JOIN b ON a.later = b.later AND a.stable_key = b.stable_key)
SELECT * FROM (
  SELECT snapshot_id, stable_key, CASE WHEN an > 1 OR bn > 1 THEN 'ambiguous' WHEN bn IS NULL THEN 'added' WHEN an IS NULL THEN 'removed'
    WHEN afp IS DISTINCT FROM bfp THEN 'changed' ELSE 'same' END AS change_kind FROM j) WHERE change_kind <> 'same'
"""

P2_FIELDS_SQL = f"""
WITH {_PAIRS_SQL},
  r AS (SELECT DISTINCT snapshot_id, stable_key, {", ".join(QUESTION_FIELDS)} FROM questions WHERE stable_key IS NOT NULL),
  n AS (SELECT snapshot_id, stable_key, count(*) AS n, {", ".join(f"any_value(ROW({f})) AS {f}" for f in QUESTION_FIELDS)} FROM r GROUP BY 1, 2),
  a AS (SELECT p.later, n.* FROM pairs p JOIN n ON n.snapshot_id = p.later),
  b AS (SELECT p.later, n.* FROM pairs p JOIN n ON n.snapshot_id = p.earlier),
  j AS (SELECT coalesce(a.later, b.later) AS snapshot_id, coalesce(a.stable_key, b.stable_key) AS stable_key, a.n AS an, b.n AS bn,
          concat_ws(',', {", ".join(f"CASE WHEN a.{f} IS DISTINCT FROM b.{f} THEN '{f}' END" for f in sorted(QUESTION_FIELDS))}) AS f
        FROM a FULL OUTER JOIN b ON a.later = b.later AND a.stable_key = b.stable_key)
SELECT snapshot_id, stable_key, change_kind, CASE WHEN change_kind = 'changed' THEN f ELSE '' END AS changed_fields FROM (
  SELECT *, CASE WHEN an > 1 OR bn > 1 THEN 'ambiguous' WHEN bn IS NULL THEN 'added' WHEN an IS NULL THEN 'removed' WHEN f <> '' THEN 'changed' ELSE 'same' END AS change_kind FROM j) WHERE change_kind <> 'same'
"""

_OBSERVED_SQL = """
  parsed AS (SELECT trim(url) AS url, lower(trim(sha256)) AS sha256, epoch_us(delivered_at) AS d, CASE
      WHEN regexp_matches(trim(retrieved_at), '^[A-Z][a-z]{2}, ') THEN epoch_us(try_strptime(trim(retrieved_at), '%a, %d %b %Y %H:%M:%S GMT'))
      WHEN regexp_matches(trim(retrieved_at), '(Z|[+-]\\d{2}:\\d{2})$') AND length(trim(retrieved_at)) > 12 THEN epoch_us(try_cast(trim(retrieved_at) AS TIMESTAMPTZ))
      ELSE epoch_us(try_cast(trim(retrieved_at) AS TIMESTAMP)) END AS t FROM media_records)"""
P3_LEDGER_SQL = f"""
WITH {_OBSERVED_SQL},
  o AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY t, r, sha256) AS n FROM (SELECT url, sha256, t, min(coalesce(d, t)) AS r FROM parsed WHERE url <> '' AND sha256 <> '' AND t IS NOT NULL GROUP BY 1, 2, 3)),
  s AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY r, n) AS arrival FROM o),
  -- successors an observation has had, each from the arrival that made it one
  x AS (SELECT a.url, a.n, a.arrival AS turn, a.r AS since, min(b.n) AS next FROM s a LEFT JOIN s b ON b.url = a.url AND b.n > a.n AND b.arrival < a.arrival GROUP BY ALL
        UNION ALL SELECT a.url, a.n, b.arrival, b.r, b.n FROM s a JOIN s b ON b.url = a.url AND b.n > a.n AND b.arrival > a.arrival),
  y AS (SELECT *, min(next) OVER (PARTITION BY url, n ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least, row_number() OVER (PARTITION BY url, n ORDER BY turn) AS k FROM x),
  z AS (SELECT *, lead(since) OVER (PARTITION BY url, n ORDER BY turn) AS until FROM y WHERE k = 1 OR least IS NULL OR next < least)
SELECT s.url, s.sha256, s.t AS valid_from_us, coalesce(e.t, -1) AS valid_to_us, z.since AS recorded_from_us, coalesce(z.until, -1) AS recorded_to_us
FROM z JOIN s ON s.url = z.url AND s.n = z.n LEFT JOIN s e ON e.url = z.url AND e.n = z.next WHERE z.since IS DISTINCT FROM z.until AND s.t IS DISTINCT FROM e.t
"""

P3_SQL = """
WITH raw AS (SELECT trim(url) AS url, lower(trim(sha256)) AS sha256, trim(retrieved_at) AS s FROM media_records),
  parsed AS (SELECT url, sha256, CASE
      WHEN regexp_matches(s, '^[A-Z][a-z]{2}, ') THEN epoch_us(try_strptime(s, '%a, %d %b %Y %H:%M:%S GMT'))
      WHEN regexp_matches(s, '(Z|[+-]\\d{2}:\\d{2})$') AND length(s) > 12 THEN epoch_us(try_cast(s AS TIMESTAMPTZ))
      ELSE epoch_us(try_cast(s AS TIMESTAMP)) END AS t FROM raw WHERE url <> '' AND sha256 <> ''),
  o AS (SELECT DISTINCT url, sha256, t FROM parsed WHERE t IS NOT NULL),
  s AS (SELECT *, lag(sha256) OVER (PARTITION BY url ORDER BY t, sha256) AS before FROM o)
SELECT url, sha256, t AS valid_from_us, coalesce(lead(t) OVER (PARTITION BY url ORDER BY t, sha256), -1) AS valid_to_us
FROM s WHERE before IS DISTINCT FROM sha256
"""


def queries() -> dict:
    return {"p2_found": p2_found, "p2_changed_fields": p2_changed_fields, "p3_found": p3_found, "p3_ledger": p3_ledger}


def sql() -> dict[str, str]:
    return {"p2_found": P2_SQL, "p2_changed_fields": P2_FIELDS_SQL, "p3_found": P3_SQL, "p3_ledger": P3_LEDGER_SQL}
