"""Runs of equal values along an order (gaps and islands), safe for hot keys.

A window partitioned by the key would sort the whole of a hot key in one task.
Here the rows are range-partitioned by (key, order), so a hot key is spread over
as many pieces as it needs; runs are found inside each piece, and only one row
per piece is compared across pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kedge import scratch


def value_runs(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """One row per longest run of one value: keys, value, ``run_start``, ``run_end``.

    ``run_start`` is the first ``order[0]`` of the run, ``run_end`` the
    ``run_start`` of the next run of the key, null for the last. Rows with a null
    key or null ``order[0]`` are left out; null values form runs of their own.
    ``order`` must be total up to rows that are equal in value.
    """
    n = scratch.pieces(df)
    cols = [*keys, *order, value]
    rows = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    k = [f"c{i}" for i in range(len(keys))]
    o = [f"c{i}" for i in range(len(keys), len(keys) + len(order))]
    v, t = f"c{len(cols) - 1}", o[0]
    for c in [*k, t]:
        rows = rows.where(F.col(c).isNotNull())
    at = rows.repartitionByRange(n, *k, *o).withColumn("piece", F.spark_partition_id())
    w = Window.partitionBy("piece", *k).orderBy(*o, v)
    at = at.withColumn("nth", F.row_number().over(w)).withColumn("before", F.lag(v).over(w))
    inner = at.withColumn("last_v", F.last(v).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    starts = inner.where((F.col("nth") == 1) | ~F.col(v).eqNullSafe(F.col("before")))
    starts = starts.withColumn("next_t", F.lead(t).over(w))

    heads = starts.where("nth = 1").select("piece", *k, F.col(v).alias("first_v"), "last_v", F.col(t).alias("first_t"), F.col("next_t").alias("second_t"))
    across = Window.partitionBy(*k).orderBy("piece")
    heads = heads.withColumn("prior_v", F.lag("last_v").over(across)).withColumn("prior", F.lag("piece").over(across))
    heads = heads.withColumn("opens", F.col("prior").isNull() | ~F.col("first_v").eqNullSafe(F.col("prior_v")))
    heads = heads.withColumn("first_start", F.when(F.col("opens"), F.col("first_t")).otherwise(F.col("second_t")))
    heads = heads.withColumn("following", F.first("first_start", ignorenulls=True).over(across.rowsBetween(1, Window.unboundedFollowing)))
    joined = starts.join(heads.select("piece", *k, "opens", "following"), ["piece", *k])
    joined = joined.where((F.col("nth") > 1) | F.col("opens"))
    return joined.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keys)], F.col(v).alias(value),
        F.col(t).alias("run_start"), F.coalesce("next_t", "following").alias("run_end"),
    )
