"""Joins on keys of which one may hold a third of all rows.

A key with more rows than a task should meet at once is cut into parts by a hash of the
row. Joined with itself, every row goes to the cells of its part with each part, one
triangle of cells; joined with another table, either side's parts meet all of the
other's. So a cell holds a bounded number of rows, every pair still meets, and no row of
a key that is not hot is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that meet in a task without being split.
MOST = 2_000
#: Keys are first counted by this many hash buckets; only keys of full buckets are counted one by one.
COARSE = 1 << 18
#: Hot keys that are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 200_000


def hot_keys(rows: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """``key, parts`` of every key with more than ``most`` rows.

    Both counts combine on the map side. The first has at most ``COARSE`` rows, and a key
    that is hot fills its bucket, so none is missed.
    """
    most = most or MOST
    bucket = F.pmod(F.xxhash64(key), F.lit(COARSE))
    full = rows.groupBy(bucket.alias("_b")).agg(F.count("*").alias("n")).where(F.col("n") > most).select("_b")
    some = rows.select(key, bucket.alias("_b")).join(F.broadcast(full), "_b", "left_semi")  # at most COARSE rows
    return some.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(key, F.ceil(F.col("n") / most).cast("int").alias("parts"))


def _with_parts(rows: DataFrame, hot: DataFrame, key: str, few: bool) -> DataFrame:
    return rows.join(F.broadcast(hot) if few else hot, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def few(hot: DataFrame) -> bool:
    """Whether so few keys are hot that they can be broadcast."""
    return hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS


def self_join(rows: DataFrame, *, key: str, by: str, most: int | None = None, tasks: int | None = None) -> tuple[DataFrame, DataFrame, Column]:
    """(a, b, condition): two aliased sides and the condition under which all pairs of rows of one key meet once in each order.

    ``tasks`` spreads the join over so many, whatever the session's setting.
    """
    hot = hot_keys(rows, key, most)
    if hot.isEmpty():
        rows = rows.repartition(tasks, key) if tasks else rows
        a, b = rows.alias("a"), rows.alias("b")
        return a, b, F.col(f"a.{key}") == F.col(f"b.{key}")
    some = _with_parts(rows, hot, key, few(hot)).withColumn("part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int"))
    each = some.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    each = each.withColumn("cell", F.least("part", "_o") * F.col("parts") + F.greatest("part", "_o")).withColumn("own", F.col("part") == F.col("_o")).drop("_o", "parts")
    each = each.repartition(tasks, key, "cell") if tasks else each
    a, b = each.alias("a"), each.alias("b")
    return a, b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.cell") == F.col("b.cell")) & ((F.col("a.part") != F.col("b.part")) | F.col("a.own"))


def join(left: DataFrame, right: DataFrame, *, key: str, by: tuple[str, str], most: int | None = None, condition: Column | None = None) -> DataFrame:
    """Inner join of all rows of two tables with the same ``key``; other columns must not share names.

    A key hot on either side is cut into parts of both sides, made from the columns ``by``.
    """
    hot_l, hot_r = hot_keys(left, key, most), hot_keys(right, key, most)
    if hot_l.isEmpty() and hot_r.isEmpty():
        r = right.withColumnRenamed(key, "_k")
        on = F.col(key) == F.col("_k")
        return left.join(r, on if condition is None else on & condition).drop("_k")
    hot = hot_l.withColumnRenamed("parts", "lp").join(hot_r.withColumnRenamed("parts", "rp"), key, "full_outer").select(key, F.coalesce("lp", F.lit(1)).alias("lp"), F.coalesce("rp", F.lit(1)).alias("rp"))
    held = F.broadcast(hot) if few(hot) else hot

    def spread(side: DataFrame, own: str, other: str, by: str) -> DataFrame:
        some = side.join(held, key, "left").withColumns({"lp": F.coalesce("lp", F.lit(1)), "rp": F.coalesce("rp", F.lit(1))})
        mine = F.pmod(F.xxhash64(by), F.col(own)).cast("int").alias(f"_{own}")
        return some.select(*side.columns, mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"_{other}"))

    l = spread(left, "lp", "rp", by[0])
    r = spread(right, "rp", "lp", by[1])
    r = r.select(*[F.col(c).alias("_k" if c == key else c) for c in right.columns], F.col("_lp").alias("_lp2"), F.col("_rp").alias("_rp2"))
    on = (F.col(key) == F.col("_k")) & (F.col("_lp") == F.col("_lp2")) & (F.col("_rp") == F.col("_rp2"))
    return l.join(r, on if condition is None else on & condition).drop("_k", "_lp", "_rp", "_lp2", "_rp2")
