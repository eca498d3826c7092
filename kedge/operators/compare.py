"""Comparison of two record sets or two maps by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_diff(previous: DataFrame, current: DataFrame, *, key: str, fields: Sequence[str], position: str | None = None) -> DataFrame:
    """``key, status, changed, moved, before, after`` of every key of either side.

    ``status`` is added, removed, ambiguous (more than one row on a side: those rows are
    never paired, and count as removed and added), changed or same; ``changed`` lists the
    differing fields in the order given; ``moved`` (position differs) is independent of
    it; ``before`` and ``after`` are row counts. Null keys are left out, null values equal
    each other.
    """
    def side(df: DataFrame, n: str, tag: str) -> DataFrame:
        held = [F.first(F.col(f)).alias(f"{tag}{i}") for i, f in enumerate(fields)]
        if position:
            held.append(F.first(F.col(position)).alias(f"{tag}p"))
        return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias(n), *held)

    j = side(previous, "before", "a").join(side(current, "after", "b"), "key", "full_outer").fillna(0, ["before", "after"])
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a{i}").eqNullSafe(F.col(f"b{i}")), F.lit(f)) for i, f in enumerate(fields)]))
    paired = (F.col("before") == 1) & (F.col("after") == 1)
    status = F.when((F.col("before") > 1) | (F.col("after") > 1), "ambiguous").when(F.col("before") == 0, "added").when(F.col("after") == 0, "removed").when(F.size(changed) > 0, "changed").otherwise("same")
    moved = paired & ~F.col("ap").eqNullSafe(F.col("bp")) if position else F.lit(False)
    return j.select("key", status.alias("status"), F.when(paired, changed).otherwise(F.array().cast("array<string>")).alias("changed"), moved.alias("moved"), "before", "after")


def diff_totals(diff: DataFrame) -> DataFrame:
    """One row of totals of ``record_diff``; unchanged is neither changed nor moved."""
    amb = F.col("status") == "ambiguous"
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return diff.agg(
        total("before").alias("previous"), total("after").alias("current"), total(F.col("after") - F.col("before")).alias("delta"),
        total(F.when((F.col("status") == "added") | amb, F.col("after"))).alias("added"), total(F.when((F.col("status") == "removed") | amb, F.col("before"))).alias("removed"),
        F.count_if(F.col("status") == "changed").alias("changed"), F.count_if("moved").alias("moved"), F.count_if(amb).alias("ambiguous_keys"),
        F.count_if((F.col("status") == "same") & ~F.col("moved")).alias("unchanged"),
    )


def map_diff(old: DataFrame, new: DataFrame, *, key: str, value: str) -> DataFrame:
    """``key, status`` (added, removed, changed, same) of two maps; of a repeated key the largest value counts."""
    side = lambda df, n: df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(value).alias(n), F.lit(True).alias(f"in_{n}"))
    j = side(old, "a").join(side(new, "b"), "key", "full_outer")
    status = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~F.col("a").eqNullSafe(F.col("b")), "changed").otherwise("same")
    return j.select("key", status.alias("status"))


def set_relation(left: DataFrame, right: DataFrame, *, key: str, universe: DataFrame | None = None) -> DataFrame:
    """``key, relation`` (both, only_left, only_right, neither) of two usable sets."""
    l, r = (df.select(F.col(key).alias("key"), F.lit(True).alias(n)).where("key is not null").distinct() for df, n in ((left, "l"), (right, "r")))
    j = l.join(r, "key", "full_outer")
    if universe is not None:
        j = universe.select(F.col(key).alias("key")).where("key is not null").distinct().join(j, "key", "full_outer")
    relation = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), "both").when(F.col("l").isNotNull(), "only_left").when(F.col("r").isNotNull(), "only_right").otherwise("neither")
    return j.select("key", relation.alias("relation"))


def all_resources(df: DataFrame, *, id: str) -> DataFrame:
    """``id, nth, url``: resources of the question, then of each answer, in order."""
    held = F.concat(F.coalesce("resources", F.array()), F.flatten(F.transform("answers", lambda a: F.coalesce(a["resources"], F.array()))))
    return df.select(F.col(id).alias(id), F.posexplode(F.transform(held, lambda r: r["url"])).alias("nth", "url"))


def enrich_resources(uses: DataFrame, media: DataFrame, *, url: str = "url", at: str | None = None, required: bool = False) -> DataFrame:
    """``uses`` with sha256, bytes and content_type of the latest record of their url.

    The latest is the one with the greatest ``at``, of several the greatest record; a use
    stays one row however many records its url has. A use without a record has nulls, or
    fails the job if one is ``required``; the message names no url.
    """
    facts = ["sha256", "bytes", "content_type"]
    last = media.where(F.col(url).isNotNull()).groupBy(F.col(url).alias(url)).agg(F.max_by(F.struct(*facts), F.struct(*([at] if at else []), *facts)).alias("_m"))
    out = uses.join(last, url, "left")
    if required:
        out = out.withColumn("_m", F.when(F.col("_m").isNull(), F.raise_error(F.lit("a resource has no media record"))).otherwise(F.col("_m")))
    return out.select(*uses.columns, *[F.col(f"_m.{c}").alias(c) for c in facts])


def zip_rows(left: DataFrame, right: DataFrame, *, by: Sequence[str], order: str) -> DataFrame:
    """Rows of two tables paired by their rank within ``by``: the columns of both, null where one side is short.

    Columns of ``right`` outside ``by`` get the suffix ``_r``.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(order)
    l = left.withColumn("nth", F.row_number().over(w))
    r = right.withColumn("nth", F.row_number().over(w)).select(*by, "nth", *[F.col(c).alias(f"{c}_r") for c in right.columns if c not in by])
    return l.join(r, [*by, "nth"], "full_outer")


def nonequal_rows(expected: DataFrame, found: DataFrame) -> DataFrame:
    """``side`` and the columns: rows (as a bag) that only one of two tables of one schema has."""
    return expected.exceptAll(found).withColumn("side", F.lit("expected")).unionByName(found.exceptAll(expected).withColumn("side", F.lit("found")))
