"""Changes between consecutive full snapshots, by signed cells.

Every row of a snapshot is unpivoted into cells (key, field, value) with sign +1
where the snapshot is the later one of a pair and -1 where it is the earlier one,
plus one presence marker per distinct row. Cells that occur on both sides cancel
in a grouped sum; what is left says which fields changed, and the presence
markers say whether a key is new, gone or ambiguous.

Both groupings combine on the map side, so a key that holds a third of all rows
reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedge import scratch

#: Pairs of snapshots, and changed keys, that may be broadcast; beyond it the plan joins by shuffle.
BROADCAST_PAIRS, BROADCAST_CHANGED = 100_000, 10_000


def snapshot_pairs(manifest: DataFrame, *, snapshot: str = "snapshot_id", previous: str = "previous_snapshot", complete: str | None = "complete") -> DataFrame:
    """(later, earlier) for each complete snapshot whose predecessor is in the manifest.

    Repeated manifest rows count once. A null or unknown predecessor gives no pair,
    and so does a snapshot whose ``complete`` is false or null. The predecessor
    itself may be incomplete. A snapshot that names itself gives no pair.
    """
    known = manifest.select(F.col(snapshot).alias("earlier")).where("earlier is not null").distinct()
    later = manifest if complete is None else manifest.where(F.col(complete))
    later = later.select(F.col(snapshot).alias("later"), F.col(previous).alias("earlier")).where("later is not null and later <> earlier").distinct()
    return later.join(known, "earlier", "left_semi").select("later", "earlier")


def _cell(c: Column) -> Column:
    """128-bit digest of a value; null stays null, which is a value of its own."""
    return F.unhex(F.md5(c))


def snapshot_delta(rows: DataFrame, pairs: DataFrame, *, snapshot: str, key: str, fields: Sequence[str], keep_unchanged: bool = False) -> DataFrame:
    """Added, removed, changed and ambiguous keys of each (later, earlier) pair.

    Returns ``snapshot_id`` (the later one), ``key``, ``change_kind`` and
    ``changed_fields`` (sorted; empty but for ``changed``). Rows with a null key or
    snapshot are left out; rows equal in all ``fields`` count once; a null value is
    a value of its own; a key with more than one distinct row on either side is
    ``ambiguous``. Other columns of ``rows``, whatever their names, are not read.
    Empty tables give an empty result.
    """
    kinds = dict(rows.dtypes)
    text = {f: F.col(f).cast("string") if kinds.get(f, "x") in _SCALARS else F.to_json(F.struct(F.col(f).alias("v"))) for f in fields}
    keyed = rows.select(F.col(snapshot).alias("_s"), F.col(key).alias("_k"), *[_cell(text[f]).alias(f"f{i}") for i, f in enumerate(fields)]).where("_s is not null and _k is not null")
    cells = [F.coalesce(F.hex(f"f{i}"), F.lit("-")) for i in range(len(fields))]
    whole = _cell(F.concat_ws(",", *cells)) if len(fields) > 1 else F.col("f0")
    roles = pairs.select("later", F.explode(F.array(F.struct(F.col("later").alias("_s"), F.lit(1).alias("_sign")), F.struct(F.col("earlier").alias("_s"), F.lit(-1).alias("_sign")))).alias("r")).select("later", "r.*")
    if pairs.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        roles = F.broadcast(roles)
    sides = [F.sum(F.when(F.col("_sign") > 0, 1).otherwise(0)).alias("after"), F.sum(F.when(F.col("_sign") < 0, 1).otherwise(0)).alias("before")]
    markers = keyed.select("_s", "_k", whole.alias("row")).distinct().join(roles, "_s").groupBy("later", "_k", "row").agg(*sides)
    keys = markers.groupBy("later", "_k").agg(F.sum("after").alias("after"), F.sum("before").alias("before"), F.max(F.col("after") != F.col("before")).alias("differs"))
    kind = (
        F.when((F.col("after") > 1) | (F.col("before") > 1), "ambiguous")
        .when(F.col("before") == 0, "added")
        .when(F.col("after") == 0, "removed")
        .when(F.col("differs"), "changed")
        .otherwise("unchanged")
    )
    out = keys.select("later", "_k", kind.alias("change_kind"))
    if not keep_unchanged:
        out = out.where("change_kind <> 'unchanged'")
    none = F.array().cast("array<string>")
    if len(fields) == 1:
        touched = F.when(F.col("change_kind") == "changed", F.array(F.lit(fields[0]))).otherwise(none)
        return out.select(F.col("later").alias("snapshot_id"), F.col("_k").alias("key"), "change_kind", touched.alias("changed_fields"))
    out = scratch.table(out, "kinds")
    changed = out.where("change_kind = 'changed'").select("later", "_k")
    if changed.limit(BROADCAST_CHANGED + 1).count() <= BROADCAST_CHANGED:
        changed = F.broadcast(changed)
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f{i}").alias("value")) for i, f in enumerate(fields)])
    signed = keyed.join(roles, "_s").join(changed, ["later", "_k"], "left_semi").select("later", "_k", "_sign", F.explode(each).alias("c")).select("later", "_k", "_sign", "c.*")
    # these keys have one distinct row a side, which may be repeated
    cell = signed.groupBy("later", "_k", "field", "value").agg(F.max(F.when(F.col("_sign") > 0, 1).otherwise(0)).alias("after"), F.max(F.when(F.col("_sign") < 0, 1).otherwise(0)).alias("before")).where("after <> before")
    touched = cell.groupBy("later", "_k").agg(F.array_sort(F.collect_set("field")).alias("touched"))
    return out.join(touched, ["later", "_k"], "left").select(F.col("later").alias("snapshot_id"), F.col("_k").alias("key"), "change_kind", F.coalesce("touched", none).alias("changed_fields"))


_SCALARS = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz"}
