"""Bitemporal history of an attribute, from observations that arrive in any order.

Each observation says: from ``valid`` on, ``key`` had ``value``, as we learned at
``recorded``. The ledger keeps, for every observation, the valid interval it was
believed to cover and the recorded period of that belief. A late observation splits
the interval it falls into: the older row is closed in recorded time and replaced,
never overwritten.

The sweep visits observations from the last recorded to the first, unlinking each
from the list of its key ordered by valid time; its neighbours at that moment are
those it had when it arrived, which gives the split it caused. That is linear after
sorting. Rows are range-partitioned by (key, valid time), so a hot key is cut into
pieces of bounded size; what a piece cannot know, the end of its open right edge, is
settled afterwards from the few steps at which the earliest known observation of the
next pieces changed.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedge import scratch
from kedge.operators.runs import value_runs

_ROW, _EDGE, _STEP = 0, 1, 2
_OUT = "key string, value string, valid_from bigint, valid_to bigint, recorded_from bigint, recorded_to bigint, kind int, piece int"


def _sweep(t: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ledger rows of one piece: node, end node (len(t): open), recorded from, to (-1: current)."""
    n = len(t)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    order = np.lexsort((np.arange(n), r))[::-1].tolist()
    node, end, cause = [0] * (2 * n), [0] * (2 * n), [0] * (2 * n)
    m = 0
    for i in order:
        p, s = prv[i], nxt[i]
        node[m], end[m], cause[m] = i, s, i
        m += 1
        if p >= 0:
            node[m], end[m], cause[m] = p, i, i
            m += 1
            nxt[p] = s
        if s < n:
            prv[s] = p
    a, b, c = (np.array(x[:m][::-1], dtype=np.int64) for x in (node, end, cause))
    by = np.argsort(a, kind="stable")
    a, b, since = a[by], b[by], r[c[by]]
    until = np.full(m, -1, dtype=np.int64)
    same = a[1:] == a[:-1]
    until[:-1][same] = since[1:][same]
    return a, b, since, until


def _steps(t: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(recorded, earliest valid known from then on), where it changes."""
    by = np.lexsort((t, r))
    low = np.minimum.accumulate(t[by])
    rr = r[by]
    last = np.append(rr[1:] != rr[:-1], True)
    low, rr = low[last], rr[last]
    new = np.append(True, low[1:] < low[:-1])
    return rr[new], low[new]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    piece = TaskContext.get().partitionId()

    def emit(key, parts, first: bool, last: bool):
        value = pa.concat_arrays([p.column(1) for p in parts])
        t = np.concatenate([p.column(2).to_numpy() for p in parts])
        r = np.concatenate([p.column(3).to_numpy() for p in parts])
        a, b, since, until = _sweep(t, r)
        ends = np.append(t, np.iinfo(np.int64).max)[b]
        keep = (since != until) & (ends != t[a])
        a, b, since, until, ends = a[keep], b[keep], since[keep], until[keep], ends[keep]
        kind = np.where((b == len(t)) & last, _EDGE, _ROW)
        cols = [value.take(pa.array(a)), t[a], pa.array(ends, mask=b == len(t)), since, pa.array(until, mask=until < 0), kind]
        if first:
            at, low = _steps(t, r)
            none = pa.nulls(len(at), pa.int64())
            more = [pa.nulls(len(at), pa.string()), low, none, at, none, np.full(len(at), _STEP)]
            cols = [pa.concat_arrays([pa.array(x) if not isinstance(x, pa.Array) else x for x in pair]) for pair in zip(cols, more, strict=True)]
        m = len(cols[0])
        cols[5] = pa.array(cols[5]).cast(pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([key] * m, pa.string()), *[x if isinstance(x, pa.Array) else pa.array(x) for x in cols], pa.array(np.full(m, piece, dtype=np.int32))], names=["key", "value", "valid_from", "valid_to", "recorded_from", "recorded_to", "kind", "piece"])

    key, parts, first = None, [], True
    for batch in batches:
        keys = batch.column(0)
        n = len(keys)
        if not n:
            continue
        codes = keys.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), n]
        for lo, hi in zip(cuts, cuts[1:]):
            this = keys[lo].as_py()
            if parts and this != key:
                yield emit(key, parts, first, False)
                parts, first = [], False
            key = this
            parts.append(batch.slice(lo, hi - lo))
    if parts:
        yield emit(key, parts, first, True)


def _stitch(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ends of the open right edges of one key's pieces."""
    steps = {p: g.sort_values("recorded_from") for p, g in pdf[pdf.kind == _STEP].groupby("piece")}
    edges = pdf[pdf.kind == _EDGE]
    frontier: list[tuple[int, int]] = []
    rows = []
    for piece in sorted({*edges.piece, *steps}, reverse=True):
        own = edges[edges.piece == piece]
        marks = [x for x, _ in frontier]
        for e in own.itertuples(index=False):
            lo, hi = int(e.recorded_from), None if pd.isna(e.recorded_to) else int(e.recorded_to)
            i = bisect_right(marks, lo) - 1
            at = lo
            while True:
                until = marks[i + 1] if i + 1 < len(marks) else None
                stop = until if hi is None or (until is not None and until < hi) else hi
                end = frontier[i][1] if i >= 0 else None
                if stop != at and end != e.valid_from:
                    rows.append((e.key, e.value, e.valid_from, end, at, stop, _ROW, piece))
                if stop is None or stop == hi:
                    break
                at, i = stop, i + 1
        if piece in steps:
            g = list(zip(steps[piece].recorded_from.astype("int64"), steps[piece].valid_from.astype("int64"), strict=True))
            frontier = [(int(r), int(t)) for r, t in frontier if r < g[0][0]] + [(int(r), int(t)) for r, t in g]
    out = pd.DataFrame(rows, columns=["key", "value", "valid_from", "valid_to", "recorded_from", "recorded_to", "kind", "piece"])
    for c in ("valid_from", "valid_to", "recorded_from", "recorded_to"):
        out[c] = pd.array(out[c].tolist(), dtype="Int64")
    return out.astype({"kind": "int32", "piece": "int32"})


def bitemporal_ledger(df: DataFrame, *, key: str, value: str, valid: str, recorded: str) -> DataFrame:
    """All beliefs about ``value`` of ``key`` over valid and recorded time.

    ``valid`` and ``recorded`` are bigint instants. Returns ``key, value, valid_from,
    valid_to, recorded_from, recorded_to``: intervals closed on the left and open on
    the right, null where open-ended. Rows without key, value or valid time are no
    observation; an observation repeated counts once, as first recorded; without a
    recorded time it counts as recorded at its valid time. Of two values observed
    for the same instant the one recorded later holds (ties: the larger value).
    Adjacent intervals may carry the same value: each is an assertion of its own.
    """
    obs = (
        df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"), F.col(valid).cast("bigint").alias("t"), F.coalesce(F.col(recorded).cast("bigint"), F.col(valid).cast("bigint")).alias("r"))
        .where("key is not null and value is not null and t is not null")
        .groupBy("key", "value", "t").agg(F.min("r").alias("r"))
        .select("key", "value", "t", "r")
    )
    n = scratch.pieces(df)
    swept = obs.repartitionByRange(n, "key", "t", "r", "value").sortWithinPartitions("key", "t", "r", "value").mapInArrow(_pieces, _OUT)
    swept = scratch.table(swept, "ledger")
    edges = swept.where(F.col("kind") != _ROW).groupBy("key").applyInPandas(_stitch, _OUT)
    return swept.where(F.col("kind") == _ROW).unionByName(edges).drop("kind", "piece")


def current_versions(ledger: DataFrame) -> DataFrame:
    """Versions as believed now: ``key, value, valid_from, valid_to``, runs of one value joined."""
    now = ledger.where("recorded_to is null").select("key", "value", "valid_from")
    runs = value_runs(now, keys=["key"], order=["valid_from"], value="value")
    return runs.select("key", "value", F.col("run_start").alias("valid_from"), F.col("run_end").alias("valid_to"))


def as_of(ledger: DataFrame, *, valid_at: int | None = None, recorded_at: int | None = None) -> DataFrame:
    """Ledger rows that hold at an instant of valid time, as believed at an instant of recorded time.

    Null ``recorded_at``: as believed now. Null ``valid_at``: all valid times.
    """
    out = ledger
    if recorded_at is None:
        out = out.where("recorded_to is null")
    else:
        out = out.where((F.col("recorded_from") <= recorded_at) & (F.col("recorded_to").isNull() | (F.col("recorded_to") > recorded_at)))
    if valid_at is not None:
        out = out.where((F.col("valid_from") <= valid_at) & (F.col("valid_to").isNull() | (F.col("valid_to") > valid_at)))
    return out
