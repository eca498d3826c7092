"""Mixing sources to target shares of the total tokens.

Documents are aggregated by membership pattern, the set of target sources they belong
to. A min-cost flow routes token capacity from the patterns to the quotas of the
sources: the k-th use of a pattern is a level of its own whose cost grows with k, so
nothing is repeated while something unused will do. Cost lies on the levels only and
grows with them, so filling level after level by largest flows, each on top of the one
before, is the cheapest: no later path takes back what a cheaper level gave. The flow
sees one node per pattern and level, never a document. Documents are then selected in a
seeded order, by their position in the running sum of tokens of their pattern; the sum is
taken over hash buckets, as many of a pattern as it has of all rows, so only buckets that a boundary cuts are sorted.
"""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kedge import scratch

#: Hash buckets of the seeded order, over all patterns; every pattern has one at least.
BUCKETS = 1 << 13
#: Most rows of targets and most membership patterns the driver handles; more is an error.
MAX_TARGETS, MAX_PATTERNS = 1000, 50_000
#: Most rows of bucket positions that are broadcast.
BROADCAST_BUCKETS = 1 << 17


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    repeats: int


class _Flow:
    """Largest flow by shortest paths in layers, on integer capacities."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[int] = []

    def edge(self, a: int, b: int, cap: int) -> int:
        for x, y, c in ((a, b, cap), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> int:
        total = 0
        while True:
            depth, queue = {source: 0}, deque([source])
            while queue:
                x = queue.popleft()
                for e in self.out[x]:
                    if self.cap[e] and self.to[e] not in depth:
                        depth[self.to[e]] = depth[x] + 1
                        queue.append(self.to[e])
            if sink not in depth:
                return total
            at = dict.fromkeys(depth, 0)
            path: list[int] = []
            x = source
            while True:
                if x == sink:
                    push = min(self.cap[e] for e in path)
                    for e in path:
                        self.cap[e] -= push
                        self.cap[e ^ 1] += push
                    total += push
                    full = next(i for i, e in enumerate(path) if not self.cap[e])
                    x = self.to[path[full] ^ 1]
                    del path[full:]
                    continue
                edges = self.out[x]
                while at[x] < len(edges) and not (self.cap[edges[at[x]]] and depth.get(self.to[edges[at[x]]], -1) == depth[x] + 1):
                    at[x] += 1
                if at[x] < len(edges):
                    path.append(edges[at[x]])
                    x = self.to[edges[at[x]]]
                elif path:
                    x = self.to[path.pop() ^ 1]
                    at[x] += 1
                else:
                    break


def route(capacity: dict[tuple[str, ...], int], targets: list[Target], quota: dict[str, int]) -> dict[tuple[tuple[str, ...], int, str], int]:
    """Tokens of (pattern, level, source); level k is the k-th use of a document."""
    patterns = [p for p in sorted(capacity) if capacity[p] > 0]
    by = {t.source: t for t in targets}
    most = {p: max(by[s].repeats for s in p) for p in patterns}
    place = {t.source: i + 1 for i, t in enumerate(targets)}
    sink = len(targets) + 1
    flow = _Flow(sink + 1)
    for t in targets:
        flow.edge(place[t.source], sink, quota[t.source])
    used: dict[tuple[tuple[str, ...], int, str], int] = {}
    left = sum(quota.values())
    for k in range(1, max(most.values(), default=0) + 1):
        if left <= 0:
            break
        for p in patterns:
            if k > most[p]:
                continue
            flow.out.append([])
            node = len(flow.out) - 1
            flow.edge(0, node, capacity[p])
            for s in p:
                if k <= by[s].repeats:
                    used[p, k, s] = flow.edge(node, place[s], capacity[p])
        left -= flow.run(0, sink)
    return {x: flow.cap[e ^ 1] for x, e in used.items() if flow.cap[e ^ 1]}


def largest_total(capacity: dict[tuple[str, ...], int], targets: list[Target]) -> int:
    """Most tokens of which every source that has any document can have its share."""
    live = [t for t in targets if t.share > 0 and t.repeats > 0 and any(t.source in p and n > 0 for p, n in capacity.items())]
    if not live:
        return 0
    most = max(t.repeats for t in live)
    lo, hi = 0, int(sum(capacity.values()) * most / sum(t.share for t in live)) + 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        quota = {t.source: int(mid * t.share) if t in live else 0 for t in targets}
        met = sum(route(capacity, targets, quota).values()) >= sum(quota.values())
        lo, hi = (mid, hi) if met else (lo, mid - 1)
    return lo


def mix(docs: DataFrame, targets: DataFrame, *, id: str, sources: str, tokens: str, total: int | str = "shares", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(uses, shares) of a mixture of ``docs``.

    ``docs`` has ``id``, ``sources`` (array of the sources a document belongs to) and
    ``tokens``; ``targets`` has source, target_share, max_repeats. ``total`` is the
    number of tokens wanted: ``"shares"``, the most with which every source that has
    documents gets its share; ``"once"``, as many as all documents have once; or a
    number. Where a quota can't be met, what there is is used and the shares say so.

    ``uses``: id, source, uses (from 1 to the source's max_repeats), tokens of one use.
    ``shares``: source, target_share, max_repeats, quota, tokens, actual_share,
    documents, most_uses: one row per target.

    Documents without tokens or outside all targets, null sources and null ids are not
    used. A boundary takes the document it falls into if more than half lies before it.
    Repeated targets are an error, and so are more targets or membership patterns than
    ``MAX_TARGETS`` and ``MAX_PATTERNS``; shares needn't sum to 1. Empty tables give
    empty uses.
    """
    spark = docs.sparkSession
    rows = targets.where("source is not null").select("source", "target_share", "max_repeats").limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS or len({r.source for r in rows}) < len(rows):
        raise ValueError("targets must be distinct and at most MAX_TARGETS")
    wanted = sorted((Target(r.source, float(r.target_share or 0), int(r.max_repeats or 0)) for r in rows), key=lambda t: t.source)
    names = F.array(*[F.lit(t.source) for t in wanted if t.repeats > 0]).cast("array<string>")
    base = docs.select(F.col(id).alias("id"), F.array_sort(F.array_distinct(F.array_intersect(F.col(sources), names))).alias("pattern"), F.col(tokens).cast("bigint").alias("tokens"))
    base = base.where("id is not null and size(pattern) > 0 and tokens > 0").withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit(seed)))
    base = scratch.table(base, "sizes")
    kinds = base.groupBy("pattern").agg(F.count("*").alias("rows")).limit(MAX_PATTERNS + 1).collect()
    if len(kinds) > MAX_PATTERNS:
        raise ValueError("more membership patterns than MAX_PATTERNS")
    every = sum(r["rows"] for r in kinds)
    cut_into = spark.createDataFrame([(r["pattern"], max(1, round(BUCKETS * r["rows"] / every))) for r in kinds], "pattern array<string>, buckets int")
    base = base.join(F.broadcast(cut_into), "pattern").withColumn("bucket", F.pmod("h", F.col("buckets")).cast("int")).drop("buckets")  # at most MAX_PATTERNS rows
    sums = base.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("n")).toPandas()
    sums["pattern"] = sums["pattern"].map(tuple)
    sums = sums.sort_values(["pattern", "bucket"])
    sums["end"] = sums.groupby("pattern")["n"].cumsum() if len(sums) else 0
    capacity = {p: int(n) for p, n in sums.groupby("pattern")["n"].sum().items()}
    if total == "shares":
        size = largest_total(capacity, wanted)
    else:
        size = sum(capacity.values()) if total == "once" else int(total)
    quota = {t.source: int(size * t.share) for t in wanted}
    routed = route(capacity, wanted, quota)

    # stretches of each pattern's order: (level, source, from, to)
    spans: dict[tuple[str, ...], list[tuple[int, str, int, int]]] = defaultdict(list)
    at: dict[tuple, int] = defaultdict(int)
    for (p, k, s), n in sorted(routed.items()):
        spans[p].append((k, s, at[p, k], at[p, k] + n))
        at[p, k] += n
    cuts = {p: sorted({x for _, _, lo, hi in v for x in (lo, hi)}) for p, v in spans.items()}
    placed = []
    for r in sums.itertuples(index=False):
        start = int(r.end) - int(r.n)
        placed.append((list(r.pattern), int(r.bucket), start, any(start < x < r.end for x in cuts.get(r.pattern, ())), int(r.end)))
    where = spark.createDataFrame(placed, "pattern array<string>, bucket int, start bigint, cut boolean, stop bigint")
    bounds = spark.createDataFrame([(list(p), v) for p, v in spans.items()], "pattern array<string>, spans array<struct<level:int,source:string,lo:bigint,hi:bigint>>")
    if len(placed) <= BROADCAST_BUCKETS:
        where = F.broadcast(where)
    at_bucket = base.join(where, ["pattern", "bucket"])
    within = Window.partitionBy("pattern", "bucket").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = at_bucket.where("cut").withColumn("mid", F.col("start") + F.sum("tokens").over(within) - F.col("tokens") / 2)
    whole = at_bucket.where("not cut").withColumn("mid", (F.col("start") + F.col("stop")) / 2)
    spot = cut.unionByName(whole).join(F.broadcast(bounds), "pattern")
    mine = F.filter("spans", lambda x: (x["lo"] <= F.col("mid")) & (F.col("mid") < x["hi"]))
    used = spot.select("id", "tokens", mine.alias("mine")).where("size(mine) > 0")
    used = used.withColumn("source", F.explode(F.array_distinct(F.transform("mine", lambda x: x["source"]))))
    uses = used.select(F.col("id").alias(id), "source", F.size(F.filter("mine", lambda x: x["source"] == F.col("source"))).alias("uses"), "tokens")

    got = uses.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens")).alias("tokens"), F.count("*").alias("documents"), F.max("uses").alias("most_uses"))
    plan = pd.DataFrame([(t.source, t.share, t.repeats, quota[t.source]) for t in wanted], columns=["source", "target_share", "max_repeats", "quota"])
    goal = spark.createDataFrame(plan.values.tolist(), "source string, target_share double, max_repeats int, quota bigint")
    shares = goal.join(got, "source", "left")
    shares = shares.select("source", "target_share", "max_repeats", "quota", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "most_uses")])
    every = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # at most MAX_TARGETS rows
    shares = shares.withColumn("actual_share", F.when(every > 0, F.col("tokens") / every).otherwise(F.lit(0.0)))
    return uses, shares
