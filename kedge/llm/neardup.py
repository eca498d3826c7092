"""Near-duplicate records by MinHash banding, verified on full sets.

Every record becomes a set of hashed word n-grams. Equal sets are one class from the
start, so exact copies cost one row however many there are. Each class is hashed into
bands of ``ROWS`` minima; the number of bands follows from the recall wanted at the
threshold. Classes that share a band hash are candidates; they carry a 128-bit sketch
(one bit of further minima each) through the shuffle, so pairs that can't reach the
threshold are dropped inside the join and never become rows. What is left is verified
on the full sets. No bucket is capped and nothing is collected to the driver; a bucket
with very many classes, and a class with very many copies, is met in cells (``split``).
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kedge import scratch
from kedge.llm import split
from kedge.llm.canonical import canonical

#: Minima per band. More make chance candidates rarer, and more bands necessary.
ROWS = 5
#: Share of pairs exactly at the threshold that some band must catch.
RECALL = 0.985
#: Sketch bits; a pair is dropped if its agreement is this many standard deviations below the threshold's.
BITS, SIGMAS = 128, 3.4

#: Rows of bands a task of their join has on either side.
BAND_ROWS = 250_000

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits in canonical form, lower case, ё as е."""
    return _WORD.findall(canonical(text).lower().replace("ё", "е"))


def bands(threshold: float, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands needed to catch ``recall`` of the pairs whose similarity is ``threshold``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def agreement(threshold: float) -> int:
    """Sketch bits that must agree for a pair to be verified."""
    p = (1 + threshold) / 2
    return math.floor(BITS * p - SIGMAS * math.sqrt(BITS * p * (1 - p)))


def record_sets(df: DataFrame, *, id: str, text: str, n: int = 1, tokens: Callable[[str], list[str]] = words) -> DataFrame:
    """``id, digest, grams``: distinct hashed ``n``-grams of words of each record, sorted, and their 128-bit digest.

    A text shorter than ``n`` words is one gram of all its words. Records with a null
    id or without a word are left out: they resemble nothing. Texts of any length are
    read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            if len(known) > 500_000:
                known.clear()
            grams, keys, at = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                found = tokens(t) if t else []
                if not found:
                    continue
                if n > 1:
                    found = [" ".join(found[j : j + n]) for j in range(max(1, len(found) - n + 1))]
                mine = set()
                for w in found:
                    h = known.get(w)
                    if h is None:
                        h = known[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) - (1 << 31)
                    mine.add(h)
                row = np.array(sorted(mine), dtype=np.int32)
                grams.append(row)
                keys.append(xxhash.xxh3_128_digest(row.tobytes()))
                at.append(i)
            offsets = np.cumsum([0, *map(len, grams)], dtype=np.int32)
            flat = np.concatenate(grams) if grams else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "digest", "grams"])

    schema = T.StructType([T.StructField("id", df.schema[id].dataType), T.StructField("digest", T.BinaryType()), T.StructField("grams", T.ArrayType(T.IntegerType()))])
    return df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where("id is not null and text is not null").mapInArrow(run, schema)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(flat: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """(sets, n) minima of ``n`` hash functions over each set of uint32 grams."""
    flip, odd = _seeds(n)
    out = np.empty((len(starts), n), dtype=np.uint32)
    ends = np.append(starts[1:], len(flat))
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 4096, "right")))
        block = flat[starts[lo] : ends[hi - 1]]
        step = max(1, 2_000_000 // max(1, len(block)))
        for c in range(0, n, step):
            hashed = (block[:, None] ^ flip[None, c : c + step]) * odd[None, c : c + step]
            hashed ^= hashed >> np.uint32(15)
            out[lo:hi, c : c + step] = np.minimum.reduceat(hashed, starts[lo:hi] - starts[lo], axis=0)
        lo = hi
    return out


def _signatures(count: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            flat = lists.flatten().to_numpy().astype(np.int64).astype(np.uint32)
            starts = lists.offsets.to_numpy()[:-1].astype(np.int64) - lists.offsets[0].as_py()
            m = minima(flat, starts, count * rows + BITS)
            acc = np.zeros((len(starts), count), dtype=np.uint64) + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for r in range(rows):
                acc = (acc ^ m[:, r : count * rows : rows].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
                acc ^= acc >> np.uint64(32)
            bits = ((m[:, count * rows :] >> np.uint32(9)) & np.uint32(1)).astype(np.uint8)
            sketch = np.packbits(bits, axis=1).view(np.int64)
            ends = np.arange(0, (len(starts) + 1) * count, count, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy()), pa.ListArray.from_arrays(pa.array(ends), pa.array(acc.view(np.int64).ravel()))], names=["key", "s1", "s2", "bands"])

    return run


def class_sets(records: DataFrame) -> DataFrame:
    """``key, digest, grams`` of the distinct sets of ``record_sets``, written once to the shared folder, which fixes their numbers."""
    return scratch.table(records.select("digest", "grams").dropDuplicates(["digest"]).withColumn("key", F.monotonically_increasing_id()), "sets")


def class_members(records: DataFrame, sets: DataFrame) -> DataFrame:
    """``id, key`` of every record and its class, each once."""
    return records.select("id", "digest").distinct().join(sets.select("digest", "key"), "digest").select("id", "key")


def similar_classes(sets: DataFrame, *, threshold: float, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """Pairs of different classes ``a < b`` with Jaccard ``similarity`` of at least ``threshold``.

    ``sets`` are distinct (``key``, ``grams``). Each pair comes once. Verification is on
    the full sets, so precision is exact; recall at the threshold is ``recall`` and
    rises steeply above it.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    count = bands(threshold, recall, rows)
    signed = scratch.table(sets.select("key", "grams").mapInArrow(_signatures(count, rows), "key bigint, s1 bigint, s2 bigint, bands array<bigint>"), "signed")
    spread = signed.count() * count
    tasks = max(1, min(scratch.partitions(sets), spread // 20_000), spread // BAND_ROWS)
    a, b, meet = split.self_join(signed.select("key", "s1", "s2", F.explode("bands").alias("band")), key="band", by="key", tasks=tasks)
    differ = BITS - agreement(threshold)
    near = F.bit_count(F.col("a.s1").bitwiseXOR(F.col("b.s1"))) + F.bit_count(F.col("a.s2").bitwiseXOR(F.col("b.s2"))) <= differ
    found = a.join(b, meet & (F.col("a.key") < F.col("b.key")) & near).select(F.col("a.key").alias("a"), F.col("b.key").alias("b")).distinct()
    left = sets.select(F.col("key").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("key").alias("b"), F.col("grams").alias("gb"))
    full = found.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ga", "gb"))
    similarity = common / (F.size("ga") + F.size("gb") - common)
    return full.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def components(links: DataFrame, *, nodes: DataFrame) -> DataFrame:
    """``key, root``: smallest key of the connected component of each key of ``nodes``.

    Alternates large-star and small-star steps until no link changes; every step is a
    pair of shuffles, each round a table in the shared folder. A star's centre with a
    third of all links is aggregated on the map side first and its links are emitted
    from its join partners, so no task holds a group.
    """
    edges = scratch.table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = scratch.table(small, "edges")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        scratch.release(edges)
        edges = new
    roots = new.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("root"))
    return nodes.select("key").join(roots, "key", "left").select("key", F.coalesce("root", "key").alias("root"))


def near_duplicate_pairs(df: DataFrame, *, id: str, text: str, threshold: float = 0.8, n: int = 5, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """All pairs of different ids, ``id_a < id_b``, whose sets reach ``threshold``: the expanded form.

    The result is as large as the copies make it. ``near_duplicate_groups`` gives the
    same links without expanding copies. A repeated id counts once.
    """
    records = scratch.table(record_sets(df, id=id, text=text, n=n), "records")
    sets = class_sets(records)
    members = scratch.table(class_members(records, sets), "members")
    links = scratch.table(similar_classes(sets, threshold=threshold, recall=recall, rows=rows).select("a", "b"), "links")
    # either side's copies may be very many
    first = split.join(links.withColumnRenamed("a", "key"), members.select("key", F.col("id").alias("x")), key="key", by=("b", "x")).select(F.col("b").alias("key"), "x")
    first = scratch.table(first, "first")
    across = split.join(first, members.select("key", F.col("id").alias("y")), key="key", by=("x", "y")).where("x <> y")
    across = across.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    copied = members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("key")
    a, b, meet = split.self_join(members.join(copied, "key", "left_semi"), key="key", by="id")
    within = a.join(b, meet & (F.col("a.id") < F.col("b.id"))).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))
    return across.unionByName(within).distinct()


def near_duplicate_groups(df: DataFrame, *, id: str, text: str, threshold: float = 0.8, n: int = 5, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row per id: ``group_id`` (smallest id linked to it, over any steps), ``copies`` of
    its own set, itself included, and ``links`` to other sets.

    Ids without a word form groups of their own.
    """
    records = scratch.table(record_sets(df, id=id, text=text, n=n), "records")
    sets = class_sets(records)
    members = scratch.table(class_members(records, sets), "members")
    links = scratch.table(similar_classes(sets, threshold=threshold, recall=recall, rows=rows).select("a", "b"), "links")
    roots = components(links, nodes=sets)
    counted = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("links"))
    classes = members.groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("first")).join(roots, "key").join(counted, "key", "left")
    names = classes.groupBy("root").agg(F.min("first").alias("group_id"))
    classes = classes.join(names, "root").select("key", "group_id", "copies", F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
    ids = df.select(F.col(id).alias("id")).where("id is not null").distinct()
    own = members.join(classes, "key").groupBy("id").agg(F.min("group_id").alias("group_id"), F.max("copies").alias("copies"), F.sum("links").alias("links"))
    return ids.join(own, "id", "left").select(F.col("id").alias(id), F.coalesce("group_id", "id").alias("group_id"), F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"), F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
