"""Matching records of two tables that share no identifier.

Left records are queries, right records the index. Terms are word bigrams of every
attribute (an attribute's terms are its own; one of a single word is that word). A posting of the inverted index holds
the BM25 impact of its term in its record: idf, saturated term frequency, length.

1. Retrieval is exact. A candidate's score, the sum of the impacts of the query's terms,
   must reach ``LEFT_SHARE`` of the score the query has with itself and ``RIGHT_SHARE`` of
   the record's. Every term has a greatest impact (its max-score), so the terms of a query
   in order of frequency, rarest first, have a point beyond which what is left can't
   reach the bound; the rarest shared term lies before it, and so it does in the record's
   own order. Only these prefixes are posted and joined. A query's numbers must all occur in the record,
   so a posting's key also holds two of them (one, none, if the query has no more), and a
   mask of all of them prunes inside the join. Long posting lists are met in cells (``split``).
2. Candidates are scored by their postings. How many are kept of a query is set by its
   best score, not by a number, which repeated questions would fill: all that score at least ``NEAR`` times as much.
3. They must be as near from the other side: at least ``NEAR`` times the best that any
   query has with their record.
4. What is left is checked on the texts (numbers, negation, answers).
5. Confidence is the probability, by a logistic curve over score shares and the gap to the
   best other candidate, that a candidate passes that check; it is fitted to a bounded
   sample of all scored candidates, passed and failed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedge import scratch
from kedge.llm import split
from kedge.llm.neardup import words

#: BM25: saturation of term frequency, and how much length counts.
K1, B = 1.2, 0.3
#: Least share of a query's own score, and of an indexed record's, that a candidate's score has.
LEFT_SHARE, RIGHT_SHARE = 0.36, 0.30
#: How near to the best of its query and of its record a candidate must score.
NEAR = 0.4
#: Least share of the main attribute's weight a match has in common with its query.
MAIN_SHARE = 0.2
#: Likeness of two phrases that say the same.
SAME_PHRASE = 0.62
#: Most pairs in the sample the confidence is fitted to.
FIT_PAIRS = 20_000
#: Numbers up to which a record posts every pair of them; one with more is found by single numbers.
PAIRED = 12
#: Most distinct terms that are broadcast; beyond it the weights are joined by shuffle.
BROADCAST_TERMS = 2_000_000
#: Words that turn a statement round.
NEGATIONS = ("не", "нет", "ни", "нельзя", "not", "no", "never")

_NUMBER = re.compile(r"\d+")


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def _terms(parts: list[list[str]]) -> tuple[list[int], list[int], int]:
    """(terms, how often each occurs, how many occur in all); the main attribute's terms are odd, the others even."""
    count: dict[int, int] = {}
    for attribute, part in enumerate(parts):
        main = attribute == 0
        mark = "m" if main else "p"
        for t in part if len(part) == 1 else (f"{a} {b}" for a, b in zip(part, part[1:])):
            h = _hash(mark + t)
            h = h | 1 if main else h & ~1
            count[h] = count.get(h, 0) + 1
    terms = sorted(count)
    return terms, [count[t] for t in terms], sum(count.values())


def _prepared(df: DataFrame) -> DataFrame:
    """``id, main, phrases``, their terms and what to post and ask numbers by, of ``id, main, phrases``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id, main, phrases in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                m = words(main or "")
                p = [w for w in (words(x) for x in phrases or () if x) if w]
                found = sorted({*_NUMBER.findall(" ".join(m))}, key=lambda x: (-len(x), x))
                nums = [_hash(x) for x in found]
                mask = 0
                for x in nums:
                    mask |= 1 << (x & 63)
                # a query asks by its two longest numbers; a record can be asked by any two, any one or none
                pairs = [_hash(f"{x},{y}") for i, x in enumerate(found) for y in found[i + 1 :]] if len(found) <= PAIRED else [_hash(f"m{x}") for x in found]
                number = _hash(f"{found[0]},{found[1]}") if len(found) > 1 else nums[0] if nums else 0
                alone = _hash(f"m{found[0]}") if len(found) > 1 else 0
                terms, freq, size = _terms([m, *p])
                rows.append((id, " ".join(m), [" ".join(x) for x in p], terms, freq, size, sorted(nums), mask - (1 << 64) if mask >> 63 else mask, number, alone, [0, *nums, *pairs]))
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in rows], schema=_ARROW)

    return df.select("id", "main", "phrases").mapInArrow(run, _SCHEMA)


_SCHEMA = "id bigint, main string, phrases array<string>, terms array<bigint>, freq array<int>, size int, nums array<bigint>, mask bigint, number bigint, alone bigint, keys array<bigint>"
_NAMES = tuple(x.split()[0] for x in _SCHEMA.split(", "))
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
_ARROW = pa.schema([(x.split()[0], _KINDS[x.split()[1]]) for x in _SCHEMA.split(", ")])


def contents(df: DataFrame, *, id: str, main: str, phrases: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(distinct contents, prepared; ``id`` of every row of ``df`` with its ``content``).

    Contents are told apart by a 128-bit digest and numbered when they are written. Rows with a null
    ``id`` belong to no record; null texts count as empty.
    """
    digest = F.unhex(F.md5(F.concat_ws("\u0002", F.coalesce(F.col(main), F.lit("")), F.coalesce(F.array_join(F.col(phrases), "\u0001", ""), F.lit("")))))
    rows = df.where(F.col(id).isNotNull()).select(F.col(id).alias("of"), F.col(main).alias("main"), F.col(phrases).alias("phrases"), digest.alias("digest"))
    held = scratch.table(rows.select("digest", "main", "phrases").dropDuplicates(["digest"]).withColumn("id", F.monotonically_increasing_id()), f"{name}-texts")
    of = rows.select("of", "digest").distinct().join(held.select("digest", F.col("id").alias("content")), "digest").select(F.col("of").alias(id), "content")
    return scratch.table(_prepared(held), name), scratch.table(of, f"{name}-rows")


def _idf(df: Column, n: int) -> Column:
    return F.log1p((F.lit(float(n)) - df + 0.5) / (df + 0.5))


def _impact(freq: Column, size: Column, mean: float) -> Column:
    """BM25 of a term without its idf."""
    return freq * (K1 + 1) / (freq + K1 * (1 - B + B * size / mean))


class Index:
    """Statistics of the indexed records: how many, mean size, and of every term its records and greatest impact without idf."""

    def __init__(self, right: DataFrame):
        facts = right.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).collect()[0]
        self.n, self.mean = facts["n"], float(facts["mean"] or 1.0) or 1.0
        each = right.select(F.explode(F.arrays_zip("terms", "freq")).alias("z"), "size").select(F.col("z.terms").alias("term"), _impact(F.col("z.freq"), F.col("size"), self.mean).alias("impact"))
        self.stats = scratch.table(each.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("top")), "terms")

    def weighted(self, side: DataFrame, *, most: bool) -> DataFrame:
        """``id, own, main, terms, weights``: the terms of each record that the index has, rarest first, and the score it has with itself, in all and from the main attribute.

        Weights are the terms' impacts, or with ``most`` their max-scores. Terms outside the index count to the own score only.
        """
        stats = F.broadcast(self.stats) if self.stats.count() <= BROADCAST_TERMS else self.stats
        each = side.select("id", "size", F.explode(F.arrays_zip("terms", "freq")).alias("z")).select("id", "size", F.col("z.terms").alias("term"), F.col("z.freq").alias("freq"))
        each = each.join(stats, "term", "left").withColumn("df", F.coalesce("df", F.lit(0).cast("bigint")))
        idf = _idf(F.col("df"), self.n)
        each = each.withColumn("weight", (idf * _impact(F.col("freq"), F.col("size"), self.mean)).cast("float"))
        entry = F.struct(F.col("df").cast("int").alias("df"), "term", ((idf * F.col("top")).cast("float") if most else F.col("weight")).alias("weight"))
        per = each.groupBy("id").agg(F.sum("weight").alias("own"), F.sum(F.when(F.col("term").bitwiseAND(F.lit(1)) == 1, F.col("weight"))).alias("main"), F.array_sort(F.collect_list(F.when(F.col("df") > 0, entry))).alias("all"))
        return per.select("id", "own", "main", F.transform("all", lambda x: x["term"]).alias("terms"), F.transform("all", lambda x: x["weight"]).alias("weights"))


def _prefixes(weighted: DataFrame, share: float) -> DataFrame:
    """``id, term``: the terms before the point from which the rest can't reach ``share`` of the own score."""
    mass = F.aggregate("weights", F.lit(0.0), lambda s, x: s + x)
    # float weights: a bound lower by a hair keeps what rounding would lose
    bound = F.col("own") * (share - 1e-5)
    start = F.struct(mass.alias("left"), F.lit(0).alias("taken"))
    folded = F.aggregate("weights", start, lambda acc, x: F.when(acc["left"] >= bound, F.struct((acc["left"] - x).alias("left"), (acc["taken"] + 1).alias("taken"))).otherwise(acc))
    return weighted.select("id", F.explode(F.slice("terms", F.lit(1), folded["taken"])).alias("term"))


def candidates(left: DataFrame, right: DataFrame, index: Index | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(``l, r`` of all pairs that may reach both bounds and hold the query's numbers, weighted left, weighted right).

    No pair that reaches ``LEFT_SHARE`` and ``RIGHT_SHARE`` and whose numbers agree is
    lost, however common its terms.
    """
    index = index or Index(right)
    lw, rw = scratch.table(index.weighted(left, most=True), "lw"), scratch.table(index.weighted(right, most=False), "rw")
    asks = F.array(F.col("number"))
    if not right.where(F.size("nums") > PAIRED).isEmpty():
        asks = F.when(F.col("alone") != 0, F.array("number", "alone")).otherwise(asks)
    query = _prefixes(lw, LEFT_SHARE).join(left.select("id", "mask", asks.alias("asks")), "id")
    query = query.select("term", F.explode("asks").alias("number"), F.col("id").alias("l"), F.col("mask").alias("lm"))
    query = query.select(F.xxhash64("term", "number").alias("key"), "l", "lm")
    posted = _prefixes(rw, RIGHT_SHARE).join(right.select("id", "mask", "keys"), "id")
    posted = posted.select("term", F.explode("keys").alias("number"), F.col("id").alias("r"), F.col("mask").alias("rm"))
    posted = posted.select(F.xxhash64("term", "number").alias("key"), "r", "rm")
    hits = split.join(query, posted, key="key", by=("l", "r"), condition=F.col("lm").bitwiseAND(F.bitwise_not("rm")) == 0)
    return hits.select("l", "r").distinct(), lw, rw


def phrase_likeness(a: str, b: str, least: float = 0.0) -> float:
    """1 for equal or contained phrases; 0 where the numbers differ or ``least`` can't be reached; else the share of matching characters."""
    if a == b or f" {a} " in f" {b} " or f" {b} " in f" {a} ":
        return 1.0
    if not {*_NUMBER.findall(a)} <= {*_NUMBER.findall(b)}:
        return 0.0
    m = SequenceMatcher(None, a, b, autojunk=False)
    if m.real_quick_ratio() < least or m.quick_ratio() < least:
        return 0.0
    return m.ratio()


def _agreement(asked: list[str], given: list[str]) -> float:
    """How well the worst of ``asked`` occurs in ``given``; 0 as soon as one doesn't, 1 for none."""
    worst = 1.0
    for p in asked:
        best = 1.0 if p in given else max((phrase_likeness(p, q, SAME_PHRASE) for q in given), default=0.0)
        if best < SAME_PHRASE:
            return 0.0
        worst = min(worst, best)
    return worst


def _negated(a: list[str], b: list[str]) -> bool:
    """Whether one of two texts turns round what the other says."""
    x, y = {*a}, {*b}
    if any((w in x) != (w in y) for w in NEGATIONS):
        return True
    return any(w.startswith("не") and len(w) > 5 and w[2:] in q and w not in q for p, q in ((x, y), (y, x)) for w in p - q)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of pairs from the terms of the query and the postings of the record."""
    for batch in batches:
        l, r = batch.column(0), batch.column(1)
        lt, rt, rw = batch.column(2), batch.column(3), batch.column(4)
        lo, ro = lt.offsets.to_numpy(), rt.offsets.to_numpy()
        lv, rv, wv = (c.values.to_numpy(zero_copy_only=False) for c in (lt, rt, rw))
        score, main = np.zeros(len(l)), np.zeros(len(l))
        for i in range(len(l)):
            mine, other = lv[lo[i] : lo[i + 1]], rv[ro[i] : ro[i + 1]]
            if not len(mine) or not len(other):
                continue
            at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
            shared = mine[at] == other
            w = wv[ro[i] : ro[i + 1]][shared]
            score[i] = w.sum(dtype=np.float64)
            main[i] = w[(other[shared] & 1) == 1].sum(dtype=np.float64)
        yield pa.RecordBatch.from_arrays([l, r, pa.array(score), pa.array(main)], names=["l", "r", "score", "main"])


def retrieve(left: DataFrame, right: DataFrame) -> DataFrame:
    """``l, r, score, main, forward, backward, gap, near`` of the candidates of every query; ``near`` says which reach the bounds and are mutually near.

    ``forward`` and ``backward`` are the score's shares of what query and record have with
    themselves, ``main`` the part of it that comes from the main attribute as a share of
    the query's, ``gap`` the distance to the best other candidate of the query, as a share of the query's own score.
    """
    pairs, lw, rw = candidates(left, right)
    lq = lw.select(F.col("id").alias("l"), F.array_sort("terms").alias("lt"), F.col("own").alias("lown"), F.col("main").alias("lmain"))
    rq = rw.select(F.col("id").alias("r"), F.col("terms").alias("rt"), F.col("weights").alias("rw"), F.col("own").alias("rown"))
    # keys and masks of numbers are hashed; here they are compared
    ln, rn = left.select(F.col("id").alias("l"), F.col("nums").alias("ln")), right.select(F.col("id").alias("r"), F.col("nums").alias("rn"))
    full = pairs.join(lq.select("l", "lt").join(ln, "l"), "l").join(rq.select("r", "rt", "rw").join(rn, "r"), "r")
    full = full.where(F.size(F.array_except("ln", "rn")) == 0).select("l", "r", "lt", "rt", "rw")
    scored = full.mapInArrow(_scored, "l bigint, r bigint, score double, main double")
    scored = scored.join(lq.select("l", "lown", "lmain"), "l").join(rq.select("r", "rown"), "r")
    scored = scored.withColumns({"forward": F.col("score") / F.col("lown"), "backward": F.col("score") / F.col("rown"), "main": F.try_divide("main", "lmain")})
    scored = scratch.table(scored.drop("lmain", "rown"), "scored")
    # best scores combine on the map side, so no task holds the partners of a hot record
    best_l = scored.groupBy("l").agg(F.max(F.struct("score", "r")).alias("first"))
    others = scored.join(best_l, "l").where(F.col("r") != F.col("first.r")).groupBy("l").agg(F.max("score").alias("second"))
    best_r = scored.groupBy("r").agg(F.max("score").alias("best_r"))
    near = scored.join(best_l, "l").join(others, "l", "left").join(best_r, "r")
    is_near = (F.col("forward") >= LEFT_SHARE) & (F.col("backward") >= RIGHT_SHARE) & (F.col("score") >= NEAR * F.col("first.score")) & (F.col("score") >= NEAR * F.col("best_r"))
    rival = F.when(F.col("r") == F.col("first.r"), F.coalesce("second", F.lit(0.0))).otherwise(F.col("first.score"))
    return near.select("l", "r", "score", "main", "forward", "backward", ((F.col("score") - rival) / F.col("lown")).alias("gap"), is_near.alias("near"))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for l, r, lm, lp, ln, rm, rp, rn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out.append((l, r, {*ln} <= {*rn} and not _negated(lm.split(), rm.split()) and _agreement(lp, rp) > 0))
        cols = list(zip(*out, strict=True)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["l", "r", "same"])


def judged(left: DataFrame, right: DataFrame) -> DataFrame:
    """The near candidates of ``retrieve``, and about ``FIT_PAIRS`` of all (``sampled``), with ``same``: whether the pair passes the check on the texts.

    It does if the record has the query's numbers and no negation the query lacks, every
    phrase of the query (if any) is among the record's, and ``MAIN_SHARE`` of the query's main weight is shared.
    """
    found = scratch.table(retrieve(left, right), "near")
    share = min(1.0, FIT_PAIRS / max(1, found.count()))
    found = found.withColumn("sampled", F.pmod(F.xxhash64("l", "r"), F.lit(1 << 31)) < int(share * (1 << 31))).where("near or sampled")
    a = left.select(F.col("id").alias("l"), F.col("main").alias("lm"), F.col("phrases").alias("lp"), F.col("nums").alias("ln"))
    b = right.select(F.col("id").alias("r"), F.col("main").alias("rm"), F.col("phrases").alias("rp"), F.col("nums").alias("rn"))
    full = found.where(F.col("main") >= MAIN_SHARE).select("l", "r").join(a, "l").join(b, "r").select("l", "r", "lm", "lp", "ln", "rm", "rp", "rn")
    checked = full.mapInArrow(_judged, "l bigint, r bigint, same boolean")
    return scratch.table(found.join(checked, ["l", "r"], "left").withColumn("same", F.coalesce("same", F.lit(False))), "judged")


_FEATURES = ("gap", "forward", "backward", "main")


def _fit(sample: pd.DataFrame) -> list[float]:
    """Intercept and weights of the features; fixed values where a label is missing."""
    y = sample["same"].to_numpy(dtype=float) if len(sample) else np.zeros(0)
    if len(y) < 50 or y.sum() < 10 or (1 - y).sum() < 10:
        return [-2.0, 1.0, 2.0, 1.0, 2.0]
    x = np.column_stack([np.ones(len(y)), *(sample[f].to_numpy(dtype=float) for f in _FEATURES)])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) * 0.1
        step = np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def match(left: DataFrame, right: DataFrame) -> DataFrame:
    """``l, r, score, confidence`` of matching contents (of ``contents``), each pair once.

    Near candidates that pass the check. Contents that ask the same tie and are all kept.
    The confidence is fitted to at most ``FIT_PAIRS`` candidates, chosen by hash, whether near, passed or not.
    Empty tables give an empty result.
    """
    held = judged(left, right)
    sample = held.where("sampled").select(*_FEATURES, "same").fillna(0.0).limit(FIT_PAIRS).toPandas()
    w = _fit(sample)
    z = F.lit(w[0])
    for f, x in zip(_FEATURES, w[1:], strict=True):
        z = z + F.lit(x) * F.col(f)
    return held.where("near and same").select("l", "r", "score", "gap", "forward", "backward", (1 / (1 + F.exp(-z))).alias("confidence"))
