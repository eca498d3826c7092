"""Snapshot deltas, runs, bitemporal ledger, instants: against plain definitions, and the edge cases."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from kedge.functions.instants import instant_us
from kedge.operators.history import as_of, bitemporal_ledger, current_versions
from kedge.operators.runs import value_runs
from kedge.operators.snapshot_delta import snapshot_delta, snapshot_pairs

MANIFEST = "snapshot_id string, previous_snapshot string, complete boolean"
ROWS = "snapshot_id string, stable_key string, fp string, later string, field int"


def test_pairs(spark):
    m = spark.createDataFrame([("a", None, True), ("b", "a", True), ("b", "a", True), ("c", "b", False), ("d", "zz", True), ("e", "c", True), ("f", "f", True), ("g", "a", None)], MANIFEST)
    assert {tuple(r) for r in snapshot_pairs(m).collect()} == {("b", "a"), ("e", "c")}


def test_delta_kinds(spark):
    pairs = spark.createDataFrame([("b", "a"), ("c", "a")], "later string, earlier string")
    rows = [
        ("a", "same", "1"), ("b", "same", "1"), ("b", "same", "1"), ("a", "gone", "1"), ("b", "new", "1"), ("a", "chg", "1"), ("b", "chg", "2"),
        ("a", "nul", None), ("b", "nul", None), ("a", "nul2", None), ("b", "nul2", "1"), ("a", "amb", "1"), ("a", "amb", None), ("b", "amb", "1"), ("a", None, "1"), ("b", None, "2"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)
    got = snapshot_delta(df, pairs, snapshot="snapshot_id", key="stable_key", fields=["fp"])
    b = {(r["key"], r["change_kind"]) for r in got.where("snapshot_id = 'b'").collect()}
    assert b == {("gone", "removed"), ("new", "added"), ("chg", "changed"), ("nul2", "changed"), ("amb", "ambiguous")}
    # a predecessor may serve several snapshots; c is empty, so everything is removed or ambiguous
    c = {(r["key"], r["change_kind"]) for r in got.where("snapshot_id = 'c'").collect()}
    assert c == {(k, "removed") for k in ("same", "gone", "chg", "nul", "nul2")} | {("amb", "ambiguous")}


def test_delta_fields_and_empty(spark):
    pairs = spark.createDataFrame([("b", "a")], "later string, earlier string")
    df = spark.createDataFrame([("a", "k", "x" * 500, "p", 1), ("b", "k", "x" * 499 + "y", "p", 2)], ROWS)
    got = snapshot_delta(df, pairs, snapshot="snapshot_id", key="stable_key", fields=["fp", "later", "field"]).collect()
    assert [(r["change_kind"], r["changed_fields"]) for r in got] == [("changed", ["field", "fp"])]
    assert snapshot_delta(df.limit(0), pairs, snapshot="snapshot_id", key="stable_key", fields=["fp"]).count() == 0
    assert snapshot_delta(df, pairs.limit(0), snapshot="snapshot_id", key="stable_key", fields=["fp"]).count() == 0


def brute_runs(rows):
    out = []
    for key in {k for k, _, _ in rows}:
        mine = sorted({(t, v) for k, t, v in rows if k == key}, key=lambda x: x[0])
        starts = [(t, v) for i, (t, v) in enumerate(mine) if i == 0 or mine[i - 1][1] != v]
        out += [(key, v, t, starts[i + 1][0] if i + 1 < len(starts) else None) for i, (t, v) in enumerate(starts)]
    return sorted(out, key=str)


@pytest.mark.parametrize("keys", [1, 3])
def test_runs_with_a_hot_key(spark, keys):
    rng = random.Random(keys)
    rows = [(f"k{rng.randrange(keys)}", t, rng.choice(["a", "a", "b", None])) for t in range(400)]
    got = value_runs(spark.createDataFrame(rows, "k string, t bigint, v string"), keys=["k"], order=["t"], value="v")
    assert sorted(((r.k, r.v, r.run_start, r.run_end) for r in got.collect()), key=str) == brute_runs(rows)


def test_runs_empty_and_null(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("k", None, "a")], "k string, t bigint, v string")
    assert value_runs(df, keys=["k"], order=["t"], value="v").count() == 0


def brute_ledger(points):
    """Beliefs at each recorded time, from scratch."""
    out = {}
    for now in sorted({r for _, r, _ in points}):
        known = sorted((t, r, v) for t, r, v in points if r <= now)
        out[now] = sorted((t, known[i + 1][0] if i + 1 < len(known) else None, v) for i, (t, _, v) in enumerate(known) if i + 1 == len(known) or known[i + 1][0] != t)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_ledger_against_replay(spark, seed):
    rng = random.Random(seed)
    hot = [(t, r, rng.choice("ab")) for t, r in zip(rng.sample(range(1000), 60), [rng.randrange(40) for _ in range(60)])]
    if seed == 1:  # every observation arrives in reverse
        hot = [(t, 100 - i, "ab"[i % 2]) for i, t in enumerate(range(0, 60))]
    few = [(5, 3, "x"), (5, 9, "y"), (7, 1, "x")]
    df = spark.createDataFrame([("hot", v, t, r) for t, r, v in hot] + [("few", v, t, r) for t, r, v in few] + [("few", "x", 7, 4)], "url string, sha string, t bigint, r bigint")
    ledger = bitemporal_ledger(df, key="url", value="sha", valid="t", recorded="r").cache()
    rows = ledger.collect()
    for key, points in (("hot", hot), ("few", few)):
        for now, state in brute_ledger(points).items():
            held = sorted((x.valid_from, x.valid_to, x.value) for x in rows if x.key == key and x.recorded_from <= now and (x.recorded_to is None or x.recorded_to > now))
            assert sorted(held, key=str) == sorted(state, key=str), (key, now)
    assert as_of(ledger, valid_at=6, recorded_at=4).where("key = 'few'").collect()[0].value == "x"
    now = current_versions(ledger).where("key = 'few'").collect()
    assert {(r.value, r.valid_from, r.valid_to) for r in now} == {("y", 5, 7), ("x", 7, None)}


def test_ledger_leaves_out_what_is_no_observation(spark):
    df = spark.createDataFrame([(None, "a", 1, 1), ("u", None, 1, 1), ("u", "a", None, 1), ("u", "a", 5, None)], "url string, sha string, t bigint, r bigint")
    got = bitemporal_ledger(df, key="url", value="sha", valid="t", recorded="r").collect()
    assert [(r.valid_from, r.recorded_from, r.valid_to) for r in got] == [(5, 5, None)]
    assert bitemporal_ledger(df.limit(0), key="url", value="sha", valid="t", recorded="r").count() == 0


def test_instants(spark):
    want = int(datetime(2028, 7, 10, 1, 11, 8, tzinfo=timezone.utc).timestamp() * 1e6)
    same = ["2028-07-10T01:11:08Z", "2028-07-10 01:11:08", "2028-07-09T23:11:08-02:00", "Mon, 10 Jul 2028 01:11:08 GMT", "2028-07-10T01:11:08.000000+00:00", "20280710T011108Z", " 2028-07-10T01:11:08z "]
    bad = ["", " ", "unknown", "0000-00-00", "2028-13-01T00:00:00Z", None]
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = spark.createDataFrame([(s,) for s in same + bad], "s string").select(instant_us(F.col("s")).alias("t")).collect()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r.t for r in got] == [want] * len(same) + [None] * len(bad)
