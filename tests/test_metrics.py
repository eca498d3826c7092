"""Metrics, reports and checks; deltas and joins added to the core."""

import pytest
from pyspark.sql import functions as F

from kedge.operators import compare, metrics, rollups
from kedge.operators.snapshot_delta import snapshot_delta


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_crosswalk_metrics_and_reports(spark):
    records = spark.createDataFrame([("a", "exact", 0.9, 3), ("b", "unmatched", 0.4, 1), ("c", "unmatched", 0.4, 0), ("d", "unmatched", None, 2)], "id string, tier string, best double, position int")
    pairs = spark.createDataFrame([("a", "r1", True, True), ("a", "r2", True, None), ("b", "r1", False, True)], "l string, r string, accepted boolean, drift boolean")
    got = {r.metric: r.value for r in metrics.crosswalk_metrics(records, pairs, flags={"drift": F.col("drift")}).collect()}
    assert got == {"records": 4, "tier:exact": 1, "tier:strong": 0, "tier:probable": 0, "tier:ambiguous": 0, "tier:unmatched": 3, "several_accepted": 1, "drift": 1, "matched_partners": 1 + 1}
    assert [r.id for r in metrics.top_reviews(records, tiers=["unmatched"], score="best", position="position", k=2).collect()] == ["c", "b"]
    before = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "id string, usable boolean")
    after = spark.createDataFrame([("a", False), ("b", True), ("d", True)], "id string, usable boolean")
    assert rows(metrics.reconciliation(before, after, id="id", usable="usable"), "before", "after", "n") == sorted([(True, False, 1), (False, True, 1), (False, None, 1), (None, True, 1)], key=str)
    twice = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("m", 1, "one")], "k string, n int, v string")
    assert rows(metrics.last_by_identity(twice, identity=["k"], order="n"), "k", "v") == [("k", "new"), ("m", "one")]
    assert rows(metrics.by_category(twice, category="k", values=["k", "z"], measures={"most": F.max("n")}), "category", "rows", "most") == [("k", 2, 2), ("z", 0, 0)]
    empty = metrics.crosswalk_metrics(records.limit(0), pairs.limit(0)).collect()
    assert all(r.value == 0 for r in empty) and len(empty) == 8


def test_checks(spark):
    m = spark.createDataFrame([("m1", "d", "d", "u", 1, "x", "c"), ("m1", "e", "d", "u", 3, "x", "c"), ("m2", None, None, "v", 1, "x", "c")], "membership_id string, document_id string, source_pdf_sha256 string, pdf_url string, link_occurrences int, dimension string, category string")
    held = metrics.inventory_metrics(m)
    assert {r.metric: r.value for r in held.collect()} == {"memberships": 3, "urls": 2, "documents": 1, "repeated_links": 2, "memberships_of_repeated_urls": 2, "documents_of_several_urls": 0, "category:x/c": 3}
    objects = spark.createDataFrame([("z",)], "sha256 string")
    found = rows(metrics.verify_inventory(m, objects, metrics=held.where("metric <> 'urls'")), "check_name", "detail")
    assert found == sorted([("membership_id_repeated", "m1"), ("document_missing", "m2"), ("document_is_source", "m1"), ("object_missing", "d"), ("object_missing", None), ("metric", "urls")], key=str)
    parsed = spark.createDataFrame([("d:1", "d", 1, "t", ["a"], True, ["i"], "s", [("x", "c", "1")], [("h",)], "t"), ("d:3", "d", 3, "t", None, False, [], "s", [("x", "e", "1")], [], "t"), ("q:1", "q", 1, "u", ["a"], True, [], None, [], [], "u")], "reference_id string, document_id string, order_no int, normalized_question_text string, published_answers array<string>, correctness_known boolean, issues array<string>, answer_structure string, memberships array<struct<dimension:string,category:string,topic_code:string>>, illustration_refs array<struct<sha256:string>>, question_text string")
    found = rows(metrics.verify_parsed(parsed, m, rules={"answers": F.size("published_answers") > 0}, metrics=metrics.parse_metrics(parsed)), "check_name", "detail")
    assert found == [("document_unknown", "q"), ("position", "d"), ("rule", "answers|d:3")]
    live = spark.createDataFrame([("a", 1), ("b", 2)], "id string, position int")
    cross = spark.createDataFrame([("a", 1), ("a", 2), ("z", 2)], "id string, position int")
    found = rows(metrics.verify_crosswalk(cross, live, position="position", written={"w": live}, recomputed={"w": live.where("id = 'a'")}), "check_name", "detail")
    assert found == sorted([("not_one_row", "a"), ("not_one_row", "b"), ("not_one_row", "z"), ("order", "a"), ("recomputed:w", "expected")], key=str)
    hashes = spark.createDataFrame([("p", "1"), ("q", "2")], "path string, sha256 string")
    now = spark.createDataFrame([("p", "1"), ("q", "3"), ("r", "4")], "path string, sha256 string")
    assert rows(metrics.changed(metrics.guard(hashes), now), "detail") == [("q",), ("r",)]


def test_latest_media_and_topics(spark):
    uses = spark.createDataFrame([("q1", "u"), ("q2", "u"), ("q3", "none")], "q string, url string")
    media = spark.createDataFrame([("u", "old", 1, "t", "2024"), ("u", "new", 2, "t", "2025"), (None, "x", 1, "t", "2026")], "url string, sha256 string, bytes bigint, content_type string, checked_at string")
    assert rows(compare.enrich_resources(uses, media, at="checked_at"), "q", "sha256") == [("q1", "new"), ("q2", "new"), ("q3", None)]
    with pytest.raises(Exception, match="no media record"):
        compare.enrich_resources(uses, media, at="checked_at", required=True).collect()
    titles = rollups.canonical_titles(spark.createDataFrame([("Огни",)], "t string"), title="t", key=F.lower("t"))
    pairs = spark.createDataFrame([("l", "ОГНИ", "A", 1)], "l string, t string, prefix string, position int")
    r = rollups.annotated(pairs, titles, title="t", key=F.lower("t")).collect()[0]
    assert (r.topic.title, r.membership.prefix, r.membership.printed) == ("Огни", "A", "ОГНИ")
    with pytest.raises(Exception, match="no canonical topic"):
        rollups.annotated(pairs, titles, title="t", key=F.lit("zz")).collect()


def test_answer_check(spark):
    df = spark.createDataFrame([(["Да"], False, "Да", True, "Да"), (["перенос"], False, "пере-нос", True, "пере-\nнос"), (["Нет"], False, "Да", True, "Да"), (["Да", "Нет"], False, "Да", True, "Да"), (["Да"], True, "Да", True, "Да"), (["Да"], False, "Да", None, "Да"), (None, None, None, True, None)], "l array<string>, m boolean, p string, k boolean, r string")
    got = [r.s for r in df.select(rollups.answer_check(F.col("l"), F.col("m"), F.col("p"), F.col("k"), F.col("r")).alias("s")).collect()]
    assert got == ["same", "wording_changed", "different", "not_comparable", "not_comparable", "unknown_correctness", "not_comparable"]


@pytest.mark.parametrize("few", [True, False])
def test_changed_fields(spark, few, monkeypatch):
    from kedge.operators import snapshot_delta as module

    if not few:
        monkeypatch.setattr(module, "BROADCAST_PAIRS", 0)
        monkeypatch.setattr(module, "BROADCAST_CHANGED", 0)
    r = spark.createDataFrame([("s1", "same", 1, "x"), ("s2", "same", 1, "x"), ("s1", "a", 1, "x"), ("s1", "a", 1, "x"), ("s2", "a", 2, None), ("s2", "new", 1, "x"), ("s1", "old", 1, "x"), ("s1", "amb", 1, "x"), ("s1", "amb", 2, "x"), ("s2", "amb", 1, "x"), ("s2", None, 1, "x")], "s string, k string, n int, t string")
    pairs = spark.createDataFrame([("s2", "s1")], "later string, earlier string")
    got = rows(snapshot_delta(r, pairs, snapshot="s", key="k", fields=["n", "t"]), "key", "change_kind", "changed_fields")
    assert got == sorted([("a", "changed", ["n", "t"]), ("new", "added", []), ("old", "removed", []), ("amb", "ambiguous", [])], key=str)
    assert rows(snapshot_delta(r, pairs, snapshot="s", key="k", fields=["t"], keep_unchanged=True), "key", "change_kind", "changed_fields")[0] == ("a", "changed", ["t"])
    assert snapshot_delta(r.limit(0), pairs, snapshot="s", key="k", fields=["n", "t"]).count() == 0
