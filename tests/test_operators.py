"""Comparison, quality, layout, linkage, roll-ups: small cases and edge cases."""

import random

import pytest

from pyspark.sql import functions as F

from kedge.operators import compare, layout, linkage, quality, rollups


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_record_diff(spark):
    s = "k string, a string, b int, p int"
    old = spark.createDataFrame([("same", "x", 1, 1), ("chg", "x", 1, 2), ("mov", "x", 1, 3), ("gone", "x", 1, 4), ("dup", "x", 1, 5), (None, "x", 1, 6), ("nul", None, 1, 7)], s)
    new = spark.createDataFrame([("same", "x", 1, 1), ("chg", "y", 2, 9), ("mov", "x", 1, 4), ("new", "x", 1, 4), ("dup", "x", 1, 5), ("dup", "x", 1, 6), ("nul", None, 1, 7)], s)
    d = compare.record_diff(old, new, key="k", fields=["a", "b"], position="p")
    assert rows(d, "key", "status", "changed", "moved") == sorted([("same", "same", [], False), ("chg", "changed", ["a", "b"], True), ("mov", "same", [], True), ("gone", "removed", [], False), ("dup", "ambiguous", [], False), ("new", "added", [], False), ("nul", "same", [], False)], key=str)
    t = compare.diff_totals(d).collect()[0]
    assert (t.previous, t.current, t.delta, t.added, t.removed, t.changed, t.moved, t.ambiguous_keys, t.unchanged) == (6, 7, 1, 3, 2, 1, 2, 1, 2)
    assert compare.diff_totals(compare.record_diff(old.limit(0), new.limit(0), key="k", fields=["a"])).collect()[0].previous == 0


def test_map_diff_sets_zip(spark):
    a = spark.createDataFrame([("u", "1"), ("v", "1"), ("w", None)], "url string, sha string")
    b = spark.createDataFrame([("u", "2"), ("w", None), ("x", "1")], "url string, sha string")
    assert rows(compare.map_diff(a, b, key="url", value="sha"), "key", "status") == [("u", "changed"), ("v", "removed"), ("w", "same"), ("x", "added")]
    assert rows(compare.set_relation(a, b, key="url", universe=spark.createDataFrame([("z",), ("u",)], "url string")), "key", "relation") == [("u", "both"), ("v", "only_left"), ("w", "both"), ("x", "only_right"), ("z", "neither")]
    assert rows(compare.zip_rows(a.withColumn("g", F.lit(1)), b.limit(2).withColumn("g", F.lit(1)), by=["g"], order="url"), "url", "url_r") == [("u", "u"), ("v", "w"), ("w", None)]
    assert compare.nonequal_rows(a, a).count() == 0 and compare.nonequal_rows(a, b).count() == 4


QUESTION = "id int, text string, resources array<struct<url:string>>, official_id string, position_no int, id_status string, answers array<struct<id:string,text:string,resources:array<struct<url:string>>,correct:boolean>>, correct_answer_ids array<string>, multiple boolean, question_type string, stable_key string"


def _q(i, **over):
    base = {"id": i, "text": "t", "resources": [], "official_id": "o", "position_no": i, "id_status": "official", "answers": [("a", "x", [], True), ("b", "y", [], False)], "correct_answer_ids": ["a"], "multiple": False, "question_type": "single", "stable_key": f"k{i}"}
    return tuple({**base, **over}.values())


def test_constraints_name_the_broken_rule(spark):
    cases = {
        2: ("content", {"text": ""}), 3: ("official_id", {"official_id": None}), 4: ("answer_ids_unique", {"answers": [("a", "x", [], True), ("a", "y", [], True)], "correct_answer_ids": ["a", "a"]}),
        5: ("correct_ids_known", {"correct_answer_ids": ["z"]}), 6: ("multiple_flag", {"multiple": True}), 7: ("correct_count", {"correct_answer_ids": []}), 8: ("correct_flags", {"answers": [("a", "x", [], None), ("b", "y", [], True)]}),
    }
    df = spark.createDataFrame([_q(1), *[_q(i, **o) for i, (_, o) in cases.items()]], QUESTION)
    got = {}
    for r in quality.violations(df, id="id", rules=quality.question_rules()).collect():
        got.setdefault(r.id, set()).add(r.rule)
    assert 1 not in got and all(rule in got[i] for i, (rule, _) in cases.items())
    s = quality.record_summary(df).collect()[0]
    assert (s.positions, s.without_official_id, s.unique_keys, s.consecutive) == (8, 1, 8, True)
    assert quality.record_summary(df.limit(0)).collect()[0].consecutive is False


def test_urls_and_signatures(spark):
    good = ["https://h.example:85/b/x.png", "https://H.example:85/b/x%20y.png?q=1"]
    bad = ["http://h.example:85/b/x", "https://h.example/b/x", "https://u:p@h.example:85/b/x", "https://h.example:85/c/x", "https://h.example:85/b/", "https://h.example:85/b/../x", "https://h.example:85/b/%2e%2e/x", "https://h.example:85/b/x#f", "https://h.example:85/b\\x", "https://h.example:85/b/%2541", "https://h.example:85/b/%zz", ""]
    df = spark.createDataFrame([(u,) for u in good + bad], "u string")
    assert [r.ok for r in df.select(quality.url_rule(F.col("u"), host="h.example", port=85, prefix="/b/").alias("ok")).collect()] == [True] * 2 + [False] * len(bad)
    files = [("image/png", b"\x89PNG\r\n\x1a\n..", True), ("image/png", b"GIF89a", False), ("image/gif", b"GIF89a", True), ("image/webp", b"RIFFxxxxWEBP", True), ("image/svg+xml", b"<?xml?><SVG>", True), ("image/svg+xml", b"<html><svg>", False), ("video/mp4", b"....ftypisom", True), ("audio/mpeg", b"\xff\xfb..", True), ("text/plain", b"x", False), ("image/png", b"", False), (None, b"x", False)]
    got = spark.createDataFrame(files, "k string, b binary, w boolean").select(quality.media_signature(F.col("k"), F.col("b")).alias("g"), "w").collect()
    assert all(r.g == r.w for r in got)


def test_duplicates_gaps_orphans(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4), (None, 5), (None, 7)], "k string, p int")
    assert quality.duplicate_profile(df, key=["k"]).collect()[0].asDict() == {"rows": 5, "unique": 3, "duplicate_groups": 2, "in_groups": 4, "excess": 2}
    assert rows(quality.repeated_keys(df, key="k"), "k", "n") == [("a", 2)]
    assert rows(quality.position_gaps(df.withColumn("g", F.lit("x")), by=["g"], position="p"), "before", "after") == [(2, 4), (5, 7)]
    assert rows(quality.orphans(df, df.where("k = 'a'"), on={"k": "k"}), "k") == [("b",)]
    assert quality.duplicate_profile(df.limit(0), key=["k"]).collect()[0].rows == 0


def test_layout(spark):
    rules = spark.createDataFrame([(1, 10.2), (1, 9.9), (1, 40.0), (1, 45.0), (2, 5.0), (1, None)], "page int, y double")
    assert rows(layout.adjacent_bands(rules, page=["page"], y="y", least=18.0), "page", "top", "bottom") == [(1, 10.0, 40.0)]
    cells = spark.createDataFrame([(1, 0.0, 10.0, 0.0, 10.0, "c1"), (1, 10.0, 20.0, 0.0, 10.0, "c2")], "page int, left double, right double, top double, bottom double, cell string")
    items = spark.createDataFrame([(1, 10.0, 0.0, "edge"), (1, 5.0, 10.0, "below"), (2, 5.0, 5.0, "page"), (1, 5.0, 9.9, "in")], "page int, x double, y double, item string")
    assert rows(layout.in_cells(items, cells, page=["page"], x="x", y="y"), "item", "cell") == [("edge", "c2"), ("in", "c1")]
    bands = spark.createDataFrame([(1, 0.0, 10.0, "r1"), (1, 9.0, 20.0, "r2")], "page int, top double, bottom double, row string")
    assert rows(layout.sole_row(items, bands, page=["page"], id="item", y="y"), "item", "row") == [("below", "r2"), ("edge", "r1"), ("in", None), ("page", None)]
    boxes = spark.createDataFrame([(1, 4.0, 9.0, 6.0, 11.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    assert rows(layout.covered(items, boxes, page=["page"], x="x", y="y"), "item") == [("below",), ("in",)]
    lines = spark.createDataFrame([(1, 0.0, 8.0, "one"), (1, 9.0, 17.0, "goes on"), (1, 30.0, 38.0, "two"), (1, 39.0, 47.0, "• three")], "page int, top double, bottom double, text string")
    assert rows(layout.paragraphs(lines, by=["page"], top="top", bottom="bottom", gap=5.0, text="text"), "paragraph", "text") == [(1, "one goes on"), (2, "two"), (3, "• three")]
    spans = spark.createDataFrame([(1, 0.0, "a"), (1, 1.5, "b"), (1, 3.0, "c"), (1, 3.5, "d")], "page int, y double, s string")
    assert rows(layout.anchored_lines(spans, page=["page"], y="y", near=2.0, keep=["s"]), "s", "line") == [("a", 1), ("b", 1), ("c", 2), ("d", 2)]
    styled = spark.createDataFrame([(1, 0, True), (1, 1, False), (2, 0, True), (2, 1, True), (3, 0, True)], "q int, n int, bold boolean")
    assert rows(layout.sole_styled(styled, by=["q"], position="n", styled="bold"), "q", "correct") == [(1, 0), (2, None), (3, None)]
    assert rows(layout.gap_range(lines, by=["page"], y="top"), "least", "most", "distinct") == [(9.0, 21.0, 2)]


def test_asof_and_nearest_against_brute_force(spark):
    rng = random.Random(3)
    heads = [(rng.randrange(3), rng.randrange(50), f"h{i}") for i in range(20)]
    heads = list({(g, o): (g, o, h) for g, o, h in heads}.values())
    asked = [(g, o, f"r{g}-{o}") for g in range(3) for o in rng.sample(range(50), 15)]
    h = spark.createDataFrame(heads, "g int, o int, h string")
    r = spark.createDataFrame(asked, "g int, o int, r string")
    want = sorted(((x, max(((p, n) for q, p, n in heads if q == g and p < o), default=(None, None))[1]) for g, o, x in asked), key=str)
    assert rows(layout.preceding(r, h, by=["g"], order=["o"], carry=["h"]), "r", "h") == want
    got = layout.nearest(r, h, by=["g"], order="o", k=2, carry="h").collect()
    assert len(got) == len(asked)
    for x in got:
        mine = sorted((p, n) for q, p, n in heads if q == x.g)
        assert x.before == [n for p, n in mine if p < x.o][-2:] and x.after == [n for p, n in mine if p > x.o][:2]


def test_pairs_and_tiers(spark):
    l = spark.createDataFrame([("l1", "судно идет по реке ночью", ["a", "b"]), ("l2", "какой сигнал подает буксир", ["c"]), ("l3", None, [])], "l string, t string, a array<string>")
    r = spark.createDataFrame([("r1", "судно идет по реке ночью", ["b", "a"], ["судно идет по реке ночью", "x"]), ("r2", "какой сигнал подаст буксир", ["d"], []), ("r3", "судно идет по реке днем", ["a"], [])], "r string, t string, a array<string>, v array<string>")
    ids = ("l", "r")
    exact = linkage.exact_pairs(l, r, id=ids, on={"t": "t"})
    assert rows(exact, "l", "r") == [("l1", "r1")] == rows(linkage.bag_pairs(l, r, id=ids, bag=("a", "a")), "l", "r") == rows(linkage.variant_pairs(l, r, id=ids, text="t", variants="v"), "l", "r")
    fuzzy = linkage.fuzzy_pairs(linkage.gated(l, exact, id="l"), r, id=ids, text=("t", "t"), cutoff=85.0, k=3)
    assert rows(fuzzy, "l", "r") == [("l2", "r2")]
    assert rows(linkage.union_pairs(exact, fuzzy, exact), "l", "r", "via") == [("l1", "r1", ["exact"]), ("l2", "r2", ["fuzzy"])]
    p = spark.createDataFrame([("x", "r1", 1.0), ("x", "r2", 1.0), ("y", "r1", 0.98), ("y", "r2", 0.975), ("w", "r1", 0.75)], "l string, r string, score double")
    assert rows(linkage.best_band(p, by=["l"], score="score", width=0.005), "l", "r", "in_band")[3:] == [("y", "r1", True), ("y", "r2", True)]
    nested = linkage.nest_pairs(p, by="l", order=[-F.col("score"), F.col("r")], fields=["r", "score"]).where("l = 'y'").collect()[0].candidates
    assert [c.r for c in nested] == ["r1", "r2"]


@pytest.mark.parametrize("cutoff", [55.0, 85.0])
def test_fuzzy_is_all_pairs(spark, cutoff, monkeypatch):
    from kedge.functions.similarity import indel_ratios

    monkeypatch.setattr(linkage, "LEFT_BLOCK", 7)
    monkeypatch.setattr(linkage, "RIGHT_BLOCK", 5)
    rng = random.Random(6)
    words = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(rng.randrange(4, 10))) for _ in range(80)]
    left = [(f"l{i}", " ".join(rng.sample(words, rng.choice([1, 3, 9, 9])))) for i in range(40)] + [("none", None), ("empty", "")]
    right = [("none", None), ("empty", "")]
    for i, (_, t) in enumerate(left[:40]):
        w = t.split()
        w[rng.randrange(len(w))] = rng.choice(words)
        right.append((f"r{i}", " ".join(w)))
    right.append(("copy", right[5][1]))
    pairs = [(a, x, b, y) for a, x in left for b, y in right if x and y]
    ratio = dict(zip([(a, b) for a, _, b, _ in pairs], indel_ratios([p[1] for p in pairs], [p[3] for p in pairs]).tolist()))
    want = set()
    for a, _ in left[:40]:
        best = sorted({(-ratio[a, b], y) for b, y in right if y and ratio[a, b] >= cutoff})[:3]
        want |= {(a, b, round(ratio[a, b], 6)) for b, y in right if y and (-ratio[a, b], y) in best}
    got = linkage.fuzzy_pairs(spark.createDataFrame(left, "l string, t string"), spark.createDataFrame(right, "r string, t string"), id=("l", "r"), text=("t", "t"), cutoff=cutoff, k=3)
    assert {(x.l, x.r, round(x.ratio, 6)) for x in got.collect()} == want and len(want) >= 15
    assert linkage.fuzzy_pairs(got.limit(0).select("l", F.col("via").alias("t")), got.select("r", F.col("via").alias("t")), id=("l", "r"), text=("t", "t"), cutoff=cutoff, k=3).count() == 0


def test_fuzzy_without_jvm_functions(spark, monkeypatch):
    left = spark.createDataFrame([(f"l{i}", "какое судно уступает дорогу плоту " + "х" * i) for i in range(9)], "l string, t string")
    right = spark.createDataFrame([(f"r{i}", "какое судно уступает дорогу плотам " + "х" * i) for i in range(9)], "r string, t string")
    pairs = lambda: rows(linkage.fuzzy_pairs(left, right, id=("l", "r"), text=("t", "t"), cutoff=85.0, k=3), "l", "r", "ratio")
    want = pairs()
    monkeypatch.setattr(linkage.kernel, "register", lambda spark: False)
    monkeypatch.setattr(linkage, "NUMPY_LEFT", 4)
    monkeypatch.setattr(linkage, "NUMPY_RIGHT", 2)
    assert pairs() == want and len(want) == 27


@pytest.mark.parametrize("cutoff, blocks", [(55.0, True), (55.0, False), (85.0, True)])
def test_fuzzy_twice_is_two_calls(spark, cutoff, blocks, monkeypatch):
    if blocks:
        monkeypatch.setattr(linkage, "LEFT_BLOCK", 17)
        monkeypatch.setattr(linkage, "RIGHT_BLOCK", 29)
    rng = random.Random(8)
    words = ["".join(rng.choice("абвгдежзиклмн?.") for _ in range(rng.randrange(3, 10))) for _ in range(60)]
    tails = ["", "?", "?", "?..", ".", " !", "абв", "?" * 40]

    def side(n, name):
        out = [(f"{name}-none", None, None), (f"{name}-empty", "", "?"), (f"{name}-all", "", "")]
        for i in range(n):
            t = " ".join(rng.choices(words, k=rng.choice([1, 3, 9, 9, 10, 30])))
            f = t + rng.choice(tails) if rng.random() < 0.9 else t.replace("а", "a") + "?"
            out += [(f"{name}{i}", None if rng.random() < 0.1 else t, None if rng.random() < 0.2 else f), (f"{name}{i}'", t, t + rng.choice(tails))]
        return out

    left, right = side(60, "l"), side(60, "r")
    right += [(f"{i}'{n}", t and t.replace(rng.choice("абвг"), ""), f and f.replace(rng.choice("абвг"), "").rstrip("?") + rng.choice(tails)) for i, t, f in left for n in range(2)]
    right = [(i, t, f) for i, t, f in right]
    left, right = (spark.createDataFrame(x, "id string, t string, f string") for x in (left, right))
    got = linkage.fuzzy_pairs_twice(left, right, id=("id", "id"), text=("t", "t"), other=("f", "f"), cutoff=cutoff, k=(5, 3))
    for found, c, k in zip(got, "tf", (5, 3)):
        want = rows(linkage.fuzzy_pairs(left, right, id=("id", "id"), text=(c, c), cutoff=cutoff, k=k), "l", "r", "ratio")
        assert rows(found, "l", "r", "ratio") == want and len(want) > 150


@pytest.mark.parametrize("cutoff", [55.0, 85.0])
def test_fuzzy_sends_texts_to_few_blocks(cutoff):
    # some 120,000 and 540,000 texts of 220 characters, as at 1 GB
    left, right = 120_000 * 220, 540_000 * 220
    a, b = linkage._sides(left, right, cutoff, 8)
    assert (left * -(-right // b) + right * -(-left // a)) * 2 < 4e9 * (1 if cutoff > 80 else 2)
    assert a * b / 220**2 < 6e8


def test_fuzzy_ranks_texts_not_copies(spark):
    left = spark.createDataFrame([("l", "какое судно уступает дорогу плоту")], "l string, t string")
    right = spark.createDataFrame([(f"a{i}", "какое судно уступает дорогу плоту 1") for i in range(5)] + [("z", "какое судно уступает дорогу плотам 22")], "r string, t string")
    got = linkage.fuzzy_pairs(left, right, id=("l", "r"), text=("t", "t"), cutoff=85.0, k=2)
    assert {x.r for x in got.collect()} == {"a0", "a1", "a2", "a3", "a4", "z"}


def test_consensus(spark):
    p = spark.createDataFrame([("one", "t", "A", 1), ("conf", "t", "A", 1), ("conf", "t", "B", 2), ("conf", "u", "C", 3), ("many", "t", "A", 1), ("many", "u", "B", 2), ("none", None, "A", 1)], "l string, topic string, prefix string, pos int")
    assert rows(linkage.topic_consensus(p, topic="topic", prefix="prefix", position="pos"), "l", "kind", "primary", "topics") == [("conf", "conflict", "t", ["t", "u"]), ("many", "several", None, ["t", "u"]), ("one", "single", "t", ["t"])]


def test_rollups(spark):
    p = spark.createDataFrame([("d", "q", 2, "d:2", ["Да ", "нет"]), ("d", "q", 1, "d:1", ["да"]), ("d", None, 3, "d:3", None)], "doc string, q string, n int, id string, a array<string>")
    g = rollups.reference_groups(p, key=["doc", "q"], order="n", row_id="id", answers="a", answer_key=F.lower(F.trim("answer")))
    assert rows(g, "q", "rows", "row_ids", "answers", "answer_rows") == sorted([("q", 2, ["d:1", "d:2"], ["да", "нет"], 3), (None, 1, ["d:3"], [], 0)], key=str)
    rows_ = [("d:2", 2, "Какой знак?", ["да"], True, "Да", "full_options", ["h2"]), ("d:1", 1, "Какой знак", ["да", "Нет"], False, None, "published_answer_only", ["h1"]), ("d:3", 3, "Что на рисунке", [], False, None, "unknown", []), ("d:4", 4, None, None, None, None, None, [])]
    q = spark.createDataFrame([(i, "d", "dim", "cat", None, t, t, a, k, c, s, p, False, False, False, n) for i, n, t, a, k, c, s, p in rows_], "id string, document_id string, dimension string, category string, topic_code string, question_text string, raw_question_text string, published_answers array<string>, correctness_known boolean, published_correct_answer string, answer_structure string, pictures array<string>, graphics boolean, masked boolean, incomplete boolean, position bigint")
    groups, members = rollups.question_groups(q)
    assert rows(groups, "text", "rows", "answers", "pictures", "needs_picture") == [("", 1, [], [], False), ("Какой знак", 2, ["да", "Нет"], ["h1", "h2"], False), ("Что на рисунке", 1, [], [], True)]
    import hashlib
    import json

    want = "group:" + hashlib.sha256(json.dumps(["d", "dim", "cat", "", "Что на рисунке", ["no-image"]], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:24]
    assert want in {r.group_id for r in members.collect()} and members.count() == 4 and rollups.question_groups(q.limit(0))[0].count() == 0
    t = spark.createDataFrame([("Огни",), ("огни",), ("Огни",), ("ОГНИ",), (None,)], "t string")
    assert rows(rollups.canonical_titles(t, title="t", key=F.lower("t")), "title", "spellings", "rows") == [("Огни", 3, 4)]
    c = spark.createDataFrame([("1.2.3",), ("1.2",), ("4",), (None,)], "c string")
    assert rows(rollups.code_tree(c, code="c"), "node", "parent", "depth", "rows") == sorted([("1", None, 1, 2), ("1.2", "1", 2, 2), ("1.2.3", "1.2", 3, 1), ("4", None, 1, 1)], key=str)
    n = spark.createDataFrame([("b", 2)], "k string, n bigint")
    assert rows(rollups.with_all(n, key="k", values=["a", "b"]), "k", "n") == [("a", 0), ("b", 2)]
    assert rows(rollups.coverage(spark.createDataFrame([("x",), ("x",), ("y",)], "t string"), tier="t", usable=["x"]), "tier", "percent", "usable") == [("x", 66.67, True), ("y", 33.33, False)]
    o = spark.createDataFrame([(1, i, "t" if i < 6 else "u", "exact") for i in range(12) if i not in (5, 6)] + [(1, 5, None, "unmatched"), (1, 6, None, "ambiguous")], "g int, o int, topic string, tier string")
    a = rollups.order_audit(o, by=["g"], order="o", topic="topic", tier="tier", anchors=["exact", "strong"], targets=["unmatched"]).collect()
    assert [(r.o, r.same_before, r.same_after, r.same_both, r.transition) for r in a] == [(5, True, True, False, True)]
