"""Text profiles, identities, similarities: against plain Python."""

import hashlib
import json
import random
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kedge.functions import identity, similarity, text


def dp_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("абвг -1", max_size=140), min_size=1, max_size=6), st.lists(st.text("абвг -1", max_size=140), min_size=1, max_size=6))
def test_common_subsequences(a, b):
    want = [[dp_lcs(x, y) for x in a] for y in b]
    assert similarity.lcs_grid(a, b).tolist() == want
    pairs = [(x, y) for y in b for x in a]
    assert similarity.lcs_pairs([x for x, _ in pairs], [y for _, y in pairs]).tolist() == [n for row in want for n in row]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("абвгдежз -1", max_size=90), min_size=1, max_size=6), st.lists(st.text("абвгдежз -1", max_size=90), min_size=1, max_size=6), st.sampled_from([30.0, 55.0, 70.0, 85.0, 100.0]), st.sampled_from([0.0, 1.0]))
def test_reaching_loses_no_pair(a, b, cutoff, pairwise):
    edited = [x[: len(x) // 3] + "ю" + x[len(x) // 3 + 2 :] for x in a]
    held, similarity.PAIRWISE = similarity.PAIRWISE, pairwise
    try:
        p, t, ratio = similarity.reaching(a, b + edited, cutoff)
    finally:
        similarity.PAIRWISE = held
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b + edited) if len(x) + len(y) and 200 * dp_lcs(x, y) / (len(x) + len(y)) >= cutoff}
    assert {(i, j) for i, j in zip(p.tolist(), t.tolist()) if a[i] or (b + edited)[j]} == want
    assert all(r >= cutoff for r in ratio)


def test_common_subsequences_of_long_and_no_texts():
    x, y = "аб" * 700, "ба" * 650 + "в"
    assert similarity.lcs_grid([x, ""], [y, "", x]).tolist() == [[dp_lcs(x, y), 0], [0, 0], [1400, 0]]
    assert similarity.lcs_grid([], ["а"]).shape == (1, 0) and similarity.lcs_pairs([], []).tolist() == []
    assert similarity.order_score([], []) == 0.0 and similarity.greedy_assignment([], []) == 1.0 and similarity.optimal_assignment([], []) == (0.0, [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("аб", max_size=4), max_size=4), st.lists(st.text("аб", max_size=4), max_size=4))
def test_assignments(a, b):
    score, at = similarity.optimal_assignment(a, b)
    if a and len(a) == len(b):
        best = max(sum(similarity.indel(x, b[j]) for x, j in zip(a, p)) for p in permutations(range(len(b)))) / 100 / len(a)
        assert abs(score - best) < 1e-9 and sorted(at) == list(range(len(b)))
        assert similarity.greedy_assignment(a, b) <= score + 1e-9
    else:
        assert at == []


def test_similarity_columns(spark):
    df = spark.createDataFrame([("ab", "abc", ["x", "y"], ["y", "x"]), (None, "a", None, ["a"]), ("", "", [], [])], "a string, b string, p array<string>, q array<string>")
    got = df.select(similarity.indel_ratio("a", "b").alias("r"), similarity.assign_optimal("p", "q").alias("o"), similarity.assign_greedy("p", "q").alias("g"), similarity.order_ratio("p", "q").alias("s")).collect()
    assert round(got[0].r, 6) == 80.0 and got[0].o.score == 1.0 and got[0].o.positions == [1, 0] and got[0].s == 0.0
    assert got[1].r is None and got[1].o.score is None and got[1].g is None
    assert got[2].r == 100.0 and got[2].o.score == 0.0 and got[2].g == 1.0


def test_bags_and_differences(spark):
    df = spark.createDataFrame([(["a", "a", "b"], ["a"]), ([], ["a"]), (None, ["a"])], "x array<string>, y array<string>")
    got = df.select(similarity.bag_difference(F.col("x"), F.col("y")).alias("d"), similarity.bag_equal(F.col("x"), F.col("y")).alias("e")).collect()
    assert [r.d for r in got] == [["a", "b"], [], []] and [r.e for r in got] == [False, False, None]


def test_visual_evidence(spark):
    d = "struct<pixel_sha256:string,aspect:double,thumbnail:array<int>,dhash:bigint>"
    rows = [([], [], None, None), (["a"], ["a"], None, None), (["a"], [], None, None), (["a"], ["b"], None, None), (["a"], ["b"], ("p", 1.0, [1, 2], 3), ("p", 1.0, [1, 2], 3)), (["a"], ["b"], ("p", 1.0, [1, 2], 3), ("q", 1.5, [2, 3], -1)), (["a"], ["b"], ("p", 1.0, [0, 0], 1), ("q", 1.0, [1, 1], 3))]
    got = [r.v for r in spark.createDataFrame(rows, f"l array<string>, r array<string>, a {d}, b {d}").select(similarity.visual_evidence(F.col("l"), F.col("r"), F.col("a"), F.col("b")).alias("v")).collect()]
    assert [v.kind for v in got] == ["both_absent", "bytes_equal", "presence_changed", "unavailable", "pixels_equal", "visual_comparison", "visual_comparison"]
    assert [v.support for v in got] == [True, True, False, False, True, False, True]
    assert got[5].bits == 62 and got[5].error == 1.0 and got[6].strict
    wide = spark.createDataFrame([(["a"], ["b"], ("p", 3.0, [1, 1, 1], 0), ("q", 2.0, [0, 0, 1], 0))], f"l array<string>, r array<string>, a {d}, b {d}").select(similarity.visual_evidence(F.col("l"), F.col("r"), F.col("a"), F.col("b")).alias("v")).collect()[0].v
    assert wide.aspect == 0.5 and wide.error == 0.6667


def test_digests_against_json(spark):
    q = {"text": "Вопрос \"1\"\\ \t", "resources": [{"url": "u/1"}], "answers": [{"id": "i", "text": "да", "resources": [], "correct": True}, {"id": "j", "text": "нет", "resources": [{"url": "u/2"}], "correct": False}], "correct": ["i"], "add": None}
    schema = "text string, resources array<struct<url:string>>, answers array<struct<id:string,text:string,resources:array<struct<url:string>>,correct:boolean>>, correct array<string>, add boolean"
    df = spark.createDataFrame([q], schema)
    cols = F.col("text"), F.col("resources"), F.col("answers")
    m = identity.match_fingerprint(*cols)
    got = df.select(identity.content_fingerprint(*cols).alias("c"), m.alias("m"), identity.revision_fingerprint(m, F.lit("single"), F.lit(False), F.col("add"), F.col("correct"), F.col("answers")).alias("r"), identity.stable_key(F.lit(None).cast("string"), m).alias("k")).collect()[0]
    dig = lambda v: hashlib.sha256(json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    urls = lambda x: [r["url"] for r in x]
    match = dig({"algorithm": "match-fingerprint-v1", "text": q["text"], "resources": urls(q["resources"]), "answers": [{"id": a["id"], "text": a["text"], "resources": urls(a["resources"])} for a in q["answers"]]})
    assert got.m == match and got.k == f"fallback:{match}"
    assert got.c == dig({"text": q["text"], "resources": urls(q["resources"]), "answers": [{"text": a["text"], "resources": urls(a["resources"])} for a in q["answers"]]})
    assert got.r == dig({"algorithm": "revision-fingerprint-v2", "match": match, "type": "single", "multiple": False, "is_additional": None, "correct_answer_ids": ["i"], "correct_flags": [True, False]})


def _one(spark, f, s):
    return spark.createDataFrame([(s,)], "s string").select(f(F.col("s")).alias("x")).collect()[0].x


def test_profiles(spark):
    raw = "  «Ёлка» – ﬁx­ed Straße 12,5 м?! "
    assert _one(spark, text.folded_text, raw) == '"елка" - fixed strasse 12,5 м?!'
    assert _one(spark, text.comparison_text, raw) == '"елка" - fixed strasse 12,5 м'
    assert _one(spark, text.text_variants, "пере-\nнос. Да") == ["пере- нос. да", "перенос. да", "пере-нос. да"]
    assert _one(spark, text.answer_key, "«Левый борт».") == "левый борт" and _one(spark, text.answer_key, '"') == '"'
    assert _one(spark, text.title_key, "Огни (ВВП+)") == "огни"
    assert _one(spark, text.words_text, "Пере-\n нос, А/Б") == "перенос а б"
    assert _one(spark, text.cased_text, "Какой Знак?..") == "Какой Знак"
    assert _one(spark, text.topic_text, "OT 5 м: Кто?") == "от 5 м: кто"
    assert _one(spark, text.critical_tokens, "не левее 2,5 м, увеличить") == ["не", "левее", "2,5", "увеличить"]
    assert _one(spark, text.wide_tokens, "Без 10% хода 5 м") == ["без", "10", "%", "5", "м"]
    assert _one(spark, text.words_text, "судно-\u200cбаржа") == "судно баржа" and _one(spark, text.cased_text, "судно-\u200cбаржа") == "судно-\u200cбаржа"
    listed = spark.createDataFrame([(["«Ёлка».", None, "Пере-\nнос"],), (None,)], "a array<string>").select(text.folded_texts("a").alias("f"), text.words_texts("a").alias("w"), text.topic_texts("a").alias("t")).collect()
    assert (listed[0].f, listed[0].w, listed[0].t) == (['"елка".', "", "пере- нос"], ["ёлка", "", "перенос"], ['"елка"', "", "пере- нос"]) and listed[1].f is None
    assert _one(spark, text.critical_signature, "нельзя 12 м") == ["critical:нельзя", "number:12 м"]
    for f in (text.folded_text, text.comparison_text, text.words_text, text.topic_text, text.nfc_text, text.answer_key):
        assert _one(spark, f, None) is None and _one(spark, f, "") == ""


def test_pictures_codes_topics(spark):
    df = spark.createDataFrame([("что на рисунке", ["а"]), ("кто прав", ["1", "2а"]), ("кто прав", ["да", "нет"]), ("кто", []), (None, None)], "t string, a array<string>")
    got = df.select(text.needs_picture(F.col("t"), F.col("a")).alias("w"), text.needs_picture(F.col("t"), F.col("a"), narrow=True).alias("n")).collect()
    assert [r.w for r in got] == [True, True, True, False, False] and [r.n for r in got] == [True, True, False, False, False]
    assert _one(spark, text.is_code, "АБ.1.2.") and not _one(spark, text.is_code, "1.2")
    assert _one(spark, text.code_of, "АБ.1 Общие") == "АБ.1" and _one(spark, text.code_of, "Общие") is None
    assert _one(spark, lambda c: F.struct(*text.topic_of(c)), "1.2. Огни") == ("1.2", "Огни")


def test_ids(spark):
    assert _one(spark, identity.is_uuid, "0cc7b5a0-1f6e-4b8f-9a50-aaaaaaaaaaaa") and not _one(spark, identity.is_uuid, "x")
    want = "g:" + hashlib.sha256(b"a\n\nb").hexdigest()[:24]
    assert spark.range(1).select(identity.short_id("g:", F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("x")).collect()[0].x == want


def test_jvm_and_numpy_agree(spark):
    from kedge.functions import kernel

    assert kernel.register(spark)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("абвг дежз\U0001f600\U0001f601ﬁ-1") for _ in range(rng.randrange(n)))
    rows = [(word(300), word(300), [rng.choice([word(30), word(80), "да"]) for _ in range(n)], [rng.choice([word(30), "да", None]) for _ in range(rng.choice([n, n, 3]))]) for n in [rng.randrange(9) for _ in range(120)]]
    df = spark.createDataFrame([*rows, (None, "а", None, ["x"]), ("", "", [], [])], "a string, b string, x array<string>, y array<string>")
    for name, cols in (("indel_ratio", "ab"), ("assign_optimal", "xy"), ("assign_greedy", "xy"), ("order_ratio", "xy")):
        got = df.select(getattr(similarity, name)(*cols).alias("jvm"), getattr(similarity, f"_{name}")(*cols).alias("numpy"))
        assert "ArrowEvalPython" not in str(df.select(getattr(similarity, name)(*cols))._jdf.queryExecution().executedPlan())
        assert all(r.jvm == r.numpy for r in got.collect())


@pytest.mark.parametrize("share", [0.0, 1.0])
@pytest.mark.parametrize("cutoff", [40.0, 55.0, 85.0])
def test_jvm_finds_the_best_of_all_pairs(spark, cutoff, share):
    from kedge.functions import kernel

    assert kernel.register(spark)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("абвгдежзикл ") for _ in range(n))
    left = [word(rng.choice([5, 40, 63, 64, 130, 210, 230, 260])) for _ in range(300)]
    right = [word(rng.choice([5, 63, 210])) for _ in range(40)] + ["".join(c for c in rng.choice(left) if rng.random() > rng.choice([0.02, 0.1, 0.4])) + "ю" for _ in range(560)]
    block = spark.createDataFrame([(list(enumerate(left)), list(enumerate(right)))], "a array<struct<id:bigint,text:string>>, b array<struct<id:bigint,text:string>>")
    found = block.select(F.inline(F.call_function("kedge_best", "a", "b", F.lit(cutoff), F.lit(3), F.lit(share)))).collect()
    p, t, ratio = similarity.reaching(left, right, cutoff)
    least = {i: sorted(ratio[p == i])[-3:][0] for i in set(p.tolist())}
    assert {(r.a, r.b, r.ratio) for r in found} == {(i, j, x) for i, j, x in zip(p.tolist(), t.tolist(), ratio.tolist()) if x >= least[i]} and len(found) > 200


def test_jvm_compares_four_texts_at_once(spark):
    from kedge.functions import kernel

    assert "kedge.kernel.Vectors" in kernel._classes(spark.sparkContext._jvm) and kernel.register(spark)
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("абвгдежз ") for _ in range(n))
    ends = [word(n) for n in (15, 16, 17, 70, 200)]
    left = [word(rng.choice([1, 10, 40, 63, 64, 100])) + rng.choice(ends) for _ in range(150)] + [word(n) for n in (252, 253, 315, 316, 330)]
    right = [word(rng.choice([0, 1, 16, 60, 120])) + e for e in ends for _ in range(120)] + ["".join(c for c in x if rng.random() > 0.15) for x in left] + [ends[3] + "ю", ends[3]]
    right = list(dict.fromkeys(right))
    block = spark.createDataFrame([(list(enumerate(left)), list(enumerate(right)))], "a array<struct<id:bigint,text:string>>, b array<struct<id:bigint,text:string>>")
    for cutoff, k in ((20.0, 7), (70.0, 3)):
        found = block.select(F.inline(F.call_function("kedge_best", "a", "b", F.lit(cutoff), F.lit(k), F.lit(0.0)))).collect()
        p, t, ratio = similarity.reaching(left, right, cutoff)
        least = {i: sorted(ratio[p == i])[-k:][0] for i in set(p.tolist())}
        assert {(r.a, r.b, r.ratio) for r in found} == {(i, j, x) for i, j, x in zip(p.tolist(), t.tolist(), ratio.tolist()) if x >= least[i]} and len(found) > 200
