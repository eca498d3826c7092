"""Near duplicates, matching, mixing."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kedge.llm import matching, mixing, neardup


def _texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"слово{i}" for i in range(400)]
    rows = []
    for i in range(n):
        base = rng.sample(vocabulary, 20)
        rows.append((f"r{i:04d}", " ".join(base)))
        for j in range(rng.randrange(3)):
            edited = base[:]
            for _ in range(rng.randrange(5)):
                edited[rng.randrange(20)] = rng.choice(vocabulary)
            rng.shuffle(edited)
            rows.append((f"r{i:04d}-{j}", " ".join(edited)))
    return rows


def test_pairs_against_brute_force(spark):
    rows = _texts(1, 150)
    rows += [("copy1", rows[0][1]), ("copy2", rows[0][1].upper()), ("copy2", rows[0][1].upper()), ("empty", ""), ("null", None), ("marks", "?!"), (None, rows[0][1]), ("long", " ".join(f"w{i}" for i in range(20000)))]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {(r.id_a, r.id_b) for r in neardup.near_duplicate_pairs(df, id="id", text="text", threshold=0.6, n=1).collect()}
    sets = {i: {*neardup.words(t)} for i, t in rows if i and t and neardup.words(t)}
    want = {tuple(sorted((a, b))) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    assert got <= want
    assert len(got) >= 0.98 * len(want) and len(want) > 50


def test_hot_buckets_and_copies(spark, monkeypatch):
    """One text, its copies and its near copies hold over a third of all rows; keys are split from five rows on."""
    from kedge.llm import split

    rows = _texts(7, 40)
    base = rows[0][1].split()
    rows += [(f"hot{i:02}", " ".join(base)) for i in range(20)] + [(f"near{i:02}", " ".join([*base[:-2], f"а{i}", f"б{i}"])) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, text string")
    plain = sorted(map(tuple, neardup.near_duplicate_pairs(df, id="id", text="text", threshold=0.6, n=1).collect()))
    groups = sorted(map(tuple, neardup.near_duplicate_groups(df, id="id", text="text", threshold=0.6, n=1).collect()))
    monkeypatch.setattr(split, "MOST", 5)
    for most in (split.BROADCAST_KEYS, 0):
        monkeypatch.setattr(split, "BROADCAST_KEYS", most)
        assert sorted(map(tuple, neardup.near_duplicate_pairs(df, id="id", text="text", threshold=0.6, n=1).collect())) == plain
    assert sorted(map(tuple, neardup.near_duplicate_groups(df, id="id", text="text", threshold=0.6, n=1).collect())) == groups
    sets = {i: {*neardup.words(t)} for i, t in rows}
    want = [p for p in combinations(sorted(sets), 2) if len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) >= 0.6]
    assert {*plain} <= {*want} and len(plain) >= 0.98 * len(want) and len(want) > 700
    l = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, a int")
    r = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 99)], "k int, b int")
    got = sorted(map(tuple, split.join(l, r, key="k", by=("a", "b")).collect()))
    assert got == sorted((k, a, b) for k, a in ((i % 3, i) for i in range(30)) for j, b in [(1, i) for i in range(30)] + [(2, 99)] if j == k)


def test_groups_and_shingles(spark):
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(words[:-1] + ["other"]), " ".join(words[:-1] + ["more"])
    df = spark.createDataFrame([("a", a), ("b", b), ("b2", b), ("c", c), ("x", "alone here"), ("y", ""), ("z", None)], "id string, text string")
    got = {r.id: (r.group_id, r.copies, r.links) for r in neardup.near_duplicate_groups(df, id="id", text="text").collect()}
    assert {got[k][0] for k in ("a", "b", "b2", "c")} == {"a"}
    assert got["b"][1] == 2 and got["a"][2] == 2
    assert got["x"] == ("x", 1, 0) and got["y"] == ("y", 1, 0) and got["z"] == ("z", 1, 0)
    assert neardup.near_duplicate_groups(df.limit(0), id="id", text="text").count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 100, 101, 200]], "key bigint")
    got = {r.key: r.root for r in neardup.components(links, nodes=nodes).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


def test_bands_meet_the_recall():
    for t in (0.5, 0.6, 0.8):
        n = neardup.bands(t)
        assert 1 - (1 - t**neardup.ROWS) ** n >= neardup.RECALL


LIVE = [
    ("k1", "Катер «Чайка-12» идёт вниз по реке Вятка при ветре 9 м/с. Кто обязан уступить дорогу?", ["Катер по левому борту", "Парусное судно без хода", "Буксир с баржей"]),
    ("k2", "Катер «Чайка-12» идёт вниз по реке Вятка при ветре 9 м/с. Кто обязан уступить дорогу? Схема условная.", ["Катер по левому борту", "Парусное судно без хода", "Буксир с баржей"]),
    ("k3", "Шлюпка «Сокол-7» стоит у причала Глубокое на якоре 40 м. Что нужно проверить до отхода?", ["Спасательные жилеты", "Запас горючего", "Исправность рации"]),
    (None, "Шлюпка без ключа", ["Да"]), ("k4", None, None), ("k5", "", []),
]
PUBLISHED = [
    ("same", "Вопрос. Катер «Чайка-12» идёт вниз по реке Вятка при ветре 9 м/с кто обязан уступить дорогу", ["Парусное судно без хода"], {"k1", "k2"}),
    ("typo", "Кaтер «Чайка-12» идёт внз по реке Вятка при ветре 9 м/с. Кто должен уступить дорогу?", ["Буксир с баржею"], {"k1", "k2"}),
    ("bare", "Шлюпка «Сокол-7» стоит у причала Глубокое на якоре 40 м. Что нужно проверить до отхода?", [], {"k3"}),
    ("number", "Катер «Чайка-12» идёт вниз по реке Вятка при ветре 19 м/с. Кто обязан уступить дорогу?", ["Парусное судно без хода"], set()),
    ("negated", "Катер «Чайка-12» идёт вниз по реке Вятка при ветре 9 м/с. Кто не обязан уступить дорогу?", ["Парусное судно без хода"], set()),
    ("answer", "Катер «Чайка-12» идёт вниз по реке Вятка при ветре 9 м/с. Кто обязан уступить дорогу?", ["Погасить все огни немедленно"], set()),
    ("other", "Где разрешена стоянка маломерного судна ночью?", [], set()), ("null", None, None, set()), ("empty", "", [], set()),
]


def test_matching_cases(spark):
    live = spark.createDataFrame(LIVE, "stable_key string, text string, answers array<string>")
    pub = spark.createDataFrame([p[:3] for p in PUBLISHED], "reference_id string, q string, a array<string>")
    left, of_left = matching.contents(pub, id="reference_id", main="q", phrases="a", name="l")
    right, of_right = matching.contents(live, id="stable_key", main="text", phrases="answers", name="r")
    rows = matching.match(left, right).join(of_left.withColumnRenamed("content", "l"), "l").join(of_right.withColumnRenamed("content", "r"), "r").collect()
    got = {}
    for r in rows:
        got.setdefault(r.reference_id, set()).add(r.stable_key)
    assert {p[0]: got.get(p[0], set()) for p in PUBLISHED} == {p[0]: p[3] for p in PUBLISHED}
    assert all(0 < r.confidence < 1 for r in rows)
    none, _ = matching.contents(pub.limit(0), id="reference_id", main="q", phrases="a", name="l")
    assert matching.match(none, right).count() == 0 and matching.match(left, right.limit(0)).count() == 0


@pytest.mark.parametrize("far", [False, True])
def test_retrieval_is_exact(spark, far, monkeypatch):
    """Scores, bounds and nearness by brute force over the terms; then with long lists split, many numbers and weights joined by shuffle."""
    import math

    from kedge.llm import split

    if far:
        monkeypatch.setattr(split, "MOST", 4)
        monkeypatch.setattr(matching, "BROADCAST_TERMS", 0)
        monkeypatch.setattr(matching, "PAIRED", 2)
    rng = random.Random(4)
    words = [f"с{c}" for c in "абвгдежзиклмнопрстуфхцчшщэюя"]
    live, pub = [], []
    for i in range(60):
        w = rng.sample(words, 12)
        live.append((f"k{i}", " ".join(w) + f" 7 {i % 2} {i % 3 + 4}", [" ".join(w[:2])] if i % 5 == 0 else []))
        for _ in range(rng.randrange(5)):
            w[rng.randrange(12)] = rng.choice(words)
        pub.append((f"p{i}", " ".join(w) + rng.choice(["", " 7", f" 7 {i % 2}", f" 7 {i % 2} {i % 3 + 4}"]), []))
    l, _ = matching.contents(spark.createDataFrame(pub, "id string, t string, a array<string>"), id="id", main="t", phrases="a", name="l")
    r, _ = matching.contents(spark.createDataFrame(live, "id string, t string, a array<string>"), id="id", main="t", phrases="a", name="r")
    lr, rr = l.collect(), r.collect()
    df = {}
    for x in rr:
        for t in x.terms:
            df[t] = df.get(t, 0) + 1
    mean = sum(x.size for x in rr) / len(rr)
    idf = lambda t: math.log1p((len(rr) - df.get(t, 0) + 0.5) / (df.get(t, 0) + 0.5))
    impact = lambda x: {t: idf(t) * f * (matching.K1 + 1) / (f + matching.K1 * (1 - matching.B + matching.B * x.size / mean)) for t, f in zip(x.terms, x.freq)}
    score, own = {}, {}
    for x in lr:
        for y in rr:
            mine, other = impact(x), impact(y)
            own["l", x.id], own["r", y.id] = sum(mine.values()), sum(other.values())
            common = sum(w for t, w in other.items() if t in mine)
            if common and {*x.nums} <= {*y.nums}:
                score[x.id, y.id] = common
    want = {k for k, v in score.items() if v >= matching.LEFT_SHARE * own["l", k[0]] and v >= matching.RIGHT_SHARE * own["r", k[1]]}
    got = {(c.l, c.r): c for c in matching.retrieve(l, r).collect()}
    assert len(want) > 40 and want <= {*got}
    for k, c in got.items():
        assert abs(c.score - score[k]) < 1e-3 and abs(c.forward - score[k] / own["l", k[0]]) < 1e-3
    best_l, best_r = {}, {}
    for k in got:
        best_l[k[0]], best_r[k[1]] = max(best_l.get(k[0], 0), score[k]), max(best_r.get(k[1], 0), score[k])
    assert {k for k, c in got.items() if c.near} == {k for k in want if score[k] >= matching.NEAR * best_l[k[0]] and score[k] >= matching.NEAR * best_r[k[1]]}


DOCS = "id bigint, sources array<string>, tokens bigint"
TARGETS = "source string, target_share double, max_repeats int"


def test_mix_meets_shares(spark):
    rng = random.Random(2)
    rows = [(i, ["a"], rng.randrange(1, 50)) for i in range(3000)] + [(5000 + i, ["b"], rng.randrange(1, 50)) for i in range(400)] + [(9000, ["b"], 0), (9001, None, 5), (9002, ["zz"], 5), (9003, [], 3)]
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], TARGETS)
    uses, shares = mixing.mix(spark.createDataFrame(rows, DOCS), t, id="id", sources="sources", tokens="tokens")
    s = {r.source: r for r in shares.collect()}
    assert abs(s["a"].actual_share - 0.5) < 0.01 and s["b"].most_uses == 3 and s["a"].most_uses == 1
    assert uses.where("id >= 9000").count() == 0
    again = mixing.mix(spark.createDataFrame(rows[::-1], DOCS), t, id="id", sources="sources", tokens="tokens")[0]
    assert sorted(map(tuple, uses.collect())) == sorted(map(tuple, again.collect()))


def test_mix_overlap_and_shortfall(spark):
    rows = [(i, ["a", "b"], 10) for i in range(100)] + [(200 + i, ["a"], 10) for i in range(50)]
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2), ("none", 0.2, 4)], TARGETS)
    uses, shares = mixing.mix(spark.createDataFrame(rows, DOCS), t, id="id", sources="sources", tokens="tokens", total=2000)
    s = {r.source: r for r in shares.collect()}
    assert s["a"].tokens == 1000 and s["b"].tokens == 1000 and s["none"].tokens == 0
    assert uses.groupBy("id").agg(F.sum("uses").alias("n")).where("n > 2").count() == 0
    short = {r.source: r.tokens for r in mixing.mix(spark.createDataFrame(rows, DOCS), t, id="id", sources="sources", tokens="tokens", total=100_000)[1].collect()}
    assert short["a"] + short["b"] == 150 * 10 + 100 * 10 and short["none"] == 0


def test_mix_many_patterns(spark):
    """Twelve sources that overlap in some thousand ways: every share is met, by documents used once."""
    rng = random.Random(5)
    names = [f"s{i:02}" for i in range(12)]
    rows = [(i, rng.sample(names, rng.randrange(1, 7)), rng.randrange(1, 40)) for i in range(4000)]
    t = spark.createDataFrame([(n, 1 / 12, 2) for n in names], TARGETS)
    patterns = {tuple(sorted(p)) for _, p, _ in rows}
    assert len(patterns) > 1000
    uses, shares = mixing.mix(spark.createDataFrame(rows, DOCS), t, id="id", sources="sources", tokens="tokens", total=60_000)
    assert all(abs(r.actual_share - 1 / 12) < 0.01 for r in shares.collect())
    assert uses.groupBy("id").agg(F.sum("uses").alias("n")).where("n > 1").count() < 0.2 * len(patterns)


def test_flow_is_cheapest():
    """Level by level against brute force over all ways to give whole tokens."""
    from itertools import product

    rng = random.Random(8)
    for _ in range(30):
        targets = [mixing.Target(s, 0.5, rng.randrange(1, 4)) for s in "ab"]
        capacity = {("a",): rng.randrange(3), ("b",): rng.randrange(3), ("a", "b"): rng.randrange(3)}
        quota = {"a": rng.randrange(5), "b": rng.randrange(5)}
        got = mixing.route(capacity, targets, quota)
        by = {t.source: t.repeats for t in targets}
        cells = [(p, k, s) for p in capacity for k in range(1, 4) for s in p if k <= by[s]]
        best = (0, 0)
        for give in product(range(3), repeat=len(cells)):
            use = dict(zip(cells, give))
            if any(sum(use.get((p, k, s), 0) for s in p) > capacity[p] for p in capacity for k in range(1, 4)) or any(sum(v for c, v in use.items() if c[2] == s) > quota[s] for s in "ab"):
                continue
            best = min(best, (-sum(give), sum(v * (c[1] - 1) ** 2 for c, v in use.items())))
            if len(cells) > 8:
                break
        total, cost = sum(got.values()), sum(v * (k - 1) ** 2 for (_, k, _), v in got.items())
        assert len(cells) > 8 or (-total, cost) == best


def test_mix_empty(spark):
    t = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    uses, shares = mixing.mix(spark.createDataFrame([], DOCS), t, id="id", sources="sources", tokens="tokens")
    assert uses.count() == 0 and [r.actual_share for r in shares.collect()] == [0.0]
    assert mixing.mix(spark.createDataFrame([(1, ["a"], 5)], DOCS), t.limit(0), id="id", sources="sources", tokens="tokens")[0].count() == 0
