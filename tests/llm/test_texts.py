"""Canonical text, tokens, garbled text."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from kedge.llm import garbled
from kedge.llm.canonical import canonical, canonical_text, irregular, quick_check
from kedge.llm.tokens import Encoder, count_tokens, decode, encode, read_ranks

PAIRS = [
    ("Мoтopнaя", "Моторная"), ("йод и ёж", "йод и ёж"), ("во​да", "вода"), ("по­рт", "порт"), ("а б　в г", "а б в г"),
    ("１２，５？", "12,5?"), ("Κατер", "Катер"), ("c борта", "с борта"), ("GPS и VHF", "GPS и VHF"), ("gps vhf ais", "gps vhf ais"), ("VНF", "VHF"),
    ("", ""), (None, None), ("«Чайка» – 5 км/ч", "«Чайка» – 5 км/ч"), ("​", ""), ("tripulação à vela", "tripulação à vela"), ("КУДА ИДЁТ CO GPS", "КУДА ИДЁТ СО GPS"), ("сигнал MOB", "сигнал MOB"), ("судно А12", "судно А12"), ("судно A12", "судно А12"),
    ("ска\u0301ла", "скала"), ("вoдa\u0301", "вода"), ("в\u0585да", "вода"), ("п\u1d0fрт", "порт"), ("5\u20126", "5–6"), ("\u0456 сигнал", "i сигнал"), ("\u0405OS", "SOS"), ("résumé", "résumé"),
]


@pytest.mark.parametrize("text,want", PAIRS)
def test_canonical(text, want):
    assert canonical(text) == want
    assert canonical(want) == want
    if text != want:
        assert re.search(quick_check(), text)


def test_quick_check_misses_nothing():
    rng = random.Random(1)
    letters = "абвйёАacCxοΡіѕօᴏ‒　 ​­̆̈１Ｚ59 -.«V\tβ½№é"
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 12)))
        c = canonical(t)
        assert canonical(c) == c
        if c != t:
            assert re.search(quick_check(), t), t
        assert unicodedata.normalize("NFC", c) == c


def test_canonical_columns(spark):
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(PAIRS)], "id int, text string, canonical string")
    got = {r.id: r.c for r in df.select("id", canonical_text(F.col("text")).alias("c")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(PAIRS)}
    assert {r.id for r in irregular(df, text="text").collect()} == {i for i, (t, w) in enumerate(PAIRS) if t != w}
    assert irregular(df.limit(0), text="text").count() == 0


TEXTS = ["", None, " ", "Судно идёт", "it's 30°\n\n  x \t", "航路標識🚤", "a\u001cb", "½²٣12", "\r\n" * 50, "я" * 4000, "<|endoftext|>", "Судно идёт"]


def test_tokens_against_the_public_tokenizer(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tk.encode_special_tokens = True
    rng = random.Random(5)
    more = ["".join(rng.choice("абв xyz'12.,\n\t🚤éя—­") for _ in range(rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(TEXTS + more)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in encode(df, id="doc_id", text="text").collect()}
    ranks = read_ranks()
    assert len(got) == len(TEXTS) + len(more)
    for i, t in enumerate(TEXTS + more):
        assert got[i] == tk.encode(t or "", add_special_tokens=False).ids
        assert decode(got[i], ranks) == (t or "")
    n = {r.doc_id: r.tokens for r in count_tokens(df, text="text", keep=["doc_id"]).collect()}
    assert n == {i: len(x) for i, x in got.items()}


def test_encoder_forgets_and_goes_on():
    e = Encoder(read_ranks(), kept=3)
    texts = ["один два три", "четыре пять шесть", "один два"]
    first = [e.encode([t])[1].tolist() for t in texts]
    assert [e.encode([t])[1].tolist() for t in texts] == first


def _corpus(n=400):
    rng = random.Random(7)
    words = "судно идёт вниз по реке шлюпка якорь буксир пристань фарватер обязан уступить дорогу встречному сигнал огонь берег волна ветер капитан экипаж".split()
    return [" ".join(rng.choice(words) for _ in range(40)).capitalize() + "." for _ in range(n)]


MAPPINGS = [("cp1252", "utf-8"), ("cp1251", "utf-8"), ("cp866", "utf-8"), ("koi8-r", "utf-8"), ("latin-1", "cp1251"), ("cp1251", "koi8-r"), ("cp1251", "cp866"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("mac-cyrillic", "cp1251")]


def _spoil(text, wrong, right):
    out = []
    for b in text.encode(right):
        try:
            out.append(bytes([b]).decode(wrong))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def test_garbled_is_found_and_restored(spark):
    docs = _corpus()
    rows, want = [(i, t, "same name") for i, t in enumerate(docs)], {}
    for j, (wrong, right) in enumerate(MAPPINGS):
        i = 1000 + j
        rows.append((i, _spoil(docs[j], wrong, right), ""))
        want[i] = docs[j]
    half = docs[50][:120] + _spoil(docs[50][120:], "cp1251", "utf-8")
    twice = _spoil(_spoil(docs[51], "cp1251", "utf-8"), "cp1251", "utf-8")
    rows += [(2000, half, ""), (2001, twice, "")]
    want |= {2000: docs[50], 2001: docs[51]}
    clean = ["", None, "  ", "Überholen ist verboten.", "À l’ancre, le voilier montre une boule noire.", "┌────┬────┐\n│ 12 │ 34 │\n└────┴────┘", "Речни знак „Ђурђево“ и Ѓорче.", "航路標識 и μίλι", "СУДНО ИДЁТ ВНИЗ ПО РЕКЕ.", "+4°C, ½ м", "я" * 5000]
    rows += [(3000 + i, t, "") for i, t in enumerate(clean)]
    rows.append((4000, "потеряно �� тут", ""))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, restored string")
    got = {r.doc_id: r.restored for r in garbled.find_garbled(df, id="doc_id", text="text").collect()}
    assert set(got) == {*want, 4000}
    assert got[4000] is None
    right = sum(got[i] == w for i, w in want.items())
    assert right >= len(want) - 2, [(i, got[i], w) for i, w in want.items() if got[i] != w]
    assert garbled.find_garbled(df.limit(0), id="doc_id", text="text").count() == 0


def test_garbling_of_a_third_of_the_corpus_is_found():
    docs = _corpus(90)
    for wrong, right in MAPPINGS[:4] + [("cp1252", "cp1251"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("cp866", "koi8-r")]:
        texts = [_spoil(t, wrong, right) if i % 3 == 0 else t for i, t in enumerate(docs)]
        model = garbled.PairModel(*garbled.pair_counts(texts))
        looked = garbled.suspects(texts, model)
        done = [garbled.restore(t, model) if yes else (t, []) for t, yes in zip(texts, looked)]
        assert [bool(how) for _, how in done] == [i % 3 == 0 for i in range(90)], (wrong, right)
        assert sum(new.lower() == t.lower() for (new, _), t in zip(done, docs)) > 75, (wrong, right)


def test_fixed_signs_look_only_where_they_can_be(monkeypatch):
    rng = random.Random(4)
    words = "какой судно огонь якорь берег обязан уступить дорогу плот на повороте реки фарватер ночью подъезд щит жёлтый цепь".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    sound = [text(40) for _ in range(30)]
    calls, segments = [], garbled.segments
    monkeypatch.setattr(garbled, "segments", lambda *a: calls.append(1) or segments(*a))
    assert all(garbled._by_fixed_signs(t) is None for t in sound)
    assert len(calls) < len(sound)  # one a mapping and text before
    texts = sound[:10] + ["", "а"]
    for wrong, right in (("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("mac-cyrillic", "cp1251"), ("cp1252", "cp1251"), ("cp1252", "utf-8"), ("cp1251", "utf-8")):
        texts += [text(9) + " " + text(n).encode(right, "replace").decode(wrong, "replace") + " " + text(5) for n in (1, 3, 9, 30)]
    single, gain, changed = garbled._fixed_scores()
    found = 0
    for t in texts[10:]:
        # the likeliest of all segments of all mappings, the first of equal ones
        s, best = garbled._codes(t), None
        for i, (wrong, right, _) in enumerate(single):
            score = gain[i][s].astype(float)
            for lo, hi in segments(score, garbled.FIXED):
                total, concerned = float(score[lo:hi].sum()), s[lo:hi][changed[i][s[lo:hi]]]
                if total >= garbled.FIXED_EACH * len(concerned) and len(set(concerned.tolist())) >= garbled.FIXED_LETTERS and (best is None or total > best[0]):
                    best = total, (wrong, right)
        got = garbled._by_fixed_signs(t)
        if got is None or got[1][1] != "utf-8":
            assert (got and got[1]) == (best and best[1])
        found += got is not None
    assert found >= 12
    # every text with a window of that gain is suspect, none but for one
    s, sizes = garbled._codes("\x00".join(t for t in texts if len(t) > 1)), [len(t) + 1 for t in texts if len(t) > 1]
    want, at = [], 0
    lead, rest, _ = garbled._sequence_bits()
    for n in sizes:
        own = s[at : at + n]
        pairs = sum(bool(x & y) for x, y in zip(lead[own[: n - 1]].tolist(), rest[s[at + 1 : at + n]].tolist(), strict=False))
        want.append(pairs >= garbled.SEQUENCES / garbled.SEQUENCE / 2 or any(g[own[i : i + garbled.WINDOW]].sum() >= garbled.WINDOW_LEAST for g in gain for i in range(0, n, garbled.WINDOW)))
        at += n
    ends = [sum(sizes[:i]) for i in range(len(sizes))]
    assert garbled._signs(s, garbled.np.array(ends), garbled.np.array(sizes)).tolist() == want and 0 < sum(want)


def test_segments_against_all_subsegments():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.integers(-4, 4, 25).astype(float)
        got = garbled.segments(s, 1.0)
        best = max((s[i:j].sum() for i in range(25) for j in range(i + 1, 26)), default=0)
        if best >= 1:
            assert max(s[a:b].sum() for a, b in got) == best
        assert all(a2 >= b1 for (_, b1), (a2, _) in zip(got, got[1:]))


def test_lost_marks():
    """A lone mark in sound text is no case; several, or one among improbable pairs, are."""
    sound = ["Катер проходит под мостом и подаёт сигнал, экипаж проверяет огни и жилеты."] * 400
    model = garbled.PairModel(*garbled.pair_counts(sound))
    assert not garbled.lost(sound[0], model) and not garbled.lost(sound[0].replace("мостом", "мос\ufffdом"), model)
    assert garbled.lost(sound[0].replace("мостом", "\ufffd\ufffd\ufffdом"), model)
    assert garbled.lost(sound[0].replace("мостом", "РјРѕС\ufffdС‚РѕРј"), model)


def test_decoded_wrongly_four_times():
    sound = ["Катер проходит под мостом и подаёт сигнал, экипаж проверяет огни и жилеты."] * 400
    model = garbled.PairModel(*garbled.pair_counts(sound))
    bad = sound[0]
    for _ in range(4):
        bad = bad.encode("utf-8").decode("latin-1")
    assert garbled.restore(bad, model)[1]
