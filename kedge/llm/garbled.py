"""Text that was decoded with the wrong character encoding, found and restored.

1. Over the whole corpus, adjacent character pairs are counted; a pair's cost is the
   negative logarithm of its contribution to the mutual information of neighbours,
   p(a,b) log(1 + p(a,b) / (p(a) p(b))). Pairs of ordinary text contribute much,
   pairs that wrong decoding makes contribute little, however closely they cling.
2. In each document the maximum-scoring segments of (cost - ``RARE``) are the
   improbable runs.
3. Inside those runs only, inverse mappings are tried: encode in the encoding that
   was used by mistake, decode in the right one, as often as it was done. A run is
   garbled if a mapping makes it cheaper by ``GAIN`` and leaves it as cheap as
   ordinary text; it is replaced by what the mapping gives. Runs that lost characters
   on the way are found by the sequences that are left, and restored as far as those go.
4. A wrong decoding that many texts share makes its own pairs ordinary. Whatever the
   corpus, stretches are therefore also found by fixed signs: UTF-8 sequences of letters
   where sound text has none, and letters that are as frequent as in Russian only after
   an inverse mapping.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cost (nats) from which a pair counts as improbable.
RARE = 9.0
#: Score from which a segment of improbable pairs is looked at.
SEGMENT = 4.5
#: The same for long segments of pairs that are only less probable than most, as a
#: wrong decoding that is frequent in the corpus makes them.
MILD, MILD_SEGMENT = 7.2, 12.0
#: Score from which a further segment extends a run.
EXTEND = 1.5
#: Characters between two segments up to which they are one run.
JOIN = 30
#: What a mapping must save over all pairs it changes (nats), and per changed pair.
GAIN, GAIN_EACH = 8.0, 1.5
#: What pairs changed by a single-byte mapping may cost on average beyond the corpus's mean.
ORDINARY = 1.7
#: What it must save in a part of a run that it makes dearer as a whole.
GAIN_PART = 25.0
#: The same allowance for such a part.
ORDINARY_PART = 0.8
#: Share of the characters past ASCII that the wrong encoding must be able to have made.
COVER = 0.6
#: Cost of a pair never met, and the most any pair costs.
WORST = 13.0
#: Score from which a stretch is garbled by fixed signs alone (nats), per changed character, and how many of these differ.
FIXED, FIXED_EACH, FIXED_LETTERS = 25.0, 0.2, 5
#: Characters of a window, and its score from which a text is looked at for these signs.
WINDOW, WINDOW_LEAST = 16, 7.0
#: Marks of lost characters in one improbable run, or score of its other pairs, from which they show a wrong decoding.
LOST_MARKS, LOST_SCORE = 2, 1.5
#: Score of each character of a UTF-8 sequence of a letter, of other characters past ASCII, and of four such sequences.
SEQUENCE, NO_SEQUENCE, SEQUENCES = 2.0, -1.5, 16.0

_ENCODINGS = ("cp1252", "cp1251", "koi8-r", "cp866", "mac-cyrillic", "iso8859-5", "mac-roman")
_RIGHT = ("utf-8", "cp1251", "koi8-r", "cp866", "mac-cyrillic", "iso8859-5", "cp1252")


@cache
def symbols() -> np.ndarray:
    """Symbol of every code point: itself in the blocks of alphabets, marks and drawing; one per category elsewhere.

    So there are under 3,200 symbols whatever the corpus holds, which bounds the
    table of pairs. 0 stands for the end of a text, all digits and all blanks are one.
    """
    out = np.zeros(0x110000, dtype=np.uint16)
    kinds: dict[str, int] = {}
    # beyond these planes nothing is assigned but marks and private use
    out[0x33480:] = 0xC02 + kinds.setdefault("Cn", len(kinds))
    for cp in (*range(0x33480), *range(0xE0000, 0xE0200)):
        if cp < 0x600 or 0x2000 <= cp < 0x2600:
            out[cp] = cp + 1 if cp < 0x600 else cp - 0x2000 + 0x601
        elif 0xD800 <= cp <= 0xF8FF:
            out[cp] = 0xC01
        else:
            out[cp] = 0xC02 + kinds.setdefault(unicodedata.category(chr(cp)), len(kinds))
    out[ord("0") : ord("9") + 1] = out[ord("0")]
    for blank in "\t\n\r":
        out[ord(blank)] = out[ord(" ")]
    out[0xFFFD] = 0xC00
    return out


BASE = 0xC40


def _codes(text: str) -> np.ndarray:
    return symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


def pair_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(pair, count) of adjacent symbols; a pair is first * BASE + second. None across texts."""
    s = _codes("\x00".join(t for t in texts if t))
    if len(s) < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    present = np.flatnonzero(np.bincount(s, minlength=BASE))
    k = len(present)
    place = np.zeros(BASE, dtype=np.int64)
    place[present] = np.arange(k)
    at = place[s]
    dense = np.bincount(at[:-1] * k + at[1:], minlength=k * k).reshape(k, k)
    end = symbols()[0]
    if end in present:
        dense[place[end], :] = 0
        dense[:, place[end]] = 0
    a, b = np.nonzero(dense)
    return present[a] * BASE + present[b], dense[a, b]


class PairModel:
    """Costs of pairs, from their counts over the whole corpus."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        a, b = pairs // BASE, pairs % BASE
        present = np.unique(np.append(np.unique(np.concatenate([a, b])), 0)) if len(pairs) else np.array([0])
        self.index = np.zeros(BASE, dtype=np.int32)
        self.index[present] = np.arange(len(present))
        k = self.k = len(present) + 1
        self.index[np.setdiff1d(np.arange(BASE), present)] = k - 1
        self.cost = np.full(k * k, WORST, dtype=np.float32)
        self.mean = WORST
        if len(pairs):
            n = counts.sum()
            p = counts / n
            left = np.bincount(self.index[a], weights=p, minlength=k)
            right = np.bincount(self.index[b], weights=p, minlength=k)
            info = p * np.log1p(p / (left[self.index[a]] * right[self.index[b]]))
            self.cost[self.index[a] * k + self.index[b]] = np.minimum(-np.log(info), WORST)
            self.mean = float((p * np.minimum(-np.log(info), WORST)).sum())

        self.single = [(w, r, t) for w, r, t, utf8 in mappings() if not utf8]
        self.moved = self._moved(present)

    def _moved(self, present: np.ndarray) -> np.ndarray:
        """For every single-byte mapping, the index that each index's symbol becomes."""
        out = np.tile(np.arange(self.k, dtype=np.int64), (len(self.single), 1))
        to = symbols()
        for i, (_, _, table) in enumerate(self.single):
            for c, d in table.items():
                at = self.index[to[c]]
                if at != self.k - 1 and c < 0x2600:
                    out[i, at] = self.index[to[d]]
        return out

    def codes(self, text: str) -> np.ndarray:
        return self.index[_codes(text)]

    def costs(self, text: str) -> np.ndarray:
        """Cost of each adjacent pair of ``text``."""
        c = self.codes(text)
        return self.cost[c[:-1] * self.k + c[1:]]


def segments(score: np.ndarray, least: float) -> list[tuple[int, int]]:
    """All maximal scoring segments [from, to) of at least ``least``, in order.

    Linear: runs of positive scores are summed first, then joined where joining scores
    more than either part.
    """
    n = len(score)
    if not n:
        return []
    total = np.cumsum(score, dtype=np.float64)
    if (total - np.minimum(np.minimum.accumulate(total), 0.0)).max() < least:
        return []
    up = score > 0
    edges = np.flatnonzero(up[1:] != up[:-1]) + 1
    starts = np.append(0, edges)
    after = np.cumsum(np.add.reduceat(score, starts, dtype=np.float64)).tolist()
    bounds = [*starts.tolist(), n]
    stack: list[tuple[int, int, float, float]] = []
    for i in range(0 if up[0] else 1, len(starts), 2):
        lo, hi, left, right = bounds[i], bounds[i + 1], after[i - 1] if i else 0.0, after[i]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                stack.append((lo, hi, left, right))
                break
            lo, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(lo, hi) for lo, hi, left, right in stack if right - left >= least]


def _scoring(scores: np.ndarray, least: float) -> list[tuple[int, float]]:
    """Rows that have a segment of at least ``least``, as ``segments`` looks first, and the score of their best, highest first."""
    if not scores.shape[1]:
        return []
    total = np.cumsum(scores, axis=1)
    most = (total - np.minimum(np.minimum.accumulate(total, axis=1), 0.0)).max(axis=1)
    return [(i, float(most[i])) for i in np.argsort(-most, kind="stable").tolist() if most[i] >= least]


def _byte_chars(encoding: str) -> list[str | None]:
    """Character of each byte; bytes the encoding lacks give the control of that number, as lenient decoders do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@cache
def mappings() -> list[tuple[str, str, dict[int, int], bool]]:
    """(wrong, right, table, whether right is UTF-8): table maps characters to characters, or to bytes as Latin-1."""
    out = []
    for wrong in _ENCODINGS:
        chars = _byte_chars(wrong)
        to_byte = {ord(c): b for b, c in enumerate(chars) if b >= 0x80}
        if wrong == "cp1252":
            # Latin-1 and its superset together: the controls stand for their own byte
            to_byte |= {b: b for b in range(0x80, 0xA0)} | {ord(c): b for b, c in enumerate(chars) if b >= 0x80}
        for right in _RIGHT:
            if right == wrong or (wrong == "mac-roman" and right != "utf-8"):
                # Western Mac text differs from others in marks only, too little to tell
                continue
            if right == "utf-8":
                # characters that stand for no byte must not look like one
                out.append((wrong, right, {c: 0 for c in range(0x80, 0x100)} | to_byte, True))
            else:
                target = _byte_chars(right)
                out.append((wrong, right, {c: ord(target[b]) for c, b in to_byte.items()}, False))
    return out


_SEQUENCE = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")


def _from_utf8(run: str, to_byte: dict[int, int]) -> tuple[str, np.ndarray, np.ndarray] | None:
    """``run`` with every complete UTF-8 sequence of its bytes replaced, the rest as it is.

    With it, which characters of the old and the new run are concerned. None if no
    sequence is complete.
    """
    as_bytes = run.translate(to_byte)
    if not _SEQUENCE.search(as_bytes):
        return None
    parts, at, n = [], 0, 0
    old, new = np.zeros(len(run), dtype=bool), []
    for m in _SEQUENCE.finditer(as_bytes):
        try:
            c = m.group().encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        lo, hi = m.span()
        parts += (run[at:lo], c)
        old[lo:hi] = True
        new.append(n + lo - at)
        n += lo - at + 1
        at = hi
    if not parts:
        return None
    text = "".join(parts) + run[at:]
    touched = np.zeros(len(text), dtype=bool)
    touched[new] = True
    return text, old, touched


@cache
def _covered() -> np.ndarray:
    """Which characters (below 0x2600) past ASCII each wrong encoding can have made."""
    out = np.zeros((len(_ENCODINGS), 0x2600), dtype=bool)
    for wrong, _, table, utf8 in mappings():
        if utf8:
            out[_ENCODINGS.index(wrong), [x for x, y in table.items() if x < 0x2600 and y]] = True
    return out


#: Letters of Russian text in percent, case aside.
_LETTERS = dict(zip("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", (10.97, 8.45, 8.01, 7.35, 6.7, 6.26, 5.47, 4.73, 4.54, 4.4, 3.49, 3.21, 2.98, 2.81, 2.62, 2.01, 1.9, 1.74, 1.7, 1.65, 1.59, 1.44, 1.21, 0.97, 0.94, 0.73, 0.64, 0.48, 0.36, 0.32, 0.26, 0.04, 0.2), strict=True))
#: Marks and drawing characters that sound text may hold many of.
_MARKS, _DRAWN = "\xa0«»–—…№°“”„‘’‚‹›§©®™±·•∙√■¬", "─│═║┌┐└┘├┤┬┴┼╔╗╚╝╠╣╦╩╬█░▒▓"


@cache
def _fixed_scores() -> tuple[list[tuple[str, str, dict[int, int]]], np.ndarray, np.ndarray]:
    """Single-byte mappings, what each gains at every symbol by the fixed frequencies, and which symbols it changes.

    Letters of ASCII speak against all of them: Western text has its accents among these.
    """
    to = symbols()
    restored = np.full(BASE, -7.5)
    for c, percent in _LETTERS.items():
        restored[to[[ord(c), ord(c.upper())]]] = np.log(percent / 100)
    # marks, drawings and ё are as frequent as letters in some sound text, but no sign of it
    known = restored.copy()
    known[to[[ord(c) for c in _MARKS]]] = -3.0
    known[to[[ord(c) for c in _DRAWN]]] = -2.0
    known[to[[ord(c) for c in "ёЁ"]]] = -2.0
    single = [(w, r, t) for w, r, t, utf8 in mappings() if not utf8]
    gain, changed = np.zeros((len(single), BASE), dtype=np.float32), np.zeros((len(single), BASE), dtype=bool)
    for i, (_, _, table) in enumerate(single):
        for c, d in table.items():
            if c > 0x7F and to[c] != to[d]:
                gain[i, to[c]], changed[i, to[c]] = restored[to[d]] - known[to[c]], True
    gain[:, to[[c for c in range(0x80) if chr(c).isalpha()]]] = -1.0
    return single, gain, changed


@cache
def _sequence_bits() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every symbol the wrong encodings, as bits, in which it leads a UTF-8 letter, continues one, and leads a UTF-8 mark."""
    lead, rest, mark = (np.zeros(BASE, dtype=np.uint8) for _ in range(3))
    for wrong, _, table, utf8 in mappings():
        for c, b in table.items() if utf8 else ():
            if b in (0xC3, 0xD0, 0xD1):
                lead[symbols()[c]] |= 1 << _ENCODINGS.index(wrong)
            elif 0x80 <= b < 0xC0:
                rest[symbols()[c]] |= 1 << _ENCODINGS.index(wrong)
            elif b == 0xE2:
                mark[symbols()[c]] |= 1 << _ENCODINGS.index(wrong)
    return lead, rest, mark


@cache
def _utf8_bits() -> tuple[np.ndarray, np.ndarray]:
    """Of every symbol the wrong encodings, as bits, in which it leads any UTF-8 sequence and continues one."""
    begins, goes_on = (np.zeros(BASE, dtype=np.uint8) for _ in range(2))
    for wrong, _, table, utf8 in mappings():
        for c, b in table.items() if utf8 else ():
            if 0xC2 <= b <= 0xF4:
                begins[symbols()[c]] |= 1 << _ENCODINGS.index(wrong)
            elif 0x80 <= b < 0xC0:
                goes_on[symbols()[c]] |= 1 << _ENCODINGS.index(wrong)
    return begins, goes_on


def _by_fixed_signs(text: str) -> tuple[str, tuple[str, str]] | None:
    """(text with the likeliest stretch restored, mapping) by signs that do not depend on the corpus."""
    s = _codes(text)
    best: tuple[float, int, int, str, str, dict[int, int], bool] | None = None
    lead, rest, mark = _sequence_bits()
    pair = lead[s[:-1]] & rest[s[1:]]
    some = np.count_nonzero(pair) >= SEQUENCES / SEQUENCE / 2
    for wrong, right, table, utf8 in mappings() if some else ():
        at = pair >> _ENCODINGS.index(wrong) & 1 if utf8 else pair[:0]
        if at.sum() < SEQUENCES / SEQUENCE / 2:
            continue
        three = mark[s[:-2]] & rest[s[1:-1]] & rest[s[2:]]
        past = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        score = np.where((past > 0x7F) & (past != 0xFFFD), NO_SEQUENCE, 0.0)
        score[:-1][at > 0] = SEQUENCE
        score[1:][at > 0] = SEQUENCE
        for i in np.flatnonzero(three >> _ENCODINGS.index(wrong) & 1).tolist():
            score[i : i + 3] = SEQUENCE
        for lo, hi in segments(score, SEQUENCES):
            total = float(score[lo:hi].sum())
            if best is None or total > best[0]:
                best = (total, lo, hi, wrong, right, table, True)
    if best is None:
        single, gain, changed = _fixed_scores()
        scores = gain[:, s].astype(np.float64)
        at = len(single)
        for i, most in _scoring(scores, FIXED):
            # of equal ones the first mapping; those that follow can only be lower
            if best is not None and most < best[0] - 1e-6:
                break
            (wrong, right, table), score = single[i], scores[i]
            for lo, hi in segments(score, FIXED):
                total = float(score[lo:hi].sum())
                if best is not None and (total < best[0] or total == best[0] and i >= at):
                    continue
                concerned = s[lo:hi][changed[i][s[lo:hi]]]
                # frequencies tell nothing about a few letters repeated
                if total >= FIXED_EACH * len(concerned) and len(np.unique(concerned)) >= FIXED_LETTERS:
                    best, at = (total, lo, hi, wrong, right, table, False), i
    if best is None:
        return None
    _, lo, hi, wrong, right, table, utf8 = best
    while lo > 0 and not text[lo - 1].isspace():
        lo -= 1
    while hi < len(text) and not text[hi].isspace():
        hi += 1
    if utf8:
        new = _from_utf8(text[lo:hi], table)
        return (text[:lo] + new[0] + text[hi:], (wrong, right)) if new else None
    return text[:lo] + text[lo:hi].translate(table) + text[hi:], (wrong, right)


def best_mapping(run: str, model: PairModel, gain: float = GAIN) -> tuple[str, list[tuple[str, str]]]:
    """(restored run, mappings applied in order); the run itself and none if nothing makes it ordinary."""
    done: list[tuple[str, str]] = []
    seen = {run}
    # as often as it was decoded wrongly; every mapping makes the run cheaper
    while found := _one_mapping(run, model, gain):
        run, how = found
        if run in seen:
            break
        seen.add(run)
        done.append(how)
    return run, done


def _one_mapping(run: str, model: PairModel, gain: float) -> tuple[str, tuple[str, str]] | None:
    if len(run) < 2 or run.isascii():
        return None
    cps = np.frombuffer(run.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbol = symbols()[cps]
    code = model.index[symbol].astype(np.int64)
    k = model.k
    both = code[:-1] * k + code[1:]
    each = model.cost[both]
    covered = _covered()[:, np.minimum(cps[cps > 0x7F], 0x25FF)].mean(axis=1) >= COVER
    likely = {w for w, yes in zip(_ENCODINGS, covered.tolist(), strict=True) if yes}
    best: tuple[float, str, str, str | None, dict | None] | None = None

    begins, goes_on = _utf8_bits()
    sequences = int(np.bitwise_or.reduce(begins[symbol[:-1]] & goes_on[symbol[1:]]))
    for wrong, right, table, utf8 in mappings():
        tried = _from_utf8(run, table) if utf8 and wrong in likely and sequences >> _ENCODINGS.index(wrong) & 1 else None
        if tried is None:
            continue
        new, old_at, new_at = tried
        once = model.costs(new)
        again = _from_utf8(new, table)
        if again is not None:
            # decoded wrongly twice: what is left half way is no cheaper
            then = model.costs(again[0])
            saved = float(each.sum() - then.sum())
            if len(then) and saved >= gain and min(each.mean(), once.mean()) - then.mean() >= 0.5 and (best is None or saved > best[0]):
                best = (saved, wrong, right, again[0], None)
                continue
        was, then = each[old_at[:-1] | old_at[1:]], once[new_at[:-1] | new_at[1:]]
        if not len(then):
            continue
        saved = float(was.sum() - then.sum())
        # a complete UTF-8 sequence is evidence in itself: it suffices that no dearer pairs come of it
        if saved >= gain and then.mean() <= was.mean() and (best is None or saved > best[0]):
            best = (saved, wrong, right, new, None)

    rows = [i for i, (wrong, _, _) in enumerate(model.single) if wrong in likely]
    if rows:
        # all single-byte mappings at once, over the distinct pairs of the run
        pairs, where, counts = np.unique(both, return_inverse=True, return_counts=True)
        a, b = pairs // k, pairs % k
        now = model.cost[pairs]
        x, y = model.moved[rows][:, a], model.moved[rows][:, b]
        costs = model.cost[x * k + y]
        changed = (x != a) | (y != b)
        n = (counts * changed).sum(axis=1)
        delta = np.where(changed, now - costs, 0.0)
        saved_all = (delta * counts).sum(axis=1)
        then_all = (np.where(changed, costs, 0.0) * counts).sum(axis=1)
        up = (np.maximum(delta, 0.0) * counts).sum(axis=1)
        for i in np.argsort(-up).tolist():
            if not n[i] or up[i] < gain:
                continue
            saved, after, most = float(saved_all[i]), float(then_all[i] / n[i]), model.mean + ORDINARY
            before = after + saved / n[i]
            if (before - after < GAIN_EACH or after > most) and up[i] >= GAIN_PART:
                # sound text around the garbled part hides what the mapping saves
                part = segments(delta[i][where], GAIN_PART)
                inside = np.concatenate([where[lo:hi] for lo, hi in part]) if part else np.zeros(0, dtype=np.int64)
                inside = inside[changed[i][inside]]
                if len(inside):
                    saved, before, after = float(delta[i][inside].sum()), float(now[inside].mean()), float(costs[i][inside].mean())
                    most = model.mean + ORDINARY_PART
            if saved >= gain and before - after >= GAIN_EACH and after <= most and (best is None or saved > best[0]):
                wrong, right, table = model.single[rows[i]]
                best = (saved, wrong, right, None, table)
    if best is None:
        return None
    _, wrong, right, new, table = best
    if new is None:
        # the run may reach into sound text
        new = _where_cheaper(run, run.translate(table), model)
    return new, (wrong, right)


def runs(text: str, costs: np.ndarray) -> list[tuple[int, int]]:
    """Character spans of the improbable runs, joined when near, grown to the blanks around."""
    score = costs - RARE
    found = [(lo, hi, float(score[lo:hi].sum()) >= SEGMENT) for lo, hi in segments(score, EXTEND)]
    found += [(lo, hi, True) for lo, hi in segments(costs - MILD, MILD_SEGMENT)]
    if not any(strong for _, _, strong in found):
        return []
    spans: list[list[int]] = []
    for lo, hi, strong in sorted(found):
        if spans and lo - spans[-1][1] <= JOIN:
            spans[-1][1] = max(spans[-1][1], hi + 1)
            spans[-1][2] |= strong
        else:
            spans.append([lo, hi + 1, strong])
    out: list[tuple[int, int]] = []
    for lo, hi, strong in spans:
        if not strong:
            continue
        while lo > 0 and not text[lo - 1].isspace():
            lo -= 1
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def suspects(texts: list[str | None], model: PairModel) -> np.ndarray:
    """Which texts have a segment to look at: one pass over all of them at once."""
    out = np.zeros(len(texts), dtype=bool)
    at = [i for i, t in enumerate(texts) if t and len(t) > 1]
    if not at:
        return out
    s = _codes("\x00".join(texts[i] for i in at))
    code = model.index[s]
    costs = model.cost[code[:-1] * model.k + code[1:]]
    sizes = np.array([len(texts[i]) + 1 for i in at])
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    for rare, least in ((RARE, SEGMENT), (MILD, MILD_SEGMENT)):
        score = costs.astype(np.float64) - rare
        # a text's end costs more than any segment gains, so none crosses it
        breaks = np.concatenate([ends[:-1] - 1, ends[:-1]])
        score[breaks] = -20.0 * (sizes.max() + 1)
        total = np.cumsum(score)
        gain = total - np.minimum.accumulate(np.append(0.0, total[:-1]))
        out[np.array(at)] |= np.maximum.reduceat(gain, np.minimum(starts, len(gain) - 1)) >= least
    out[np.array(at)] |= _signs(s, starts, sizes)
    return out


def _signs(s: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of the texts in ``s`` show signs that do not depend on the corpus."""
    lead, rest, _ = _sequence_bits()
    pair = np.append(lead[s[:-1]] & rest[s[1:]], 0) != 0
    out = np.add.reduceat(pair, starts, dtype=np.int64) >= SEQUENCES / SEQUENCE / 2
    # windows begin with their text, so none holds two texts
    windows = -(-sizes // WINDOW)
    of = np.repeat(np.arange(len(starts)), windows)
    first = np.cumsum(windows) - windows
    edges = starts[of] + (np.arange(len(of)) - first[of]) * WINDOW
    gain = _fixed_scores()[1]
    # what the best mapping of each symbol gains rules most windows out, and texts that are suspect already are
    edges = np.minimum(edges, len(s) - 1)
    left = (np.add.reduceat(gain.max(axis=0)[s], edges) >= WINDOW_LEAST - 1e-3) & ~out[of]
    if not left.any():
        return out
    lengths = np.diff(np.append(edges, len(s)))
    s, lengths = s[np.repeat(left, lengths)], lengths[left]
    edges = np.cumsum(lengths) - lengths
    high = np.zeros(len(edges), dtype=bool)
    for each in gain:
        high |= np.add.reduceat(each[s], edges) >= WINDOW_LEAST
    out[of[left][high]] = True
    return out


def restore(text: str, model: PairModel) -> tuple[str, list[tuple[str, str]]]:
    """(restored text, mappings that restored runs of it)."""
    if len(text) < 2:
        return text, []
    outright: list[tuple[str, str]] = []
    # a text may be garbled in several stretches, each of them several times
    seen = {text}
    while found := _by_fixed_signs(text):
        if found[0] in seen:
            break
        text = found[0]
        seen.add(text)
        outright.append(found[1])
    parts, at, done = [], 0, []
    for lo, hi in runs(text, model.costs(text)):
        new, how = best_mapping(text[lo:hi], model)
        if how:
            parts += (text[at:lo], new)
            at = hi
            done += how
    text = "".join(parts) + text[at:]
    for wrong, right in dict.fromkeys(done):
        # what a single-byte mapping changes is sparse in some texts: the rest of them
        table = next((t for w, r, t, utf8 in mappings() if (w, r) == (wrong, right) and not utf8), None)
        if table:
            text = _where_cheaper(text, text.translate(table), model)
    return text, outright + done


def _where_cheaper(text: str, new: str, model: PairModel) -> str:
    """``text`` with those stretches of ``new``, character for character, that cost less."""
    parts, at = [], 0
    for lo, hi in segments(model.costs(text) - model.costs(new), EXTEND):
        parts += (text[at:lo], new[lo : hi + 1])
        at = hi + 1
    return "".join(parts) + text[at:]


#: Marks that a decoder leaves where characters were lost.
_LOST = re.compile("[\x80-\x84\x86-\x9f\ufffd]")


def lost(text: str, model: PairModel) -> bool:
    """Whether an improbable run of the text holds marks of lost characters that aren't a lone one in sound text.

    Either it holds several of them, or its other pairs are improbable too.
    """
    if not _LOST.search(text):
        return False
    costs = model.costs(text)
    for lo, hi in runs(text, costs):
        marks = [m.start() for m in _LOST.finditer(text, lo, hi)]
        if len(marks) >= LOST_MARKS:
            return True
        if marks:
            other = np.maximum(costs[lo : max(lo, hi - 1)] - RARE, 0.0)
            for m in marks:
                other[max(0, m - 1 - lo) : m + 1 - lo] = 0.0
            if other.sum() >= LOST_SCORE:
                return True
    return False


def corpus_pairs(df: DataFrame, *, text: str) -> DataFrame:
    """``pair, n``: adjacent symbol pairs of all texts, counted per batch before the shuffle.

    At most ``BASE`` squared rows (9.8 million) whatever the corpus, some thousands in
    practice. Null and empty texts have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = pair_counts(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int32)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    return df.select(F.col(text).cast("string").alias("t")).where("t is not null and t <> ''").mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def find_garbled(df: DataFrame, *, id: str, text: str) -> DataFrame:
    """Garbled rows: ``id``, ``restored`` text, ``mappings`` applied (wrong>right, in order).

    Statistics come from all rows of ``df``. A row that only shows that characters were
    lost has null ``restored`` and no mappings. Null, empty and blank texts, foreign
    letters, symbols and drawn tables as such are no case; repeated rows are found as
    often as they occur. An empty table gives an empty result.
    """
    table = corpus_pairs(df, text=text).toPandas()
    shared = df.sparkSession.sparkContext.broadcast((table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PairModel(*shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column(1).to_pylist()
                at, restored, how = [], [], []
                for i, suspect in enumerate(suspects(texts, model)):
                    done = []
                    if suspect:
                        new, done = restore(texts[i], model)
                    if done:
                        how.append([f"{w}>{r}" for w, r in done])
                        restored.append(new)
                    elif suspect and lost(texts[i], model):
                        how.append([])
                        restored.append(None)
                    else:
                        continue
                    at.append(i)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array(restored, pa.string()), pa.array(how, pa.list_(pa.string()))], names=["id", "restored", "mappings"])

    schema = T.StructType([T.StructField("id", df.schema[id].dataType), T.StructField("restored", T.StringType()), T.StructField("mappings", T.ArrayType(T.StringType()))])
    return df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id)
