"""Pieces of SQL, for DuckDB, that say what the text and likeness functions compute.

Written from the definitions, not from the Spark code: Unicode folding is a table of
code points generated from the Unicode database, likeness is a fold over the characters of
one text with the positions of the other as bits.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from itertools import permutations

from kedge.functions import text as tx

_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: Bits of a word, and words a text of the left side may need.
BITS, WORDS = 120, 3


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@cache
def _compatible() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters with a compatibility form of one character, those forms, and those with a longer one (up to U+33FF)."""
    frm, to, more = [], [], []
    for cp in [*range(0xA0, 0x3400), *range(0xF900, 0xFFF0)]:
        ch = chr(cp)
        new = unicodedata.normalize("NFKC", ch)
        if new == ch or unicodedata.normalize("NFC", ch) != ch:
            continue
        if len(new) == 1:
            frm.append(ch)
            to.append(new)
        elif cp < 0x2100 or cp in (0x2116, 0x2122):
            more.append((ch, new))
    return "".join(frm), "".join(to), tuple(more)


def nfkc(x: str) -> str:
    frm, to, more = _compatible()
    for a, b in more:
        x = f"replace({x}, {_q(a)}, {_q(b)})"
    return f"nfc_normalize(translate({x}, {_q(frm)}, {_q(to)}))"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, {_q(_BLANK)}, ' ', 'g'), ' ')"


def folded(x: str) -> str:
    frm, to = "".join(tx.TYPOGRAPHY), "".join(tx.TYPOGRAPHY.values())
    return squeeze(f"replace(translate(replace(lower({nfkc(x)}), 'ß', 'ss'), {_q(frm + 'ё')}, {_q(to + 'е')}), chr(173), '')")


def compared(x: str) -> str:
    return f"rtrim({folded(x)}, {_q(tx.TRAILING)})"


def rejoined(x: str, hyphen: str) -> str:
    # the letter before is kept, and so is the one after, which RE2 can't look ahead for
    return f"regexp_replace(regexp_replace({x}, '([а-яёА-ЯЁ])-\\s*\\n([а-яёА-ЯЁ])', '\\1{hyphen}\\2', 'g'), '([а-яёА-ЯЁ])-\\s*\\n([а-яёА-ЯЁ])', '\\1{hyphen}\\2', 'g')"


def variants(x: str) -> str:
    """Up to three readings, in order, each once."""
    a, b, c = compared(x), compared(rejoined(x, "")), compared(rejoined(x, "-"))
    return f"(SELECT CASE WHEN v.b = v.a AND v.c = v.a THEN [v.a] WHEN v.b = v.a THEN [v.a, v.c] WHEN v.c = v.a OR v.c = v.b THEN [v.a, v.b] ELSE [v.a, v.b, v.c] END FROM (SELECT {a} AS a, {b} AS b, {c} AS c) v)"


def unwrapped(x: str) -> str:
    return squeeze(f"regexp_replace(regexp_replace({x}, '([\\p{{L}}\\p{{N}}_])-\\s*([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), '([\\p{{L}}\\p{{N}}_])-\\s*([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g')")


def words(x: str) -> str:
    return squeeze(f"regexp_replace({unwrapped(f'lower({nfkc(x)})')}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')")


def cased(x: str) -> str:
    return f"rtrim({unwrapped(nfkc(x))}, {_q(tx.TRAILING)})"


_RUNS = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+"


def topic(x: str) -> str:
    table = tx.TYPOGRAPHY | tx.TYPOGRAPHY_MORE | {"ё": "е"}
    frm, to = "".join(table), "".join(table.values())
    base = squeeze(f"replace(translate(replace(lower({nfkc(x)}), 'ß', 'ss'), {_q(frm)}, {_q(to)}), chr(173), '')")
    base = f"rtrim(regexp_replace({base}, '[?!.…;:]+(\\s*)$', '\\1'), ' ')"
    look, like = "".join(tx.HOMOGLYPHS), "".join(tx.HOMOGLYPHS.values())
    one = f"CASE WHEN regexp_full_match(w, '[a-zа-я]{{1,3}}') AND regexp_matches(w, '[a-z]') THEN translate(w, {_q(look)}, {_q(like)}) ELSE w END"
    return squeeze(f"coalesce(array_to_string(list_transform(regexp_extract_all({base}, {_q(_RUNS)}), lambda w: {one}), ''), '')")


_TOKEN = "\\d+[.,]\\d+[\\p{L}\\p{N}_]*|[\\p{L}\\p{N}_]+"


def _lexicon(lexicon: str) -> str:
    return lexicon.replace("\\w*", "[\\p{L}\\p{N}_]*")


def critical(x: str, lexicon: str = tx.NEGATION_LEXICON, marks: str = "") -> str:
    """List of numbers, words of the lexicon and marks, in order."""
    token = f"{_TOKEN}|[{marks}]" if marks else _TOKEN
    keep = f"regexp_full_match(w, {_q('(?:' + _lexicon(lexicon) + ')' + (f'|[{marks}]' if marks else ''))})"
    numbers = "regexp_extract_all(w, '\\d+(?:[.,]\\d+)?')"
    return f"flatten(list_transform(regexp_extract_all({x}, {_q(token)}), lambda w: CASE WHEN {keep} THEN [w] ELSE {numbers} END))"


def needs_picture(text: str, answers: str, *, narrow: bool = False) -> str:
    label = "^[а-яa-z0-9)()., /-]{1,12}$"
    test = f"regexp_matches(a, {_q(label)})"
    if narrow:
        plain = ", ".join(_q(p) for p in tx.PLAIN_LABELS)
        test = f"a NOT IN ({plain}) AND regexp_matches(a, '^[а-яa-z0-9]{{1,3}}(?:[)()., /-]+[а-яa-z0-9]{{1,3}})*[)()., /-]*$')"
    return f"(coalesce(regexp_matches({text}, {_q(tx.PICTURE_LEXICON)}), false) OR coalesce(len({answers}) > 0 AND len(list_filter({answers}, lambda a: {test})) = len({answers}), false))"


_FULL = f"((1::HUGEINT << {BITS}) - 1)"


def _places(t: str, alphabet: str, word: int) -> str:
    """Of each letter of the alphabet the places in ``t`` that fall into a word, as bits."""
    lo = word * BITS
    bits = f"list_transform(list_filter(range({lo + 1}, least(length({t}), {lo + BITS})::BIGINT + 1), lambda i: substr({t}, i, 1) = c), lambda i: 1::HUGEINT << (i - {lo + 1})::INT)"
    return f"list_transform(string_split({alphabet}, ''), lambda c: coalesce(list_sum({bits}), 0)::HUGEINT)"


def ratios(name: str, left: str, right: str, pairs: str = "", words_of: int = WORDS) -> str:
    """CTEs ``name``(lt, rt, q100): indel ratio of all pairs of the texts (t) of two CTEs, or of those of ``pairs`` (lt, rt)."""
    w = range(words_of)
    state = "{" + ", ".join(f"'w{i}': {_FULL}" for i in w) + "}"
    letters = "{" + ", ".join(f"'w{i}': l.p{i}[k]" for i in w) + "}"
    steps, carry = [], ""
    for i in w:
        total = f"(v.w{i} + (v.w{i} & m.w{i}){carry})"
        steps.append(f"'w{i}': ({total} & {_FULL}) | (v.w{i} & ~m.w{i})")
        carry = f" + ({total} >> {BITS})"
    common = " + ".join(f"bit_count(~x.v.w{i} & {_FULL})::BIGINT" for i in w)
    tables = f"""{name}_a AS (SELECT coalesce(string_agg(c, '' ORDER BY c), '') AS s FROM (SELECT DISTINCT unnest(string_split(t, '')) AS c FROM {left} UNION SELECT DISTINCT unnest(string_split(t, '')) FROM {right})),
 {name}_l AS MATERIALIZED (SELECT t, {", ".join(f"{_places('t', 'a.s', i)} AS p{i}" for i in w)} FROM (SELECT DISTINCT t FROM {left}) q, {name}_a a),
 {name}_r AS MATERIALIZED (SELECT t, list_transform(string_split(t, ''), lambda c: strpos(a.s, c)::INT) AS codes FROM (SELECT DISTINCT t FROM {right}) q, {name}_a a),
"""
    source = f"(SELECT DISTINCT lt, rt FROM {pairs}) p JOIN {name}_l l ON l.t = p.lt JOIN {name}_r r ON r.t = p.rt" if pairs else f"{name}_l l, {name}_r r"
    fold = f"list_reduce(list_transform(r.codes, lambda k: {letters}), lambda v, m: {{{', '.join(steps)}}}, {state})"
    return tables + f""" {name} AS MATERIALIZED (SELECT lt, rt, CASE WHEN length(lt) + length(rt) = 0 THEN 100.0 WHEN length(lt) = 0 OR length(rt) = 0 THEN 0.0 ELSE 100.0 * 2 * ({common}) / (length(lt) + length(rt)) END::DOUBLE AS q100
  FROM (SELECT l.t AS lt, r.t AS rt, {fold} AS v FROM {source}) x)"""


def assignments(name: str, pairs: str, *, greedy: bool, most: int) -> str:
    """CTEs ``name``(la, ra, a, o): how well the answers of distinct (la, ra) of ``pairs`` fit, best or greedily, and in their order."""
    rows = ", ".join(f"({n}, {list(p)})" for n in range(1, 6) for p in permutations(range(1, n + 1)))
    both = f"{name}_p AS MATERIALIZED (SELECT DISTINCT la, ra FROM {pairs}), {name}_x AS (SELECT DISTINCT lt, rt FROM (SELECT unnest(la) AS lt, ra FROM {name}_p), unnest(ra) AS u(rt))"
    cells = f"{name}_lt AS (SELECT DISTINCT lt AS t FROM {name}_x), {name}_rt AS (SELECT DISTINCT rt AS t FROM {name}_x), {ratios(name + '_q', name + '_lt', name + '_rt', name + '_x', 1)}"
    order = f"""{name}_z AS (SELECT la, ra, sum(q100 / 100) / greatest(len(la), len(ra)) AS o FROM (SELECT la, ra, unnest(range(1, least(len(la), len(ra)) + 1)) AS i FROM {name}_p) z JOIN {name}_q q ON q.lt = la[i] AND q.rt = ra[i] GROUP BY la, ra),
 {name}_s AS (SELECT la, ra, sum(q100 / 100) / greatest(len(la), len(ra)) AS o FROM (SELECT la, ra, unnest(range(1, least(len(la), len(ra)) + 1)) AS i FROM {name}_p WHERE len(la) <> len(ra) OR len(la) > {most}) z JOIN {name}_q q ON q.lt = list_sort(la)[i] AND q.rt = list_sort(ra)[i] GROUP BY la, ra)"""
    tried = f"{name}_t AS (SELECT la, ra, p, sum(v ORDER BY i) / len(la) AS score, list({{'v': -v, 'p': p[i]}} ORDER BY i) AS way FROM (SELECT la, ra, p, i, q100 / 100 AS v FROM (SELECT la, ra, p, unnest(range(1, n + 1)) AS i FROM {name}_p JOIN (VALUES {rows}) perm(n, p) ON n = len(la) AND n = len(ra)) z JOIN {name}_q q ON q.lt = la[i] AND q.rt = ra[p[i]]) GROUP BY la, ra, p)"
    best = f"{name}_b AS (SELECT la, ra, {'arg_min(score, way)' if greedy else 'max(score)'} AS a FROM {name}_t GROUP BY la, ra)"
    none = "1.0" if greedy else "0.0"
    out = f"{name} AS MATERIALIZED (SELECT p.la, p.ra, CASE WHEN len(p.la) = 0 AND len(p.ra) = 0 THEN {none} ELSE coalesce(b.a, s.o, 0.0) END AS a, coalesce(z.o, 0.0) AS o FROM {name}_p p LEFT JOIN {name}_b b ON b.la = p.la AND b.ra = p.ra LEFT JOIN {name}_s s ON s.la = p.la AND s.ra = p.ra LEFT JOIN {name}_z z ON z.la = p.la AND z.ra = p.ra)"
    return ",\n ".join([both, cells, order, tried, best, out])
