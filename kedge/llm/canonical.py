"""One form for texts that look the same.

A text is left alone unless a quick check finds a character that is not stable: one
whose compatibility decomposition looks the same (full width, special blanks), a
combining mark, a character that cannot be seen, or a letter of another script
inside a word. The check is one regular expression evaluated in the JVM; only texts
that fail it reach Python. There each unstable segment is cut out with the boundary
context it can combine with (back to the preceding starter, on to the next), that
segment alone is normalised, and the result is spliced into the unchanged rest.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that look like a Cyrillic letter.
LATIN_ALIKE = {
    "A": "А", "B": "В", "C": "С", "E": "Е", "H": "Н", "K": "К", "M": "М", "O": "О", "P": "Р", "T": "Т", "X": "Х", "Y": "У",
    "a": "а", "b": "в", "c": "с", "e": "е", "h": "н", "k": "к", "m": "м", "o": "о", "p": "р", "t": "т", "x": "х", "y": "у",
}
GREEK_ALIKE = {
    "Α": "А", "Β": "В", "Ε": "Е", "Η": "Н", "Κ": "К", "Μ": "М", "Ν": "Н", "Ο": "О", "Ρ": "Р", "Τ": "Т", "Υ": "У", "Χ": "Х", "Ϲ": "С",
    "α": "а", "β": "в", "ε": "е", "η": "н", "κ": "к", "μ": "м", "ν": "н", "ο": "о", "ρ": "р", "τ": "т", "υ": "у", "χ": "х", "ϲ": "с",
}
#: Small capitals, Armenian letters and others that look like a Cyrillic one.
OTHER_ALIKE = {"ɑ": "а", "ʙ": "в", "ʜ": "н", "ᴀ": "а", "ᴄ": "с", "ᴇ": "е", "ᴋ": "к", "ᴍ": "м", "ᴏ": "о", "ᴛ": "т", "ᴦ": "г", "ᴨ": "п", "ᴫ": "л", "օ": "о", "Օ": "О"}
#: Cyrillic letters that Russian lacks and that look like a Latin one.
CYRILLIC_ALIKE = {"І": "I", "і": "i", "Ѕ": "S", "ѕ": "s", "Ј": "J", "ј": "j", "Ӏ": "I", "ӏ": "l", "ԁ": "d", "Ԛ": "Q", "ԛ": "q", "Ԝ": "W", "ԝ": "w", "һ": "h"}
#: Marks that look like an ASCII one (or a dash) and have no decomposition.
MARK_ALIKE = {"‐": "-", "‑": "-", "−": "-", "‒": "–", "―": "—", "⁃": "-", "˗": "-", "ʼ": "'", "׳": "'", "ʹ": "'", "∕": "/", "⁄": "/", "∶": ":", "ꞏ": "·"}
# End of fixed values.

ALIKE = LATIN_ALIKE | GREEK_ALIKE | OTHER_ALIKE
_TO_CYRILLIC = str.maketrans(ALIKE)
_TO_LATIN = str.maketrans({c: x for x, c in LATIN_ALIKE.items()} | {g: next(x for x, y in LATIN_ALIKE.items() if y == c) for g, c in GREEK_ALIKE.items()})
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>")
_KEPT_CONTROLS = "\t\n\r"
_LOOSE = re.compile("[\u0300-\u036f\u0483-\u0487]")


def _unstable(ch: str) -> bool:
    kind = ud.category(ch)
    if kind == "Cf" or kind == "Mn" or (kind == "Cc" and ch not in _KEPT_CONTROLS) or ch in MARK_ALIKE or ch in CYRILLIC_ALIKE:
        return True
    if kind == "Zs":
        return ch != " "
    parts = ud.decomposition(ch)
    if not parts:
        return False
    if parts.startswith(_SAME_LOOK):
        return True
    if parts.startswith("<"):
        return parts.startswith("<compat>") and kind[0] == "L"
    return ud.normalize("NFC", ch) != ch


@cache
def unstable_class() -> str:
    """Body of a character class of all unstable characters, from the Unicode database."""
    spans: list[list[int]] = []
    for cp in range(0x80, 0x110000):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xF8FF or 0xE0000 > cp > 0x2FA1D or 0x2EBE0 > cp >= 0x20000:
            continue
        if _unstable(chr(cp)):
            if spans and spans[-1][1] == cp - 1:
                spans[-1][1] = cp
            else:
                spans.append([cp, cp])
    low = "\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f"
    return low + "".join(f"{_esc(a)}-{_esc(b)}" if a != b else _esc(a) for a, b in spans)


def _esc(cp: int) -> str:
    return chr(cp) if cp > 0xFFFF else f"\\u{cp:04x}"


_GREEK, _CYR, _LATIN = "Ͱ-Ͽ", "Ѐ-ӿ", "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u02af\\u0531-\\u0587\\u1d00-\\u1d2b\\u1e00-\\u1eff"
_FOREIGN = _LATIN + _GREEK
_BETWEEN = "0-9\\u0300-\\u036f"
_WORD = f"[{_FOREIGN}{_CYR}{_BETWEEN}]"


def _as(table: dict[int, str], w: str) -> str:
    """A word with its letters, accents apart, in another script."""
    return ud.normalize("NFC", ud.normalize("NFD", w).translate(table))


_ACCENTED = [c for c in map(chr, range(0xC0, 0x400)) if len(x := _as(_TO_CYRILLIC, c)) == 1 and "Ѐ" <= x <= "ӿ"]
_LIKE = "".join(dict.fromkeys([*ALIKE, *_ACCENTED]))
#: Stable characters of most texts, tested before the long class.
_COMMON = "\\t\\n\\r -~А-яЁё«»–—"


@cache
def quick_check() -> str:
    """Regular expression, valid in Java and Python, that finds a cause to normalise."""
    pairs = ((_CYR, _FOREIGN), (_FOREIGN, _CYR), (_LATIN, _GREEK), (_GREEK, _LATIN))
    mixed = "|".join(f"[{x}][{_BETWEEN}]*[{y}]" for x, y in pairs)
    alone = f"(?<!{_WORD})[{_LIKE}0-9]*[{_LIKE}][{_LIKE}0-9]*(?!{_WORD})"
    return f"(?=[^{_COMMON}])[{unstable_class()}]|{mixed}|{alone}"


@cache
def _compiled() -> tuple[re.Pattern, re.Pattern]:
    unstable = re.compile(f"(?:(?=[^{_COMMON}])[{unstable_class()}])+")
    word = re.compile(f"{_WORD}*[{_FOREIGN}]{_WORD}*")
    return unstable, word


def _fold(segment: str) -> str:
    out = []
    for ch in segment:
        kind = ud.category(ch)
        if ch in MARK_ALIKE or ch in CYRILLIC_ALIKE:
            out.append(MARK_ALIKE.get(ch) or CYRILLIC_ALIKE[ch])
        elif kind == "Zs":
            out.append(" ")
        elif kind == "Cf" or (kind == "Cc" and ch not in _KEPT_CONTROLS):
            continue
        else:
            parts = ud.decomposition(ch)
            if parts.startswith(_SAME_LOOK) or (parts.startswith("<compat>") and kind[0] == "L"):
                out.append(ud.normalize("NFKC", ch))
            else:
                out.append(ch)
    # what is left of the accents of Latin, Greek and Cyrillic letters belongs to no letter
    return _LOOSE.sub("", ud.normalize("NFC", "".join(out)))


def _word(m: re.Match, cyrillic_text: bool, capitals: bool) -> str:
    w = m.group()
    letters = [c for c in ud.normalize("NFD", w) if c.isalpha()]
    plain = [c for c in letters if c not in ALIKE and not "Ѐ" <= c <= "ӿ"]
    cyrillic = any("Ѐ" <= c <= "ӿ" for c in letters)
    if plain:
        if cyrillic or any(c in GREEK_ALIKE for c in letters):
            latin = _as(_TO_LATIN, w)
            if all(c.isascii() for c in plain) and not any("Ͱ" <= c <= "ӿ" for c in latin):
                return latin
            return _LOOSE.sub("", _as(_TO_CYRILLIC, w)) if cyrillic else w
        return w
    if not cyrillic and not capitals and len(letters) > 1 and len(letters) == len(w) and w.isascii() and w.isupper():
        return w  # an abbreviation, unless the whole text is in capitals
    # nothing but look-alikes: the text decides, if it has letters with such accents
    new = _as(_TO_CYRILLIC, w)
    if cyrillic:
        return _LOOSE.sub("", new)
    return new if cyrillic_text and not any(ud.combining(c) for c in new) else w


def canonical(text: str | None) -> str | None:
    """The one form of ``text``; null stays null, and an empty text empty.

    Idempotent. A text of any length is processed whole, in linear time.
    """
    if not text:
        return text
    unstable, word = _compiled()
    parts, at = [], 0
    for m in unstable.finditer(text):
        # the character before the run is the starter its marks compose with
        start = max(m.start() - 1, at)
        parts += (text[at:start], _fold(text[start : m.end()]))
        at = m.end()
    if parts:
        text = "".join(parts) + text[at:]
    cyrillic = [c for c in text if "Ѐ" <= c <= "ӿ"]
    capitals = len(cyrillic) > 3 and all(c.isupper() for c in cyrillic)
    return word.sub(lambda m: _word(m, bool(cyrillic), capitals), text)


@F.pandas_udf(T.StringType())
def _canonical_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(canonical, na_action="ignore")


def canonical_text(c: Column) -> Column:
    """``canonical`` of every value; stable values don't leave the JVM's row but pass as null."""
    suspect = F.when(c.rlike(quick_check()), c)
    return F.coalesce(_canonical_udf(suspect), c)


def irregular(df: DataFrame, *, text: str, into: str = "canonical") -> DataFrame:
    """Rows of ``df`` whose ``text`` is not in canonical form, with that form in ``into``.

    Null and empty texts are in form. Repeated rows stay repeated; a column of
    ``df`` named ``into`` is replaced.
    """
    suspects = df.where(F.col(text).rlike(quick_check()))
    return suspects.withColumn(into, _canonical_udf(F.col(text))).where(~F.col(into).eqNullSafe(F.col(text)))
