"""Text normalisation profiles and ordered lexical evidence.

Spark has no Unicode normalisation, so NFC, NFKC and case folding are Arrow pandas
UDFs that pass text which can't change straight through; everything after them is a
built-in expression. Null gives null, empty text gives empty text, in every function.
Lexicons are parameters; the defaults are those of the corpus this was built for.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# They decide which texts count as equal.
TYPOGRAPHY = {"«": '"', "»": '"', "“": '"', "”": '"', "–": "-", "—": "-"}
TYPOGRAPHY_MORE = {"„": '"', "‑": "-"}
SOFT_HYPHEN = "­"
TRAILING = " .?!;:…"
TERMINAL = "[?!.…;:]+(?=\\s*$)"
HOMOGLYPHS = {"a": "а", "c": "с", "e": "е", "o": "о", "p": "р", "x": "х", "y": "у", "k": "к", "m": "м", "t": "т", "b": "в", "h": "н"}
NEGATION_LEXICON = "не|нет|нельзя|запрещается|разрешается|лев\\w*|прав\\w*|верх\\w*|ниж\\w*|увелич\\w*|уменьш\\w*"
WIDE_LEXICON = (
    "не|ни|нет|нельзя|без|запре\\w*|разреш\\w*|допус\\w*|лев\\w*|прав\\w*|влев\\w*|вправ\\w*|слева|справа|"
    "верх\\w*|ниж\\w*|вверх\\w*|вниз\\w*|увелич\\w*|уменьш\\w*|положит\\w*|отрицат\\w*|"
    "гидроцикл\\w*|парусн\\w*|моторн\\w*|швертбот\\w*|катер\\w*|яхт\\w*|особ\\w*|конструкц\\w*|воздушн\\w*|подушк\\w*|"
    "ввп|вп|мп|морск\\w*|территориальн\\w*|внутренн\\w*|речн\\w*|порт\\w*|фарватер\\w*|шлюз\\w*|судоходн\\w*|"
    "км|м|см|мм|кг|квт|л\\.с|узл\\w*|метр\\w*|секунд\\w*|минут\\w*|час\\w*"
)
SIGNATURE_LEXICON = (
    "не|нет|нельзя|запрещается|разрешается|лев\\w*|прав\\w*|слева|справа|верх\\w*|ниж\\w*|увелич\\w*|уменьш\\w*|"
    "положит\\w*|отрицат\\w*|гидроцикл\\w*|парусн\\w*|моторн\\w*|швертбот\\w*|катер\\w*|яхт\\w*|"
    "особ\\w*\\s+конструкц\\w*|воздушн\\w*\\s+подушк\\w*"
)
PICTURE_LEXICON = "рисунк|иллюстрац|изображ|показан|на схем|обозначен|этих судов"
PLAIN_LABELS = ("да", "нет", "все")
TITLE_SUFFIX = "ммс|мпс|гд|с|ввп|вп|мп"
# End of fixed values.

_NUMBER = r"\d+(?:[.,]\d+)?"
#: Letters, digits and the underscore; the JVM's own class of word characters also has marks and joiners.
_LETTER = r"\p{L}\p{N}_"


def _udf(f: Callable[[str], str]):
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(f, na_action="ignore")

    return run


_nfc = _udf(lambda s: s if unicodedata.is_normalized("NFC", s) else unicodedata.normalize("NFC", s))
_nfkc = _udf(lambda s: s if s.isascii() else unicodedata.normalize("NFKC", s))
_nfkc_fold = _udf(lambda s: unicodedata.normalize("NFKC", s).casefold())


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\s\u001c-\u001f\u0085   -     　]+", " "))


def nfc_text(c: Column) -> Column:
    """NFC and single blanks."""
    return squeeze(_nfc(c))


def typographic(c: Column) -> Column:
    """Quotes, dashes and soft hyphens in one form; ё as е."""
    frm, to = "ё" + "".join(TYPOGRAPHY), "е" + "".join(TYPOGRAPHY.values())
    return F.translate(c, frm + SOFT_HYPHEN, to)


def folded_text(c: Column) -> Column:
    """NFKC, case folded, one typography, single blanks; numbers and punctuation stay."""
    return squeeze(typographic(_nfkc_fold(c)))


def comparison_text(c: Column) -> Column:
    """``folded_text`` without trailing punctuation."""
    return F.rtrim(folded_text(c), F.lit(TRAILING))


def rejoined(c: Column, hyphen: str) -> Column:
    """Hyphens at line ends between Cyrillic letters replaced by ``hyphen``."""
    return F.regexp_replace(c, r"(?<=[а-яёА-ЯЁ])-\s*\n(?=[а-яёА-ЯЁ])", hyphen)


def text_variants(c: Column) -> Column:
    """Up to three distinct readings of line-end hyphens (as it is, dropped, kept), first the text itself."""
    return F.array_distinct(F.array(comparison_text(c), comparison_text(rejoined(c, "")), comparison_text(rejoined(c, "-"))))


def unquoted(t: Column) -> Column:
    """A text without one pair of quotes around it."""
    quoted = (F.length(t) > 1) & t.startswith('"') & t.endswith('"')
    return F.when(quoted, F.substr(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def answer_key(c: Column) -> Column:
    """``comparison_text`` without one pair of quotes around it."""
    return unquoted(comparison_text(c))


def title_key(c: Column) -> Column:
    """``comparison_text`` of a title without its trailing category in brackets."""
    return comparison_text(F.regexp_replace(c, rf"(?iu)\s*\((?:{TITLE_SUFFIX})\+?\)\s*$", ""))


def _unwrapped(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, rf"(?U)(?<=[{_LETTER}])-\s*(?:\n\s*)?(?=[{_LETTER}])", ""))


def words_text(c: Column) -> Column:
    """NFKC, lower case, wrapped words joined, punctuation as blanks: the words in their order."""
    return squeeze(F.regexp_replace(_unwrapped(F.lower(_nfkc(c))), rf"(?U)[^{_LETTER}\s]", " "))


def cased_text(c: Column) -> Column:
    """NFKC with wrapped words joined and trailing punctuation gone; case stays."""
    return F.rtrim(_unwrapped(_nfkc(c)), F.lit(TRAILING))


def _topic_text(s: str) -> str:
    table = str.maketrans(TYPOGRAPHY | TYPOGRAPHY_MORE | {SOFT_HYPHEN: "", "ё": "е"})
    s = " ".join(unicodedata.normalize("NFKC", s).casefold().translate(table).split())
    s = re.sub(TERMINAL, "", s).strip()
    look = str.maketrans(HOMOGLYPHS)
    s = re.sub(r"(?<!\w)[a-zа-я]{1,3}(?!\w)", lambda m: m[0].translate(look) if re.search("[a-z]", m[0]) else m[0], s)
    return " ".join(s.split())


def _folded(s: str) -> str:
    table = str.maketrans(TYPOGRAPHY | {SOFT_HYPHEN: "", "ё": "е"})
    return " ".join(unicodedata.normalize("NFKC", s).casefold().translate(table).split())


def _words(s: str) -> str:
    s = re.sub(r"(?<=\w)-\s*(?:\n\s*)?(?=\w)", "", unicodedata.normalize("NFKC", s).lower())
    return " ".join(re.sub(r"[^\w\s]", " ", s).split())


def _each(f: Callable[[str], str]):
    """``f`` of every element of an array; null elements count as empty."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, str] = {}
        for s in batches:
            if len(known) > 100_000:
                known.clear()
            out = []
            for a in s:
                if a is None:
                    out.append(None)
                    continue
                a = ["" if x is None else x for x in a]
                for x in a:
                    if x not in known:
                        known[x] = f(x)
                out.append([known[x] for x in a])
            yield pd.Series(out, dtype=object)

    return run


folded_texts, topic_texts, words_texts = _each(_folded), _each(_topic_text), _each(_words)
topic_text = _udf(_topic_text)
topic_text.__doc__ = "As ``comparison_text``, with look-alike letters in tokens of up to three letters made Cyrillic."


def critical_tokens(c: Column, lexicon: str = NEGATION_LEXICON, marks: str = "") -> Column:
    """Numbers, words of ``lexicon`` and ``marks`` in the order of the (folded) text."""
    tail = f"|[{marks}]" if marks else ""
    words = lexicon.replace(r"\w", f"[{_LETTER}]")
    return F.regexp_extract_all(c, F.lit(rf"(?U){_NUMBER}|(?<![{_LETTER}])(?:{words})(?![{_LETTER}]){tail}"), F.lit(0))


def wide_tokens(c: Column) -> Column:
    """``critical_tokens`` of the wide lexicon, over the text for comparison."""
    return critical_tokens(comparison_text(c), WIDE_LEXICON, "%°")


def _signature(s: str) -> list[str]:
    marks = [(m.start(), 0, "number:" + m[0]) for m in re.finditer(rf"(?<!\w){_NUMBER}(?:\s*[А-Яа-яA-Za-z%°/-]+)?", s)]
    marks += [(m.start(), 1, "critical:" + m[0]) for m in re.finditer(rf"\b(?:{SIGNATURE_LEXICON})\b", s, re.I)]
    return [x for _, _, x in sorted(marks)]


@F.pandas_udf(T.ArrayType(T.StringType()))
def critical_signature(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Numbers with their unit and critical words, labelled, in text order."""
    for s in batches:
        yield s.map(_signature, na_action="ignore")


def needs_picture(text: Column, answers: Column, *, narrow: bool = False) -> Column:
    """Whether a question can't be understood without its picture.

    By words of its (folded) text, or because all its answers are labels: up to twelve
    characters, or with ``narrow`` groups of up to three that are no plain answers. No
    answers are no labels; nulls count as empty.
    """
    if narrow:
        label = lambda a: ~a.isin(*PLAIN_LABELS) & a.rlike(r"^[а-яa-z0-9]{1,3}(?:[)()., /-]+[а-яa-z0-9]{1,3})*[)()., /-]*$")
    else:
        label = lambda a: a.rlike(r"^[а-яa-z0-9)()., /-]{1,12}$")
    listed = F.coalesce(answers, F.array().cast("array<string>"))
    return F.coalesce(text.rlike(PICTURE_LEXICON), F.lit(False)) | ((F.size(listed) > 0) & F.coalesce(F.forall(listed, label), F.lit(False)))


def code_of(c: Column) -> Column:
    """Leading section code of a heading (letters, then one to three numbers), null if none."""
    return F.nullif(F.regexp_extract(c, r"(?Us)^([А-ЯЁA-Z]+(?:\.\d+){1,3})\.?\s+(.+)", 1), F.lit(""))


def is_code(c: Column) -> Column:
    """Whether the text is a record code: letters, then one to four numbers, an optional dot."""
    return c.rlike(r"^[А-ЯЁA-Z]+(?:\.\d+){1,4}\.?$")


def topic_of(c: Column) -> tuple[Column, Column]:
    """(code, title) of ``1.2. Title``; null where there is no such start."""
    found = lambda i: F.nullif(F.trim(F.regexp_extract(F.trim(c), r"(?s)^(\d+(?:\.\d+)+)\.?\s*(\D.+)", i)), F.lit(""))
    return found(1), found(2)
