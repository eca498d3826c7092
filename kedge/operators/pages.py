"""Questions from the geometry of table pages: rules make rows, rows make cells, lines in cells make texts.

Input are flat tables of a page's spans (document, page, x0, y0, x1, y1, text, bold), drawings (document,
page, x0, y0, x1, y1) and pictures (document, page, x0, y0, x1, y1, sha256), as any reader of page
files gives them. Everything is an equality join on (document, page) with ranges inside, and
windows per page or record; only the fold that carries a record over a page break visits the rows of
a document in order, of which a document has a bounded number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedge import scratch
from kedge.functions import text as tx
from kedge.operators import layout

# They decide what is a rule, a column, a header, a number, a code and a heading.
BULLETS = "\uf0b7•●"
HEADERS = ("No", "№", "Nо", "Nº")
QUESTION_HEADER, PICTURE_HEADER, ANSWER_HEADER = "Вопрос", "Иллюстрация", "Варианты ответа"


@dataclass(frozen=True)
class Grid:
    """Where the rules of a table lie: width and ends of a row's rule, least height of a row, ranges of the five column rules, how far a span may lie above its row."""

    width: tuple[float, float]
    x0: tuple[float, float]
    x1: tuple[float, float]
    least: float
    columns: tuple[tuple[float, float], ...]
    slack: float


_ANY = 1e9
NUMBERED = Grid((20, 70), (20, 80), (65, 125), 5.0, ((20, 65), (65, 125), (260, 360), (480, 650), (700, 825)), 1.0)
CODED = Grid((25, _ANY), (-_ANY, 85), (90, 145), 18.0, ((40, 90), (90, 145), (300, 345), (490, 535), (750, 815)), 0.0)
#: A span further down, or further right, than this begins another line.
LINE_DOWN, LINE_RIGHT = 2.0, 7.0
#: A heading goes on in lines within this distance of its first.
HEADING_WRAP = 30.0
#: Gaps up to this are within a line; how much wider than the narrowest a gap between paragraphs is.
GAP_LEAST, GAP_MORE = 3.0, 0.3
# End of fixed values.
PAGE = ("document", "page")
ROW = (*PAGE, "top")


def _between(c: str | Column, r: tuple[float, float]) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c > r[0]) & (c < r[1])


def table_rows(drawings: DataFrame, grid: Grid) -> DataFrame:
    """``document, page, top, bottom, columns``: bands between neighbouring row rules that all five column rules cross.

    Of several column rules in a range the tallest counts, of these the leftmost.
    """
    d = drawings.withColumns({"w": F.col("x1") - F.col("x0"), "h": F.col("y1") - F.col("y0")})
    w = Window.partitionBy(*PAGE).orderBy("top")
    tops = d.where((F.col("h") <= 1) & _between("w", grid.width) & _between("x0", grid.x0) & _between("x1", grid.x1)).select(*PAGE, F.round("y0", 2).alias("top")).distinct()
    bands = tops.withColumn("bottom", F.lead("top").over(w)).where(F.col("bottom") - F.col("top") >= grid.least)
    of = F.lit(None).cast("int")
    for i, r in enumerate(grid.columns):
        of = F.when(_between("x0", r), i).otherwise(of)
    rules = d.where("w <= 1").select(*[F.col(p).alias(f"_{p}") for p in PAGE], F.col("x0").cast("double").alias("x"), "y0", "y1", "h", of.alias("nth")).where("nth is not null")
    mid = (F.col("top") + F.col("bottom")) / 2
    met = bands.join(rules, [*[F.col(p) == F.col(f"_{p}") for p in PAGE], F.col("y0") <= mid, F.col("y1") >= mid])
    each = met.groupBy(*ROW, "bottom", "nth").agg(F.max_by("x", F.struct("h", -F.col("x"))).alias("x"))
    return each.groupBy(*ROW, "bottom").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "x"))), lambda s: s["x"]).alias("columns")).where(F.size("columns") == len(grid.columns))


def cell_spans(spans: DataFrame, rows: DataFrame, grid: Grid) -> DataFrame:
    """Spans with ``top`` of the row their middle lies in and ``cell`` (0 to 3) their left edge lies in."""
    held = rows.select(*[F.col(p).alias(f"_{p}") for p in PAGE], "top", "bottom", "columns")
    mid = (F.col("y0") + F.col("y1")) / 2
    on = [*[F.col(p) == F.col(f"_{p}") for p in PAGE], mid >= F.col("top") - grid.slack, mid < F.col("bottom")]
    cell = F.size(F.filter("columns", lambda c: c <= F.col("x0"))) - 1
    return spans.join(held, on).withColumn("cell", cell).where(F.col("cell").between(0, 3)).drop(*[f"_{p}" for p in PAGE], "bottom", "columns")


def cell_lines(spans: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, line, y, text, x0, x1, y1, plain``: lines of each cell; spans within ``LINE_DOWN`` of a line's first belong to it, left to right.

    ``plain`` counts spans with a word character that are not bold, ``worded`` all with one.
    """
    folded = layout.anchored_lines(spans.withColumn("at", F.col("y0")), page=by, y="at", near=LINE_DOWN, keep=["x0", "y0", "x1", "y1", "text", "bold"])
    word = F.col("text").rlike(r"[\p{L}\p{N}_]")
    parts = F.array_sort(F.collect_list(F.struct("x0", "y0", "text")))
    return folded.groupBy(*by, "line").agg(
        F.trim(F.array_join(F.transform(parts, lambda s: s["text"]), "")).alias("text"), F.min("y0").alias("y"), F.max("y1").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1"),
        F.count_if(word & ~F.col("bold")).alias("plain"), F.count_if(word).alias("worded"),
    )


def _texts(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with ``raw``: the text of each of the four cells, lines apart; null for an empty cell."""
    full = F.filter(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda s: s["text"] != "")
    each = lines.groupBy(*ROW, "cell").agg(F.array_join(F.transform(full, lambda s: s["text"]), "\n").alias("raw"))
    wide = each.groupBy(*ROW).agg(*[F.max(F.when(F.col("cell") == i, F.col("raw"))).alias(f"raw{i}") for i in range(4)])
    return rows.join(wide, [*ROW], "left")


def carried(rows: DataFrame, *, kind: Column) -> DataFrame:
    """``rows`` with ``record``: each document's records in order, carried over page breaks.

    ``kind`` is start, more, bad or skip. A row of kind more goes on with the last record if that ended on
    the page before; else, and for bad, ``record`` is null. Skipped rows are left out.
    """
    held = rows.withColumn("kind", kind).where("kind <> 'skip'")
    listed = held.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("page", "top", "kind"))).alias("rows"))
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("out"))

    def step(acc, x):
        more = (x["kind"] == "more") & (acc["n"] > 0) & (acc["last"] == x["page"] - 1)
        n = F.when(x["kind"] == "start", acc["n"] + 1).otherwise(acc["n"])
        ok = F.coalesce((x["kind"] == "start") | more, F.lit(False))
        return F.struct(n.alias("n"), F.when(ok, x["page"].cast("int")).otherwise(acc["last"]).alias("last"), F.array_append(acc["out"], F.when(ok, n)).alias("out"))

    each = listed.withColumn("record", F.aggregate("rows", start, step)["out"]).select("document", F.explode(F.arrays_zip("rows", "record")).alias("z"))
    return held.join(each.select("document", F.col("z.rows.page").alias("page"), F.col("z.rows.top").alias("top"), F.col("z.record").alias("record")), [*ROW])


def _raw_of(rows: DataFrame) -> DataFrame:
    order = F.array_sort(F.collect_list(F.struct("page", "top", F.coalesce("raw1", F.lit("")).alias("raw"), "bottom")))
    return rows.groupBy("document", "record").agg(
        F.min_by("raw0", F.struct("page", "top")).alias("number"), F.min("page").alias("page"), F.array_join(F.transform(order, lambda s: s["raw"]), "\n").alias("raw_question_text"),
        F.transform(order, lambda s: F.struct(s["page"].alias("page"), s["top"].alias("top"), s["bottom"].alias("bottom"))).alias("row_refs"), F.max(F.col("kind") == "more").alias("continued"),
    )


def _pictures(records: DataFrame, rows: DataFrame, pictures: DataFrame | None) -> DataFrame:
    """``records`` with ``illustrations``: hashes of the pictures whose middle lies in the picture cell of one of their rows only."""
    if pictures is None:
        return records.withColumn("illustrations", F.array().cast("array<string>"))
    p = pictures.withColumns({"mx": (F.col("x0") + F.col("x1")) / 2, "my": (F.col("y0") + F.col("y1")) / 2, "_id": F.monotonically_increasing_id()})
    held = rows.select(*[F.col(c).alias(f"_{c}") for c in PAGE], "top", "bottom", "columns", "record")
    met = p.join(held, [*[F.col(c) == F.col(f"_{c}") for c in PAGE], F.col("my") >= F.col("top"), F.col("my") < F.col("bottom"), F.col("mx") >= F.get("columns", F.lit(2)), F.col("mx") < F.get("columns", F.lit(3))])
    one = met.groupBy("_id").agg(F.count("*").alias("n"), F.first("document").alias("document"), F.first("record").alias("record"), F.first("sha256").alias("sha256"), F.first("my").alias("my")).where("n = 1 and record is not null")
    seen = one.groupBy("document", "record").agg(F.transform(F.array_sort(F.collect_list(F.struct("my", "sha256"))), lambda s: s["sha256"]).alias("illustrations"))
    return records.join(seen, ["document", "record"], "left").withColumn("illustrations", F.coalesce("illustrations", F.array().cast("array<string>")))


def numbered_questions(spans: DataFrame, drawings: DataFrame, *, legend: DataFrame, pictures: DataFrame | None = None, grid: Grid = NUMBERED) -> tuple[DataFrame, DataFrame]:
    """(records, issues) of documents whose rows are numbered; ``legend`` (document, legend) says where correct answers are highlighted.

    A numbered row begins a record; an unnumbered one goes on with the record of the page
    before, else it is an issue (unrecognized_row). Answers begin at bullets. The one answer all of whose
    words are bold is the correct one, where the legend says so. A record is full_options with four
    bulleted answers of which the correct one is known, published_answer_only with one answer.
    Issues are also nonsequential_numbers of a document. Empty tables give empty results.
    """
    rows = scratch.table(table_rows(drawings, grid), "rows")
    lines = scratch.table(cell_lines(cell_spans(spans, rows, grid), [*ROW, "cell"]), "lines")
    full = _texts(lines, rows).withColumn("number", F.trim(F.coalesce("raw0", F.lit(""))))
    empty = F.coalesce("raw0", "raw1", "raw2", "raw3").isNull()
    kind = (
        F.when(F.col("number").isin(*HEADERS) | (F.trim(F.coalesce("raw1", F.lit(""))) == QUESTION_HEADER), "skip").when(F.col("number").rlike(r"^\d+\.?$"), "start")
        .when(empty, "skip").when(F.col("number") == "", "more").otherwise("bad")
    )
    held = scratch.table(carried(full, kind=kind), "carried")
    records = _pictures(_raw_of(held.where("record is not null")), held, pictures)

    at = Window.partitionBy("document", "record").orderBy("page", "top", "line")
    bullet = F.col("text").rlike(f"[{BULLETS}]")
    mine = lines.where("cell = 3").join(held.where("record is not null").select(*ROW, "record"), [*ROW]).withColumn("bullet", bullet).withColumn("paragraph", F.sum(F.col("bullet").cast("int")).over(at))
    joined = F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("page", "top", "line", "text"))), lambda s: s["text"] != ""), lambda s: s["text"]), "\n")
    per = mine.groupBy("document", "record", "paragraph").agg(F.trim(F.translate(joined, BULLETS, "")).alias("raw"), (F.sum("plain") == 0).alias("no_plain"), F.sum("worded").alias("worded"), F.max("bullet").alias("bullet"))
    per = per.withColumns({"text": tx.squeeze(F.col("raw")), "bold": F.col("no_plain") & (F.col("worded") > 0)})
    order = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("paragraph", "text", "raw", "bold"))))
    answers = per.groupBy("document", "record").agg(order.alias("a"), F.count_if("bullet").alias("bullets"))
    j = records.join(answers, ["document", "record"], "left").join(legend, "document", "left")
    a = F.coalesce("a", F.array().cast("array<struct<paragraph:bigint,text:string,raw:string,bold:boolean>>"))
    j = j.withColumn("a", a).withColumn("marked", F.filter(F.sequence(F.lit(0), F.greatest(F.size("a") - 1, F.lit(0))), lambda i: F.coalesce(F.get("a", i)["bold"], F.lit(False))))
    known = F.coalesce(F.col("legend"), F.lit(False)) & (F.size("marked") == 1)
    structure = F.when(F.size("a") == 1, "published_answer_only").when((F.size("a") == 4) & (F.col("bullets") == 4) & known, "full_options").otherwise("unknown")
    text = tx.squeeze(F.col("raw_question_text"))
    flag = lambda yes, name: F.when(yes, F.lit(name))
    out = j.select(
        F.concat_ws(":", "document", F.col("record").cast("string")).alias("reference_id"), "document", "page", F.col("record").alias("order_no"), F.trim("number").alias("question_number"), "raw_question_text", text.alias("question_text"),
        F.transform("a", lambda s: s["text"]).alias("published_answers"), F.transform("a", lambda s: s["raw"]).alias("raw_published_answers"), F.when(known, F.get("a", F.get("marked", F.lit(0)))["text"]).alias("published_correct_answer"),
        F.when(known, F.col("marked")).alias("published_correct_answer_indexes"), known.alias("correctness_known"), structure.alias("answer_structure"), "illustrations", "row_refs",
        F.array_compact(F.array(flag(F.col("continued"), "page_continuation"), flag((text == "") | (F.size("a") == 0), "incomplete_content"), flag(~known, "unknown_correctness"), flag(text.contains("�"), "text_layer_replacement_character"))).alias("issues"),
    )
    lost = held.where("record is null").select("document", "page", F.lit("unrecognized_row").alias("issue"), F.col("number").alias("detail"))
    numbers = records.groupBy("document").agg(F.max(F.regexp_replace(F.trim("number"), r"\.", "").cast("bigint") != F.col("record")).alias("broken")).where("broken")
    return out, lost.unionByName(numbers.select("document", F.lit(None).cast("int").alias("page"), F.lit("nonsequential_numbers").alias("issue"), F.lit(None).cast("string").alias("detail")))


def headings(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """``document, page, y, code, title``: headings between the rows of a table, with the lines they go on in.

    ``lines`` are whole lines of the page (document, page, y0, y1, x0, text). A heading begins with a section code.
    """
    held = rows.select(*[F.col(p).alias(f"_{p}") for p in PAGE], "top", "bottom")
    mid = (F.col("y0") + F.col("y1")) / 2
    outside = lines.join(held, [*[F.col(p) == F.col(f"_{p}") for p in PAGE], mid >= F.col("top"), mid < F.col("bottom")], "left_anti").withColumn("text", F.trim("text"))
    marked = layout.islands(outside.withColumn("code", tx.code_of(F.col("text"))), by=[*PAGE], order=["y0", "x0"], starts="code is not null").where("island > 0")
    first = marked.withColumn("y", F.min("y0").over(Window.partitionBy(*PAGE, "island")))
    goes_on = (F.col("text") != "") & ~F.col("text").isin("№", "No", QUESTION_HEADER, PICTURE_HEADER) & ~F.col("text").contains(ANSWER_HEADER) & (F.col("y0") - F.col("y") < HEADING_WRAP)
    kept = first.where(F.col("code").isNotNull() | goes_on).withColumn("title", F.when(F.col("code").isNotNull(), F.regexp_extract("text", r"(?Us)^[А-ЯЁA-Z]+(?:\.\d+){1,3}\.?\s+(.+)", 1)).otherwise(F.col("text")))
    return kept.groupBy(*PAGE, "island").agg(F.first("y").alias("y"), F.max("code").alias("code"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "title"))), lambda s: s["title"]), " ").alias("title")).drop("island")


def coded_questions(spans: DataFrame, drawings: DataFrame, *, highlights: DataFrame | None = None, grid: Grid = CODED) -> tuple[DataFrame, DataFrame]:
    """(records, issues) of documents whose rows carry a section code, with the heading they stand under.

    A row with a code begins a record, one without goes on with that of the page before, else it is an
    issue (orphan_row, invalid_code). Answers begin at bullets; without any in a row, at
    gaps wider than the narrowest one there, or at every line if all gaps are alike. The one
    answer of several that is all bold or highlighted (``highlights``: document, page, x0, y0, x1, y1) is correct.
    """
    rows = scratch.table(table_rows(drawings, grid), "rows")
    lines = cell_lines(cell_spans(spans, rows, grid), [*ROW, "cell"])
    if highlights is not None:
        h = highlights.select(*[F.col(p).alias(f"_{p}") for p in PAGE], *[F.col(c).alias(f"h{c}") for c in ("x0", "y0", "x1", "y1")])
        mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y") + F.col("y1")) / 2
        lit = lines.join(h, [*[F.col(p) == F.col(f"_{p}") for p in PAGE], mx.between(F.col("hx0"), F.col("hx1")), my.between(F.col("hy0"), F.col("hy1"))], "left_semi").select(*ROW, "cell", "line", F.lit(True).alias("lit"))
        lines = lines.join(lit, [*ROW, "cell", "line"], "left")
    else:
        lines = lines.withColumn("lit", F.lit(None).cast("boolean"))
    lines = scratch.table(lines, "lines")
    full = _texts(lines, rows).withColumn("number", F.regexp_replace(F.coalesce("raw0", F.lit("")), r"\s+", ""))
    header = F.coalesce(F.col("raw1").contains(QUESTION_HEADER) & F.col("raw2").contains(PICTURE_HEADER), F.lit(False)) | F.col("number").isin("№", "No")
    kind = F.when(header, "skip").when(F.col("number") == "", "more").when(tx.is_code(F.col("number")), "start").otherwise("bad")
    held = scratch.table(carried(full, kind=kind), "carried")
    records = _raw_of(held.where("record is not null").withColumn("raw0", F.col("number")))

    row_of = [*ROW, "record"]
    mine = lines.where("cell = 3 and text <> ''").join(held.where("record is not null").select(*row_of), [*ROW])
    in_row, order = Window.partitionBy(*row_of), ["page", "top", F.round(F.col("y") / 4), "x0"]
    mine = mine.withColumn("bullet", F.substring("text", 1, 1).rlike(f"[{BULLETS}]")).withColumn("bulleted", F.max("bullet").over(in_row))
    ys = F.array_sort(F.collect_set(F.round("y", 2)).over(in_row))
    gaps = F.filter(F.zip_with(F.slice(ys, F.lit(2), F.greatest(F.size(ys) - 1, F.lit(0))), F.slice(ys, F.lit(1), F.greatest(F.size(ys) - 1, F.lit(0))), lambda b, a: b - a), lambda g: g > GAP_LEAST)
    mine = mine.withColumn("gaps", gaps).withColumn("split", F.when((F.size("gaps") > 0) & (F.array_max("gaps") - F.array_min("gaps") > GAP_MORE), F.array_min("gaps") + GAP_MORE).otherwise(0.0))
    mine = mine.withColumn("gap", F.col("y") - F.lag("y").over(in_row.orderBy(*order)))
    whole = Window.partitionBy("document", "record").orderBy(*order)
    begins = F.when(F.col("bulleted"), F.col("bullet")).otherwise((F.row_number().over(whole) == 1) | F.coalesce(F.col("gap") > F.col("split"), F.lit(False)))
    mine = mine.withColumn("begins", begins).withColumn("answer", F.greatest(F.sum(F.col("begins").cast("int")).over(whole), F.lit(1))).withColumn("text", F.trim(F.regexp_replace("text", f"^[{BULLETS}]", "")))
    mine = mine.where("text <> ''").withColumn("nth", F.row_number().over(whole))
    styled = ((F.col("plain") == 0) & (F.col("worded") > 0)) | F.coalesce("lit", F.lit(False))
    per = mine.groupBy("document", "record", "answer").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "text"))), lambda s: s["text"]), " ").alias("text"), F.min(styled).alias("styled"), F.min("bulleted").alias("bulleted"))
    per = per.withColumn("nth", F.row_number().over(Window.partitionBy("document", "record").orderBy("answer")) - 1)
    correct = layout.sole_styled(per, by=["document", "record"], position="nth", styled="styled")
    listed = per.groupBy("document", "record").agg(F.transform(F.array_sort(F.collect_list(F.struct("answer", "text"))), lambda s: s["text"]).alias("answers"), (~F.min("bulleted")).alias("inferred"))
    heads = headings(spans.select(*PAGE, "x0", "y0", "y1", "text"), rows)
    begun = held.where("kind = 'start'").groupBy("document", "record").agg(F.min(F.struct("page", "top")).alias("s")).select("document", "record", "s.*")
    under = layout.preceding(begun.select("document", "record", "page", F.col("top").alias("y")), heads.select("document", "page", "y", "code", "title"), by=["document"], order=["page", "y"], carry=["code", "title"])
    j = records.join(listed, ["document", "record"], "left").join(correct, ["document", "record"], "left").join(under.select("document", "record", "code", "title"), ["document", "record"], "left")
    flag = lambda yes, name: F.when(yes, F.lit(name))
    out = j.select(
        "document", F.col("record").alias("order_no"), "page", F.col("number").alias("code"), F.substring_index("number", ".", 1).alias("prefix"), F.col("code").alias("section_code"), F.col("title").alias("section_title"), tx.squeeze(F.col("raw_question_text")).alias("question_text"),
        F.coalesce("answers", F.array().cast("array<string>")).alias("answers"), "correct", F.array_compact(F.array(flag(F.col("continued"), "page_continuation"), flag(F.col("inferred"), "answer_boundaries_inferred"), flag(F.col("correct").isNull(), "correct_style_unknown"))).alias("issues"),
    )
    lost = held.where("record is null").select("document", "page", F.when(F.col("kind") == "bad", "invalid_code").otherwise("orphan_row").alias("issue"), F.col("number").alias("detail"))
    return out, lost
