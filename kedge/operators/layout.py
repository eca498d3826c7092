"""Rows and records from page geometry: interval joins with a (document, page) key, and folds along a page.

Every join here has the page as an equality key, so ranges are only tried within one
page; windows are per page or per document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def adjacent_bands(rules: DataFrame, *, page: Sequence[str], y: str, least: float) -> DataFrame:
    """``page, top, bottom, nth`` of neighbouring distinct rule positions at least ``least`` apart."""
    w = Window.partitionBy(*page).orderBy("top")
    seen = rules.where(F.col(y).isNotNull()).select(*page, F.round(F.col(y), 0).alias("top")).distinct()
    bands = seen.withColumn("bottom", F.lead("top").over(w)).where(F.col("bottom") - F.col("top") >= least)
    return bands.withColumn("nth", F.row_number().over(w))


def in_cells(items: DataFrame, cells: DataFrame, *, page: Sequence[str], x: str, y: str, slack: float = 0.0) -> DataFrame:
    """``items`` with the columns of the cell (left, right, top, bottom) their centre lies in.

    Left and top edges belong to a cell, right and bottom ones don't; the top may be
    missed by ``slack``. Items outside all cells are left out.
    """
    held = cells.select(*[F.col(c).alias(f"_{c}" if c in page else c) for c in cells.columns])
    on = [F.col(p) == F.col(f"_{p}") for p in page]
    on += [F.col(y) >= F.col("top") - slack, F.col(y) < F.col("bottom"), F.col(x) >= F.col("left"), F.col(x) < F.col("right")]
    return items.join(held, on).drop(*[f"_{p}" for p in page])


def sole_row(items: DataFrame, rows: DataFrame, *, page: Sequence[str], id: str, y: str) -> DataFrame:
    """``items`` with ``row``, the id of the one band (row, top, bottom) their ``y`` lies in; null for none or several."""
    held = rows.select(*[F.col(p).alias(f"_{p}") for p in page], F.col("row").alias("_row"), F.col("top").alias("_top"), F.col("bottom").alias("_bottom"))
    on = [F.col(p) == F.col(f"_{p}") for p in page] + [F.col(y) >= F.col("_top"), F.col(y) < F.col("_bottom")]
    hits = items.join(held, on).groupBy(*page, id).agg(F.count("*").alias("_n"), F.first("_row").alias("_r"))
    return items.join(hits, [*page, id], "left").withColumn("row", F.when(F.col("_n") == 1, F.col("_r"))).drop("_n", "_r")


def covered(items: DataFrame, boxes: DataFrame, *, page: Sequence[str], x: str, y: str) -> DataFrame:
    """``items`` whose centre lies in any box (x0, y0, x1, y1) of their page."""
    held = boxes.select(*[F.col(p).alias(f"_{p}") for p in page], "x0", "y0", "x1", "y1")
    on = [F.col(p) == F.col(f"_{p}") for p in page] + [F.col(x).between(F.col("x0"), F.col("x1")), F.col(y).between(F.col("y0"), F.col("y1"))]
    return items.join(held, on, "left_semi")


def preceding(rows: DataFrame, headings: DataFrame, *, by: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """As-of join: ``rows`` with the columns ``carry`` of the last heading strictly before them.

    Nulls before the first heading. One pass over the union in order; no range join.
    """
    mark = F.struct(*carry)
    names = [c for c in rows.columns if c not in carry]
    both = headings.select(*by, *order, mark.alias("_h"), F.lit(1).alias("_k"), F.lit(None).cast(rows.select(F.struct(*names)).schema[0].dataType).alias("_r"))
    both = both.unionByName(rows.select(*by, *order, F.lit(None).cast(both.schema["_h"].dataType).alias("_h"), F.lit(0).alias("_k"), F.struct(*names).alias("_r")))
    # a row sorts before headings at its own place, so those don't count
    w = Window.partitionBy(*by).orderBy(*order, "_k").rowsBetween(Window.unboundedPreceding, -1)
    got = both.withColumn("_h", F.last("_h", ignorenulls=True).over(w)).where("_k = 0")
    return got.select("_r.*", *[F.col(f"_h.{c}").alias(c) for c in carry])


def islands(df: DataFrame, *, by: Sequence[str], order: Sequence[str], starts: str) -> DataFrame:
    """``df`` with ``island``, the number of rows that start one up to each row (0 before the first)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("island", F.sum(F.when(F.expr(starts), 1).otherwise(0)).over(w))


def paragraphs(lines: DataFrame, *, by: Sequence[str], top: str, bottom: str, gap: float, text: str, bullets: str = "•●") -> DataFrame:
    """``by, paragraph, text``: lines joined unless the gap above is over ``gap`` or the line starts with a bullet."""
    w = Window.partitionBy(*by).orderBy(top)
    first = F.col("_above").isNull() | (F.col(top) - F.col("_above") > gap) | F.ltrim(text).rlike(f"^[{bullets}]")
    cut = lines.withColumn("_above", F.lag(bottom).over(w)).withColumn("_first", first)
    marked = islands(cut, by=by, order=[top], starts="_first")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(top, text))), lambda x: x[text]), " ")
    return marked.groupBy(*by, F.col("island").alias("paragraph")).agg(joined.alias("text"))


def anchored_lines(spans: DataFrame, *, page: Sequence[str], y: str, near: float, keep: Sequence[str]) -> DataFrame:
    """``spans`` with ``line``: a span joins the line whose first span is within ``near``.

    The distance counts from the first span of a line, not from the one before, so this
    is a fold along the page, which is bounded by the page's spans.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(y).alias("y"), F.struct(*keep).alias("s"))))
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("line"), F.array().cast("array<int>").alias("lines"))

    def step(acc, x):
        new = acc["anchor"].isNull() | (x["y"] - acc["anchor"] > near)
        line = F.when(new, acc["line"] + 1).otherwise(acc["line"])
        return F.struct(F.when(new, x["y"].cast("double")).otherwise(acc["anchor"]).alias("anchor"), line.alias("line"), F.array_append(acc["lines"], line).alias("lines"))

    folded = spans.where(F.col(y).isNotNull()).groupBy(*page).agg(rows.alias("rows")).withColumn("lines", F.aggregate("rows", start, step)["lines"])
    each = folded.select(*page, F.explode(F.arrays_zip("rows", "lines")).alias("z"))
    return each.select(*page, F.col("z.rows.y").alias(y), F.col("z.rows.s.*"), F.col("z.lines").alias("line"))


def sole_styled(answers: DataFrame, *, by: Sequence[str], position: str, styled: str) -> DataFrame:
    """``by, correct``: position of the one fully styled answer among several; null for none, several or a single answer."""
    return answers.groupBy(*by).agg(F.when((F.count("*") > 1) & (F.count_if(F.col(styled)) == 1), F.max(F.when(F.col(styled), F.col(position)))).alias("correct"))


def gap_range(df: DataFrame, *, by: Sequence[str], y: str) -> DataFrame:
    """``by, least, most, distinct`` of the gaps between neighbouring positions."""
    w = Window.partitionBy(*by).orderBy(y)
    gaps = df.withColumn("_g", F.col(y) - F.lag(y).over(w)).where("_g is not null")
    return gaps.groupBy(*by).agg(F.min("_g").alias("least"), F.max("_g").alias("most"), F.countDistinct("_g").alias("distinct"))


def nearest(targets: DataFrame, anchors: DataFrame, *, by: Sequence[str], order: str, k: int, carry: str) -> DataFrame:
    """The ``k`` nearest anchors strictly before and after each target: ``by, order, before, after`` (arrays of ``carry``, in order).

    Anchors are numbered along their group; a target knows how many lie before it, so
    its neighbours are an equality join on at most 2k numbers.
    """
    both = anchors.select(*by, F.col(order).alias("o"), F.lit(1).alias("a"), F.col(carry).alias("c")).unionByName(targets.select(*by, F.col(order).alias("o"), F.lit(0).alias("a"), F.lit(None).cast(anchors.schema[carry].dataType).alias("c")))
    w = Window.partitionBy(*by).orderBy("o").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy(*by, "o")
    counted = both.withColumn("upto", F.sum("a").over(w)).withColumn("here", F.sum("a").over(same))
    numbered = counted.where("a = 1").select(*by, "c", F.row_number().over(Window.partitionBy(*by).orderBy("o", "c")).alias("n"))
    wanted = counted.where("a = 0").select(*by, "o", (F.col("upto") - F.col("here")).alias("left"), F.col("upto").alias("right")).distinct()
    asked = wanted.select(*by, "o", "left", F.explode(F.array(*[F.col("left") - i for i in range(k)], *[F.col("right") + i for i in range(1, k + 1)])).alias("n"), )
    got = asked.join(numbered, [*by, "n"], "left").groupBy(*by, "o").agg(
        F.array_sort(F.collect_list(F.when(F.col("c").isNotNull() & (F.col("n") <= F.col("left")), F.struct("n", "c")))).alias("b"),
        F.array_sort(F.collect_list(F.when(F.col("c").isNotNull() & (F.col("n") > F.col("left")), F.struct("n", "c")))).alias("f"),
    )
    return got.select(*by, F.col("o").alias(order), F.transform("b", lambda x: x["c"]).alias("before"), F.transform("f", lambda x: x["c"]).alias("after"))
