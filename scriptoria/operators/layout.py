"""Page geometry to paragraphs: layout, reading order, lines, paragraphs.

Everything is windows over (document, page, column) except the anchored clustering of items into lines, whose
reference point is the first item of a line; it runs per page and column in an Arrow batch function.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions.jsregex import matches, normal_spaces
from scriptoria.functions.lines import is_page_number

# Geometry.
LOW_BAND, HIGH_BAND, MIN_ITEMS, LANDSCAPE, MIN_GAP, MIN_SIDE = 0.08, 0.92, 20, 1.1, 0.06, 20
LINE_TOLERANCE, LINE_SHARE, PARAGRAPH_GAP, INDENT = 2.5, 0.45, 1.55, 9.0
LINE_SCHEMA = "doc string, page int, column int, x double, y double, height double, text string"


def clean_items(items: DataFrame) -> DataFrame:
    """Items (doc, page, pageWidth, pageHeight, x, y, width, height, text) with normal spaces; blank ones go.

    Where the raw transform is given (``b``, ``d``), the height is at least its vertical extent.
    """
    out = items.withColumn("text", normal_spaces(F.col("text"))).where(F.length("text") > 0)
    return out.withColumn("height", F.greatest("height", F.hypot("b", "d"))).drop("b", "d") if {"b", "d"} <= set(items.columns) else out


def widest_gap(rows: DataFrame, keys: list[str], x: str = "x") -> DataFrame:
    """keys, gap, mid: the widest gap between neighbours (the first one of equal width) and its middle."""
    w = Window.partitionBy(*keys).orderBy(x)
    gaps = rows.select(*keys, F.col(x).alias("_x"), F.lag(x).over(w).alias("_before")).where("_before is not null")
    best = F.max_by(F.struct((F.col("_x") - F.col("_before")).alias("gap"), (F.col("_before") + (F.col("_x") - F.col("_before")) / 2).alias("mid")), F.struct(F.col("_x") - F.col("_before"), -F.col("_x")))
    return gaps.groupBy(*keys).agg(best.alias("_g")).select(*keys, "_g.gap", "_g.mid")


def page_layouts(items: DataFrame) -> DataFrame:
    """doc, page, layout, splitX of each page."""
    keys = ["doc", "page"]
    wide = F.length("text") > 2
    inner = items.where(wide & (F.col("x") > F.col("pageWidth") * LOW_BAND) & (F.col("x") < F.col("pageWidth") * HIGH_BAND))
    pages = items.groupBy(*keys).agg(F.first("pageWidth").alias("w"), F.first("pageHeight").alias("h"), F.count_if(wide).alias("n"))
    split = pages.join(widest_gap(inner, keys), keys, "left").withColumn("cut", F.when(F.col("gap") > 0, F.col("mid")).otherwise(F.col("w") / 2))
    sides = items.join(split.select(*keys, "cut"), keys).groupBy(*keys).agg(F.count_if(F.col("x") < F.col("cut")).alias("left"), F.count_if(F.col("x") >= F.col("cut")).alias("right"))
    both = split.join(sides, keys)
    two = (F.col("n") >= MIN_ITEMS) & (F.col("w") > F.col("h") * LANDSCAPE) & (F.coalesce("gap", F.lit(0.0)) > F.col("w") * MIN_GAP) & (F.col("left") > MIN_SIDE) & (F.col("right") > MIN_SIDE)
    return both.select(*keys, F.when(two, "two-column").otherwise("single-column").alias("layout"), F.when(two, F.col("cut")).otherwise(F.col("w") / 2).alias("splitX"))


def document_layout(pages: DataFrame) -> DataFrame:
    """doc, pages, layout: two columns if most pages have them."""
    share = F.avg((F.col("layout") == "two-column").cast("double"))
    return pages.groupBy("doc").agg(F.count(F.lit(1)).alias("pages"), F.when(share > 0.5, "two-column").otherwise("single-column").alias("layout"))


def reading_order(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items with their column and their place in the page: columns first, then down, then across."""
    out = items.join(pages, ["doc", "page"]).withColumn("column", F.when((F.col("layout") == "two-column") & (F.col("x") >= F.col("splitX")), 1).otherwise(0))
    return out.withColumn("place", F.row_number().over(Window.partitionBy("doc", "page").orderBy("column", F.desc("y"), "x")))


def cluster(page: pd.DataFrame) -> pd.DataFrame:
    """Lines of one page and column: an item joins the first line whose first item is near enough in height."""
    anchors: list[float] = []
    lines: list[list[int]] = []
    rows = page.sort_values(["y", "x"], ascending=[False, True], kind="stable").reset_index(drop=True)
    for i, (y, h) in enumerate(zip(rows["y"], rows["height"], strict=True)):
        near = max(LINE_TOLERANCE, h * LINE_SHARE)
        at = next((k for k, a in enumerate(anchors) if abs(a - y) <= near), None)
        if at is None:
            anchors.append(y)
            lines.append([i])
        else:
            lines[at].append(i)
    out = []
    for members in lines:
        own = rows.loc[members].sort_values("x", kind="stable")
        head = own.iloc[0]
        out.append((head["doc"], head["page"], head["column"], head["x"], head["y"], own["height"].max(), " ".join(own["text"])))
    return pd.DataFrame(out, columns=["doc", "page", "column", "x", "y", "height", "text"])


def page_lines(ordered: DataFrame) -> DataFrame:
    """Lines (doc, page, column, x, y, height, text), page numbers left out; a page is a small group."""
    cols = ["doc", "page", "column", "x", "y", "height", "text"]
    typed = ordered.select(F.col("doc").cast("string"), F.col("page").cast("int"), F.col("column").cast("int"), *[F.col(c).cast("double") for c in ("x", "y", "height")], "text")
    out = typed.groupBy("doc", "page", "column").applyInPandas(cluster, LINE_SCHEMA)
    out = out.select(*cols).withColumn("text", normal_spaces(F.col("text")))
    return out.where((F.length("text") > 0) & ~is_page_number(F.col("text")))


_LOWER = r"^[а-яёa-z]"


def _glued(pieces: Column) -> Column:
    """Pieces as one text: a trailing hyphen before a lower-case piece goes, others are joined by a space."""

    def add(acc: Column, x: Column) -> Column:
        broken = acc.endswith("-") & matches(x, _LOWER, "u")
        return F.when(F.length(acc) == 0, x).when(broken, F.concat(F.substring(acc, F.lit(1), F.length(acc) - 1), x)).otherwise(F.concat_ws(" ", acc, x))

    return F.aggregate(pieces, F.lit(""), add)


def islands(rows: DataFrame, keys: list[str], order: list, starts: Column, value: str) -> DataFrame:
    """Gaps and islands: rows of a group, cut where ``starts`` holds, as lists of ``value`` in order (keys, island, parts)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("_new", starts).withColumn("_n", F.row_number().over(w))
    cut = marked.withColumn("island", F.sum(F.when(F.coalesce("_new", F.lit(True)), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_n", F.col(value).alias("_v")))), lambda s: s["_v"])
    return cut.groupBy(*keys, "island").agg(parts.alias("parts"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """Paragraphs (doc, place, text): a new page or column, a wide gap or an indent starts one; hyphens are closed."""
    keys = ["doc"]
    order = ["page", "column", F.desc("y"), "x"]
    w = Window.partitionBy(*keys).orderBy(*order)
    was = {c: F.lag(c).over(w) for c in ("page", "column", "x", "y", "height")}
    gap = F.abs(was["y"] - F.col("y")) > F.greatest(was["height"], F.col("height")) * PARAGRAPH_GAP
    starts = (was["page"] != F.col("page")) | (was["column"] != F.col("column")) | gap | (F.col("x") - was["x"] > INDENT)
    blocks = islands(lines, keys, order, starts, "text").select("doc", F.col("island").alias("place"), _glued(F.col("parts")).alias("text"))
    return merge_broken(blocks)


def merge_broken(blocks: DataFrame) -> DataFrame:
    """Join paragraphs (doc, place, text) that a break cut: the next one begins in lower case, and the one before ends in a
    hyphen (closed up) or without a full stop (joined by a space)."""
    w = Window.partitionBy("doc").orderBy("place")
    before = F.lag("text").over(w)
    lower = matches(F.col("text"), _LOWER, "u")
    ended = matches(before, r"[.!?…»][»\"')]*\s*$", "u")
    starts = before.isNull() | ~(lower & (before.endswith("-") | ~ended))
    out = islands(blocks, ["doc"], ["place"], starts, "text")
    return out.select("doc", F.col("island").alias("place"), _glued(F.col("parts")).alias("text"))


def extract(items: DataFrame) -> DataFrame:
    """Paragraphs of documents from their positioned items."""
    tidy = clean_items(items)
    return paragraphs(page_lines(reading_order(tidy, page_layouts(tidy))))

