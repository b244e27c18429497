"""Page layout as tables: glyphs, boxes, styles, bookmarks and the blocks that come of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import points_in_ranges


def trimmed_page(text: Column) -> Column:
    """Without white space at line ends and blank lines at either end; other control characters are spaces; not empty
    pages end with a line feed."""
    clean = F.regexp_replace(F.translate(text, "\r\f\x00", "   "), r"(?mU)[^\S\n]+$", "")
    body = F.regexp_replace(clean, r"^\n+|\n+$", "")
    return F.when(body == "", body).otherwise(F.concat(body, F.lit("\n")))


def glyphs_in_boxes(glyphs: DataFrame, boxes: DataFrame, keys: Sequence[str], cell: float = 50.0) -> DataFrame:
    """``keys, box, start, end``: the range of glyph numbers (``idx``) whose centres lie in each box (``x0, top, x1, bottom``).
    A glyph falls in one grid cell, a box in all that it touches: an equi-join on the cell with the exact test behind."""
    g = glyphs.withColumn("_x", (F.col("x0") + F.col("x1")) / 2).withColumn("_y", (F.col("top") + F.col("bottom")) / 2)
    g = g.select(*keys, "idx", "_x", "_y", F.floor(F.col("_x") / cell).alias("_cx"), F.floor(F.col("_y") / cell).alias("_cy"))
    b = boxes.withColumn("_cx", F.explode(F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell))))
    b = b.withColumn("_cy", F.explode(F.sequence(F.floor(F.col("top") / cell), F.floor(F.col("bottom") / cell))))
    inside = (F.col("_x") >= F.col("x0")) & (F.col("_x") < F.col("x1")) & (F.col("_y") >= F.col("top")) & (F.col("_y") < F.col("bottom"))
    hits = g.join(b.select(*keys, "box", "x0", "top", "x1", "bottom", "_cx", "_cy"), [*keys, "_cx", "_cy"]).where(inside)
    return hits.groupBy(*keys, "box").agg(F.min("idx").alias("start"), (F.max("idx") + 1).alias("end"))


def style_runs(chars: DataFrame, keys: Sequence[str], order: str, char: str, style: str) -> DataFrame:
    """``keys, start, end, style``: stretches of one style, bridging white space, ended by a line feed or an unstyled
    character."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = chars.withColumn("_break", F.sum(F.when(F.col(char) == "\n", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where(F.trim(F.regexp_replace(char, r"(?U)\s", "")) != "")
    same = F.col(style).eqNullSafe(F.lag(style).over(w)) & (F.col("_break") == F.lag("_break").over(w))
    rows = rows.withColumn("_run", F.sum(F.when(same, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where(F.col(style).isNotNull()).groupBy(*keys, "_run", style).agg(F.min(order).alias("start"), (F.max(order) + 1).alias("end")).drop("_run")


def table_blocks(tables: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, start, end, has_sentences`` of table ranges: whether a cell ends a sentence, as running text does."""
    inside = F.substring(F.col(text), F.col("start") + 1, F.col("end") - F.col("start"))
    return tables.select(key, "start", "end", inside.rlike(r"다\.(?=\s|$)").alias("has_sentences"))


def label_blocks(cells: DataFrame, sections: DataFrame, key: str, kind: str = "summary") -> DataFrame:
    """``cells`` (key, start, end, label) that begin inside a section of that kind (``kind, start, end``)."""
    ranges = sections.where((F.col("kind") == kind) & F.col("start").isNotNull()).select(key, F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    return points_in_ranges(cells, ranges, [key], "start", "s_start", "s_end", how="left_semi")


def emphasis_blocks(runs: DataFrame, key: str) -> DataFrame:
    """``key, start, end, bold, bold_method, color`` of style runs: bold is what has a method."""
    return runs.select(key, "start", "end", F.col("bold_method").isNotNull().alias("bold"), "bold_method", "color")


def bookmark_recall(agreement: DataFrame) -> DataFrame:
    """One row over all documents of ``bookmark_agreement``: recall and precision of parts and sections from summed counts."""
    total = lambda c: F.sum(c)
    rates = [F.try_divide(total(f"matched_{k}"), total(f"{side}_{k}")).alias(f"{k[:-1]}_{name}") for k in ("parts", "sections") for side, name in (("bookmark", "recall"), ("rule", "precision"))]
    return agreement.agg(F.count("*").alias("docs"), *rates)


def blocks(kinds: dict[str, DataFrame], key: str) -> DataFrame:
    """All kinds of blocks of each document as one table with a ``kind``; what a kind lacks is null."""
    out = None
    for kind, df in kinds.items():
        rows = df.withColumn("kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select(key, "start", "end", "kind", *(c for c in out.columns if c not in (key, "start", "end", "kind")))


def bookmark_agreement(bookmarks: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """Per document with bookmarks: how many parts and sections they name, rules have found, and both. A section's part is
    that of the last part bookmark before it. ``bookmarks``: key, no, title; ``sections``: key, part, number."""
    part = F.regexp_extract(F.trim("title"), r"^제\s*([1-5])\s*부", 1)
    number = F.regexp_extract("title", r"^\s*(\d{1,2})\s*\.\s*\S", 1)
    carried = F.last(F.when(part != "", part), ignorenulls=True).over(Window.partitionBy(key).orderBy("no").rowsBetween(Window.unboundedPreceding, 0))
    marks = bookmarks.withColumn("part", carried.cast("int")).withColumn("number", F.when((part == "") & (number != ""), number))
    named = marks.where((part != "") | (F.col("number").isNotNull() & F.col("part").isNotNull())).select(key, "part", "number").distinct()
    ruled = sections.select(key, "part", F.lit(None).cast("string").alias("number")).unionByName(sections.where("number rlike '^[0-9]+$'").select(key, "part", "number")).distinct()
    both = named.withColumn("_b", F.lit(1)).join(ruled.withColumn("_r", F.lit(1)), (named[key] == ruled[key]) & (named["part"] == ruled["part"]) & named["number"].eqNullSafe(ruled["number"]), "left").select(named[key], named["number"].alias("n"), "_r")
    count = lambda cond, name: F.count_if(cond).alias(name)
    of_marks = both.groupBy(key).agg(count(F.col("n").isNull(), "bookmark_parts"), count(F.col("n").isNotNull(), "bookmark_sections"), count(F.col("n").isNull() & F.col("_r").isNotNull(), "matched_parts"), count(F.col("n").isNotNull() & F.col("_r").isNotNull(), "matched_sections"))
    of_rules = ruled.groupBy(key).agg(count(F.col("number").isNull(), "rule_parts"), count(F.col("number").isNotNull(), "rule_sections"))
    return bookmarks.select(key).distinct().join(of_marks, key, "left").join(of_rules, key, "left").fillna(0)


def reading_order(glyphs: DataFrame, keys: Sequence[str], line: float = 3.0) -> DataFrame:
    """Glyphs with ``idx``, their place on the page (``keys``) from top to bottom and left to right: those whose tops fall in one
    band of ``line`` are of one line, wherever the file draws them."""
    band = F.floor(F.col("top") / F.lit(line))
    return glyphs.withColumn("idx", F.row_number().over(Window.partitionBy(*keys).orderBy(band, "x0", "top", "x1")) - 1)


def cell_labels(hits: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, box, start, end, label`` of glyphs in boxes (``keys, box, idx``) and page texts (``keys, text``): the box's stretch of
    each line, joined by one space; boxes without a label have no row. Other boxes' glyphs on the lines stay out."""
    text = F.col("text")
    lines = F.length(F.regexp_replace(F.substring(text, F.lit(1), F.col("idx")), r"[^\n]", ""))
    placed = hits.join(pages.select(*keys, "text"), list(keys)).withColumn("_line", lines)
    stretch = placed.groupBy(*keys, "box", "_line").agg(F.min("idx").alias("a"), F.max("idx").alias("b"), F.first("text").alias("text"))
    piece = F.struct(F.col("_line"), F.substring(text, F.col("a") + 1, F.col("b") - F.col("a") + 1).alias("p"))
    boxes = stretch.select(*keys, "box", "a", "b", piece.alias("piece")).groupBy(*keys, "box")
    joined = boxes.agg(F.min("a").alias("start"), (F.max("b") + 1).alias("end"), F.array_sort(F.collect_list("piece")).alias("pieces"))
    label = F.trim(F.regexp_replace(F.array_join(F.transform("pieces", lambda x: x["p"]), " "), r"(?U)\s+", " "))
    return joined.select(*keys, "box", "start", "end", label.alias("label")).where("label <> ''")


def document_digest(sections: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """One row per document for a run's summary: body sections found in and beyond the contents, flags, and blocks by kind with
    the characters in tables. sections: ``section_kind, char_start, in_toc, quality_flags``; blocks: ``kind, start, end, has_sentences``."""
    found = (F.col("section_kind") == "body") & F.col("char_start").isNotNull()
    flagged = lambda f: F.count_if(found & F.array_contains("quality_flags", f))
    one = sections.groupBy(key).agg(
        F.count_if(found & F.col("in_toc")).alias("body_found"), F.count_if(found & ~F.col("in_toc")).alias("body_only"), flagged("SHORT_TEXT").alias("short_text"),
        flagged("BROKEN_CHARS").alias("broken_chars"), F.coalesce(F.bool_or(F.col("section_kind") == "summary"), F.lit(False)).alias("has_summary"),
    )
    kinds = blocks.groupBy(key, "kind").agg(F.count("*").alias("n"), F.count_if("has_sentences").alias("s"), F.sum(F.col("end") - F.col("start")).alias("c"))
    table = lambda c: F.coalesce(F.sum(F.when(F.col("kind") == "table", F.col(c))), F.lit(0))
    other = kinds.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("block_counts"), table("n").alias("tables"), table("s").alias("tables_with_sentences"), table("c").alias("table_chars"))
    return one.join(other, key, "left").fillna(0, ["tables", "tables_with_sentences", "table_chars"])
