"""Markdown texts as blocks with their page and section, without marks of the parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Forms of lines that are no text (fixed values): page marks, headings, origin and telemetry, lone images, blank pages.
PAGE_COMMENT = r"(?i)^<!--\s*PAGE\s+(\d+)\s*-->$"
PAGE_HEADING = r"^#{1,6}\s+第\s*(\d+)\s*页\s*#*$"
HEADING = r"^#{1,6}\s+(.+?)\s*#*$"
NOISE = r"(?i)^>\s*(?:来源|切片|模型|DPI)\s*[:：]|^<sub>\s*tokens\s*\(|^!\[[^\]]*\]\([^)]*\)$|^\[blank page\]$|^---$"


def title_key(title: Column) -> Column:
    """A title's letters and digits in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"[^\p{L}\p{N}]", "")


def text_blocks(texts: DataFrame, row: str, text: str, title: str) -> DataFrame:
    """``(row, block_no, page, section, path, kind, body)``: paragraphs and headings of every text, in order, with where they stand.

    ``path`` names the headings of all levels that a block stands under.

    A page mark holds from its line on, a section from its heading on; a heading that only repeats the
    title before any paragraph names none.  Blank lines, page marks and lines that are no text end a
    paragraph.  Null texts give nothing; rows of one ``row`` value must be one.
    """
    lines = texts.select(F.col(row).alias("row"), title_key(F.col(title)).alias("title"), F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n")).alias("n", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", r"(?U)^\s+|\s+$", "")))
    page = F.when(F.col("line").rlike(PAGE_COMMENT), F.regexp_extract("line", PAGE_COMMENT, 1)).when(F.col("line").rlike(PAGE_HEADING), F.regexp_extract("line", PAGE_HEADING, 1)).cast("int")
    kind = F.when(F.col("line") == "", "blank").when(page.isNotNull(), "page").when(F.col("line").rlike(HEADING), "heading").when(F.col("line").rlike(NOISE), "noise").otherwise("text")
    # lines of one text are in one task: a text fits into a worker
    order = Window.partitionBy("row").orderBy("n")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    marked = lines.withColumn("kind", kind).withColumn("mark", page).withColumn("heading", F.when(F.col("kind") == "heading", F.regexp_extract("line", HEADING, 1)))
    marked = marked.withColumn("wrapper", (F.col("kind") == "heading") & (title_key(F.col("heading")) == F.col("title")) & ~F.coalesce(F.max(F.col("kind") == "text").over(before), F.lit(False)))
    marked = marked.withColumn("page", F.last("mark", ignorenulls=True).over(so_far)).withColumn("section", F.last(F.when(~F.col("wrapper"), F.col("heading")), ignorenulls=True).over(so_far))
    marked = marked.withColumn("begins", ((F.col("kind") == "heading") | ((F.col("kind") == "text") & (F.coalesce(F.lag("kind").over(order), F.lit("")) != "text"))).cast("int")).withColumn("block_no", F.sum("begins").over(so_far))
    # a heading of a level ends those below it
    level = F.length(F.regexp_extract("line", r"^(#+)", 1))
    levels = marked.withColumn("level", F.when((F.col("kind") == "heading") & ~F.col("wrapper"), level))
    for k in range(1, 7):
        levels = levels.withColumn(f"h{k}", F.last(F.when(F.col("level") == k, F.struct("n", "heading")), ignorenulls=True).over(so_far))
    above = lambda k: F.coalesce(F.greatest(F.lit(-2), F.lit(-1), *(F.coalesce(F.col(f"h{j}.n"), F.lit(-1)) for j in range(1, k))), F.lit(-1))
    path = F.array_compact(F.array(*(F.when(F.col(f"h{k}.n") > above(k), F.col(f"h{k}.heading")) for k in range(1, 7))))
    marked = levels.withColumn("path", F.array_join(path, " / "))
    held = marked.filter((F.col("kind") == "text") | ((F.col("kind") == "heading") & ~F.col("wrapper")))
    blocks = held.groupBy("row", "block_no").agg(F.first("page").alias("page"), F.first("section").alias("section"), F.first("path").alias("path"), F.first("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("n", "line"))).alias("x"))
    place = F.row_number().over(Window.partitionBy("row").orderBy("block_no"))
    body = F.array_join(F.transform("x", lambda x: x["line"]), "\n")
    return blocks.select("row", place.alias("block_no"), "page", "section", "path", "kind", F.when(F.col("kind") == "heading", F.col("section")).otherwise(body).alias("body"))
