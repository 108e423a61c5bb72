"""Listings pasted from web pages: numbered lines, record starts found by shape, records by a running count.

The line rules replace a state machine: a line belongs to the last start before it, which a window over the
file's lines counts. One file is one window group; a pasted page is small, and files are dealt out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sitefold import vocabulary as V
from sitefold.functions.address import ACTIVITY_LINE, DATE_LINE, ID_DATE_LINE, REMARK_LINE, bullets, clean_region, group_for, slaughter_letter, species_of_line, split_food_city, split_health_city
from sitefold.functions.text import lookup, squeeze
from sitefold.sources.files import file_stem, read_documents

# The columns of the listings, and the line that starts a page.
FOOD = "approval_number name address city postcode region country group section activity slaughter species remarks date_of_approval publication_date".split()
HEALTH = "approval_number name address city postcode region country section section_label activity species last_update".split()
MARK = "Skip to Main Content"
NOISE = "|".join(re.escape(x) for x in V.NOISE_LINES)


def lines(docs: DataFrame) -> DataFrame:
    """(file, doc, n, line) of (file, text): pages split at the mark; what stands before the first of several is dropped."""
    parts = F.split(F.regexp_replace("text", "\r\n?", "\n"), MARK)
    pages = docs.select("file", F.posexplode(F.when(F.size(parts) > 2, F.slice(parts, 2, F.size(parts))).otherwise(parts)).alias("doc", "page"))
    return pages.select("file", "doc", F.posexplode(F.split("page", "\n")).alias("n", "line"))


def _noise(x: Column) -> Column:
    """Chrome is matched from the line's start, so that a place whose name contains such a word is kept."""
    return x.rlike(f"^\\s*(?:{NOISE})\\b") & ~x.rlike("^Country:") | x.rlike("^\\s*ago\\.")


def food(spark: SparkSession, path) -> DataFrame:
    """Rows of FOOD from pasted food listings, in the tabbed layout or, for pages without one such row, in blocks
    of lines between blank ones."""
    at = lines(read_documents(spark, path))
    page = Window.partitionBy("file", "doc")
    order = page.orderBy("n")
    cells = F.transform(F.split("line", "\t|  +"), lambda x: F.trim(x))
    at = at.withColumns({"cells": cells, "line": F.trim("line")})
    country = F.regexp_extract("line", r"^Country:\s*(.+?)\s*$", 1)
    head = F.regexp_extract("line", r"List view\s*\(\s*(.+?)\s*-\s*(.+?)\s*\)", 1)
    title = F.regexp_extract("line", r"List view\s*\(\s*(.+?)\s*-\s*(.+?)\s*\)", 2)
    coded = F.regexp_extract("line", V.SECTION_CODE, 1)
    first = lambda c: F.first(F.nullif(c, F.lit("")), ignorenulls=True).over(page.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    at = at.withColumns({
        "country": F.coalesce(first(country), first(head), F.initcap(F.regexp_replace(file_stem(), "_", " "))),
        "section": F.coalesce(first(F.coalesce(lookup(F.lower(title), V.SECTION_NAMES), F.lit(""))), first(F.when(F.col("line").rlike("^(Food|Section)"), coded).otherwise(F.lit("")))),
    })
    shown = ~_noise(F.col("line")) & ~F.col("line").rlike("^(Country:|List view|Food )")
    wide = (F.size("cells") >= 4) & (F.get("cells", F.lit(0)) != "") & shown
    at = at.withColumn("_wide", wide).withColumn("_any", F.max(F.col("_wide").cast("int")).over(page))
    gap = F.lag("line", 1, "").over(order) == ""
    start = F.when(F.col("_any") == 1, F.col("_wide")).otherwise(gap & (F.col("line") != "") & shown)
    at = at.withColumn("_start", start).withColumn("rec", F.sum(F.col("_start").cast("int")).over(order)).where("rec > 0 AND line <> ''")
    at = at.where(F.col("_start") | shown)
    at = at.withColumn("k", F.row_number().over(Window.partitionBy("file", "doc", "rec").orderBy("n")))
    narrow = (F.col("_any") == 0) & (F.col("k") <= 4)
    species, act = species_of_line(F.col("line")), F.regexp_extract("line", ACTIVITY_LINE, 1)
    kind = (
        F.when(F.col("_start") | narrow, "head").when(F.col("line").rlike(DATE_LINE), "date").when(F.col("line").rlike(ID_DATE_LINE), "id").when(species.isNotNull(), "species")
        .when(act != "", "activity").when(F.col("line").rlike(REMARK_LINE), "remark").otherwise("region")
    )
    at = at.withColumns({"kind": kind, "_sp": species, "_act": act})
    listed = lambda k, c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("n", F.col(c).alias("v"))))), lambda x: x["v"]))
    head_cells = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "head", F.struct("n", F.when(F.col("_any") == 1, F.col("cells")).otherwise(F.array("line")).alias("v"))))), lambda x: x["v"]))
    rows = at.groupBy("file", "doc", "rec", "country", "section").agg(head_cells.alias("h"), listed("species", "_sp").alias("sp"), listed("activity", "_act").alias("acts"), listed("region", "line").alias("reg"), listed("remark", "line").alias("rem"), listed("activity", "line").alias("shown"), listed("date", "line").alias("dates"))
    city, code = split_food_city(F.get("h", F.lit(3)))
    tail = F.filter(F.slice("h", 5, 20), lambda x: x != "")
    return rows.select(
        "file", "doc", "rec", F.get("h", F.lit(0)).alias("approval_number"), F.get("h", F.lit(1)).alias("name"), F.get("h", F.lit(2)).alias("address"), city.alias("city"), code.alias("postcode"),
        clean_region(F.array_join(F.concat(tail, "reg"), ";")).alias("region"), "country", group_for(F.col("country")).alias("group"), "section", F.array_join("acts", " ").alias("activity"),
        slaughter_letter(F.col("acts"), F.coalesce("section", F.lit("")), V.NO_ACTIVITY_SECTIONS).alias("slaughter"), F.array_join("sp", " ").alias("species"),
        F.array_join(F.concat("shown", "rem"), " | ").alias("remarks"), F.coalesce(F.get("dates", F.lit(0)), F.lit("")).alias("date_of_approval"), F.lit("").alias("publication_date"),
    )


def health(spark: SparkSession, path) -> DataFrame:
    """Rows of HEALTH from pasted animal-health listings: a table between bars, lines after a row adding to it."""
    at = lines(read_documents(spark, path)).withColumn("line", F.rtrim(F.regexp_replace("line", " ", " ")))
    order = Window.partitionBy("file", "doc").orderBy("n")
    told = F.lag(F.trim("line")).over(order)
    label = lambda name: F.last(F.when(told == f"{name}:", F.trim("line")), ignorenulls=True).over(order)
    at = at.withColumns({"country": label("Country"), "_section": label("Section"), "last_update": label("Last update"), "_value": told.isin("Country:", "Section:", "Last update:")})
    at = at.withColumns({"section": F.regexp_extract("_section", r"^(?:[A-Za-z][A-Za-z ]*?\s)?([A-Z][A-Z0-9]*(?:-[A-Z0-9]+)*)\s+(\S.*)$", 1), "section_label": F.regexp_extract("_section", r"^(?:[A-Za-z][A-Za-z ]*?\s)?([A-Z][A-Z0-9]*(?:-[A-Z0-9]+)*)\s+(\S.*)$", 2)})
    at = at.withColumn("cells", F.split("line", "\\|"))
    start = (F.size("cells") >= 6) & ~F.col("line").startswith("Approval number")
    at = at.withColumn("_start", start).withColumn("rec", F.sum(F.col("_start").cast("int")).over(order))
    more = ~F.col("_start") & F.col("line").rlike("^[\t •]") & ~F.col("_value")
    at = at.where((F.col("rec") > 0) & (F.col("_start") | more))
    items = F.when(F.col("_start"), F.concat(bullets(F.get("cells", F.lit(5))), bullets(F.get("cells", F.lit(6))))).otherwise(bullets(F.col("line")))
    at = at.withColumn("items", F.filter(items, lambda x: ~x.rlike(f"^(?:{NOISE})\\b")))
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "items"))), lambda x: x["items"]))
    rows = at.groupBy("file", "doc", "rec").agg(F.min_by(F.struct("cells", "country", "section", "section_label", "last_update"), "n").alias("h"), ordered.alias("items"))
    cell = lambda k: squeeze(F.coalesce(F.get("h.cells", F.lit(k)), F.lit("")))
    city, code = split_health_city(F.get("h.cells", F.lit(3)))
    sp = F.array_distinct(F.array_compact(F.transform("items", species_of_line)))
    return rows.select(
        "file", "doc", "rec", cell(0).alias("approval_number"), cell(1).alias("name"), cell(2).alias("address"), city.alias("city"), code.alias("postcode"), cell(4).alias("region"),
        "h.country", "h.section", "h.section_label", F.array_join(F.array_distinct(F.filter("items", lambda x: species_of_line(x).isNull())), " | ").alias("activity"), F.array_join(sp, " ").alias("species"), "h.last_update",
    )


def merged(existing: DataFrame, new: DataFrame, key=("approval_number", "name", "section")) -> DataFrame:
    """Existing rows, and new ones whose key they don't have; repeats within the paste stay."""
    fresh = new.join(existing.select(*key), list(key), "left_anti")
    return existing.unionByName(fresh.select(*[c for c in existing.columns if c in fresh.columns]), allowMissingColumns=True)


def write_rows(df: DataFrame, path: str, columns: list[str] = FOOD) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
