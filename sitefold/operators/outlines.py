"""Countries of positions, from a cover of their outlines with cells.

A cell that no border touches lies inside an outline or outside of it as a whole; that is decided once, at its centre. In
a border's cell the even-odd rule decides, over the border lines of that latitude band from the cell on eastwards. Each
cell has one row: the outlines that hold or cross it, and the corners within reach. Positions join on the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitefold.plans.shared import materialise

#: Degrees of a cell's side, what a border may lie off its computed place, and lines and corners of a cover that is broadcast.
CELL, SLACK, MOST_BROADCAST = 1.0, 1e-9, 1_000_000

#: (iso3, rings of (lon, lat)) for each country, in order of preference.
Outlines = list[tuple[str, list[list[list[float]]]]]

LINE = "struct<ring:int,x0:double,y0:double,x1:double,y1:double>"


def lines(spark: SparkSession, outlines: Outlines) -> DataFrame:
    """(rank, iso, ring, x0, y0, x1, y1): each ring's lines, the closing one included."""
    rows = [(rank, iso, n, *map(float, (*a, *b))) for rank, (iso, rings) in enumerate(outlines) for n, ring in enumerate(rings) for a, b in zip([ring[-1], *ring], ring)]
    return spark.createDataFrame(rows, "rank int, iso string, ring int, x0 double, y0 double, x1 double, y1 double")


def _cell(c: Column) -> Column:
    return F.floor(c / CELL).cast("int")


def _cells(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(_cell(low - SLACK), _cell(high + SLACK)))


def _odd(found: Column, x: Column, y: Column, open_rings: bool = False) -> Column:
    """Whether a ray eastwards from (x, y) meets an odd number of lines; with open_rings those of rings that (x, y) lies on do not count."""
    level = lambda s: s["y0"] == s["y1"]
    at = lambda s: F.when(~level(s), (s["x0"] - s["x1"]) * (y - s["y1"]) / (s["y0"] - s["y1"]) + s["x1"])
    meets = lambda s: ((s["y1"] > y) != (s["y0"] > y)) & (x < at(s))
    odd = F.size(F.filter(found, meets)) % 2 == 1
    if not open_rings:
        return odd
    between = lambda v, a, b: v.between(F.least(a, b), F.greatest(a, b))
    on = lambda s: between(y, s["y0"], s["y1"]) & F.when(level(s), between(x, s["x0"], s["x1"])).otherwise((x == at(s)) | (x == s["x0"]) & (y == s["y0"]) | (x == s["x1"]) & (y == s["y1"]))
    touched = F.transform(F.filter(found, on), lambda s: s["ring"])
    return F.when(F.exists(found, on), F.size(F.filter(found, lambda s: meets(s) & ~F.array_contains(touched, s["ring"]))) % 2 == 1).otherwise(odd)


def cover(spark: SparkSession, outlines: Outlines, near: float) -> DataFrame:
    """(cy, cx, entries, corners), written."""
    all_lines = lines(spark, outlines)
    banded = all_lines.select("*", _cells(F.least("y0", "y1"), F.greatest("y0", "y1")).alias("cy"))
    at = lambda y: F.when(F.col("y0") == F.col("y1"), F.col("x0")).otherwise(F.col("x0") + (F.col("x1") - F.col("x0")) * (y - F.col("y0")) / (F.col("y1") - F.col("y0")))
    low, high = F.greatest(F.least("y0", "y1"), F.col("cy") * CELL), F.least(F.greatest("y0", "y1"), (F.col("cy") + 1) * CELL)
    ends = lambda f: F.when(F.col("y0") == F.col("y1"), f("x0", "x1")).otherwise(f(at(low), at(high)))
    border = banded.select("rank", "iso", "cy", _cells(ends(F.least), ends(F.greatest)).alias("cx")).distinct()
    bands = banded.groupBy("rank", "cy").agg(F.collect_list(F.struct("ring", "x0", "y0", "x1", "y1")).alias("lines"))
    none = F.array().cast(f"array<{LINE}>")
    reach = border.groupBy("rank", "iso", "cy").agg(F.min("cx").alias("_a"), F.max("cx").alias("_b"))
    between = reach.select("rank", "iso", "cy", F.explode(F.sequence("_a", "_b")).alias("cx"))
    inner = between.join(border, ["rank", "iso", "cy", "cx"], "left_anti").join(bands, ["rank", "cy"])
    inner = inner.where(_odd(F.col("lines"), (F.col("cx") + 0.5) * CELL, (F.col("cy") + 0.5) * CELL)).select("cy", "cx", "rank", "iso", F.lit(True).alias("whole"), none.alias("lines"))
    east = F.filter(F.coalesce("lines", none), lambda s: F.greatest(s["x0"], s["x1"]) >= F.col("cx") * CELL - SLACK)
    crossed = border.join(bands, ["rank", "cy"], "left").select("cy", "cx", "rank", "iso", F.lit(False).alias("whole"), east.alias("lines"))
    entries = inner.unionByName(crossed).groupBy("cy", "cx").agg(F.collect_list(F.struct("rank", "iso", "whole", "lines")).alias("entries"))
    around = lambda c: _cells(F.col(c) - near, F.col(c) + near)
    corners = all_lines.where(F.lit(near > 0)).select("rank", "iso", "x1", "y1", around("x1").alias("cx")).select("*", around("y1").alias("cy"))
    corners = corners.groupBy("cy", "cx").agg(F.collect_list(F.struct("rank", "iso", F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("corners"))
    return materialise(entries.join(corners, ["cy", "cx"], "full"), "outline-cover")


def with_country(rows: DataFrame, outlines: Outlines, lat: Column, lon: Column, into: str, near: float = 1.0, open_rings: bool = False) -> DataFrame:
    """rows with the column `into`: its own value where it has one, else the first outline that holds the position, by the
    even-odd rule over all its rings, else the one with the nearest corner within `near` degrees; null if none.

    A position exactly on a ring's line is in or out of the ring by the line's side, as in the registers' earlier
    processing; with open_rings it is outside of that ring.
    """
    spark = rows.sparkSession
    cells = cover(spark, outlines, near)
    size = cells.agg(F.sum(F.aggregate(F.coalesce("entries", F.array()), F.lit(0), lambda a, e: a + 1 + F.size(e["lines"])) + F.coalesce(F.size("corners"), F.lit(0)))).first()[0] or 0
    rows = rows if into in rows.columns else rows.withColumn(into, F.lit(None).cast("string"))
    kept = rows.columns
    open_ = F.col(into).isNull() & lat.isNotNull() & lon.isNotNull()
    rows = rows.withColumns({"_x": F.when(open_, lon.cast("double")), "_y": F.when(open_, lat.cast("double"))})
    rows = rows.withColumns({"_cx": _cell(F.col("_x")), "_cy": _cell(F.col("_y"))})
    x, y = F.col("_x"), F.col("_y")
    held = F.filter("entries", lambda e: e["whole"] | _odd(e["lines"], x, y, open_rings))
    first = F.array_min(F.transform(held, lambda e: F.struct(e["rank"].alias("rank"), e["iso"].alias("iso"))))["iso"]
    far = lambda c: (c["x"] - x) * (c["x"] - x) + (c["y"] - y) * (c["y"] - y)
    nearest = F.array_min(F.filter(F.transform("corners", lambda c: F.struct(far(c).alias("d"), c["rank"].alias("rank"), c["iso"].alias("iso"))), lambda c: c["d"] < near * near))["iso"]
    found = F.coalesce(F.col(into), first, nearest)
    match = [F.col("_cy") == F.col("cy"), F.col("_cx") == F.col("cx")]
    if size <= MOST_BROADCAST:
        return rows.join(F.broadcast(cells), match, "left").withColumn(into, found).select(*kept)
    # Rows without a cell would all meet in one task, so only the others are dealt out.
    rest = rows.where("_cx IS NULL").select(*kept)
    return rows.where("_cx IS NOT NULL").join(cells, match, "left").withColumn(into, found).select(*kept).unionByName(rest)
