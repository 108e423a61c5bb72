"""Published facilities laid out for maps: rows along a Z-order curve, so that a viewport or a search around a point
reads only the row groups that lie there, and the number of rows in each tile of a grid.

A layout is a Table in versions with two parts, rows and counts, committed together. Row groups are skipped by the
least and greatest x and y in their footers, which a curve keeps close together. Facilities without a position, and
those at a pole, which has no place on the map, are not part of it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitefold.functions.geo import mercator
from sitefold.plans.publish import inside
from sitefold.plans.store import Table

#: Bits of either coordinate in a place on the curve; bits of a tile of the counts (at most 4 ** TILE_BITS tiles).
BITS, TILE_BITS = 16, 10
#: Rows of a row group, the least that a search reads.
GROUP_ROWS = 16_384


def _spread(c: Column) -> Column:
    """A number's 16 bits at every other place."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return c


def _cell(c: Column, bits: int) -> Column:
    """The cell of a coordinate; what lies off the unit square is in the outermost one."""
    return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor(c * (1 << bits)))).cast("long")


def z_order(x: Column, y: Column) -> Column:
    return _spread(_cell(x, BITS)).bitwiseOR(F.shiftleft(_spread(_cell(y, BITS)), 1))


def lay_out(facilities: DataFrame, path: str, group_rows: int = GROUP_ROWS) -> int:
    """Writes a version of the layout: one shuffle by ranges of the curve; the counts are taken from what was written."""
    table = Table(facilities.sparkSession, path)
    base, _ = table.manifest()
    x, y = mercator(F.col("lat"), F.col("lon"))
    placed = facilities.where("abs(lat) < 90 AND lon IS NOT NULL").withColumns({"x": x, "y": y})
    rows = placed.withColumn("z", z_order(F.col("x"), F.col("y"))).repartitionByRange("z").sortWithinPartitions("z")
    parts = {"rows": table.write(rows, **{"parquet.block.row.count.limit": group_rows})[""]}
    at = facilities.sparkSession.read.parquet(f"{path}/{parts['rows']}").where("x >= 0 AND x < 1 AND y >= 0 AND y < 1")
    counts = at.groupBy(_cell(F.col("x"), TILE_BITS).alias("tx"), _cell(F.col("y"), TILE_BITS).alias("ty")).agg(F.count(F.lit(1)).alias("n"))
    parts["counts"] = table.write(counts)[""]
    return table.commit(parts, base, others=False)


class Tiles:
    """A version of a layout. Both searches are lazy scans of its rows, whose filters reach the row groups."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        folders = Table(spark, path).manifest(version)[1]
        if not folders:
            raise ValueError(f"no layout at {path}")
        self.rows = spark.read.parquet(f"{path}/{folders['rows']}")
        self.counts = spark.read.parquet(f"{path}/{folders['counts']}")

    def viewport(self, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
        return self.rows.where(inside(F.col("x"), F.col("y"), x0, y0, x1, y1))

    def radius(self, x: float, y: float, reach: float, n: int) -> float:
        """A distance within which n facilities lie for certain, or reach if that is less.

        Tiles are put into rings by the distance of their farthest corner; the first ring up to which they hold n
        facilities bounds the n-th nearest. There are at most 1.5 * 2 ** TILE_BITS rings around a point of the square.
        """
        side = 1 / (1 << TILE_BITS)
        far = lambda c, v: F.greatest(F.abs(c * side - v), F.abs((c + 1) * side - v))
        corner = F.hypot(far(F.col("tx"), x), far(F.col("ty"), y))
        near = self.counts.where(corner <= reach + side)
        rings = near.groupBy(F.ceil(corner / side).alias("ring")).agg(F.sum("n").alias("n")).orderBy("ring").collect()
        held = 0
        for r in rings:
            held += r["n"]
            if held >= n:
                return min(reach, math.nextafter(r["ring"] * side, math.inf))
        return reach

    def nearest(self, x: float, y: float, reach: float, n: int = 40) -> DataFrame:
        """The n facilities nearest to a point, within reach, with d2, the squared distance; of equals the smaller uid."""
        r = self.radius(x, y, reach, n)
        px, py = F.col("x"), F.col("y")
        d = (px - x) * (px - x) + (py - y) * (py - y)
        some = self.viewport(x - r, y - r, x + r, y + r).withColumn("d2", d)
        return some.where(F.col("d2") <= reach * reach).orderBy("d2", "uid").limit(n)
