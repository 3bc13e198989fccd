"""Mercator tiles: assignment, bands, containment, size-bounded samples, view queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import tile_x, tile_y, tiles_of_bbox

TILE_PROPERTIES = ["id", "date", "nat", "type", "vf", "sb", "st", "np", "nl", "com", "adr", "cp"]
#: Zoom ranges of the layers.
LAYERS = {"mutations": (4, 14), "communes": (6, 10), "departements": (4, 6), "iris": (10, 14)}
EXHAUSTIVE_FROM = 13


def assign(points: DataFrame, z: int) -> DataFrame:
    return points.withColumn("z", F.lit(z)).withColumn("x", tile_x(F.col("lon"), z)).withColumn("y", tile_y(F.col("lat"), z))


def pyramid(points: DataFrame, lowest: int, deepest: int) -> DataFrame:
    """A row per point and level: coordinates at the deepest level, shifted for those above it."""
    deep = points.withColumn("_x", tile_x(F.col("lon"), deepest)).withColumn("_y", tile_y(F.col("lat"), deepest))
    deep = deep.withColumn("z", F.explode(F.sequence(F.lit(lowest), F.lit(deepest))))
    shift = F.pow(F.lit(2.0), F.lit(deepest) - F.col("z"))
    return deep.withColumn("x", F.floor(F.col("_x") / shift).cast("int")).withColumn("y", F.floor(F.col("_y") / shift).cast("int")).drop("_x", "_y")


def tile_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("z", "x", "y").agg(F.count("*").alias("n"))


def missing_in_parent(parents: DataFrame, children: DataFrame) -> DataFrame:
    """(x, y, id) of children that their parent tile lacks."""
    up = children.select(F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y"), "id").distinct()
    return up.join(parents.select("x", "y", "id"), ["x", "y", "id"], "left_anti")


def sample(assigned: DataFrame, most: int, order) -> DataFrame:
    """At most `most` points per tile, the first by `order` (then id)."""
    w = Window.partitionBy("z", "x", "y").orderBy(order, "id")
    return assigned.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")


def sample_by_size(assigned: DataFrame, budget: int, size) -> DataFrame:
    """Points of each tile in the order of a hash of their id while their sizes' sum is within the budget.

    Sums go by 1024 ranges of the hash first; only points of the range in which the budget ends, and of those
    before it, are ordered, range by range, so no task orders a whole tile."""
    key = ["z", "x", "y", "_range"]
    rows = assigned.withColumn("_size", size).withColumn("_hash", F.xxhash64("id")).withColumn("_range", F.shiftright("_hash", 54))
    before = Window.partitionBy("z", "x", "y").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*key).agg(F.sum("_size").alias("_all")).withColumn("_before", F.coalesce(F.sum("_all").over(before), F.lit(0))).filter(F.col("_before") <= budget)
    inside = Window.partitionBy(*key).orderBy("_hash", "id").rowsBetween(Window.unboundedPreceding, 0)
    kept = rows.join(sums.drop("_all"), key).withColumn("_sum", F.col("_before") + F.sum("_size").over(inside)).filter(F.col("_sum") <= budget)
    return kept.select(*assigned.columns)


def low_zoom(points: DataFrame) -> DataFrame:
    """Points for the levels below the exhaustive band: without address and postcode."""
    return points.drop("adr", "cp")


def view(assigned: DataFrame, lon0: float, lat0: float, lon1: float, lat1: float, map_zoom: float, most: int | None = 16) -> DataFrame:
    """Rows of the tiles of a view at its data level, the first `most` tiles by (x, y)."""
    z = min(int(map_zoom), 14)
    tiles = tiles_of_bbox(lon0, lat0, lon1, lat1, z)[:most]
    keys = assigned.sparkSession.createDataFrame(tiles or [(-1, -1)], "x int, y int")
    return assigned.filter(F.col("z") == z).join(keys, ["x", "y"], "left_semi")
