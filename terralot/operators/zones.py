"""Points in zones: spatial joins, statistics and documents by zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import bbox, interior_point, tile_x, tile_y, within
from .stats import medians, rint


def join_zones(points: DataFrame, zones: DataFrame) -> DataFrame:
    """Points with the zone of their own commune that strictly holds them.

    zones: code, com, polys. The commune is the join key, so Spark shuffles or broadcasts by the zones'
    size; the box is tested before the polygon.
    """
    z = zones.withColumn("b", bbox(F.col("polys"))).select("code", F.col("com").alias("zone_com"), "polys", "b")
    in_box = F.col("lon").between(F.col("b.xmin"), F.col("b.xmax")) & F.col("lat").between(F.col("b.ymin"), F.col("b.ymax"))
    return points.join(z, (F.col("com") == F.col("zone_com")) & in_box & within(F.col("lon"), F.col("lat"), F.col("polys"))).drop("zone_com", "polys", "b")


#: Levels of the tiles that zones are covered with, and the most tiles of one zone (but at the lowest level).
COVER_LEVELS, COVER_TILES = (3, 6, 9), 64


def join_anywhere(points: DataFrame, zones: DataFrame, levels: tuple[int, ...] = COVER_LEVELS) -> DataFrame:
    """Points with the first zone (by pos) that strictly holds them, whatever its commune: an equi-join on
    tiles. A zone's box is covered at the deepest of the levels at which few tiles do, so large zones aren't
    cut into many; a point has a key for each level. zones: code, pos, polys. Beyond the map's edges the
    outermost tiles count."""
    edge = lambda lat: F.least(F.greatest(lat, F.lit(-85.0)), F.lit(85.0))
    column = lambda lon, z: F.least(F.greatest(tile_x(lon, z), F.lit(0)), F.lit(2**z - 1))
    row = lambda lat, z: tile_y(edge(lat), z)
    box = zones.withColumn("b", bbox(F.col("polys")))

    def span(z: int):
        x, y = (column(F.col("b.xmin"), z), column(F.col("b.xmax"), z)), (row(F.col("b.ymax"), z), row(F.col("b.ymin"), z))
        return F.struct(F.lit(z).alias("tz"), x[0].alias("x0"), x[1].alias("x1"), y[0].alias("y0"), y[1].alias("y1"))

    chosen = span(min(levels))
    for z in sorted(levels)[1:]:
        s = span(z)
        chosen = F.when((s["x1"] - s["x0"] + 1) * (s["y1"] - s["y0"] + 1) <= COVER_TILES, s).otherwise(chosen)
    cover = box.withColumn("s", chosen).withColumn("tx", F.explode(F.sequence("s.x0", "s.x1"))).withColumn("ty", F.explode(F.sequence("s.y0", "s.y1"))).withColumn("tz", F.col("s.tz"))
    keys = F.array(*[F.struct(F.lit(z).alias("tz"), column(F.col("lon"), z).alias("tx"), row(F.col("lat"), z).alias("ty")) for z in levels])
    keyed = points.withColumn("key", F.explode(keys)).select("*", "key.*").drop("key")
    hit = keyed.join(cover.select("code", "pos", "polys", "b", "tz", "tx", "ty"), ["tz", "tx", "ty"])
    hit = hit.filter(F.col("lon").between(F.col("b.xmin"), F.col("b.xmax")) & F.col("lat").between(F.col("b.ymin"), F.col("b.ymax"))).filter(within(F.col("lon"), F.col("lat"), F.col("polys")))
    return hit.groupBy(*points.columns).agg(F.min_by("code", "pos").alias("code"))


def unmatched(points: DataFrame, joined: DataFrame, key: str = "id") -> DataFrame:
    return points.join(joined.select(key), key, "left_anti")


def zone_stats(joined: DataFrame) -> DataFrame:
    return joined.groupBy("code").agg(F.count("*").alias("n_tot"), *medians(pm2_med="pm2", vf_med="vf"))


def zone_year_type(joined: DataFrame) -> DataFrame:
    return joined.filter("type IS NOT NULL").groupBy("code", "annee", "type").agg(F.count("*").alias("n"), rint(F.median("pm2")).alias("pm2_med"))


def zones_with_sales(zones: DataFrame, joined: DataFrame) -> DataFrame:
    return zones.join(joined.select("code"), "code", "left_semi")


def zone_layer(zones: DataFrame, joined: DataFrame) -> DataFrame:
    return zones.join(zone_stats(joined), "code")


def zone_documents(joined: DataFrame, columns: list[str]) -> DataFrame:
    """(code, doc): one JSON document per zone; nulls are left out. The transactions of a zone are few."""
    row = F.struct("id", *[c for c in columns if c != "id"])
    return joined.groupBy("code").agg(F.array_sort(F.collect_list(row)).alias("mutations")).select("code", F.to_json(F.struct("code", "mutations")).alias("doc"))


def zone_meta(joined: DataFrame, zones: DataFrame) -> DataFrame:
    """(code, name, com, com_name, n_tot, pm2_med) of each zone with sales; of several names of one code the least."""
    names = zones.groupBy("code").agg(*[F.min(c).alias(c) for c in ("name", "com", "com_name")])
    return names.join(joined.groupBy("code").agg(F.count("*").alias("n_tot"), *medians(pm2_med="pm2")), "code")


def zone_index(zones: DataFrame) -> DataFrame:
    """(code, com, lat, lon, bbox) of each zone: a point inside and the box, six decimals."""
    rows = zones.select("code", "com", interior_point(F.col("polys")).alias("p"), bbox(F.col("polys"), 6).alias("b"))
    return rows.select("code", "com", F.bround("p.y", 6).alias("lat"), F.bround("p.x", 6).alias("lon"), F.array("b.xmin", "b.ymin", "b.xmax", "b.ymax").alias("bbox"))


def sales_at(points: DataFrame, zones: DataFrame, documents: DataFrame) -> DataFrame:
    """Points (lon, lat, ...) with the zone that holds them and that zone's document (code, and columns that are worked out
    of it once); null where there is none. Only points in a zone are dealt by its code, so no task gets all the others."""
    located = join_anywhere(points, zones).join(documents, "code", "left")
    return points.join(located, points.columns, "left").select("code", *points.columns, *[c for c in documents.columns if c != "code"])
