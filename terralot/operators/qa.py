"""Quality checks: each returns the rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Layers that a finished archive must have, with their zoom ranges.
EXPECTED = [("mutations", 4, 14), ("communes", 6, 10), ("departements", 4, 6)]
REQUIRED = ["id", "date", "nat", "sb", "st", "np", "nl", "com"]


def layer_ranges(found: DataFrame) -> DataFrame:
    """Expected layers that are missing or whose zoom range differs. found: name, minzoom, maxzoom."""
    want = found.sparkSession.createDataFrame(EXPECTED, "name string, minzoom int, maxzoom int")
    return want.join(found, ["name", "minzoom", "maxzoom"], "left_anti")


def attribute_coverage(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Per group: how many rows, and which share of them has each attribute, in percent (one decimal)."""
    share = lambda c: F.bround(F.avg(F.col(c).isNotNull().cast("int")) * 100, 1).alias(f"pct_{c}")
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[share(c) for c in names])


def attributes_everywhere(features: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Per group the required attributes that some feature lacks. features: props MAP."""
    has = [F.min(F.map_contains_key("props", n).cast("int")).alias(n) for n in names]
    got = features.groupBy(*keys).agg(*has)
    lacking = F.array_compact(F.array(*[F.when(F.col(n) == 0, F.lit(n)) for n in names]))
    return got.select(*keys, lacking.alias("lacking")).filter(F.size("lacking") > 0)


def sample_findings(sales: DataFrame) -> DataFrame:
    """(z, what, severity) of decoded sample tiles' sales: prices absent (error) or below 90 % (warning);
    address and postcode below 80 % from the exhaustive levels on (error if absent), and present below them (error)."""
    share = lambda c: F.avg(F.col(c).isNotNull().cast("int")).alias(c)
    rows = sales.groupBy("z").agg(share("vf"), share("adr"), share("cp"))

    def finding(what: str, error, warning):
        return F.when(error, F.struct(F.lit(what).alias("what"), F.lit("error").alias("severity"))).when(warning, F.struct(F.lit(what).alias("what"), F.lit("warning").alias("severity")))

    deep = F.col("z") >= 13
    found = [finding("vf", F.col("vf") == 0, F.col("vf") < 0.9)]
    found += [finding(c, (deep & (F.col(c) == 0)) | (~deep & (F.col(c) > 0)), deep & (F.col(c) < 0.8)) for c in ("adr", "cp")]
    return rows.select("z", F.explode(F.array_compact(F.array(*found))).alias("f")).select("z", "f.what", "f.severity")


def unequal_versions(manifest_version: str, bundles: DataFrame) -> DataFrame:
    """Bundles of another version than the manifest's. Columns: dep, version."""
    return bundles.filter(~F.col("version").eqNullSafe(F.lit(manifest_version)))


def price_range(rows: DataFrame, least: int = 1, below: int = 1_000_000_000) -> DataFrame:
    return rows.filter((F.col("vf") < least) | (F.col("vf") >= below))


def rejected_share(kept: DataFrame, rejected: DataFrame, limit: float = 5.0) -> DataFrame:
    """(kept, rejected, pct, over)."""
    counts = kept.agg(F.count("*").alias("kept")).crossJoin(rejected.agg(F.count("*").alias("rejected")))  # of one row each
    pct = F.bround(F.try_divide(F.col("rejected") * 100.0, F.col("kept") + F.col("rejected")), 2)
    return counts.withColumn("pct", F.coalesce(pct, F.lit(0.0))).withColumn("over", F.col("pct") > limit)


def count_moved(now: int, last: int | None, limit: float = 20.0) -> bool:
    """Whether the count left the last good one's neighbourhood of `limit` percent."""
    return bool(last) and abs(now - last) * 100.0 / last > limit


def heavy_tiles(tiles: DataFrame, most_bytes: int = 800_000, from_zoom: int = 13) -> DataFrame:
    return tiles.filter((F.col("z") >= from_zoom) & (F.length("data") > most_bytes))


def zooms_without_sample(tiles: DataFrame, zooms: list[int]) -> DataFrame:
    want = tiles.sparkSession.createDataFrame([(z,) for z in zooms], "z int")
    return want.join(tiles.select("z"), "z", "left_anti")


def outside_tolerance(tile_counts: DataFrame, source_counts: DataFrame) -> DataFrame:
    """Tiles whose count is off the source's by more than max(2, source / 1000)."""
    both = tile_counts.withColumnRenamed("n", "n_tile").join(source_counts.withColumnRenamed("n", "n_src"), ["z", "x", "y"], "full").fillna(0, ["n_tile", "n_src"])
    return both.filter(F.abs(F.col("n_tile") - F.col("n_src")) > F.greatest(F.lit(2.0), F.col("n_src") / 1000))


def unequal_totals(layer: DataFrame, bundles: DataFrame) -> DataFrame:
    """Entities whose n_tot differs between layer and bundle (those in one only don't count). Columns: code, n_tot."""
    a, b = layer.select("code", F.coalesce("n_tot", F.lit(0)).alias("n_layer")), bundles.select("code", F.col("n_tot").alias("n_bundle"))
    return a.join(b, "code").filter("n_layer <> n_bundle")


def unaligned(entities: DataFrame, n_years: int) -> DataFrame:
    """Entities with an array whose length isn't that of the axis of years. Columns: code, n, pm2_med."""
    return entities.filter((F.size("n") != n_years) | (F.size("pm2_med") != n_years))


def missing_geometry(stats: DataFrame, geometry: DataFrame) -> DataFrame:
    """Entities with statistics but no geometry."""
    return stats.join(geometry.select("code"), "code", "left_anti")


def exposure(missing: DataFrame, total: int) -> DataFrame:
    """How many sales have no geometry, and which share of all, in percent (three decimals)."""
    return missing.agg(F.coalesce(F.sum("n_tot"), F.lit(0)).alias("sales")).withColumn("pct", F.bround(F.col("sales") * 100.0 / max(1, total), 3))


def report(spark: SparkSession, checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(check, severity, violations) of named (severity, violations) pairs, in one pass over their union."""
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), F.lit(how).alias("severity"), "violations") for name, (how, df) in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def first_codes(missing: DataFrame, most: int = 20) -> DataFrame:
    """The first codes, in order, to show in a report."""
    return missing.select("code").orderBy("code").limit(most)


ARRAYS = ["n", "pm2_med", "vf_med", "sb_med", "st_med", "np_med"]
BUNDLE = "version string, entities map<string,struct<code:string,n_tot:long,overall:struct<n:array<long>,pm2_med:array<int>>,byType:map<string,struct<n:array<long>,pm2_med:array<int>,vf_med:array<int>,sb_med:array<int>,st_med:array<int>,np_med:array<int>>>,quarters:array<struct<p:string,n:long,pm2_med:int>>>>"


def bundle_findings(manifest: dict | None, bundles: DataFrame) -> DataFrame:
    """(dep, code, what) of bundles (dep, value as JSON text): a missing manifest or bundle, another version, arrays
    not aligned with the manifest's years, quarters of entities below its threshold."""
    spark = bundles.sparkSession
    if manifest is None:
        return spark.createDataFrame([(None, None, "manifest")], "dep string, code string, what string")
    n = len(manifest.get("years") or [])
    rows = bundles.select("dep", F.from_json("value", BUNDLE).alias("b"))
    version = rows.filter(~F.col("b.version").eqNullSafe(F.lit(manifest.get("version")))).select("dep", F.lit(None).cast("string").alias("code"), F.lit("version").alias("what"))
    each = rows.select("dep", F.explode(F.map_values("b.entities")).alias("e"))
    off = lambda a: F.coalesce(F.size(a), F.lit(0)) != n
    types = F.exists(F.map_values("e.byType"), lambda t: F.array_contains(F.array(*[off(t[a]) for a in ARRAYS]), True))
    found = [F.when(off(F.col("e.overall.n")) | off(F.col("e.overall.pm2_med")), "overall"), F.when(F.coalesce(types, F.lit(False)), "byType")]
    if (least := manifest.get("dense_threshold")) is not None:
        found.append(F.when(F.col("e.quarters").isNotNull() & (F.col("e.n_tot") < least), "quarters"))
    entities = each.select("dep", F.col("e.code").alias("code"), F.explode(F.array_compact(F.array(*found))).alias("what"))
    listed = spark.createDataFrame([(d,) for d in manifest.get("departements", [])], "dep string").join(bundles.select("dep"), "dep", "left_anti")
    return version.unionByName(entities).unionByName(listed.select("dep", F.lit(None).cast("string").alias("code"), F.lit("bundle").alias("what")))
