"""A whole build: files to records, codes, statistics, outputs and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import feature_centroid
from ..functions.parse import TYPE_CODE, dept_of
from ..operators import consolidate, qa, recode, stats
from ..sources import geo, lines, sinks
from ..sources.shared import find, staged


def layer_features(polygons: DataFrame, src: DataFrame, key: str, years: list[int], types: list[int]) -> DataFrame:
    """Features of a layer: one polygon of each code (city parents left out), its statistics, 0 sales where there are none."""
    areas = geo.first_of_code(polygons).filter(~F.col("code").isin(recode.CITY_PARENTS))
    numbers = stats.entity_total(src, key).join(stats.wide(src, key, years, types), key, "left").withColumnRenamed(key, "code")
    rows = stats.with_spine(areas.select("code", "name", "polys", feature_centroid(F.col("polys")).alias("c")), numbers, "code")
    names = [c for c in numbers.columns if c not in ("code", "n_tot")]
    rows = rows.select("code", F.col("name").alias("nom"), "polys", "c.cx", "c.cy", "n_tot", *names)
    return rows.select("code", "n_tot", sinks.polygon_feature(["code", "nom", "cx", "cy", "n_tot", *names]).alias("feature"))


def build(
    spark: SparkSession, sales: str, communes: str, departements: str, movements: str | None, out: str, version: str, generated: str, dense: int = stats.DENSE, least: int = stats.LEAST_PER_QUARTER, reset_baseline: bool = False
) -> dict:
    """Read the files of `sales` (globs), consolidate, re-code, and write to the folder `out`: records, points, the
    Parquet export, layers, bundles with their manifest, counters and the report of the checks. Returns the counters.

    Ids in several records and transactions without commune stop the build. A report with errors is set apart."""
    raw = lines.read_raw(spark, find(spark, sales))
    counters = lines.counters(raw).first().asDict()
    kept, rejected = consolidate.consolidate(lines.to_lines(raw))
    kept, rejected = staged(kept, "records"), staged(rejected, "rejected")
    areas = geo.read_polygons(spark, find(spark, communes)).withColumn("pos", F.dense_rank().over(Window.orderBy("file", "pos")))  # a layer has some ten thousand features
    moves = geo.read_movements(spark, movements) if movements else spark.createDataFrame([], "mod string, date_eff string, typecom_av string, com_av string, typecom_ap string, com_ap string, pos long")
    known = areas.filter("code IS NOT NULL").select("code", "polys", "pos")
    consolidate.refuse_duplicates(kept)
    moved = recode.remap(kept, known, moves)[0]
    moved = recode.with_children(moved, recode.reassign_children(moved, known, moves))
    records = staged(recode.refuse_without_commune(moved), "recoded")
    src = stats.stats_source(records)
    years = stats.years_of(src) or []

    sinks.write_lines(records.drop("file", "biens", "bare_lines"), f"{out}/mutations")
    sinks.write_points(records, f"{out}/points")
    sinks.write_parquet(records, f"{out}/export")
    layers = {"communes": (areas, "com"), "departements": (geo.read_polygons(spark, find(spark, departements)), "dep")}
    for name, (polygons, key) in layers.items():
        sinks.write_collection(layer_features(polygons, src, key, years, sorted(TYPE_CODE.values())), f"{out}/{name}.geojson", "code")
    spine = geo.first_of_code(areas).filter(~F.col("code").isin(recode.CITY_PARENTS)).select(F.col("code").alias("com"))
    documents = stats.entity_documents(src, spine, "com", years, dense, least)
    bundles = staged(sinks.bundles(documents, "com", dept_of(F.col("com")), version), "bundles")
    sinks.write_each(bundles, "dep", f"{out}/stats/dep")
    departments = [r["dep"] for r in bundles.select("dep").orderBy("dep").collect()]

    totals = records.agg(F.count("*").alias("records"), F.coalesce(F.sum("bare_lines"), F.lit(0)).alias("embedded_lines_without_place")).first().asDict()
    missing = qa.missing_geometry(stats.entity_total(src, "com").withColumnRenamed("com", "code"), spine.withColumnRenamed("com", "code"))
    counts = counters | totals | {"rejected": rejected.count(), "codes_without_geometry": missing.count(), "by_year": {str(r["annee"]): r["count"] for r in src.groupBy("annee").count().orderBy("annee").collect()}}
    counts |= qa.exposure(missing, totals["records"]).first().asDict() | {"first_codes_without_geometry": [r["code"] for r in qa.first_codes(missing).collect()]}
    manifest = sinks.write_manifest(f"{out}/stats/manifest.json", version, generated, years, dense, {k: v for k, v in counts.items() if isinstance(v, int)}, departments)
    sinks.write_document(f"{out}/prepare_stats.json", counts)

    share = qa.rejected_share(kept, rejected)
    checks = {"price_range": ("warning", qa.price_range(records)), "rejected_share": ("warning", share.filter("over")), "without_geometry": ("warning", missing), "bundles": ("error", qa.bundle_findings(manifest, bundles))}
    report = [r.asDict() for r in qa.report(spark, checks).collect()]
    last = None if reset_baseline else sinks.last_totals(out).get("records")
    report.append({"check": "count_moved", "severity": "error", "violations": int(qa.count_moved(totals["records"], last))})
    counts["ok"] = sinks.write_report(out, report, {"records": totals["records"]})
    return counts
