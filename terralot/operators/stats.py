"""Counts and medians by entity, year, type and quarter.

All groupings of one source come from one GROUPING SETS pass; medians don't recombine, so each is
taken at the granularity at which it is shown. Medians are rounded half to even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import price_per_m2, quarter_of, year_of

DENSE, LEAST_PER_QUARTER = 200, 5


def rint(c: Column) -> Column:
    return F.rint(c).cast("int")


def stats_source(mutations: DataFrame) -> DataFrame:
    return mutations.withColumn("annee", year_of(F.col("date"))).withColumn("q", quarter_of(F.col("date"))).withColumn("pm2", price_per_m2(F.col("vf"), F.col("sb")))


def medians(**columns: str) -> list[Column]:
    return [rint(F.median(c)).alias(name) for name, c in columns.items()]


def entity_total(src: DataFrame, key: str) -> DataFrame:
    return src.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_tot"), *medians(pm2_med="pm2", vf_med="vf"))


def entity_year(src: DataFrame, key: str) -> DataFrame:
    return src.filter(F.col(key).isNotNull()).groupBy(key, "annee").agg(F.count("*").alias("n"), *medians(pm2_med="pm2"))


def entity_year_type(src: DataFrame, key: str) -> DataFrame:
    """Only transactions with a type."""
    rows = src.filter(F.col(key).isNotNull() & F.col("type").isNotNull())
    return rows.groupBy(key, "annee", "type").agg(F.count("*").alias("n"), *medians(pm2_med="pm2", vf_med="vf", sb_med="sb", st_med="st", np_med="np"))


def entity_quarter(src: DataFrame, key: str, dense: int = DENSE, least: int = LEAST_PER_QUARTER) -> DataFrame:
    """Quarters of at least `least` sales, of entities of at least `dense`."""
    totals = src.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_tot")).filter(F.col("n_tot") >= dense).select(key)
    quarters = src.filter(F.col(key).isNotNull()).groupBy(key, "annee", "q").agg(F.count("*").alias("n"), *medians(pm2_med="pm2")).filter(F.col("n") >= least)
    return quarters.join(totals, key, "left_semi")


def grouping_sets(src: DataFrame, key: str) -> DataFrame:
    """Totals, years, years and types, years and quarters in one pass; `level` tells which."""
    return src.sparkSession.sql(
        f"""
      SELECT {key}, annee, type, q, cast(grouping_id() AS int) AS level, count(*) AS n, cast(rint(median(pm2)) AS int) AS pm2_med, cast(rint(median(vf)) AS int) AS vf_med
      FROM {{src}} WHERE {key} IS NOT NULL
      GROUP BY GROUPING SETS (({key}), ({key}, annee), ({key}, annee, type), ({key}, annee, q))
    """,
        src=src,
    )


def years_of(src: DataFrame) -> list[int]:
    """The axis of years: those that occur, in order."""
    return src.select(F.sort_array(F.collect_set("annee"))).first()[0]


def wide(src: DataFrame, key: str, years: list[int], types: list[int]) -> DataFrame:
    """One row per entity: n_{year}_t{type} (0 where none) and p_{year}_t{type} (null where none)."""
    rows = src.filter(F.col(key).isNotNull() & F.col("type").isNotNull()).withColumn("slot", F.concat(F.col("annee").cast("string"), F.lit("_t"), F.col("type").cast("string")))
    slots = [f"{y}_t{t}" for y in years for t in types]
    out = rows.groupBy(key).pivot("slot", slots).agg(F.count(F.lit(1)).alias("n"), rint(F.median("pm2")).alias("p"))
    names = [F.coalesce(F.col(f"{s}_n"), F.lit(0)).alias(f"n_{s}") for s in slots] + [F.col(f"{s}_p").alias(f"p_{s}") for s in slots]
    return out.select(key, *names)


def aligned(by_year: DataFrame, key: str, years: list[int]) -> DataFrame:
    """Arrays along one axis of years: counts 0 and medians null where a year has none."""
    rows = by_year.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("annee", F.struct("n", "pm2_med")))).alias("m"))
    at = F.array(*[F.lit(y) for y in years])
    return rows.select(key, F.transform(at, lambda y: F.coalesce(F.try_element_at("m", y)["n"], F.lit(0))).alias("n"), F.transform(at, lambda y: F.try_element_at("m", y)["pm2_med"]).alias("pm2_med"))


def with_spine(spine: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Every entity of the spine; those without sales count 0; statistics without entity are left out."""
    return spine.join(stats, key, "left").withColumn("n_tot", F.coalesce("n_tot", F.lit(0)))


def entity_documents(src: DataFrame, spine: DataFrame, key: str, years: list[int], dense: int = DENSE, least: int = LEAST_PER_QUARTER) -> DataFrame:
    """(key, n_tot, doc): the JSON document of each entity, with explicit nulls in its arrays."""
    totals, by_year = entity_total(src, key), entity_year(src, key)
    arrays = aligned(by_year, key, years).select(key, F.struct("n", "pm2_med").alias("overall"))
    per_type = entity_year_type(src, key).groupBy(key, "type").agg(F.map_from_entries(F.collect_list(F.struct("annee", F.struct("n", "pm2_med", "vf_med", "sb_med", "st_med", "np_med")))).alias("m"))
    at = F.array(*[F.lit(y) for y in years])
    fields = [F.transform(at, lambda y: F.coalesce(F.try_element_at("m", y)["n"], F.lit(0))).alias("n")]

    def series(c: str) -> Column:
        return F.transform(at, lambda y: F.try_element_at("m", y)[c]).alias(c)

    fields += [series(c) for c in ("pm2_med", "vf_med", "sb_med", "st_med", "np_med")]
    per_type = per_type.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("type").cast("string").alias("k"), F.struct(*fields).alias("v"))))).alias("byType"))
    quarters = entity_quarter(src, key, dense, least).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.concat(F.col("annee").cast("string"), F.lit("Q"), F.col("q").cast("string")).alias("p"), "n", "pm2_med"))).alias("quarters")
    )
    rows = with_spine(spine, totals, key).join(arrays, key, "left").join(per_type, key, "left").join(quarters, key, "left")
    empty = F.struct(F.transform(at, lambda y: F.lit(0).cast("long")).alias("n"), F.transform(at, lambda y: F.lit(None).cast("int")).alias("pm2_med"))
    body = F.struct(F.col(key).alias("code"), "n_tot", "pm2_med", "vf_med", F.coalesce("overall", empty).alias("overall"), F.coalesce("byType", F.create_map().cast(per_type.schema["byType"].dataType)).alias("byType"))
    plain = F.to_json(body, {"ignoreNullFields": "false"})
    doc = F.when(F.col("quarters").isNull(), plain).otherwise(F.concat(F.regexp_replace(plain, r"\}$", ""), F.lit(',"quarters":'), F.to_json("quarters", {"ignoreNullFields": "false"}), F.lit("}")))
    return rows.select(key, "n_tot", doc.alias("doc"))
