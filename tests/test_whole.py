"""Queries that take whole tables: nothing is left out on the way."""

import os

import pytest
from pyspark.sql import functions as F

from terralot.functions.geo import within
from terralot.operators import stats
from terralot.plans import catalog, profile

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@tables
def test_aligned_counts_every_order(spark):
    want = profile.simple(spark, SF).filter("type = 1").filter(f"annee BETWEEN {catalog.YEARS[0]} AND {catalog.YEARS[-1]}").count()
    got = catalog.QUERIES["aligned_year_arrays"](spark, SF).collect()
    assert sum(int(n) for r in got for n in r["n"].split(",")) == want


def test_aligned_years_without_sales(spark):
    rows = spark.createDataFrame([("a", 1996, 2, 7), ("b", 1995, 1, None)], "com string, annee int, n long, pm2_med int")
    got = {r["com"]: (r["n"], r["pm2_med"]) for r in stats.aligned(rows, "com", [1995, 1996, 1997]).collect()}
    assert got == {"a": ([0, 2, 0], [None, 7, None]), "b": ([1, 0, 0], [None, None, None])}


@tables
def test_every_point_is_resolved(spark):
    """Against every pair of point and polygon, without keys and boxes."""
    pairs = profile.simple(spark, SF).select("id", "lon", "lat").crossJoin(catalog._polygons(spark, SF))
    want = pairs.filter(within(F.col("lon"), F.col("lat"), F.col("polys"))).groupBy("id").agg(F.min_by("code", "pos").alias("code")).collect()
    got = catalog.QUERIES["gps_resolve"](spark, SF).collect()
    assert len(got) == len(want) and {r["id"]: r["code"] for r in got} == {r["id"]: r["code"] for r in want}
    assert any(int(r["id"]) % 10 for r in got)


@tables
def test_movements_of_every_order(spark):
    n = profile.table(spark, SF, "orders").count()
    moves = catalog._moves(spark, SF)
    assert moves.count() == n and moves.select("com_av").distinct().count() > n / 4 > 60
    assert catalog.QUERIES["latest_event"](spark, SF).count() > 60


@tables
def test_codes_of_all_sales(spark):
    mapped = {r["com"] for r in catalog.QUERIES["remap_mapping"](spark, SF).collect()}
    assert mapped == {r["com"] for r in profile.simple(spark, SF).filter("com < '00020'").select("com").distinct().collect()} and max(mapped) > "00009"
    moved = catalog.QUERIES["reassign_children"](spark, SF)
    parents = {r["com"] for r in profile.simple(spark, SF).join(moved.select("id"), "id").select("com").distinct().collect()}
    assert max(parents) >= "00012" and not moved.filter("com < '00025'").count()
