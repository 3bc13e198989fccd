"""Points with their zones' documents."""

import os

import pytest

import __spark_entry__ as entry
from terralot.functions.geo import POLYGONS
from terralot.operators import zones

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_each_document_is_read_once(spark):
    """Documents are parsed below the joins with points, not again for each point in a zone."""
    plan = entry.queries()["zone_fetch"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "from_json" in below and "from_json" not in above


def test_sales_at(spark):
    square = lambda x: [[[(x, 0.0), (x + 4.0, 0.0), (x + 4.0, 4.0), (x, 4.0), (x, 0.0)]]]
    areas = spark.createDataFrame([("a", 0, square(0.0)), ("b", 1, square(2.0)), ("c", 2, square(10.0))], f"code string, pos int, polys {POLYGONS}")
    documents = spark.createDataFrame([("a", 3), ("b", 5)], "code string, n long")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0), (3, 5.0, 1.0), (4, 11.0, 1.0), (5, 50.0, 1.0), (5, 50.0, 1.0), (1, 1.0, 1.0), (6, None, 1.0)], "k long, lon double, lat double")
    got = zones.sales_at(points, areas, documents)
    assert got.columns == ["code", "k", "lon", "lat", "n"]
    assert sorted((r["k"], r["code"], r["n"]) for r in got.select("k", "code", "n").collect()) == [(1, "a", 3), (1, "a", 3), (2, "a", 3), (3, "b", 5), (4, "c", None), (5, None, None), (5, None, None), (6, None, None)]
