"""Statistics documents, sinks, quality checks, periods, manifests and streams."""

import json

import pytest
from pyspark.sql import functions as F

from terralot.functions.parse import dept_of, half_away, parse_float, parse_int
from terralot.operators import manifest, periods, qa, stats
from terralot.sources import sinks
from terralot.streaming.periods import replace_periods, windowed_counts

MUTATION = "id string, date int, nat int, type int, vf long, sb int, st int, np int, nl int, com string, dep string, adr string, cp string, lon double, lat double"


def sales(spark):
    at = [("01001", 20230110, 1, 200000, 100)] + [("01001", 20240105 + i, 1, 300000, 100) for i in range(5)] + [("01001", 20240501, None, 50000, 0), ("01002", 20240710, 2, 250000, 50), ("01002", 20240711, 2, 250000, 50)]
    return spark.createDataFrame([(f"m{i}", d, 1, t, vf, sb, 10, 2, 1, com, "01", None, "01000", 5.0, 45.0) for i, (com, d, t, vf, sb) in enumerate(at)], MUTATION)


def test_documents(spark):
    src = stats.stats_source(sales(spark))
    spine = spark.createDataFrame([("01001",), ("01002",), ("01003",)], "com string")
    docs = {r["com"]: json.loads(r["doc"]) for r in stats.entity_documents(src, spine, "com", [2023, 2024], dense=4, least=5).collect()}
    assert docs["01001"]["n_tot"] == 7 and docs["01001"]["pm2_med"] == 3000 and docs["01001"]["overall"] == {"n": [1, 6], "pm2_med": [2000, 3000]}
    assert docs["01001"]["quarters"] == [{"p": "2024Q1", "n": 5, "pm2_med": 3000}]
    assert docs["01002"]["overall"] == {"n": [0, 2], "pm2_med": [None, 5000]} and "quarters" not in docs["01002"]
    assert docs["01002"]["byType"]["2"]["n"] == [0, 2]
    assert docs["01003"] == {"code": "01003", "n_tot": 0, "pm2_med": None, "vf_med": None, "overall": {"n": [0, 0], "pm2_med": [None, None]}, "byType": {}}


def test_sinks(spark, tmp_path):
    rows = sales(spark)
    sinks.write_points(rows, str(tmp_path / "points"))
    points = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "points")).collect()]
    assert len(points) == 8 and "adr" not in points[0]["properties"] and list(points[0]["properties"])[:2] == ["id", "date"]
    assert sinks.parquet_rows(rows).columns == sinks.PARQUET
    src = stats.stats_source(rows)
    docs = stats.entity_documents(src, rows.select("com").distinct(), "com", [2023, 2024])
    sinks.write_each(sinks.bundles(docs, "com", dept_of(F.col("com")), "v1").select(F.col("dep"), "value"), "dep", str(tmp_path / "bundles"))
    bundle = json.load(open(tmp_path / "bundles" / "01.json"))
    assert bundle["version"] == "v1" and set(bundle["entities"]) == {"01001", "01002"}
    n = sinks.write_collection(rows.select("id", sinks.point_feature(["id"]).alias("feature")), str(tmp_path / "c.json"), "id")
    assert n == 9 == len(json.load(open(tmp_path / "c.json"))["features"])


def test_numbers(spark):
    texts = ["12", " 3.5 ", "1e400", "inf", "nan", "12d", "", "1_0", "-2.5", "118750.49", "abc"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_float(F.col("t")).alias("f"), parse_int(F.col("t")).alias("i")).collect()
    assert [r["f"] for r in rows] == [12.0, 3.5, None, None, None, None, None, 10.0, -2.5, 118750.49, None]
    assert [r["i"] for r in rows] == [12, 4, None, None, None, None, None, 10, -3, 118750, None]
    halves = spark.createDataFrame([(0.5,), (-0.5,), (1.5,), (2.5,), (-2.5,)], "v double").select(half_away(F.col("v")).cast("int")).collect()
    assert [r[0] for r in halves] == [1, -1, 2, 3, -3]


def test_checks(spark):
    layer = spark.createDataFrame([("a", 3), ("b", None), ("c", 1)], "code string, n_tot long")
    bundle = spark.createDataFrame([("a", 3), ("b", 2), ("x", 9)], "code string, n_tot long")
    bad = qa.unequal_totals(layer, bundle)
    assert [tuple(r) for r in bad.collect()] == [("b", 0, 2)]
    assert qa.report(spark, {"totals": ("error", bad)}).first()["violations"] == 1
    found = spark.createDataFrame([("mutations", 4, 14), ("communes", 6, 9)], "name string, minzoom int, maxzoom int")
    assert {r["name"] for r in qa.layer_ranges(found).collect()} == {"communes", "departements"}
    features = spark.createDataFrame([(13, {"id": "a", "vf": "1"}), (13, {"id": "b"})], "z int, props map<string,string>")
    assert qa.attributes_everywhere(features, ["z"], ["id", "vf"]).first()["lacking"] == ["vf"]
    assert qa.count_moved(130, 100) and not qa.count_moved(110, 100) and not qa.count_moved(5, None)


def test_periods(spark):
    rows = spark.createDataFrame([("2024-1", "2024-06-30"), ("2024-2", "2024-07-01")], "id_mutation string, date_mutation string")
    assert [r["id_mutation"] for r in periods.extract(rows, "2024-07-01", 500).collect()] == ["2024-501"]
    both = rows.unionByName(spark.createDataFrame([("2024-1", "2024-08-01")], rows.schema))
    with pytest.raises(ValueError, match="2024-1"):
        periods.extract(both, "2024-07-01", 500)


def test_manifest(spark):
    index = spark.createDataFrame([("01", "a"), ("01", "b"), ("2A", "c")], "dep string, code string")
    once = manifest.patched({"version": "v", "years": [2024]}, index)
    assert once["iris"] == {"count": 3, "departements": ["01", "2A"]} and once["version"] == "v"
    assert manifest.patched(once, index) == once
    assert manifest.newest_edition(["x_2023-01-01.7z", "x_2024-06-01.7z", "y_2025-01-01.7z"], "^x") == "x_2024-06-01.7z"
    assert manifest.newer_than("x_2024-06-01", "x_2025-01-01") == 10 and manifest.newer_than("x_2024-06-01", "x_2024-06-01") == 0


def test_findings(spark):
    rows = [(14, 1, "a", "c"), (14, None, None, "c"), (13, None, None, None), (12, 5, None, "c")]
    got = {tuple(r) for r in qa.sample_findings(spark.createDataFrame(rows, "z int, vf long, adr string, cp string")).collect()}
    assert got == {(14, "vf", "warning"), (14, "adr", "warning"), (13, "vf", "error"), (13, "adr", "error"), (13, "cp", "error"), (12, "cp", "error")}
    bundles = spark.createDataFrame([("01", "v1"), ("02", "v0"), ("03", None)], "dep string, version string")
    assert {r["dep"] for r in qa.unequal_versions("v1", bundles).collect()} == {"02", "03"}


def test_feed(tmp_path):
    pages = {1: 'href="iris_2023-01-01.7z" href="other"', 2: 'href="iris_2024-01-01.7z"', 3: 'href="iris_2024-01-01.7z"', 4: 'href="iris_2025-01-01.7z"'}
    assert manifest.list_editions(lambda n: pages[n], "iris") == ["iris_2023-01-01.7z", "iris_2024-01-01.7z"]
    (tmp_path / "m.json").write_text('{"version": "v"}')
    assert manifest.load(str(tmp_path / "m.json")) == {"version": "v"}


def test_stream_replaces_periods(spark, tmp_path):
    """A delivery of all years, then one of 2024 in two batches: nothing is replaced before it is complete."""
    source, target, incoming = (str(tmp_path / x) for x in ("in", "out", "incoming"))
    schema = MUTATION + ", delivery string, rows_of_delivery long"

    def deliver(rows, name, n):
        rows.withColumn("delivery", F.lit(name)).withColumn("rows_of_delivery", F.lit(n).cast("long")).coalesce(1).write.mode("append").parquet(source)
        replace_periods(spark.readStream.schema(schema).parquet(source), target, incoming, str(tmp_path / "check")).awaitTermination()
        return {(r["annee"], r["vf"]): r["n"] for r in spark.read.parquet(target).groupBy("annee", "vf").agg(F.count("*").alias("n")).collect()}

    first = sales(spark).withColumn("vf", F.lit(1).cast("long"))
    assert deliver(first, "a", 9) == {(2023, 1): 1, (2024, 1): 8}
    later = sales(spark).withColumn("vf", F.lit(2).cast("long")).filter("date BETWEEN 20240000 AND 20249999").orderBy("id")
    head = later.limit(3)
    assert deliver(head, "b", 8) == {(2023, 1): 1, (2024, 1): 8}
    assert deliver(later.join(head.select("id"), "id", "left_anti").select(*later.columns), "b", 8) == {(2023, 1): 1, (2024, 2): 8}


def test_windowed_counts(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:10", "a"), ("2024-01-01 00:00:50", "a"), ("2024-01-01 00:01:10", "b")], "t string, k string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(str(tmp_path / "e"))
    stream = windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e")), "t", "k", "1 minute", "1 minute")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["k"], r["n"]) for r in spark.table("windows").collect()) == [("a", 2), ("b", 1)]
