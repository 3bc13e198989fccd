"""A whole build from files, and the conditions that stop it."""

import csv
import json

import pytest

from terralot.operators import consolidate
from terralot.plans.build import build
from terralot.sources import geo, lines, shared, sinks

from .test_consolidate import cases, line


def square(code, x, y, **more):
    ring = [[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]
    return {"type": "Feature", "properties": {"code": code, "nom": f"N{code}"} | more, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([lines.HEADER, *rows])


@pytest.fixture
def inputs(tmp_path):
    write(tmp_path / "a.csv", cases())
    write(tmp_path / "b.csv", [line("T-1", "Q1", type_local="Maison", valeur_fonciere="90000", surface_reelle_bati="50", code_commune="01999", longitude="5.5", latitude="45.5"), line("T-2", "Q2", date_mutation="2023-01-02", longitude="9.5", latitude="9.5", code_commune="02001", valeur_fonciere="70000")])
    (tmp_path / "com.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [square("01053", 5, 45), square("01000", 8, 45)]}))
    (tmp_path / "dep.geojson").write_text(json.dumps(square("01", 5, 45)))
    return tmp_path


def test_build(spark, inputs):
    run = lambda version="v1", **more: build(spark, f"{inputs}/a.csv,{inputs}/*.csv", f"{inputs}/com.geojson", f"{inputs}/dep.geojson", None, f"{inputs}/out", version, "2024-01-01", dense=5, least=1, **more)
    counts = run()
    assert counts["ok"] and counts["malformed"] == 0 and counts["rejected"] == 1 and counts["records"] == 12 and counts["codes_without_geometry"] == 1 and counts["first_codes_without_geometry"] == ["02001"]
    assert counts["by_year"] == {"2023": 1, "2024": 11}
    out = inputs / "out"
    records = {r["id"]: r for r in lines.read_mutations(spark, str(out / "mutations")).collect()}
    assert records["T-1"]["com"] == "01053" and records["T-2"]["com"] == "02001"  # by a vote, and an orphan
    layer = json.loads((out / "communes.geojson").read_text())["features"]
    assert [(f["properties"]["code"], f["properties"]["n_tot"]) for f in layer] == [("01000", 0), ("01053", 11)]
    assert layer[1]["properties"]["cx"] == 5.5 and layer[1]["properties"]["n_2024_t1"] >= 1
    bundle = json.loads((out / "stats/dep/01.json").read_text())
    assert bundle["version"] == "v1" and bundle["entities"]["01053"]["overall"]["n"] == [0, 11] and "quarters" in bundle["entities"]["01053"]
    manifest = json.loads((out / "stats/manifest.json").read_text())
    assert manifest["years"] == [2023, 2024] and manifest["departements"] == ["01"]
    assert lines.read_located(spark, str(out / "export")).count() == sum(1 for r in records.values() if r["type"] is not None)
    assert json.loads((out / sinks.PASSED).read_text())["totals"] == {"records": 12}
    (inputs / "a.csv").unlink()  # far fewer records: the report fails and is set apart
    assert not run("v2")["ok"] and json.loads((out / sinks.FAILED).read_text())["totals"] == {"records": 2} and sinks.last_totals(str(out)) == {"records": 12}
    assert run("v3", reset_baseline=True)["ok"] and sinks.last_totals(str(out)) == {"records": 2}


def test_what_stops_a_build(spark, inputs):
    write(inputs / "c.csv", cases()[:3])  # the ids of another file again
    args = (f"{inputs}/com.geojson", f"{inputs}/dep.geojson", None, f"{inputs}/out", "v", "g")
    with pytest.raises(ValueError, match="several records"):
        build(spark, f"{inputs}/*.csv", *args)
    write(inputs / "d.csv", [line("U-1", "R1", code_commune="", longitude="5.5", latitude="45.5")])
    with pytest.raises(ValueError, match="no commune"):
        build(spark, f"{inputs}/d.csv", *args)
    with pytest.raises(FileNotFoundError):
        build(spark, f"{inputs}/none*.csv", *args)
    with pytest.raises(ValueError, match="1 features"):
        geo.valid_layer(geo.read_polygons(spark, f"{inputs}/dep.geojson"), 2)


def test_files_in_order_and_once(inputs, spark):
    assert [f.rpartition("/")[2] for f in shared.find(spark, f"{inputs}/b*.csv, {inputs}/*.csv")] == ["a.csv", "b.csv"]


def test_plain_files_are_split(spark, tmp_path):
    write(tmp_path / "a.csv", [line(f"S-{i}", f"P{i}", longitude="1", latitude="2") for i in range(4000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    raw = lines.read_raw(spark, str(tmp_path / "a.csv"))
    assert raw.rdd.getNumPartitions() > 2
    assert [r["id_mutation"] for r in raw.orderBy("ord").select("id_mutation").collect()] == [f"S-{i}" for i in range(4000)]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_consolidation_shuffles_lines_once(spark, tmp_path):
    """Exchanges of the plan: lines by sale (the second use is the same one), their located part by parcel, and the join of both."""
    rows = spark.createDataFrame([], consolidate.LINE)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows.write.parquet(str(tmp_path / "lines"))
    plan = consolidate.consolidate(spark.read.parquet(str(tmp_path / "lines")))[0]._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Scan parquet") == 1 and plan.count("ReusedExchange") == 1 and sum("Exchange hashpartitioning" in x and "Reused" not in x for x in plan.split("\n")) == 3

