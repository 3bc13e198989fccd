"""Tile codec, archives and geometry."""

import random
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from terralot.functions import geo, mvt
from terralot.operators import vector_tiles
from terralot.sources import pmtiles
from terralot.sources.geo import GeoPackage, first_of_code, gpkg_polygons, read_polygons


def test_tile_numbers():
    assert [pmtiles.tile_id(*t) for t in ((0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0))] == [0, 1, 2, 3, 4, 5]
    r = random.Random(1)
    for _ in range(300):
        z = r.randrange(20)
        t = (z, r.randrange(2**z), r.randrange(2**z))
        assert pmtiles.tile_place(pmtiles.tile_id(*t)) == t


def test_directory_round_trip():
    entries = [(0, 1, 10, 0), (5, 3, 20, 10), (9, 1, 20, 10), (1 << 40, 0, 7, 30)]
    assert pmtiles.parse_directory(pmtiles.encode_directory(entries)) == entries


def test_layer_round_trip():
    features = [(7, "point", [[(10, -3)]], {"a": 1, "b": "é", "c": 1.5, "d": True, "e": None, "f": -4}), (None, "polygon", [[(0, 0), (9, 0), (9, 9)]], {"a": 1})]
    got = list(mvt.decode_tile(mvt.encode_layer("l", features) + mvt.encode_layer("m", [])))
    assert got[0] == {"layer": "l", "extent": 4096, "id": 7, "kind": "point", "parts": [[(10, -3)]], "props": {"a": 1, "b": "é", "c": 1.5, "d": True, "f": -4}}
    assert got[1]["parts"] == [[(0, 0), (9, 0), (9, 9), (0, 0)]]


@pytest.mark.parametrize("data", [b"\x1a\x05ab", b"\xff" * 11, b"\x1f\x8babc", b"\x1b"])
def test_broken_tiles(data):
    with pytest.raises(ValueError):
        list(mvt.decode_tile(data))


@pytest.mark.parametrize("leaf", [4096, 3])
def test_archive(spark, tmp_path, leaf):
    pmtiles.register(spark)
    rows = [(z, x, y, bytes([z]) if z == 3 else f"{z}/{x}/{y}".encode()) for z in range(4) for x in range(2**z) for y in range(2**z)]
    path = str(tmp_path / "a.pmtiles")
    made = pmtiles.write_archive(spark.createDataFrame(rows, "z int, x int, y int, data binary").repartition(3), path, {"k": 1}, leaf)
    assert made["tiles"] == 85 and made["entries"] == 22  # level 3 is one run of equal tiles
    got = spark.read.format("pmtiles").load(path)
    assert {(r["z"], r["x"], r["y"], mvt.gunzipped(bytes(r["data"]))) for r in got.collect()} == set(rows)
    one = got.filter("z = 2 AND x = 1 AND y IN (3, 0)").collect()
    assert sorted(mvt.gunzipped(bytes(r["data"])) for r in one) == [b"2/1/0", b"2/1/3"]
    places = spark.read.format("pmtiles").option("mode", "directory").load(path)
    assert places.count() == 85
    assert pmtiles.Archive(path).metadata() == {"k": 1}
    assert pmtiles.index_document(places).filter("z = 1").first()["doc"].count('"offset"') == 4


def square(x, y, size=1.0):
    return [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]


def test_polygons(spark, tmp_path):
    import json

    ell = [[0, 0], [4, 0], [4, 1], [1, 1], [1, 4], [0, 4], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"CODE_IRIS": "A", "INSEE_COM": "10000"}, "geometry": {"type": "Polygon", "coordinates": [ell]}},
        {"type": "Feature", "properties": {"CODE_IRIS": "B", "INSEE_COM": "20000"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square(10, 10, 4), square(11, 11)], [square(20, 20)]]}},
    ]}
    (tmp_path / "a.geojson").write_text(json.dumps(doc))
    (tmp_path / "b.geojson").write_text(json.dumps(doc["features"][0]))
    rows = read_polygons(spark, [str(tmp_path / "a.geojson"), str(tmp_path / "b.geojson")])
    assert rows.count() == 3
    one = first_of_code(rows)
    assert one.count() == 2 and one.filter("code = 'B'").first()["com"] == "20000"
    inside = one.withColumn("p", geo.interior_point(F.col("polys"))).select(geo.within(F.col("p.x"), F.col("p.y"), F.col("polys")).alias("i"))
    assert all(r["i"] for r in inside.collect())
    test = lambda x, y: {r["code"] for r in one.filter(geo.within(F.lit(x), F.lit(y), F.col("polys"))).collect()}
    assert test(0.5, 3.5) == {"A"} and test(3.0, 3.0) == set() and test(11.5, 11.5) == set() and test(10.5, 12.0) == {"B"} and test(20.5, 20.5) == {"B"} and test(4.0, 0.5) == set()
    v = one.filter("code = 'B'").select(geo.vertex_counts(F.col("polys")).alias("v"), geo.feature_centroid(F.col("polys")).alias("c")).first()
    assert (v["v"]["rings"], v["v"]["vertices"]) == (3, 12) and (v["c"]["cx"], v["c"]["cy"]) == (12.0, 12.0)


def test_geopackage(spark, tmp_path):
    ring = square(0, 0)
    wkb = struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<2d", *p) for p in ring)
    multi = struct.pack(">BII", 0, 6, 1) + struct.pack(">BIII", 0, 3, 1, 5) + b"".join(struct.pack(">2d", *p) for p in ring)
    head = b"GP\x00\x01" + struct.pack("<i", 4326)
    assert gpkg_polygons(head + wkb) == gpkg_polygons(head + multi) == [[[tuple(map(float, p)) for p in ring]]]
    with sqlite3.connect(tmp_path / "a.gpkg") as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('iris', 'geometrie')")
        db.execute("CREATE TABLE iris (code_iris TEXT, code_insee TEXT, nom_iris TEXT, geometrie BLOB)")
        db.execute("INSERT INTO iris VALUES ('010530101', '01053', 'Nord', ?)", [head + wkb])
    spark.dataSource.register(GeoPackage)
    (r,) = spark.read.format("gpkg").load(str(tmp_path / "a.gpkg")).collect()
    assert (r["code"], r["com"], r["name"], len(r["polys"][0][0])) == ("010530101", "01053", "Nord", 5)


def test_corners_of_a_tile(spark):
    row = spark.range(1).select(geo.tile_point_to_wgs84(F.lit(14), F.lit(8411), F.lit(5844), F.lit(0), F.lit(0)).alias("p")).first()["p"]
    assert geo.tiles_of_bbox(row["lon"] + 1e-9, row["lat"] - 1e-9, row["lon"] + 1e-9, row["lat"] - 1e-9, 14) == [(8411, 5844)]


def test_sales_of_tiles(spark):
    props = {"id": "a", "date": 20240101, "nat": 1, "type": 2, "sb": 1, "st": 2, "np": 3, "nl": 1, "com": "01053"}
    data = mvt.encode_layer("mutations", [(None, "point", [[(1, 2)]], props), (None, "point", [[(1, 2)]], {k: v for k, v in props.items() if k != "com"}), (None, "polygon", [[(0, 0), (1, 0), (1, 1)]], props)])
    features = vector_tiles.decode(spark.createDataFrame([(14, 1, 1, data)], "z int, x int, y int, data binary"))
    (r,) = vector_tiles.sales_of(features).collect()
    assert r["com"] == "01053" and r["vf"] is None and r["date"] == 20240101
    assert vector_tiles.inside_extent(features).count() == 2
