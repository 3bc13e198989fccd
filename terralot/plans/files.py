"""Queries that write a source or sink format to the shared folder and read it back, with their SQL on the tables."""

from __future__ import annotations

import json
import sqlite3
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo as shapes
from ..functions import parse
from ..operators import manifest, periods, qa, stats, tiles, vector_tiles, zones
from ..sources import geo, lines, pmtiles, shared, sinks
from ..streaming.periods import replace_periods, windowed_counts
from . import profile
from .catalog import EDGES, JOINED, YEARS, _joined, _med, _points, _polygons, _tile_sql
from .profile import LINES, SIMPLE, simple, table
from .registry import query

# --- transaction files --------------------------------------------------------------------------


def _csv(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """Lines as a folder of transaction files: every 97th has a field too many, every 89th no parcel."""
    rows = profile.lines(spark, sf_dir).withColumn("k", F.col("ord.l_orderkey") * 8 + F.col("ord.l_linenumber"))
    text = lambda c: F.col(c).cast("string")
    values = {
        "id_mutation": F.col("id"), "id_parcelle": F.when(F.col("k") % 89 != 0, F.col("parcel")), "date_mutation": F.regexp_replace(text("date"), r"(\d{4})(\d\d)(\d\d)", "$1-$2-$3"), "nature_mutation": F.col("nature"),
        "valeur_fonciere": text("price"), "type_local": F.col("rtype"), "surface_reelle_bati": text("bati"), "nombre_pieces_principales": text("pieces"), "surface_terrain": text("terrain"),
        "adresse_nom_voie": F.concat(F.col("adr"), F.lit(', "x"')), "code_commune": F.col("com"), "code_departement": F.col("dep"), "longitude": text("lon"), "latitude": text("lat"), "lot1_surface_carrez": F.when(F.col("k") % 5 == 0, F.lit("10.5")),
        "lot3_surface_carrez": F.when(F.col("k") % 10 == 0, F.lit("2.25")),
    }
    quoted = lambda c: F.when(c.contains('"') | c.contains(","), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = F.concat_ws(",", *[F.coalesce(quoted(values[c]), F.lit("")) if c in values else F.lit("") for c in lines.HEADER])
    rows = rows.select(F.when(F.col("k") % 97 == 0, F.concat(line, F.lit(",more"))).otherwise(line).alias("value"))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([",".join(lines.HEADER)])], ["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], ["value"])

    folder = shared.new_folder(spark, "csv")
    rows.mapInArrow(headed, "value string").write.option("compression", compression).text(folder)
    return folder


CSV = f"""{LINES}, x AS (
  SELECT *, CAST(id AS BIGINT) * 8 + CAST(split_part(adr, ' ', 1) AS BIGINT) AS k FROM l
), y AS (SELECT * FROM x WHERE k % 97 <> 0 AND k % 89 <> 0)"""
_CSV_ROWS = f"""WITH {CSV} SELECT id, parcel, date, nature, price, rtype, bati, CAST(pieces AS INTEGER) AS pieces, terrain, CASE WHEN k % 10 = 0 THEN 12.75::DOUBLE WHEN k % 5 = 0 THEN 10.5::DOUBLE END AS carrez,
  adr || ', "x"' AS adr, com, dep, lon, lat FROM y"""


def _lines_of(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.to_lines(lines.read_raw(spark, shared.find(spark, f"{folder}/part-*,{folder}/part-*0*")))
    return rows.select("id", "parcel", "date", "nature", "price", "rtype", "bati", "pieces", "terrain", "carrez", "adr", "com", "dep", "lon", "lat")


@query(_CSV_ROWS)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as CSV and read again; those of another width or without a needed value are left out."""
    return _lines_of(spark, _csv(spark, sf_dir))


@query(_CSV_ROWS)
def csv_gzip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_of(spark, _csv(spark, sf_dir, "gzip"))


@query(f"WITH {CSV} SELECT count(*) AS lines, count(*) FILTER (WHERE k % 97 = 0) AS malformed, count(*) FILTER (WHERE k % 97 <> 0 AND k % 89 = 0) AS skipped FROM x")
def csv_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _csv(spark, sf_dir)
    return lines.counters(lines.read_raw(spark, shared.find(spark, f"{folder}/part-*")))


@query(f"WITH {SIMPLE} SELECT '2024-' || CAST(k + 500 AS VARCHAR) AS id_mutation, strftime(strptime(CAST(date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS date_mutation, CAST(vf AS VARCHAR) AS valeur_fonciere FROM s WHERE date < 19980701")
def period_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date slice with moved ids, written as gzip CSV and read again."""
    rows = simple(spark, sf_dir).select(F.concat(F.lit("2024-"), F.col("id")).alias("id_mutation"), F.regexp_replace(F.col("date").cast("string"), r"(\d{4})(\d\d)(\d\d)", "$1-$2-$3").alias("date_mutation"), F.col("vf").cast("string").alias("valeur_fonciere"))
    folder = shared.new_folder(spark, "slice")
    sinks.write_slice(periods.extract(rows, "1998-07-01", 500), folder)
    return spark.read.csv(folder, header=True)


# --- records and points -------------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = simple(spark, sf_dir).withColumn("nat", (k % 5 + 1).cast("int")).withColumn("adr", F.when(k % 4 != 0, F.concat(F.col("id"), F.lit(' rue de l\'Été "B"')))).withColumn("cp", F.when(k % 3 != 0, F.col("com")))
    return rows.select(*[c.split()[0] for c in lines.MUTATION.split(", ")])


RECORDS = """r AS (SELECT id, date, CAST(k % 5 + 1 AS INTEGER) AS nat, type, vf, sb, st, np, CAST(1 AS INTEGER) AS nl, com, dep, CASE WHEN k % 4 <> 0 THEN id || ' rue de l''Été "B"' END AS adr, CASE WHEN k % 3 <> 0 THEN com END AS cp, lon, lat, annee, pm2 FROM s)"""


@query(f"WITH {SIMPLE}, {RECORDS} SELECT * EXCLUDE (annee, pm2) FROM r")
def ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as line-delimited JSON and read by their declared schema; null keys are left out on the way."""
    folder = shared.new_folder(spark, "ndjson")
    sinks.write_lines(_records(spark, sf_dir), folder)
    return lines.read_mutations(spark, folder)


@query(f"WITH {SIMPLE}, {RECORDS} SELECT id, date, nat, type, vf, sb, com, adr, cp, lon, lat FROM r WHERE type IS NOT NULL")
def geojson_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sales written as line-delimited GeoJSON and read again."""
    folder = shared.new_folder(spark, "points")
    sinks.write_points(_records(spark, sf_dir), folder)
    return geo.read_points(spark, folder, "id:string,date:int,nat:int,type:int,vf:long,sb:int,com:string,adr:string,cp:string")


@query(f"WITH {SIMPLE}, {RECORDS} SELECT sum(CASE WHEN adr IS NULL THEN 1 ELSE 0 END)::BIGINT AS without_adr, sum(CASE WHEN cp IS NULL THEN 1 ELSE 0 END)::BIGINT AS without_cp, count(*) AS n FROM r WHERE type IS NOT NULL")
def null_keys_omitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features whose JSON lacks the key of a null value."""
    rows = _records(spark, sf_dir).filter("type IS NOT NULL").select(sinks.point_feature(tiles.TILE_PROPERTIES).alias("f"))
    lacks = lambda k: F.sum((~F.contains(F.col("f"), F.lit(f'"{k}":'))).cast("long"))
    return rows.agg(lacks("adr").alias("without_adr"), lacks("cp").alias("without_cp"), F.count("*").alias("n"))


@query(f"WITH {SIMPLE}, {RECORDS} SELECT id, CAST(annee AS INTEGER) AS annee, type, CAST(round(pm2) AS INTEGER) AS pm2, CAST(NULL AS INTEGER) AS nc, dep, lon AS x, lat AS y FROM r WHERE type IS NOT NULL")
def parquet_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export's derived columns, its typed null column and the point of its reader."""
    folder = shared.new_folder(spark, "export")
    sinks.write_parquet(_records(spark, sf_dir), folder)
    return lines.read_located(spark, folder).select("id", "annee", "type", "pm2", "nc", "dep", F.col("pt.lon").alias("x"), F.col("pt.lat").alias("y"))


# --- polygons -----------------------------------------------------------------------------------

SHAPE = f"{EDGES}, g AS (SELECT code, min(xi) AS xmin, min(yi) AS ymin, max(xi) AS xmax, max(yi) AS ymax, CAST(count(*) AS INTEGER) AS vertices FROM ed GROUP BY code)"


def _shape(polygons: DataFrame) -> DataFrame:
    rows = polygons.select("code", shapes.bbox(F.col("polys"), 6).alias("b"), shapes.vertex_counts(F.col("polys"))["vertices"].alias("vertices"))
    return rows.select("code", "b.*", "vertices")


@query(f"WITH {SHAPE} SELECT * FROM g")
def geojson_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as one FeatureCollection, and again, moved, as bare features in later files: the first of each code is read."""
    folder = shared.new_folder(spark, "zones")
    rows = _polygons(spark, sf_dir).withColumnRenamed("com", "INSEE_COM").withColumnRenamed("name", "nom")
    sinks.write_collection(rows.select("code", sinks.polygon_feature(["code", "INSEE_COM", "nom"]).alias("feature")), f"{folder}/a.geojson", "code")
    moved = rows.withColumn("polys", F.transform("polys", lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.struct((v["x"] + 1).alias("x"), v["y"].alias("y"))))))
    sinks.write_each(moved.select(F.concat(F.lit("b"), F.col("code")).alias("file"), sinks.polygon_feature(["code"]).alias("value")), "file", folder)
    return _shape(geo.first_of_code(geo.valid_layer(geo.read_polygons(spark, shared.find(spark, f"{folder}/*.geojson,{folder}/*.json")), 25)))


@query(f"WITH {SHAPE} SELECT * FROM g")
def gpkg_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones from a GeoPackage."""
    import os

    path = (shared.plain(shared.new_folder(spark, "gpkg")) or "") + ".gpkg"  # SQLite needs a mounted folder
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('zones', 'geometrie')")
        db.execute("CREATE TABLE zones (code_iris TEXT, nom_iris TEXT, code_insee TEXT, geometrie BLOB)")
        for r in _polygons(spark, sf_dir).collect():  # as many rows as nations
            ring = lambda points: struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in points)
            parts = [struct.pack("<BII", 1, 3, len(p)) + b"".join(map(ring, p)) for p in r["polys"]]
            db.execute("INSERT INTO zones VALUES (?, ?, ?, ?)", (r["code"], r["name"], r["com"], struct.pack("<2sBBi", b"GP", 0, 1, 4326) + struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)))
    spark.dataSource.register(geo.GeoPackage)
    return _shape(spark.read.format("gpkg").load(path))


@query("""SELECT CASE WHEN o_orderkey % 5 = 0 THEN '21' ELSE '32' END AS mod, strftime(o_orderdate, '%Y-%m-%d') AS date_eff, 'COM' AS typecom_av, lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS com_av, 'COMD' AS typecom_ap, lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS com_ap FROM orders""")
def movements_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code movements from CSV, leading zeros kept."""
    code = lambda c: F.lpad((F.col(c) % 100000).cast("string"), 5, "0")
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 5 == 0, "21").otherwise("32").alias("MOD"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATE_EFF"), F.lit("COM").alias("TYPECOM_AV"), code("o_custkey").alias("COM_AV"), F.lit("COMD").alias("TYPECOM_AP"), code("o_orderkey").alias("COM_AP"), F.lit("x").alias("LIBELLE"))
    folder = shared.new_folder(spark, "movements")
    rows.write.csv(folder, header=True)
    return geo.read_movements(spark, folder).drop("pos")


# --- tile archives ------------------------------------------------------------------------------


def _archive(spark: SparkSession, sf_dir: str, leaf_entries: int = 64) -> str:
    """An archive of levels 13 and, sampled, 6."""
    rows = _points(spark, sf_dir).drop("z", "x", "y")
    made = vector_tiles.encode_band(rows, 13, "mutations", tiles.TILE_PROPERTIES).unionByName(vector_tiles.encode_band(rows, 6, "mutations", tiles.TILE_PROPERTIES, budget=2000))
    uri = shared.new_folder(spark, "archive") + ".pmtiles"
    pmtiles.write_archive(made, uri, {"vector_layers": [{"id": "mutations", "minzoom": 6, "maxzoom": 13}]}, leaf_entries)
    pmtiles.register(spark)
    return uri


_AT_13 = f"SELECT id, {_tile_sql(13)} FROM s WHERE type IS NOT NULL"


@query(f"WITH {SIMPLE} {_AT_13}")
def pmtiles_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the exhaustive level, through tiles and an archive of many leaf directories."""
    data = spark.read.format("pmtiles").load(_archive(spark, sf_dir)).filter("z = 13")
    return vector_tiles.sales_of(vector_tiles.decode(data)).select("id", "x", "y")


@query(f"WITH {SIMPLE}, t AS (SELECT {_tile_sql(6)} FROM s WHERE type IS NOT NULL) SELECT x, y, least(count(*), 20) AS n FROM t GROUP BY 1, 2")
def tiles_sampled_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in the tiles of a level with a size budget of 20 of them."""
    data = spark.read.format("pmtiles").load(_archive(spark, sf_dir)).filter("z = 6")
    rows = vector_tiles.decode(data).filter(~F.map_contains_key("props", "adr") & ~F.map_contains_key("props", "cp"))
    return rows.groupBy("x", "y").agg(F.count("*").alias("n"))


@query(f"WITH {SIMPLE}, t AS (SELECT DISTINCT 13 AS z, {_tile_sql(13)} FROM s WHERE type IS NOT NULL UNION SELECT DISTINCT 6, {_tile_sql(6)} FROM s WHERE type IS NOT NULL) SELECT z, count(*) AS tiles FROM t GROUP BY z")
def tiles_per_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of each level in an archive's index."""
    return pmtiles.index_stats(spark.read.format("pmtiles").option("mode", "directory").load(_archive(spark, sf_dir))).select("z", "tiles")


@query(f"""WITH {SIMPLE}, t AS (SELECT DISTINCT {_tile_sql(13)} FROM s WHERE type IS NOT NULL), q AS (SELECT p_partkey, CAST(p_partkey * 37 % 8192 AS INTEGER) AS x, CAST(p_partkey * 53 % 8192 AS INTEGER) AS y FROM part UNION ALL SELECT -row_number() OVER (), x, y FROM t)
  SELECT count(*) AS asked, count(*) FILTER (WHERE (x, y) IN (SELECT (x, y) FROM t)) AS found FROM q""")
def tile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests looked up in a cached index: some at random, and every tile there is."""
    index = pmtiles.load_index(spark, _archive(spark, sf_dir))
    asked = table(spark, sf_dir, "part").select(F.lit(13).alias("z"), (F.col("p_partkey") * 37 % 8192).cast("int").alias("x"), (F.col("p_partkey") * 53 % 8192).cast("int").alias("y"))
    asked = asked.unionByName(tiles.assign(_points(spark, sf_dir).drop("z", "x", "y"), 13).select("z", "x", "y").distinct())
    return pmtiles.tile_lookup(asked, index).agg(F.count("*").alias("asked"), F.count("offset").alias("found"))


@query(f"WITH {SIMPLE}, t AS (SELECT 13 AS z, {_tile_sql(13)} FROM s WHERE type IS NOT NULL) SELECT DISTINCT CAST(x AS VARCHAR) AS x, CAST(y AS VARCHAR) AS y FROM t")
def tile_index_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places listed in the nested JSON of one level."""
    places = spark.read.format("pmtiles").option("mode", "directory").load(_archive(spark, sf_dir))
    doc = pmtiles.index_document(places).filter("z = 13").select(F.from_json("doc", "tiles map<string,map<string,struct<offset:long,length:long>>>").alias("d"))
    return doc.select(F.explode("d.tiles").alias("x", "ys")).select("x", F.explode("ys").alias("y", "place")).filter("place.length > 0").select("x", "y")


def _hilbert_sql(z: int) -> str:
    """Level by level, as nested selects."""
    out = f"SELECT id, x, y, x AS hx, y AS hy, CAST(0 AS BIGINT) AS d FROM (SELECT id, {_tile_sql(z)} FROM s)"
    for k in range(z - 1, -1, -1):
        n = 1 << k
        rx, ry, lx, ly = f"(hx >> {k} & 1)", f"(hy >> {k} & 1)", f"(hx & {n - 1})", f"(hy & {n - 1})"
        out = f"SELECT id, x, y, CASE WHEN {ry} = 0 THEN CASE WHEN {rx} = 1 THEN {n - 1} - {ly} ELSE {ly} END ELSE {lx} END AS hx, CASE WHEN {ry} = 0 THEN CASE WHEN {rx} = 1 THEN {n - 1} - {lx} ELSE {lx} END ELSE {ly} END AS hy, d + {n * n} * xor(3 * {rx}, {ry}) AS d FROM ({out})"
    return f"SELECT id, CAST({(4**z - 1) // 3} + d AS BIGINT) AS number, x, y FROM ({out})"


@query(f"WITH {SIMPLE} {_hilbert_sql(9)}")
def hilbert_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of sales' tiles on the curve."""
    rows = tiles.assign(simple(spark, sf_dir), 9)
    return rows.select("id", pmtiles.tile_number(F.col("z"), F.col("x"), F.col("y")).alias("number"), "x", "y")


# --- bundles, manifests, documents --------------------------------------------------------------


def _entity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = simple(spark, sf_dir)
    spine = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("com")).unionByName(spark.createDataFrame([("97901",)], "com string"))
    return stats.entity_documents(src, spine, "com", YEARS)


def _bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles written as files and read again: dep, value."""
    folder = shared.new_folder(spark, "bundles")
    sinks.write_each(sinks.bundles(_entity_documents(spark, sf_dir), "com", parse.dept_of(F.col("com")), "v1"), "dep", folder)
    return spark.read.text(f"{folder}/*.json", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("dep"), "value")


_AXIS = f"(SELECT unnest(range({YEARS[0]}, {YEARS[-1] + 1})) AS annee)"
_ENTITIES = f"""e AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS com FROM nation UNION ALL VALUES ('97901')), n AS (SELECT com, count(*) AS n_tot, {_med(pm2_med="pm2")} FROM s GROUP BY com),
  y AS (SELECT com, annee, count(*) AS n, CAST(round_even(median(pm2), 0) AS INTEGER) AS p FROM s GROUP BY 1, 2), a AS (SELECT com, a.annee AS annee, coalesce(n, 0) AS n, p FROM e CROSS JOIN {_AXIS} a LEFT JOIN y USING (com, annee)),
  q AS (SELECT com, count(*) AS k FROM (SELECT com, annee, q FROM s GROUP BY 1, 2, 3 HAVING count(*) >= 5) JOIN n USING (com) WHERE n_tot >= 200 GROUP BY com)"""


@query(f"""WITH {SIMPLE}, {_ENTITIES} SELECT CASE WHEN starts_with(com, '97') THEN left(com, 3) ELSE left(com, 2) END AS dep, com AS code, coalesce(n_tot, 0) AS n_tot, pm2_med, string_agg(CAST(a.n AS VARCHAR), ',' ORDER BY annee) AS n,
  string_agg(coalesce(CAST(p AS VARCHAR), 'null'), ',' ORDER BY annee) AS pm2, CAST(any_value(q.k) AS INTEGER) AS quarters FROM a LEFT JOIN n USING (com) LEFT JOIN q USING (com) GROUP BY com, n_tot, pm2_med""")
def bundle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of the bundles' files: totals, arrays along the years, and how many quarters of dense ones."""
    schema = qa.BUNDLE.replace("n_tot:long,", "n_tot:long,pm2_med:int,")
    rows = _bundles(spark, sf_dir).select("dep", F.explode(F.map_values(F.from_json("value", schema)["entities"])).alias("e"))
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",", "null")
    return rows.select("dep", "e.code", "e.n_tot", "e.pm2_med", text(F.col("e.overall.n")).alias("n"), text(F.col("e.overall.pm2_med")).alias("pm2"), F.nullif(F.size(F.coalesce("e.quarters", F.array())), F.lit(0)).alias("quarters"))


@query(f"""WITH {SIMPLE}, t AS (SELECT com, type, annee, count(*) AS n, {_med(st_med="st")} FROM s WHERE type IS NOT NULL GROUP BY 1, 2, 3), k AS (SELECT DISTINCT com, type FROM t)
  SELECT com AS code, CAST(type AS VARCHAR) AS type, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY a.annee) AS n, string_agg(coalesce(CAST(st_med AS VARCHAR), 'null'), ',' ORDER BY a.annee) AS st FROM k CROSS JOIN {_AXIS} a LEFT JOIN t USING (com, type, annee) GROUP BY 1, 2""")
def bundle_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrays by type in the bundles' files."""
    rows = _bundles(spark, sf_dir).select(F.explode(F.map_values(F.from_json("value", qa.BUNDLE)["entities"])).alias("e")).select("e.code", F.explode("e.byType").alias("type", "t"))
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",", "null")
    return rows.select("code", "type", text(F.col("t.n")).alias("n"), text(F.col("t.st_med")).alias("st"))


@query("""SELECT dep, code, what FROM (VALUES ('00', '00003', 'overall'), ('00', NULL, 'version'), ('00', '00005', 'byType'), ('01', '01001', 'quarters'), ('09', NULL, 'bundle')) t(dep, code, what)
  UNION ALL SELECT '02', lpad(CAST(2000 + r_regionkey AS VARCHAR), 5, '0'), 'overall' FROM region""")
def bundle_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with bundles made wrong on purpose."""

    def entity(code: str, n: int = 2, years: int = 2, types: int = 2, quarters: bool = False) -> dict:
        by = {"n": [1] * types} | {k: [None] * types for k in qa.ARRAYS[1:]}
        return {"code": code, "n_tot": n, "overall": {"n": [0] * years, "pm2_med": [None] * years}, "byType": {"1": by}} | ({"quarters": [{"p": "2024Q1", "n": 5, "pm2_med": None}]} if quarters else {})

    regions = [r["r_regionkey"] for r in table(spark, sf_dir, "region").collect()]
    bundles = {
        "00": ("v0", [entity("00001"), entity("00003", years=3), entity("00005", types=1)]), "01": ("v1", [entity("01001", quarters=True), entity("01002", n=5, quarters=True)]),
        "02": ("v1", [entity(f"{2000 + k:05d}", years=1) for k in regions]),
    }
    rows = spark.createDataFrame([(d, json.dumps({"version": v, "entities": {e["code"]: e for e in es}})) for d, (v, es) in bundles.items()], "dep string, value string")
    return qa.bundle_findings({"version": "v1", "years": [2023, 2024], "dense_threshold": 5, "departements": ["00", "01", "02", "09"]}, rows)


@query(f"""WITH {SIMPLE} SELECT 'v1' AS version, string_agg(DISTINCT CAST(annee AS VARCHAR), ',' ORDER BY CAST(annee AS VARCHAR)) AS years, string_agg(DISTINCT dep, ',' ORDER BY dep) AS departements, count(*) AS records,
  (SELECT count(*) FROM customer) AS zones FROM s""")
def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest written, loaded, and patched twice with the zones' counts."""
    rows = simple(spark, sf_dir)
    uri = shared.new_folder(spark, "manifest") + "/manifest.json"
    deps = [r["dep"] for r in rows.select("dep").distinct().orderBy("dep").collect()]
    sinks.write_manifest(uri, "v1", "2024-01-01", stats.years_of(rows), stats.DENSE, {"records": rows.count()}, deps)
    index = table(spark, sf_dir, "customer").select(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("dep"))
    found = manifest.patched(manifest.patched(json.loads(shared.read_bytes(uri)), index), index)
    row = (found["version"], ",".join(map(str, found["years"])), ",".join(found["departements"]), found["compteurs"]["records"], found["iris"]["count"])
    return spark.createDataFrame([row], "version string, years string, departements string, records long, zones long")


@query(f"WITH {JOINED} SELECT code, id, vf FROM j")
def zone_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of sales per zone, read again."""
    folder = shared.new_folder(spark, "zone-files")
    sinks.write_each(zones.zone_documents(_joined(spark, sf_dir), ["id", "vf", "type"]).withColumnRenamed("doc", "value"), "code", folder)
    rows = spark.read.schema("code string, mutations array<struct<id:string,vf:long>>").json(f"{folder}/*.json")
    return rows.select("code", F.explode("mutations").alias("m")).select("code", "m.id", "m.vf")


@query(f"""WITH {EDGES}, b AS (SELECT code, min(xi) AS xmin, min(yi) AS ymin, max(xi) AS xmax, max(yi) AS ymax FROM ed GROUP BY code)
  SELECT left(code, 2) AS dep, CAST(row_number() OVER (PARTITION BY left(code, 2) ORDER BY code) - 1 AS INTEGER) AS place, code, code AS com, CAST(xmin AS VARCHAR) || ',' || CAST(ymin AS VARCHAR) || ',' || CAST(xmax AS VARCHAR) || ',' || CAST(ymax AS VARCHAR) AS bbox, true AS inside FROM b""")
def zone_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of zones, a sorted array for each département, read again; its points lie in their zones."""
    folder = shared.new_folder(spark, "zone-index")
    polygons = _polygons(spark, sf_dir)
    sinks.write_each(sinks.zone_index(zones.zone_index(polygons), parse.dept_of_zone(F.col("code")), ["com", "lat", "lon", "bbox"]), "dep", folder)
    rows = spark.read.text(f"{folder}/*.json", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("dep"), F.posexplode(F.from_json("value", "array<struct<code:string,com:string,lat:double,lon:double,bbox:array<double>>>")).alias("place", "z"))
    rows = rows.select("dep", "place", "z.*").join(polygons.select("code", "polys"), "code")
    return rows.select("dep", "place", "code", "com", F.array_join("bbox", ",").alias("bbox"), shapes.within(F.col("lon"), F.col("lat"), F.col("polys")).alias("inside"))


@query("SELECT ok, file, last FROM (VALUES (true, 'passed', 100), (false, 'failed', 100)) t(ok, file, last)")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good report, then one with an error: the failed one is set apart, and the good one stays the baseline."""
    folder = shared.new_folder(spark, "reports")
    out = []
    for violations, n in ((0, 100), (3, 40)):
        good = sinks.write_report(folder, [{"check": "c", "severity": "error", "violations": violations}], {"records": n})
        kept = json.loads(shared.read_bytes(f"{folder}/{sinks.PASSED if good else sinks.FAILED}"))
        out.append((kept["ok"], "passed" if good else "failed", sinks.last_totals(folder)["records"]))
    return spark.createDataFrame(out, "ok boolean, file string, last int")


# --- streams ------------------------------------------------------------------------------------


@query(f"WITH {SIMPLE} SELECT id, CAST(annee AS INTEGER) AS annee, CASE WHEN annee = 1998 THEN vf + 1 ELSE vf END AS vf FROM s")
def period_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of all sales, and then one of a year in two files, a file a batch: it replaces the year whole."""
    folder = shared.new_folder(spark, "deliveries")
    rows = simple(spark, sf_dir).select("id", "date", "vf", "k", "annee")
    year = rows.filter("annee = 1998").withColumn("vf", F.col("vf") + 1)

    def deliver(part: DataFrame, name: str, n: int) -> None:
        part.select("id", "date", "vf").withColumn("delivery", F.lit(name)).withColumn("rows_of_delivery", F.lit(n).cast("long")).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    deliver(rows, "a", rows.count())
    n = year.count()
    for half in (0, 1):
        deliver(year.filter(F.floor(F.col("k") / 2) % 2 == half), "b", n)
    stream = spark.readStream.schema("id string, date int, vf long, delivery string, rows_of_delivery long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    replace_periods(stream, f"{folder}/out", f"{folder}/incoming", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("id", "annee", "vf")


@query("SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted by hour and type, as a stream."""
    out = shared.new_folder(spark, "windows")
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    counted = windowed_counts(events, "ts", "event_type", "1 hour", "1 hour").select("event_type", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")
    keep = lambda batch, _: batch.write.mode("overwrite").parquet(f"{out}/counts")
    counted.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/counts")
