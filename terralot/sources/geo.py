"""Polygons from GeoJSON and GeoPackage, points from line-delimited GeoJSON, code movements from CSV."""

from __future__ import annotations

import sqlite3
import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.geo import POLYGONS

#: Names under which columns of zone files go.
ALIASES = {"code": ["code", "code_iris"], "com": ["insee_com", "code_insee", "com"], "name": ["nom", "nom_iris"], "com_name": ["nom_com", "nom_commune"]}


def polygons_of(geometry: Column) -> Column:
    """Nested polygons from a geometry's JSON text (Polygon or MultiPolygon)."""
    ring = "array<array<double>>"
    kind = F.get_json_object(geometry, "$.type")
    one = F.from_json(F.get_json_object(geometry, "$.coordinates"), f"array<{ring}>")
    many = F.from_json(F.get_json_object(geometry, "$.coordinates"), f"array<array<{ring}>>")
    nested = F.when(kind == "MultiPolygon", many).when(kind == "Polygon", F.array(one))
    return F.transform(nested, lambda polygon: F.transform(polygon, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))


def read_polygons(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """file, pos, code, com, name, com_name, props (MAP), polys, of a FeatureCollection or bare features.

    Property names count whatever their case; a file with no name for the code is an error when read.
    """
    text = spark.read.text(paths, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    feature = "struct<properties:map<string,string>,geometry:string>"
    many = F.from_json(F.get_json_object("value", "$.features"), f"array<{feature}>")
    rows = text.select("file", F.posexplode(F.coalesce(many, F.array(F.from_json("value", feature)))).alias("pos", "f"))
    low = F.transform_keys("f.properties", lambda k, v: F.lower(k))
    pick = lambda names: F.coalesce(*[F.try_element_at(F.col("props"), F.lit(n)) for n in names])
    rows = rows.select("file", "pos", low.alias("props"), F.col("f.geometry").alias("geometry"))
    return rows.select("file", "pos", *[pick(v).alias(k) for k, v in ALIASES.items()], "props", polygons_of(F.col("geometry")).cast(POLYGONS).alias("polys"))


def first_of_code(polygons: DataFrame) -> DataFrame:
    """One polygon row per code: the first of the sorted files and their features; rows without code are left out."""
    others = [c for c in polygons.columns if c not in ("code", "props")]
    rows = polygons.filter("code IS NOT NULL").groupBy("code").agg(F.min_by(F.struct(*others), F.struct("file", "pos")).alias("r"))
    return rows.select("code", "r.*")


def valid_layer(polygons: DataFrame, least: int) -> DataFrame:
    """The same rows; an error if the layer has fewer features than a whole one."""
    if (n := polygons.count()) < least:
        raise ValueError(f"{n} features; a whole layer has {least} at least")
    return polygons


def read_points(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Line-delimited GeoJSON points: their properties (a declared schema) and lon, lat."""
    rows = spark.read.schema(f"properties struct<{properties}>, geometry struct<coordinates:array<double>>").json(path)
    return rows.select("properties.*", F.get("geometry.coordinates", F.lit(0)).alias("lon"), F.get("geometry.coordinates", F.lit(1)).alias("lat"))


def read_movements(spark: SparkSession, path: str) -> DataFrame:
    """Code movements with their place in the file."""
    rows = spark.read.csv(path, header=True)
    return rows.select(*[F.col(c).alias(c.lower()) for c in ("MOD", "DATE_EFF", "TYPECOM_AV", "COM_AV", "TYPECOM_AP", "COM_AP")], F.monotonically_increasing_id().alias("pos"))


def wkb_polygons(data: bytes) -> list:
    """Nested polygons of WKB (Polygon or MultiPolygon, either byte order, Z and M dropped)."""
    at = 0

    def number(form: str):
        nonlocal at
        (v,) = struct.unpack_from(order + form, data, at)
        at += struct.calcsize(form)
        return v

    def polygon(dims: int) -> list:
        nonlocal at
        rings = []
        for _ in range(number("I")):
            n = number("I")
            values = struct.unpack_from(f"{order}{n * dims}d", data, at)
            at += 8 * n * dims
            rings.append([(values[i], values[i + 1]) for i in range(0, n * dims, dims)])
        return rings

    def head() -> tuple[int, int]:
        nonlocal order, at
        order = "<" if data[at] else ">"
        at += 1
        kind = number("I")
        dims = 2 + bool(kind & 0x80000000 or kind % 10000 // 1000 in (1, 3)) + bool(kind & 0x40000000 or kind % 10000 // 1000 in (2, 3))
        if kind & 0x20000000:
            number("I")
        return kind & 0xFFFF, dims

    order = "<"
    kind, dims = head()
    kind %= 1000
    if kind == 3:
        return [polygon(dims)]
    if kind != 6:
        raise ValueError(f"geometry of kind {kind} is no polygon")
    return [polygon(head()[1]) for _ in range(number("I"))]


def gpkg_polygons(blob: bytes) -> list:
    """Nested polygons of a GeoPackage geometry: its header (with an optional box) and then WKB."""
    if blob[:2] != b"GP":
        raise ValueError("no GeoPackage geometry")
    box = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    return wkb_polygons(blob[8 + box :])


class GeoPackage(DataSource):
    """spark.read.format("gpkg").load(path): code, com, name, com_name, polys of the first feature table (option table: another)."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        return f"pos int, code string, com string, name string, com_name string, polys {POLYGONS}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _GeoPackageReader(self.options)


class _GeoPackageReader(DataSourceReader):
    STEP = 2000

    def __init__(self, options: dict):
        self.path, self.table = options["path"].removeprefix("file://"), options.get("table")

    def _open(self):
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._open() as db:
            table, column = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns" + (" WHERE table_name = ?" if self.table else ""), [self.table] if self.table else []).fetchone()
            names = [r[1] for r in db.execute(f'PRAGMA table_info("{table}")')]
            (top,) = db.execute(f'SELECT coalesce(max(rowid), 0) FROM "{table}"').fetchone()
        low = {n.lower(): n for n in names}
        picked = [next((low[a] for a in v if a in low), None) for v in ALIASES.values()]
        if picked[0] is None:
            raise KeyError(f"no column for the code among {names}")
        return [InputPartition((table, column, picked, i)) for i in range(0, top + 1, self.STEP)]

    def read(self, partition: InputPartition):
        table, column, picked, start = partition.value
        columns = ", ".join(f'"{p}"' if p else "NULL" for p in picked)
        with self._open() as db:
            for r in db.execute(f'SELECT rowid, {columns}, "{column}" FROM "{table}" WHERE rowid >= ? AND rowid < ? ORDER BY rowid', (start, start + self.STEP)):
                polys = [[[{"x": x, "y": y} for x, y in ring] for ring in p] for p in gpkg_polygons(r[-1])] if r[-1] else None
                yield (r[0], *[None if v is None else str(v) for v in r[1:-1]], polys)
