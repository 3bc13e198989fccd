"""Outputs: GeoJSON, line-delimited JSON, Parquet, bundles by département, one document per zone."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import year_of
from ..operators.tiles import TILE_PROPERTIES
from .shared import open_write, read_bytes, write_whole

#: The columns of the Parquet export.
PARQUET = ["id", "date", "annee", "nat", "type", "vf", "sb", "st", "pm2", "np", "nl", "nc", "dep", "com", "lon", "lat"]


def point_feature(properties: list[str]) -> Column:
    """A GeoJSON point as text; null properties are left out."""
    return F.concat(F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":['), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit(']},"properties":'), F.to_json(F.struct(*properties)), F.lit("}"))


def write_points(mutations: DataFrame, folder: str) -> None:
    """Line-delimited GeoJSON of the typed sales."""
    mutations.filter("type IS NOT NULL").select(point_feature(TILE_PROPERTIES).alias("value")).write.mode("overwrite").text(folder)


def parquet_rows(mutations: DataFrame) -> DataFrame:
    """Typed sales with year, rounded price per m2 and a count of buildings that is always null."""
    pm2 = F.when((F.col("vf") > 0) & (F.col("sb") > 0), F.round(F.col("vf").cast("double") / F.col("sb")).cast("int"))
    rows = mutations.filter("type IS NOT NULL").withColumn("annee", year_of(F.col("date"))).withColumn("pm2", pm2).withColumn("nc", F.lit(None).cast("int"))
    return rows.select(*PARQUET)


def write_parquet(mutations: DataFrame, folder: str) -> None:
    parquet_rows(mutations).write.mode("overwrite").parquet(folder)


def write_lines(mutations: DataFrame, folder: str) -> None:
    mutations.write.mode("overwrite").json(folder)


def write_collection(features: DataFrame, uri: str, order: str) -> int:
    """One FeatureCollection file from features as text (column `feature`), one partition at a time on the driver."""
    n = 0
    with open_write(uri) as f:
        f.write(b'{"type":"FeatureCollection","features":[')
        for r in features.orderBy(order).select("feature").toLocalIterator():
            f.write((b"," if n else b"") + r["feature"].encode())
            n += 1
        f.write(b"]}")
    return n


def polygon_feature(properties: list[str]) -> Column:
    """A GeoJSON MultiPolygon as text, from `polys`."""
    rings = F.transform("polys", lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.array(v["x"], v["y"]))))
    return F.concat(F.lit('{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":'), F.to_json(rings), F.lit('},"properties":'), F.to_json(F.struct(*properties)), F.lit("}"))


def bundles(documents: DataFrame, key: str, dep: Column, version: str) -> DataFrame:
    """(dep, value): the bundle of each département, from entity documents (key, doc)."""
    rows = documents.groupBy(dep.alias("dep")).agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), "doc"))).alias("d"))
    inner = F.array_join(F.transform("d", lambda e: F.concat(F.lit('"'), e["k"], F.lit('":'), e["doc"])), ",")
    return rows.select("dep", F.concat(F.lit(f'{{"version":"{version}","entities":{{'), inner, F.lit("}}")).alias("value"))


def zone_index(zones: DataFrame, dep: Column, columns: list[str]) -> DataFrame:
    """(dep, value): the zones of each département in the order of their codes, as one JSON array."""
    row = F.struct("code", *[c for c in columns if c != "code"])
    return zones.groupBy(dep.alias("dep")).agg(F.to_json(F.sort_array(F.collect_list(row))).alias("value"))


def write_each(rows: DataFrame, key: str, folder: str) -> None:
    """A file {key}.json per row (columns key, value) in a shared folder, in the order of the keys in each task."""

    def write(part) -> None:
        for r in part:
            write_whole(f"{folder}/{r[key]}.json", r["value"].encode())

    rows.select(key, "value").repartition(key).sortWithinPartitions(key).foreachPartition(write)


def write_document(uri: str, document: dict) -> None:
    write_whole(uri, json.dumps(document, ensure_ascii=False).encode())


def write_manifest(uri: str, version: str, generated: str, years: list[int], dense: int, counts: dict, departments: list[str]) -> dict:
    """The manifest, written last: what it names is complete."""
    out = {"version": version, "generated": generated, "dense_threshold": dense, "years": years, "departements": departments, "compteurs": counts}
    write_document(uri, out)
    return out


#: Names of a report that passed, which the next build compares with, and of one that failed, which it never reads.
PASSED, FAILED = "qa_report.json", "qa_report_failed.json"


def write_report(folder: str, report: list[dict], totals: dict) -> bool:
    """Write a build's checks (check, severity, violations) and totals; whether no error was found."""
    good = not any(r["severity"] == "error" and r["violations"] for r in report)
    write_document(f"{folder}/{PASSED if good else FAILED}", {"ok": good, "checks": report, "totals": totals})
    return good


def last_totals(folder: str) -> dict:
    """The totals of the last report that passed; none without one."""
    try:
        return json.loads(read_bytes(f"{folder}/{PASSED}"))["totals"]
    except FileNotFoundError:
        return {}


def write_slice(lines: DataFrame, folder: str) -> None:
    """A date slice as gzip CSV."""
    lines.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(folder)
