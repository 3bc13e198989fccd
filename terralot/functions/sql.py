"""The engine's functions for SQL: expressions as SQL functions of a session, and vector tiles as a table function."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from .mvt import decode_tile, gunzipped
from .parse import NATURE_CODE

RING = "array<struct<x:double,y:double>>"
#: Whether a point lies in the ring r, by the even-odd rule; {r} stands for the ring.
IN_RING = (
    "aggregate(sequence(1, size({r})), false, (a, i) -> a <> ((element_at({r}, i).y > y) <> (element_at({r}, CASE WHEN i = 1 THEN size({r}) ELSE i - 1 END).y > y)"
    " AND x < (element_at({r}, CASE WHEN i = 1 THEN size({r}) ELSE i - 1 END).x - element_at({r}, i).x) * (y - element_at({r}, i).y)"
    " / nullif(element_at({r}, CASE WHEN i = 1 THEN size({r}) ELSE i - 1 END).y - element_at({r}, i).y, 0D) + element_at({r}, i).x))"
)
#: Name, parameters and result type, and the expression.
FUNCTIONS = [
    ("half_away(v DOUBLE) RETURNS BIGINT", "CAST(CASE WHEN v >= 0 THEN floor(v + 0.5D) ELSE ceil(v - 0.5D) END AS BIGINT)"),
    ("dept_of(com STRING) RETURNS STRING", "CASE WHEN startswith(com, '97') THEN substring(com, 1, 3) ELSE substring(com, 1, 2) END"),
    ("tile_x(lon DOUBLE, z INT) RETURNS INT", "CAST(floor((lon + 180D) / 360D * pow(2D, z)) AS INT)"),
    ("tile_y(lat DOUBLE, z INT) RETURNS INT", f"CAST(floor((1D - ln(tan(radians(lat)) + 1D / cos(radians(lat))) / {math.pi!r}D) / 2D * pow(2D, z)) AS INT)"),
    ("property_class(label STRING) RETURNS STRING", "CASE WHEN contains(label, 'Maison') THEN 'maison' WHEN contains(label, 'Appartement') THEN 'appartement' WHEN contains(label, 'Dépendance') THEN 'dependance' WHEN contains(label, 'Local') THEN 'local' END"),
    (
        "nature_code(label STRING) RETURNS INT",
        f"CASE WHEN contains(label, 'futur') THEN {NATURE_CODE['vefa']} WHEN contains(label, 'Adjudication') THEN {NATURE_CODE['adjudication']} WHEN contains(label, 'change') THEN {NATURE_CODE['echange']} WHEN contains(label, 'Expropriation') THEN {NATURE_CODE['expropriation']} ELSE {NATURE_CODE['vente']} END",
    ),
    (
        f"pip(x DOUBLE, y DOUBLE, polys array<array<{RING}>>) RETURNS BOOLEAN",
        f"exists(polys, p -> {IN_RING.format(r='p[0]')} AND NOT exists(slice(p, 2, size(p)), h -> {IN_RING.format(r='h')}))",
    ),
]


@udtf(returnType="layer string, kind string, props map<string,string>")
class MvtFeatures:
    """Features of a vector tile, compressed or not."""

    def eval(self, data: bytes) -> Iterator[tuple]:
        for f in decode_tile(gunzipped(bytes(data))):
            yield f["layer"], f["kind"], {k: str(v) for k, v in f["props"].items()}


def register(spark: SparkSession) -> None:
    """Make half_away, dept_of, tile_x, tile_y, property_class, nature_code, pip and the table function mvt_features known to SQL."""
    for head, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udtf.register("mvt_features", MvtFeatures)
