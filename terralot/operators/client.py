"""What a map client asks: filters, medians, deduplication, status of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiles import LAYERS

#: The first level that shows single sales.
DETAIL_FROM = 11


def view_filter(rows: DataFrame, type_code: int, year_from: int, pm2_from: float, pm2_to: float) -> DataFrame:
    """Sales of a type from a year on, within a range of prices per m2; without price or area none."""
    pm2 = F.when((F.col("vf") > 0) & (F.col("sb") > 0), F.rint(F.col("vf").cast("double") / F.col("sb")))
    return rows.filter((F.col("type") == type_code) & (F.floor(F.col("date") / 10000) >= year_from)).withColumn("pm2", pm2).filter(F.col("pm2").between(pm2_from, pm2_to))


def panel_filter(rows: DataFrame, types: list[int], year_from: int, price_to: float, price_limit: float) -> DataFrame:
    """A price cap at the slider's end is no cap; under any other, rows without price fail."""
    cap = F.lit(True) if price_to >= price_limit else F.coalesce(F.col("vf") <= price_to, F.lit(False))
    return rows.filter(F.col("type").isin(types) & (F.floor(F.col("date") / 10000) >= year_from) & cap)


def upper_median(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The element at half the count, rounded down, of each group's sorted values: the upper of two middle ones."""
    upper = F.expr(f"-percentile_disc(0.5) WITHIN GROUP (ORDER BY -{value})").cast(rows.schema[value].dataType)  # of the negated values the lower one
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), upper.alias(name))


def by_id(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per id, the first by `order`: a sale near a border is in the buffers of several tiles."""
    others = [c for c in rows.columns if c != "id"]
    first = rows.groupBy("id").agg(F.min_by(F.struct(*others), F.struct(*order)).alias("r"))
    return first.select("id", *[F.col(f"r.{c}").alias(c) for c in others])


def request_status(requests: DataFrame) -> DataFrame:
    """HTTP status of tile requests (method, layer, z, x, y, found; a null number is none): 405, 400, 404, 204 or 200."""
    n = F.pow(F.lit(2.0), F.col("z"))
    lowest, deepest = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, (a, b) in LAYERS.items():
        lowest, deepest = F.when(F.col("layer") == name, a).otherwise(lowest), F.when(F.col("layer") == name, b).otherwise(deepest)
    outside = (F.col("z") < lowest) | (F.col("z") > deepest) | (F.col("x") < 0) | (F.col("y") < 0) | (F.col("x") >= n) | (F.col("y") >= n)
    status = (
        F.when(F.col("method") != "GET", 405).when(F.col("layer").isNull(), 400).when(lowest.isNull(), 404).when(F.col("z").isNull() | F.col("x").isNull() | F.col("y").isNull(), 400).when(outside | ~F.col("found"), 204).otherwise(200)
    )
    return requests.withColumn("status", status)


def data_zoom(map_zoom: Column) -> Column:
    """The level whose tiles a map zoom shows: 14 at most."""
    return F.least(F.floor(map_zoom), F.lit(14)).cast("int")


def uses_aggregates(map_zoom: Column) -> Column:
    """Whether a map zoom shows areas instead of single sales."""
    return data_zoom(map_zoom) < DETAIL_FROM


def recomposed(features: DataFrame, value: str) -> DataFrame:
    """(n, total): areas seen in several tiles count once, by their code."""
    return features.dropDuplicates(["code"]).agg(F.count("*").alias("n"), F.coalesce(F.sum(value), F.lit(0)).alias("total"))


def half_up(c: Column) -> Column:
    """The nearest whole number, halves upwards: floor(x + 1/2)."""
    return F.floor(c + F.lit(0.5))


def megabytes(c: Column) -> Column:
    return F.bround(c / F.lit(1e6), 1)


def kilobytes(c: Column) -> Column:
    return F.rint(c / F.lit(1024.0)).cast("long")


#: Colours of areas by price per m2, and of sales by type.
RAMP = [(800, "#13343b"), (2000, "#0f766e"), (3500, "#10b981"), (5500, "#b08d57")]
TYPE_COLOURS, OTHER_COLOUR = {1: "#10b981", 2: "#3b82f6", 3: "#8b5cf6", 4: "#b08d57", 5: "#9ca3af"}, "#6b7280"


def ramp(value: Column, stops: list[tuple[float, str]] = RAMP) -> Column:
    """struct(r, g, b): between two stops in proportion, outside them the nearest stop's; a null value counts as 0."""
    value = F.coalesce(value.cast("double"), F.lit(0.0))
    parts = [(at, [int(colour[i : i + 2], 16) for i in (1, 3, 5)]) for at, colour in stops]

    def channel(k: int) -> Column:
        out = F.lit(float(parts[-1][1][k]))
        for (a, low), (b, high) in reversed(list(zip(parts, parts[1:]))):
            out = F.when(value < b, F.lit(float(low[k])) + (value - F.lit(float(a))) * F.lit((high[k] - low[k]) / (b - a))).otherwise(out)
        return F.when(value <= parts[0][0], F.lit(float(parts[0][1][k]))).otherwise(out)

    return F.struct(*[channel(k).alias(c) for k, c in enumerate("rgb")])


def type_colour(c: Column) -> Column:
    out = F.lit(OTHER_COLOUR)
    for k, colour in TYPE_COLOURS.items():
        out = F.when(c == k, colour).otherwise(out)
    return out
