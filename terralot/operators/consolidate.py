"""Lines of a transaction to one record.

A line has: file, id, parcel, ord (orders the lines of a file), date, nature, price, rtype, bati,
pieces, terrain, carrez, adr, cp, com, dep, lon, lat. One grouping by (file, id) brings a transaction's
lines together, in order, as an array; its first line, items and land come from that array by
expressions. So the lines are shuffled once for all of them, and once more (located ones, after
partial aggregation) for the parcels' coordinates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import NATURE_CODE, PRIORITY, TYPE_CODE, code, half_away, nature_class, priority, property_class, round5
from ..sources.shared import staged

KEY = ["file", "id"]
LINE = "file string, id string, parcel string, ord long, date int, nature string, price double, rtype string, bati double, pieces int, terrain double, carrez double, adr string, cp string, com string, dep string, lon double, lat double"


def fold(values: Column) -> Column:
    """Sum from the left in the array's order; nulls count 0."""
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sales(lines: DataFrame) -> DataFrame:
    """(file, id, lines): each transaction's lines in their order. They are dealt by transaction first: a sale has
    few lines, so collecting parts of it before the shuffle would only cost."""
    line = F.struct("ord", "parcel", "date", "nature", "price", "rtype", "bati", "pieces", "terrain", "carrez", "adr", "cp", "com", "dep", "lon", "lat")
    return lines.repartition(*KEY).groupBy(*KEY).agg(F.sort_array(F.collect_list(line)).alias("lines"))


def parcel_coords(grouped: DataFrame) -> DataFrame:
    """(file, parcel, lon, lat): of the first line of each parcel that has both."""
    located = F.filter("lines", lambda x: x["lon"].isNotNull() & x["lat"].isNotNull())
    each = grouped.select("file", F.explode(F.transform(located, lambda x: F.struct(x["parcel"].alias("parcel"), x["ord"].alias("ord"), x["lon"].alias("lon"), x["lat"].alias("lat")))).alias("x"))
    return each.groupBy("file", F.col("x.parcel").alias("parcel")).agg(F.min_by(F.struct("x.lon", "x.lat"), "x.ord").alias("at")).select("file", "parcel", "at.lon", "at.lat")


FIRST = ["parcel", "price", "date", "nature", "adr", "cp", "com", "dep"]


def first_lines(grouped: DataFrame) -> DataFrame:
    """The first line of each transaction, and how many lines it has and how many without coordinates."""
    first = F.get("lines", F.lit(0))
    bare = F.size(F.filter("lines", lambda x: x["lon"].isNull() | x["lat"].isNull())).alias("bare_lines")
    return grouped.select(*KEY, *[first[c].alias(c) for c in FIRST], F.size("lines").cast("long").alias("n_lines"), bare)


def merged_items(lines: Column) -> Column:
    """Items after merging, as structs (rtype, cls, bati, pieces, carrez, terrain).

    Items of one label, built area, room count and private area (a missing value equals -1) merge if they
    are several and their land areas (a missing one equals 0) differ: the first one's values, with the
    sum of the land areas, or null for 0. They stand in the order of their groups' and their own first lines.
    """
    minus = lambda c: F.coalesce(c, F.lit(-1.0))

    def item(x: Column, terrain: Column) -> Column:
        return F.struct(x["rtype"].alias("rtype"), property_class(x["rtype"]).alias("cls"), x["bati"].alias("bati"), x["pieces"].alias("pieces"), x["carrez"].alias("carrez"), terrain.alias("terrain"))

    key = lambda x: F.struct(x["rtype"].alias("r"), minus(x["bati"]).alias("b"), F.coalesce(x["pieces"], F.lit(-1)).alias("p"), minus(x["carrez"]).alias("c"))
    built = F.transform(F.filter(lines, lambda x: x["rtype"].isNotNull()), lambda x: F.struct(key(x).alias("key"), x.alias("x")))

    def merged(each: Column) -> Column:
        lands = F.array_distinct(F.transform(each, lambda x: F.coalesce(x["terrain"], F.lit(0.0))))
        total = F.nullif(fold(F.transform(each, lambda x: x["terrain"])), F.lit(0.0))
        first = F.get(each, F.lit(0))
        return F.when((F.size(each) > 1) & (F.size(lands) > 1), F.array(item(first, total))).otherwise(F.transform(each, lambda x: item(x, x["terrain"])))

    def grouped(built: Column) -> Column:
        keys = F.array_distinct(F.transform(built, lambda e: e["key"]))
        apart = F.transform(built, lambda e: item(e["x"], e["x"]["terrain"]))
        groups = F.transform(keys, lambda k: F.transform(F.filter(built, lambda e: e["key"] == k), lambda e: e["x"]))
        return F.when(F.size(keys) == F.size(built), apart).otherwise(F.flatten(F.transform(groups, merged)))

    return let(built, grouped)


def items(grouped: DataFrame) -> DataFrame:
    """A row per item after merging."""
    return grouped.select(*KEY, F.explode(merged_items(F.col("lines"))).alias("i")).select(*KEY, "i.*")


def land_of(lines: Column) -> Column:
    """Sum over a transaction's parcels of their largest land area, from the largest down."""
    parcels = F.array_distinct(F.transform(lines, lambda x: x["parcel"]))
    tops = F.transform(parcels, lambda p: F.array_max(F.transform(F.filter(lines, lambda x: x["parcel"] == p), lambda x: F.coalesce(x["terrain"], F.lit(0.0)))))
    return fold(F.sort_array(tops, asc=False))


def land_totals(grouped: DataFrame) -> DataFrame:
    return grouped.select(*KEY, land_of(F.col("lines")).alias("land"))


def primary_type(counts: dict[str, Column], surfaces: dict[str, Column]) -> Column:
    """Several flats, or a flat with premises: a building; else the class of the largest built area,
    by precedence if equal; else the first class there is, outbuildings last; else none."""
    out = F.when(counts["dependance"] > 0, F.lit("dependance"))
    for name in reversed(PRIORITY[1:4]):
        out = F.when(counts[name] > 0, F.lit(name)).otherwise(out)
    top = F.greatest(*[surfaces[name] for name in PRIORITY[1:4]])
    for name in reversed(PRIORITY[1:4]):
        out = F.when((top > 0) & (surfaces[name] == top), F.lit(name)).otherwise(out)
    return F.when((counts["appartement"] >= 3) | ((counts["appartement"] >= 1) & (counts["local"] >= 1)), F.lit("immeuble")).otherwise(out)


def item_totals(grouped: DataFrame) -> DataFrame:
    """Sums over each transaction's items, its class, and its items in canonical order (none: no class and no items)."""
    rows = grouped.withColumn("items", merged_items(F.col("lines")))
    of = lambda f: F.transform(F.filter("items", f), lambda i: i["bati"])

    def is_(cls: str):
        return lambda i: i["cls"] == cls

    counts = {c: F.size(F.filter("items", is_(c))) for c in PRIORITY[1:]}
    surfaces = {c: fold(of(is_(c))) for c in PRIORITY[1:]}
    minus = lambda c: F.coalesce(c, F.lit(-1.0))
    ordered = F.transform(
        "items",
        lambda i, n: F.struct(
            priority(i["cls"]).alias("rank"), i["rtype"].alias("type"), minus(i["bati"]).alias("b"), F.coalesce(i["pieces"], F.lit(-1)).alias("p"), minus(i["terrain"]).alias("t"), minus(i["carrez"]).alias("c"), n.alias("n"), i.alias("i")
        ),
    )
    final = F.transform(
        F.sort_array(ordered),
        lambda s: F.struct(s["type"].alias("type"), s["i"]["bati"].alias("surfBati"), s["i"]["pieces"].alias("pieces"), s["i"]["terrain"].alias("surfTerrain"), s["i"]["carrez"].alias("surfCarrez")),
    )
    return rows.select(
        *[c for c in grouped.columns if c != "lines"], primary_type(counts, surfaces).alias("cls"), fold(of(lambda i: i["cls"].isNull() | (i["cls"] != "dependance"))).alias("built"),
        F.aggregate("items", F.lit(0), lambda a, i: a + F.coalesce(i["pieces"], F.lit(0))).alias("np"), fold(F.transform("items", lambda i: i["terrain"])).alias("item_land"),
        F.size("items").alias("nl"), final.alias("biens"),
    )


def consolidate(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): one record per transaction; rejected are those whose first line's parcel has no coordinates."""
    grouped = sales(lines)
    first = F.get("lines", F.lit(0))
    bare = F.size(F.filter("lines", lambda x: x["lon"].isNull() | x["lat"].isNull()))
    rows = grouped.select(*KEY, "lines", *[first[c].alias(c) for c in FIRST], F.size("lines").cast("long").alias("n_lines"), bare.alias("bare_lines"), land_of(F.col("lines")).alias("land"))
    placed = item_totals(rows).join(parcel_coords(grouped), ["file", "parcel"], "left")
    rejected = placed.filter("lon IS NULL").select("file", "id", "n_lines")
    whole = lambda c: half_away(F.coalesce(c, F.lit(0.0))).cast("int")
    kept = placed.filter("lon IS NOT NULL").select(
        "file", "id", "date", code(nature_class(F.col("nature")), NATURE_CODE).alias("nat"), code(F.col("cls"), TYPE_CODE).alias("type"), half_away(F.col("price")).cast("long").alias("vf"),
        whole(F.col("built")).alias("sb"), whole(F.when(F.col("land") > 0, F.col("land")).otherwise(F.col("item_land"))).alias("st"), "np", "nl",
        "com", "dep", "adr", "cp", round5(F.col("lon")).alias("lon"), round5(F.col("lat")).alias("lat"), "biens", "bare_lines",
    )
    return kept, rejected


def broken_runs(lines: DataFrame) -> DataFrame:
    """Ids whose lines don't stand together in their file: (file, id, runs).

    Lines are cut into ranges of (file, ord), so no task takes a whole file; each is compared with the line
    before it in its range, and a range's first line with the last one of the range before."""
    ranged = staged(lines.select("file", "id", "ord").repartitionByRange("file", "ord").withColumn("range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("range").orderBy("file", "ord")
    ends = ranged.groupBy("range").agg(F.max_by(F.struct("file", "id"), F.struct("file", "ord")).alias("end"))  # a row for each range
    ends = ends.select("range", F.lag("end").over(Window.orderBy("range")).alias("end"))
    rows = ranged.withColumn("before", F.lag(F.struct("file", "id")).over(inside)).join(F.broadcast(ends), "range").withColumn("before", F.coalesce("before", "end"))
    starts = rows.filter(F.col("before").isNull() | (F.col("before.file") != F.col("file")) | (F.col("before.id") != F.col("id")))
    return starts.groupBy(*KEY).agg(F.count("*").alias("runs")).filter("runs > 1")


def duplicate_ids(mutations: DataFrame) -> DataFrame:
    """Ids that occur in more than one record: a build with any must stop."""
    return mutations.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")


def refuse_duplicates(mutations: DataFrame) -> DataFrame:
    """The same records; an error if an id occurs in more than one."""
    if first := duplicate_ids(mutations).limit(5).collect():
        raise ValueError(f"ids in several records: {[r['id'] for r in first]}")
    return mutations


def ordered(kept: DataFrame, rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and rejected ids in the order of their ids, as text."""
    return kept.orderBy("id"), rejected.orderBy("id")
