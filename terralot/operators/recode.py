"""Re-coding transactions to the current communes: votes, code chains, re-established communes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import bbox, point_in_polygons
from ..functions.parse import dept_of

#: Cities coded by district; their own codes are no polygons of the layer.
CITY_PARENTS = ["75056", "69123", "13055"]
HOPS, VOTERS = 8, 7


def commune_moves(movements: DataFrame) -> DataFrame:
    """Movements from one commune's code to another's. Columns: mod, date_eff, typecom_av, com_av, typecom_ap, com_ap, pos."""
    return movements.filter("typecom_av = 'COM' AND typecom_ap = 'COM' AND com_av <> com_ap")


def latest_events(movements: DataFrame) -> DataFrame:
    """(com_av, com_ap): each code's last movement; of equal dates the first in the file."""
    w = Window.partitionBy("com_av").orderBy(F.desc("date_eff"), "pos")
    return commune_moves(movements).withColumn("n", F.row_number().over(w)).filter("n = 1").select("com_av", "com_ap")


def code_chains(movements: DataFrame, hops: int = HOPS) -> DataFrame:
    """(com_av, target): where a code's movements lead, after at most `hops` of them, so cycles end."""
    latest = latest_events(movements)
    step = latest.select(F.col("com_av").alias("at"), F.col("com_ap").alias("next"))
    out = latest.select("com_av", F.col("com_ap").alias("target"))
    for _ in range(hops - 1):
        out = out.join(step, out["target"] == step["at"], "left").select("com_av", F.coalesce("next", "target").alias("target"))
    return out


def children_of_splits(movements: DataFrame) -> DataFrame:
    """(child, parent): communes re-established from others (movement 21)."""
    return commune_moves(movements).filter("mod = '21'").select(F.col("com_ap").alias("child"), F.col("com_av").alias("parent")).distinct()


def vote_targets(mutations: DataFrame, polygons: DataFrame, voters: int = VOTERS) -> DataFrame:
    """(com, target) for codes without polygon: the polygon of the same département in which most of the
    code's first `voters` located transactions lie. A point votes for the first polygon that holds it;
    of equally many votes the first polygon wins. Polygons: code, polys, pos; city parents take no part."""
    polygons = polygons.filter(~F.col("code").isin(CITY_PARENTS))
    unknown = mutations.join(polygons.select(F.col("code").alias("com")), "com", "left_anti").filter("lon IS NOT NULL AND lat IS NOT NULL")
    w = Window.partitionBy("com").orderBy("id")
    points = unknown.select("id", "com", "lon", "lat").withColumn("k", F.row_number().over(w)).filter(F.col("k") <= voters)
    box = bbox(F.col("polys"))
    near = polygons.withColumn("d", dept_of(F.col("code"))).withColumn("b", box).select("code", "polys", "pos", "d", "b")
    hit = points.withColumn("d", dept_of(F.col("com"))).join(near, "d")
    hit = hit.filter(F.col("lon").between(F.col("b.xmin"), F.col("b.xmax")) & F.col("lat").between(F.col("b.ymin"), F.col("b.ymax"))).filter(point_in_polygons(F.col("lon"), F.col("lat"), F.col("polys")))
    first = hit.groupBy("com", "id").agg(F.min_by(F.struct("code", "pos"), "pos").alias("v"))
    votes = first.groupBy("com", "v.code", "v.pos").agg(F.count("*").alias("n"))
    return votes.groupBy("com").agg(F.max_by("code", F.struct("n", -F.col("pos"))).alias("target"))


def remap(mutations: DataFrame, polygons: DataFrame, movements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mutations with current codes, mapping): a vote's target, else the chain's if it has a polygon, else unchanged (orphan)."""
    known = polygons.filter(~F.col("code").isin(CITY_PARENTS)).select("code").distinct()
    codes = mutations.select("com").distinct().join(known.withColumnRenamed("code", "com"), "com", "left_anti")
    chain = code_chains(movements).join(known.withColumnRenamed("code", "target"), "target", "left_semi").select(F.col("com_av").alias("com"), F.col("target").alias("chained"))
    mapping = codes.join(vote_targets(mutations, polygons).withColumnRenamed("target", "voted"), "com", "left").join(chain, "com", "left")
    how = F.when(F.col("voted").isNotNull(), "vote").when(F.col("chained").isNotNull(), "chain").otherwise("orphan")
    mapping = mapping.select("com", F.coalesce("voted", "chained").alias("target"), how.alias("how"))
    moved = mutations.join(mapping.select("com", "target"), "com", "left").withColumn("com", F.coalesce("target", "com")).drop("target")
    return with_department(moved), mapping


def reassign_children(mutations: DataFrame, polygons: DataFrame, movements: DataFrame) -> DataFrame:
    """(id, com): transactions still coded under a parent that lie in the polygon of a re-established
    commune without any of its own; the first such polygon takes them."""
    have = mutations.select(F.col("com").alias("code")).distinct()
    children = children_of_splits(movements).withColumnRenamed("child", "code").join(have, "code", "left_anti").filter(~F.col("code").isin(CITY_PARENTS))
    zones = polygons.join(children, "code").withColumn("b", bbox(F.col("polys"))).select("code", "polys", "pos", "b", F.col("parent").alias("com"))
    hit = mutations.select("id", "com", "lon", "lat").join(zones, "com")
    hit = hit.filter(F.col("lon").between(F.col("b.xmin"), F.col("b.xmax")) & F.col("lat").between(F.col("b.ymin"), F.col("b.ymax"))).filter(point_in_polygons(F.col("lon"), F.col("lat"), F.col("polys")))
    return hit.groupBy("id").agg(F.min_by("code", "pos").alias("com"))


def with_children(mutations: DataFrame, moved: DataFrame) -> DataFrame:
    out = mutations.join(moved.withColumnRenamed("com", "child"), "id", "left").withColumn("com", F.coalesce("child", "com")).drop("child")
    return with_department(out)


def with_department(mutations: DataFrame) -> DataFrame:
    return mutations.withColumn("dep", dept_of(F.col("com")))


def without_commune(mutations: DataFrame) -> DataFrame:
    """Transactions with no commune: a build with any must stop."""
    return mutations.filter("com IS NULL")


def refuse_without_commune(mutations: DataFrame) -> DataFrame:
    """The same transactions; an error if one has no commune."""
    if first := without_commune(mutations).limit(5).collect():
        raise ValueError(f"no commune: {[r['id'] for r in first]}")
    return mutations
