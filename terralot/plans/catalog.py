"""The engine's queries on the star-schema tables, and DuckDB SQL with the same rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, parse
from ..operators import client, consolidate, manifest, periods, qa, recode, stats, tiles, vector_tiles, zones
from .registry import QUERIES as QUERIES
from .registry import SQL as SQL
from .registry import query
from .profile import AWAY, CLASS, CONSOLIDATED, FIRSTS, ITEMS, LINES, NATURE, SIMPLE, TOTALS, lines, mutations, simple, table

# --- scalar functions -------------------------------------------------------------------------

#: Number texts of many shapes, made from the events' keys.
TEXTS = ["{k}", "{k}.5", "-{k}.25", " {k} ", "+{k}e2", "{k}_0", "{k}d", "inf", "nan", "1e400", "", "abc{k}", ".{k}", "{k}.", "--{k}", "0x{k}"]


def _text_spark():
    k = F.get_json_object("props", "$.k")
    out = F.lit(None).cast("string")
    for i, t in enumerate(TEXTS):
        a, _, b = t.partition("{k}")
        out = F.when(F.col("event_id") % len(TEXTS) == i, F.concat(F.lit(a), k, F.lit(b)) if "{k}" in t else F.lit(t)).otherwise(out)
    return out


def _text_sql() -> str:
    k = "json_extract_string(props, '$.k')"
    whens = " ".join("WHEN {} THEN '{}'".format(i, t.replace("{k}", f"' || {k} || '")) for i, t in enumerate(TEXTS))
    return f"CASE event_id % {len(TEXTS)} {whens} END"


_NUMBER = f"CASE WHEN regexp_full_match(t, '{parse.NUMBER.strip('^$')}') THEN TRY_CAST(replace(trim(t), '_', '') AS DOUBLE) END"


@query(f"""
  WITH t AS (SELECT event_id, {_text_sql()} AS t FROM events), n AS (SELECT event_id, t, {_NUMBER} AS v FROM t), f AS (SELECT event_id, t, CASE WHEN isfinite(v) THEN v END AS as_float FROM n)
  SELECT event_id, t AS text, as_float,
    coalesce(CASE WHEN regexp_full_match(t, '{parse.WHOLE.strip("^$")}') THEN TRY_CAST(replace(trim(t), '_', '') AS BIGINT) END, CASE WHEN abs(as_float) < 9e18 THEN CAST({AWAY.format("as_float")} AS BIGINT) END) AS as_int
  FROM f""")
def parse_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from text: what is no plain finite number is null."""
    rows = table(spark, sf_dir, "events").select("event_id", _text_spark().alias("text"))
    return rows.select("event_id", "text", parse.parse_float(F.col("text")).alias("as_float"), parse.parse_int(F.col("text")).alias("as_int"))


@query(f"SELECT event_id, CAST({AWAY.format('v')} AS BIGINT) AS away, ({AWAY.format('(w * 100000::DOUBLE)')}) / 100000::DOUBLE AS at5 FROM (SELECT event_id, (value - 25) / 2 AS v, value / 7 AS w FROM events)")
def round_half_away(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounding half away from zero, to whole numbers and to five decimals."""
    rows = table(spark, sf_dir, "events").select("event_id", ((F.col("value") - 25) / 2).alias("v"), (F.col("value") / 7).alias("w"))
    return rows.select("event_id", parse.half_away(F.col("v")).cast("long").alias("away"), parse.round5(F.col("w")).alias("at5"))


@query(f"WITH {LINES} SELECT {CLASS} AS cls, CAST(CASE {CLASS} WHEN 'maison' THEN 1 WHEN 'appartement' THEN 2 WHEN 'local' THEN 4 WHEN 'dependance' THEN 5 END AS INTEGER) AS code, count(*) AS n FROM l GROUP BY 1, 2")
def classify_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the class of their label."""
    cls = parse.property_class(F.col("rtype"))
    return lines(spark, sf_dir).groupBy(cls.alias("cls"), parse.code(cls, parse.TYPE_CODE).alias("code")).agg(F.count("*").alias("n"))


@query(f"WITH {LINES} SELECT CAST({NATURE} AS INTEGER) AS nat, count(*) AS n FROM l GROUP BY 1")
def classify_nature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the code of their nature."""
    return lines(spark, sf_dir).groupBy(parse.code(parse.nature_class(F.col("nature")), parse.NATURE_CODE).alias("nat")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, nullif(concat_ws(' ', nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END, ''), CASE WHEN c_custkey % 2 = 0 THEN 'bis' END, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END), '') AS adr FROM customer")
def compose_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses from parts that may be missing."""
    k = F.col("c_custkey")
    parts = [F.when(k % 3 == 0, F.lit("")).otherwise(k.cast("string")), F.when(k % 2 == 0, F.lit("bis")), F.when(k % 6 != 0, F.col("c_mktsegment"))]
    return table(spark, sf_dir, "customer").select("c_custkey", parse.compose_address(*parts).alias("adr"))


@query("""SELECT code, CASE WHEN starts_with(code, '97') THEN left(code, 3) ELSE left(code, 2) END AS dep, CASE WHEN starts_with(code, '97') OR starts_with(code, '98') THEN left(code, 3) ELSE left(code, 2) END AS zone_dep
  FROM (SELECT lpad(CAST(p_partkey * 7919 % 100000 AS VARCHAR), 5, '0') AS code FROM part)""")
def dept_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Départements of commune and zone codes."""
    rows = table(spark, sf_dir, "part").select(F.lpad((F.col("p_partkey") * 7919 % 100000).cast("string"), 5, "0").alias("code"))
    return rows.select("code", parse.dept_of(F.col("code")).alias("dep"), parse.dept_of_zone(F.col("code")).alias("zone_dep"))


@query(f"WITH {SIMPLE} SELECT id, CAST(annee AS INTEGER) AS annee, CAST(q AS INTEGER) AS q, pm2, CAST(round(pm2) AS INTEGER) AS pm2_round, substr(CAST(date AS VARCHAR), 7, 2) || '/' || substr(CAST(date AS VARCHAR), 5, 2) || '/' || substr(CAST(date AS VARCHAR), 1, 4) AS shown FROM s")
def pm2_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, quarter, price per m2 and displayed date of each sale."""
    return simple(spark, sf_dir).select("id", "annee", "q", "pm2", F.round("pm2").cast("int").alias("pm2_round"), parse.display_date(F.col("date")).alias("shown"))


# --- consolidation ----------------------------------------------------------------------------


@query(f"WITH {LINES}, {FIRSTS} SELECT parcel, lon, lat FROM c")
def parcel_first_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of each parcel from its first located line."""
    return consolidate.parcel_coords(consolidate.sales(lines(spark, sf_dir))).select("parcel", "lon", "lat")


@query(f"WITH {LINES}, {FIRSTS} SELECT id, parcel, c.lon AS lon, c.lat AS lat FROM f JOIN c USING (parcel)")
def anchor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions anchored by their first line's parcel, whichever transaction located it."""
    rows = consolidate.sales(lines(spark, sf_dir))
    return consolidate.first_lines(rows).join(consolidate.parcel_coords(rows), ["file", "parcel"]).select("id", "parcel", "lon", "lat")


@query(f"WITH {LINES}, {FIRSTS} SELECT id, CAST(n_lines AS BIGINT) AS n_lines FROM f WHERE parcel NOT IN (SELECT parcel FROM c)")
def anchor_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without an anchor."""
    return consolidate.consolidate(lines(spark, sf_dir))[1].select("id", "n_lines")


@query(f"WITH {LINES}, {ITEMS} SELECT id, rtype, bati, CAST(pieces AS INTEGER) AS pieces, CAST(sum(k) AS BIGINT) AS n_items, CAST(coalesce(sum(land), 0) AS BIGINT) AS land FROM i GROUP BY ALL")
def item_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items after merging, counted by label, area and rooms."""
    rows = consolidate.items(consolidate.sales(lines(spark, sf_dir)))
    return rows.groupBy("id", "rtype", "bati", "pieces").agg(F.count("*").alias("n_items"), F.coalesce(F.sum("terrain"), F.lit(0.0)).cast("long").alias("land"))


@query(f"WITH {LINES}, {ITEMS}, {TOTALS} SELECT id, CAST(land AS BIGINT) AS land FROM p")
def parcel_max_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land of each transaction: the sum of its parcels' maxima."""
    return consolidate.land_totals(consolidate.sales(lines(spark, sf_dir))).select("id", F.col("land").cast("long").alias("land"))


@query(f"WITH {LINES}, {ITEMS}, {TOTALS} SELECT id, CAST(type AS INTEGER) AS type, nl FROM w")
def primary_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type of each transaction that has items."""
    return consolidate.item_totals(consolidate.sales(lines(spark, sf_dir))).filter("nl > 0").select("id", parse.code(F.col("cls"), parse.TYPE_CODE).alias("type"), "nl")


@query(f"WITH {CONSOLIDATED} SELECT id, date, CAST(nat AS INTEGER) AS nat, type, vf, sb, st, np, nl, com, dep, adr, lon, lat FROM m")
def consolidate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction's record."""
    return mutations(spark, sf_dir).select("id", "date", "nat", "type", "vf", "sb", "st", "np", "nl", "com", "dep", "adr", "lon", "lat")


@query(f"""WITH {LINES}, b AS (SELECT parcel, id, ord, lag(parcel) OVER (PARTITION BY dep ORDER BY ord) AS before, dep FROM l)
  SELECT dep, parcel, count(*) AS runs FROM b WHERE before IS NULL OR before <> parcel GROUP BY dep, parcel HAVING count(*) > 1""")
def contiguity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose lines don't stand together (here: parcels, with a département as the file)."""
    rows = lines(spark, sf_dir).select(F.col("dep").alias("file"), F.col("parcel").alias("id"), "ord")
    return consolidate.broken_runs(rows).select(F.col("file").alias("dep"), F.col("id").alias("parcel"), "runs")


@query(f"""WITH {LINES}, {ITEMS}, e AS (
    SELECT id, rtype, bati, pieces, unnest(CASE WHEN n > 1 AND lands > 1 THEN [nullif(land, 0)] ELSE ts END) AS terrain, cls
    FROM i JOIN (SELECT id, rtype, bati, pieces, list(terrain ORDER BY ord) AS ts FROM l WHERE rtype IS NOT NULL GROUP BY id, rtype, bati, pieces) USING (id, rtype, bati, pieces)
  ), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE cls WHEN 'maison' THEN 1 WHEN 'appartement' THEN 2 WHEN 'local' THEN 3 WHEN 'dependance' THEN 4 ELSE 5 END, rtype, bati, pieces, coalesce(terrain, -1)) AS place FROM e)
  SELECT id, CAST(place AS INTEGER) AS place, rtype, bati, CAST(pieces AS INTEGER) AS pieces, terrain FROM r""")
def canonical_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in canonical order: class, label, areas; missing values first."""
    rows = consolidate.item_totals(consolidate.sales(lines(spark, sf_dir))).select("id", F.posexplode("biens").alias("p", "b"))
    return rows.select("id", (F.col("p") + 1).alias("place"), F.col("b.type").alias("rtype"), F.col("b.surfBati").alias("bati"), F.col("b.pieces").alias("pieces"), F.col("b.surfTerrain").alias("terrain"))


@query("SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dup_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that occur twice."""
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"))
    return consolidate.duplicate_ids(rows)


@query(f"WITH {SIMPLE} SELECT CAST(annee AS INTEGER) AS annee, count(*) AS n, count(DISTINCT id) AS ids FROM s GROUP BY 1")
def count_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple(spark, sf_dir).groupBy("annee").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


# --- statistics -------------------------------------------------------------------------------


def _med(**columns: str) -> str:
    return ", ".join(f"CAST(round_even(median({c}), 0) AS INTEGER) AS {n}" for n, c in columns.items())


FIVE = {"pm2_med": "pm2", "vf_med": "vf", "sb_med": "sb", "st_med": "st", "np_med": "np"}


@query(f"WITH {SIMPLE} SELECT com, count(*) AS n_tot, {_med(pm2_med='pm2', vf_med='vf')} FROM s GROUP BY com")
def agg_entity_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.entity_total(simple(spark, sf_dir), "com")


@query(f"WITH {SIMPLE} SELECT com, CAST(annee AS INTEGER) AS annee, count(*) AS n, {_med(pm2_med='pm2')} FROM s GROUP BY 1, 2")
def agg_entity_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.entity_year(simple(spark, sf_dir), "com")


@query(f"WITH {SIMPLE} SELECT com, CAST(annee AS INTEGER) AS annee, type, count(*) AS n, {_med(**FIVE)} FROM s WHERE type IS NOT NULL GROUP BY 1, 2, 3")
def agg_entity_year_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.entity_year_type(simple(spark, sf_dir), "com")


@query(f"""WITH {SIMPLE}, d AS (SELECT com FROM s GROUP BY com HAVING count(*) >= 200)
  SELECT com, CAST(annee AS INTEGER) AS annee, CAST(q AS INTEGER) AS q, count(*) AS n, {_med(pm2_med="pm2")} FROM s WHERE com IN (SELECT com FROM d) GROUP BY 1, 2, 3 HAVING count(*) >= 5""")
def agg_entity_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.entity_quarter(simple(spark, sf_dir), "com")


@query(f"""WITH {SIMPLE} SELECT com, CAST(annee AS INTEGER) AS annee, type, CAST(q AS INTEGER) AS q, CAST(grouping(com, annee, type, q) AS INTEGER) AS level, count(*) AS n, {_med(pm2_med="pm2", vf_med="vf")}
  FROM s GROUP BY GROUPING SETS ((com), (com, annee), (com, annee, type), (com, annee, q))""")
def agg_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All granularities in one pass."""
    return stats.grouping_sets(simple(spark, sf_dir), "com")


YEARS, TYPES = list(range(1995, 2002)), [1, 2, 3, 4, 5]


@query(
    f"WITH {SIMPLE} SELECT com, "
    + ", ".join(f"count(*) FILTER (WHERE annee = {y} AND type = {t}) AS n_{y}_t{t}, CAST(round_even(median(pm2) FILTER (WHERE annee = {y} AND type = {t}), 0) AS INTEGER) AS p_{y}_t{t}" for y in YEARS for t in TYPES)
    + " FROM s WHERE type IS NOT NULL GROUP BY com"
)
def wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.wide(simple(spark, sf_dir), "com", YEARS, TYPES)


def _aligned(rows: DataFrame) -> DataFrame:
    arrays = stats.aligned(stats.entity_year(rows, "com"), "com", YEARS)
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",", "null").alias(c)
    return arrays.select("com", text("n"), text("pm2_med"))



@query(f"""WITH {SIMPLE}, y AS (SELECT com, annee, count(*) AS n, CAST(round_even(median(pm2), 0) AS INTEGER) AS p FROM s WHERE type = 1 GROUP BY 1, 2),
  a AS (SELECT com, a.annee AS annee, coalesce(n, 0) AS n, p FROM (SELECT DISTINCT com FROM y) CROSS JOIN (SELECT unnest(range(1995, 2002)) AS annee) a LEFT JOIN y USING (com, annee))
  SELECT com, string_agg(CAST(n AS VARCHAR), ',' ORDER BY annee) AS n, string_agg(coalesce(CAST(p AS VARCHAR), 'null'), ',' ORDER BY annee) AS pm2_med FROM a GROUP BY com""")
def aligned_year_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly counts and medians of all sales of a type along one axis, as text."""
    return _aligned(simple(spark, sf_dir).filter("type = 1"))


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communes with geometry: those of the nations but every seventh, and two without sales."""
    rows = table(spark, sf_dir, "nation").filter("n_nationkey % 7 <> 3").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("com"))
    return rows.unionByName(spark.createDataFrame([("90001",), ("90002",)], "com string"))


SPINE = "e AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS com FROM nation WHERE n_nationkey % 7 <> 3 UNION ALL VALUES ('90001'), ('90002'))"


@query(f"WITH {SIMPLE}, {SPINE}, t AS (SELECT com, count(*) AS n_tot, {_med(pm2_med='pm2', vf_med='vf')} FROM s GROUP BY com) SELECT com, coalesce(n_tot, 0) AS n_tot, pm2_med, vf_med FROM e LEFT JOIN t USING (com)")
def entity_spine_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_spine(_spine(spark, sf_dir), stats.entity_total(simple(spark, sf_dir), "com"), "com")


@query(f"""WITH {SIMPLE}, {SPINE}, t AS (SELECT com, count(*) AS n_tot FROM s GROUP BY com)
  SELECT com AS code, n_tot, round_even(100.0 * n_tot / (SELECT sum(n_tot) FROM t), 3)::DOUBLE AS pct FROM t WHERE com NOT IN (SELECT com FROM e)""")
def missing_geometry_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with sales but no geometry, and their share of all sales."""
    totals = stats.entity_total(simple(spark, sf_dir), "com").select(F.col("com").alias("code"), "n_tot")
    every = totals.agg(F.sum("n_tot").alias("every"))
    lost = qa.missing_geometry(totals, _spine(spark, sf_dir).withColumnRenamed("com", "code"))
    return lost.crossJoin(F.broadcast(every)).select("code", "n_tot", F.bround(100.0 * F.col("n_tot") / F.col("every"), 3).alias("pct"))  # one row


@query(f"WITH {SIMPLE}, {SPINE} SELECT com FROM e WHERE com IN (SELECT com FROM s)")
def semi_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spine(spark, sf_dir).join(simple(spark, sf_dir).select("com"), "com", "left_semi")


# --- codes ------------------------------------------------------------------------------------



def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements made from all orders, among half as many codes as there are orders; splits re-establish the code 25 above."""
    orders, k, m = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("m")
    code = lambda v: F.when(v < 100_000, F.lpad(v.cast("string"), 5, "0")).otherwise(v.cast("string"))
    size = orders.agg(F.floor(F.count("*") / 2).cast("long").alias("n")).select((F.col("n") + 1).alias("m"))
    return orders.crossJoin(F.broadcast(size)).select(  # one row
        F.when(k % 5 == 0, "21").otherwise("32").alias("mod"), F.concat(F.lit("20"), F.lpad((k % 7 + 10).cast("string"), 2, "0"), F.lit("-01-01")).alias("date_eff"), F.when(k % 11 == 0, "COMD").otherwise("COM").alias("typecom_av"),
        code(k * 7 % m).alias("com_av"), F.lit("COM").alias("typecom_ap"), code(F.when(k % 5 == 0, k * 7 % m + 25).otherwise(k * 13 % m + k % 2)).alias("com_ap"), k.alias("pos"),
    )


def _code_sql(v: str) -> str:
    return f"CASE WHEN {v} < 100000 THEN lpad(CAST({v} AS VARCHAR), 5, '0') ELSE CAST({v} AS VARCHAR) END"


MOVES = f"""
v AS (
  SELECT CASE WHEN o_orderkey % 5 = 0 THEN '21' ELSE '32' END AS mod, '20' || lpad(CAST(o_orderkey % 7 + 10 AS VARCHAR), 2, '0') || '-01-01' AS date_eff, CASE WHEN o_orderkey % 11 = 0 THEN 'COMD' ELSE 'COM' END AS typecom_av,
    {_code_sql("(o_orderkey * 7 % m)")} AS com_av, 'COM' AS typecom_ap, {_code_sql("(CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey * 7 % m + 25 ELSE o_orderkey * 13 % m + o_orderkey % 2 END)")} AS com_ap, o_orderkey AS pos
  FROM orders, (SELECT count(*) // 2 + 1 AS m FROM orders)
), n AS (
  SELECT com_av, com_ap FROM (SELECT *, row_number() OVER (PARTITION BY com_av ORDER BY date_eff DESC, pos) AS r FROM v WHERE typecom_av = 'COM' AND typecom_ap = 'COM' AND com_av <> com_ap) WHERE r = 1
)"""



@query(f"WITH {MOVES} SELECT com_av, com_ap FROM n")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recode.latest_events(_moves(spark, sf_dir))


CHAIN = "h AS (SELECT com_av, com_ap AS tip, 1 AS hops FROM n UNION ALL SELECT h.com_av, n.com_ap, hops + 1 FROM h JOIN n ON n.com_av = h.tip WHERE hops < 8), k AS (SELECT com_av, arg_max(tip, hops) AS target FROM h GROUP BY com_av)"



@query(f"WITH RECURSIVE {MOVES}, {CHAIN} SELECT com_av, target FROM k")
def code_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recode.code_chains(_moves(spark, sf_dir))



@query(f"WITH {MOVES} SELECT DISTINCT com_ap AS child, com_av AS parent FROM v WHERE typecom_av = 'COM' AND typecom_ap = 'COM' AND com_av <> com_ap AND mod = '21'")
def split_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recode.children_of_splits(_moves(spark, sf_dir))


#: Communes beyond the nations' codes 0 to 24, without sales.
MORE = 25


def _polygons(spark: SparkSession, sf_dir: str, first: int = 0, more: int = 0) -> DataFrame:
    """Polygons of the nations from `first` on and of `more` codes after them: one or two L-shapes with a hole, on a coarse grid so that they overlap."""
    k = F.col("n_nationkey").cast("double")
    x0, y0 = k * 13.0 % 60.0 * 6.0 - 180.0, k * 7.0 % 20.0 * 6.0 - 60.0
    pt = lambda dx, dy: F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y"))
    outer = F.array(pt(0.0, 0.0), pt(70.0, 0.0), pt(70.0, 30.0), pt(30.0, 30.0), pt(30.0, 60.0), pt(0.0, 60.0), pt(0.0, 0.0))
    hole = F.array(pt(10.0, 10.0), pt(10.0, 20.0), pt(20.0, 20.0), pt(20.0, 10.0), pt(10.0, 10.0))
    second = F.array(F.array(pt(80.0, 5.0), pt(100.0, 5.0), pt(90.0, 25.0), pt(80.0, 5.0)))
    polys = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.array(outer, hole), second)).otherwise(F.array(F.array(outer, hole)))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey")).filter(F.col("n_nationkey") >= first)
    if more:
        rows = rows.unionByName(spark.range(25, 25 + more).withColumnRenamed("id", "n_nationkey"))
    return rows.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("code"), F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("com"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("name"), polys.cast(geo.POLYGONS).alias("polys"), F.col("n_nationkey").alias("pos"))


_RINGS = [  # (polygon, is hole, points)
    (1, False, [(0, 0), (70, 0), (70, 30), (30, 30), (30, 60), (0, 60), (0, 0)]), (1, True, [(10, 10), (10, 20), (20, 20), (20, 10), (10, 10)]), (2, False, [(80, 5), (100, 5), (90, 25), (80, 5)]),
]
_EDGES = ", ".join(f"({p}, {h}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for p, h, r in _RINGS for a, b in zip(r, r[1:]))
EDGES = f"""
z AS (SELECT n_nationkey AS pos, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, n_nationkey * 13 % 60 * 6::DOUBLE - 180 AS x0, n_nationkey * 7 % 20 * 6::DOUBLE - 60 AS y0 FROM nation),
ed AS (
  SELECT z.code, z.pos, p, hole, x0 + px AS xj, y0 + py AS yj, x0 + qx AS xi, y0 + qy AS yi
  FROM z, (VALUES {_EDGES}) e(p, hole, px, py, qx, qy) WHERE p = 1 OR z.pos % 2 = 0
)"""
EDGES_ALL = EDGES.replace("FROM nation)", f"FROM (SELECT n_nationkey FROM nation UNION ALL SELECT unnest(range(25, {25 + MORE}))))")
#: {0}: rows with id, lon, lat, and a condition to join them to `ed`.
INSIDE = """
SELECT id, code, pos FROM (
  SELECT o.id AS id, ed.code AS code, ed.pos AS pos, ed.p AS p,
    sum(CASE WHEN NOT hole AND (yi > lat) <> (yj > lat) AND lon < (xj - xi) * (lat - yi) / (yj - yi) + xi THEN 1 ELSE 0 END) % 2 AS o,
    sum(CASE WHEN hole AND (yi > lat) <> (yj > lat) AND lon < (xj - xi) * (lat - yi) / (yj - yi) + xi THEN 1 ELSE 0 END) % 2 AS h
  FROM {rows} o JOIN ed ON {on} GROUP BY 1, 2, 3, 4
) WHERE o = 1 AND h = 0 GROUP BY 1, 2, 3"""


@query(f"""WITH {SIMPLE}, {EDGES}, u AS (SELECT id, k, com, lon, lat, row_number() OVER (PARTITION BY com ORDER BY id) AS r FROM s WHERE com < '00009'), g AS (SELECT * FROM u WHERE r <= 7), hit AS ({INSIDE.format(rows="g", on="ed.pos >= 9")}),
  first AS (SELECT id, arg_min(code, pos) AS code, min(pos) AS pos FROM hit GROUP BY id), votes AS (SELECT com, code, pos, count(*) AS n FROM first JOIN g USING (id) GROUP BY 1, 2, 3)
  SELECT com, arg_max(code, n * 1000 - pos) AS target FROM votes GROUP BY com""")
def remap_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes without polygon, by the votes of their first points."""
    return recode.vote_targets(simple(spark, sf_dir), _polygons(spark, sf_dir, 9))



@query(f"""WITH RECURSIVE {SIMPLE}, {EDGES}, {MOVES}, {CHAIN}, u AS (SELECT id, com, lon, lat, row_number() OVER (PARTITION BY com ORDER BY id) AS r FROM s WHERE com < '00020'), g AS (SELECT * FROM u WHERE r <= 7), hit AS ({INSIDE.format(rows="g", on="ed.pos >= 20")}),
  first AS (SELECT id, arg_min(code, pos) AS code, min(pos) AS pos FROM hit GROUP BY id), votes AS (SELECT com, code, pos, count(*) AS n FROM first JOIN g USING (id) GROUP BY 1, 2, 3),
  won AS (SELECT com, arg_max(code, n * 1000 - pos) AS voted FROM votes GROUP BY com), chained AS (SELECT com_av AS com, target FROM k WHERE target IN (SELECT code FROM z WHERE pos >= 20))
  SELECT com, coalesce(voted, target) AS target, CASE WHEN voted IS NOT NULL THEN 'vote' WHEN target IS NOT NULL THEN 'chain' ELSE 'orphan' END AS how
  FROM (SELECT DISTINCT com FROM s WHERE com NOT IN (SELECT code FROM z WHERE pos >= 20)) LEFT JOIN won USING (com) LEFT JOIN chained USING (com)""")
def remap_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each unknown code of all sales is mapped."""
    return recode.remap(simple(spark, sf_dir), _polygons(spark, sf_dir, 20), _moves(spark, sf_dir))[1]



@query(f"""WITH {SIMPLE}, {EDGES_ALL}, {MOVES}, d AS (SELECT DISTINCT com_ap AS code, com_av AS com FROM v WHERE typecom_av = 'COM' AND com_av <> com_ap AND mod = '21' AND com_ap NOT IN (SELECT com FROM s)),
  q AS (SELECT id, s.com AS com, lon, lat, d.code AS child FROM s JOIN d USING (com)), hit AS ({INSIDE.format(rows="q", on="ed.code = o.child")})
  SELECT id, arg_min(code, pos) AS com FROM hit GROUP BY id""")
def reassign_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales of parents that lie in a re-established commune; these have codes beyond the nations' and no sales of their own."""
    return recode.reassign_children(simple(spark, sf_dir), _polygons(spark, sf_dir, more=MORE), _moves(spark, sf_dir))


# --- zones and geometry -----------------------------------------------------------------------


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.join_zones(simple(spark, sf_dir), _polygons(spark, sf_dir))


JOINED = f"{SIMPLE}, {EDGES}, j AS (SELECT s.*, hit.code AS code FROM ({INSIDE.format(rows='s', on='ed.code = o.com')}) hit JOIN s USING (id))"


@query(f"WITH {JOINED} SELECT id, code FROM j")
def pip_join_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in the zone of their own commune."""
    return _joined(spark, sf_dir).select("id", "code")



@query(f"WITH {SIMPLE}, {EDGES}, hit AS ({INSIDE.format(rows='s', on='true')}) SELECT id, arg_min(code, pos) AS code FROM hit GROUP BY id")
def gps_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first zone anywhere that holds a point, of all points, by tile keys."""
    return zones.join_anywhere(simple(spark, sf_dir).select("id", "lon", "lat"), _polygons(spark, sf_dir)).select("id", "code")


@query(f"WITH {JOINED} SELECT code, count(*) AS n_tot, {_med(pm2_med='pm2', vf_med='vf')} FROM j GROUP BY code")
def zone_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_stats(_joined(spark, sf_dir))


@query(f"WITH {JOINED} SELECT code, CAST(annee AS INTEGER) AS annee, type, count(*) AS n, {_med(pm2_med='pm2')} FROM j WHERE type IS NOT NULL GROUP BY 1, 2, 3")
def zone_year_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_year_type(_joined(spark, sf_dir))


@query(f"WITH {JOINED} SELECT com, count(*) AS n FROM s WHERE id NOT IN (SELECT id FROM j) GROUP BY com")
def zone_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simple(spark, sf_dir)
    return zones.unmatched(rows, _joined(spark, sf_dir)).groupBy("com").agg(F.count("*").alias("n"))


@query(f"WITH {JOINED} SELECT code, 'N' || CAST(z.pos AS VARCHAR) AS name, n_tot FROM z JOIN (SELECT code, count(*) AS n_tot FROM j GROUP BY code) USING (code)")
def zone_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_layer(_polygons(spark, sf_dir), _joined(spark, sf_dir)).select("code", "name", "n_tot")


@query(f"""WITH {EDGES}, e AS (SELECT code, p, hole, sum(xj * yi - xi * yj) AS a, sum((xj + xi) * (xj * yi - xi * yj)) AS cx, sum((yj + yi) * (xj * yi - xi * yj)) AS cy FROM ed WHERE NOT hole GROUP BY 1, 2, 3),
  b AS (SELECT code, arg_max(cx / (3 * a), abs(a)) AS cx, arg_max(cy / (3 * a), abs(a)) AS cy FROM e GROUP BY code) SELECT code, round(cx, 4) AS cx, round(cy, 4) AS cy FROM b""")
def ring_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre of each polygon's largest part (four decimals)."""
    rows = _polygons(spark, sf_dir).select("code", geo.feature_centroid(F.col("polys")).alias("c"))
    return rows.select("code", F.round("c.cx", 4).alias("cx"), F.round("c.cy", 4).alias("cy"))


@query(f"WITH {EDGES} SELECT code, min(xi) AS xmin, min(yi) AS ymin, max(xi) AS xmax, max(yi) AS ymax, CAST(count(DISTINCT (p, hole)) AS INTEGER) AS rings, CAST(count(*) AS INTEGER) AS vertices FROM ed GROUP BY code")
def polygon_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _polygons(spark, sf_dir).select("code", geo.bbox(F.col("polys"), 6).alias("b"), geo.vertex_counts(F.col("polys")).alias("v"))
    return rows.select("code", "b.*", "v.*")


@query("SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, true AS inside FROM nation")
def interior_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each polygon's inner point lies strictly inside it."""
    rows = _polygons(spark, sf_dir).withColumn("i", geo.interior_point(F.col("polys")))
    return rows.select("code", geo.within(F.col("i.x"), F.col("i.y"), F.col("polys")).alias("inside"))


# --- tiles and views --------------------------------------------------------------------------


def _tile_sql(z: int) -> str:
    return f"CAST(floor((lon + 180) / 360 * {2**z}) AS INTEGER) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / {math.pi!r}) / 2 * {2**z}) AS INTEGER) AS y"


@query(f"WITH {SIMPLE} SELECT id, {_tile_sql(14)} FROM s")
def tile_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.assign(simple(spark, sf_dir), 14).select("id", "x", "y")


@query(f"WITH {SIMPLE} SELECT z, x >> (14 - z) AS x, y >> (14 - z) AS y, count(*) AS n FROM (SELECT {_tile_sql(14)} FROM s), (SELECT CAST(unnest(range(4, 15)) AS INTEGER) AS z) GROUP BY 1, 2, 3")
def tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per tile of all levels."""
    return tiles.tile_counts(tiles.pyramid(simple(spark, sf_dir), 4, 14))


@query(f"WITH {SIMPLE} SELECT x >> 1 AS x, y >> 1 AS y, id FROM (SELECT id, k, {_tile_sql(14)} FROM s) WHERE k % 17 = 0")
def tile_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of level 14 that level 13 lacks (every 17th is left out there on purpose)."""
    rows = simple(spark, sf_dir)
    return tiles.missing_in_parent(tiles.assign(rows.filter("k % 17 <> 0"), 13), tiles.assign(rows, 14))


@query(f"WITH {SIMPLE}, t AS (SELECT id, k, {_tile_sql(4)} FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY k * 7919 % 10007, id) AS n FROM t) SELECT id, x, y FROM r WHERE n <= 20")
def tile_sample_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 20 sales per tile of level 4."""
    return tiles.sample(tiles.assign(simple(spark, sf_dir), 4), 20, F.col("k") * 7919 % 10007).select("id", "x", "y")


@query(f"WITH {SIMPLE} SELECT id, pm2 FROM (SELECT id, type, annee, CASE WHEN vf > 0 AND sb > 0 THEN round_even(CAST(vf AS DOUBLE) / sb, 0) END AS pm2 FROM s) WHERE type = 2 AND annee >= 1998 AND pm2 BETWEEN 2000 AND 8000")
def viewport_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return client.view_filter(simple(spark, sf_dir).drop("pm2"), 2, 1998, 2000, 8000).select("id", "pm2")


@query(f"WITH {SIMPLE} SELECT id FROM s WHERE type IN (1, 3) AND annee >= 1997 AND coalesce(vf <= 200000, false)")
def panel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return client.panel_filter(simple(spark, sf_dir), [1, 3], 1997, 200_000, 500_000).select("id")


@query(f"WITH {SIMPLE}, t AS (SELECT id, {_tile_sql(4)} FROM s) SELECT id, x, y FROM t WHERE x BETWEEN 5 AND 7 AND y BETWEEN 4 AND 8 OR x = 8 AND y = 4")
def viewport_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the first 16 tiles of a view."""
    return tiles.view(tiles.assign(simple(spark, sf_dir), 4), -60.0, 0.0, 40.0, 60.0, 4.7).select("id", "x", "y")


@query(f"WITH {SIMPLE} SELECT com, type, count(*) AS n, list_sort(list(vf))[count(*) // 2 + 1] AS vf_upper FROM s WHERE type IS NOT NULL GROUP BY 1, 2")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return client.upper_median(simple(spark, sf_dir).filter("type IS NOT NULL"), ["com", "type"], "vf", "vf_upper")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS id, min(l_partkey) AS part, arg_min(l_suppkey, (l_partkey, l_suppkey, l_linenumber)) AS supp FROM lineitem GROUP BY 1")
def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per id."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_linenumber").alias("line"))
    return client.by_id(rows, ["part", "supp", "line"]).select("id", "part", "supp")


_REQUEST = "CASE p_partkey % 5 WHEN 0 THEN 'mutations' WHEN 1 THEN 'communes' WHEN 2 THEN 'departements' WHEN 3 THEN 'roads' END"


@query(f"""WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 23 = 0 THEN 'POST' ELSE 'GET' END AS method, {_REQUEST} AS layer, CASE WHEN p_partkey % 19 <> 0 THEN CAST(p_size % 16 AS INTEGER) END AS z, CAST(p_partkey % 300 AS INTEGER) AS x, CAST(p_partkey % 17 AS INTEGER) AS y, p_partkey % 3 <> 0 AS found FROM part)
  SELECT p_partkey, CAST(CASE WHEN method <> 'GET' THEN 405 WHEN layer IS NULL THEN 400 WHEN layer = 'roads' THEN 404 WHEN z IS NULL THEN 400
    WHEN z < CASE layer WHEN 'communes' THEN 6 ELSE 4 END OR z > CASE layer WHEN 'mutations' THEN 14 WHEN 'communes' THEN 10 ELSE 6 END OR x >= pow(2, z) OR y >= pow(2, z) OR NOT found THEN 204 ELSE 200 END AS INTEGER) AS status FROM r""")
def request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    layer = F.when(k % 5 == 0, "mutations").when(k % 5 == 1, "communes").when(k % 5 == 2, "departements").when(k % 5 == 3, "roads")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 23 == 0, "POST").otherwise("GET").alias("method"), layer.alias("layer"), F.when(k % 19 != 0, (F.col("p_size") % 16).cast("int")).alias("z"), (k % 300).cast("int").alias("x"), (k % 17).cast("int").alias("y"), (k % 3 != 0).alias("found")
    )
    return client.request_status(rows).select("p_partkey", "status")


# --- periods, manifests, quality --------------------------------------------------------------


def _period_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select(F.concat(F.lit("2024-"), F.col("l_orderkey").cast("string")).alias("id_mutation"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_mutation"), "l_linenumber")


@query("SELECT '2024-' || CAST(l_orderkey + 1000000 AS VARCHAR) AS id_mutation, count(*) AS n FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') < '1998-07-01' GROUP BY 1")
def period_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before a date under moved ids, counted by id."""
    rows = _period_lines(spark, sf_dir).filter("date_mutation < '1998-07-01'").withColumn("id_mutation", periods.renumbered("id_mutation", 1_000_000))
    return rows.groupBy("id_mutation").agg(F.count("*").alias("n"))


@query("SELECT '2024-' || CAST(l_orderkey AS VARCHAR) AS id_mutation FROM lineitem GROUP BY l_orderkey HAVING min(strftime(l_shipdate, '%Y-%m-%d')) < '1998-07-01' AND max(strftime(l_shipdate, '%Y-%m-%d')) >= '1998-07-01'")
def straddle_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.straddling(_period_lines(spark, sf_dir), "1998-07-01")


@query("SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS dep, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.zone_counts(_index(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("dep"), F.col("c_custkey").cast("string").alias("code"))


@query("SELECT DISTINCT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS dep FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey NOT IN (0, 2)")
def extra_depts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.extra_departments(_index(spark, sf_dir), spark.createDataFrame([("00",), ("02",)], "dep string"))


@query(f"WITH {SIMPLE} SELECT com, count(*) AS n, round_even(avg(CASE WHEN type IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS pct_type, round_even(avg(CASE WHEN pm2 IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS pct_pm2 FROM s GROUP BY com")
def qa_attr_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.attribute_coverage(simple(spark, sf_dir), ["com"], ["type", "pm2"])


@query(f"WITH {SIMPLE}, a AS (SELECT com, count(*) AS n FROM s GROUP BY com), b AS (SELECT com, count(*) AS n FROM s WHERE k % 1000 <> 7 GROUP BY com) SELECT com AS code, a.n AS n_layer, b.n AS n_bundle FROM a JOIN b USING (com) WHERE a.n <> b.n")
def qa_parity_ntot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose totals differ between layer and bundle (one in a thousand sales is left out on purpose)."""
    total = lambda rows: stats.entity_total(rows, "com").select(F.col("com").alias("code"), "n_tot")
    rows = simple(spark, sf_dir)
    return qa.unequal_totals(total(rows), total(rows.filter("k % 1000 <> 7")))


@query(f"""WITH {SIMPLE}, a AS (SELECT {_tile_sql(3)}, count(*) AS n FROM s WHERE k % 40 <> 0 GROUP BY 1, 2), b AS (SELECT {_tile_sql(3)}, count(*) AS n FROM s GROUP BY 1, 2)
  SELECT 3 AS z, x, y, coalesce(a.n, 0) AS n_tile, coalesce(b.n, 0) AS n_src FROM a FULL JOIN b USING (x, y) WHERE abs(coalesce(a.n, 0) - coalesce(b.n, 0)) > greatest(2, coalesce(b.n, 0) / 1000)""")
def qa_source_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles off their source's count (one in forty sales is left out on purpose)."""
    rows = tiles.assign(simple(spark, sf_dir), 3)
    return qa.outside_tolerance(tiles.tile_counts(rows.filter("k % 40 <> 0")), tiles.tile_counts(rows))


@query(f"WITH {SIMPLE} SELECT id, vf FROM s WHERE vf < 20000 OR vf >= 450000")
def qa_price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.price_range(simple(spark, sf_dir), 20_000, 450_000).select("id", "vf")


@query(f"WITH {LINES}, {FIRSTS}, o AS (SELECT count(*) FILTER (WHERE parcel IN (SELECT parcel FROM c)) AS kept, count(*) FILTER (WHERE parcel NOT IN (SELECT parcel FROM c)) AS rejected FROM f) SELECT kept, rejected, round_even(rejected * 100.0::DOUBLE / (kept + rejected), 2) AS pct, rejected * 100.0 / (kept + rejected) > 5 AS over FROM o")
def qa_rejected_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.rejected_share(*consolidate.consolidate(lines(spark, sf_dir)))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simple(spark, sf_dir).filter("type IS NOT NULL").withColumn("nat", F.lit(1)).withColumn("adr", F.lit(None).cast("string")).withColumn("cp", F.lit(None).cast("string"))
    return tiles.assign(rows, 13)


@query(f"WITH {SIMPLE} SELECT id, date, type, vf, sb, st, np, com, {_tile_sql(13)} FROM s WHERE type IS NOT NULL")
def mvt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales encoded to vector tiles and decoded again."""
    data = vector_tiles.encode_points(_points(spark, sf_dir), "mutations", tiles.TILE_PROPERTIES)
    return vector_tiles.sales_of(vector_tiles.decode(data)).select("id", "date", "type", "vf", "sb", "st", "np", "com", "x", "y")


@query(f"WITH {SIMPLE} SELECT 13 AS z, {_tile_sql(13)}, count(*) AS n FROM s WHERE type IS NOT NULL GROUP BY 2, 3")
def mvt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers' tiles put together: features of the sales' layer per tile."""
    points = _points(spark, sf_dir)
    one = vector_tiles.encode_points(points, "mutations", tiles.TILE_PROPERTIES)
    two = vector_tiles.encode_points(points.filter("type = 1"), "communes", ["id"])
    rows = vector_tiles.decode(vector_tiles.merge_layers(one, two)).filter("layer = 'mutations'")
    return rows.groupBy("z", "x", "y").agg(F.count("*").alias("n"))
