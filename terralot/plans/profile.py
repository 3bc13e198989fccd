"""The engine's inputs on the star-schema tables: which column plays which part.

A transaction is an order, its lines the order's lines, a parcel a part, a commune a nation and a
département a region. The same frames are given as SQL for DuckDB, so that results can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.consolidate import consolidate
from ..operators.stats import stats_source

LABELS = {"STANDARD": "Appartement", "LARGE": "Maison", "SMALL": "Local industriel", "MEDIUM": "Dépendance", "PROMO": "Inconnu"}
NATURES = {"1-URGENT": "Vente", "2-HIGH": "Vente en l'état futur d'achèvement", "3-MEDIUM": "Adjudication", "4-NOT SPECIFIED": "Echange", "5-LOW": "Expropriation"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(c: str, names: dict[str, str]):
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(c)]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as the consolidation takes them; `ord` is a struct that orders all lines."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    d = lambda c: F.col(c).cast("double")
    hidden = (F.col("l_partkey") % 13 == 0) | (F.col("l_suppkey") % 4 == 0)
    lon = (d("l_partkey") * F.lit(37.0)) % F.lit(36000.0) / F.lit(100.0) - F.lit(180.0) + d("l_suppkey") % F.lit(10.0) / F.lit(1000.0)
    lat = (d("l_partkey") * F.lit(53.0)) % F.lit(12000.0) / F.lit(100.0) - F.lit(60.0)
    return rows.select(
        F.lit("f").alias("file"), F.col("l_orderkey").cast("string").alias("id"), F.col("l_partkey").cast("string").alias("parcel"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("ord"), F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date"),
        _mapped("o_orderpriority", NATURES).alias("nature"), F.col("o_totalprice").alias("price"), _mapped("p_type", LABELS).alias("rtype"),
        F.floor(F.col("l_quantity") / 25).cast("double").alias("bati"), (F.col("l_linenumber") % 2).cast("int").alias("pieces"),
        F.when(F.col("l_suppkey") % 3 != 0, F.round(F.col("l_extendedprice") * 100)).alias("terrain"), F.lit(None).cast("double").alias("carrez"),
        F.concat_ws(" ", F.col("l_linenumber").cast("string"), "o_orderstatus").alias("adr"), F.lit(None).cast("string").alias("cp"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("com"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("dep"),
        F.when(~hidden, lon).alias("lon"), F.when(~hidden, lat).alias("lat"),
    )


def mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(lines(spark, sf_dir))[0]


def simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order without consolidation: the input of the statistics' queries."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("orders").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    key, d = F.col("o_orderkey"), lambda c: F.col(c).cast("double")
    rows = rows.select(
        key.cast("string").alias("id"), key.alias("k"), F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date"), F.when(key % 6 != 0, (key % 5 + 1).cast("int")).alias("type"),
        F.floor("o_totalprice").cast("long").alias("vf"), (key % 40).cast("int").alias("sb"), (key % 700).cast("int").alias("st"), (key % 9).cast("int").alias("np"), F.lit(1).alias("nl"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("com"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("dep"),
        (d("o_orderkey") * 37.0 % 36000.0 / 100.0 - 180.0 + 0.003).alias("lon"), (d("o_orderkey") * 53.0 % 12000.0 / 100.0 - 60.0 + 0.003).alias("lat"),
    )
    return stats_source(rows)


def _case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join("WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in names.items()) + " END"


CLASS = "CASE WHEN contains(rtype, 'Maison') THEN 'maison' WHEN contains(rtype, 'Appartement') THEN 'appartement' WHEN contains(rtype, 'Dépendance') THEN 'dependance' WHEN contains(rtype, 'Local') THEN 'local' END"
NATURE = "CASE WHEN contains(nature, 'futur') THEN 2 WHEN contains(nature, 'Adjudication') THEN 3 WHEN contains(nature, 'change') THEN 4 WHEN contains(nature, 'Expropriation') THEN 5 ELSE 1 END"
AWAY = "CASE WHEN {0} >= 0 THEN floor({0} + 0.5::DOUBLE) ELSE ceil({0} - 0.5::DOUBLE) END"

#: DuckDB: common table expressions without the leading WITH.
LINES = f"""
l AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS parcel,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS ord,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date, {_case("o_orderpriority", NATURES)} AS nature, o_totalprice AS price, {_case("p_type", LABELS)} AS rtype,
    floor(l_quantity / 25) AS bati, l_linenumber % 2 AS pieces, CASE WHEN l_suppkey % 3 <> 0 THEN round(l_extendedprice * 100) END AS terrain,
    CAST(l_linenumber AS VARCHAR) || ' ' || o_orderstatus AS adr, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS com, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS dep,
    l_partkey % 13 = 0 OR l_suppkey % 4 = 0 AS hidden,
    CASE WHEN NOT (l_partkey % 13 = 0 OR l_suppkey % 4 = 0) THEN CAST(l_partkey * 37 % 36000 AS DOUBLE) / 100::DOUBLE - 180::DOUBLE + CAST(l_suppkey % 10 AS DOUBLE) / 1000::DOUBLE END AS lon,
    CASE WHEN NOT (l_partkey % 13 = 0 OR l_suppkey % 4 = 0) THEN CAST(l_partkey * 53 % 12000 AS DOUBLE) / 100::DOUBLE - 60::DOUBLE END AS lat
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""
FIRSTS = """
f AS (
  SELECT id, arg_min(parcel, ord) AS parcel, arg_min(price, ord) AS price, arg_min(date, ord) AS date, arg_min(nature, ord) AS nature, arg_min(adr, ord) AS adr, arg_min(com, ord) AS com, arg_min(dep, ord) AS dep,
    count(*) AS n_lines, count(*) FILTER (WHERE hidden) AS bare_lines
  FROM l GROUP BY id
), c AS (
  SELECT parcel, arg_min(lon, ord) AS lon, arg_min(lat, ord) AS lat FROM l WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY parcel
)"""
ITEMS = f"""
g AS (
  SELECT id, rtype, bati, pieces, count(*) AS n, count(DISTINCT coalesce(terrain, 0)) AS lands, sum(terrain) AS land FROM l WHERE rtype IS NOT NULL GROUP BY id, rtype, bati, pieces
), i AS (
  SELECT *, CASE WHEN n > 1 AND lands > 1 THEN 1 ELSE n END AS k, {CLASS} AS cls FROM g
)"""
TOTALS = f"""
t AS (
  SELECT id, CAST(sum(k) AS INTEGER) AS nl, CAST(sum(k * pieces) AS INTEGER) AS np, sum(CASE WHEN cls IS DISTINCT FROM 'dependance' THEN k * bati ELSE 0 END) AS built, coalesce(sum(land), 0) AS item_land,
    {", ".join(f"coalesce(sum(k) FILTER (WHERE cls = '{c}'), 0) AS n_{c}, coalesce(sum(k * bati) FILTER (WHERE cls = '{c}'), 0) AS s_{c}" for c in ("maison", "appartement", "local", "dependance"))}
  FROM i GROUP BY id
), p AS (
  SELECT id, sum(top) AS land FROM (SELECT id, parcel, max(coalesce(terrain, 0)) AS top FROM l GROUP BY id, parcel) GROUP BY id
), w AS (
  SELECT *, CASE
    WHEN n_appartement >= 3 OR n_appartement >= 1 AND n_local >= 1 THEN 3
    WHEN s_maison > 0 AND s_maison >= s_appartement AND s_maison >= s_local THEN 1 WHEN s_appartement > 0 AND s_appartement >= s_local THEN 2 WHEN s_local > 0 THEN 4
    WHEN n_maison > 0 THEN 1 WHEN n_appartement > 0 THEN 2 WHEN n_local > 0 THEN 4 WHEN n_dependance > 0 THEN 5 END AS type
  FROM t
)"""
MUTATIONS = f"""
m AS (
  SELECT f.id, date, {NATURE} AS nat, CAST(w.type AS INTEGER) AS type, CAST({AWAY.format("price")} AS BIGINT) AS vf, CAST({AWAY.format("coalesce(built, 0)")} AS INTEGER) AS sb,
    CAST({AWAY.format("(CASE WHEN p.land > 0 THEN p.land ELSE coalesce(item_land, 0) END)")} AS INTEGER) AS st, coalesce(np, 0) AS np, coalesce(nl, 0) AS nl, com, dep, adr,
    ({AWAY.format("(c.lon * 100000::DOUBLE)")}) / 100000::DOUBLE AS lon, ({AWAY.format("(c.lat * 100000::DOUBLE)")}) / 100000::DOUBLE AS lat
  FROM f JOIN c USING (parcel) LEFT JOIN w USING (id) JOIN p USING (id)
)"""
CONSOLIDATED = ",".join((LINES, FIRSTS, ITEMS, TOTALS, MUTATIONS))
SIMPLE = """
s0 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS k, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 5 + 1 AS INTEGER) END AS type,
    CAST(floor(o_totalprice) AS BIGINT) AS vf, CAST(o_orderkey % 40 AS INTEGER) AS sb, CAST(o_orderkey % 700 AS INTEGER) AS st, CAST(o_orderkey % 9 AS INTEGER) AS np,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS com, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS dep,
    CAST(o_orderkey * 37 % 36000 AS DOUBLE) / 100::DOUBLE - 180::DOUBLE + 0.003::DOUBLE AS lon, CAST(o_orderkey * 53 % 12000 AS DOUBLE) / 100::DOUBLE - 60::DOUBLE + 0.003::DOUBLE AS lat
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), s AS (
  SELECT *, date // 10000 AS annee, (date // 100 % 100 - 1) // 3 + 1 AS q, CASE WHEN vf > 0 AND sb > 0 THEN CAST(vf AS DOUBLE) / sb END AS pm2 FROM s0
)"""
