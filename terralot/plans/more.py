"""Queries of the remaining operators: client, editions, codes, checks, orders, SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import sql as functions
from ..functions.mvt import encode_layer
from ..operators import client, consolidate, manifest, qa, recode, stats, tiles, vector_tiles, zones
from .catalog import EDGES, INSIDE, JOINED, _joined, _med, _polygons, _spine, _tile_sql
from .profile import AWAY, CLASS, CONSOLIDATED, LINES, NATURE, SIMPLE, lines, simple, table
from .registry import query

# --- client -------------------------------------------------------------------------------------


@query("SELECT p_partkey, CAST(least(floor(p_retailprice / 97), 14) AS INTEGER) AS zoom, least(floor(p_retailprice / 97), 14) < 11 AS aggregates FROM part")
def data_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level that a map zoom shows, and whether it shows areas."""
    z = F.col("p_retailprice") / 97
    return table(spark, sf_dir, "part").select("p_partkey", client.data_zoom(z).alias("zoom"), client.uses_aggregates(z).alias("aggregates"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(round_even((l_quantity - 25) / 2, 0) AS BIGINT) AS even, CAST(floor((l_quantity - 25) / 2 + 0.5) AS BIGINT) AS up, round_even(l_extendedprice * 1000 / 1e6, 1) AS mb, CAST(round_even(l_partkey * 512 / 1024.0::DOUBLE, 0) AS BIGINT) AS kb FROM lineitem")
def client_roundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves to even, halves upwards, megabytes and kilobytes."""
    v = (F.col("l_quantity") - 25) / 2
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.rint(v).cast("long").alias("even"), client.half_up(v).cast("long").alias("up"),
        client.megabytes(F.col("l_extendedprice") * 1000).alias("mb"), client.kilobytes(F.col("l_partkey") * 512).alias("kb"),
    )


@query("SELECT count(DISTINCT c_nationkey) AS n, CAST(sum(DISTINCT c_nationkey * 1000 + 7) AS BIGINT) AS total FROM customer")
def recompose_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sum over areas of several tiles, each counted once."""
    seen = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("code"), (F.col("c_nationkey") * 1000 + 7).alias("n_2025_t2"), F.col("c_custkey").alias("x"))
    return client.recomposed(seen, "n_2025_t2")


_V = "CAST(p_partkey % 70 AS DOUBLE) * 100"


def _channel(low: int, mid: int, high: int, last: int) -> str:
    lerp = lambda a, b, x, y: f"{x}::DOUBLE + (v - {a}::DOUBLE) * (({y - x})::DOUBLE / {b - a})"
    return f"CASE WHEN v <= 800 THEN {low}::DOUBLE WHEN v < 2000 THEN {lerp(800, 2000, low, mid)} WHEN v < 3500 THEN {lerp(2000, 3500, mid, high)} WHEN v < 5500 THEN {lerp(3500, 5500, high, last)} ELSE {last}::DOUBLE END"


@query(f"""SELECT p_partkey, round({_channel(0x13, 0x0F, 0x10, 0xB0)}, 6) AS r, round({_channel(0x34, 0x76, 0xB9, 0x8D)}, 6) AS g, round({_channel(0x3B, 0x6E, 0x81, 0x57)}, 6) AS b,
  CASE p_size % 7 WHEN 1 THEN '#10b981' WHEN 2 THEN '#3b82f6' WHEN 3 THEN '#8b5cf6' WHEN 4 THEN '#b08d57' WHEN 5 THEN '#9ca3af' ELSE '#6b7280' END AS type_colour FROM (SELECT *, {_V} AS v FROM part)""")
def colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of areas by price and of sales by type."""
    rows = table(spark, sf_dir, "part").select("p_partkey", client.ramp((F.col("p_partkey") % 70).cast("double") * 100).alias("c"), client.type_colour(F.col("p_size") % 7).alias("type_colour"))
    return rows.select("p_partkey", *[F.round(f"c.{c}", 6).alias(c) for c in "rgb"], "type_colour")


@query(f"WITH {JOINED}, d AS (SELECT code, count(*) AS n FROM j GROUP BY code), p AS (SELECT CAST(id AS BIGINT) AS k, arg_min(code, pos) AS code FROM (SELECT hit.id AS id, hit.code AS code, hit.pos AS pos FROM ({{}}) hit) GROUP BY 1) SELECT s.k AS k, p.code AS code, coalesce(n, 0) AS n FROM s LEFT JOIN p USING (k) LEFT JOIN d ON d.code = p.code".replace("{}", INSIDE.format(rows="s", on="true")))
def zone_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sales the document of the zone holds that a point lies in."""
    documents = zones.zone_documents(_joined(spark, sf_dir), ["id"])
    sales = F.size(F.from_json("doc", "mutations array<struct<id:string>>")["mutations"]).cast("long")
    points = simple(spark, sf_dir).select("k", "lon", "lat")
    rows = zones.sales_at(points, _polygons(spark, sf_dir), documents.select("code", sales.alias("n")))  # a document is read once, not for each point
    return rows.select("k", "code", F.coalesce("n", F.lit(0)).alias("n"))


# --- zones and tiles ----------------------------------------------------------------------------


@query(f"WITH {JOINED} SELECT z.code AS code, 'N' || CAST(z.pos AS VARCHAR) AS name, z.code AS com, 'C' || CAST(z.pos AS VARCHAR) AS com_name, n_tot, pm2_med FROM z JOIN (SELECT code, count(*) AS n_tot, {_med(pm2_med='pm2')} FROM j GROUP BY code) USING (code)")
def zone_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, commune and totals of each zone with sales, from zones of which every row is there twice."""
    polygons = _polygons(spark, sf_dir).withColumn("com_name", F.concat(F.lit("C"), F.col("pos").cast("string")))
    return zones.zone_meta(_joined(spark, sf_dir), polygons.unionByName(polygons.withColumn("name", F.concat("name", F.lit("x")))))


@query(f"""WITH {SIMPLE} SELECT id, round(lon, 5) AS lon, round(lat, 5) AS lat FROM s""")
def tile_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees to a place in a tile and back, five decimals."""
    rows = tiles.assign(simple(spark, sf_dir), 14)
    n, r, size = F.lit(float(2**14)), F.radians("lat"), 1 << 20
    px = ((F.col("lon") + 180) / 360 * n - F.col("x")) * size
    py = ((1 - F.log(F.tan(r) + 1 / F.cos(r)) / F.lit(3.141592653589793)) / 2 * n - F.col("y")) * size
    at = geo.tile_point_to_wgs84(F.col("z"), F.col("x"), F.col("y"), px, py, size)
    return rows.select("id", F.round(at["lon"], 5).alias("lon"), F.round(at["lat"], 5).alias("lat"))


@query(f"""WITH {EDGES}, a AS (SELECT code, p, hole, sum(xj * yi - xi * yj) AS twice FROM ed GROUP BY 1, 2, 3) SELECT code, CAST(count(*) FILTER (WHERE NOT hole) AS INTEGER) AS outer_rings, CAST(round(sum(twice) FILTER (WHERE NOT hole)) AS BIGINT) AS area2 FROM a GROUP BY code""")
def outer_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer rings by their turn (the polygons' y taken as a tile's, downwards), and twice their area."""
    rows = _polygons(spark, sf_dir).withColumn("rings", geo.exterior_rings(F.flatten("polys")))
    return rows.select("code", F.size("rings").alias("outer_rings"), F.round(F.aggregate(F.transform("rings", geo.signed_area), F.lit(0.0), lambda a, v: a + v)).cast("long").alias("area2"))


@query("SELECT 'A' || CAST(n_nationkey AS VARCHAR) AS code, CAST(n_nationkey * 3 AS VARCHAR) AS n_tot, 1 AS rings, CAST(n_nationkey % 8 AS INTEGER) AS x, round(n_nationkey % 8 / 8.0 * 360 - 180 + 45 * 100 / 4096.0, 4) AS lon FROM nation WHERE n_nationkey % 5 <> 4")
def aggregate_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas from vector tiles: code, properties and outer rings in degrees; features without code are left out."""
    square, hole = [(100, 100), (300, 100), (300, 300), (100, 300)], [(150, 150), (150, 250), (250, 250), (250, 150)]
    made = []
    for r in table(spark, sf_dir, "nation").collect():  # 25 tiles
        k = r["n_nationkey"]
        props = {"n_tot": k * 3} | ({"code": f"A{k}"} if k % 5 != 4 else {})
        made.append((3, k % 8, k // 8, encode_layer("communes", [(None, "polygon", [square, hole], props), (None, "point", [[(1, 1)]], {"code": "p"})])))
    rows = vector_tiles.aggregate_features(vector_tiles.decode(spark.createDataFrame(made, "z int, x int, y int, data binary")), "communes")
    west = F.array_min(F.transform(F.col("rings")[0], lambda p: p["lon"]))
    return rows.select("code", F.try_element_at("props", F.lit("n_tot")).alias("n_tot"), F.size("rings").alias("rings"), "x", F.round(west, 4).alias("lon"))


@query("SELECT event_id, x > 0 AND x < 10 AND y > 0 AND y < 10 AS inside FROM (SELECT event_id, CAST(event_id % 13 - 1 AS DOUBLE) AS x, CAST(event_id % 12 - 1 AS DOUBLE) AS y FROM events)")
def strictly_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in a square; those on its boundary and corners are outside."""
    square = F.array(F.array(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))])))
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 13 - 1).cast("double").alias("x"), (F.col("event_id") % 12 - 1).cast("double").alias("y"))
    return rows.select("event_id", geo.within(F.col("x"), F.col("y"), square).alias("inside"))


# --- editions -----------------------------------------------------------------------------------

_NAMES = "SELECT 'IRIS_' || CASE WHEN o_orderkey % 2 = 0 THEN 'GPKG' ELSE 'SHP' END || CASE WHEN o_orderkey % 7 <> 0 THEN '_' || strftime(o_orderdate, '%Y-%m-%d') ELSE '_none' END AS name, o_orderkey FROM orders"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    date = F.when(k % 7 != 0, F.concat(F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd"))).otherwise("_none")
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("IRIS_"), F.when(k % 2 == 0, "GPKG").otherwise("SHP"), date).alias("name"))


@query(f"SELECT name, regexp_extract(name, '_([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})$', 1) AS date, count(*) AS n FROM ({_NAMES}) WHERE name LIKE '%GPKG%' GROUP BY 1")
def edition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions that match, with the dates in their names."""
    return manifest.editions(_names(spark, sf_dir), "GPKG").groupBy("name", "date").agg(F.count("*").alias("n"))


@query(f"SELECT max(name) AS name, CAST(CASE WHEN max(name) > 'IRIS_GPKG_1999-01-01' THEN 10 ELSE 0 END AS INTEGER) AS exit_code FROM ({_NAMES}) WHERE name LIKE '%GPKG%' AND name NOT LIKE '%none'")
def latest_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest edition, and the exit code of the test against a known one."""
    known = F.lit("1999-01-01")
    rows = manifest.latest(_names(spark, sf_dir), "GPKG")
    return rows.select("name", F.when(manifest.edition_date(F.col("name")) > known, 10).otherwise(0).alias("exit_code"))


@query("SELECT p_partkey, 'https://x.org/' || p_name || '.7z' AS href, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey * 1000 END AS length FROM part")
def feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address and length in link tags of a feed."""
    k = F.col("p_partkey")
    tag = F.concat(F.lit('<link rel="x" href="https://x.org/'), F.col("p_name"), F.lit('.7z"'), F.when(k % 3 != 0, F.concat(F.lit(' gpf_dl:length="'), (k * 1000).cast("string"), F.lit('"'))).otherwise(""), F.lit("/>"))
    rows = table(spark, sf_dir, "part").select("p_partkey", manifest.link(tag).alias("l"))
    return rows.select("p_partkey", "l.href", "l.length")


# --- codes --------------------------------------------------------------------------------------

_MOVED = "CASE WHEN k % 11 = 0 THEN '97199' WHEN com < '00003' THEN '75056' ELSE com END"


@query(f"WITH {SIMPLE}, m AS (SELECT id, {_MOVED} AS com FROM s) SELECT id, com, CASE WHEN starts_with(com, '97') THEN left(com, 3) ELSE left(com, 2) END AS dep FROM m")
def moved_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes replaced by a mapping and, for some ids, by another; the département follows."""
    rows = simple(spark, sf_dir).select("id", "k", F.when(F.col("com") < "00003", "75056").otherwise(F.col("com")).alias("com"), "dep")
    children = rows.filter("k % 11 = 0").select("id", F.lit("97199").alias("com"))
    return recode.refuse_without_commune(recode.with_children(rows, children)).select("id", "com", "dep")


@query(f"WITH {SIMPLE} SELECT id, k FROM s WHERE k % 1000 = 7")
def null_commune_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without commune (one in a thousand is made so on purpose)."""
    rows = simple(spark, sf_dir).withColumn("com", F.when(F.col("k") % 1000 != 7, F.col("com")))
    return recode.without_commune(rows).select("id", "k")


@query("SELECT '00' || CAST(n_nationkey AS VARCHAR) AS com, 'orphan' AS how FROM nation WHERE n_nationkey >= 10")
def city_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes whose points lie only in the polygon of a city's own code, which takes no votes."""
    world = F.array(F.array(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((-190, -90), (190, -90), (190, 90), (-190, 90), (-190, -90))])))
    polygons = spark.createDataFrame([(c, i) for i, c in enumerate(recode.CITY_PARENTS)], "code string, pos int").withColumn("polys", world.cast(geo.POLYGONS))
    sales = table(spark, sf_dir, "nation").filter("n_nationkey >= 10").select(F.col("n_nationkey").cast("string").alias("id"), F.concat(F.lit("00"), F.col("n_nationkey").cast("string")).alias("com"), F.lit(1.0).alias("lon"), F.lit(1.0).alias("lat"), F.lit("00").alias("dep"))
    none = spark.createDataFrame([], "mod string, date_eff string, typecom_av string, com_av string, typecom_ap string, com_ap string, pos long")
    return recode.remap(sales, polygons, none)[1].select("com", "how")


# --- checks -------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('communes', 6, 10), ('departements', 4, 6)) t(name, minzoom, maxzoom)")
def qa_layer_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers that are missing or have other levels."""
    return qa.layer_ranges(spark.createDataFrame([("mutations", 4, 14), ("communes", 6, 9)], "name string, minzoom int, maxzoom int"))


@query(f"WITH {SIMPLE} SELECT annee, count(*) FILTER (WHERE k % 50 <> 1) AS now, count(*) AS last, abs(count(*) FILTER (WHERE k % 50 <> 1) - count(*)) * 100.0 / count(*) > 2 AS moved FROM (SELECT CAST(annee AS INTEGER) AS annee, k FROM s) GROUP BY annee")
def qa_count_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years whose count left the last one's neighbourhood of two percent."""
    counts = simple(spark, sf_dir).groupBy("annee").agg(F.count(F.when(F.col("k") % 50 != 1, 1)).alias("now"), F.count("*").alias("last")).collect()  # a row for each year
    return spark.createDataFrame([(r["annee"], r["now"], r["last"], qa.count_moved(r["now"], r["last"], 2.0)) for r in counts], "annee int, now long, last long, moved boolean")


@query("SELECT p_brand AS layer, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_partkey % 40 = 0) THEN 'vf' ELSE '' END || CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size = 1) THEN 'com' ELSE '' END AS lacking FROM (SELECT DISTINCT p_brand FROM part) WHERE p_brand IN (SELECT p_brand FROM part WHERE p_partkey % 40 = 0 OR p_size = 1)")
def qa_required_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes that some feature of a layer lacks."""
    k = F.col("p_partkey")
    pairs = F.map_filter(F.create_map(F.lit("id"), k.cast("string"), F.lit("vf"), F.when(k % 40 != 0, F.lit("1")), F.lit("com"), F.when(F.col("p_size") != 1, F.lit("c"))), lambda _, v: v.isNotNull())
    rows = qa.attributes_everywhere(table(spark, sf_dir, "part").select(F.col("p_brand").alias("layer"), pairs.alias("props")), ["layer"], ["id", "vf", "com"])
    return rows.select("layer", F.array_join("lacking", "").alias("lacking"))


_SAMPLES = "SELECT 10 + l_linenumber AS z, CASE WHEN l_linenumber <> 3 AND l_partkey % 20 <> 0 AND l_suppkey % 5 <> 0 THEN 1 END AS vf, CASE WHEN l_linenumber >= 4 AND l_partkey % 3 <> 0 THEN 'a' END AS adr, CASE WHEN l_linenumber IN (1, 5) THEN 'c' END AS cp FROM lineitem"


@query(f"""WITH t AS ({_SAMPLES}), c AS (SELECT z, count(vf) / count(*) AS vf, count(adr) / count(*) AS adr, count(cp) / count(*) AS cp FROM t GROUP BY z), f AS (
    SELECT z, 'vf' AS what, CASE WHEN vf = 0 THEN 'error' WHEN vf < 0.9 THEN 'warning' END AS severity FROM c
    UNION ALL SELECT z, 'adr', CASE WHEN z >= 13 AND adr = 0 OR z < 13 AND adr > 0 THEN 'error' WHEN z >= 13 AND adr < 0.8 THEN 'warning' END FROM c
    UNION ALL SELECT z, 'cp', CASE WHEN z >= 13 AND cp = 0 OR z < 13 AND cp > 0 THEN 'error' WHEN z >= 13 AND cp < 0.8 THEN 'warning' END FROM c)
  SELECT * FROM f WHERE severity IS NOT NULL""")
def qa_sample_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of prices, addresses and postcodes by level."""
    n, p = F.col("l_linenumber"), F.col("l_partkey")
    rows = table(spark, sf_dir, "lineitem").select((n + 10).alias("z"), F.when((n != 3) & (p % 20 != 0) & (F.col("l_suppkey") % 5 != 0), 1).alias("vf"), F.when((n >= 4) & (p % 3 != 0), "a").alias("adr"), F.when(n.isin(1, 5), "c").alias("cp"))
    return qa.sample_findings(rows)


@query("SELECT CAST(11 + p_partkey % 4 AS INTEGER) AS z, CAST(p_partkey AS INTEGER) AS x, CAST(0 AS INTEGER) AS y FROM part WHERE p_partkey % 4 >= 2 AND p_size * 20 > 800")
def qa_heavy_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles over the size limit at the deep levels."""
    rows = table(spark, sf_dir, "part").select((F.col("p_partkey") % 4 + 11).cast("int").alias("z"), F.col("p_partkey").cast("int").alias("x"), F.lit(0).alias("y"), F.repeat(F.lit("x"), F.col("p_size") * 20).cast("binary").alias("data"))
    return qa.heavy_tiles(rows, 800).select("z", "x", "y")


@query(f"WITH {SIMPLE} SELECT z FROM (VALUES (12), (13), (14), (15)) t(z) WHERE z NOT IN (SELECT 12 + k % 2 FROM s)")
def qa_zooms_without_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels without any decoded sample."""
    return qa.zooms_without_sample(simple(spark, sf_dir).select((F.col("k") % 2 + 12).cast("int").alias("z")), [12, 13, 14, 15])


@query(f"WITH {SIMPLE} SELECT 'price' AS check, 'warning' AS severity, count(*) FILTER (WHERE vf < 20000 OR vf >= 450000) AS violations FROM s UNION ALL SELECT 'type', 'error', count(*) FILTER (WHERE type IS NULL) FROM s UNION ALL SELECT 'none', 'error', 0 FROM region WHERE r_regionkey = 0")
def qa_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of several checks in one report."""
    rows = simple(spark, sf_dir)
    return qa.report(spark, {"price": ("warning", qa.price_range(rows, 20_000, 450_000)), "type": ("error", rows.filter("type IS NULL")), "none": ("error", rows.filter("vf < 0"))})


@query(f"WITH {SIMPLE}, t AS (SELECT com, count(*) AS n_tot FROM s GROUP BY com), m AS (SELECT * FROM t WHERE com IN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') FROM nation WHERE n_nationkey % 7 = 3)) SELECT CAST(sum(n_tot) AS BIGINT) AS sales, round_even(sum(n_tot) * 100.0::DOUBLE / (SELECT count(*) FROM s), 3) AS pct FROM m")
def qa_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without geometry, and their share."""
    rows = simple(spark, sf_dir)
    totals = stats.entity_total(rows, "com").select(F.col("com").alias("code"), "n_tot")
    return qa.exposure(qa.missing_geometry(totals, _spine(spark, sf_dir).withColumnRenamed("com", "code")), rows.count())


@query("SELECT CAST(c_custkey AS VARCHAR) AS code FROM customer WHERE c_custkey % 3 = 0 ORDER BY code LIMIT 20")
def qa_first_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty codes without geometry."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_custkey"))
    return qa.first_codes(qa.missing_geometry(rows, rows.filter("c_custkey % 3 <> 0")))


# --- order, years, SQL --------------------------------------------------------------------------


def _places(rows: DataFrame, key: str) -> DataFrame:
    """Each row's place in the order that the plan gives: partitions follow each other, and so do rows in them."""
    return rows.select(key, F.monotonically_increasing_id().alias("at"))


@query(f"WITH {CONSOLIDATED}, o AS (SELECT id, lead(id) OVER (ORDER BY id) AS next FROM m) SELECT id, next FROM o")
def ordered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the order of their ids as text: each with the one that follows."""
    kept, _ = consolidate.ordered(*consolidate.consolidate(lines(spark, sf_dir)))
    return _places(kept, "id").select("id", F.lead("id").over(Window.orderBy("at")).alias("next"))


@query(f"WITH {EDGES}, o AS (SELECT code, lead(code) OVER (ORDER BY code) AS next FROM z) SELECT code, next FROM o")
def ordered_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones in the order of their codes: each with the one that follows."""
    return _places(_polygons(spark, sf_dir).orderBy("code"), "code").select("code", F.lead("code").over(Window.orderBy("at")).alias("next"))


@query(f"WITH {SIMPLE} SELECT string_agg(DISTINCT CAST(annee AS VARCHAR), ',' ORDER BY CAST(annee AS VARCHAR)) AS years FROM s")
def years_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years that occur, in order."""
    return spark.createDataFrame([(",".join(map(str, stats.years_of(simple(spark, sf_dir)))),)], "years string")


@query(f"""WITH {LINES} SELECT id, parcel, ord, CAST({AWAY.format("price")} AS BIGINT) AS whole, CASE WHEN starts_with(com, '97') THEN left(com, 3) ELSE left(com, 2) END AS dep, {CLASS} AS cls, CAST({NATURE} AS INTEGER) AS nat, {_tile_sql(9)} FROM l""")
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engine's functions called from SQL."""
    functions.register(spark)
    order = Window.orderBy("ord.l_orderkey", "ord.l_linenumber", "ord.l_partkey", "ord.l_suppkey", "ord.l_quantity")
    rows = lines(spark, sf_dir).withColumn("ord", F.row_number().over(order).cast("long"))  # numbers the rows as the SQL does
    return spark.sql("SELECT id, parcel, ord, half_away(price) AS whole, dept_of(com) AS dep, property_class(rtype) AS cls, nature_code(nature) AS nat, tile_x(lon, 9) AS x, tile_y(lat, 9) AS y FROM {rows}", rows=rows)


@query(f"WITH {JOINED} SELECT id, code FROM j")
def sql_pip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in polygons, from SQL."""
    functions.register(spark)
    return spark.sql("SELECT s.id AS id, z.code AS code FROM {s} s JOIN {z} z ON s.com = z.com AND pip(s.lon, s.lat, z.polys)", s=simple(spark, sf_dir), z=_polygons(spark, sf_dir))


@query("SELECT 'roads' AS layer, 'point' AS kind, CAST(n_nationkey AS VARCHAR) AS k FROM nation")
def sql_mvt_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of vector tiles by the table function."""
    functions.register(spark)
    rows = spark.createDataFrame([(encode_layer("roads", [(None, "point", [[(1, 2)]], {"k": r["n_nationkey"]})]),) for r in table(spark, sf_dir, "nation").collect()], "data binary")
    return spark.sql("SELECT f.layer AS layer, f.kind AS kind, f.props['k'] AS k FROM {t} t, LATERAL mvt_features(t.data) f", t=rows)
