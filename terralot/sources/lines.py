"""Transaction files: CSV of 40 named columns, plain or gzip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.parse import compose_address, parse_float, parse_int

#: The columns of a transaction file in their order.
HEADER = [
    "id_mutation", "date_mutation", "numero_disposition", "nature_mutation", "valeur_fonciere", "adresse_numero", "adresse_suffixe", "adresse_nom_voie", "adresse_code_voie", "code_postal",
    "code_commune", "nom_commune", "code_departement", "ancien_code_commune", "ancien_nom_commune", "id_parcelle", "ancien_id_parcelle", "numero_volume",
    "lot1_numero", "lot1_surface_carrez", "lot2_numero", "lot2_surface_carrez", "lot3_numero", "lot3_surface_carrez", "lot4_numero", "lot4_surface_carrez", "lot5_numero", "lot5_surface_carrez",
    "nombre_lots", "code_type_local", "type_local", "surface_reelle_bati", "nombre_pieces_principales", "code_nature_culture", "nature_culture", "code_nature_culture_speciale",
    "nature_culture_speciale", "surface_terrain", "longitude", "latitude",
]
NEEDED = ["id_mutation", "id_parcelle", "date_mutation"]


def read_raw(spark: SparkSession, paths: list[str] | str, multi_line: bool = False) -> DataFrame:
    """All columns as text, with file, ord (place in the file) and, of lines of another width, _corrupt_record.

    The columns are those of the first file's header, in any order; a header without the needed columns,
    or another file with another header, is an error. Plain files are split (a gzip file is one split);
    multi_line: quoted values may hold line breaks, and then a file is one split. ord goes by split and line.
    """
    paths = sorted(set([paths] if isinstance(paths, str) else paths))
    first = spark.read.text(paths).first()
    columns = [x.strip().strip('"') for x in (first["value"] if first else "").lstrip("\ufeff").split(",")]
    if missing := [c for c in NEEDED if c not in columns]:
        raise ValueError(f"columns are missing: {missing}")
    schema = StructType([StructField(c, StringType()) for c in (*columns, "_corrupt_record")])
    # a line's width shows only if all its fields are parsed
    raw = spark.read.option("columnPruning", False).csv(paths, schema=schema, header=True, multiLine=multi_line, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", enforceSchema=False, encoding="UTF-8")
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    return raw.withColumn("file", F.col("_metadata.file_path")).withColumn("ord", place)


def to_lines(raw: DataFrame) -> DataFrame:
    """Typed lines of those rows that have the right width and the needed values."""
    rows = raw.filter("_corrupt_record IS NULL").dropna(subset=NEEDED)
    carrez = F.filter(F.array(*[parse_float(F.col(f"lot{i}_surface_carrez")) for i in range(1, 6)]), lambda v: v.isNotNull())
    number = lambda c: parse_float(F.col(c))
    return rows.select(
        "file", F.col("id_mutation").alias("id"), F.col("id_parcelle").alias("parcel"), "ord", F.regexp_replace("date_mutation", "-", "").try_cast("int").alias("date"), F.col("nature_mutation").alias("nature"),
        number("valeur_fonciere").alias("price"), F.col("type_local").alias("rtype"), number("surface_reelle_bati").alias("bati"), parse_int(F.col("nombre_pieces_principales")).cast("int").alias("pieces"),
        number("surface_terrain").alias("terrain"), F.when(F.size(carrez) > 0, F.aggregate(carrez, F.lit(0.0), lambda a, v: a + v)).alias("carrez"),
        compose_address(F.col("adresse_numero"), F.col("adresse_suffixe"), F.col("adresse_nom_voie")).alias("adr"), F.col("code_postal").alias("cp"), F.col("code_commune").alias("com"), F.col("code_departement").alias("dep"),
        number("longitude").alias("lon"), number("latitude").alias("lat"),
    )


def counters(raw: DataFrame) -> DataFrame:
    """(lines, malformed, skipped) over all files. Spark drops wholly blank lines, so they count nowhere."""
    bad = F.col("_corrupt_record").isNotNull()
    lacking = F.lit(False)
    for c in NEEDED:
        lacking = lacking | F.col(c).isNull()
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return raw.agg(F.count("*").alias("lines"), total(bad).alias("malformed"), total(~bad & lacking).alias("skipped"))


#: A consolidated record, as the sinks write it.
MUTATION = "id string, date int, nat int, type int, vf long, sb int, st int, np int, nl int, com string, dep string, adr string, cp string, lon double, lat double"


def read_mutations(spark: SparkSession, path: str) -> DataFrame:
    """Consolidated records from line-delimited JSON, by their declared schema."""
    return spark.read.schema(MUTATION).json(path)


def read_located(spark: SparkSession, path: str) -> DataFrame:
    """Exported records (Parquet) with the point that the spatial joins take."""
    return spark.read.parquet(path).withColumn("pt", F.struct("lon", "lat"))
