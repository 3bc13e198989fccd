"""What the operators share: the shared folder, staged tables, prefix sums, text batches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import new_folder, remove
from ..sources.shared import open_read as open_read
from ..sources.shared import open_write as open_write

#: Spark's setting to delete a query's shuffle files when it ends; nothing reads those of a staged table's query again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: lineage ends there,
    nothing is computed twice, and lost executors cost no more than their running tasks."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    schema = df.schema
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(schema).parquet(folder)
    out._staged_at = folder
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t._staged_at)


def prefix_sum(df: DataFrame, keys: list[str], order: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of `value` over the rows before each row (by the non-negative integer `order`, distinct
    in each key). Two levels, blocks of `block` places and then rows in a block, so no single task
    gets all rows of a key."""
    b = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)).cast("long"))
    sums = b.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = b.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(sums, [*keys, "_block"]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_block", "_before", "_inside")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Smaller batches: at most `rows` rows, and about `chars` bytes, so long texts stay few at a time."""
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, min(rows, int(b.num_rows * chars / max(1, b.nbytes))))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_training(doc_id: str):
    """The rows that a fit may see: crc32 of the id as text leaves another remainder than 2 by 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2


def count_blocks(counts: np.ndarray, size: int) -> tuple[list[int], list[bytes]]:
    """The blocks of a count table that hold any: their numbers, and their packed bytes."""
    blocks = counts.reshape(-1, size)
    used = [int(i) for i in blocks.any(axis=1).nonzero()[0]]
    return used, [zlib.compress(blocks[i].astype(np.int64).tobytes(), 1) for i in used]


def sum_blocks(rows: DataFrame, total: int, size: int, fan_in: int = 256) -> np.ndarray:
    """The tasks' tables (block, counts) summed: `total` counts, a fixed size whatever the input's. First
    `fan_in` sums a block, then these, so no task holds the tables of all tasks; each adds one table at a time."""

    def run(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed = np.zeros(size, np.int64)
        for b in parts:
            for x in b.column("counts"):
                summed += np.frombuffer(zlib.decompress(x.as_py()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(summed.tobytes(), 1)], pa.binary())], ["block", "counts"])

    schema = "block int, counts binary"
    some = rows.select("block", "counts", F.spark_partition_id().alias("task")).withColumn("deal", F.col("task") % fan_in)
    some = some.select("block", "counts", "deal").groupBy("block", "deal").applyInArrow(run, schema)
    out = np.zeros((total // size, size), np.int64)
    for r in some.groupBy("block").applyInArrow(run, schema).collect():
        out[r["block"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.reshape(-1)


def estimated_bytes(df: DataFrame) -> int:
    """The size of a plan's result as Spark estimates it, for the size of a table of counts."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
