"""Streaming ingestion of period files: a delivery replaces the periods it brings, once it is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import year_of


def read_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def replace_periods(stream: DataFrame, target: str, incoming: str, checkpoint: str) -> StreamingQuery:
    """Write consolidated sales by year. The stream's rows have `delivery` and `rows_of_delivery`.

    Ids are numbered anew with each delivery, so a delivery's years replace what was there before, whole; other
    years stay. A delivery may come in several batches: each is kept under `incoming` by its number (a batch that
    runs again replaces itself), and when as many rows have come as the delivery says, its years are replaced at once."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery", "batch").parquet(incoming)
        come = batch.select("delivery").distinct()
        every = spark.read.schema(batch.schema).option("basePath", incoming).parquet(incoming)
        whole = every.join(F.broadcast(come), "delivery").groupBy("delivery").agg(F.count("*").alias("n"), F.max("rows_of_delivery").alias("all")).filter("n >= all")
        for r in whole.orderBy("delivery").collect():  # the deliveries that this batch completes
            rows = every.filter(F.col("delivery") == r["delivery"]).drop("delivery", "rows_of_delivery").withColumn("annee", year_of(F.col("date"))).dropDuplicates(["id", "annee"])
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("annee").parquet(target)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, length: str, late: str) -> DataFrame:
    """Counts by window and key; rows later than `late` behind the latest time are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, length), key).agg(F.count("*").alias("n"))
