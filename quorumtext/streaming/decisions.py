"""Streams of decisions: the last one of a key stands.

The batch engine has no streams; these are extensions with the same answers as the batch forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def read_decisions(spark: SparkSession, folder: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    """ST-01: files appended to a folder, JSON lines."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).json(folder)


def last_by_key(stream: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A streaming aggregate: of each key the row of highest order so far.  State is a row a key."""
    others = [c for c in stream.columns if c not in keys]
    return stream.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r")).select(*keys, "_r.*")


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Counts a window; rows later than ``late`` are left out and their windows' state is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))


def keep_latest(stream: DataFrame, keys: list[str], order: str, target: str, checkpoint: str) -> StreamingQuery:
    """ST-01, ST-03: folds each micro-batch into a parquet table of the latest rows.

    Versions are written side by side and a pointer names the one that holds, so a
    batch that is run again after a failure changes nothing.
    """
    spark = stream.sparkSession

    def fold(batch: DataFrame, number: int) -> None:
        before = f"{target}/v{number - 1}"
        rows = batch
        if number > 0:
            rows = spark.read.schema(batch.schema).parquet(before).unionByName(batch)
        latest = last_by_key(rows, keys, order).select(*batch.columns)
        latest.write.mode("overwrite").parquet(f"{target}/v{number}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_queue(queue: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """ST-02: what is still to be decided."""
    return queue.join(decided.select(*keys).distinct(), keys, "left_anti")
