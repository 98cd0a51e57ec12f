"""Samples that a seed and the keys decide, so that they can be drawn again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def lot(seed: int, keys: list[str]) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _ranged(rows: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """With the lot and its range, of which there are 4,096."""
    return rows.withColumn("_lot", lot(seed, keys)).withColumn("_range", F.substring("_lot", 1, 3))


def reach(rows: DataFrame, stratum: str, most: int, keys: list[str], seed: int) -> DataFrame:
    """(_stratum, _last): the range in which each stratum's ``most``-th row is, from counts; a row a stratum."""
    counts = _ranged(rows, keys, seed).groupBy(stratum, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(stratum).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("_before", before).where(F.col("_before") < most).groupBy(F.col(stratum).alias("_stratum")).agg(F.max("_range").alias("_last"))


def within(rows: DataFrame, reached: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Rows up to the farthest range of all strata, before anything is known of them but their keys."""
    farthest = reached.agg(F.max("_last").alias("_farthest"))
    return _ranged(rows, keys, seed).crossJoin(F.broadcast(farthest)).where("_range <= _farthest").drop("_lot", "_range", "_farthest")


def least_by_lot(rows: DataFrame, stratum: str, size: Column, most: int, keys: list[str], seed: int, reached: DataFrame | None = None) -> DataFrame:
    """The ``size`` rows of least lot of each stratum, of which there are few; ``most`` bounds all sizes.

    A stratum's rows are counted by ranges of their lot (``reach``); only those up to the range in which its ``most``-th row is are
    ranked.  So no task sorts or passes on more than a share of the rows, whatever a stratum's size.
    """
    last = reach(rows, stratum, most, keys, seed) if reached is None else reached
    near = _ranged(rows, keys, seed).join(F.broadcast(last), F.col(stratum).eqNullSafe(F.col("_stratum")) & (F.col("_range") <= F.col("_last"))).drop("_stratum", "_last", "_range")
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("_lot", *keys))
    ranked = near.withColumn("_rank", rank).where(F.col("_rank") <= most)
    return ranked.where(F.col("_rank") <= size).drop("_lot", "_rank")


def next_round(rows: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    """What earlier rounds have not drawn."""
    return rows.join(earlier.select(*keys).distinct(), keys, "left_anti")
