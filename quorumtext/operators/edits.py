"""Corrections by hand: a log of edits keyed by entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def apply_edits(entries: DataFrame, edits: DataFrame) -> DataFrame:
    """UD-04.  ``edits``: id, op (drop, date, split), to_month, to_day, cuts.

    Dropped entries go, dated ones take the edit's month and day, split ones come once a
    part.  Edits without an entry are rows with result ``orphan``.  The log is small beside the entries
    but of no fixed size; Spark broadcasts it if its size allows.
    """
    met = entries.join(edits, "id", "left").where("op IS NULL OR op <> 'drop'")
    dated = F.col("op") == "date"
    parts = F.when(F.col("op") == "split", F.sequence(F.lit(0), F.col("cuts"))).otherwise(F.array(F.lit(0)))
    kept = met.select("id", "year", F.when(dated, F.col("to_month")).otherwise(F.col("month")).alias("month"), F.when(dated, F.col("to_day")).otherwise(F.col("day")).alias("day"), F.explode(parts).alias("part"), F.lit("kept").alias("result"))
    none = F.lit(None).cast("int")
    orphans = edits.join(entries, "id", "left_anti").select("id", none.alias("year"), none.alias("month"), none.alias("day"), none.alias("part"), F.lit("orphan").alias("result"))
    return kept.unionByName(orphans)
