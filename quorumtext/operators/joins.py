"""Joins that SQL has no word for, as equi-joins with residual conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, start: str, values: list[str]) -> DataFrame:
    """J-10: each left row takes the values of the last right row of its group whose start is not after ``at``.

    Both sides go through one sort by (group, place) and a running last value; there is no
    join, so a group costs its rows, not their product.  A start at the same place counts.
    """
    width = F.struct(*[F.col(v) for v in values])
    marks = right.select(*by, F.col(start).alias("_at"), F.lit(0).alias("_side"), width.alias("_mark"), *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns if c not in by])
    asks = left.select(*by, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(marks.schema["_mark"].dataType).alias("_mark"), *[c for c in left.columns if c not in by])
    w = Window.partitionBy(*by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marks.unionByName(asks).withColumn("_mark", F.last("_mark", ignorenulls=True).over(w)).where("_side = 1").select(*left.columns, *[F.col("_mark")[v].alias(v) for v in values])


def first_match(calls: DataFrame, notes: DataFrame, on: list[str], call_key: list[str], owner: str, note_key: list[str]) -> DataFrame:
    """J-09: a call takes the first note of its key, and an owner takes a note once."""
    ranked = notes.withColumn("_n", F.row_number().over(Window.partitionBy(*on).orderBy(*note_key))).where("_n = 1").drop("_n")
    met = calls.join(ranked, on)
    return met.withColumn("_n", F.row_number().over(Window.partitionBy(owner, *on).orderBy(*call_key))).where("_n = 1").drop("_n")


def between_rows(left: DataFrame, right: DataFrame, by: list[str], at: Column, low: Column, high: Column, width: float) -> DataFrame:
    """J-11: right rows whose [low, high) holds a left row's place, within groups.

    Both sides are dealt to cells of ``width`` (right rows to each cell they touch), so that a join on
    (group, cell) replaces the comparison of all rows of a group.
    """
    cell = lambda c: F.floor(c / F.lit(width))
    a = left.withColumn("_cell", cell(at))
    b = right.withColumn("_cell", F.explode(F.sequence(cell(low), cell(high))))
    return a.join(b, [*by, "_cell"]).where((at >= low) & (at <= high)).drop("_cell")


def anti_with_key(rows: DataFrame, claimed: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """J-05: rows without a claimed row of the same derived key; keys maps a name to the expressions of both sides."""
    a = rows.withColumns({k: x for k, (x, _) in keys.items()})
    b = claimed.select(*[y.alias(k) for k, (_, y) in keys.items()]).distinct()
    return a.join(b, list(keys), "left_anti").drop(*keys)


def dense_axis(rows: DataFrame, key: str) -> DataFrame:
    """Every whole number from the least to the largest key."""
    return rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias(key))


def contains_any(docs: DataFrame, text: str, needles: DataFrame, needle: str, words: int) -> DataFrame:
    """J-16: needles of ``words`` words that stand in a text, by an equi-join on runs of as many words."""
    w = F.filter(F.split(F.lower(text), "[^a-z]+"), lambda x: x != "")
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - (words - 1)), lambda i: F.array_join(F.slice("_w", i, words), " "))
    made = docs.withColumn("_w", w).where(F.size("_w") >= words).withColumn(needle, F.explode(F.array_distinct(runs))).drop("_w")
    return made.join(needles.select(needle).distinct(), needle, "left_semi")
