"""Set operations on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b).distinct().unionByName(b.exceptAll(a).distinct())


def close_range(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """SO-02: every key from the least to the largest on which both signals fire."""
    ends = a.select(key).intersect(b.select(key)).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo IS NOT NULL")
    return ends.select(F.explode(F.sequence("lo", "hi")).alias(key))


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of the rows of a key the one of highest order."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r")).select(*keys, "_r.*")


def assert_disjoint(*sets: DataFrame) -> None:
    """SO-05: no key is in two of the sets."""
    whole = None
    for s in sets:
        s = s.distinct()
        whole = s if whole is None else whole.unionAll(s)
    if not whole.groupBy(*whole.columns).count().where("count > 1").isEmpty():
        raise ValueError("the sets overlap")
