"""Scores of engines and panels against known truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stratified_mean(graded: DataFrame, by: list[str], stratum: str, right: str, shares: DataFrame) -> DataFrame:
    """AG-12: sum over strata of share * right / n.  ``shares`` is (stratum, share); strata
    without rows are skipped and the others are not scaled up.  Two aggregations: the second
    has a row a stratum."""
    per = graded.groupBy(*by, stratum).agg((F.sum(F.col(right).cast("int")) / F.count("*")).alias("rate"))
    return per.join(F.broadcast(shares), stratum).groupBy(*by).agg(F.round(F.sum(F.col("share") * F.col("rate")), 6).alias(right))


def confusion(graded: DataFrame, by: list[str], read: Column, truth: Column) -> DataFrame:
    """AG-13: how many readings are right, right but for case, and wrong."""
    only_case = (read != truth) & (F.lower(read) == F.lower(truth))
    return graded.groupBy(*by).agg(F.count_if(read == truth).alias("correct"), F.count_if(only_case).alias("case_only"), F.count_if((read != truth) & ~only_case).alias("wrong"))


def zero_failure_bound(n: Column, confidence: float = 0.95) -> Column:
    """AG-15: the highest error rate that still makes n successes in a row as likely as 1 - confidence."""
    return F.lit(1.0) - F.pow(F.lit(1.0 - confidence), F.lit(1.0) / n.cast("double"))


def digest(rows: DataFrame, order: str, line: Column, length: int = 16) -> DataFrame:
    """AG-28: start of the SHA-256 over all lines in order, each closed by a line feed.

    It is a single value over all rows in one order, so use it for bounded tables (samples);
    a whole corpus needs a digest of digests.
    """
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return rows.agg(F.substring(F.sha2(F.array_join(F.transform(lines, lambda x: x["l"]), "\n"), 256), 1, length).alias("digest"))
