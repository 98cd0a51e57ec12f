"""UD-03, D12: checks that fire on rows, as one pass that explodes what fired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def findings(rows: DataFrame, keys: list[str], checks: dict[str, Column]) -> DataFrame:
    """(keys, check) of every check that holds for a row."""
    fired = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]), lambda x: x.isNotNull())
    return rows.select(*keys, F.explode(fired).alias("check"))


def fire_rates(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, n, rate): one aggregation over the rows, then a row a check."""
    counts = rows.agg(F.count("*").alias("_all"), *[F.count_if(c).alias(name) for name, c in checks.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("n")) for name in checks])
    return counts.select("_all", F.explode(pairs).alias("c")).select("c.check", "c.n", F.round(F.col("c.n") / F.col("_all"), 6).alias("rate"))


def scores(found: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """AG-24: the sum of weights of what fired, per key; checks without a weight inform only."""
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return found.groupBy(*keys).agg(F.round(F.sum(F.coalesce(F.try_element_at(table, F.col("check")), F.lit(0.0))), 6).alias("score"), F.count("*").alias("n"))


def text_checks(text: str) -> dict[str, Column]:
    """Checks on a text alone."""
    t = F.col(text)
    return {
        "empty": F.trim(t) == "",
        "short": F.length(t) < 100,
        "digit_in_word": t.rlike("[A-Za-z][0-9]+[A-Za-z]"),
        "double_space": t.contains("  "),
        "unbalanced": F.length(t) - F.length(F.translate(t, "(", "")) != F.length(t) - F.length(F.translate(t, ")", "")),
        "upper_run": t.rlike("[A-Z]{6}"),
        "space_before_mark": t.rlike(" [,;:]"),
        "symbols": t.rlike("[#$%&*]{3}"),
        "hyphen_at_end": t.rlike("-\\n"),
        "no_mark_at_end": ~t.rlike("[.!?]$"),
    }
