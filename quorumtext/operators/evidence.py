"""What the readings of a line say about a derived value, and the best string for an agreed one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from .vote import present


def month_votes(words: DataFrame, by: list[str], order: str, least: int = 3) -> DataFrame:
    """EV-02: (by, month, votes, offset) of words for which ``least`` readings name a month that the winner does not show.

    ``offset`` is where the word starts in the line's joined text.
    """
    from .sequence import UP_TO_HERE, over

    start = F.sum(F.length("winner") + 1).over(over(by, [order], UP_TO_HERE)) - F.length("winner") - 1
    told = F.filter(F.transform(present(F.col("readings")), lambda r: T.month_of(r)), lambda m: m.isNotNull())
    placed = words.withColumns({"offset": start, "_told": told, "_own": T.month_of(F.col("winner"))}).where(F.col("_own").isNull() & (F.size("_told") >= least))
    kinds = F.transform(F.array_distinct("_told"), lambda m: F.struct(F.size(F.filter("_told", lambda x: x == m)).alias("votes"), (-m).alias("n")))
    best = F.array_max(kinds)
    return placed.withColumn("_b", best).where(F.col("_b.votes") >= least).select(*by, order, (-F.col("_b.n")).alias("month"), "_b.votes", "offset")


def best_string(rows: DataFrame, by: list[str], reading: str, plain: Column) -> DataFrame:
    """EV-03: of the readings that state an agreed value the plain form, then the one with most votes, then the shortest."""
    kinds = rows.groupBy(*by, reading).agg(F.count("*").alias("_n"), F.max(plain).alias("_plain"))
    return kinds.groupBy(*by).agg(F.min_by(reading, F.struct(~F.col("_plain"), -F.col("_n"), F.length(reading), F.col(reading))).alias("text"))


def best_reading(rows: DataFrame, by: list[str], reading: str) -> DataFrame:
    """EV-04: a month's exact name, then votes, then length, then the string."""
    kinds = rows.groupBy(*by, reading).agg(F.count("*").alias("_n"))
    exact = F.lower(reading).isin(*T.MONTHS)
    return kinds.groupBy(*by).agg(F.max_by(reading, F.struct(exact, F.col("_n"), F.length(reading), F.col(reading))).alias("text"))


def roman_candidates(readings: Column) -> Column:
    """EV-05: the numbers that readings give as a Roman numeral at the start."""
    numerals = F.transform(present(readings), lambda r: F.regexp_extract(r, r"^\s*([IVXLC]+)\b", 1))
    return F.array_sort(F.array_distinct(F.transform(F.filter(numerals, lambda n: n != ""), lambda n: T.from_roman(n))))


def glued_entry(words: Column) -> Column:
    """EV-07: a year that opens a line, then a quotation mark or any word that some reading takes for a month.  ``words``: array of arrays of readings."""
    opens = F.exists(F.get(words, F.lit(0)), lambda r: r.rlike(r"^1[2-8]\d\d"))
    later = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(0)))
    return opens & (F.exists(F.get(words, F.lit(1)), lambda r: r.rlike("^[\"“«]")) | F.exists(later, lambda some: F.exists(some, lambda r: T.month_of(r).isNotNull())))


def alike(a: Column, b: Column) -> Column:
    """EV-08: the same word, or the same month."""
    return F.coalesce(T.same_word(a, b), F.lit(False)) | F.coalesce(T.month_of(a) == T.month_of(b), F.lit(False))


def refuse_if_shared(flagged: DataFrame, adjudicated: DataFrame, key: str) -> None:
    """J-17: pages that were adjudicated may not be read in another way."""
    both = [r[0] for r in flagged.select(key).intersect(adjudicated.select(key)).orderBy(key).limit(5).collect()]
    if both:
        raise ValueError(f"adjudicated pages are flagged: {both}")


def join_rounds(rounds: list[DataFrame]) -> DataFrame:
    """PR-01: sample rounds as one; of a repeated id the first round's row stands."""
    from functools import reduce

    marked = [r.withColumn("_round", F.lit(n)) for n, r in enumerate(rounds)]
    whole = reduce(DataFrame.unionByName, marked)
    others = [c for c in rounds[0].columns if c != "id"]
    return whole.groupBy("id").agg(F.min_by(F.struct(*others), "_round").alias("_r")).select("id", "_r.*")
