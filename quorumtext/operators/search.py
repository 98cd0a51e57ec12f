"""D11: substring search over folded texts, with snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T


def hits(records: DataFrame, text: str, needle: str, least: int = 2) -> DataFrame:
    """Records that hold the needle (folded, quotes stripped), with ``at``, the 1-based place of its first occurrence."""
    wanted = needle.strip("\"'").lower().translate(str.maketrans(T.MARKED, T.PLAIN))
    if len(wanted) < least:
        return records.where(F.lit(False)).withColumn("at", F.lit(0))
    return records.withColumn("at", F.instr(T.fold_search(F.col(text)), wanted)).where("at > 0")


def first_with_total(found: DataFrame, order: list[Column], limit: int = 40) -> DataFrame:
    """TK-05: the first hits and how many there are in all.

    A count and a top-k side by side; no window over all hits.
    """
    total = found.agg(F.count("*").alias("total"))
    top = found.orderBy(*order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).crossJoin(F.broadcast(total))


def exact_year(needle: str) -> int | None:
    return int(needle) if needle.isdigit() and 3 <= len(needle) <= 4 else None
