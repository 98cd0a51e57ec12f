"""Operator 4: exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after each run of ASCII white space has
become one space; the SHA-256 of that form is the digest.  Misra-Gries summaries of
``counters`` entries, one a task, are merged into candidates for frequent digests; the
candidates are counted exactly, and the winners (at least a ``1/counters`` share of
the rows, so at most ``counters`` of them) are broadcast.  Their rows get an answer on
the map side and take no part in the shuffle that groups the other digests.

Defined results: null counts as empty, so all null and empty texts are one group; of
rows with the same id and text each is returned, and as many count in ``group_size``
(all of them are ``kept`` if theirs is the smallest id); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import map_arrow, staged, text_or_empty

COUNTERS = 1024


def digest(text):
    return F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), 256)


def misra_gries(values, counters: int) -> dict:
    """At most ``counters`` values with lower bounds of their counts; every value that
    makes up more than ``1 / (counters + 1)`` of the input is among them."""
    held: dict = {}
    for value, n in values:
        if value in held or len(held) < counters:
            held[value] = held.get(value, 0) + n
            continue
        take = min(n, min(held.values()))
        held = {k: c - take for k, c in held.items() if c > take}
        if n > take:
            held[value] = n - take
    return held


def _summary(batches, counters: int):
    import pyarrow as pa
    import pyarrow.compute as pc

    held: dict = {}
    for batch in batches:
        counts = pc.value_counts(batch.column(0)).to_pylist()
        # the largest first: most others then meet full counters once, not one by one
        held = misra_gries([*held.items(), *sorted(((x["values"], x["counts"]) for x in counts), key=lambda x: -x[1])], counters)
    yield pa.RecordBatch.from_pydict({"digest": list(held), "n": list(held.values())}, schema=pa.schema([("digest", pa.string()), ("n", pa.int64())]))


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """digest, keep_id, group_size of every digest that at least a ``1/counters`` share of the rows has.

    Each task's summary misses less than a ``1/(counters+1)`` share of its own rows of
    any digest, so a digest with such a share of all rows is in the summary of some
    task; what is counted exactly afterwards is the summaries' union without those
    whose count and possible misses stay below the share.
    """
    total = digests.count()
    least = -(-total // counters)
    summaries = map_arrow(digests.select("digest"), lambda it: _summary(it, counters), "digest string, n long")
    # a digest of share 1/counters can lose up to 1/(counters+1) of the rows: any positive sum may win
    merged = summaries.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") + F.lit(total // (counters + 1)) >= least)
    bound = merged.orderBy(F.desc("n"), "digest").limit(4 * counters)
    exact = digests.join(F.broadcast(bound.select("digest")), "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return exact.where(F.col("group_size") >= least)


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, heavy of every row."""
    digests = staged(docs.select("doc_id", digest(text_or_empty()).alias("digest")), "op4-digests")
    winners = F.broadcast(staged(heavy_digests(digests, counters), "op4-winners"))
    heavy = digests.join(winners, "digest")
    others = digests.join(winners, "digest", "left_anti")
    groups = others.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    light = others.join(groups, "digest")
    columns = ("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))
    return heavy.select(*columns, F.lit(True).alias("heavy")).unionByName(light.select(*columns, F.lit(False).alias("heavy")))


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` (unique ids) that stay, with all their columns."""
    return docs.join(exact_groups(docs, counters).where("kept").select("doc_id"), "doc_id", "left_semi")
