"""D4: a second vote over runs of contested places, as whole strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as T
from .sequence import islands
from .vote import bind


def span_revote(voted: DataFrame, panel: int, by: list[str], order: str) -> DataFrame:
    """(by, run, text, grade) of runs in which a place was won by the empty reading and another string wins the vote over the run.

    Each engine's readings over the run are joined with spaces and compared folded.  The best
    non-empty fold, by votes and then length, is taken if it has two votes, more than
    the blanks, is longer than what stands, and contains every word that stands.
    """
    runs = islands(voted, by, order, F.col("tier") != "unanimous")
    own = F.transform(F.col("readings"), lambda r: F.coalesce(r, F.lit("")))
    # only runs with a hole go on; the window shares the runs' own partitioning
    runs = runs.withColumn("_hole", F.max(F.col("winner") == "").over(Window.partitionBy(*by, "run"))).where("_hole")
    rows = runs.select(*by, "run", order, "winner", F.posexplode(own).alias("k", "reading"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(c).alias("v")))), lambda x: x["v"])
    spoken = rows.groupBy(*by, "run", "k").agg(F.array_join(F.filter(ordered("reading"), lambda x: x != ""), " ").alias("raw"), F.filter(ordered("winner"), lambda x: x != "").alias("standing"))
    spoken = spoken.withColumn("fold", T.fold_span(F.col("raw")))
    # the commonest spelling of a fold; equals go by panel order, of spellings as of folds
    spelt = spoken.groupBy(*by, "run", "fold", "raw").agg(F.count("*").alias("m"), F.min("k").alias("k"), F.first("standing").alias("standing"))
    folds = spelt.groupBy(*by, "run", "fold").agg(F.sum("m").alias("n"), F.max_by("raw", F.struct("m", -F.col("k"))).alias("text"), (-F.min("k")).alias("early"), F.first("standing").alias("standing"))
    full = folds.groupBy(*by, "run").agg(F.sum(F.when(F.col("fold") == "", F.col("n")).otherwise(0)).alias("blank"), F.max(F.when(F.col("fold") != "", F.struct("n", F.length("fold").alias("len"), "early", "fold", "text", "standing"))).alias("b"))
    standing = T.fold_span(F.array_join("b.standing", ""))
    good = (F.col("b.n") >= 2) & (F.col("b.n") > F.col("blank")) & (F.col("b.len") > F.length(standing)) & F.forall(F.col("b.standing"), lambda w: F.col("b.fold").contains(T.fold_span(w)))
    grade = F.when(F.col("b.n") >= panel - 1, "one-dissent").when(F.col("b.n") == panel - 2, "two-dissent").otherwise("contested")
    return full.where(F.col("b").isNotNull() & good).select(*by, "run", F.col("b.text").alias("text"), grade.alias("grade"))


def _spoken(voted: DataFrame, panel: int, by: list[str], order: str) -> DataFrame:
    """(by, run, raws, standing) of runs with a hole: what each engine reads over the run, and the words that stand."""
    kinds = {c: voted.schema[c].dataType.simpleString() for c in by}
    own = [F.coalesce(F.get("readings", F.lit(k)), F.lit("")).alias(f"_r{k}") for k in range(panel)]
    rows = voted.where(F.col("tier") != "unanimous").select(*by, order, "winner", *own)

    def work(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        from .neighbours import joined, starts, whole_groups

        full = lambda c: pc.not_equal(c, "").to_numpy(zero_copy_only=False)
        for batch in whole_groups(batches, by):
            first, at = starts(batch, by), batch.column(order).to_numpy(zero_copy_only=False)
            new = np.append(True, np.diff(at) != 1)
            new[first] = True
            begin = np.flatnonzero(new)
            run = np.arange(len(begin)) - np.searchsorted(begin, first[np.searchsorted(first, begin, side="right") - 1])
            holes = np.flatnonzero(np.logical_or.reduceat(~full(batch.column("winner")), begin))
            if not len(holes):
                continue
            raws = [joined(c, begin, full(c)).take(pa.array(holes)) for c in (batch.column(f"_r{k}") for k in range(panel))]
            keep = full(batch.column("winner"))
            ends = np.append(0, np.cumsum(keep))[np.append(begin, len(at))].astype(np.int32)
            standing = pa.ListArray.from_arrays(pa.array(ends), batch.column("winner").filter(pa.array(keep))).take(pa.array(holes))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(begin[holes])) for c in by], pa.array(run[holes], pa.int64()), *raws, standing], [*by, "run", *[f"_s{k}" for k in range(panel)], "standing"])

    shape = ", ".join(f"{c} {k}" for c, k in kinds.items())
    made = rows.mapInArrow(work, f"{shape}, run long, " + ", ".join(f"_s{k} string" for k in range(panel)) + ", standing array<string>")
    return made.select(*by, "run", F.array(*[f"_s{k}" for k in range(panel)]).alias("raws"), "standing")


def span_revote_in_order(voted: DataFrame, panel: int, by: list[str], order: str) -> DataFrame:
    """``span_revote`` of places that stand in order, group by group: a run is a row, and its engines' strings are counted in it."""
    runs = _spoken(voted, panel, by, order)
    runs = bind(runs, said=F.transform("raws", lambda r, k: F.struct(k.alias("k"), r.alias("raw"), T.fold_span(r).alias("fold"))))
    count = lambda name, value: F.size(F.filter("said", lambda y: y[name] == value)).cast("long")
    early = lambda fold: F.array_max(F.transform(F.filter("said", lambda y: y["fold"] == fold), lambda y: -y["k"]))
    folds = F.transform(F.filter("said", lambda x: x["fold"] != ""), lambda x: F.struct(count("fold", x["fold"]).alias("n"), F.length(x["fold"]).alias("len"), early(x["fold"]).alias("early"), x["fold"].alias("fold")))
    best = bind(runs, b=F.array_max(folds), blank=count("fold", F.lit("")), own=T.fold_span(F.array_join("standing", "")))
    good = (F.col("b.n") >= 2) & (F.col("b.n") > F.col("blank")) & (F.col("b.len") > F.length("own")) & F.forall("standing", lambda w: F.col("b.fold").contains(T.fold_span(w)))
    # the commonest spelling of the fold; equals go by panel order
    spelt = F.transform(F.filter("said", lambda x: x["fold"] == F.col("b.fold")), lambda x: F.struct(count("raw", x["raw"]).alias("m"), (-x["k"]).alias("early"), x["raw"].alias("raw")))
    grade = F.when(F.col("b.n") >= panel - 1, "one-dissent").when(F.col("b.n") == panel - 2, "two-dissent").otherwise("contested")
    return best.where(F.col("b").isNotNull() & good).select(*by, "run", F.array_max(spelt)["raw"].alias("text"), grade.alias("grade"))
