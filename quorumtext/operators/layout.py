"""Columns, reading order and tables of positioned lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .sequence import over, run_id


def edge_clusters(lines: DataFrame, by: list[str], edge: str, tolerance: float, least: int) -> DataFrame:
    """WN-06: sorted left edges fall into clusters where neighbours are no further apart than ``tolerance``.

    Edges repeat (they are read to a few places), so equal ones are counted first and the window runs
    over distinct edges.
    """
    edges = lines.groupBy(*by, edge).agg(F.count("*").alias("_n"))
    far = F.round(F.col(edge) - F.lag(edge).over(over(by, [edge])), 9) > tolerance
    grouped = edges.withColumn("_far", F.coalesce(far, F.lit(False))).withColumn("cluster", run_id(F.col("_far"), by, [edge]))
    return grouped.groupBy(*by, "cluster").agg(F.min(edge).alias("left"), F.sum("_n").alias("n")).where(F.col("n") >= least)


def column_of(x0: Column, bounds: Column, slack: float = 0.021) -> Column:
    """D8: the last boundary not right of a line's edge."""
    return F.size(F.filter(bounds, lambda b: b <= x0 + slack)) - 1


def reading_order(lines: DataFrame, by: list[str], column: str = "col", single: bool = False) -> DataFrame:
    """TK-07: adds ``seq`` in each group: down the columns, or down the page if there is one."""
    keys = ["y0", "x0", "id"] if single else [column, "y0", "x0", "id"]
    return lines.withColumn("seq", F.row_number().over(Window.partitionBy(*by).orderBy(*keys)))


def accept_boundaries(lines: list[tuple[float, float]], lefts: list[float], most: float = 0.10, narrow: float = 0.5, share: float = 0.6) -> list[float]:
    """D8: of the clusters' left edges those that few lines cross.  Wide lines are set aside if narrow ones are the rule."""
    kept: list[float] = []
    for left in sorted(lefts):
        before = [(a, b) for a, b in lines if a < left - 1e-9]
        thin = [(a, b) for a, b in before if b - a < narrow]
        body = thin if before and len(thin) >= share * len(before) else before
        if not body or sum(b > left for _, b in body) <= most * len(body):
            kept.append(left)
    return kept


def find_columns(lines: DataFrame, by: str, tolerance: float = 0.012, least: int = 8) -> DataFrame:
    """(by, bounds): accepted column boundaries of each page; pages are the groups."""
    kind = lines.schema[by].dataType.simpleString()

    def work(pdf):
        import pandas as pd

        edges = sorted(pdf["x0"])
        clusters, run = [], []
        for x in edges:
            if run and x - run[-1] > tolerance:
                clusters.append(run)
                run = []
            run.append(x)
        clusters = [c[0] for c in [*clusters, run] if len(c) >= least]
        return pd.DataFrame({by: [pdf[by].iloc[0]], "bounds": [accept_boundaries(list(zip(pdf["x0"], pdf["x1"])), clusters)]})

    return lines.select(by, "x0", "x1").groupBy(by).applyInPandas(work, f"{by} {kind}, bounds array<double>")


def quantised_rows(lines: DataFrame, by: list[str]) -> DataFrame:
    """TK-08: printed lines as steps of 0.7 of the page's median height (halves to even)."""
    height = lines.groupBy(*by).agg(F.median(F.col("y1") - F.col("y0")).alias("_h"))
    return lines.join(height, by).withColumn("row", F.bround(F.col("y0") / (F.col("_h") * 0.7), 0).cast("int")).drop("_h")


def merge_spans(spans: list[tuple[float, float]], share: float = 0.5) -> list[tuple[float, float]]:
    """PR-10: spans that overlap the merged one before by more than a share of the narrower grow it."""
    out: list[tuple[float, float]] = []
    for a, b in sorted(spans):
        if out:
            c, d = out[-1]
            if min(b, d) - max(a, c) > share * min(b - a, d - c):
                out[-1] = (min(a, c), max(b, d))
                continue
        out.append((a, b))
    return out


def table_runs(rows: list[dict], slack: float = 0.012, least: int = 3) -> list[list[int]]:
    """WN-07: runs of rows whose edge stays within ``slack`` of the run's first, of three rows and two different figures at least."""
    out, run = [], []

    def close():
        if len(run) >= least and len({rows[i]["figure"] for i in run}) > 1:
            out.append(list(run))
        run.clear()

    for i, row in enumerate(rows):
        if not row["figure"]:
            close()
            continue
        if run and abs(row["edge"] - rows[run[0]]["edge"]) > slack:
            close()
        run.append(i)
    close()
    return out


def ledger_rows(rows: list[dict], reach: int = 6) -> list[tuple[int, int]]:
    """WN-08: (row, label row): a figure without a label takes the last label, up to ``reach`` rows back."""
    out, label = [], None
    for i, row in enumerate(rows):
        if row["label"]:
            label = i
        if row["figure"]:
            if row["label"]:
                out.append((i, i))
            elif label is not None and i - label <= reach:
                out.append((i, label))
    return out


def find_tables(rows: DataFrame, by: str) -> DataFrame:
    """(by, table_id, seq, id) of rows (id, edge, figure) in table runs; pages are the groups."""
    kind = rows.schema[by].dataType.simpleString()

    def work(pdf):
        import pandas as pd

        pdf = pdf.sort_values("id")
        items = pdf.to_dict("records")
        out = [(pdf[by].iloc[0], t, n, items[i]["id"]) for t, run in enumerate(table_runs(items)) for n, i in enumerate(run)]
        return pd.DataFrame(out, columns=[by, "table_id", "seq", "id"])

    return rows.groupBy(by).applyInPandas(work, f"{by} {kind}, table_id int, seq int, id long")
