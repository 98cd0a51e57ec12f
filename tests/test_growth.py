"""What keeps queries within their limits on larger tables: steps inside a document need no exchange, and results stay the same."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quorumtext.operators import align, assembly, parsing, vote
from quorumtext.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pairs_of(rows):
    return sorted(map(tuple, rows))


def places(spark, n=400, seed=3):
    """Documents of several lines with absent engines, blanks and repeated words."""
    draw = random.Random(seed)
    rows = []
    for doc in range(n // 20):
        for pos in range(draw.randrange(1, 41)):
            word = draw.choice(["alpha", "beta", "Beta", "gam-", "de"])
            readings = [draw.choice([word, word, word, "", None, word + "."]) for _ in range(6)]
            rows.append((doc, pos // 10, pos, word, "contested" if pos % 3 else "unanimous", readings, draw.choice([None, None, "said"])))
    return spark.createDataFrame(rows, "doc_id long, line int, pos int, winner string, tier string, readings array<string>, decision string").coalesce(1)


def test_line_manifest_compares_lines_where_they_are_made(spark, sf_dir):
    assert "hashpartitioning" not in plan(catalog.queries()["line_manifest"](spark, sf_dir))
    p = places(spark)
    rows = p.select("doc_id", "line", "pos", F.posexplode("readings").alias("k", "r")).where("r IS NOT NULL")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "r"))), lambda x: x["r"]), " ")
    want = parsing.disputed_lines(rows.groupBy("doc_id", "line", "k").agg(text.alias("text")), ["doc_id", "line"])
    assert pairs_of(parsing.disputed_in_order(p, ["doc_id", "line"], 6).collect()) == pairs_of(want.collect())


def test_choices_of_a_place_are_its_own_rows(spark, sf_dir):
    assert "hashpartitioning" not in plan(catalog.queries()["choices"](spark, sf_dir))
    p = places(spark)
    rows = p.select("doc_id", "pos", F.posexplode("readings").alias("k", "r"))
    assert pairs_of(vote.choices_of(p, ["doc_id", "pos"], 6).collect()) == pairs_of(vote.choices(rows, ["doc_id", "pos"], "k", "r").collect())


def test_alignment_of_all_pairs_is_difflibs(spark, sf_dir):
    import numpy as np

    draw, pairs = random.Random(5), []
    for _ in range(400):
        a = [draw.randrange(draw.choice([1, 3, 20])) for _ in range(draw.randrange(1, 40))]
        b = [x for x in a for _ in range(draw.choice([0, 1, 1, 1, 2]))] or [7]
        pairs.append((a, [draw.choice([x, x, x, 99]) for x in b]))
    begin, end, base = align.project_all([(np.array(a), np.array(b)) for a, b in pairs])
    for p, (a, b) in enumerate(pairs):
        assert [" ".join(map(str, b[begin[s] : end[s]])) for s in range(base[p], base[p + 1])] == align.project([*map(str, a)], [*map(str, b)])
    assert "hashpartitioning" not in plan(catalog.queries()["align_project"](spark, sf_dir))
    p = places(spark).select("doc_id", "pos", F.transform("readings", lambda r: F.nullif(r, F.lit(""))).alias("readings"))
    rows = p.select("doc_id", "pos", F.posexplode("readings").alias("engine", "r")).where("r IS NOT NULL")
    want = align.align_engines(rows, "doc_id", "engine", "pos", "r", 0).collect()
    assert pairs_of(align.align_in_order(p, ["doc_id"], 6, 0).collect()) == pairs_of(want)


def test_pages_are_assembled_where_their_words_are_made(spark, sf_dir):
    assert "hashpartitioning" not in plan(catalog.queries()["assembled_pages"](spark, sf_dir))
    p = places(spark, 2000)
    assert pairs_of(assembly.assemble_in_order(p, "doc_id", 6).collect()) == pairs_of(assembly.assemble(p, "doc_id").collect())


def test_groups_go_on_in_the_next_batch():
    import pyarrow as pa

    from quorumtext.operators.neighbours import whole_groups

    keys = [1, 1, 2, 2, 2, None, None, 3]
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[k : k + size], pa.int64())], ["k"]) for k in range(0, len(keys), size)]
        made = [b.column("k").to_pylist() for b in whole_groups(batches, ["k"])]
        assert sum(made, []) == keys and all(a[-1] != b[0] for a, b in zip(made, made[1:]))


def test_editions_are_joined_on_their_pages(spark, sf_dir):
    """One row a page goes through the exchange, not one a place."""
    shown = plan(catalog.queries()["box_join_guarded"](spark, sf_dir))
    assert all("doc_id" in line and "pos" not in line.split("]")[0] for line in shown.splitlines() if "Join [" in line)


def test_asof_reads_columns_over_a_million(spark, tmp_path):
    import duckdb

    spark.createDataFrame([(2_000_007, 3, 5, 1), (1_000_207, 3, 6, 1), (7, 9, 2, 2)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, 4), (207, 9), (1_000_007, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(catalog.oracle_sql()["asof_leaf"]).fetchall()
    assert sorted(map(tuple, catalog.queries()["asof_leaf"](spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


def test_sample_ranks_few_rows(spark):
    """A stratum is not sorted whole: ranks are given behind a join with the ranges that the sample reaches."""
    from pyspark.sql import Window

    from quorumtext.operators import sampling

    rows = spark.range(30_000).select("id", F.when(F.col("id") < 7, "rare").when(F.col("id") % 3 == 0, "third").otherwise("rest").alias("s"))
    got = sampling.least_by_lot(rows, "s", F.when(F.col("s") == "third", 5).otherwise(9), 9, ["id"], 7)
    rank = F.row_number().over(Window.partitionBy("s").orderBy(sampling.lot(7, ["id"]), "id"))
    want = rows.withColumn("r", rank).where("r <= CASE s WHEN 'third' THEN 5 ELSE 9 END").drop("r")
    assert pairs_of(got.collect()) == pairs_of(want.collect())
    near = sampling.within(rows, sampling.reach(rows.where("s <> 'rare'"), "s", 9, ["id"], 7), ["id"], 7)
    assert 18 <= near.count() < 1_000
    assert "BroadcastHashJoin" in plan(got)


def test_json_of_a_page_is_made_of_its_row(spark, sf_dir):
    assert "hashpartitioning" not in plan(catalog.queries()["nested_json_load"](spark, sf_dir))


def test_panels_are_one_scan(spark, sf_dir):
    df = catalog.queries()["panel_ablation"](spark, sf_dir)
    assert plan(df).count("FileScan") == 1
    p = places(spark)
    panels = {"all": (0, 1, 2, 3, 4, 5), "two": (1, 4)}
    full = vote.complete(p, list(range(6)))
    got = {r["panel"]: tuple(r)[1:] for r in vote.tally_panels(full, panels, 6).collect()}
    for name, ks in panels.items():
        v = vote.vote(vote.sub_panel(full.select("readings"), list(ks)), len(ks)).collect()
        assert got[name] == (len(v), sum(r["tie"] for r in v), sum(r["tier"] == "unanimous" for r in v))


def test_line_shift_is_the_plain_search():
    draw = random.Random(4)
    for _ in range(20):
        box = lambda: (x := draw.random() * 0.7, y := draw.randrange(0, 300) / 1000, x + 0.28, y + 0.012)
        a, b = [box() for _ in range(draw.randrange(1, 15))], [box() for _ in range(draw.randrange(0, 15))]
        best = (0.0, -1)
        for k in range(-30, 31):
            s = k * 0.001
            n = sum(any(y[1] + s <= (x[1] + x[3]) / 2 <= y[3] + s and x[0] < y[2] and x[2] > y[0] for y in b) for x in a)
            best = (s, n) if n > best[1] else best
        assert align.best_shift(a, b) == best


def test_variants_compare_a_words_answers(spark, sf_dir):
    assert "SortAggregate" not in plan(catalog.queries()["variants_if_unique"](spark, sf_dir)).split("Exchange")[-1]


def test_islands_where_places_are_made(spark, sf_dir):
    from quorumtext.operators import sequence

    assert "Window" not in plan(catalog.queries()["spans_islands"](spark, sf_dir))
    p = places(spark).where("tier <> 'unanimous'")
    want = sequence.islands(p, ["doc_id", "line"], "pos", F.lit(True)).groupBy("doc_id", "line", "run").agg(F.min("pos"), F.max("pos"))
    assert pairs_of(sequence.islands_in_order(p, ["doc_id", "line"], "pos").collect()) == pairs_of(want.collect())


def test_accuracy_is_one_scan_of_one_row_a_place(spark, sf_dir):
    shown = plan(catalog.queries()["weighted_accuracy"](spark, sf_dir))
    assert shown.count("FileScan") == 1 and "posexplode(readings" not in shown


def test_years_of_a_line_need_no_exchange(spark, sf_dir):
    from quorumtext.operators import entries

    assert "hashpartitioning" not in plan(catalog.queries()["heading_votes"](spark, sf_dir))
    told = [(1, ["Any 1300.", "1300, 1301", "Any 1300. 1300", "none"]), (2, ["1400", "1401"]), (3, ["1500 1600", "1600 1500", "1500 1600"]), (4, [])]
    lines = spark.createDataFrame(told, "at int, told array<string>")
    want = entries.evidence_year(lines.select("at", F.explode("told").alias("r")), "at", "r")
    assert pairs_of(entries.evidence_year_in_place(lines, ["at"], "told").collect()) == pairs_of(want.select("at", "year", "votes").collect())


def test_medoid_compares_a_pair_once(monkeypatch):
    calls = []
    monkeypatch.setattr("difflib.SequenceMatcher.ratio", lambda self: calls.append(1) or 0.5)
    for _ in range(3):
        vote.medoid(["one more", "one mere", "one more", "one more", "one mere", "one mure"])
    assert len(calls) <= 6


def test_spans_are_revoted_in_their_own_row(spark, sf_dir):
    from quorumtext.operators import spans

    assert "hashpartitioning" not in plan(catalog.queries()["span_revote"](spark, sf_dir))
    draw, rows = random.Random(8), []
    for line in range(150):
        for pos in range(8):
            readings = [draw.choice(["", "", None, "ab", "Ab", "a-b", "c"]) for _ in range(6)]
            rows.append((line // 10, line, pos, draw.choice(["", "", "ab", "c"]), draw.choice(["unanimous", "contested", "contested"]), readings))
    p = spark.createDataFrame(rows, "doc_id long, line int, pos int, winner string, tier string, readings array<string>").coalesce(1)
    want = spans.span_revote(p, 6, ["doc_id", "line"], "pos").collect()
    assert want and pairs_of(spans.span_revote_in_order(p, 6, ["doc_id", "line"], "pos").collect()) == pairs_of(want)
