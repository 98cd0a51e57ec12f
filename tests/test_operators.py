"""Known answers and brute force for operators that have no SQL."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quorumtext.functions import text as T
from quorumtext.operators import align, assembly, audit, edits, entries, evidence, joins, layout, parsing, search, sequence, sets, spans, vote


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def places(spark, *readings):
    return spark.createDataFrame([(i, list(r)) for i, r in enumerate(readings)], "pos int, readings array<string>")


def test_vote_blank_counts_and_null_does_not(spark):
    got = {r["pos"]: (r["winner"], r["stratum"], r["tier"]) for r in vote.vote(places(spark, ["a", "a", None], ["", "", "b"], ["a", "b", None], ["b", "a", "b"], [None, None, None], ["a", "a", "a"]), 3).collect()}
    assert got == {0: ("a", "2of3", "one-dissent"), 1: ("", "2of3", "one-dissent"), 2: ("a", "tie", "contested"), 3: ("b", "2of3", "one-dissent"), 5: ("a", "3of3", "unanimous")}


def test_vote_against_counter(spark):
    from collections import Counter

    rng = random.Random(1)
    data = [[rng.choice(["a", "b", "c", "", None]) for _ in range(5)] for _ in range(300)]
    got = {r["pos"]: r for r in vote.vote(places(spark, *data), 5).collect()}
    for i, readings in enumerate(data):
        votes = [r for r in readings if r is not None]
        if not votes:
            assert i not in got
            continue
        (winner, top), *rest = Counter(votes).most_common()
        assert (got[i]["winner"], got[i]["top"], got[i]["tie"]) == (winner, top, bool(rest and rest[0][1] == top))


def test_gather_keeps_panel_order(spark):
    rows = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, None)], "p int, k int, r string")
    assert vote.gather(rows, ["p"], "k", "r").first()["readings"] == ["a", None, "c"]


def test_arbitration():
    assert vote.medoid(["casa", "casa", "cosa"]) == "casa"
    assert vote.medoid([None, None]) is None
    assert vote.character_vote(["cbsa", "casa", "casx"]) == "casa"
    assert vote.lexicon_choice(["caja", "casa", "caja"], {"casa": 5}) == "casa"
    assert vote.lexicon_choice(["caja", "casa", "caja"], {}) == "caja"


@pytest.mark.parametrize("a, b, want", [
    ("a b c", "a b c", ["a", "b", "c"]), ("a b c", "a x c", ["a", "x", "c"]), ("a b c d", "a x d", ["a", "x", "", "d"]), ("a b c", "a x y c", ["a", "x y", "c"]),
    ("a b c", "a c", ["a", "", "c"]), ("a b", "x a b", ["a", "b"]), ("a b", "a x b", ["a x", "b"]), ("", "a", []),
])
def test_project(a, b, want):
    assert align.project(a.split(), b.split()) == want


def test_align_lines_shift_and_fallback():
    ref = [{"x0": 0.1, "y0": y, "x1": 0.9, "y1": y + 0.01, "words": [f"w{i}"]} for i, y in enumerate((0.1, 0.2, 0.3))]
    low = [x | {"y0": x["y0"] - 0.02, "y1": x["y1"] - 0.02} for x in ref]
    assert align.align_lines(ref, low) == [(0, "w0"), (1, "w1"), (2, "w2")]
    far = [x | {"y0": x["y0"] + 0.5, "y1": x["y1"] + 0.5} for x in ref]
    assert align.align_lines(ref, far) == [(0, "w0"), (1, "w1"), (2, "w2")]


def quadratic(v, strict=False):
    best, before = [], []
    for i in range(len(v)):
        b, p = 1, -1
        for j in range(i):
            if (v[j] < v[i] or v[j] == v[i] and not strict) and best[j] + 1 > b:
                b, p = best[j] + 1, j
        best.append(b)
        before.append(p)
    if not v:
        return []
    at, out = best.index(max(best)), []
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


@pytest.mark.parametrize("strict", [False, True])
def test_rising_is_the_quadratic_one(strict):
    rng = random.Random(2)
    for _ in range(400):
        v = [rng.randrange(12) for _ in range(rng.randrange(14))]
        assert sequence.rising(v, strict) == quadratic(v, strict)


def test_chronology():
    assert entries.chronology([(1, 1300), (2, 1310), (3, 1800), (4, 1320), (5, 1330)]) == [(1, 1300), (2, 1310), (4, 1320), (5, 1330)]


def test_split_entries():
    got = entries.split_entries("Antes. 3 de mayo — uno. El 31. dos. febrero 30, tres. 1401. junio 2 — cuatro", 1400)
    assert [(e["year"], e["month"], e["day"]) for e in got] == [(1400, None, None), (1400, 5, 3), (1400, 5, 31), (1400, None, 30), (1401, 6, 2)]
    assert entries.split_entries("", 1400) == []
    assert [e["body"] for e in entries.split_entries("en mayo 3, nada", 1400)] == ["en mayo 3, nada"]


def test_lift_is_all_or_nothing(spark):
    rows = spark.createDataFrame([("text — A — B",), ("text — A — Z",), ("text — A — A — B",), ("plain",)], "t string")
    body, sources = entries.lift_sources(F.col("t"), ["A", "B"])
    assert [tuple(r) for r in rows.select(body, sources).collect()] == [("text", ["A", "B"]), ("text — A — Z", []), ("text", ["A", "B"]), ("plain", [])]


def test_as_of_takes_the_last_start(spark):
    marks = spark.createDataFrame([(1, 10, "x"), (1, 20, "y"), (2, 5, "z")], "g int, s int, v string")
    asks = spark.createDataFrame([(1, 9), (1, 10), (1, 25), (3, 5)], "g int, a int")
    assert {(r["g"], r["a"]): r["v"] for r in joins.as_of(asks, marks, ["g"], "a", "s", ["v"]).collect()} == {(1, 9): None, (1, 10): "x", (1, 25): "y", (3, 5): None}


def test_between_is_the_cross_join(spark):
    rng = random.Random(3)
    a = [(rng.randrange(3), i, rng.random()) for i in range(80)]
    b = [(rng.randrange(3), i, y := rng.random(), y + 0.1) for i in range(80)]
    got = joins.between_rows(spark.createDataFrame(a, "p int, i int, m double"), spark.createDataFrame(b, "p int, j int, lo double, hi double"), ["p"], F.col("m"), F.col("lo"), F.col("hi"), 0.05)
    assert sorted((r["i"], r["j"]) for r in got.collect()) == sorted((i, j) for p, i, m in a for q, j, lo, hi in b if p == q and lo <= m <= hi)


def test_layout_folds():
    assert layout.merge_spans([(0, 10), (4, 12), (30, 40)]) == [(0, 12), (30, 40)]
    rows = [{"edge": e, "figure": f} for e, f in ((0.5, "1"), (0.505, "2"), (0.511, "3"), (0.52, "4"), (0.5, ""), (0.5, "7"), (0.5, "7"), (0.5, "7"))]
    assert layout.table_runs(rows) == [[0, 1, 2]]
    assert layout.ledger_rows([{"label": "a", "figure": "1"}, {"label": "", "figure": "2"}, {"label": "b", "figure": ""}]) == [(0, 0), (1, 0)]
    assert layout.accept_boundaries([(0.1, 0.4)] * 9 + [(0.5, 0.9)] * 9, [0.1, 0.5]) == [0.1, 0.5]


def test_parsers():
    got = parsing.parse_name_list(["1300", "Pere", "2 Joan", "1290.", "Mal", "1301", *"ABCDEFG"])
    assert [(x["year"], x["seat"]) for x in got] == [(1300, 1), (1300, 2)] + [(1301, k) for k in range(1, 7)]
    assert parsing.rising_pieces([[1], [5, 2], [2], [3]]) == [1, 2, None, 3]
    assert parsing.numbered_pieces([1, 2, 9, 3, 4, 5]) == [0, 1, 3, 4, 5]
    assert parsing.regroup(["a" * 5, "b" * 5, "c"], 8) == ["aaaaa bbbbb c"]
    assert [w["text"] for w in parsing.rejoin_words([{"text": "Barce", "panel": ["Barcelona"]}, {"text": "lona"}], {})] == ["Barcelona"]
    assert parsing.long_s("cafa", ["caſa", "cafa"], {}) == "caſa" and parsing.long_s("cafa", ["caſa"], {"cafa": 3}) == "cafa"
    assert parsing.sigla_pattern(["A", "AB", "A"]) == r"\b(AB|A)\b"


def test_scalar_functions(spark):
    lit = F.lit
    assert one(spark, T.fold_search(lit("Éa"))) == "ea"
    assert one(spark, T.siglum_key(lit("A A B"))) == ["A", "B"]
    assert one(spark, T.years_in(lit("en 1.3o0 y 1801"))) == [1300]
    assert one(spark, T.as_day(lit("l5."))) == 15
    assert one(spark, T.valid_day(lit(2), lit(30))) is False
    assert one(spark, T.grouped_number(lit(1234567))) == "1.234.567"
    assert one(spark, T.nfc(lit("é "))) == "é"
    assert one(spark, T.reading_form(lit("caſa"))) == "casa"
    assert one(spark, T.same_word(lit("Casá,"), lit("casa"))) is True
    assert one(spark, T.compress(lit(" Él—dijo! "))) == "el dijo"
    assert one(spark, T.case_only_difference(lit("A"), lit("a"))) is True
    assert one(spark, parsing.century_sources(lit("Siglo (A, B) y (C)"))) == "A, B) y (C"
    assert one(spark, parsing.printed_number(lit("— 123 —"))) == "123"
    assert one(spark, sequence.stitch(F.array(lit("a-"), lit("b"), lit("c")))) == "ab c"


def test_edits_orphans_and_sets(spark):
    base = spark.createDataFrame([(1, 1300, 1, 1), (2, 1300, 1, 2)], "id long, year int, month int, day int")
    log = spark.createDataFrame([(1, "drop", 0, 0, 0), (9, "date", 1, 1, 0)], "id long, op string, to_month int, to_day int, cuts int")
    assert sorted((r["id"], r["result"]) for r in edits.apply_edits(base, log).collect()) == [(2, "kept"), (9, "orphan")]
    with pytest.raises(ValueError):
        sets.assert_disjoint(base.select("id"), base.select("id"))
    sets.assert_disjoint(base.select("id").where("id = 1"), base.select("id").where("id = 2"))


def test_search_and_notes(spark):
    docs = spark.createDataFrame([(1, "Él dijo"), (2, "nada")], "id int, t string")
    assert [r["at"] for r in search.hits(docs, "t", '"el"').collect()] == [1]
    assert search.hits(docs, "t", "e").count() == 0 and search.exact_year("1301") == 1301
    lines = spark.createDataFrame([(1, 1, "body"), (1, 2, "(1) first no-"), (1, 3, "te"), (1, 4, "2) second")], "p int, n int, text string")
    assert sorted((r["number"], r["text"]) for r in parsing.gather_notes(lines, ["p"], "n").collect()) == [(1, "first note"), (2, "second")]
    rows = audit.findings(docs, ["id"], audit.text_checks("t"))
    assert {r["check"] for r in rows.where("id = 2").collect()} == {"short", "no_mark_at_end"}


def test_vote_plan_has_no_shuffle(spark):
    plan = vote.vote(places(spark, ["a", "b", "c"]), 3).where("tier = 'contested'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_assembly(spark):
    word = {"winner": "cafa", "tier": "contested", "readings": ["cafa", "casa", None, ""]}
    assert assembly.published(word, "casa") == {"text": "casa", "tier": "adjudicated", "printed": "cafa"}
    assert assembly.published(word, None, "casa") == {"text": "casa", "tier": "contested", "printed": "cafa", "variants": ["cafa"]}
    assert assembly.published(word) == {"text": "cafa", "tier": "contested", "variants": ["casa"]}
    assert assembly.page_text([["uno", "dos-"], [""], ["tres"], ["cuatro"]]) == "uno dostres\ncuatro"
    assert [w["text"] for w in assembly.dedupe([{"text": "casa", "readings": ["casa"]}, {"text": "Casá,", "readings": ["", "Casá,"]}])] == ["casa"]
    wedged = lambda *texts: [r["text"] for r in assembly.unwedge([{"text": t} for t in texts])]
    assert wedged("the ma-", "XII.", "", "yor and more", "end") == ["the ma-", "yor and more", "", "XII.", "end"]
    assert wedged("the one", "12.", "and more") == ["the one", "12.", "and more"]  # no break hyphen
    assert wedged("the ma-", "12", "Agosto") == ["the ma-", "12", "Agosto"]  # nothing goes on
    rows = spark.createDataFrame([(1, 0, 0, "uno", "unanimous", ["uno"], None), (1, 0, 1, "", "contested", ["", "x"], None), (1, 1, 2, "x", "contested", ["x", "y"], "dos")], "p int, line int, pos int, winner string, tier string, readings array<string>, decision string")
    assert tuple(assembly.assemble(rows, "p").first()) == (1, "uno\ndos", 2, 0)


def test_evidence(spark):
    words = spark.createDataFrame([(1, 0, "El", ["El", "El", "El"]), (1, 1, "mzyo", ["mayo", "mayo", "mavo"]), (1, 2, "3", ["3", None, "3"])], "l int, n int, winner string, readings array<string>")
    assert [tuple(r) for r in evidence.month_votes(words.withColumn("winner", F.when(F.col("n") == 1, "zzzz").otherwise(F.col("winner"))), ["l"], "n").collect()] == [(1, 1, 5, 3, 3)]
    rows = spark.createDataFrame([(1, "XIV."), (1, "XIV"), (1, "XIV."), (2, "Mayo"), (2, "mayor"), (2, "mayor")], "l int, r string")
    assert {r["l"]: r["text"] for r in evidence.best_string(rows, ["l"], "r", F.col("r").rlike("^[XIV]+$")).collect()}[1] == "XIV"
    assert {r["l"]: r["text"] for r in evidence.best_reading(rows, ["l"], "r").collect()}[2] == "Mayo"
    assert one(spark, evidence.roman_candidates(F.array(F.lit("XIV. De"), F.lit("XIII De"), F.lit("no")))) == [13, 14]
    assert one(spark, evidence.glued_entry(F.array(F.array(F.lit("1300")), F.array(F.lit("x")), F.array(F.lit("mayo"))))) is True
    assert one(spark, evidence.alike(F.lit("mayo"), F.lit("Mavo"))) is True
    pages = spark.createDataFrame([(1,), (2,)], "p int")
    with pytest.raises(ValueError):
        evidence.refuse_if_shared(pages, pages.where("p = 1"), "p")
    rounds = [spark.createDataFrame([(1, "a")], "id int, t string"), spark.createDataFrame([(1, "b"), (2, "c")], "id int, t string")]
    assert sorted(map(tuple, evidence.join_rounds(rounds).collect())) == [(1, "a"), (2, "c")]


def test_more_scalars(spark):
    assert one(spark, T.small_caps(F.lit("mayo  — 3"))) == "MAYO—3"
    assert one(spark, T.sentences(F.lit("Uno. Dos! tres. Cuatro"))) == ["Uno.", "Dos! tres.", "Cuatro"]
    assert one(spark, T.mark_doubt(F.lit("la cafa, es"), F.create_map(F.lit("cafa"), F.lit("casa")))) == "la cafa, [casa] es"
    assert one(spark, T.page_normalise(F.lit("=== 3 ===\nuno-\ndos\n\n\ntres\u00a0x"))) == "unodos\ntres x"


def test_line_parsers(spark):
    box = "p int, n int, text string, col int, x0 double, x1 double, y0 double, y1 double, centred boolean, banded boolean"
    lines = spark.createDataFrame([
        (1, 1, "SERIES OF NAMES", 0, 0.3, 0.7, 0.10, 0.12, True, False), (1, 2, "full line here", 0, 0.1, 0.9, 0.13, 0.15, False, False), (1, 3, "short", 0, 0.1, 0.4, 0.16, 0.18, False, False),
        (1, 4, "Indented after short", 0, 0.115, 0.9, 0.19, 0.21, False, False), (1, 5, "(1) small", 0, 0.1, 0.9, 0.30, 0.31, False, True), (2, 1, "1300", 0, 0.1, 0.2, 0.1, 0.12, False, False), (2, 2, "1301.", 0, 0.1, 0.2, 0.2, 0.22, False, False),
    ], box)
    opens = {r["n"]: r["opens"] for r in parsing.paragraph_openers(lines.where("p = 1"), ["p"], "n").collect()}
    assert opens == {1: True, 2: True, 3: False, 4: True, 5: False}
    assert round({r["p"]: r["cut"] for r in parsing.small_type_cut(lines, ["p"], "n").collect()}[1], 4) == 0.015
    assert {r["p"]: r["table"] for r in parsing.is_table_leaf(lines, ["p"]).collect()} == {1: False, 2: True}
    assert [tuple(r) for r in parsing.series_starts(lines, "p", "n", "^SERIES").collect()] == [(1, "SERIES OF NAMES")]
    words = spark.createDataFrame([(1, "intro"), (2, "ABBREVIATIONS"), (3, "AB — first book"), (4, "AB — second"), (5, "not one"), (6, "C= other")], "n int, text string")
    assert sorted(map(tuple, parsing.glossary(words, "n", "^ABBREV").collect())) == [("AB", "first book"), ("C", "other")]
    leaves = spark.createDataFrame([(1, "Front"), (2, "CHAPTER"), (3, "x"), (4, "INDEX")], "pdf_page int, text string")
    assert [r["section"] for r in parsing.fill_sections(leaves, {"body": "^CHAPTER", "index": "^INDEX"}).orderBy("pdf_page").collect()] == [None, "body", "body", "index"]
    for anchors in ({"body": "^NONE"}, {"body": "^[A-Z]"}, {"index": "^INDEX", "body": "^CHAPTER"}):
        with pytest.raises(ValueError):
            parsing.fill_sections(leaves, anchors)
    across = spark.createDataFrame([(1, 1, "SIGLO", True), (1, 2, "XIV", True), (2, 1, "(A, B)", True), (2, 2, "text", False), (2, 3, "FAR", True), (5, 1, "XV", True), (5, 2, "body", False)], "p int, n int, text string, across boolean")
    openers = spark.createDataFrame([(1, "XIV"), (5, "XV")], "p int, numeral string")
    assert {r["p"]: r["banner"] for r in parsing.century_openings(across, openers, "p", "n").collect()} == {1: "SIGLO XIV (A, B)", 5: "XV"}
    gaps = parsing.missing_years(spark.createDataFrame([(1300, 3), (1303, 9)], "year int, pdf_page int"))
    assert sorted(map(tuple, gaps.collect())) == [(1301, 3, 9), (1302, 3, 9)]
    left = parsing.furniture(spark.createDataFrame([("12", 0.2, 0.5, 0.52), ("12", 0.8, 0.5, 0.52), ("text", 0.2, 0.01, 0.02), ("text", 0.2, 0.5, 0.52)], "text string, x0 double, y0 double, y1 double"))
    assert [r["furniture"] for r in left.collect()] == [True, False, True, False]


def test_span_takes_the_commonest_spelling(spark):
    places = spark.createDataFrame([(1, 0, 0, "", "contested", ["", "", "", "AB", "ABRIL", "ABRIL"]), (1, 0, 1, "3.", "one-dissent", ["3.", "3.", "3.", "RIL3.", "3.", "3."])], "doc_id int, line int, pos int, winner string, tier string, readings array<string>")
    assert [(r["text"], r["grade"]) for r in spans.span_revote(places, 6, ["doc_id", "line"], "pos").collect()] == [("ABRIL 3.", "contested")]


def test_lexicon_vote_is_the_rule(spark):
    import random

    rng = random.Random(2)
    lexicon = {"casa": 5, "caso": 3, "cosa": 2, "x": 9}
    places = [(i, [rng.choice([None, "casa", "Caso", "cosa", "X", "y", ""]) for _ in range(6)]) for i in range(200)]
    got = {r["i"]: r["winner"] for r in vote.lexicon_vote(spark.createDataFrame(places, "i int, readings array<string>"), spark.createDataFrame(list(lexicon.items()), "word string, n long"), ["i"]).collect()}
    assert got == {i: vote.lexicon_choice(r, lexicon) for i, r in places if any(x is not None for x in r)}
