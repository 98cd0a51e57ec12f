"""Queries on texts: search, numerals, months, entries, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as C, entries as E, search as H, spans, vote as V  # noqa: F401
from . import fixtures as X
from .registry import query, with_

NEEDLE = "the re"
_FOLDED = f"CASE WHEN length(translate(lower(text), '{T.MARKED}', '{T.PLAIN}')) = length(text) THEN translate(lower(text), '{T.MARKED}', '{T.PLAIN}') ELSE text END"
_HITS = f"h AS (SELECT doc_id, text, instr({_FOLDED}, '{NEEDLE}') AS spot FROM documents WHERE instr({_FOLDED}, '{NEEDLE}') > 0)"


@query(f"""WITH {_HITS} SELECT rank, doc_id AS id, spot AS "offset", total FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rank, count(*) OVER () AS total FROM h) WHERE rank <= 40""")
def first40_total(spark, sf_dir):
    """TK-05, D11"""
    found = H.hits(X.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", NEEDLE)
    return H.first_with_total(found, [F.col("doc_id")]).select(F.col("rank").cast("long").alias("rank"), F.col("doc_id").alias("id"), F.col("at").cast("long").alias("offset"), "total")


@query(f"""WITH {_HITS} SELECT doc_id AS id, CASE WHEN spot - 110 > 1 THEN '…' ELSE '' END || substr(text, greatest(spot - 110, 1), least(spot + {len(NEEDLE)} - 1 + 110, length(text)) - greatest(spot - 110, 1) + 1) || CASE WHEN spot + {len(NEEDLE)} - 1 + 110 < length(text) THEN '…' ELSE '' END AS snippet FROM h""")
def snippets(spark, sf_dir):
    """FN-23, FN-03"""
    found = H.hits(X.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", NEEDLE)
    return found.select(F.col("doc_id").alias("id"), T.snippet(F.col("text"), F.col("at"), F.lit(len(NEEDLE))).alias("snippet"))


ROMANS = ("I", "IV", "IX", "XIV", "XL", "XC", "CD", "CM", "MDCCCLXXXI", "MCMXCIV", "iii", "MMXXIV")


@query("""WITH r(numeral) AS (VALUES """ + ", ".join(f"('{x}')" for x in ROMANS) + """),
v AS (SELECT numeral, [CASE c WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 WHEN 'M' THEN 1000 ELSE 0 END for c in string_split(upper(numeral), '')] AS v FROM r)
SELECT numeral, list_sum([CASE WHEN x < coalesce(v[i + 1], 0) THEN -x ELSE x END for x, i in v])::INTEGER AS value FROM v""")
def roman(spark, sf_dir):
    """FN-14"""
    return spark.createDataFrame([(x,) for x in ROMANS], "numeral string").select("numeral", T.from_roman(F.col("numeral")).alias("value"))


TOKENS = ("Mayo", "mavo", "dicíembre", "Enero.", "junlo", "xulio", "febrcro", "casa", "abrl", "octubre,", "setiembre", "agost", "marzo")


@query("WITH t(token) AS (VALUES " + ", ".join(f"('{x}')" for x in TOKENS) + "), m(n, name) AS (VALUES " + ", ".join(f"({i}, '{x}')" for i, x in enumerate(T.MONTHS, 1)) + """)
SELECT token, (SELECT min(n) FROM m WHERE contains(lower(token), name) OR (length(token) = length(name) AND list_sum([CASE WHEN substr(lower(token), i, 1) <> substr(name, i, 1) THEN 1 ELSE 0 END for i in range(1, length(name) + 1)]) <= 2) OR levenshtein(lower(token), name) <= 1)::INTEGER AS month FROM t""")
def month_near(spark, sf_dir):
    """FN-10"""
    return spark.createDataFrame([(x,) for x in TOKENS], "token string").select("token", T.month_of(F.col("token")).alias("month"))


def _tails(spark, sf_dir):
    o = X.f4(spark, sf_dir)
    return o.select("id", F.concat(F.lit("Entry "), F.col("id"), F.lit(" — "), F.array_join("sources", " — "), F.when(F.col("id") % 5 == 0, " — Q").otherwise(""), F.when(F.col("id") % 7 == 0, F.concat(F.lit(" — "), F.element_at("sources", -1))).otherwise("")).alias("text"))


@query(with_(X.F4, """SELECT id, CASE WHEN id % 5 = 0 THEN 'Entry ' || id || ' — ' || array_to_string(sources, ' — ') || ' — Q' || CASE WHEN id % 7 = 0 THEN ' — ' || sources[-1] ELSE '' END ELSE 'Entry ' || id END AS body,
 CASE WHEN id % 5 = 0 THEN '' ELSE array_to_string(sources, ',') END AS sources FROM f4"""))
def sigla_lift(spark, sf_dir):
    """D6, FN-17: initials at the end of an entry become its sources, all or none."""
    body, sources = E.lift_sources(F.col("text"), ["F", "O", "P", *[f"P{k}" for k in range(1, 6)]])
    return _tails(spark, sf_dir).select("id", body.alias("body"), F.array_join(sources, ",").alias("sources"))


@query()
def entry_split(spark, sf_dir):
    """D6: three orders' dates written out in one text and cut again (known answers are tested)."""
    o = X.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d"))
    name = F.element_at(F.array(*map(F.lit, T.MONTHS)), F.col("m"))
    text = F.concat(F.lit("Before all. "), name, F.lit(" "), F.col("d"), F.lit(" — first thing. El "), F.col("d") % 28 + 1, F.lit(". second thing. 3 de "), name, F.lit(", third."))
    return E.entries_of(o.select(F.col("o_orderkey").alias("id"), F.lit(1500).alias("year"), text.alias("text")), "id")


_CHECKS = {
    "empty": "trim(text) = ''", "short": "length(text) < 100", "digit_in_word": "regexp_matches(text, '[A-Za-z][0-9]+[A-Za-z]')", "double_space": "contains(text, '  ')",
    "unbalanced": "length(replace(text, '(', '')) <> length(replace(text, ')', ''))", "upper_run": "regexp_matches(text, '[A-Z]{6}')", "space_before_mark": "regexp_matches(text, ' [,;:]')",
    "symbols": "regexp_matches(text, '[#$%&*]{3}')", "hyphen_at_end": "regexp_matches(text, '-\\n')", "no_mark_at_end": "NOT regexp_matches(text, '[.!?]$')",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER (WHERE {c}) AS n, round(count(*) FILTER (WHERE {c}) / count(*), 6) AS rate FROM documents" for k, c in _CHECKS.items()))
def tier_audit(spark, sf_dir):
    """D12: how often each check fires."""
    return C.fire_rates(X.table(spark, sf_dir, "documents").select("text"), C.text_checks("text"))


_WEIGHTS = {"short": 1.0, "digit_in_word": 2.0, "upper_run": 0.5, "symbols": 3.0, "unbalanced": 1.0}


@query("SELECT doc_id, round(sum(w), 6) AS score, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT doc_id, {_WEIGHTS.get(k, 0.0)}::DOUBLE AS w FROM documents WHERE {c}" for k, c in _CHECKS.items()) + ") GROUP BY doc_id")
def audit_scores(spark, sf_dir):
    """AG-24"""
    return C.scores(C.findings(X.table(spark, sf_dir, "documents"), ["doc_id"], C.text_checks("text")), ["doc_id"], _WEIGHTS)


@query(r"""SELECT doc_id, lower(regexp_replace(regexp_replace(text, '[ \t\n\r\f]+', '', 'g'), '[‐‑‒–—―-]', '—', 'g')) AS fold, regexp_replace(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug,
 regexp_extract(text, '([A-Z][a-z]+)', 1) AS genre, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS html, substr(sha256(text), 1, 8) AS sha FROM documents""")
def text_functions(spark, sf_dir):
    """FN-05, FN-20, FN-22, FN-24"""
    return X.table(spark, sf_dir, "documents").select("doc_id", T.fold_span(F.col("text")).alias("fold"), T.slug(F.col("source")).alias("slug"), T.genre(F.col("text")).alias("genre"), T.escape_html(F.col("text")).alias("html"), F.substring(F.sha2("text", 256), 1, 8).alias("sha"))


@query("SELECT o_orderkey AS id, ((year(o_orderdate) - 1) // 100 + 1)::INTEGER AS century, (year(o_orderdate) // 10 * 10)::INTEGER AS decade, printf('%d:%.5f,%.5f', o_orderkey, o_totalprice / 7, o_totalprice / 11) AS key FROM orders")
def key_functions(spark, sf_dir):
    """FN-26, FN-30"""
    y = F.year("o_orderdate")
    return X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), T.century(y).alias("century"), T.decade(y).alias("decade"), T.box_key(F.col("o_orderkey"), F.col("o_totalprice") / 7, F.col("o_totalprice") / 11).alias("key"))


@query(with_(X.F1, """SELECT doc_id, line, year, n AS votes FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY n DESC, year) AS r FROM (SELECT doc_id, line, year, count(*) AS n FROM
 (SELECT DISTINCT doc_id, line, pos, k, 1300 + (doc_id + line * 7 + CASE WHEN k IN (1, 3) THEN 1 ELSE 0 END) % 400 AS year FROM f1 WHERE reading IS NOT NULL AND pos % 10 = 0) GROUP BY ALL)) WHERE r = 1 AND n >= 3"""))
def heading_votes(spark, sf_dir):
    """EV-01: years stated by the readings of a line's first place; three at least must agree."""
    rows = X.f1(spark, sf_dir).where("pos % 10 = 0").select("doc_id", "line", "readings")
    year = 1300 + (F.col("doc_id") + F.col("line") * 7) % 400
    after = 1300 + (F.col("doc_id") + F.col("line") * 7 + 1) % 400
    said = lambda k: F.concat(F.lit("Any "), F.when(k.isin(1, 3), after).otherwise(year), F.lit("."))
    told = F.filter(F.transform("readings", lambda r, k: F.when(r.isNotNull(), said(k))), lambda t: t.isNotNull())
    return E.evidence_year_in_place(V.bind(rows, told=told), ["doc_id", "line"], "told")
