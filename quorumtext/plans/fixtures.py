"""Derived inputs: the same relations as DataFrames and as DuckDB SQL, in integer arithmetic only.

Each ``fN`` takes (spark, sf_dir); ``FN`` is a common table expression of the same name and columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..operators.vote import bind

ENGINES = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Small inputs come as fewer files than there are cores; large ones pass as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, tok: the words of every document."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.posexplode(T.tokens(F.col("text"))).alias("pos", "tok"))


def reading(k: int, tok: Column) -> Column:
    """What an engine reads where the truth is ``tok``."""
    h = (F.col("doc_id") * 31 + F.col("pos") * 17 + k * 7919) % 397
    g = (F.col("doc_id") * 13 + F.col("pos") * 29) % 101
    absent = F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string")) if k == 5 else None
    shared = F.concat(F.lit("x"), tok)
    steps = absent
    if k in (1, 3, 5):
        steps = steps.when(g < 5, shared) if steps is not None else F.when(g < 5, shared)
    steps = steps.when(h < 6, "") if steps is not None else F.when(h < 6, "")
    return steps.when(h < 10, F.lower(tok)).when(h < 16, T.strip_accents(tok)).when(h < 24, F.concat(tok, F.lit("."))).otherwise(tok)


def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, line, truth, readings: what six engines read at each place (array in panel order; null: absent)."""
    w = words(spark, sf_dir)
    return w.select("doc_id", "pos", F.expr("pos div 10").cast("int").alias("line"), F.col("tok").alias("truth"), F.array(*[reading(k, F.col("tok")) for k in range(ENGINES)]).alias("readings"))


WORDS = r"""words AS (SELECT doc_id, unnest(range(len(t)))::INTEGER AS pos, unnest(t) AS tok FROM (
  SELECT doc_id, list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS t FROM documents))"""

F1 = (
    WORDS
    + f""",
f1 AS (SELECT doc_id, pos, (pos // 10)::INTEGER AS line, k::INTEGER AS k, tok AS truth, CASE
  WHEN doc_id % 13 = 0 AND k = 5 THEN NULL
  WHEN (doc_id * 13 + pos * 29) % 101 < 5 AND k IN (1, 3, 5) THEN 'x' || tok
  WHEN h < 6 THEN '' WHEN h < 10 THEN lower(tok) WHEN h < 16 THEN translate(tok, '{T.MARKED}', '{T.PLAIN}')
  WHEN h < 24 THEN tok || '.' ELSE tok END AS reading
  FROM (SELECT *, (doc_id * 31 + pos * 17 + k * 7919) % 397 AS h FROM words, range(6) r(k)))"""
)

#: F1 with words that half of the engines read in two places and others not at all.
F1_HOLES = F1.replace(
    "WHEN doc_id % 13 = 0 AND k = 5 THEN NULL",
    "WHEN pos % 19 = 0 THEN CASE WHEN k < 3 THEN '' ELSE substr(tok, 1, 3) END WHEN pos % 19 = 1 THEN CASE WHEN k < 2 THEN '' WHEN k = 2 THEN tok ELSE substr(tok, 3) END WHEN doc_id % 13 = 0 AND k = 5 THEN NULL",
)


def f1_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank, tok = F.lit(""), F.col("truth")
    first, second = F.substring(tok, 1, 3), F.expr("substr(truth, 3)")
    readings = F.when(F.col("pos") % 19 == 0, F.array(blank, blank, blank, first, first, first)).when(F.col("pos") % 19 == 1, F.array(blank, blank, tok, second, second, second)).otherwise(F.col("readings"))
    return bind(bind(f1(spark, sf_dir), _held=F.col("readings")).drop("readings").withColumnRenamed("_held", "readings"), _new=readings).drop("readings").withColumnRenamed("_new", "readings")


#: Every place's vote: winner, highest count, how many readings have it.
VOTE = (
    F1
    + (_VOTED := """,
n1 AS (SELECT doc_id, pos, line, truth, reading, count(*) AS n, min(k) AS o FROM f1 WHERE reading IS NOT NULL GROUP BY ALL),
vote AS (SELECT doc_id, pos, line, truth, arg_max(reading, n * 10 - o) AS winner, max(n) AS top FROM n1 GROUP BY ALL),
ties AS (SELECT doc_id, pos, count(*) AS m FROM n1 JOIN vote USING (doc_id, pos) WHERE n = top GROUP BY ALL),
voted AS (SELECT doc_id, pos, line, truth, winner, top, m >= 2 AS tie,
  CASE WHEN m >= 2 THEN 'tie' ELSE top || 'of6' END AS stratum,
  CASE WHEN m >= 2 THEN 'contested' WHEN top = 6 THEN 'unanimous' WHEN top = 5 THEN 'one-dissent' WHEN top = 4 THEN 'two-dissent' ELSE 'contested' END AS tier
  FROM vote JOIN ties USING (doc_id, pos))""")
)
VOTE_HOLES = F1_HOLES + _VOTED


def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, id, engine, x0, y0, x1, y1: lines of text with boxes, from orders; a page has as many lines in a table of any size."""
    o = table(spark, sf_dir, "orders")
    column = F.substring("o_orderpriority", 1, 1).cast("int") % 3
    return o.select(
        F.expr("o_orderkey div 1200").cast("int").alias("page"), F.col("o_orderkey").alias("id"), (F.expr("o_orderkey div 50") % 5).cast("int").alias("engine"),
        ((column * 330 + 20 + F.col("o_orderkey") % 7) / 1000.0).alias("x0"), (F.expr("(o_orderkey div 11 * 37 + o_orderkey div 50 % 5 * 3) % 1000") / 1000.0).alias("y0"),
        ((column * 330 + 20 + F.col("o_orderkey") % 7 + 280) / 1000.0).alias("x1"), ((F.expr("(o_orderkey div 11 * 37 + o_orderkey div 50 % 5 * 3) % 1000") + 12) / 1000.0).alias("y1"), column.alias("col"),
    )


F3 = """f3 AS (SELECT (o_orderkey // 1200)::INTEGER AS page, o_orderkey AS id, (o_orderkey // 50 % 5)::INTEGER AS engine,
  (c * 330 + 20 + o_orderkey % 7) / 1000.0::DOUBLE AS x0, ((o_orderkey // 11 * 37 + o_orderkey // 50 % 5 * 3) % 1000) / 1000.0::DOUBLE AS y0,
  (c * 330 + 20 + o_orderkey % 7 + 280) / 1000.0::DOUBLE AS x1, ((o_orderkey // 11 * 37 + o_orderkey // 50 % 5 * 3) % 1000 + 12) / 1000.0::DOUBLE AS y1, c AS col
  FROM (SELECT *, substr(o_orderpriority, 1, 1)::INTEGER % 3 AS c FROM orders))"""


def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, year, month (null where not restated), day, sources, page, text: dated entries, from orders."""
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))
    date = F.col("o_orderdate")
    year = F.when(F.col("k") % 97 == 0, F.lit(1900)).otherwise(F.year(date))
    month = F.when(F.col("k") % 3 != 0, F.month(date))
    initials = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1))
    sources = F.when(F.col("k") % 2 == 0, F.array(F.col("o_orderstatus"))).otherwise(F.array(F.col("o_orderstatus"), initials))
    text = F.concat(F.lit("Entry "), F.col("k"), F.lit(" — day "), F.dayofmonth(date), F.lit(" — "), F.col("o_orderstatus"), F.lit("."))
    return o.select(F.col("k").alias("id"), year.alias("year"), month.alias("month"), F.dayofmonth(date).alias("day"), sources.alias("sources"), (F.expr("k div 40")).cast("int").alias("page"), text.alias("text"))


F4 = """f4 AS (SELECT o_orderkey AS id, (CASE WHEN o_orderkey % 97 = 0 THEN 1900 ELSE year(o_orderdate) END)::INTEGER AS year,
  (CASE WHEN o_orderkey % 3 <> 0 THEN month(o_orderdate) END)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
  CASE WHEN o_orderkey % 2 = 0 THEN [o_orderstatus] ELSE [o_orderstatus, 'P' || substr(o_orderpriority, 1, 1)] END AS sources,
  (o_orderkey // 40)::INTEGER AS page, 'Entry ' || o_orderkey || ' — day ' || day(o_orderdate) || ' — ' || o_orderstatus || '.' AS text FROM orders)"""


def f5_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, col, number, text: notes, numbered anew in each column, from lineitem."""
    item = table(spark, sf_dir, "lineitem")
    text = F.concat(F.lit("note "), F.col("l_linenumber"), F.lit(" of "), F.col("l_orderkey"))
    return item.select(F.expr("l_orderkey div 40").cast("int").alias("page"), (F.col("l_orderkey") % 2).cast("int").alias("col"), (F.col("l_orderkey") % 9 + F.col("l_linenumber")).cast("int").alias("number"), text.alias("text"), F.col("l_orderkey").alias("okey"), F.col("l_linenumber").cast("int").alias("seq"))


def f5_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entry, page, col, number: the calls to notes in the text of entries."""
    o = table(spark, sf_dir, "orders")
    body = F.concat(F.lit("word ("), F.col("o_orderkey") % 9 + 1, F.lit(") more ("), F.col("o_orderkey") % 9 + 3, F.lit(").")).alias("text")
    entries = o.where("o_orderkey % 4 <> 3").select(F.col("o_orderkey").alias("entry"), F.expr("o_orderkey div 40").cast("int").alias("page"), (F.col("o_orderkey") % 2).cast("int").alias("col"), body)
    numbers = F.transform(F.regexp_extract_all("text", F.lit(r"\((\d+)\)"), 1), lambda x: x.cast("int"))
    return entries.select("entry", "page", "col", "text", F.posexplode(numbers).alias("nth", "number"))


F5 = r"""notes AS (SELECT (l_orderkey // 40)::INTEGER AS page, (l_orderkey % 2)::INTEGER AS col, (l_orderkey % 9 + l_linenumber)::INTEGER AS number,
  'note ' || l_linenumber || ' of ' || l_orderkey AS text, l_orderkey AS okey, l_linenumber::INTEGER AS seq FROM lineitem),
ent AS (SELECT o_orderkey AS entry, (o_orderkey // 40)::INTEGER AS page, (o_orderkey % 2)::INTEGER AS col,
  'word (' || (o_orderkey % 9 + 1) || ') more (' || (o_orderkey % 9 + 3) || ').' AS text FROM orders WHERE o_orderkey % 4 <> 3),
calls AS (SELECT entry, page, col, text, unnest(range(len(x)))::INTEGER AS nth, unnest(x)::INTEGER AS number
  FROM (SELECT *, regexp_extract_all(text, '\((\d+)\)', 1) AS x FROM ent))"""

#: Rows as they stand in printed tables (literal, hand-written).
F6_ROWS = (
    (1, 0, "Wheat 120"), (1, 1, "Barley 85 kg"), (1, 2, "Oats per measure kg"), (1, 3, "No figure here"), (1, 4, "1.250"), (1, 5, "Rye 85 85"),
    (2, 0, "Oil 12,5 l."), (2, 1, "In 1714 there were many"), (2, 2, "Salt 7"), (2, 3, "Salt 7"), (2, 4, ""), (2, 5, "Wine 30 qq"),
)


def f6(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(F6_ROWS, "table_id int, seq int, text string")


F6 = "f6(table_id, seq, text) AS (VALUES " + ", ".join(f"({a}, {b}, '{c}')" for a, b, c in F6_ROWS) + ")"
