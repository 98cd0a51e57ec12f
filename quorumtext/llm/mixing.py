"""Operator 6: mixing sources to target weights by iterative proportional fitting.

Everything here is DataFrame expressions.  Documents are summed into cells (source,
language, topic); raking scales the cells' token weights to each target marginal in turn
until all hold.  A cell's ratio of raked to present tokens, times one constant, is the
probability with which its documents are kept (at most 1; the constant is raised over
the cells below 1 until the kept tokens come to ``keep_share`` of all), and a
number from the document's id decides.

Targets default to the present marginals tempered by a power, so that large sources,
languages and topics give way to small ones.  A topic is read from the column that ``topic_column``
names, and is the form of the text where none is named.  Tokens are runs between white space.

The table of cells is small beside the documents but not bounded, so it stays in Spark: a sweep is
three aggregations with map-side sums, joined to the cells, and one written table, which cuts the lineage.
Sweeps go on until every marginal is within ``tolerance`` of its target.  Targets that contradict each other
(where sources decide languages, say) have no such end: when a sweep no longer brings the marginals nearer, it
ends with a warning that names the distance left, and ``gaps`` lists every value's target and weight.

Defined results: null source, language or topic is the value ``(none)``; a null or empty
text has 0 tokens and probability 1 (it weighs nothing); values that a given target lacks get
weight 0; repeated rows share one fate; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F

from .common import staged, text_or_empty

DIMENSIONS = ("source", "lang", "topic")
POWERS = {"source": 0.7, "lang": 0.6, "topic": 0.8}
SWEEPS = 500
SQL_SWEEPS = 400
TOLERANCE = 1e-10
RAISES = 8
KEEP_SHARE = 0.6
NONE = "(none)"


def tokens_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^ \\t\\n\\r\\f]+")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """What the text looks like: figures, short notes, listings, articles or long works."""
    digits = F.length(text) - F.length(F.translate(text, "0123456789", ""))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    return (F.when(digits * 40 >= F.length(text), "figures").when(tokens < 120, "notes").when(tokens < lines * 30, "listings").when(tokens < 1000, "articles").otherwise("works"))


def described(docs: DataFrame, topic_column: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens of every row."""
    named = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(name)
    text = docs.select("doc_id", named("source", "source"), named("lang", "lang"), *([named(topic_column, "topic")] if topic_column else []), text_or_empty().alias("_text"))
    counted = text.withColumn("tokens", tokens_of(F.col("_text")))
    if not topic_column:
        counted = counted.withColumn("topic", topic_of(F.col("_text"), F.col("tokens")))
    return counted.select("doc_id", *DIMENSIONS, "tokens")


def _target(cells: DataFrame, dimension: str, given: dict | None) -> DataFrame:
    """(value, share): shares of present values; they sum to 1."""
    present = cells.groupBy(dimension).agg(F.sum("tokens").alias("t"))
    if given is None:
        raw = present.select(dimension, F.pow(F.col("t").cast("double"), F.lit(POWERS[dimension])).alias("raw"))
    else:
        table = F.create_map(*[F.lit(x) for pair in given.items() for x in (pair[0], float(pair[1]))]) if given else F.lit(None).cast("map<string,double>")
        raw = present.select(dimension, F.coalesce(F.try_element_at(table, F.col(dimension)), F.lit(0.0)).alias("raw"))
    total = raw.agg(F.sum("raw").alias("all"))
    return raw.crossJoin(F.broadcast(total)).select(dimension, (F.col("raw") / F.nullif("all", F.lit(0.0))).alias(f"{dimension}_share"))


def _held(cells: DataFrame, dimension: str) -> DataFrame:
    return cells.groupBy(dimension).agg(F.sum("weight").alias("held"))


def gaps(raked: DataFrame) -> DataFrame:
    """dimension, value, target, held: how the raked weights meet every target."""
    each = [raked.groupBy(d).agg(F.max(f"{d}_share").alias("target"), F.sum("weight").alias("held")).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "target", "held") for d in DIMENSIONS]
    return each[0].unionByName(each[1]).unionByName(each[2])


def rake(cells: DataFrame, targets: dict[str, dict] | None = None, sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``weight`` to (source, lang, topic, tokens): raked shares that sum to 1; and the targets of each dimension's value."""
    targets = targets or {}
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        out = out.join(_target(cells, d, targets.get(d)), d)
    out = staged(out, "op6-raked")
    before = None
    for _ in range(sweeps):
        for d in DIMENSIONS:
            fitted = F.when(F.col("held") > 0, F.col("weight") * F.col(f"{d}_share") / F.col("held")).otherwise(0.0)
            out = out.join(_held(out, d), d).withColumn("weight", fitted).drop("held")
        out = staged(out, "op6-raked")
        off = gaps(out).agg(F.max(F.abs(F.col("held") - F.col("target")))).first()[0]
        if off is None or off <= tolerance:
            break
        if before is not None and off > before * 0.9999:
            warnings.warn(f"the targets contradict each other: after raking a marginal is still {off:.3g} off its target", stacklevel=2)
            break
        before = off
    else:
        if sweeps:
            warnings.warn(f"after {sweeps} sweeps a marginal is still {off:.3g} off its target", stacklevel=2)
    return out


def probabilities(raked: DataFrame, keep_share: float = KEEP_SHARE, raises: int = RAISES) -> DataFrame:
    """Adds ``probability`` to raked cells: min(1, constant * weight / tokens)."""
    raked = staged(raked.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)), "op6-ratios")
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    constant = keep_share * total
    for _ in range(raises):
        full = F.col("ratio") * F.lit(constant) >= 1
        kept, rest = raked.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("kept"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("rest")).first()
        if not rest:
            break
        constant = max(constant, (keep_share * total - kept) / rest)
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("ratio") * F.lit(float(constant)))).otherwise(1.0)
    return raked.select(*DIMENSIONS, probability.alias("probability"))


def lot(seed: int = 6) -> Column:
    """A number in [0, 1) from the id: the same for a document wherever and whenever it is drawn."""
    hex8 = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8)
    return F.conv(hex8, 16, 10).cast("double") / F.lit(float(2**32))


def mix(docs: DataFrame, targets: dict[str, dict] | None = None, keep_share: float = KEEP_SHARE, seed: int = 6, sweeps: int = SWEEPS, topic_column: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept of every row."""
    rows = staged(described(docs, topic_column), "op6-rows")
    cells = staged(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "op6-cells")
    chances = probabilities(rake(cells, targets, sweeps), keep_share)
    joined = rows.join(chances, list(DIMENSIONS))
    return joined.select("doc_id", *DIMENSIONS, "tokens", F.round("probability", 6).alias("probability"), (lot(seed) < F.col("probability")).alias("kept"))


def sample_mixture(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` (unique ids) that the lot keeps, with all their columns."""
    # repeated ids share one fate, so that the semi join keeps all of them or none
    return docs.join(mix(docs, **how).where("kept").select("doc_id"), "doc_id", "left_semi")


def mixing_sql(sweeps: int = SQL_SWEEPS, raises: int = RAISES, keep_share: float = KEEP_SHARE, seed: int = 6, documents: str = "documents") -> str:
    """The same in DuckDB's SQL: a recursive query of so many sweeps that the marginals stand still."""
    steps = [rf"""
t AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, coalesce(text, '') AS text,
  len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f]+')) AS tokens FROM {documents}),
r AS MATERIALIZED (SELECT doc_id, source, lang, tokens, CASE
  WHEN (length(text) - length(translate(text, '0123456789', ''))) * 40 >= length(text) THEN 'figures' WHEN tokens < 120 THEN 'notes'
  WHEN tokens < (length(text) - length(replace(text, chr(10), '')) + 1) * 30 THEN 'listings' WHEN tokens < 1000 THEN 'articles' ELSE 'works' END AS topic FROM t),
c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM r GROUP BY ALL)"""]
    for d in DIMENSIONS:
        steps.append(f"raw_{d} AS (SELECT {d}, pow(sum(tokens)::DOUBLE, {POWERS[d]}) AS raw FROM c GROUP BY {d}), share_{d} AS MATERIALIZED (SELECT {d}, raw / sum(raw) OVER () AS {d}_share FROM raw_{d})")
    fit = "rk"
    for k, d in enumerate(DIMENSIONS):
        held = f"(SELECT *, sum({f'w{k}' if k else 'weight'}) OVER (PARTITION BY {d}) AS h{k} FROM {fit}{'' if k else f' WHERE step < {sweeps}'})"
        fit = f"(SELECT *, CASE WHEN h{k} > 0 THEN {f'w{k}' if k else 'weight'} * {d}_share / h{k} ELSE 0 END AS w{k + 1} FROM {held})"
    steps.append(f"""rk(step, source, lang, topic, tokens, source_share, lang_share, topic_share, weight) AS (
  SELECT 0, source, lang, topic, tokens, source_share, lang_share, topic_share, tokens::DOUBLE FROM c JOIN share_source USING (source) JOIN share_lang USING (lang) JOIN share_topic USING (topic)
  UNION ALL SELECT step + 1, source, lang, topic, tokens, source_share, lang_share, topic_share, w{len(DIMENSIONS)} FROM {fit})""")
    steps.append(f"q AS MATERIALIZED (SELECT source, lang, topic, tokens, weight, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM rk WHERE step = {sweeps})")
    steps.append(f"k0 AS MATERIALIZED (SELECT {keep_share}::DOUBLE * sum(tokens) AS c, {keep_share}::DOUBLE * sum(tokens) AS want FROM q)")
    for n in range(raises):
        steps.append(f"k{n + 1} AS MATERIALIZED (SELECT greatest(c, coalesce((want - (SELECT sum(CASE WHEN ratio * c >= 1 THEN tokens ELSE 0 END) FROM q)) / nullif((SELECT sum(CASE WHEN ratio * c >= 1 THEN 0.0 ELSE weight END) FROM q), 0), c)) AS c, want FROM k{n})")
    steps.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0::DOUBLE, ratio * c) ELSE 1.0 END AS probability FROM q, k{raises})")
    return "WITH RECURSIVE " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, tokens, round(probability, 6) AS probability,
  ('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < probability AS kept
FROM r JOIN p USING (source, lang, topic)"""
