"""Operator 2: line deduplication by pairwise alignment.

Lines are compared without the blanks around them, by a 64-bit hash.  Documents are
candidates for one another when they share a line: each is linked to the earliest
document (least id) that has it, and, if the line is rare (in at most ``rare`` documents),
to the one before it in order as well.  A run of short neighbouring lines that just reaches
``block_words`` words links its documents to the earliest one that has the whole run.  So a line
or run links each of its documents at most twice, in groups of any size.  A pair is aligned by patience diff: lines that are
unique in both anchor the alignment (their longest rising sequence), equal neighbours
extend it, and the gaps between anchors are aligned again.  Aligned blocks of at least
``block_words`` words go from the later document; several earlier documents may each take
blocks from it.  An earlier document is aligned with its original lines, also where
they were deleted from it, since those stand in a still earlier one.

Lines that one document alone has are left out of the sequences (their places still
divide blocks).  Sequences are cut into units of ``unit_lines`` lines, so that rows are bounded for
documents of any length.  A unit also has the last and the next ``block_words`` lines of its neighbours, which
a block that just suffices never exceeds: a block across a cut is found in the unit it starts in, and longer ones
in parts that overlap.  Texts themselves move once, to take their deletions.

A document is an id with a text: rows with equal ids and equal texts get the same answer, rows with equal
ids and different texts are documents of their own (the one of lesser text hash is the earlier).

Defined results: null counts as empty; blank lines are never deleted on their own, but
go when no line with words is left, and the text is then empty; a document that
repeats a line of its own keeps it; of documents of equal text the later ones lose
all lines; an empty table gives an empty result; other columns are ignored, and kept, but for columns
of the names n_lines and n_deleted, which ``dedup_lines`` replaces.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

from .common import free_name, map_arrow, staged, text_or_empty

RARE = 64
BLOCK_WORDS = 5
UNIT_LINES = 512


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j), rising in both, of equal items of the two sequences."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = _places_once(a, a0, a1), _places_once(b, b0, b1)
        anchors = _rising([(i, once_b[x]) for x, i in once_a.items() if x in once_b])
        if not anchors:
            # no item is unique in both: the first pair of equal items in order is an anchor
            places: dict = {}
            for j in range(b0, b1):
                places.setdefault(b[j], []).append(j)
            at = b0
            for i in range(a0, a1):
                own = places.get(a[i], ())
                k = bisect_left(own, at)
                if k < len(own):
                    found.append((i, own[k]))
                    at = own[k] + 1
            continue
        found += anchors
        at_a, at_b = a0, b0
        for i, j in [*anchors, (a1, b1)]:
            if at_a < i and at_b < j:
                todo.append((at_a, i, at_b, j))
            at_a, at_b = i + 1, j + 1
    return sorted(found)


def _places_once(items: list, low: int, high: int) -> dict:
    seen: dict = {}
    for k in range(low, high):
        seen[items[k]] = -1 if items[k] in seen else k
    return {x: k for x, k in seen.items() if k >= 0}


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that rises in both, of pairs in the order of the first."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        if pile == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[pile], at[pile] = j, k
        before[k] = at[pile - 1] if pile else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def blocks_to_delete(later: list[tuple], earlier: list[tuple], block_words: int) -> list[int]:
    """Places of the later document's lines in aligned blocks of enough words.

    Both are (place, line hash, words) in order, places counted without blank lines; a
    block is a run of aligned lines that are neighbours in both documents."""
    out: list[int] = []
    run: list[int] = []
    words = 0
    last = None
    for i, j in patience([x[1] for x in later], [x[1] for x in earlier]):
        here = (later[i][0], earlier[j][0])
        if last is None or here != (last[0] + 1, last[1] + 1):
            if words >= block_words:
                out += run
            run, words = [], 0
        run.append(later[i][0])
        words += later[i][2]
        last = here
    return out + run if words >= block_words else out


def lines_of(docs: DataFrame, unit_lines: int = UNIT_LINES) -> DataFrame:
    """doc (doc_id, hash of the text), unit, place (without blank lines), line (with them), hash, words of every line that is not blank."""
    trimmed = "transform(split(text, '\\n'), (x, i) -> struct(i AS line, trim(BOTH ' \\t\\r\\u000b\\f' FROM x) AS own))"
    rows = docs.select("doc_id", text_or_empty().alias("text")).select(F.struct("doc_id", F.xxhash64("text").alias("mark")).alias("doc"), "text")
    rows = rows.select("doc", F.expr(f"posexplode(filter({trimmed}, x -> x.own <> ''))").alias("place", "x"))
    words = F.size(F.split("x.own", r"[ \t]+")).alias("words")
    return rows.select("doc", F.expr(f"place div {unit_lines}").cast("int").alias("unit"), "place", F.col("x.line").alias("line"), F.xxhash64("x.own").alias("hash"), words)


def _align_rows(batches, block_words: int):
    import pyarrow as pa

    for batch in batches:
        ids, out = [], []
        for row in batch.to_pylist():
            later = [(x["place"], x["hash"], x["words"]) for x in row["later_lines"]]
            earlier = [(x["place"], x["hash"], x["words"]) for x in row["earlier_lines"]]
            gone = set(blocks_to_delete(later, earlier, block_words))
            if gone:
                ids.append(row["doc"])
                out.append([x["line"] for x in row["later_lines"] if x["place"] in gone])
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc").type), pa.array(out, pa.list_(pa.int32()))], ["doc", "gone"])


def _run_rows(batches, block_words: int):
    """The least runs of neighbouring lines that reach ``block_words`` words, one a line that has fewer itself."""
    from hashlib import blake2b
    from struct import pack

    import pyarrow as pa

    for batch in batches:
        ids, units, keys = [], [], []
        for row in batch.to_pylist():
            lines = row["lines"]
            for at, x in enumerate(lines):
                end, words = at + 1, x["words"]
                if words >= block_words:
                    continue
                while words < block_words and end < len(lines) and lines[end]["place"] == lines[end - 1]["place"] + 1:
                    end, words = end + 1, words + lines[end]["words"]
                if words >= block_words:
                    ids.append(row["doc"])
                    units.append(row["unit"])
                    keys.append(blake2b(pack(f"<{end - at}q", *(y["hash"] for y in lines[at:end])), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc").type), pa.array(units, pa.int32()), pa.array(keys, pa.binary())], ["doc", "unit", "run"])


def deleted_lines(docs: DataFrame, rare: int = RARE, block_words: int = BLOCK_WORDS, unit_lines: int = UNIT_LINES) -> DataFrame:
    """doc (doc_id, hash of the text), gone (line numbers from 0): of each document that loses lines."""
    kind = f"struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},mark:bigint>"
    lines = staged(lines_of(docs, unit_lines), "op2-lines")
    first = F.min(F.struct("doc", "unit"))
    in_two = lines.groupBy("hash").agg(first.alias("first"), F.max("doc").alias("last"), F.count("*").alias("n")).where("first.doc < last").drop("last")
    # a stored table, so that the join deals both sides by itself and Spark can split a line that very many have
    shared = staged(lines.join(staged(in_two, "op2-lines-of-two"), "hash"), "op2-shared")
    linked = lambda rows: rows.where("doc > first.doc").select("doc", "unit", F.col("first.doc").alias("earlier"), F.col("first.unit").alias("earlier_unit"))
    # rare lines only, so that a window's group is bounded
    w = Window.partitionBy("hash").orderBy("doc", "unit", "place")
    before = shared.where(F.col("n") <= rare).drop("first").withColumn("first", F.lag(F.struct("doc", "unit")).over(w))
    # each line in its own unit and, near a cut, in the unit on the other side of it
    places = F.expr(f"array_distinct(array(unit, cast(greatest(place - {block_words}, 0) div {unit_lines} as int), cast((place + {block_words}) div {unit_lines} as int)))")
    spread = shared.select("doc", "place", "line", "hash", "words", F.explode(places).alias("unit"))
    units = staged(spread.groupBy("doc", "unit").agg(F.array_sort(F.collect_set(F.struct("place", "line", "hash", "words"))).alias("lines")), "op2-units")
    runs = staged(map_arrow(units.select("doc", "unit", "lines"), lambda it: _run_rows(it, block_words), f"doc {kind}, unit int, run binary").distinct(), "op2-runs")
    run_first = runs.groupBy("run").agg(first.alias("first"), F.max("doc").alias("last")).where("first.doc < last").drop("last")
    in_run = runs.join(staged(run_first, "op2-runs-of-two"), "run")
    pairs = linked(shared).unionByName(linked(before)).unionByName(linked(in_run)).distinct()
    later = pairs.join(units.withColumnRenamed("lines", "later_lines"), ["doc", "unit"])
    both = later.join(units.select(F.col("doc").alias("earlier"), F.col("unit").alias("earlier_unit"), F.col("lines").alias("earlier_lines")), ["earlier", "earlier_unit"])
    found = map_arrow(both.select("doc", "later_lines", "earlier_lines"), lambda it: _align_rows(it, block_words), f"doc {kind}, gone array<int>")
    return found.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def _cut_rows(batches, schema, text_at: int, gone_at: int, keep_emptied: bool):
    """Texts without their deleted lines; n_lines and n_deleted follow, or else rows that lose all of their text go."""
    import pyarrow as pa

    for batch in batches:
        texts, gone = batch.column(text_at).to_pylist(), batch.column(gone_at).to_pylist()
        out, total, lost = [], [], []
        for text, lines in zip(texts, gone):
            every = (text or "").split("\n")
            total.append(len(every))
            lost.append(len(lines or ()))
            if lines:
                drop = set(lines)
                left = [x for i, x in enumerate(every) if i not in drop]
                text = "\n".join(left) if any(x.strip() for x in left) else ""
            out.append(text)
        columns = [c for k, c in enumerate(batch.columns) if k != gone_at]
        columns[text_at] = pa.array(out, pa.string())
        if keep_emptied:
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int32()), pa.array(lost, pa.int32())], schema=schema)
        else:
            stays = pa.array([not n or bool(t) for n, t in zip(lost, out)], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, schema=schema).filter(stays)


def _cleaned(docs: DataFrame, keep_emptied: bool, **how) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    names = docs.columns
    own, mark, gone = (free_name(x, names) for x in ("own_id", "mark", "gone"))
    deleted = deleted_lines(docs, **how).select(F.col("doc.doc_id").alias(own), F.col("doc.mark").alias(mark), F.col("gone").alias(gone))
    met = (docs["doc_id"] == deleted[own]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == deleted[mark])
    joined = docs.join(deleted, met, "left").select(*[docs[c] for c in names], deleted[gone])
    schema = StructType([*docs.schema.fields, *(StructType.fromDDL("n_lines int, n_deleted int").fields if keep_emptied else [])])
    arrow = to_arrow_schema(schema)
    text_at, gone_at = names.index("text"), len(names)
    return map_arrow(joined, lambda it: _cut_rows(it, arrow, text_at, gone_at, keep_emptied), schema)


def dedup_lines(docs: DataFrame, **how) -> DataFrame:
    """The columns of ``docs`` with ``text`` cleaned, and n_lines, n_deleted, of every row."""
    return _cleaned(docs.drop("n_lines", "n_deleted"), True, **how)


def clean_documents(docs: DataFrame, **how) -> DataFrame:
    """The columns of ``docs`` with ``text`` cleaned; rows that lose all of their text go."""
    return _cleaned(docs, False, **how)
