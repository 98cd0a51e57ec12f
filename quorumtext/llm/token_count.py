"""Operator 1: token counts by overlap resynchronisation.

Documents up to ``huge_chars`` code points are encoded whole.  Longer ones are cut into
overlapping chunks that become rows of their own, so that one document is shared out
over many tasks.  Every chunk is encoded with offsets; two neighbouring chunks are
spliced at a position inside their overlap where both have a token start that
provably does not depend on what lies further away.  A document with a seam that has
no such position is encoded again with overlaps ``widen`` times as wide, at last whole.

Defined results: null or empty text has 0 tokens and 0 bytes; repeated rows are
counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .common import map_arrow, staged, text_or_empty

TOKENIZER = "word_bpe_49k.json"
#: White space as the tokenizer sees it.
_SPACE = frozenset(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def is_stable(text: str, at: int) -> bool:
    """Whether a token start at ``at`` holds whatever stands further left or right.

    White space before it ends every earlier match.  Between two ASCII letters or
    digits of which one is a digit there is always a cut, as digits stand alone, no
    mark composes with an ASCII digit and no special token or contraction has digits.
    """
    if at <= 0:
        return False
    a, b = text[at - 1], text[at]
    if a in _SPACE:
        return True
    return a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and (a.isdigit() or b.isdigit())


def count_small(batches, name: str):
    import pyarrow as pa

    from .tokens import array_slices, encoder, gathered

    for batch in gathered(batches):
        counts: list[int] = []
        for _, part in array_slices(batch.column("text")):
            counts += encoder(name).encode(part)[1].tolist()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64()), pa.array([1] * len(counts), pa.int32())], ["doc_id", "n_bytes", "n_tokens", "n_chunks"])


_CHUNK = "row long, doc_id {id}, n_bytes long, chunk int, low long, left long, right long, text string"


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def cut(batches, schema, size: int, overlap: int):
    """Chunk ``i`` owns [i*size, (i+1)*size) and also has ``overlap`` more on each side."""
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"]
            n = len(text)
            last = max(0, -(-n // size) - 1)
            for i in range(last + 1):
                low, high = max(0, i * size - overlap), min(n, (i + 1) * size + overlap)
                yield pa.RecordBatch.from_pylist([{"row": row["row"], "doc_id": row["doc_id"], "n_bytes": row["n_bytes"], "chunk": i, "low": low, "left": i * size if i else -1, "right": (i + 1) * size if i < last else -1, "text": text[low:high]}], schema=schema)


def encode_chunks(batches, name: str, schema, overlap: int):
    """Of each chunk: token starts in both seams, those of them that are stable, and the count between."""
    import pyarrow as pa

    from .tokens import encoder

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            text, low = row.pop("text"), row["low"]
            starts = encoder(name).with_offsets([text])[0]
            left, right = row.pop("left"), row.pop("right")
            head_end = left + overlap if left >= 0 else -1
            tail_start = right - overlap if right >= 0 else low + len(text) + 1
            head = [s + low for s in starts if s + low < head_end]
            tail = [s + low for s in starts if s + low >= tail_start]
            out.append(row | {
                "head": head, "tail": tail, "core": len(starts) - len(head) - len(tail),
                "head_stable": [p for p in head if is_stable(text, p - low)], "tail_stable": [p for p in tail if is_stable(text, p - low)],
            })
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _huge(rows: DataFrame, name: str, size: int, overlap: int) -> DataFrame:
    """(row, doc_id, n_bytes, n_tokens, n_chunks, failed) of documents that are cut."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = _id_type(rows)
    cut_schema = StructType.fromDDL(_CHUNK.format(id=kind))
    enc_schema = StructType.fromDDL(f"row long, doc_id {kind}, n_bytes long, chunk int, low long, core long, head array<long>, tail array<long>, head_stable array<long>, tail_stable array<long>")
    cut_arrow, enc_arrow = to_arrow_schema(cut_schema), to_arrow_schema(enc_schema)
    chunks = map_arrow(rows, lambda it: cut(it, cut_arrow, size, overlap), cut_schema).repartition("row", "chunk")
    found = map_arrow(chunks, lambda it: encode_chunks(it, name, enc_arrow, overlap), enc_schema, encodes=True)
    w = Window.partitionBy("row").orderBy("chunk")
    seams = found.withColumn("next_stable", F.lead("head_stable").over(w)).withColumn("last", F.lead("chunk").over(w).isNull())
    seams = seams.withColumn("splice", F.array_min(F.array_intersect("tail_stable", "next_stable"))).withColumn("before", F.lag("splice").over(w))
    counted = F.col("core") + F.when(F.col("last"), F.size("tail")).otherwise(F.size(F.filter("tail", lambda p: p < F.col("splice")))) + F.when(F.col("chunk") == 0, F.size("head")).otherwise(F.size(F.filter("head", lambda p: p >= F.col("before"))))
    return seams.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum(counted).cast("long").alias("n_tokens"), F.count("*").cast("int").alias("n_chunks"), F.max(~F.col("last") & F.col("splice").isNull()).alias("failed"))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, huge_chars: int = 16_384, chunk_chars: int = 8_192, overlap: int = 256, widen: int = 8) -> DataFrame:
    """doc_id, n_bytes, n_tokens, n_chunks of every row of ``docs``."""
    kind = _id_type(docs)
    text = text_or_empty()
    base = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    small = map_arrow(base.where(F.length("text") <= huge_chars), lambda it: count_small(it, tokenizer), f"doc_id {kind}, n_bytes long, n_tokens long, n_chunks int", encodes=True)
    # the few rows that are cut get a key of their own, which repeated ids do not disturb; their texts stay staged for wider tries
    rows = staged(base.where(F.length("text") > huge_chars).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "n_bytes"), "op1-huge")
    result, size = small, chunk_chars
    while True:
        found = staged(_huge(rows, tokenizer, size, min(overlap, size // 2)), "op1-spliced")
        result = result.unionByName(found.where(~F.col("failed")).select("doc_id", "n_bytes", "n_tokens", "n_chunks"))
        failed = found.where("failed").select("row")
        if failed.isEmpty():
            return result
        rows = rows.join(failed, "row", "left_semi")
        overlap, size = overlap * widen, max(size, overlap * widen * 2)
