"""Operator 7: best-fit packing by hierarchical residual packing.

Documents become pieces of at most ``capacity`` tokens.  Leaves of the tree are
bounded groups of pieces by a hash of the document; each leaf packs best-fit
decreasing.  Nearly full bins are final.  After best fit a leaf has at most one bin
that is half full or less (two would have been one), so only that one and the
``carry`` emptiest of the others can profit from bins elsewhere; they go up as items
for best fit among ``fan_in`` leaves, and so on to the root.  No task gets more than
a leaf or ``fan_in * (carry + 1)`` bins, whatever the input.

Defined results: a null or empty text is the closing id alone (one piece of length
1); repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import map_arrow, staged, text_or_empty

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
LEAF_PIECES = 40_000
FAN_IN = 16
CARRY = 64
NEARLY_FULL = 4


class BestFit:
    """Bins of one capacity; the tightest bin that takes a size is one bit operation away."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.free, self.room = capacity, 0, {}, []

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset in it)"""
        able = self.mask >> size
        if able:
            room = size + (able & -able).bit_length() - 1
            bins = self.free[room]
            at = bins.pop()
            if not bins:
                self.mask &= ~(1 << room)
        else:
            room, at = self.capacity, len(self.room)
            self.room.append(self.capacity)
        left = room - size
        self.room[at] = left
        if left:
            self.free.setdefault(left, []).append(at)
            self.mask |= 1 << left
        return at, self.capacity - room


def to_pieces(batches, name: str, capacity: int, schema):
    import zlib

    import pyarrow as pa

    from .tokens import array_slices, encoder, gathered

    step = 4 * capacity
    for batch in gathered(batches, 6_000_000):
        ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
        out: list[list] = [[] for _ in range(6)]
        for first, texts in array_slices(batch.column("text")):
            tokens, counts = encoder(name).encode(texts)
            every, low = tokens.tobytes(), 0
            for k, n in enumerate(counts.tolist(), first):
                data, low = every[low : low + 4 * n] + b"\0\0\0\0", low + 4 * n
                for piece_no, at in enumerate(range(0, len(data), step)):
                    piece = data[at : at + step]
                    for column, value in zip(out, (rows[k], ids[k], piece_no, at // 4, len(piece) // 4, zlib.crc32(piece))):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)


def pack_leaf(pdf, capacity: int):
    pdf = pdf.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True], kind="stable")
    bins = BestFit(capacity)
    placed = [bins.put(int(n)) for n in pdf["length"]]
    leaf = int(pdf["leaf"].iloc[0]) if len(pdf) else 0
    pdf["bin"] = [(leaf << 24) + b for b, _ in placed]
    pdf["at"] = [o for _, o in placed]
    pdf["used"] = [capacity - bins.room[b] for b, _ in placed]
    return pdf


def merge_node(pdf, capacity: int, carry: int, nearly_full: int):
    """Bins as items of best fit; members: (leaf bin, offset) pairs of the merged bin, as bytes."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values(["used", "bin"], ascending=[False, True], kind="stable")
    bins, members, names = BestFit(capacity), [], []
    for name, used, packed in zip(pdf["bin"], pdf["used"], pdf["members"]):
        at, offset = bins.put(int(used))
        if at == len(members):
            members.append([])
            names.append(name)
        pairs = np.frombuffer(packed, dtype="<i8").reshape(-1, 2).copy()
        pairs[:, 1] += offset
        members[at].append(pairs)
    used = [capacity - r for r in bins.room]
    order = sorted(range(len(used)), key=lambda i: (used[i], names[i]))
    up = {i for i in order[: carry + 1] if used[i] < capacity - nearly_full}
    return pd.DataFrame({
        "node": np.repeat(pdf["node"].iloc[0], len(used)), "bin": names, "used": used,
        "members": [np.concatenate(m).astype("<i8").tobytes() for m in members], "open": [i in up for i in range(len(used))],
    })


def pieces_of(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """row (one of each row of ``docs``), doc_id, piece, start, length, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    arrow = to_arrow_schema(schema)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_or_empty().alias("text"))
    return map_arrow(rows, lambda it: to_pieces(it, tokenizer, capacity, arrow), schema, encodes=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY, leaf_pieces: int = LEAF_PIECES, fan_in: int = FAN_IN, carry: int = CARRY, nearly_full: int = NEARLY_FULL) -> DataFrame:
    """Adds sequence_id and offset to pieces (row, doc_id, piece, length and any others but leaf, bin, at, used).

    ``pieces`` must be a stored table: leaves are read again when an executor is lost.
    """
    from pyspark.sql.types import StructType

    leaves = max(1, -(-pieces.count() // leaf_pieces))
    keyed = pieces.withColumn("leaf", F.pmod(F.xxhash64("row"), F.lit(leaves)))
    schema = StructType([*keyed.schema.fields, *StructType.fromDDL("bin long, at long, used long").fields])
    packed = staged(keyed.groupBy("leaf").applyInPandas(lambda pdf: pack_leaf(pdf, capacity), schema), "op7-leaves")
    bins = packed.groupBy("bin").agg(F.first("used").alias("used"), F.first("leaf").alias("node"))
    bins = bins.where(F.col("used") < capacity - nearly_full)
    layout = "node long, bin long, used long, members binary, open boolean"
    moved = None
    if leaves > 1:
        open_bins = bins.mapInPandas(_with_members, "node long, bin long, used long, members binary")
        # of a leaf, like of any node, only the carry + 1 emptiest go up
        from pyspark.sql import Window

        emptiest = Window.partitionBy("node").orderBy("used", "bin")
        level = open_bins.withColumn("rank", F.row_number().over(emptiest)).where(F.col("rank") <= carry + 1).drop("rank")
        width = leaves
        while width > 1:
            width = -(-width // fan_in)
            merged = staged(level.withColumn("node", F.expr(f"node div {fan_in}")).groupBy("node").applyInPandas(lambda pdf: merge_node(pdf, capacity, carry, nearly_full), layout), "op7-level")
            final = merged if width == 1 else merged.where(~F.col("open"))
            moved = final if moved is None else moved.unionByName(final)
            level = merged.where("open").drop("open")
        places = moved.mapInPandas(_places, "bin long, sequence_id long, base long")
        packed = packed.join(places, "bin", "left")
    else:
        packed = packed.withColumn("sequence_id", F.col("bin")).withColumn("base", F.lit(0).cast("long"))
    return packed.select(*pieces.columns, F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset"))


def _with_members(frames):
    import numpy as np

    for pdf in frames:
        pdf["members"] = [np.array([b, 0], dtype="<i8").tobytes() for b in pdf["bin"]]
        yield pdf[["node", "bin", "used", "members"]]


def _places(frames):
    import numpy as np
    import pandas as pd

    for pdf in frames:
        pairs = [np.frombuffer(m, dtype="<i8").reshape(-1, 2) for m in pdf["members"]]
        if pairs:
            every = np.concatenate(pairs)
            yield pd.DataFrame({"bin": every[:, 0], "sequence_id": np.repeat(pdf["bin"].to_numpy(), [len(p) for p in pairs]), "base": every[:, 1]})


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, **how) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row."""
    return pack(staged(pieces_of(docs, tokenizer, capacity), "op7-pieces"), capacity, **how).drop("row")
