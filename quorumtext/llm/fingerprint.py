"""Operator 8: document fingerprints by MinHash.

The fingerprint of a text is the vector of the least values of ``permutations``
universal hash functions (multiply-add over 64 bits) over its five-word shingles, of
each of which 16 bits are kept (b-bit MinHash), computed in numpy for many texts at once.  Signature bands
(32 of 4 places: a pair at 0.8 meets in none once in 10^7 times) are joined in Spark to find similar
documents, and exact Jaccard over the shingles decides.  Within a band's bucket texts are compared as in
operator 3: with a head, and those unlike it anew by what the head lacks.

Defined results: null counts as empty; texts of under five words have one shingle of
all their words, so empty and blank texts are alike; equal texts have equal
fingerprints; repeated rows are fingerprinted each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import map_arrow, staged, text_or_empty

PERMUTATIONS = 128
SHINGLE = 5
BLOCK = 16_384
BANDS = 32


@lru_cache(maxsize=4)
def _functions(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_240_607))
    high = np.iinfo(np.uint64).max
    return rng.integers(1, high, permutations, dtype=np.uint64) | np.uint64(1), rng.integers(0, high, permutations, dtype=np.uint64)


def signatures(texts: list[str], permutations: int = PERMUTATIONS, size: int = SHINGLE) -> np.ndarray:
    """uint16 (texts, permutations)"""
    from .shingles import shingle_hashes

    a, b = _functions(permutations)
    hashes, counts = shingle_hashes(texts, size)
    least = np.full((permutations, len(texts)), np.iinfo(np.uint64).max, dtype=np.uint64)
    ends = np.cumsum(counts)
    room = np.empty(BLOCK, dtype=np.uint64)
    for low in range(0, len(hashes), BLOCK):
        part = hashes[low : low + BLOCK]
        first, last = np.searchsorted(ends, [low, low + len(part) - 1], side="right")
        cuts = np.maximum(ends[first : last + 1] - counts[first : last + 1] - low, 0)
        values = room[: len(part)]
        for k in range(permutations):
            np.multiply(part, a[k], out=values)
            np.add(values, b[k], out=values)
            np.minimum(least[k, first : last + 1], np.minimum.reduceat(values, cuts), out=least[k, first : last + 1])
    return (least >> np.uint64(24)).astype(np.uint16).T.copy()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal places: the estimate of Jaccard."""
    return (a == b).mean(axis=1)


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _fingerprints(pairs, permutations: int, size: int, schema):
    """(doc_id, text, next text) to fingerprints."""
    import hashlib

    import pyarrow as pa

    from .tokens import slices

    texts = [t for _, t, _ in pairs]
    for first, part in slices(texts):
        rows = pairs[first : first + len(part)]
        after = [n for _, _, n in rows]
        edited = [_edited(t, n) for t, n in zip(part, after)]
        own, other = signatures(part, permutations, size), signatures(edited, permutations, size)
        coming = np.roll(own, -1, axis=0)  # most rows stand before the row that follows them
        apart = [i for i, n in enumerate(after) if i + 1 == len(part) or n != part[i + 1]]
        coming[apart] = signatures([after[i] for i in apart], permutations, size)
        yield pa.RecordBatch.from_arrays([
            pa.array([i for i, _, _ in rows], schema.field(0).type), pa.array([len(t) for t in part], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            pa.array([x.astype(">u2").tobytes().hex() for x in own]), pa.array([x.astype(">u2").tobytes().hex() for x in other]),
            pa.array(likeness(own, other)), pa.array(likeness(own, coming)),
        ], schema=schema)


def _ids_with_part(batches, bounds):
    import pyarrow as pa

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.searchsorted(bounds, ids, side="right").astype(np.int32))], ["doc_id", "part"])


def _with_part(batches, bounds, head_of: dict):
    """Rows with the range of ids they are in; the first of a range also goes to the range before, as its tail."""
    import pyarrow as pa

    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        part = np.searchsorted(bounds, ids, side="right").astype(np.int32)
        names = ["part", "tail", "doc_id", "text"]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(ids), bool)), batch.column("doc_id"), batch.column("text")], names)
        heads = [i for i in np.flatnonzero(np.isin(ids, list(head_of))).tolist()]
        if heads:
            more = batch.take(pa.array(heads))
            yield pa.RecordBatch.from_arrays([pa.array([head_of[ids[i].item()] for i in heads], pa.int32()), pa.array([True] * len(heads)), more.column("doc_id"), more.column("text")], names)


def _pairs(batches, most_chars: int = 1_000_000, rows: int = 256):
    """Lists of (doc_id, text, next text) from rows in the order of part, tail, doc_id."""
    held, done, out, size = None, None, [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            few = batch.slice(low, rows)
            for part, tail, doc_id, text in zip(*(few.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text"))):
                if part == done:
                    continue  # the tail, repeated
                if held is not None:
                    out.append((held[0], held[1], text))
                    size += len(held[1])
                held, done = (None, part) if tail else ((doc_id, text), None)
                if size > most_chars:
                    yield out
                    out, size = [], 0
    if out:
        yield out


def fingerprints(docs: DataFrame, permutations: int = PERMUTATIONS, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Neighbours in the order of doc_id meet through one exchange of the texts: ids are
    divided into ranges, and the first document of each goes to the range before as well.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    arrow = to_arrow_schema(schema)
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    bounds = np.unique(ids.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 20 * ranges).alias("b")).first()["b"] or [])
    # the first id of each range: a number a range
    firsts = map_arrow(ids, lambda it: _ids_with_part(it, bounds), f"doc_id {kind}, part int").groupBy("part").agg(F.min("doc_id").alias("first"))
    firsts = sorted((r["part"], r["first"]) for r in firsts.collect())
    head_of = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    placed = map_arrow(rows, lambda it: _with_part(it, bounds, head_of), f"part int, tail boolean, doc_id {kind}, text string")
    ordered = placed.repartition("part").sortWithinPartitions("part", "tail", "doc_id", "text")
    return map_arrow(ordered, lambda it: (done for pairs in _pairs(it) for done in _fingerprints(pairs, permutations, size, arrow)), schema)


def _bands(batches, permutations: int, size: int, bands: int):
    """(doc_id, print, n, keys): a hash of the fingerprint, the number of distinct shingles, a key a band."""
    import pyarrow as pa
    import xxhash

    from .shingles import shingle_hashes
    from .tokens import slices

    width = permutations // bands
    for batch in batches:
        ids = batch.column("doc_id")
        for first, part in slices(batch.column("text").to_pylist(), 1_000_000):
            rows = signatures(part, permutations, size)
            keys = [[xxhash.xxh3_64_intdigest(r[k * width : (k + 1) * width].tobytes(), seed=k + 1) for k in range(bands)] for r in rows]
            hashes, counts = shingle_hashes(part, size)
            n = [len(np.unique(x)) for x in np.split(hashes, np.cumsum(counts)[:-1])]
            exact = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in part]
            yield pa.RecordBatch.from_arrays([ids.slice(first, len(part)), pa.array(exact, pa.binary()), pa.array(n, pa.int64()), pa.array(np.array(keys, dtype=np.uint64).view(np.int64).tolist(), pa.list_(pa.int64()))], ["doc_id", "same", "n", "keys"])


def similar_documents(docs: DataFrame, threshold: float = 0.8, permutations: int = PERMUTATIONS, size: int = SHINGLE, bands: int = BANDS) -> DataFrame:
    """doc_id, class_id, n_links, kept of every row: the connected component of links of Jaccard ``threshold`` or more
    between different texts (its least id) and the number of the text's verified links.  Rows of equal text are one class,
    whose least id stands for them.  Blank texts have one shingle of no words, so they are alike."""
    from .order_minhash import classes_of, jaccard

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    found = staged(map_arrow(rows, lambda it: _bands(it, permutations, size, bands), f"doc_id {kind}, same binary, n long, keys array<long>"), "op8-bands")
    return classes_of(found, rows, jaccard, threshold, size)
