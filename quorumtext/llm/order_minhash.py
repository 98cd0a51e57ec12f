"""Operator 3: near-duplicate detection by Order MinHash.

k-mers are runs of five words, labelled with the number of their occurrence in the
text.  Each of ``sketches`` hash functions picks the ``picks`` least labelled k-mers;
the bucket key of a sketch is the hash of the picked ones in the order in which they
stand in the text.  So texts meet only if they share the same k-mers in the same order,
as texts at a small edit distance do.

A pair is verified by banded alignment of its words: the similarity is
2 * aligned words / (words of both), and ``threshold`` of it makes a near-duplicate.  The
band is as wide as an alignment that good can stray, so the verification is exact.  Pairs whose lengths or
counts of words rule it out (both exactly) are not aligned.  Groups are the connected
components of verified pairs; texts with the same words are one class from the start.

Within a bucket every text is compared with one head (its least id), and with the least of
its heads first: most members of a group of copies are then of one class, and only texts of
another class than their head (and not unlike the same one) are compared further.  That is all for a group
of any size whose members are like its head.  Where some are not, members
get keys anew, which only those compared with the same head share: sketches of the k-mers that
the head lacks (two texts that only share a common passage with the head do
not meet again, two copies of one another do), and, for texts that the head nearly contains, sketches of
all their k-mers.  That is repeated until no bucket has two members; every level leaves its heads
behind, so a bucket of any size costs a comparison a member and level, not one a pair.
Texts that the pairs verified so far put into one class, by whatever chain of likeness, are not compared again:
``n_links`` counts the links that the classes needed, not all that there are inside a class.

Sketches: a pair in which a tenth of the words differ shares 0.42 of its k-mers and so one key
with probability 0.18; it misses all 64 keys once in 10^5 times.  With a fifth of the
words differing, all at random places, it is 0.04 a key and 0.93 in all.

Defined results: null counts as empty; texts without words are not near-duplicates of
one another (each is its own group); texts of under five words have one k-mer of all
their words; repeated rows are one group; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_arrow, may_have_key, staged, text_or_empty

SKETCHES = 64
REST_SKETCHES = 32
PICKS = 2
KMER = 5
THRESHOLD = 0.8
BLOCK = 4_096
HOT = 1_024
FEW = 2_048


@lru_cache(maxsize=4)
def _functions(sketches: int):
    rng = np.random.Generator(np.random.PCG64(7_301))
    high = np.iinfo(np.uint64).max
    return rng.integers(1, high, sketches, dtype=np.uint64) | np.uint64(1), rng.integers(0, high, sketches, dtype=np.uint64)


def label_occurrences(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each k-mer's hash with the number of its occurrence in its own text mixed in."""
    from .shingles import mix

    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    keys = mix(hashes + owner * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    at = np.arange(len(keys))
    number = np.empty(len(keys), dtype=np.uint64)
    number[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return mix(hashes ^ (number * np.uint64(0xC2B2AE3D27D4EB4F)))


def _least(values: np.ndarray, places: np.ndarray, picks: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``picks`` least values of each row and their places (``values`` is used up)."""
    if values.shape[1] <= picks:
        return values, places
    rows = np.arange(len(values))
    out, at = np.empty((len(values), picks), np.uint64), np.empty((len(values), picks), np.int64)
    for k in range(picks):
        low = values.argmin(axis=1)
        out[:, k], at[:, k] = values[rows, low], places[rows, low]
        values[rows, low] = np.iinfo(np.uint64).max
    return out, at


def order_sketch(labelled: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """One key a sketch of a single text."""
    from .shingles import mix

    a, b = _functions(sketches)
    least = places = None
    for low in range(0, len(labelled), BLOCK):
        part = labelled[low : low + BLOCK]
        values = a[:, None] * part[None, :]
        values += b[:, None]
        values, at = _least(values, np.broadcast_to(np.arange(low, low + len(part)), values.shape), picks)
        if least is not None:
            values, at = _least(np.concatenate([least, values], 1), np.concatenate([places, at], 1), picks)
        least, places = values, at
    picked = labelled[np.sort(places, axis=1)]  # in the order of the text
    key = np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(picked.shape[1]):
        key = mix((key ^ picked[:, k]) * np.uint64(0xE7037ED1A0B428DB))
    return key


def _sketch_rows(batches, sketches: int, picks: int, size: int):
    import hashlib

    import pyarrow as pa

    from .shingles import shingle_hashes, word_hashes
    from .tokens import slices

    kind = pa.list_(pa.int64())
    for batch in batches:
        ids = batch.column("doc_id")
        for first, part in slices(batch.column("text").to_pylist(), 1_000_000):
            hashes, counts = shingle_hashes(part, size)
            labelled = label_occurrences(hashes, counts)
            words, n_words = word_hashes(part)
            same, keys, at, word_at = [], [], 0, 0
            for n, w in zip(counts, n_words):
                if w:
                    same.append(hashlib.blake2b(words[word_at : word_at + w].tobytes(), digest_size=16).digest())
                    keys.append(order_sketch(labelled[at : at + n], sketches, picks).view(np.int64))
                else:
                    same.append(None)
                    keys.append([])
                at, word_at = at + n, word_at + w
            yield pa.RecordBatch.from_arrays([ids.slice(first, len(part)), pa.array(same, pa.binary()), pa.array([int(w) for w in n_words], pa.int64()), pa.array(keys, kind)], ["doc_id", "same", "n", "keys"])


def aligned_words(x: np.ndarray, y: np.ndarray, need: int) -> int:
    """The most words (as hashes) that can be aligned in order, if that is ``need`` or more; else less than ``need``.

    Common starts and ends are aligned first (that is never worse), words that the other side
    lacks are left out.  What remains is a longest common subsequence inside the band that ``need`` allows.
    """
    n = min(len(x), len(y))
    if n < need:
        return 0
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    done = head + tail
    if not len(x) or not len(y):
        return done
    x_kept, y_kept = np.flatnonzero(np.isin(x, y)), np.flatnonzero(np.isin(y, x))
    if done + min(len(x_kept), len(y_kept)) < need:
        return 0
    # so many of x may stay alone, and as many of y: an alignment that good is never further off the diagonal
    return done + banded_lcs(x[x_kept].tolist(), x_kept, y[y_kept].tolist(), y_kept, len(x) + done - need, len(y) + done - need)


def banded_lcs(x: list[int], x_at: np.ndarray, y: list[int], y_at: np.ndarray, lone_x: int, lone_y: int) -> int:
    """Longest common subsequence of matches with -lone_x <= y place - x place <= lone_y.

    A row of the table is one long integer, a bit a place of ``x`` inside the band (0 where
    the length rises); a word of ``y`` moves the band and costs a few operations on it.
    """
    low_of = np.searchsorted(x_at, y_at - lone_y, side="left").tolist()
    high_of = np.searchsorted(x_at, y_at + lone_x, side="right").tolist()
    places: dict[int, int] = {}
    for i, value in enumerate(x):
        places[value] = places.get(value, 0) | 1 << i
    row, low, high, left = 0, 0, 0, 0  # the band is [low, high) of x; ``left`` rises lie before it
    for value, new_low, new_high in zip(y, low_of, high_of):
        if new_high > high:
            row |= ((1 << (new_high - high)) - 1) << (high - low)
            high = new_high
        if new_low > low:
            gone = (1 << (new_low - low)) - 1
            left += (new_low - low) - (row & gone).bit_count()
            row >>= new_low - low
            low = new_low
        hit = row & (places[value] >> low)
        if hit:
            row = ((row + hit) | (row - hit)) & ((1 << (high - low)) - 1)
    return left + (high - low) - row.bit_count()


def _common(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> int:
    """How many words two texts share, of their (distinct hashes, counts): no alignment has more."""
    at = np.searchsorted(y[0], x[0])
    at[at == len(y[0])] = 0
    same = y[0][at] == x[0]
    return int(np.minimum(x[1][same], y[1][at[same]]).sum())


class _Text:
    """What comparisons need of a text, each made when it is first asked for."""

    def __init__(self, text: str, size: int):
        from .shingles import word_hashes

        self.text, self.size = text, size
        self.words = word_hashes([text])[0]
        self.counts = np.unique(self.words, return_counts=True)
        self._kmers = self._distinct = None

    @property
    def kmers(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, hashes with labels) of its k-mers in order."""
        if self._kmers is None:
            from .shingles import shingle_hashes

            hashes, counts = shingle_hashes([self.text], self.size)
            self._kmers = hashes, label_occurrences(hashes, counts)
        return self._kmers

    def distinct(self) -> np.ndarray:
        if self._distinct is None:
            self._distinct = np.unique(self.kmers[0])
        return self._distinct

    def likeness(self, other: "_Text", threshold: float) -> float:
        """2 * aligned words / (words of both); 0 where that is under the threshold."""
        both = len(self.words) + len(other.words)
        need = int(np.ceil(threshold * both / 2 - 1e-9))
        if not len(self.words) or not len(other.words) or _common(self.counts, other.counts) < need:
            return 0.0
        found = aligned_words(self.words, other.words, need)
        return 2 * found / both if found >= need else 0.0

    def keys_beside(self, head: "_Text", threshold: float, sketches: int, picks: int) -> np.ndarray:
        """Keys for texts unlike the same head: of the k-mers that it lacks, and of all where it nearly contains this text."""
        hashes, labelled = self.kmers
        rest = labelled[~np.isin(hashes, head.kmers[0])]
        found = [order_sketch(rest, sketches, picks)] if len(rest) else []
        need = int(np.ceil(threshold * len(self.words) - 1e-9))
        if _common(self.counts, head.counts) >= need and aligned_words(self.words, head.words, need) >= need:
            found.append(~order_sketch(labelled, sketches, picks))
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


def similarity(a: str, b: str, threshold: float = THRESHOLD, size: int = KMER) -> float:
    """2 * aligned words / (words of both); 0 where that is under the threshold."""
    return _Text(a, size).likeness(_Text(b, size), threshold)


def aligned(a: _Text, b: _Text, threshold: float) -> float:
    return a.likeness(b, threshold)


def jaccard(a: _Text, b: _Text, threshold: float) -> float:
    """Of the sets of k-mers; 0 where it is under the threshold."""
    x, y = a.distinct(), b.distinct()
    if min(len(x), len(y)) < threshold * max(len(x), len(y)) - 1e-9:
        return 0.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    found = both / (len(x) + len(y) - both)
    return found if found >= threshold else 0.0


def _verify_rows(batches, like, threshold: float, size: int, sketches: int, picks: int):
    import xxhash

    import pyarrow as pa

    from .shingles import mix

    head_id = head = salt = None
    for batch in batches:
        found, keys, n = [], [], []
        for member, other, other_text, again in zip(*(batch.column(c).to_pylist() for c in ("text", "head", "head_text", "again"))):
            if other != head_id:
                head_id, head, salt = other, _Text(other_text, size), np.uint64(xxhash.xxh3_64_intdigest(str(other)))
            own = _Text(member, size)
            found.append(like(own, head, threshold))
            keys.append(mix(own.keys_beside(head, threshold, sketches, picks) ^ salt).view(np.int64) if again else [])
            n.append(len(own.words))
        columns = [batch.column("doc_id"), batch.column("head"), batch.column("again"), pa.array(n, pa.int64()), pa.array(found, pa.float64()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "head", "again", "n", "similarity", "keys"])


def _heads(keys: DataFrame, name: str, by_hash: bool, carried: tuple[str, ...] = ()) -> DataFrame:
    """(key, head, again) of the keys (doc_id, key) that several texts have; the head is the bucket's least id or the id of least hash,
    and what it has in the columns ``carried`` comes with it as head_<column>.

    ``again``: the bucket has others that may be unlike the head.  The heads are a stored table,
    so that the join deals both sides by itself and Spark can split a key that very many have.
    """
    least = F.min(F.struct(F.xxhash64("doc_id", F.lit(17)).alias("o"), "doc_id", *carried) if by_hash else "doc_id")
    heads = keys.groupBy("key").agg(least.alias("head"), F.count("*").alias("many")).where("many > 1")
    own = [F.col("head.doc_id").alias("head"), *(F.col(f"head.{c}").alias(f"head_{c}") for c in carried)] if by_hash else ["head"]
    return staged(heads.select("key", *own, (F.col("many") > 2).alias("again")), f"{name}-heads")


def _possible(threshold: float):
    """Not of pairs whose numbers of words ``n`` and ``head_n`` rule them out and that need no keys."""
    return F.col("again") | (2 * F.least("n", "head_n") >= (F.col("n") + F.col("head_n")) * F.lit(threshold) - F.lit(1e-9))


def _first_pairs(keys: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, head, again, first) of the possible pairs of a text and a bucket's least id; ``first``: it is the least head of that text."""
    met = keys.join(_heads(keys, "op3", by_hash=False), "key").select("doc_id", "head", "again").where("doc_id <> head")
    pairs = met.repartition("doc_id").groupBy("doc_id", "head").agg(F.max("again").alias("again"))
    pairs = pairs.join(sizes, "doc_id").join(sizes.toDF("head", "head_n"), "head").where(_possible(threshold)).select("doc_id", "head", "again")
    least = F.min("head").over(Window.partitionBy("doc_id"))
    return staged(pairs.withColumn("first", F.col("head") == least), "op3-pairs")


def _verified(pairs: DataFrame, rows: DataFrame, like, threshold: float, size: int, sketches: int, picks: int, name: str) -> DataFrame:
    """pairs with the text's number of words, their similarity (0 below the threshold) and, of those below, keys; staged.  Texts that are in no pair are not shuffled."""
    kind = pairs.schema["doc_id"].dataType.simpleString()
    heads = pairs.select(F.col("head").alias("doc_id")).distinct()
    members = may_have_key(rows, pairs, "doc_id")
    head_texts = may_have_key(rows, heads, "doc_id").select(F.col("doc_id").alias("head"), F.col("text").alias("head_text"))
    # the member's text goes to its pairs first: the head of a large group is split by Spark's skewed join
    texts = pairs.join(members, "doc_id").join(head_texts, "head")
    schema = f"doc_id {kind}, head {kind}, again boolean, n long, similarity double, keys array<long>"
    return staged(map_arrow(texts.select("doc_id", "head", "again", "text", "head_text"), lambda it: _verify_rows(it, like, threshold, size, sketches, picks), schema), name)


def _hot(stored: DataFrame, on: str) -> DataFrame:
    """``_hot_of`` the rows of a stored table."""
    counts = stored.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"))
    return _hot_of(counts, on, "_n", stored.count())


def _hot_of(counts: DataFrame, on: str, n: str, rows: int) -> DataFrame:
    """(on, _salts) of the keys that one in ``HOT`` of ``rows`` rows or more have, so ``HOT`` keys at most; ``n`` is the count of a key.

    ``_salts`` is the number of parts in which such a key is as large as the least hot one: 2 * ``HOT`` in all.
    """
    share = F.col(n) * F.lit(HOT)
    return counts.where(share >= F.lit(rows)).select(on, F.ceil(share / F.lit(max(rows, 1))).cast("int").alias("_salts"))


def _salted(df: DataFrame, hot: DataFrame, on: str) -> DataFrame:
    """``df`` with a column ``_salt`` from the id, which spreads the rows that share a hot key, and those without a key."""
    parts = F.when(F.col(on).isNull(), F.lit(1 << 20)).otherwise(F.coalesce("_salts", F.lit(1)))
    salt = F.pmod(F.xxhash64("doc_id", F.lit(19)), parts).cast("int")
    return df.join(F.broadcast(hot), on, "left").withColumn("_salt", salt).drop("_salts")


def _each_salt(df: DataFrame, hot: DataFrame, on: str) -> DataFrame:
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return df.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(salts)).drop("_salts")


def components(links: DataFrame, name: str) -> DataFrame:
    """(doc_id, class_id): the least id of the connected component, of each id in ``links``
    (doc_id, head).  Rounds of hooking to the least neighbour and halving the way to
    the root: as many as the logarithm of the longest way, each a staged table."""
    edges = staged(links.select("doc_id", "head").union(links.select("head", "doc_id")).toDF("doc_id", "other").distinct(), f"{name}-edges")
    # edges go both ways: an id stands as often on this side as on the other
    salts = F.ceil(F.count("*") * F.lit(HOT) / F.lit(max(edges.count(), 1))).cast("int")
    labels = staged(edges.groupBy("doc_id").agg(F.least(F.min("other"), F.first("doc_id")).alias("class_id"), salts.alias("_salts")), f"{name}-labels")
    ids = labels.count()
    hot = labels.where("_salts > 1").select(F.col("doc_id").alias("other"), "_salts")
    edges = staged(_salted(edges, hot, "other"), f"{name}-salted")
    while True:
        ends = labels.select(F.col("doc_id").alias("other"), "class_id", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
        near = edges.join(ends, ["other", "_salt"]).groupBy("doc_id").agg(F.min("class_id").alias("near"))
        hooked = labels.join(near, "doc_id").select("doc_id", F.least("class_id", "near").alias("class_id"), "_salts", (F.col("near") < F.col("class_id")).alias("moved"))
        hooked = staged(hooked, f"{name}-hooked")
        if hooked.where("moved").isEmpty():
            return hooked.select("doc_id", "class_id")
        hot_class = _hot_of(hooked.groupBy("class_id").agg(F.count("*").alias("_n")), "class_id", "_n", ids)
        jump = _each_salt(hooked.select(F.col("doc_id").alias("class_id"), F.col("class_id").alias("beyond")), hot_class, "class_id")
        after = _salted(hooked.withColumnRenamed("_salts", "_own"), hot_class, "class_id").join(jump, ["class_id", "_salt"], "left")
        labels = staged(after.select("doc_id", F.least("class_id", "beyond").alias("class_id"), F.col("_own").alias("_salts")), f"{name}-labels")


def _roots(edges: list[tuple]) -> list[tuple]:
    """(id, least id of its connected component) of every id in ``edges``."""
    above: dict = {}

    def root(x):
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        above[high] = low
    return [(x, root(x)) for x in list(above)]


def _merged(classes: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
    """(doc_id, class_id) of each id in ``links`` (doc_id, head) or in ``classes``, those of all links before; stored.

    Only links between different classes count, as edges between these classes.  They are the fewer the later
    the level: up to ``FEW`` of them are followed on the driver, more by ``components``.
    """
    if classes is None:
        return components(links, name)
    spark, kind = links.sparkSession, links.schema["doc_id"].dataType.simpleString()
    of = lambda end: classes.select(F.col("doc_id").alias(end), F.col("class_id").alias(f"{end}_class"))
    ends = links.join(of("doc_id"), "doc_id", "left").join(of("head"), "head", "left")
    ends = ends.select(F.coalesce("doc_id_class", "doc_id").alias("doc_id"), F.coalesce("head_class", "head").alias("head"))
    edges = staged(ends.where("doc_id <> head").distinct(), f"{name}-between")
    few = [tuple(r) for r in edges.limit(FEW + 1).collect()]
    if not few:
        return classes
    if len(few) <= FEW:
        moved = spark.createDataFrame(_roots(few), f"class_id {kind}, least {kind}")
        after = classes.join(F.broadcast(moved), "class_id", "left")
    else:
        moved = components(edges, name).toDF("class_id", "least")
        hot = _hot(classes, "class_id")
        after = _salted(classes, hot, "class_id").join(_each_salt(moved, hot, "class_id"), ["class_id", "_salt"], "left")
    fresh = moved.join(classes.select(F.col("doc_id").alias("class_id")), "class_id", "left_anti").toDF("doc_id", "class_id")
    return staged(after.select("doc_id", F.coalesce("least", "class_id").alias("class_id")).union(fresh), f"{name}-classes")


def _links(keys: DataFrame, rows: DataFrame, sizes: DataFrame, like, threshold: float, size: int, picks: int) -> tuple[DataFrame, DataFrame] | None:
    """(doc_id, head) of all verified pairs, level after level, and (doc_id, class_id) of their texts; None if there are no pairs."""

    def verified(pairs):
        return _verified(pairs.select("doc_id", "head", "again"), rows, like, threshold, size, REST_SKETCHES, picks, "op3-checked")

    pairs = _first_pairs(keys, sizes, threshold)
    if pairs.isEmpty():
        return None
    # of each text the pair with its least head first; texts like, or unlike, one least head need no other pair
    level = verified(pairs.where("first"))
    known = level.select("doc_id", F.when(F.col("similarity") > 0, F.col("head")).alias("like"), F.when((F.col("similarity") == 0) & F.col("again"), F.col("head")).alias("unlike"))
    level = level.unionByName(verified(staged(_apart(pairs.where("NOT first"), known), "op3-others")))
    done, links = level.select("doc_id", "head", "again"), level.where("similarity > 0").select("doc_id", "head")
    classes = _merged(None, links, "op3")
    while True:
        # a head that all are like needs no further look at its texts
        mixed = level.where("similarity = 0 AND again").select("head").distinct()
        own = classes.withColumnRenamed("class_id", "own")
        kept = level.where("size(keys) > 0").join(mixed, "head", "left_semi").join(own, "doc_id", "left")
        beside = staged(kept.select("doc_id", "n", F.coalesce("own", "doc_id").alias("own"), F.explode("keys").alias("key")).distinct(), "op3-beside")
        met = beside.join(_heads(beside, "op3", by_hash=True, carried=("n", "own")), "key").where("doc_id <> head AND own <> head_own").where(_possible(threshold))
        had = done.groupBy("doc_id", "head").agg(F.max("again").alias("had"))
        fresh = met.groupBy("doc_id", "head").agg(F.max("again").alias("again")).join(had, ["doc_id", "head"], "left").where("had IS NULL OR (again AND NOT had)").drop("had")
        fresh = staged(fresh, "op3-fresh")
        if fresh.isEmpty():
            return links, classes
        level = verified(fresh)
        done, alike = done.unionByName(level.select("doc_id", "head", "again")), level.where("similarity > 0").select("doc_id", "head")
        links, classes = links.unionByName(alike), _merged(classes, alike, "op3")


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """``pairs`` (a stored table) without those of which is known (doc_id, like, unlike) that both are like one text, or unlike one."""
    hot = _hot(pairs, "head")
    own = pairs.join(known, "doc_id", "left").select("doc_id", "head", "again", F.coalesce("like", "doc_id").alias("own"), F.col("unlike").alias("own_unlike"))
    of_head = known.select(F.col("doc_id").alias("head"), F.col("like").alias("other"), F.col("unlike").alias("other_unlike"))
    own, of_head = _salted(own, hot, "head"), _each_salt(of_head, hot, "head")
    both = own.join(of_head, ["head", "_salt"], "left").where(F.col("own") != F.coalesce("other", "head"))
    return both.where("coalesce(own_unlike <> other_unlike, true)").select("doc_id", "head", "again")


def near_groups(docs: DataFrame, threshold: float = THRESHOLD, sketches: int = SKETCHES, picks: int = PICKS, size: int = KMER) -> DataFrame:
    """doc_id, class_id (least id of the group), n_links (verified links of its words' class), kept, of every row."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = staged(map_arrow(rows, lambda it: _sketch_rows(it, sketches, picks, size), f"doc_id {kind}, same binary, n long, keys array<long>"), "op3-sketches")
    return classes_of(found, rows, aligned, threshold, size, picks)


def classes_of(found: DataFrame, rows: DataFrame, like, threshold: float, size: int, picks: int = PICKS) -> DataFrame:
    """doc_id, class_id, n_links, kept of ``found`` (doc_id, same, n, keys), a stored table.

    Rows of equal ``same`` are one class from the start (null: alone); texts that share a key are compared by ``like``.
    """
    same = found.where("same IS NOT NULL").groupBy("same").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    same = staged(same, "op3-same")
    # only words that several rows have need a look at their first row; frequent ones are spread
    hot = _hot_of(same.where("n > 1"), "same", "n", found.count())
    several = _each_salt(same.where("n > 1").drop("n"), hot, "same")
    copies = _salted(found.select("doc_id", "same"), hot, "same").join(several, ["same", "_salt"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
    reps = found.where("same IS NOT NULL").join(same.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = reps.select("doc_id", "n", "keys")
    found = _links(reps.select("doc_id", F.explode("keys").alias("key")), rows, staged(reps.select("doc_id", "n"), "op3-sizes"), like, threshold, size, picks)
    if found is None:
        return copies.select("doc_id", F.col("rep").alias("class_id"), F.lit(0).cast("long").alias("n_links"), (F.col("doc_id") == F.col("rep")).alias("kept"))
    links, classes = found
    links = staged(links.distinct(), "op3-links")
    degree = links.select("doc_id").union(links.select("head")).groupBy("doc_id").agg(F.count("*").alias("n_links"))
    of_rep = classes.join(degree, "doc_id", "left").select(F.col("doc_id").alias("rep"), "class_id", "n_links")
    hot = hot.join(same.select("same", "rep"), "same").select("rep", "_salts")
    joined = _salted(copies, hot, "rep").join(_each_salt(of_rep, hot, "rep"), ["rep", "_salt"], "left")
    return joined.select("doc_id", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (F.col("doc_id") == F.coalesce("class_id", "rep")).alias("kept"))


def drop_near_copies(docs: DataFrame, **how) -> DataFrame:
    """Of each group of ``docs`` (unique ids) the row of least id, with all its columns."""
    kept = near_groups(docs, **how).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi")
