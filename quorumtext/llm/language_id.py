"""Operator 10: language identification by prediction by partial matching.

For each language a context tree over the bytes of its sample counts which byte follows
which context of 0 to ``order`` bytes.  The statistics are then frozen.  The code length
of a byte is -log2 of its probability after the longest known context; a byte that was
never seen there costs the escape (method C: distinct followers / (followers +
distinct followers)) and is coded after the context one byte shorter, with the
followers that the longer one has ruled out excluded exactly, down to a uniform code
over 256 bytes.  A text's score for a language is the exact sum over all its bytes
(lower case, runs of white space as one space).

All trees share one set of contexts, so that a byte's code lengths under every language
are one row of a table that each worker makes once from the counts; whole texts are
scored in numpy without sampling.

Training takes a bounded sample: per language, of the training rows, those of least
hash until ``sample_chars`` code points (of a longer text, as many blocks of it from all over, by a hash of
their place); the bound is a parameter, as is the size of the frozen statistics: of the contexts of two
and three bytes the ``contexts`` most frequent of each.

Defined results: null texts and texts without a letter (Unicode's letter categories: no
digits, fractions or Roman numeral signs) are ``und`` with score 0; ties
go to the language that sorts first; with no training rows everything is ``und``;
repeated rows are scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_arrow, may_have_key

ORDER = 3
SAMPLE_CHARS = 600_000
CONTEXTS = 24_000
UNDETERMINED = "und"
BLOCK = 262_144
SAMPLE_BLOCK = 4_096


def normal(text: str) -> bytes:
    return b" " * ORDER + " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


class ByteTrees:
    """Frozen context trees of several languages over shared contexts.

    ``grams[k]``: the (k+1)-byte strings (as numbers, last byte lowest) that occur after kept
    contexts of k bytes; ``counts[k]``: how often, one column a language.
    """

    def __init__(self, languages: list[str], order: int, grams: list[np.ndarray], counts: list[np.ndarray]):
        self.languages, self.order, self.grams, self.counts = languages, order, grams, counts
        self._tables = None

    def __getstate__(self):
        return self.languages, self.order, self.grams, self.counts

    def __setstate__(self, state):
        self.__init__(*state)

    @classmethod
    def learn(cls, samples: dict[str, list[bytes]], order: int = ORDER, contexts: int = CONTEXTS) -> "ByteTrees":
        languages = sorted(samples)
        found: list[dict] = []
        for language in languages:
            by_length = []
            joined = [np.frombuffer(t, dtype=np.uint8).astype(np.uint64) for t in samples[language]]
            for k in range(order + 1):
                keys = []
                for b in joined:
                    n = len(b) - order
                    key = np.zeros(max(0, n), dtype=np.uint64)
                    for back in range(k, -1, -1):
                        key = (key << np.uint64(8)) | b[order - back : order - back + n]
                    keys.append(key)
                by_length.append(np.unique(np.concatenate(keys or [np.zeros(0, np.uint64)]), return_counts=True))
            found.append(by_length)
        grams, counts = [], []
        for k in range(order + 1):
            every = np.unique(np.concatenate([f[k][0] for f in found])) if found else np.zeros(0, np.uint64)
            table = np.zeros((len(every), len(languages)), dtype=np.int64)
            for column, f in enumerate(found):
                table[np.searchsorted(every, f[k][0]), column] = f[k][1]
            grams.append(every)
            counts.append(table)
        # the most frequent contexts of the longest kind are kept; shorter ones are few
        for k in range(2, order + 1):
            context, inverse = np.unique(grams[k] >> np.uint64(8), return_inverse=True)
            uses = np.bincount(inverse, weights=counts[k].sum(1), minlength=len(context))
            if len(context) > contexts:
                least = np.partition(uses, len(uses) - contexts)[len(uses) - contexts]
                keep = (uses >= least)[inverse]
                grams[k], counts[k] = grams[k][keep], counts[k][keep]
        return cls(languages, order, grams, counts)

    def tables(self):
        """(symbols, children by order, cost): byte to symbol; for each order the row of a
        context from the row of the one byte shorter and the next byte back; bits of (context row, symbol, language)."""
        if self._tables is None:
            self._tables = self._build()
        return self._tables

    def _build(self):
        many = len(self.languages)
        seen = np.unique(self.grams[0]).astype(np.int64)
        symbols = np.full(256, len(seen), dtype=np.int64)  # bytes that no sample has share the last symbol
        symbols[seen] = np.arange(len(seen))
        width = len(seen) + 1
        blank = max(1, 256 - len(seen))
        # probability of each symbol, language; the last symbol's is that of each single unseen byte
        rows = [np.full((1, width, many), 1 / 256)]
        weight = np.ones(width)
        weight[-1] = blank
        children = []
        known: dict[int, int] = {}
        contexts_before = np.zeros(1, dtype=np.uint64)
        parent_rows = np.zeros(1, dtype=np.int64)
        total = 1
        row_of = {(): 0}
        all_rows = []
        for k in range(self.order + 1):
            gram, count = self.grams[k], self.counts[k]
            context, inverse = np.unique(gram >> np.uint64(8), return_inverse=True)
            if k == 0:
                base = rows[0]  # order -1
                parents = np.zeros(len(context), dtype=np.int64)
                parent_probability = base
            else:
                # the parent drops the byte furthest back
                shorter = context & np.uint64(256 ** (k - 1) - 1) if k > 1 else np.zeros(len(context), np.uint64)
                at = np.searchsorted(contexts_before, shorter)
                assert (contexts_before[at] == shorter).all()
                parents = at
                parent_probability = last
            inherited = parent_probability[parents]
            table = np.zeros((len(context), width, many))
            symbol = symbols[(gram & np.uint64(255)).astype(np.int64)]
            table[inverse, symbol] = count
            follow, distinct = table.sum(1), (table > 0).sum(1)
            whole = follow + distinct
            ruled_out = np.where(table > 0, inherited * weight[None, :, None], 0).sum(1)
            escape = np.where(follow > 0, distinct / np.maximum(whole, 1) / np.maximum(1 - ruled_out, 1e-9), 1.0)
            # a language that never saw the context codes as after the shorter one
            last = np.where(table > 0, table / np.maximum(whole, 1)[:, None, :], inherited * escape[:, None, :])
            if k:
                back = ((context >> np.uint64(8 * (k - 1))) & np.uint64(255)).astype(np.int64)
                child = np.full((len(all_rows[-1]) if k > 1 else 1, width), -1, dtype=np.int32)
                child[parents, symbols[back]] = np.arange(len(context))
                children.append(child)
            all_rows.append(last)
            contexts_before = context
        starts = np.cumsum([0, *[len(r) for r in all_rows]])
        cost = np.concatenate([-np.log2(np.maximum(r, 1e-12)) for r in all_rows]).astype(np.float32)
        return symbols.astype(np.int32), children, starts, cost.reshape(-1, many), width

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): the code length of each text (as ``normal`` gives it) under each language."""
        symbols, children, starts, cost, width = self.tables()
        out = np.zeros((len(texts), len(self.languages)))
        every = np.frombuffer(b"".join(texts), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        first_byte = ends - lengths + self.order
        for low in range(self.order, len(every), BLOCK):
            high = min(len(every), low + BLOCK)
            symbol = symbols[every[low - self.order : high]]
            n = high - low
            coded = symbol[self.order :]
            row = np.zeros(n, dtype=np.int64)  # in the order it was found at
            place = np.zeros(n, dtype=np.int64)
            live = None
            for k, child in enumerate(children, 1):
                back = symbol[self.order - k : self.order - k + n]
                if live is None:
                    row = child.ravel()[back].astype(np.int64)
                    good = row >= 0
                else:
                    stepped = child.ravel()[row * width + back]
                    good = live & (stepped >= 0)
                    row = np.where(good, stepped, 0)
                place = np.where(good, row + starts[k], place)
                row = np.where(good, row, 0)
                live = good
            value = cost[place * width + coded]
            first, last = np.searchsorted(ends, [low, high - 1], side="right")
            # the bytes before a text's first one are blanks that only give it a context
            skip_from = np.maximum(first_byte[first : last + 1] - self.order - low, 0)
            skip_to = np.clip(first_byte[first : last + 1] - low, 0, n)
            for a, b in zip(skip_from, skip_to):
                if b > a:
                    value[a:b] = 0
            cuts = np.maximum(ends[first : last + 1] - lengths[first : last + 1] - low, 0)
            out[first : last + 1] += np.add.reduceat(value, cuts, axis=0, dtype=np.float64)
        return out


def training_sample(docs: DataFrame, sample_chars: int) -> dict[str, list[bytes]]:
    """Per language, texts in the order of a hash of the id until ``sample_chars`` code points."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(10))
    sized = rows.select("doc_id", "lang", F.length("text").alias("n"), order.alias("order")).where("n > 0")
    # the ranges of the hash that hold the sample, from the lengths of all rows, before rows are sorted: at most 65,536 sums a language
    ranged = sized.withColumn("range", F.shiftright("order", 48))
    sums = ranged.groupBy("lang", "range").agg(F.sum("n").alias("range_n"))
    so_far = F.sum("range_n").over(Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    needed = sums.withColumn("so_far", F.coalesce(so_far, F.lit(0))).where(F.col("so_far") < sample_chars).select("lang", "range")
    few = ranged.join(needed, ["lang", "range"])
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = few.withColumn("before", before).where(F.col("before") < sample_chars).select("doc_id", F.col("lang").alias("language"))
    # a text longer than the bound gives blocks from all over it: the sample, not the scoring, is bounded
    block, many = min(SAMPLE_BLOCK, sample_chars), sample_chars // min(SAMPLE_BLOCK, sample_chars)
    places = f"sort_array(transform(slice(sort_array(transform(sequence(0L, (length(text) - 1L) div {block}), i -> struct(xxhash64(i, 10) AS h, i AS i))), 1, {many}), x -> x.i))"
    sampled = F.expr(f"CASE WHEN length(text) <= {sample_chars} THEN text ELSE array_join(transform({places}, i -> substring(text, int(i * {block}) + 1, {block})), ' ') END")
    texts = may_have_key(docs.select("doc_id", "text"), chosen, "doc_id").join(chosen, "doc_id").select("doc_id", "language", sampled.alias("text"))
    found: dict[str, list[bytes]] = {}
    for row in texts.select("language", "doc_id", "text").sort("language", "doc_id").collect():
        found.setdefault(row["language"], []).append(normal(row["text"]))
    return found


def train(docs: DataFrame, order: int = ORDER, sample_chars: int = SAMPLE_CHARS, contexts: int = CONTEXTS) -> ByteTrees:
    return ByteTrees.learn(training_sample(docs, sample_chars), order, contexts)


def posterior(bits: np.ndarray) -> np.ndarray:
    """Of languages that are as likely before the text is seen."""
    odds = np.exp2(-(bits - bits.min(axis=1, keepdims=True)))
    return odds / odds.sum(axis=1, keepdims=True)


_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a letter stands in the text; ``\\w`` alone also takes fractions, powers and Roman numeral signs."""
    return any(x.group().isalpha() for x in _WORDLIKE.finditer(text))


def _score_rows(batches, trees):
    import pyarrow as pa

    from .tokens import slices

    for batch in batches:
        for first, part in slices(batch.column("text").to_pylist() if batch.num_rows else []):
            model = trees.value
            named, score, rate = [UNDETERMINED] * len(part), [0.0] * len(part), [0.0] * len(part)
            good = [i for i, t in enumerate(part) if t and has_letter(t)]
            if good and model.languages:
                bits = model.bits([normal(part[i]) for i in good])
                odds, best = posterior(bits), bits.argmin(axis=1)
                for i, k, o, b in zip(good, best, odds, bits):
                    named[i], score[i], rate[i] = model.languages[k], float(o[k]), float(b[k]) / max(1, len(part[i].encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(part)), pa.array(named), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], ["doc_id", "lang_pred", "score", "bits_per_byte"])


def identify(docs: DataFrame, trees: ByteTrees) -> DataFrame:
    """doc_id, lang_pred, score (posterior), bits_per_byte of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(text, lambda it: _score_rows(it, shared), f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")


def held_out(modulus: int, remainder: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder


def identify_held_out(docs: DataFrame, **how) -> DataFrame:
    """``identify`` with trees from the rows whose crc32(doc_id) mod 4 is not 2; held_out marks the others."""
    trees = train(docs.where(~held_out(4, 2)), **how)
    return identify(docs, trees).withColumn("held_out", held_out(4, 2)).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def keep_identified(docs: DataFrame, trees: ByteTrees) -> DataFrame:
    """The rows of ``docs`` (unique ids) that have a language, with all their columns."""
    rejected = identify(docs, trees).where(F.col("lang_pred") == UNDETERMINED).select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti")
