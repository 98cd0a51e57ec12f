"""Encoding with a public tokenizer file inside Spark workers.

A run of white space is a boundary that no token of a ``tokenizers`` file with a
word-level split and white space dropped can cross, in whichever text it stands.
So the ids of a text are the ids of its white-space-separated words in order, and
words repeat: each worker asks the library once for a word and remembers the answer.

A new word of Latin letters with ASCII punctuation after it (most are) is two pieces to
the tokenizer, the lower-case letters and the punctuation; many such pieces are given
to the library in one text and its answer is cut where pieces end (``</w>``).  Any
other word is given to the library by itself.
"""

from __future__ import annotations

import string
import unicodedata

from .common import single_thread

_PUNCTUATION = string.punctuation
_LATIN_END = "\u0250"
#: Words, and pieces, of one generation: with keys of at most 40 characters and about 200 bytes an entry, 4 x 100,000 take 80 MB a worker at most.
MEMO_WORDS = 100_000
MEMO_WORD_CHARS = 40


def tokenizer_path(name_or_path: str) -> str:
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


class Memo:
    """A bounded dict in two generations: when the young one is full it becomes the old
    one, and what is asked for again moves to the young one."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set) -> list:
        """The keys without an answer; the others are in ``young`` afterwards."""
        if len(self.young) + len(keys) > self.most:
            self.old, self.young = self.young, {}
        fresh = keys.difference(self.young)
        if self.old:
            held = fresh.intersection(self.old)
            self.young.update((k, self.old[k]) for k in held)
            fresh -= held
        return list(fresh)


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, name_or_path: str):
        single_thread()
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name_or_path))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.pieces = Memo(MEMO_WORDS), Memo(MEMO_WORDS)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in found]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Of pieces that the tokenizer does not divide: one text for all."""
        import numpy as np

        ids = np.asarray(self.tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(pieces):  # a piece was divided after all: each by itself
            return self._library(pieces)
        data, at = ids.tobytes(), [0, *(cuts * 4).tolist()]
        return [data[a:b] for a, b in zip(at, at[1:])]

    def _new_words(self, words: list[str]) -> list[bytes]:
        parts: list[tuple[str, str] | None] = []
        pieces: set[str] = set()
        for w in words:
            core = w.rstrip(_PUNCTUATION)
            low = core.lower()
            if low.isalpha() and len(w) <= MEMO_WORD_CHARS and (low.isascii() or max(low) < _LATIN_END and unicodedata.is_normalized("NFC", core)):
                tail = w[len(core) :]
                parts.append((low, tail))
                pieces.add(low)
                pieces.add(tail)
            else:
                parts.append(None)
        pieces.discard("")
        if fresh := self.pieces.missing(pieces):
            self.pieces.young.update(zip(fresh, self._piece_ids(fresh)))
        table = self.pieces.young
        other = iter(self._library([w for w, p in zip(words, parts) if p is None]))
        return [next(other) if p is None else table[p[0]] + table[p[1]] if p[1] else table[p[0]] for p in parts]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        long = [w for w in words if len(w) > MEMO_WORD_CHARS]
        fresh = self.words.missing(set(words).difference(long))
        young = self.words.young
        if fresh:
            young.update(zip(fresh, self._new_words(fresh)))
        if not long:
            return list(map(young.__getitem__, words))
        answers = dict(zip(long, self._library(long)))
        return [answers[w] if w in answers else young[w] for w in words]

    def encode(self, texts):
        """(ids of all texts in a row as uint32, how many each text has) of an Arrow string array without nulls.

        Words are found and made distinct in Arrow, so that Python sees each once.
        """
        import numpy as np
        import pyarrow.compute as pc

        split = pc.ascii_split_whitespace(texts)
        coded = split.values.dictionary_encode()
        blobs = self._word_ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
        joined = np.frombuffer(b"".join(blobs), dtype="<u4")
        word = coded.indices.to_numpy()
        size = sizes[word]
        ends = np.cumsum(size)
        shift = (np.cumsum(sizes) - sizes)[word] - (ends - size)
        ids = joined[np.repeat(shift, size) + np.arange(len(shift) and ends[-1])]
        at = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return ids, np.diff(at)

    def with_offsets(self, texts: list[str]) -> list[list[int]]:
        """The code point at which each token of each text starts."""
        return [[a for a, _ in x.offsets] for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(name_or_path: str) -> Encoder:
    """One encoder a worker process and file."""
    if name_or_path not in _ENCODERS:
        _ENCODERS[name_or_path] = Encoder(name_or_path)
    return _ENCODERS[name_or_path]


def forget() -> None:
    """Drops what this worker remembers; the next encoder begins anew."""
    _ENCODERS.clear()


def slices(items: list[str], most_chars: int = 4_000_000):
    """Consecutive (start, texts) of bounded total length; a longer text stands alone."""
    start, size = 0, 0
    for i, x in enumerate(items):
        if i > start and size + len(x) > most_chars:
            yield start, items[start:i]
            start, size = i, 0
        size += len(x)
    if start < len(items):
        yield start, items[start:]


def array_slices(texts, most_bytes: int = 8_000_000):
    """Consecutive (start, part) of an Arrow string array, of bounded total length."""
    import numpy as np
    import pyarrow.compute as pc

    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + most_bytes, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def gathered(batches, most_bytes: int = 8_000_000):
    """Arrow batches joined to about ``most_bytes``: in more text at once more words are repeated."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
