"""Operator 5: document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad.  What speaks for either are the line's own
features and those of the lines before and after it (shares of kinds of bytes, word
lengths, repeated words, repeated lines, length), and which label the line before has.
Forward-backward gives each line's probability of being good; the mean over the lines,
weighted by their length, is the document's quality, which a logistic curve fitted on the
training documents turns into the score.

The recursions are products of two-by-two matrices, taken for all lines of many
texts at once by doubling, so that a text of a million lines costs 20 passes, not a
million steps.

Training: of the labelled rows, at most ``train_docs`` documents of least hash; features are
made from whole texts, and a document of more than ``train_lines`` lines gives runs of ``RUN`` lines
from all over it, by a hash of their place, up to that number (both bounds are parameters).  Every line
first has its document's label.  After a first fit, lines that the field holds for the other kind with
probability ``RELABEL`` or more change theirs (never so many that the document would), and the field is
fitted again: so it sees how labels follow one another inside a document.  Scoring reads whole texts.

Defined results: null and empty texts are one line of no bytes, and get the score of
that; a text of blank lines alone has weight 1 on each; repeated rows are scored each; with
no labelled rows every score is 0.5; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import map_arrow, may_have_key
from .language_id import held_out

TRAIN_DOCS = 2_000
TRAIN_LINES = 120
RUN = 40
RELABEL = 0.9
PASSES = 150

_KIND = np.zeros(256, dtype=np.int8)  # 0 other symbol, 1 lower case or above ASCII, 2 upper case, 3 digit, 4 blank, 5 sentence mark, 6 rest of UTF-8
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[9, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:'\"?-()"]] = 5
_KIND[128:192] = 6
_KIND[192:] = 1
OWN = 14


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines, OWN) features, bytes of each line, lines of each text."""
    data = "\n".join(texts).encode("utf-8", "surrogatepass") + b"\n"
    every = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(every == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    kinds = _KIND[every]
    kinds[ends] = 7
    counts = np.stack([np.add.reduceat((kinds == k).astype(np.int32), starts) for k in range(7)], axis=1).astype(np.float64)
    other, low, up, digit, blank, mark, _ = counts.T
    chars = np.maximum(1, size - counts[:, 6])
    letters = np.maximum(1, low + up)
    n_lines, again, distinct, words_of, first_same = [], [], [], [], []
    for t in texts:
        lines = t.split("\n")
        n_lines.append(len(lines))
        seen: set[str] = set()
        for line in lines:
            words = line.split()
            again.append(line in seen)
            seen.add(line)
            words_of.append(len(words))
            distinct.append(len(set(words)))
    words, distinct = np.asarray(words_of, dtype=np.float64), np.asarray(distinct, dtype=np.float64)
    some = np.maximum(1, words)
    features = np.stack([
        np.ones(len(size)), np.log1p(size) / 5, other / chars, np.minimum(other / some, 3), up / letters, (up / letters) > 0.5, digit / chars, blank / chars,
        mark / some, np.minimum(chars / some, 20) / 10, np.where(words > 0, distinct / some, 1), np.log1p(words) / 4 * np.where(words > 0, 1 - distinct / some, 0), np.asarray(again, dtype=np.float64), size == 0,
    ], axis=1).astype(np.float64)
    return features, size, np.asarray(n_lines, dtype=np.int64)


def with_neighbours(own: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after (zeros past the ends)."""
    first = np.cumsum(n_lines) - n_lines
    last = first + n_lines - 1
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after], axis=1)


def _scan(m: np.ndarray, longest: int) -> np.ndarray:
    """Products m[0] .. m[t] of (n, 2, 2), each up to a factor, by doubling."""
    m, reach = m.copy(), 1
    while reach < longest:
        p = np.matmul(m[:-reach], m[reach:])
        p /= p.sum(axis=(1, 2), keepdims=True)
        m[reach:] = p
        reach *= 2
    return m


def marginals(emit: np.ndarray, trans: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the probabilities of (bad, good); of each line and the one before it those of the pairs (zeros at a text's first)."""
    n = len(emit)
    first = np.cumsum(n_lines) - n_lines
    last = first + n_lines - 1
    longest = int(n_lines.max(initial=1))
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    t = np.exp(trans)
    step = t[None, :, :] * e[:, None, :]
    forward = step.copy()
    forward[first] = e[first][:, None, :]  # both rows alike: whatever stands before is forgotten
    alpha = _scan(forward, longest)[:, 0, :]
    alpha /= alpha.sum(axis=1, keepdims=True)
    coming = np.empty_like(step)
    coming[:-1] = step[1:]
    coming[last] = 1.0
    # suffix products are prefix products of the transposes from the end
    beta = _scan(coming[::-1].transpose(0, 2, 1).copy(), longest)[::-1].transpose(0, 2, 1).sum(axis=2)
    one = alpha * beta
    one /= one.sum(axis=1, keepdims=True)
    pairs = np.zeros((n, 2, 2))
    pairs[1:] = alpha[:-1, :, None] * step[1:] * beta[1:, None, :]
    pairs[first] = 0
    total = pairs.sum(axis=(1, 2), keepdims=True)
    pairs /= np.where(total > 0, total, 1)
    return one, pairs


def gradient(x: np.ndarray, y: np.ndarray, n_lines: np.ndarray, weights: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean over the texts of log likelihood / lines: a document counts once, however many lines it has."""
    each = np.repeat(1 / n_lines, n_lines)[:, None]
    one, pairs = marginals(x @ weights, trans, n_lines)
    inner = np.ones(len(y), dtype=bool)
    inner[np.cumsum(n_lines) - n_lines] = False
    seen = np.zeros((2, 2))
    at = np.flatnonzero(inner)
    np.add.at(seen, (y[at - 1], y[at]), each[at, 0])
    return (x.T @ ((np.eye(2)[y] - one) * each)) / len(n_lines), (seen - (pairs * each[:, :, None]).sum(axis=0)) / len(n_lines)


def relabelled(one: np.ndarray, y: np.ndarray, size: np.ndarray, n_lines: np.ndarray, least: float = RELABEL) -> np.ndarray:
    """Labels of lines, changed where the marginals ``one`` speak for the other with ``least`` or more;
    a text in which half of the bytes or more would change keeps its own."""
    change = one[np.arange(len(y)), y] <= 1 - least
    first = np.cumsum(n_lines) - n_lines
    weight = size + 1.0
    most = np.add.reduceat(weight * change, first) < 0.5 * np.add.reduceat(weight, first)
    return np.where(change & np.repeat(most, n_lines), 1 - y, y)


class LineField:
    """Weights of the field and of the curve from mean marginal to score."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, mean: np.ndarray, scale: np.ndarray, curve: tuple[float, float]):
        self.weights, self.trans, self.mean, self.scale, self.curve = weights, trans, mean, scale, curve

    @classmethod
    def fit(cls, texts: list[str], labels: np.ndarray, passes: int = PASSES, decay: float = 2e-3) -> "LineField":
        own, size, n_lines = line_features(texts) if len(texts) else (np.zeros((0, OWN)), np.zeros(0), np.zeros(0, np.int64))
        return cls.fit_features(own, size, n_lines, labels, passes, decay)

    @classmethod
    def fit_features(cls, own: np.ndarray, size: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, passes: int = PASSES, decay: float = 2e-3) -> "LineField":
        """Of what ``line_features`` gives, and a label (0 or 1) a text."""
        if not len(labels) or len(set(labels.tolist())) < 2:
            sure = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
            return cls(np.zeros((3 * OWN, 2)), np.zeros((2, 2)), np.zeros(OWN), np.ones(OWN), (0.0, sure))
        mean, scale = own.mean(axis=0), own.std(axis=0)
        mean[0], scale[scale == 0] = 0, 1
        scale[0] = 1
        x = with_neighbours((own - mean) / scale, n_lines)
        document = np.repeat(labels.astype(np.int64), n_lines)
        weights, trans = cls._ascend(x, document, n_lines, np.zeros((x.shape[1], 2)), np.zeros((2, 2)), passes, decay)
        y = relabelled(marginals(x @ weights, trans, n_lines)[0], document, size, n_lines)
        if (y != document).any():
            weights, trans = cls._ascend(x, y, n_lines, weights, trans, passes // 3, decay)
        field = cls(weights, trans, mean, scale, (1.0, 0.0))
        raw = field.quality_of(own, size, n_lines)
        a, b = 1.0, 0.0
        z = cls._logit(raw)
        for _ in range(60):  # Newton for the two numbers of the curve, a little drawn to (1, 0)
            p = 1 / (1 + np.exp(-(a * z + b)))
            g = np.array([((labels - p) * z).sum() - (a - 1), (labels - p).sum() - b])
            w = p * (1 - p)
            h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
            step_a, step_b = np.linalg.solve(h, g)
            a, b = a + step_a, b + step_b
            if abs(step_a) + abs(step_b) < 1e-9:
                break
        field.curve = (float(a), float(b))
        return field

    @staticmethod
    def _ascend(x, y, n_lines, weights, trans, passes: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
        """Adam on the penalised likelihood of the labels ``y``."""
        weights, trans = weights.copy(), trans.copy()
        state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)]
        for step in range(1, passes + 1):
            grad_w, grad_t = gradient(x, y, n_lines, weights, trans)
            for value, grad, m, v in ((weights, grad_w - decay * weights, 0, 1), (trans, grad_t - 0.02 * trans, 2, 3)):
                state[m] = 0.9 * state[m] + 0.1 * grad
                state[v] = 0.99 * state[v] + 0.01 * grad**2
                value += 0.05 * (state[m] / (1 - 0.9**step)) / (np.sqrt(state[v] / (1 - 0.99**step)) + 1e-8)
        return weights, trans

    @staticmethod
    def _logit(p):
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    def quality_of(self, own: np.ndarray, size: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        """The length-weighted mean of the lines' probabilities of good, of each text."""
        x = with_neighbours((own - self.mean) / self.scale, n_lines)
        good = marginals(x @ self.weights, self.trans, n_lines)[0][:, 1]
        first = np.cumsum(n_lines) - n_lines
        weight = size.astype(np.float64)
        blank = np.add.reduceat(weight, first) == 0
        weight = np.where(np.repeat(blank, n_lines), 1.0, weight)
        return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)

    def quality(self, texts: list[str]) -> np.ndarray:
        return self.quality_of(*line_features(texts)) if texts else np.zeros(0)

    def score(self, texts: list[str]) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-(a * self._logit(self.quality(texts)) + b)))


def _training_rows(batches, train_lines: int):
    """(doc_id, run, features, sizes): a text's lines, or runs of them by a hash of their place."""
    import zlib

    import pyarrow as pa

    for batch in batches:
        out: list[tuple] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own, size, _ = line_features([text])
            if len(own) <= train_lines:
                runs = [(0, 0, len(own))]
            else:
                starts = sorted(range(0, len(own), RUN), key=lambda at: (zlib.crc32(f"{doc_id}:{at}".encode()), at))
                runs = [(at, at, min(at + RUN, len(own))) for at in sorted(starts[: max(1, train_lines // RUN)])]
            out += [(doc_id, run, own[a:b].astype("<f4").tobytes(), size[a:b].astype("<i8").tobytes()) for run, a, b in runs]
        ids, runs, features, sizes = zip(*out) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc_id").type), pa.array(runs, pa.int64()), pa.array(features, pa.binary()), pa.array(sizes, pa.binary())], ["doc_id", "run", "features", "sizes"])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> LineField:
    """Fits on the rows of ``docs`` that ``labels`` (doc_id, quality) covers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    labelled = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(5))
    chosen = labelled.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(order, "doc_id").limit(train_docs)
    rows = may_have_key(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), chosen, "doc_id").join(chosen.select("doc_id"), "doc_id", "left_semi")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    made = map_arrow(rows, lambda it: _training_rows(it, train_lines), f"doc_id {kind}, run long, features binary, sizes binary")
    # at most train_docs * train_lines lines of OWN numbers
    found = sorted(((r["doc_id"], r["run"], r["features"], r["sizes"], r["quality"]) for r in made.join(chosen, "doc_id").collect()), key=lambda r: r[:2])
    own = np.frombuffer(b"".join(r[2] for r in found), dtype="<f4").astype(np.float64).reshape(-1, OWN)
    size = np.frombuffer(b"".join(r[3] for r in found), dtype="<i8")
    return LineField.fit_features(own, size, np.array([len(r[3]) // 8 for r in found], dtype=np.int64), np.array([r[4] for r in found], dtype=np.float64))


def _score_rows(batches, field):
    import pyarrow as pa

    from .tokens import slices

    for batch in batches:
        for first, part in slices(batch.column("text").to_pylist()):
            score = field.score(part)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(part)), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])


def score_documents(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id, score, predicted of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(text, lambda it: _score_rows(it, field), f"doc_id {kind}, score double, predicted int")


def score_held_out(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``score_documents`` with a field fitted on rows whose crc32(doc_id) mod 3 is not 1; held_out marks the others."""
    field = train(docs.where(~held_out(3, 1)), labels.where(~held_out(3, 1)), **how)
    return score_documents(docs, field).withColumn("held_out", held_out(3, 1)).select("doc_id", "held_out", "score", "predicted")
