"""Alignment of readings with a reference, in groups of a page."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import DataFrame, functions as F


def project(reference: list[str], other: list[str], missing: str | None = "") -> list[str | None]:
    """D2: what ``other`` reads at each slot of ``reference``.

    Replaced slots take words in turn; too few leave ``missing``, the surplus goes to the last
    one.  Words inserted after a slot join it; those before the first slot are lost.
    """
    slots: list[str | None] = [missing] * len(reference)
    for kind, a0, a1, b0, b1 in SequenceMatcher(None, reference, other, autojunk=False).get_opcodes():
        words = other[b0:b1]
        if kind == "insert":
            if a0:
                slots[a0 - 1] = " ".join(x for x in (slots[a0 - 1], *words) if x)
            continue
        for n, at in enumerate(range(a0, a1)):
            if n < len(words):
                slots[at] = " ".join(words[n:]) if at == a1 - 1 else words[n]
    return slots


def align_engines(rows: DataFrame, by: str, engine: str, order: str, text: str, reference: int) -> DataFrame:
    """(by, engine, pos, reading): every engine's words on the reference engine's slots; pages are the groups."""
    kind = rows.schema[by].dataType.simpleString()

    def work(pdf):
        import pandas as pd

        pdf = pdf.sort_values([engine, order])
        words = {k: g[text].tolist() for k, g in pdf.groupby(engine)}
        spine = words.get(reference, [])
        out = [(pdf[by].iloc[0], k, i, r) for k, w in words.items() for i, r in enumerate(spine if k == reference else project(spine, w))]
        return pd.DataFrame(out, columns=[by, "engine", "pos", "reading"])

    return rows.groupBy(by).applyInPandas(work, f"{by} {kind}, engine int, pos int, reading string")


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of n numbers each."""
    return np.repeat(start - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def _runs(a: np.ndarray, b: np.ndarray, pa: np.ndarray, pb: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pair, i, j, n) of all longest runs of two equal words or more of pairs that stand one after the other."""
    wide = int(max(a.max(initial=0), b.max(initial=0))) + 1
    two = lambda w, p: np.flatnonzero(p[1:] == p[:-1])
    key = lambda w, p, at: (p[at] * wide + w[at]) * wide + w[at + 1]
    at, bt = two(a, pa), two(b, pb)
    ka, kb = key(a, pa, at), key(b, pb, bt)
    order = np.argsort(ka, kind="stable")
    ka = ka[order]
    low = np.searchsorted(ka, kb, "left")
    n = np.searchsorted(ka, kb, "right") - low
    i, j = at[order[_spread(low, n)]], np.repeat(bt, n)
    # a run's first and last two words; in the order of diagonals both come in turn
    beside = lambda step: (i + step >= 0) & (j + step >= 0) & (i + step < len(a)) & (j + step < len(b))
    goes = lambda step: beside(step) & (pa.take(i + step, mode="clip") == pa[i]) & (pb.take(j + step, mode="clip") == pa[i]) & (a.take(i + step, mode="clip") == b.take(j + step, mode="clip"))
    diagonal = lambda which: np.sort((j[which] - i[which] + len(a)) << 32 | i[which])
    start, end = diagonal(~goes(-1)), diagonal(~goes(2))
    i = start & 0xFFFFFFFF
    return pa[i], i, (start >> 32) + i - len(a), end - start + 2


def _single(a: list, b: list, a0: int, a1: int, b0: int, b1: int):
    """Equal words where no two neighbours are equal: the first in a with its first place in b, then on behind them."""
    for i in range(a0, a1):
        if a[i] in b[b0:b1]:
            j = b.index(a[i], b0, b1)
            yield i, j
            b0 = j + 1


def blocks(a: np.ndarray, b: np.ndarray, pa: np.ndarray, pb: np.ndarray, base_a: np.ndarray, base_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pair, i, j, n): the matching blocks of difflib (without junk) of each pair of number sequences, places counted through all pairs.

    The longest run, of equals the first in a, then in b; then the same left and right of it.
    All pairs take a step together; a run that a block cuts keeps what is on one side of it.
    Single words come last, when no run of two is left between two blocks.
    """
    pair, i, j, n = _runs(a, b, pa, pb)
    order = np.argsort(pair, kind="stable")
    pair, i, j, n = pair[order], i[order], j[order], n[order]
    group, found = pair, []
    while len(i):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
        rank = (n << 48) - ((i - base_a[pair]) << 24) - (j - base_b[pair])
        best = np.flatnonzero(rank == np.maximum.reduceat(rank, first)[which])
        found.append((pair[best], i[best], j[best], n[best]))
        bi, bj, bn = (x[best][which] for x in (i, j, n))
        left = (i < bi) & (j < bj)
        cut = np.where(left, 0, np.maximum(np.maximum(bi + bn - i, bj + bn - j), 0))
        n = np.where(left, np.minimum(n, np.minimum(bi - i, bj - j)), n - cut)
        keep = n > 1
        i, j, n, pair, group = (i + cut)[keep], (j + cut)[keep], n[keep], pair[keep], (which * 2 + ~left)[keep]
        order = np.argsort(group, kind="stable")
        i, j, n, pair, group = i[order], j[order], n[order], pair[order], group[order]
    pair, i, j, n = (np.concatenate([x[c] for x in found]) if found else np.zeros(0, np.int64) for c in range(4))
    g, a0, a1, b0, b1 = _gaps(pair, i, j, n, base_a, base_b)
    open_ = (a1 > a0) & (b1 > b0)
    plain = open_ & (a1 - a0 == 1) & (b1 - b0 == 1)
    open_[plain] = a[a0[plain]] == b[b0[plain]]
    more = [(p, *at, 1) for p, *gap in zip(*(x[open_].tolist() for x in (g, a0, a1, b0, b1))) for at in _single(a_list, b_list, *gap)] if open_.any() and (a_list := a.tolist()) and (b_list := b.tolist()) else []
    pair, i, j, n = (np.append(x, [m[c] for m in more]).astype(np.int64) for c, x in enumerate((pair, i, j, n)))
    order = np.argsort(i, kind="stable")
    return pair[order], i[order], j[order], n[order]


def _gaps(pair, i, j, n, base_a, base_b) -> tuple[np.ndarray, ...]:
    """(pair, a0, a1, b0, b1) between neighbouring blocks, of which each pair has an empty one at each end."""
    every, zero = np.arange(len(base_a) - 1), np.zeros(len(base_a) - 1, np.int64)
    p, x, y, m = np.concatenate([every, pair, every]), np.concatenate([base_a[:-1], i, base_a[1:]]), np.concatenate([base_b[:-1], j, base_b[1:]]), np.concatenate([zero, n, zero])
    order = np.lexsort((np.repeat([0, 1, 2], [len(every), len(pair), len(every)]), x, p))
    p, x, y, m = p[order], x[order], y[order], m[order]
    inside = p[1:] == p[:-1]
    return p[1:][inside], (x + m)[:-1][inside], x[1:][inside], (y + m)[:-1][inside], y[1:][inside]


#: Words of a reference times words of another, summed over the pairs that are aligned together.
TOGETHER = 8_000_000


def project_all(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``project`` of each (reference, other): where the words of each slot begin and end in the other, slots of all pairs
    one after the other, and where each pair's slots begin.  A slot's words are neighbours in the other."""
    sizes = np.cumsum([len(x) * len(y) for x, y in pairs]) // TOGETHER if pairs else np.zeros(0, np.int64)
    cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), len(pairs)]
    done = [_project(pairs[x:y]) for x, y in zip(cuts, cuts[1:])]
    return np.concatenate([x[0] for x in done]), np.concatenate([x[1] for x in done]), np.append(0, np.cumsum([len(x) for x, _ in pairs])).astype(np.int64)


def _project(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    la, lb = (np.array([len(p[c]) for p in pairs], np.int64) for c in (0, 1))
    base_a, base_b = (np.append(0, np.cumsum(x)) for x in (la, lb))
    every = np.arange(len(pairs))
    a, b = (np.concatenate([p[c] for p in pairs]).astype(np.int64) if pairs else np.zeros(0, np.int64) for c in (0, 1))
    begin, end = np.zeros(base_a[-1], np.int64), np.zeros(base_a[-1], np.int64)
    pair, i, j, n = blocks(a, b, np.repeat(every, la), np.repeat(every, lb), base_a, base_b)
    g, a0, a1, b0, b1 = _gaps(pair, i, j, n, base_a, base_b)
    taken = np.minimum(a1 - a0, b1 - b0)
    at, to = np.append(_spread(i, n), _spread(a0, taken)), np.append(_spread(j, n), _spread(b0, taken))
    begin[at], end[at] = to, to + 1
    # the surplus of a replaced run, or words put in behind a slot
    last = (b1 > b0) & (a1 - a0 <= b1 - b0) & (a1 > base_a[g])
    end[a1[last] - 1] = b1[last]
    shift = np.repeat(base_b[:-1], la)
    return begin - np.where(end > begin, shift, 0), end - np.where(end > begin, shift, 0)


def align_in_order(rows: DataFrame, by: list[str], panel: int, reference: int) -> DataFrame:
    """``align_engines`` of rows (by, readings) that stand in order, page by page; null where an engine has no word.

    (by, engine, pos, reading), without an exchange.
    """
    kinds = {c: rows.schema[c].dataType.simpleString() for c in by}

    def work(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from .neighbours import starts, whole_groups

        for batch in whole_groups(batches, by):
            first = np.append(starts(batch, by), batch.num_rows)
            columns = [batch.column(f"_r{k}") for k in range(panel)]
            bounds = [np.append(0, np.cumsum(c.is_valid().to_numpy(zero_copy_only=False)))[first] for c in columns]
            words = pa.concat_arrays([c.drop_null() for c in columns])
            from_ = np.append(0, np.cumsum([b[-1] for b in bounds]))
            numbers = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False)
            own = lambda k, g: (from_[k] + bounds[k][g], from_[k] + bounds[k][g + 1])
            asked = [(g, k) for g in range(len(first) - 1) for k in range(panel) if bounds[k][g] < bounds[k][g + 1] and bounds[reference][g] < bounds[reference][g + 1]]
            if not asked:
                continue
            begin, end, base = project_all([(numbers[slice(*own(reference, g))], numbers[slice(*own(k, g))]) for g, k in asked])
            begin, end = (x + np.repeat([own(k, g)[0] for g, k in asked], np.diff(base)) for x in (begin, end))
            n = np.where(end > begin, end - begin, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), words.take(pa.array(_spread(begin, n))))
            slots = pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), pc.binary_join(lists, " "))
            page = pa.array(first[[g for g, _ in asked]])
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(page) for c in by], pa.array([k for _, k in asked], pa.int32()), slots], [*by, "engine", "readings"])

    words = rows.select(*by, *[F.get("readings", F.lit(k)).alias(f"_r{k}") for k in range(panel)])
    made = words.mapInArrow(work, ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", engine int, readings array<string>")
    return made.select(*by, "engine", F.posexplode("readings").alias("pos", "reading"))


def best_shift(reference: list[tuple], other: list[tuple], reach: float = 0.030, step: float = 0.001) -> tuple[float, int]:
    """The vertical shift under which most reference lines (x0, y0, x1, y1) have their centre in an overlapping line of the other; the first of equals."""
    steps = int(reach / step)
    best = (0.0, -1)
    a, b = (np.array(x, float).reshape(-1, 4) for x in (reference, other))
    mid = (a[:, 1] + a[:, 3]) / 2
    # only lines that meet across and can meet in height under some shift
    across = (a[:, None, 0] < b[None, :, 2]) & (a[:, None, 2] > b[None, :, 0])
    near = (b[None, :, 1] - reach - step <= mid[:, None]) & (mid[:, None] <= b[None, :, 3] + reach + step)
    i, j = np.nonzero(across & near)
    for k in range(-steps, steps + 1):
        s = k * step
        fits = (b[j, 1] + s <= mid[i]) & (mid[i] <= b[j, 3] + s)
        n = len(np.unique(i[fits]))
        if n > best[1]:
            best = (s, n)
    return best


def align_lines(reference: list[dict], other: list[dict]) -> list[tuple[int, str]]:
    """D3: (slot, reading) of the reference's words; lines are {x0, y0, x1, y1, words}.

    Lines are matched under one shift, each of the other's once, in the order of the reference; words are
    aligned inside lines.  If fewer than half of the reference lines match, whole streams are aligned.
    """
    box = lambda x: (x["x0"], x["y0"], x["x1"], x["y1"])
    spine = [w for line in reference for w in line["words"]]
    shift, matched = best_shift([box(x) for x in reference], [box(x) for x in other])
    if matched * 2 < len(reference):
        return list(enumerate(project(spine, [w for line in other for w in line["words"]])))
    used: set[int] = set()
    out, at = [], 0
    low, high, x0, x1 = (np.array([x[c] for x in other], float) + d for c, d in (("y0", shift), ("y1", shift), ("x0", 0), ("x1", 0)))
    for line in reference:
        mid = (line["y0"] + line["y1"]) / 2
        at_hand = np.flatnonzero((low <= mid) & (mid <= high) & (line["x0"] < x1) & (line["x1"] > x0)).tolist()
        fits = sorted((other[i]["x0"], i) for i in at_hand if i not in used)
        used.update(i for _, i in fits)
        words = [w for _, i in fits for w in other[i]["words"]]
        out += [(at + k, r) for k, r in enumerate(project(line["words"], words))]
        at += len(line["words"])
    return out
