"""Groups whose rows stand together in a task.

Words of a document come from its row one after the other, and nothing deals them anew before these
functions see them, so pages and lines of whole documents need no exchange.  A key's rows must be neighbours, in their order.
"""

from __future__ import annotations

import numpy as np


def _differ(a, b):
    """Whether neighbours differ; null is a value."""
    import pyarrow.compute as pc

    unlike = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return unlike | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))


def starts(batch, keys: list[str]) -> np.ndarray:
    """Where groups begin in a batch."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for c in keys if n > 1 else ():
        column = batch.column(c)
        new[1:] |= _differ(column.slice(1), column.slice(0, n - 1))
    return np.flatnonzero(new)


def _one(batches: list):
    import pyarrow as pa

    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def whole_groups(batches, keys: list[str]):
    """Record batches that end where a group ends; one that goes on waits for its rest."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(_differ(held[-1].column(c).slice(held[-1].num_rows - 1), batch.column(c).slice(0, 1))[0] for c in keys):
            yield _one(held)
            held = []
        cut = int(starts(batch, keys)[-1])
        if cut:
            yield _one([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _one(held)


def joined(texts, first: np.ndarray, keep: np.ndarray | None = None):
    """Texts of each group, joined with blanks; nulls (and what is not kept) are left out, a group of none is ''."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = np.append(first, len(texts))
    if keep is None and texts.null_count:
        keep = texts.is_valid().to_numpy(zero_copy_only=False)
    if keep is not None:
        ends = np.append(0, np.cumsum(keep))[ends]
        texts = texts.filter(pa.array(keep))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), texts), " ")
