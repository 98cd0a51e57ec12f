"""Operator 9: shards by best-fit-decreasing bin packing.

Groups (rows of equal text) are indivisible and stay in one shard.  Items of the
packing are the large groups, each by itself, and bundles of the small ones by a hash
of their text; both are bounded in number (``grain`` of each at most: a large group has
more than a ``1/grain`` share of all bytes), so sorting them and walking the balanced
tree on the driver costs the same for any input, and the two answers that are
broadcast have at most ``grain`` rows each.

``best_fit_decreasing`` opens as few bins of a fixed capacity as it can.
``shards_for`` gives each item larger than the fair share of what remains a shard of
its own, and finds for the others the least capacity at which the remaining shards are
enough.  While one item moved from the fullest to the emptiest of these would still level
them, the fullest is settled and the rest packed again.

Defined results: a null text has size 16, CRC 0 and belongs to the group of empty
texts; repeated rows are placed each (their slots differ); an empty table gives an empty
result; other columns are ignored.  A group larger than a shard's fair share has
a shard to itself, which is larger than the others, as a group is not divided; only where
there are fewer items than shards do shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window, functions as F

from .common import staged, text_or_empty

SHARDS = 40
GRAIN = 20_000
SLOT_BLOCK = 50_000


class CapacityTree:
    """(remaining, bin) pairs in order: a two-level B-tree whose leaves split when full."""

    LEAF = 256

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = []
        self.least: list[tuple[int, int]] = []

    def _leaf(self, key) -> int:
        at = bisect_left(self.least, key)
        return at if at < len(self.least) and self.least[at] == key else max(0, at - 1)

    def add(self, remaining: int, bin_: int) -> None:
        key = (remaining, bin_)
        if not self.leaves:
            self.leaves, self.least = [[key]], [key]
            return
        at = self._leaf(key)
        leaf = self.leaves[at]
        insort(leaf, key)
        self.least[at] = leaf[0]
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.least[at : at + 1] = [leaf[0], leaf[half]]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the pair of least remaining >= size."""
        if not self.leaves:
            return None
        at = self._leaf((size, -1))
        spot = bisect_left(self.leaves[at], (size, -1))
        if spot == len(self.leaves[at]):
            at, spot = at + 1, 0
            if at == len(self.leaves):
                return None
        found = self.leaves[at].pop(spot)
        if self.leaves[at]:
            self.least[at] = self.leaves[at][0]
        else:
            del self.leaves[at], self.least[at]
        return found


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size (sorted, largest first); None if more than ``most`` bins are needed."""
    tree, bins, placed = CapacityTree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            if most is not None and bins == most:
                return None
            found, bins = (capacity, bins), bins + 1
        remaining, bin_ = found
        placed.append(bin_)
        if remaining > size:
            tree.add(remaining - size, bin_)
    return placed


def _least_capacity(sizes: list[int], shards: int) -> list[int]:
    """Bins 0..shards-1 of the sorted sizes, at the least capacity at which so many are enough."""
    low = max(sizes[0], -(-sum(sizes) // shards))
    high = low
    while (best := best_fit_decreasing(sizes, high, shards)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        placed = best_fit_decreasing(sizes, middle, shards)
        if placed is None:
            low = middle + 1
        else:
            best, high = placed, middle
    return best


def shards_for(sizes: list[int], shards: int) -> list[int]:
    """Bins 0..shards-1 of the sorted sizes: as level as the items allow."""
    out, used, left, total = [0] * len(sizes), 0, list(range(len(sizes))), sum(sizes)
    while left:
        alone = 0
        while alone < len(left) and sizes[left[alone]] * (shards - used) > total:
            out[left[alone]], used, total = used, used + 1, total - sizes[left[alone]]
            alone += 1
        left = left[alone:]
        if not left:
            break
        placed = _least_capacity([sizes[i] for i in left], shards - used)
        sums = [0] * (shards - used)
        for i, bin_ in zip(left, placed):
            sums[bin_] += sizes[i]
        fullest = sums.index(max(sums))
        smallest = min(sizes[i] for i, bin_ in zip(left, placed) if bin_ == fullest)
        if sums[fullest] - min(sums) <= smallest:
            for i, bin_ in zip(left, placed):
                out[i] = used + bin_
            break
        for i, bin_ in zip(left, placed):
            if bin_ == fullest:
                out[i] = used
        left = [i for i, bin_ in zip(left, placed) if bin_ != fullest]
        used, total = used + 1, total - sums[fullest]
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, grain: int = GRAIN, slot_block: int = SLOT_BLOCK) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    text = text_or_empty()
    base = staged(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
    ), "op9-rows")
    total, rows = base.agg(F.sum("size"), F.count("*")).first()
    if not rows:
        return spark.createDataFrame([], f"doc_id {kind.simpleString()}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
    bundle = F.pmod(F.xxhash64("digest"), F.lit(grain))
    groups = base.groupBy("digest").agg(F.sum("size").alias("size"))
    large_item = F.col("size") > F.lit(max(1, total // grain))
    groups = staged(groups.withColumn("large", large_item), "op9-groups")
    items = [(r["size"], 0, bytes(r["digest"])) for r in groups.where("large").collect()]
    items += [(r["size"], 1, r["bundle"]) for r in groups.where("not large").groupBy(bundle.alias("bundle")).agg(F.sum("size").alias("size")).collect()]
    items.sort(key=lambda x: (-x[0], x[1], x[2]))
    placed = shards_for([x[0] for x in items], shards)
    large = spark.createDataFrame([(bytearray(x[2]), s) for x, s in zip(items, placed) if x[1] == 0], "digest binary, large_shard int")
    small = spark.createDataFrame([(x[2], s) for x, s in zip(items, placed) if x[1] == 1], "bundle long, small_shard int")
    put = base.join(F.broadcast(large), "digest", "left").withColumn("bundle", bundle).join(F.broadcast(small), "bundle", "left")
    put = put.withColumn("shard", F.coalesce("large_shard", "small_shard"))
    # places in a shard: blocks of rows are ranked each by itself, and start where the blocks before them end
    blocks = max(1, -(-rows // (shards * slot_block)))
    put = put.withColumn("block", F.pmod(F.xxhash64("row", F.lit(9)), F.lit(blocks)))
    counts = put.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "row"))
    ranked = put.withColumn("rank", rank).join(before.drop("n"), ["shard", "block"])
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
