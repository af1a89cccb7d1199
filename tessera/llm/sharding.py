"""Sharding by best-fit-decreasing bin packing.

Groups of equal texts are indivisible. Items sorted by size enter the bin
whose remaining capacity is the tightest that holds them; a balanced search
tree finds it. The capacity is the least (by bisection) at which the shards
suffice; a group larger than the shards' mean has a shard of its own.

The items that the driver packs are bounded whatever the input: a group of at
least 1/``items`` of all bytes is an item (there can be ``items`` of them at
most), all others go by hash of their text into ``items`` bundles, an item
each. Rows get their place in three counted steps: the item's start in its
shard, the start of the row's piece of the item (pieces hold about
``piece_rows`` rows), and the row's number in that piece; so a group that holds
much of the table is numbered by many tasks.

Defined cases: a null text has no bytes, size 8, and is a group of its own
kind apart from the empty text; rows of equal id are kept; a shard that gets
nothing has no rows; an empty table gives an empty result; other columns are
left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, table

SHARDS = 24
ITEMS = 8192
PIECE_ROWS = 20_000
OVERHEAD = 8


class BinTree:
    """A balanced search tree (treap) of bins by remaining capacity."""

    __slots__ = ("key", "left", "right", "rank", "root", "seed")

    def __init__(self) -> None:
        self.key: list[tuple[int, int]] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.rank: list[int] = []
        self.root, self.seed = -1, 1

    def _merge(self, a: int, b: int) -> int:
        if a < 0 or b < 0:
            return max(a, b)
        if self.rank[a] > self.rank[b]:
            self.right[a] = self._merge(self.right[a], b)
            return a
        self.left[b] = self._merge(a, self.left[b])
        return b

    def _split(self, t: int, key: tuple[int, int]) -> tuple[int, int]:
        if t < 0:
            return -1, -1
        if self.key[t] < key:
            self.right[t], rest = self._split(self.right[t], key)
            return t, rest
        rest, self.left[t] = self._split(self.left[t], key)
        return rest, t

    def insert(self, key: tuple[int, int]) -> None:
        self.seed = (self.seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        self.key.append(key)
        self.left.append(-1)
        self.right.append(-1)
        self.rank.append(self.seed >> 33)
        a, b = self._split(self.root, key)
        self.root = self._merge(self._merge(a, len(self.key) - 1), b)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least key whose capacity holds ``size``."""
        t, found = self.root, None
        while t >= 0:
            if self.key[t][0] >= size:
                found, t = self.key[t], self.left[t]
            else:
                t = self.right[t]
        return found

    def remove(self, key: tuple[int, int]) -> None:
        a, b = self._split(self.root, key)
        gone, rest = self._split(b, (key[0], key[1] + 1))
        self.root = self._merge(a, rest)


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """A bin for each of the sizes (sorted, largest first); None if more than
    ``most`` bins are needed or a size does not fit at all."""
    tree, out, n = BinTree(), [], 0
    for size in sizes:
        place = tree.tightest(size)
        if place is None:
            if size > capacity or n == most:
                return None
            place, n = (capacity, n), n + 1
        else:
            tree.remove(place)
        out.append(place[1])
        tree.insert((place[0] - size, place[1]))
    return out


def pack(sizes: list[int], shards: int) -> list[int]:
    """A shard for each of the sizes (sorted, largest first)."""
    total, own = sum(sizes), 0
    while own < min(shards - 1, len(sizes)) and sizes[own] * (shards - own) >= total:
        total -= sizes[own]  # as large as the mean of what is left: a shard of its own
        own += 1
    rest, bins = sizes[own:], shards - own
    if not rest:
        return list(range(own))
    low, high = max(-(-total // bins), rest[0]), total
    best = best_fit(rest, high, bins)
    close = max(0, total // bins // 10_000)
    step = max(1, low // 1000)
    while low < high and (found := best_fit(rest, min(low + step, high), bins)) is None:
        low, step = low + step, 2 * step
    if low < high:
        high, best = min(low + step, high), found
    while high - low > close:
        mid = (low + high) // 2
        if (found := best_fit(rest, mid, bins)) is None:
            low = mid + 1
        else:
            high, best = mid, found
    return [*range(own), *[own + b for b in best]]


def shard(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", items: int = ITEMS, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("null")).alias("key"),
        ),
        "sizes",
    )
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    large = F.col("bytes") * F.lit(items) >= F.lit(int(total))
    big = groups.where(large).select("key", "key", "bytes", "n").toDF("key", "item", "bytes", "n")
    bundled = F.concat(F.lit("bundle-"), F.pmod(F.xxhash64("key"), F.lit(items)))
    bundles = groups.where(~large).groupBy(bundled.alias("item")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    # At most `items` large groups and as many bundles, whatever the input.
    listed = sorted(
        [(r["item"], r["bytes"], r["n"], True) for r in big.collect()] + [(r["item"], r["bytes"], r["n"], False) for r in bundles.collect()],
        key=lambda x: (-x[1], x[0]),
    )
    bins = pack([x[1] for x in listed], shards) if listed else []
    start, plan, own = [0] * shards, [], []
    for (item, _, n, alone), b in zip(listed, bins, strict=True):
        plan.append((item, b, start[b], max(1, -(-n // piece_rows))))
        start[b] += n
        if alone:
            own.append((item,))
    plan = spark.createDataFrame(plan, "item string, shard int, start long, pieces int")
    own = spark.createDataFrame(own, "key string").withColumn("item", F.col("key"))

    placed = (
        rows.join(F.broadcast(own), "key", "left")
        .withColumn("item", F.coalesce("item", bundled))
        .join(F.broadcast(plan), "item")
        .withColumn("piece", F.pmod(F.xxhash64("doc_id", "key"), F.col("pieces")).cast("int"))
    )
    counts = placed.groupBy("item", "piece", "start").agg(F.count("*").alias("n"))
    before = Window.partitionBy("item").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("item", "piece", (F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("offset"))
    inside = Window.partitionBy("item", "piece").orderBy("key", "doc_id", "text_crc32")
    numbered = placed.select("doc_id", "size", "text_crc32", "shard", "item", "piece", F.row_number().over(inside).alias("number"))
    return numbered.join(offsets, ["item", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("number") - 1).cast("long").alias("slot")
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("grown_shard", F.lit(None).cast("int"))
