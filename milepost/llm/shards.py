"""Shards of equal capacity, filled by best fit, largest group first."""

from pyspark.sql import Column, DataFrame, functions as F

from milepost.operators.ordering import positions
from milepost.session import stage

PARTS = 256  # a group above a shard's PARTS-th is placed on its own
BUNDLES = 16_384  # smaller groups are placed in so many bundles at most


class Tree:
    """A balanced search tree (treap) of (free capacity, shard)."""

    def __init__(self):
        self.root = None  # [key, priority, left, right]

    @staticmethod
    def _split(node, key):
        """Nodes below `key`, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = Tree._split(node[3], key)
            node[3] = low
            return node, high
        low, high = Tree._split(node[2], key)
        node[2] = high
        return low, node

    @staticmethod
    def _join(low, high):
        if low is None or high is None:
            return low or high
        if low[1] < high[1]:
            low[3] = Tree._join(low[3], high)
            return low
        high[2] = Tree._join(low, high[2])
        return high

    def add(self, key: tuple) -> None:
        low, high = self._split(self.root, key)
        priority = (key[1] * 0x9E3779B97F4A7C15 + key[0] * 0xC2B2AE3D27D4EB4F) % (1 << 64) * 0xD6E8FEB86659FD93 % (1 << 64)
        self.root = self._join(self._join(low, [key, priority, None, None]), high)

    def take_at_least(self, size: int):
        """Remove and return the smallest key with that much room, or None."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        below, rest = self._split(high, (node[0][0], node[0][1] + 1))
        self.root = self._join(low, rest)
        return below[0]


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The shard of each size (`sizes` falls): the fullest one that has room, else a new
    one. None if more than `most` shards were needed. A size above the capacity gets a shard of its own."""
    tree, used, out = Tree(), 0, []
    for size in sizes:
        found = tree.take_at_least(size)
        if found is None:
            if used == most:
                return None
            found, used = (max(capacity, size), used), used + 1
        tree.add((found[0] - size, found[1]))
        out.append(found[1])
    return out


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """Best fit into exactly `shards` shards: a size above an equal share of what is left
    fills a shard alone, and the others go into the least capacity at which best fit needs no more shards."""
    alone, total = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest, left = sizes[alone:], shards - alone
    fair = max(-(-total // left), rest[0] if rest else 1)
    fail, slack = -1, 0
    while (placed := best_fit(rest, fair + slack, left)) is None:
        fail, slack = slack, max(1, 2 * slack, fair >> 14)
    while slack - fail > max(1, fair >> 14):  # between a capacity that fails and one that is enough
        middle = (slack + fail) // 2
        if (tighter := best_fit(rest, fair + middle, left)) is None:
            fail = middle
        else:
            slack, placed = middle, tighter
    return list(range(alone)) + [alone + s for s in placed]


def shard_by_best_fit(
    docs: DataFrame, size: Column, group: Column, shards: int | None = None, capacity: int | None = None,
    key: str = "doc_id", more: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows in shards, rows of an equal `group` (a 64-bit hash) always together.

    Give the number of `shards`, which then get nearly equal sizes, or a `capacity`, of
    which as few shards as best fit needs are used. Best-fit decreasing: groups in falling
    size enter the shard with the least room that is enough, found in a balanced tree.

    Groups are summed up on each task first. Groups above 1/PARTS of a shard are placed
    one by one, at most PARTS per shard; all smaller ones are bundled by hash, so the driver
    places a bounded number of units (BUNDLES + PARTS * shards) whatever the input, and only
    that list is broadcast. A group above an equal share fills a shard alone, since groups
    are indivisible. Positions in a shard are counted over ranges of rows, so a shard may be
    larger than a task.

    Returns key, size, the columns of `more`, shard, slot (gapless from 0, by key).
    Null keys come first; repeated rows keep slots of their own; an empty table has no shards.
    """
    more = more or {}
    rows = docs.select(F.col(f"`{key}`").alias("_key"), size.cast("bigint").alias("_size"), group.alias("_group"), *[c.alias(f"_more_{n}") for n, c in more.items()])
    rows = stage(rows, "sizes")
    sums = stage(rows.groupBy("_group").agg(F.sum("_size").alias("_sum")), "groups")
    total = sums.agg(F.sum("_sum")).first()[0] or 0
    whole = -(-total // shards) if shards else capacity
    count = shards or max(1, -(-total // capacity))
    bundles = max(BUNDLES, 64 * count)
    is_large = F.col("_sum") * PARTS > whole
    large = sums.where(is_large).select("_group", "_sum")
    small = sums.where(~is_large).groupBy(F.pmod("_group", F.lit(bundles)).alias("_bundle")).agg(F.sum("_sum").alias("_sum"))
    units = [(r["_sum"], 0, r["_group"]) for r in large.toArrow().to_pylist()] + [(r["_sum"], 1, r["_bundle"]) for r in small.toArrow().to_pylist()]
    units.sort(key=lambda u: (-u[0], u[1], u[2]))
    sizes = [u[0] for u in units]
    placed = into_shards(sizes, shards) if shards else best_fit(sizes, capacity)
    spark = docs.sparkSession
    table = lambda kind: F.broadcast(  # noqa: E731  at most PARTS * shards, or `bundles`, rows
        spark.createDataFrame([(u[2], s) for u, s in zip(units, placed) if u[1] == kind], f"_unit{kind} bigint, _shard{kind} int")
    )
    rows = rows.join(table(0), F.col("_group") == F.col("_unit0"), "left")
    rows = rows.join(table(1), F.pmod("_group", F.lit(bundles)) == F.col("_unit1"), "left")
    rows = rows.select("_key", "_size", *[f"_more_{n}" for n in more], F.coalesce("_shard0", "_shard1").alias("shard"))
    order = [F.col(c).asc() for c in rows.columns if c != "shard"]
    placed_rows = positions(rows, order, ["shard"], index="_slot1")
    return placed_rows.select(
        F.col("_key").alias(key), F.col("_size").alias("size"), *[F.col(f"_more_{n}").alias(n) for n in more], "shard", (F.col("_slot1") - 1).alias("slot")
    )
