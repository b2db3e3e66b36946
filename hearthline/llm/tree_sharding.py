"""Shards of nearly equal size by best-fit-decreasing packing of indivisible groups.

Groups, sorted by size, enter the shard with the tightest remaining capacity that holds
them; a balanced search tree over the remaining capacities finds it.  The capacity is the
smallest found at which the wanted number of shards suffices, so the shards are full up
to it, which makes their sizes nearly equal.

Groups of one size are packed together: a shard that fits one takes as many of them as
it has room for.  The packing therefore needs only the number of groups of each size.
Sizes up to ``EXACT`` are told apart; larger ones are rounded up to 11 binary digits
(0.1 %) in the plan.  So at most EXACT plus 1024 sizes per doubling beyond reach the
driver, about 100,000, whatever the corpus.  Groups find their shard by their number among
the groups of their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import col, numbered, placed, restored
from hearthline.session import settle

EXACT = 1 << 16


class Node:
    __slots__ = ("key", "left", "level", "right")

    def __init__(self, key):
        self.key, self.level, self.left, self.right = key, 1, None, None


class Tree:
    """A balanced search tree (AA tree) of distinct keys."""

    def __init__(self):
        self.root: Node | None = None

    def ceiling(self, key):
        """The smallest key that is at least ``key``."""
        node, found = self.root, None
        while node:
            if node.key >= key:
                found, node = node.key, node.left
            else:
                node = node.right
        return found

    def add(self, key) -> None:
        self.root = self._add(self.root, key)

    def drop(self, key) -> None:
        self.root = self._drop(self.root, key)

    @staticmethod
    def _skew(node):
        if node and node.left and node.left.level == node.level:
            left = node.left
            node.left, left.right = left.right, node
            return left
        return node

    @staticmethod
    def _split(node):
        if node and node.right and node.right.right and node.right.right.level == node.level:
            right = node.right
            node.right, right.left = right.left, node
            right.level += 1
            return right
        return node

    def _add(self, node, key):
        if node is None:
            return Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._split(self._skew(node))

    def _drop(self, node, key):
        if node is None:
            return None
        if key < node.key:
            node.left = self._drop(node.left, key)
        elif key > node.key:
            node.right = self._drop(node.right, key)
        elif node.left is None and node.right is None:
            return None
        elif node.left is None:
            heir = node.right
            while heir.left:
                heir = heir.left
            node.key = heir.key
            node.right = self._drop(node.right, heir.key)
        else:
            heir = node.left
            while heir.right:
                heir = heir.right
            node.key = heir.key
            node.left = self._drop(node.left, heir.key)
        level = 1 + min(node.left.level if node.left else 0, node.right.level if node.right else 0)
        if level < node.level:
            node.level = level
            if node.right and node.right.level > level:
                node.right.level = level
        node = self._skew(node)
        if node.right:
            node.right = self._skew(node.right)
            if node.right.right:
                node.right.right = self._skew(node.right.right)
        node = self._split(node)
        if node.right:
            node.right = self._split(node.right)
        return node


Range = tuple[int, int, int, int]  # size, first and last number of the groups of that size, shard


def best_fit_decreasing(counts: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[Range] | None:
    """Pack groups, given as (size, number) in falling order of size, into shards of a capacity.

    A group larger than the capacity has a shard of its own.  None if more than ``most``
    shards were needed.
    """
    tree, plan, shards = Tree(), [], 0
    for size, n in counts:
        done = 0
        while done < n:
            fit = tree.ceiling((size, -1))
            if fit is None:
                if shards == most:
                    return None
                fit = (max(capacity, size), shards)
                shards += 1
            else:
                tree.drop(fit)
            room, shard = fit
            taken = min(n - done, room // size)
            plan.append((size, done, done + taken, shard))
            done += taken
            tree.add((room - taken * size, shard))
    return plan


def balanced_plan(counts: dict[int, int], shards: int) -> list[Range]:
    """The packing into so many shards with the smallest capacity that a search finds.

    A group that exceeds an even share of what is left gets a shard alone first.
    """
    order = sorted(counts.items(), reverse=True)
    plan, left, total = [], shards, sum(s * n for s, n in order)
    used: dict[int, int] = {}
    for size, n in order:
        while used.get(size, 0) < n and left > 1 and size * left >= total:
            at = used.get(size, 0)
            plan.append((size, at, at + 1, shards - left))
            used[size], left, total = at + 1, left - 1, total - size
    rest = [(s, n - used.get(s, 0)) for s, n in order if n > used.get(s, 0)]
    if not rest:
        return plan
    least = -(-total // left)
    extra = [0, *(1 << b for b in range((least + rest[0][0]).bit_length() + 1))]
    low, high, found = 0, len(extra) - 1, None
    while low < high or found is None:
        middle = (low + high) // 2
        packed = best_fit_decreasing(rest, least + extra[middle], left)
        if packed is None:
            low = middle + 1
        else:
            high, found = middle, packed
    done = shards - left
    return plan + [(s, a + used.get(s, 0), b + used.get(s, 0), shard + done) for s, a, b, shard in found]


def planned_size(size: Column) -> Column:
    """The size that a group has in the plan: itself up to EXACT, else rounded up to 11 binary digits."""
    step = F.pow(F.lit(2), F.length(F.bin(size)) - 11).cast("long")
    return F.when(size <= EXACT, size).otherwise(F.ceil(size / step).cast("long") * step)


PLAN = T.StructType([T.StructField(n, T.LongType()) for n in ("_planned", "_first", "_last")] + [T.StructField("shard", T.IntegerType())])
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def group_shards(rows: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """(_group, shard) of all groups; ``rows`` has _group and size, equal within a group."""
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_total"))
    groups = groups.select("_group", planned_size(F.col("_total")).alias("_planned"))
    numbered = placed(groups, ["_planned"], [F.col("_group")], "groups", "_number")
    numbered = settle(numbered, "numbered")
    counts = {r["_planned"]: r["n"] for r in numbered.groupBy("_planned").agg(F.count("*").alias("n")).collect()}
    if capacity is None:
        plan = balanced_plan(counts, shards)
    else:
        plan = best_fit_decreasing(sorted(counts.items(), reverse=True), capacity)
    ranges = rows.sparkSession.createDataFrame(plan, PLAN).withColumnRenamed("_planned", "_size")
    here = (F.col("_planned") == F.col("_size")) & (F.col("_number") >= F.col("_first")) & (F.col("_number") < F.col("_last"))
    return numbered.join(F.broadcast(ranges), here).select("_group", "shard")


def shard(
    df: DataFrame, shards: int = 16, *, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text", payload: list[str] | None = None
) -> DataFrame:
    """All rows with size, text_crc32, law, shard, slot and grown_shard.

    Law ``bytes``: shards hold nearly equal sums of size (UTF-8 bytes of the text plus one),
    and rows of equal text share a shard.  With ``capacity``, shards of that size, as few as
    the packing finds, instead of a number of them; a group beyond the capacity is alone.
    A null text counts as empty and belongs to the group of the empty text.  Slots are
    numbered from 0 in each shard in the order of ``id_col``, null ids first.  ``payload``:
    the columns passed on besides the id, by default all others; those named like a result
    are replaced.
    """
    plain, names = numbered(df)
    carried = [c for c in df.columns if c == id_col or payload is None or c in payload]
    kept = [names[c] for c in carried]
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit("")).cast("binary")
    rows = plain.select(
        *kept, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("_group")
    )
    rows = settle(rows, "sized")
    found = settle(group_shards(rows, shards, capacity), "shards")
    joined = rows.join(found, "_group").select(*kept, "size", "text_crc32", "shard")
    order = [F.col(names[id_col]).asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    slotted = placed(joined, ["shard"], order, "slots", "slot").withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
    return restored(slotted, df.select(*[col(c) for c in carried]), names, *RESULT)
