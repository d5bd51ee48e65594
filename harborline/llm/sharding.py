"""Sharding by minimax contiguous partition: equal texts stay together, and the largest shard is as small as can be.

Rows with equal texts are one atomic group (texts of one 64-bit hash: where two texts share theirs, both stay together,
which does no harm). Groups are ordered by hash. A group of more than an even share of what is left stands alone, in front
of the order (there are fewer of these than shards); the others are cut at places of the order into the shards left. The
least capacity that holds is found by binary search, each capacity checked greedily; where several cuts keep to it, those
nearest to even shares are taken.

Sums by hash are a table of Spark's, as long as there are different texts. The driver sees the sums of about sqrt(groups)
blocks of the order, and the groups of the few blocks that cuts fall into, up to BLOCKS_HELD of them at a time. As the order
is that of hashes, a row's shard follows from its own text and the cuts, without a join.

Numbers within a shard (slots) have two levels: rows are dealt to cells of about CELL_BYTES by a hash of key and text, cells
are counted, and rows are numbered within cells; so copies of one text, which share a shard, are numbered by many tasks.
Only rows equal in key and text share a cell for certain; between these the order is open.

A null text counts as an empty one, of 0 bytes; a row's size is its bytes and 1. Null or repeated keys are keys like others.
Columns of docs are kept; outputs whose names are taken get an underscore in front. Without rows all shards are empty.
"""

import uuid
from collections import OrderedDict

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm import native
from harborline.llm.store import shared_dir, written

SHARDS, CELL_BYTES, BLOCKS_HELD, SEED = 8, 32 << 20, 256, "shard-1"
PLACE_BITS = 20


class _Order:
    """Prefix sums over the groups in order of hash; blocks of groups are fetched when a cut falls into them."""

    def __init__(self, groups: DataFrame, n_groups: int) -> None:
        self.bits = max(1, (max(1, n_groups).bit_length() + 1) // 2)
        block = F.shiftright("h", 64 - self.bits)
        self.table = written(groups.select("h", "bytes").repartitionByRange("h").sortWithinPartitions("h"), "shard-groups")
        sums = self.table.groupBy(block.alias("block")).agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest")).toArrow()
        found = {c: sums.column(c).to_numpy() for c in sums.column_names}
        order = np.argsort(found["block"])
        self.block = found["block"][order].astype(np.int64)
        self.ends = np.cumsum(found["bytes"][order].astype(np.int64))
        self.starts = self.ends - found["bytes"][order].astype(np.int64)
        self.total = int(self.ends[-1]) if len(order) else 0
        self.largest = int(found["largest"].max()) if len(order) else 0
        self.held: OrderedDict[int, tuple[np.ndarray, np.ndarray]] = OrderedDict()

    def _low(self, i: int) -> int:
        """The least hash that block i may hold."""
        return int(self.block[i]) << (64 - self.bits)

    def fetch(self, wanted: set[int]) -> None:
        missing = sorted(wanted - self.held.keys())
        if not missing:
            return
        within = F.lit(False)
        for i in missing:
            within = within | F.col("h").between(self._low(i), self._low(i) + (1 << 64 - self.bits) - 1)
        rows = self.table.filter(within).toArrow()
        h, size = rows.column("h").to_numpy().astype(np.int64), rows.column("bytes").to_numpy().astype(np.int64)
        order = np.argsort(h)
        h, size = h[order], size[order]
        edges = np.searchsorted(h >> np.int64(64 - self.bits), self.block[missing], "left")
        for i, a, b in zip(missing, edges, [*edges[1:], len(h)], strict=True):
            self.held[i] = h[a:b], self.starts[i] + np.cumsum(size[a:b])
        while len(self.held) > max(BLOCKS_HELD, len(missing)):
            self.held.popitem(last=False)

    def holding(self, x: int) -> int:
        """The block that the sum x falls into."""
        return min(int(np.searchsorted(self.ends, x, "right")), len(self.block) - 1)

    def _block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        self.fetch({i})
        self.held.move_to_end(i)
        return self.held[i]

    def below(self, x: int) -> tuple[int, int]:
        """The greatest sum of whole groups that is at most x, and the last hash that it holds (or one before the next)."""
        i = self.holding(x)
        hashes, ends = self._block(i)
        j = int(np.searchsorted(ends, x, "right")) - 1
        return (int(self.starts[i]), self._low(i) - 1) if j < 0 else (int(ends[j]), int(hashes[j]))

    def above(self, x: int) -> tuple[int, int]:
        """The least sum of whole groups that is more than x."""
        hashes, ends = self._block(self.holding(x))
        j = int(np.searchsorted(ends, x, "right"))
        return (int(ends[j]), int(hashes[j])) if j < len(ends) else self.below(x)


def _fits(order: _Order, capacity: int, shards: int, at: int = 0) -> bool:
    """Whether the groups behind the sum `at` fill at most so many shards: each takes as many as it can."""
    order.fetch({order.holding(min(at + k * capacity, order.total)) for k in range(1, shards + 1)})
    for _ in range(shards):
        if at + capacity >= order.total:
            return True
        after, _ = order.below(at + capacity)
        if after == at:
            return False
        at = after
    return False


def _cuts(order: _Order, shards: int) -> tuple[int, list[int]]:
    """The least capacity of the largest shard, and the last hash of each shard but the last."""
    if not order.total:
        return 0, []
    low = max(-(-order.total // shards), order.largest)
    high = max(low, -(-order.total // shards) + order.largest)
    while low < high:
        middle = (low + high) // 2
        if _fits(order, middle, shards):
            high = middle
        else:
            low = middle + 1
    at, cuts = 0, []
    for left in range(shards, 1, -1):
        even = at + -(-(order.total - at) // left)
        choices = sorted([order.below(even), order.above(even)], key=lambda c: abs(c[0] - even))
        for choice in [*choices, order.below(min(at + low, order.total))]:
            if at <= choice[0] <= at + low and _fits(order, low, left - 1, choice[0]):
                break
        at = choice[0]
        cuts.append(choice[1])
    return low, cuts


def plan(sums: DataFrame, shards: int) -> tuple[dict[int, int], list[int], int]:
    """From rows of h and bytes: the groups that stand alone with their shards, the cuts between the other shards, and the
    bytes of the largest shard."""
    groups = sums.groupBy("h").agg(F.sum("bytes").alias("bytes"))
    whole = groups.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    left, alone, largest = whole["bytes"] or 0, {}, 0
    for row in groups.orderBy(F.desc("bytes"), "h").limit(shards - 1).collect():
        if row["bytes"] * (shards - len(alone)) <= left:
            break
        left -= row["bytes"]
        largest = max(largest, row["bytes"])
        alone[row["h"]] = len(alone)
    order = _Order(groups.filter(~F.col("h").isin(list(alone))) if alone else groups, whole["n"])
    capacity, cuts = _cuts(order, shards - len(alone))
    return alone, cuts, max(largest, capacity)


def names(docs: DataFrame) -> dict[str, str]:
    return {n: native.name(docs, n) for n in ("size", "shard", "slot")}


def assign(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """docs with size, shard (from 0) and slot (from 0 within the shard, without gaps), ordered by shard and slot in each partition."""
    out = names(docs)
    whole = native.whole(text)
    h: Column = F.xxhash64(whole)
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key), whole), 64 - PLACE_BITS)
    size = F.octet_length(whole).cast("long") + 1
    sums = written(docs.select(h.alias("h"), place.alias("place"), size.alias("size")).groupBy("h", "place").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-sums")
    alone, cuts, _ = plan(sums, shards)

    def shard(of: Column) -> Column:
        found = sum(((of > F.lit(c)).cast("int") for c in cuts), F.lit(len(alone)))
        for group, number in alone.items():
            found = F.when(of == F.lit(group), number).otherwise(found)
        return found.cast("int")

    cells = max(1, (sums.agg(F.sum("bytes").alias("b")).first()["b"] or 0) // shards // CELL_BYTES)
    cell = lambda p: F.shiftright(p * F.lit(cells), PLACE_BITS)
    counts = sums.groupBy(shard(F.col("h")).alias("__s"), cell(F.col("place")).alias("__c")).agg(F.sum("n").alias("n"))
    along = Window.partitionBy("__s").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select("__s", "__c", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("__before")), "shard-starts")
    placed = docs.select(F.struct(*docs.columns).alias("__row"), F.col(key).alias("__key"), size.alias("__size"), h.alias("__h"), place.alias("__place")).withColumns({"__s": shard(F.col("__h")), "__c": cell(F.col("__place"))})
    within = Window.partitionBy("__s", "__c").orderBy("__place", "__key", "__h")
    return placed.join(starts, ["__s", "__c"]).select(
        *[F.col("__row").getField(c).alias(c) for c in docs.columns], F.col("__size").alias(out["size"]), F.col("__s").alias(out["shard"]), (F.col("__before") + F.row_number().over(within) - 1).alias(out["slot"]))


def write(docs: DataFrame, path: str | None = None, **options) -> tuple[str, DataFrame]:
    """Writes a folder of Parquet files for each shard, rows in the order of slots within a file; the path, and the rows
    read from it. options: those of `assign`."""
    path = path or f"{shared_dir(docs.sparkSession).rstrip('/')}/harborline/shards-{uuid.uuid4().hex}"
    made = assign(docs, **options)
    made.write.partitionBy(names(docs)["shard"]).parquet(path)
    return path, docs.sparkSession.read.schema(made.schema).parquet(path)


def read(spark: SparkSession, path: str, shard: int | None = None) -> DataFrame:
    """All shards' rows, or one shard's."""
    found = spark.read.parquet(path)
    return found if shard is None else found.filter(F.col("shard") == shard)


def digest(docs: DataFrame) -> DataFrame:
    _, rows = write(docs.select("doc_id", "text"))
    return rows.select("doc_id", "size", F.crc32(native.whole("text").cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
