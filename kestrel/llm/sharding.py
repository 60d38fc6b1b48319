"""Operator 9 - minimax contiguous shards of atomic groups.

Groups are rows of equal text, ordered by their smallest ``doc_id``.  The
smallest capacity with which a greedy pass over the ordered group sizes
needs at most ``n_shards`` shards is found by binary search; the greedy
cuts at that capacity are the shards.

The group sizes stay distributed.  The driver sees their running sums only
through cells: at most ``CELLS`` (first, last) sums over equal stretches of
bytes.  A greedy pass over cells brackets each cut; where the bracket leaves a
capacity undecided, just the cells it passed through are split into smaller
ones by one Spark job, so that every answer is exact.

Defined results
    null text: size 8, crc 0, in the group of the empty text; null
    ``doc_id``: ordered first; equal rows: each is placed, in its group's shard;
    an empty table gives no row; a group larger than an even share
    fills a shard alone or with its neighbours; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialise

CELLS = 1 << 16
#: Bits of a row's number inside its partition in ``monotonically_increasing_id``.
ROW_BITS = 33


def _numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` written in range partitions of ``order``; ``_part`` and ``_row`` are a
    row's partition and place in it, fixed by the written files."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    out = materialise(ordered.withColumn("_id", F.monotonically_increasing_id()), name)
    return out.select(*df.columns, F.shiftright("_id", ROW_BITS).alias("_part"),
                      F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"))


def _before(df: DataFrame, amount: Column) -> DataFrame:
    """One row per partition: what all earlier partitions hold."""
    per = df.groupBy("_part").agg(F.sum(amount).alias("_n"))
    return per.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))


def running_sums(groups: DataFrame, size: str, order: list[Column]) -> DataFrame:
    """``groups`` with ``end``: the sum of ``size`` up to and with this row in order."""
    rows = _numbered(groups, order, "groups")
    local = F.sum(size).over(Window.partitionBy("_part").orderBy("_row"))
    return rows.withColumn("_local", local).join(F.broadcast(_before(rows, F.col(size))), "_part") \
        .select(*groups.columns, (F.col("_before") + F.col("_local")).alias("end"))


class Cells:
    """Known running sums: of each cell the first and the last one in it."""

    def __init__(self, sums: DataFrame, total: int, cells: int = CELLS):
        self.sums, self.cells = sums, cells
        step = max(1, -(-total // cells))
        self.first, self.last = self._read([(0, total, step)])

    def _read(self, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Cells of ``step`` bytes over each span (after, up to, step)."""
        cell, inside = F.lit(None).cast("long"), F.lit(False)
        base = 0
        for a, b, step in spans:
            here = (F.col("end") > a) & (F.col("end") <= b)
            cell = F.when(here, F.floor((F.col("end") - a - 1) / step) + base).otherwise(cell)
            inside = inside | here
            base += -(-(b - a) // step)
        rows = self.sums.where(inside).groupBy(cell.alias("cell")) \
            .agg(F.min("end").alias("first"), F.max("end").alias("last")).select("first", "last").collect()
        out = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 2)
        out = out[np.argsort(out[:, 0])]
        return out[:, 0], out[:, 1]

    def split(self, which: set[int]) -> None:
        spans = [(int(self.first[i]), int(self.last[i]), max(1, -(-int(self.last[i] - self.first[i]) * len(which) // self.cells)))
                 for i in sorted(which)]
        first, last = self._read(spans)
        keep = np.ones(len(self.first), bool)
        keep[list(which)] = False
        alone = self.first[~keep]  # the first sum of a split cell stays as a cell of its own
        first = np.concatenate([self.first[keep], alone, first])
        last = np.concatenate([self.last[keep], alone, last])
        order = np.argsort(first)
        self.first, self.last = first[order], last[order]

    def cut(self, upto: int, most: bool) -> tuple[int, int | None]:
        """The last running sum <= ``upto``: (a bound, the cell that leaves it open)."""
        i = int(np.searchsorted(self.first, upto, "right")) - 1
        if i < 0:
            return 0, None
        if self.last[i] <= upto:
            return int(self.last[i]), None
        return (min(upto, int(self.last[i]) - 1) if most else int(self.first[i])), i

    def greedy(self, capacity: int, n: int, total: int, most: bool) -> tuple[list[int], set[int], bool]:
        cuts, open_cells, at = [], set(), 0
        for _ in range(n):
            at, cell = self.cut(at + capacity, most)
            cuts.append(at)
            if cell is not None:
                open_cells.add(cell)
            if at >= total:
                break
        return cuts, open_cells, at >= total

    def feasible(self, capacity: int, n: int, total: int) -> bool:
        while True:
            _, low, fits = self.greedy(capacity, n, total, most=False)
            if fits:
                return True
            _, high, may_fit = self.greedy(capacity, n, total, most=True)
            if not may_fit:
                return False
            self.split(low | high)

    def cuts(self, capacity: int, n: int, total: int) -> list[int]:
        while True:
            cuts, open_cells, _ = self.greedy(capacity, n, total, most=False)
            if not open_cells:
                return cuts
            self.split(open_cells)


def minimax_cuts(sums: DataFrame, n_shards: int, total: int, largest: int, cells: int = CELLS) -> tuple[int, list[int]]:
    """(smallest feasible capacity, running sums at which its greedy shards end)."""
    known = Cells(sums, total, cells)
    low = max(-(-total // n_shards), largest)
    high = low + largest  # a shard closes only when less than ``largest`` is left in it
    while low < high:
        mid = (low + high) // 2
        if known.feasible(mid, n_shards, total):
            high = mid
        else:
            low = mid + 1
    return low, known.cuts(low, n_shards, total)


def minimax_shards(docs: DataFrame, n_shards: int, cells: int = CELLS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, group_first, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("key")), "shard-rows")
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("group_first"), F.sum("size").alias("bytes"))
    sums = materialise(running_sums(groups, "bytes", [F.col("group_first").asc_nulls_first(), F.col("key")]), "shard-sums")
    total, largest = sums.agg(F.sum("bytes"), F.max("bytes")).first()
    cuts = minimax_cuts(sums, n_shards, total, largest, cells)[1] if total else []
    shard = sum(((F.col("end") > c).cast("int") for c in cuts[:-1]), F.lit(0))
    placed = rows.join(sums.select("key", "group_first", "end", shard.alias("shard")), "key")
    placed = _numbered(placed, [F.col("end"), F.col("doc_id").asc_nulls_first()], "shard-placed")
    at = placed.join(F.broadcast(_before(placed, F.lit(1))), "_part").withColumn("_at", F.col("_before") + F.col("_row"))
    starts = at.groupBy("shard").agg(F.min("_at").alias("_start"))  # one row per shard
    return at.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "group_first", "shard", (F.col("_at") - F.col("_start")).alias("slot"))


def op9_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return minimax_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"), "group_first")
