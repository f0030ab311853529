"""Contiguous ranges of lines: ceil(N / g) lines each, the last one shorter.

A global row number would need all rows in one task. Here rows are numbered within
their block (a file split, or a sort partition), the blocks' row counts are summed up
(one small row per block), and each row adds its block's offset.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_dir

_ROW_BITS = 33
FILE_BLOCKS = ("line_file", "line_block")
#: Blocks whose offsets are sent to every task (some 200 bytes each); more are joined by a shuffle.
MAP_BLOCKS = 100_000


@dataclass(frozen=True)
class RangePlan:
    """Where the ranges of a stored frame's rows begin.

    ``offsets`` has a row per block: what to add to a line's id to get its place, the place of the
    block's first line and its number of lines.
    """

    offsets: DataFrame
    blocks: tuple[str, ...]
    block_count: int
    total: int
    ranges: int

    @property
    def size(self) -> int:
        return max(1, ceil(self.total / self.ranges))

    @property
    def count(self) -> int:
        """Ranges that have lines."""
        return ceil(self.total / self.size)

    def lines_of(self, number: int) -> int:
        return min(self.size, self.total - number * self.size)

    def label(self, df: DataFrame, line_id: str = "line_id", label: str = "partition") -> DataFrame:
        """Adds the 0-based range of each row."""
        placed = attach_offsets(df, self.offsets, self.blocks, self.block_count)
        place = F.expr(f"CAST((_offset + {line_id}) div {self.size} AS INT)")
        return placed.withColumn(label, place).select(*[c for c in df.columns if c != label], label)

    def spans(self, numbers: list[int]) -> Column:
        """A condition on the first block column that holds for all lines of these ranges; storage can skip the rest."""
        first, last = min(numbers) * self.size, (max(numbers) + 1) * self.size
        held = self.offsets.filter((F.col("_before") < last) & (F.col("_before") + F.col("_rows") > first))
        name = self.blocks[0]
        low, high = held.agg(F.min(f"_{name}"), F.max(f"_{name}")).first()
        return F.col(name).between(low, high)


def plan_ranges(
    df: DataFrame, ranges: int, blocks: tuple[str, ...] = FILE_BLOCKS, line_id: str = "line_id"
) -> RangePlan:
    """Ranges of a stored frame (a table or a checkpoint, since ids may differ between two evaluations of a query).

    It must hold all rows of each block; the ids of a block are gapless. The only pass over the rows counts
    them per block; the window sees one row per block.
    """
    offsets = block_offsets(df, blocks, line_id)
    count, total = offsets.agg(F.count("*"), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    return RangePlan(offsets, blocks, count, total, ranges)


def label_ranges(
    df: DataFrame, ranges: int, blocks: tuple[str, ...] = FILE_BLOCKS, line_id: str = "line_id", label: str = "partition"
) -> DataFrame:
    """Adds the 0-based range of each row, by the order of its block and, within it, of ``line_id``."""
    return plan_ranges(df, ranges, blocks, line_id).label(df, line_id, label)


def attach_offsets(df: DataFrame, offsets: DataFrame, blocks: tuple[str, ...], block_count: int) -> DataFrame:
    """Rows with the columns of their block's offsets; no row is shuffled while the map of blocks is small."""
    return df.join(F.broadcast(offsets) if block_count <= MAP_BLOCKS else offsets, _same(blocks), "left")


def block_offsets(df: DataFrame, blocks: tuple[str, ...], line_id: str = "line_id") -> DataFrame:
    """Per block (under names with an underscore): _offset, _before and _rows (see ``RangePlan``)."""
    shared_dir(df.sparkSession)
    sizes = df.groupBy(*[F.col(b).alias(f"_{b}") for b in blocks]).agg(
        F.count("*").alias("_rows"), F.min(line_id).alias("_first")
    )
    earlier = Window.orderBy(*[f"_{b}" for b in blocks]).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    placed = sizes.select(*[f"_{b}" for b in blocks], "_rows", "_first", before)
    return placed.select("*", (F.col("_before") - F.col("_first")).alias("_offset")).drop("_first").checkpoint()


def range_split(df: DataFrame, order: list[str], ranges: int, label: str = "partition") -> DataFrame:
    """Sorts by ``order`` and adds the contiguous range of each row.

    Equal keys are told apart by their place in the input, so a key held by many
    rows is spread over several sort partitions. The sorted rows are checkpointed.
    """
    shared_dir(df.sparkSession)
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    ordered = placed.orderBy(*order, "_place").drop("_place").withColumn("_line", F.monotonically_increasing_id())
    stored = ordered.withColumn("_task", F.shiftright("_line", _ROW_BITS)).checkpoint()
    return label_ranges(stored, ranges, ("_task",), "_line", label).drop("_line", "_task")


def range_bounds(labelled: DataFrame, blocks: tuple[str, ...] = FILE_BLOCKS, line_id: str = "line_id") -> DataFrame:
    """First and last line of each range as it was written (startLine, endLine, partition); line 1 is the header."""
    plan = plan_ranges(labelled, 1, blocks, line_id)
    placed = attach_offsets(labelled, plan.offsets, blocks, plan.block_count)
    line = F.col("_offset") + F.col(line_id) + 2
    return placed.groupBy("partition").agg(F.min(line).alias("startLine"), F.max(line).alias("endLine")).select(
        "startLine", "endLine", "partition"
    )


def _same(blocks: tuple[str, ...]):
    condition = F.lit(True)
    for block in blocks:
        condition &= F.col(block).eqNullSafe(F.col(f"_{block}"))
    return condition
