"""Row-frame windows over long series, split into overlapping blocks.

A window over `partitionBy(keys)` sorts a whole series in one task; without keys that is
the whole table. Every frame used here looks back (or ahead) a bounded number of rows, so
a series is cut into blocks of consecutive positions and each block also receives copies
of the rows its frames can reach. Results are exact, one exchange serves all frames, and
a long or only series runs on as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.timebins import seconds_of

BLOCK_ROWS = 8192
_CHUNK_SECONDS = 30 * 86400


def with_dense_position(df: DataFrame, keys: list[str], ts: str, name: str = "_pos") -> DataFrame:
    """Add the 0-based rank of each row in its series.

    Rows are numbered and counted inside 30-day chunks. The first row of every chunk meets those of the other chunks of its
    series, one each, which gives it the rows before, and hands that on to its chunk. The input is read once.
    """
    chunk = Window.partitionBy(*keys, "_chunk")
    heads = Window.partitionBy(*keys, "_part").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("_chunk", F.floor(seconds_of(ts) / F.lit(_CHUNK_SECONDS))) \
        .withColumns({"_nth": F.row_number().over(chunk.orderBy(ts)), "_cn": F.count(F.lit(1)).over(chunk)})
    head = F.col("_nth") == 1
    return placed.withColumn("_part", F.when(~head, F.coalesce("_chunk", F.lit(-1 << 62)))) \
        .withColumn("_off", F.when(head, F.coalesce(F.sum("_cn").over(heads), F.lit(0)))) \
        .withColumn(name, F.max("_off").over(chunk) + F.col("_nth") - 1).drop("_chunk", "_nth", "_cn", "_part", "_off")


def with_successor(df: DataFrame, keys: list[str], ts: str, name: str = "_next") -> DataFrame:
    """Add the time of each row's successor in its series, NULL for the last row.

    Rows are ordered inside 30-day chunks. The first and last rows of all chunks of a series, two each, are ordered once
    more among themselves, which carries the successor over chunk borders and holes of any length.
    """
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    placed = df.withColumn("_chunk", F.floor(seconds_of(ts) / F.lit(_CHUNK_SECONDS))) \
        .withColumns({"_inner": F.lead(ts).over(inside), "_nth": F.row_number().over(inside)})
    edge = F.col("_inner").isNull() | (F.col("_nth") == 1)
    ends = Window.partitionBy(*keys, "_part").orderBy(ts)
    return placed.withColumn("_part", F.when(~edge, F.col("_chunk"))) \
        .withColumn(name, F.coalesce("_inner", F.lead(ts).over(ends))).drop("_chunk", "_inner", "_nth", "_part")


def positioned(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Add `_pos`, the row's number in its series, or keep it where it is known already.

    Frames count rows, so positions do too, whatever the grid: rows may be missing anywhere.
    """
    return df if "_pos" in df.columns else with_dense_position(df, keys, ts)


def overlapping(df: DataFrame, back: int, ahead: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add `_blk` and `_own`, copying rows into the blocks whose frames reach them."""
    size = max(block_rows, back, ahead, 1)
    blk = F.floor(F.col("_pos") / F.lit(size)).cast("bigint")
    inner = F.pmod(F.col("_pos"), F.lit(size))
    targets = F.array(
        blk,
        F.when(inner >= size - back, blk + 1),
        F.when(inner < ahead, blk - 1),
    )
    return df.withColumn("_blk", F.explode(F.filter(targets, lambda b: b.isNotNull()))) \
        .withColumn("_own", F.col("_blk") == blk)


def block_window(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys, "_blk").orderBy("_pos")


def own_rows(df: DataFrame) -> DataFrame:
    """Keep each row once, in the block that owns it."""
    return df.where("_own").drop("_pos", "_blk", "_own")
