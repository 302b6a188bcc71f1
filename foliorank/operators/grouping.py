"""Exact positions inside groups of any size.

A plain ``row_number`` sends a whole group to one task. Here a group is cut into
cells that follow the order, rows are numbered inside their cell, and the
counts of the earlier cells are added. The counts are pre-aggregated before the
shuffle, and there are only as many of them as cells.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows one task is asked to sort for one group.
CELL_ROWS = 1_000_000


def position_in_group(
    df: DataFrame, group: Sequence[str], cell: Column, order: Sequence[str | Column]
) -> DataFrame:
    """Add ``position`` (from 1) and ``group_size`` to every row.

    ``cell`` must not fall along ``order``: every row of a lower cell comes
    before every row of a higher one.
    """
    group = list(group)
    celled = df.withColumn("_cell", cell)
    counts = celled.groupBy(*group, "_cell").agg(F.count("*").alias("_rows"))
    in_group = Window.partitionBy(*group)
    earlier = in_group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group,
        "_cell",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(in_group).alias("group_size"),
    )
    in_cell = Window.partitionBy(*group, "_cell").orderBy(*order)
    numbered = celled.withColumn("_row", F.row_number().over(in_cell))
    return (
        numbered.join(offsets, [*group, "_cell"])
        .withColumn("position", F.col("_before") + F.col("_row"))
        .drop("_cell", "_before", "_row")
    )


def hash_cell(key: Column, cells: Column | int) -> Column:
    """Cell of a hex digest: ``cells`` equal ranges of its first 32 bits."""
    first_bits = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    return F.floor(first_bits * cells / F.lit(float(1 << 32))).cast("bigint")


def dense_index(df: DataFrame, key: str, index: str, cells: int = 4096) -> DataFrame:
    """Number distinct keys 0, 1, 2, ... in the order of their digests.

    4096 cells keep each sort at a 4096th of the keys; only the 4096 counts meet
    in one task.
    """
    keyed = df.select(key).distinct().withColumn("_digest", F.md5(F.col(key).cast("string")))
    numbered = position_in_group(keyed, [], hash_cell(F.col("_digest"), cells), ["_digest", key])
    return numbered.select(key, (F.col("position") - 1).alias(index))
