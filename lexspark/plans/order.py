"""Positions in a total order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage
from lexspark.plans.sizing import Lookup


def ranges(df: DataFrame, *order: Column) -> DataFrame:
    """Range-partition by ``order`` and fix each row's range number in ``_part``.

    The result is materialised: later passes must see the same ranges.
    """
    return cut_lineage(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )


def with_position(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Number the rows 0, 1, ... in a total order.

    Rows are numbered inside their range and shifted by the sizes of the ranges before it; only one
    row per range meets in a single task.
    """
    placed = ranges(df, *order)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n") + start).alias("_before"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        Lookup(offsets).join(placed.withColumn("_row", F.row_number().over(inside) - 1), "_part")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_part", "_before", "_row")
    )
