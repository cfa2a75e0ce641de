"""Runs of equal labels in a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.plans.order import ranges
from lexspark.plans.sizing import Lookup


def label_runs(rows: DataFrame, order: str, label: str) -> DataFrame:
    """Add ``run``: 0, 1, ... for consecutive rows with equal labels.

    Rows are cut into ranges of ``order``; changes are counted inside each range and then shifted by
    what went before. Only one row per range meets in a single task.
    """
    placed = ranges(rows, F.asc(order))
    inside = Window.partitionBy("_part").orderBy(order)
    changed = (~F.lag(label).over(inside).eqNullSafe(F.col(label))).cast("bigint")
    marked = placed.withColumn(
        "_local", F.sum(F.when(F.row_number().over(inside) > 1, changed).otherwise(0)).over(inside)
    )
    in_order = Window.orderBy("_part")
    summary = marked.groupBy("_part").agg(
        F.min_by(label, order).alias("_first"), F.max_by(label, order).alias("_last"),
        F.max("_local").alias("_changes"),
    )
    breaks = F.when(F.lag("_part").over(in_order).isNull(), 0).otherwise(
        (~F.lag("_last").over(in_order).eqNullSafe(F.col("_first"))).cast("bigint")
    )
    offsets = (
        summary.withColumn("_break", breaks)
        .withColumn("_before", F.sum(F.col("_break") + F.col("_changes")).over(in_order)
                    - F.col("_changes"))
        .select("_part", "_before")
    )
    return (
        Lookup(offsets).join(marked, "_part")
        .withColumn("run", F.col("_before") + F.col("_local"))
        .drop("_part", "_before", "_local")
    )


def label_partition(rows: DataFrame, order: str, label: str) -> DataFrame:
    """Add ``part``: 0 up to the first change of the label, 1 after it."""
    return label_runs(rows, order, label).withColumn(
        "part", F.when(F.col("run") == 0, 0).otherwise(1)
    ).drop("run")
