"""Decisions that depend on measured sizes: broadcasting and spreading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024
SPLIT_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 48


def measured_bytes(df: DataFrame) -> int:
    """Size of a materialised table, from its own rows."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length(F.to_json(F.struct("*"))).cast("bigint")).alias("chars"),
    ).first()
    return (row["n"] or 0) * ROW_OVERHEAD + (row["chars"] or 0)


class Lookup:
    """A table to look keys up in, materialised and measured once.

    Within ``limit`` bytes it is broadcast. Beyond it both sides are shuffled, with the lookup
    repeated once per salt so that a key holding a large share of the rows is spread over
    ``salts`` tasks. The planner sees the stored size only, a tenth or less of that in memory, and
    not the repeats, so it is told not to broadcast them.
    """

    def __init__(self, table: DataFrame, limit: int = BROADCAST_BYTES, salts: int = 32):
        self.table = cut_lineage(table)
        self.bytes = measured_bytes(self.table)
        self.fits = self.bytes <= limit
        self.salts = salts

    def join(self, rows: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
        keys = [on] if isinstance(on, str) else list(on)
        if self.fits:
            return rows.join(F.broadcast(self.table), keys, how)
        salted = rows.withColumn("_salt", F.spark_partition_id() % self.salts)
        repeated = self.table.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1)))
        )
        return salted.join(repeated.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a small table stored in fewer files than there are cores.

    Only a table below one split per core is shuffled, so the cost is bounded; larger tables and those
    of many files keep the partitions of their scan.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) >= cores * SPLIT_BYTES or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(4 * cores)
