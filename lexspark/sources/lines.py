"""Line-oriented text files: manifests, word lists, title weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.text import first_field, trim_space
from lexspark.plans.lineage import cut_lineage


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with sort keys for their place in the file: (file, block, line).

    ``block`` is the offset of the split a line was read from and ``line`` grows inside a split, so
    file order is known without reading a file in one task.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def _place() -> Column:
    return F.struct("file", "block", "line")


def read_manifest(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Document file names in manifest order, the first ``limit`` of them (None: all)."""
    names = (
        read_lines(spark, path)
        .withColumn("path", trim_space(F.col("value"))).where(F.col("path") != "")
        .select("path", _place().alias("ord"))
    )
    return names if limit is None else names.orderBy("ord").limit(limit)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary or stopwords: first field of every line, lower-cased, distinct."""
    return (
        spark.read.text(path).select(first_field(F.col("value")).alias("word"))
        .where(F.col("word") != "").distinct()
    )


def _weights(spark: SparkSession, path: str) -> DataFrame:
    fields = F.split(trim_space(F.col("value")), r"[\s\x0b\x1c-\x1f\x85\p{Z}]+")
    return (
        read_lines(spark, path)
        .where(F.size(fields) == 2)
        .select(
            F.replace(F.get(fields, F.lit(0)), F.lit("_"), F.lit(" ")).alias("title"),
            F.get(fields, F.lit(1)).try_cast("bigint").alias("pageviews"),
            _place().alias("ord"),
        )
        .where(F.col("pageviews").isNotNull())
    )


def read_title_weights(spark: SparkSession, path: str) -> DataFrame:
    """Title and page views; a title listed again keeps its later count. Other rows are skipped."""
    return _weights(spark, path).groupBy("title").agg(
        F.max_by("pageviews", "ord").alias("pageviews")
    )


def count_rejected_weights(spark: SparkSession, path: str) -> DataFrame:
    """Number of non-blank rows the reader above skips."""
    lines = read_lines(spark, path).where(trim_space(F.col("value")) != "")
    fields = F.split(trim_space(F.col("value")), r"[\s\x0b\x1c-\x1f\x85\p{Z}]+")
    good = (F.size(fields) == 2) & F.get(fields, F.lit(1)).try_cast("bigint").isNotNull()
    return lines.agg(F.count_if(~good).alias("rejected"))


def top_titles(weights: DataFrame, n: int | None = None) -> DataFrame:
    """The ``n`` most viewed titles (None: all)."""
    if n is None:
        return weights
    return weights.orderBy(F.desc("pageviews"), F.asc("title")).limit(n)


def first_titles(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """The first ``n`` distinct titles in file order (None: all).

    Reading ends where the ``n``-th title appears, so repeats after it do not change counts.
    """
    if n is None:
        return read_title_weights(spark, path)
    rows = cut_lineage(_weights(spark, path))
    seen = rows.groupBy("title").agg(F.min("ord").alias("first"))
    last = seen.orderBy("first").limit(n).agg(F.max("first").alias("last"))
    # one row: the place where reading ends
    return (
        rows.join(F.broadcast(last), F.col("ord") <= F.col("last"))
        .groupBy("title").agg(F.max_by("pageviews", "ord").alias("pageviews"))
    )
