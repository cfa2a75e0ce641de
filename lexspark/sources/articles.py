"""Extractor files: articles between ``<doc ...>`` and ``</doc>`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions.binding import let
from lexspark.functions.text import doc_title, trim_space
from lexspark.sources import splits

_OPEN = r"(?m)^[ \t]*<doc"
_BLOCK = r"(?ms)^[ \t]*<doc.*?^[ \t]*</doc>"
_CLOSE = r"(?m)^[ \t]*</doc>"
_BLANK_END = r"\s*\z"


def _join_lines(body: Column) -> Column:
    return F.array_join(F.transform(F.split(body, "\n"), trim_space), " ")


def _title_and_article(block: Column) -> Column:
    """Parse one block that ends before its closing line; the last opening line counts."""

    def parse(text: Column) -> Column:
        cut = F.instr(text, "\n")
        header = F.when(cut > 0, F.substring(text, F.lit(1), cut - 1)).otherwise(text)
        # the line break after the header and the one before the closing line are no content
        body = F.regexp_replace(F.when(cut > 0, F.substring(text, cut + 1, F.length(text))), r"\n\z", "")
        return F.struct(
            doc_title(header).alias("title"),
            F.coalesce(_join_lines(body), F.lit("")).alias("article"),
        )

    return let(F.element_at(F.split(block, _OPEN), -1), parse)


def read_articles(
    spark: SparkSession, paths: str | list[str], *, first_only: bool = False,
    splittable: bool | None = None,
) -> DataFrame:
    """Articles of extractor files: (file, ord, title, article).

    Lines are stripped and joined by one space, so blank lines leave double spaces. Text outside a
    block and an unclosed last article are dropped. A title without attribute is NULL. With
    ``first_only`` the first article of each file is read, also if it is not closed.

    Files are read whole, one row each, or with ``splittable`` by several tasks each, in two passes;
    both give the same articles. By default they are split if one is larger than a split.
    ``ord`` orders the articles of a file; it is a number, or a pair of numbers for split files.
    """
    if splittable is None:
        splittable = splits.worth_splitting(spark, paths)
    pieces = (_split_pieces if splittable else _whole_pieces)(spark, paths)
    kept = pieces if first_only else pieces.where("closed")
    articles = kept.select("file", "ord", _title_and_article(F.col("block")).alias("_a")).select(
        "file", "ord", "_a.title", "_a.article")
    if not first_only:
        return articles
    by_file = Window.partitionBy("file").orderBy("ord")
    return articles.withColumn("_n", F.row_number().over(by_file)).where("_n = 1").drop("_n")


def _whole_pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, ord, block, closed): every closed block, or what is left of a file without any."""
    closed = F.transform(F.regexp_extract_all("value", F.lit(_BLOCK), F.lit(0)), lambda b: F.struct(
        F.get(F.split(b, _CLOSE), F.lit(0)).alias("block"), F.lit(True).alias("closed")))
    rest = F.array(F.struct(F.regexp_replace("value", _BLANK_END, "").alias("block"), F.lit(False).alias("closed")))
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.posexplode(F.when(F.col("value").rlike(_BLOCK), closed).when(F.col("value").rlike(_OPEN), rest)).alias("ord", "_b"),
    ).select("file", "ord", "_b.block", "_b.closed")


def _split_pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The same of split files: a closing mark counts at the beginning of a line."""
    records = splits.read_records(spark, paths, "</doc>")
    narrow = records.select("file", "bytes", "split", "at", (F.octet_length("value") + 6).alias("n"),
                            (~F.col("value").rlike(r"\n[ \t]*\z")).alias("goes_on"))
    texts = splits.whole_texts(records, narrow, "</doc>")
    # only the first text of a file begins a line
    block = F.when(F.col("first"), F.col("value")).otherwise(F.concat(F.lit("\x01"), "value"))
    # spaces before a closing mark belong to its line; an unclosed end is stripped
    end = F.when(F.col("closed"), r"[ \t]*\z").otherwise(_BLANK_END)
    return texts.select("file", "ord", block.alias("block"), "closed").where(F.col("block").rlike(_OPEN)).withColumn(
        "block", F.regexp_replace(F.col("block"), end, F.lit("")))


def read_manifest_articles(
    spark: SparkSession, manifest: DataFrame, base: str = "", **options: bool,
) -> DataFrame:
    """Articles of the files a manifest lists. Only file names pass the driver, as for any scan."""
    names = [row["path"] for row in manifest.select("path").toLocalIterator()]
    return read_articles(spark, [f"{base}{name}" for name in names], **options)
