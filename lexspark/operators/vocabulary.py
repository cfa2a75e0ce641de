"""Vocabulary tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import is_letters
from lexspark.operators.packed import looked_up
from lexspark.plans.sizing import Lookup


def frequent_words(tokens: DataFrame, min_count: int = 5) -> DataFrame:
    """Letter-only words seen at least ``min_count`` times. Letters are looked for in counted words, not in
    every token: a condition that needs the count stays behind the aggregation."""
    return (
        tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where(F.when(F.col("n") >= min_count, is_letters(F.col("word"))))
        .select("word")
    )


def effective_vocabulary(vocabulary: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Distinct vocabulary words that are not stopwords."""
    return vocabulary.join(stopwords, "word", "left_anti").distinct()


def keep_vocabulary(rows: DataFrame, vocabulary: DataFrame | Lookup) -> DataFrame:
    """Rows whose ``word`` is in the vocabulary."""
    lookup = vocabulary if isinstance(vocabulary, Lookup) else Lookup(vocabulary)
    return lookup.join(rows, "word", "left_semi")


def keep_vocabulary_tokens(sents: DataFrame, vocabulary: DataFrame | Lookup, tokens: Callable[..., DataFrame]) -> DataFrame:
    """``keep_vocabulary`` of the rows that ``tokens`` makes of sentences.

    A vocabulary too large to broadcast marks the words inside their sentences, before there is a row per
    token: ``tokens(sents, listed=...)`` then makes rows of marked words only.
    """
    lookup = vocabulary if isinstance(vocabulary, Lookup) else Lookup(vocabulary)
    if lookup.fits:
        return keep_vocabulary(tokens(sents), lookup)
    words = lookup.table.select(F.col("word").cast("string")).distinct()
    return tokens(looked_up(sents, "words", words.withColumn("value", F.lit(1)), "_listed"), listed=F.col("_listed"))
