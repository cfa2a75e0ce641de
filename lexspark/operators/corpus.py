"""Articles -> sentences -> tokens -> scored word occurrences."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark.functions import text, trees
from lexspark.functions.forests import sentence_rows, token_rows
from lexspark.plans.sizing import Lookup

KEYS = ("doc_id", "sent_id", "tok_id")
TOKENS_PER_PART = 1 << 17


def keep_titles(articles: DataFrame, titles: DataFrame) -> DataFrame:
    """Articles whose title is among the given ones. Apply before the costly sentence stage."""
    return Lookup(titles.select("title")).join(articles, "title", "left_semi")


def sentences(articles: DataFrame) -> DataFrame:
    """(doc_id, title, article) -> one row per non-empty sentence.

    ``tokens`` are as written, ``words`` the same in lower case.
    """
    return (
        articles.select(
            "doc_id", "title",
            F.posexplode(text.split_sentences(F.col("article")))
            .alias("sent_id", "sentence"),
        )
        .where(F.col("sentence").rlike(r"\S"))
        .withColumn("tokens", text.split_tokens(F.col("sentence")))
        .withColumn("words", text.lower_all(F.col("tokens")))
    )


def with_words(sents: DataFrame, words: Sequence[str]) -> DataFrame:
    """Sentences with one of the words. Apply before the costly scores of all tokens."""
    return sents.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in words])))


def tokens(sents: DataFrame) -> DataFrame:
    """One row per token, lower-cased."""
    return sents.select(
        "doc_id", "sent_id", F.posexplode("words").alias("tok_id", "word")
    )


def sentence_lengths(sents: DataFrame) -> DataFrame:
    return sents.select("doc_id", "sent_id", F.size("tokens").alias("n_tokens"))


def with_chain_heads(sents: DataFrame, stopwords: Sequence[str]) -> DataFrame:
    """Add the default tree as a ``heads`` column; parsed corpora bring their own."""
    return sents.withColumn("heads", trees.chain_heads(F.col("words"), stopwords))


def with_parser(
    sents: DataFrame, parse: Callable[[pd.Series], pd.Series]
) -> DataFrame:
    """Add ``heads`` with a user's parser: batches of token arrays in, arrays of head indexes out."""
    schema = T.StructType([*sents.schema.fields, T.StructField("heads", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(heads=parse(batch["tokens"]))

    return sents.mapInPandas(run, schema)


def simplicity_per_token(heads: Column) -> Column:
    return trees.simplicity(trees.ancestor_counts(heads), trees.children_counts(heads))


def coverage_per_token(heads: Column) -> Column:
    return trees.span_coverage(trees.leftmost_ancestors(heads), trees.rightmost_children(heads))


def token_values(sents: DataFrame, values: Column, name: str) -> DataFrame:
    """Explode one per-token array computed inside the sentence row."""
    return sents.select("doc_id", "sent_id", F.posexplode(values).alias("tok_id", name))


def measured_tokens(sents: DataFrame, measures: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per token with measures of its place in the tree: ``ancestors``, ``children`` (whole
    numbers), ``simplicity``, ``coverage`` (shares).

    All sentences of an Arrow batch are measured at once. The batch is cut so that a part holds about
    ``TOKENS_PER_PART`` tokens; a longer sentence is one part. Tokens leave it as rows, but with
    columns to carry as arrays, which are exploded later: a batch never holds a text once per token.
    """
    names = list(measures)
    types = [T.LongType() if m in ("ancestors", "children") else T.DoubleType() for m in names]
    read = sents.select("doc_id", "sent_id", *carry, "words", "heads")
    given = read.schema.fields
    if carry:
        made, build = [*given[:-1], *[T.StructField(m, T.ArrayType(t)) for m, t in zip(names, types, strict=True)]], sentence_rows
    else:
        made, build = [*given[:-2], T.StructField("tok_id", T.IntegerType()), T.StructField("word", T.StringType()),
                       *map(T.StructField, names, types)], token_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.fill_null(batch.column(batch.num_columns - 1).value_lengths(), 0).to_numpy())
            start = 0
            while start < len(batch):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + TOKENS_PER_PART, "right")))
                yield build(batch.slice(start, stop - start), names)
                start = stop

    rows = read.mapInArrow(run, T.StructType(made))
    if not carry:
        return rows
    return rows.select(
        "doc_id", "sent_id", *carry, F.posexplode(F.arrays_zip("words", *names)).alias("tok_id", "_t")).select(
        "doc_id", "sent_id", "tok_id", *carry, F.col("_t.words").alias("word"), *[f"_t.{m}" for m in names])


def scored_tokens(
    sents: DataFrame, carry: Sequence[str] = (), score: Column | None = None
) -> DataFrame:
    """One row per token with its simplicity (or another per-token score array).

    ``carry`` names further columns to keep, such as title and sentence; leave it empty where rows
    are shuffled before most of them are dropped.
    """
    if score is None:
        return measured_tokens(sents, ["simplicity"], carry).select(
            "doc_id", "sent_id", "tok_id", *carry, "word", F.col("simplicity").alias("score"))
    zipped = F.zip_with(
        "words", score,
        lambda w, s: F.struct(w.alias("word"), s.alias("score")),
    )
    return sents.select(
        "doc_id", "sent_id", *carry, F.posexplode(zipped).alias("tok_id", "_t")
    ).select("doc_id", "sent_id", "tok_id", *carry, "_t.word", "_t.score")
