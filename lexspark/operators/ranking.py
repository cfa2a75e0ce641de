"""Top-k example sentences per word."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark.functions import postings
from lexspark.plans.lineage import cut_lineage
from lexspark.plans.sizing import Lookup

OUTPUTS_PER_WORD = 3000
SUITABILITY_SCALE = 1000

# a vocabulary and its thresholds above this size are shuffled, not broadcast
VOCABULARY_BYTES = 16 * 1024 * 1024

# sentences of one part of the order, sentences packed at once, and parts that words are dealt to
PART_BYTES = 3 * 1024 * 1024
FLUSH_BYTES = 24 * 1024 * 1024
BUCKETS = 64
BATCH_BYTES = 1024 * 1024
# sentences shown to the driver by each task, and how much of each
SHOWN, SHOWN_CHARS = 64, 1024

_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def _allow_limit(spark: SparkSession, k: int) -> None:
    """The optimizer only limits groups before the shuffle up to this k; the plan is made later than this
    call, so the setting has to stay."""
    if int(spark.conf.get(_LIMIT_CONF)) < k:
        spark.conf.set(_LIMIT_CONF, str(k))


def top_k(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
    rank: str = "rank", salts: int = 64,
) -> DataFrame:
    """Best ``k`` rows per key, in two steps so that no task sees all rows of a hot key.

    Every map task first keeps its own best ``k`` per key; these meet per (key, salt), and only the
    ``salts * k`` best per key reach the last step.
    """
    _allow_limit(rows.sparkSession, k)
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_salt", F.spark_partition_id() % salts)
        .withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= k)
        .drop("_salt", "_r")
        .withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)
    )


def score_thresholds(scored: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """Per word the score of its k-th best occurrence, or its lowest one with fewer than k.

    Occurrences are counted per (word, score) inside each map task first. Of the distinct scores only
    the ``k`` best per (word, salt) are handed on, as the threshold is among the ``k`` best ones: the
    last step sees at most ``salts * k`` rows of a word, however many occurrences or scores it has.
    """
    return _thresholds(_score_counts(scored), k, salts)


def _score_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("word", "score").agg(F.count(F.lit(1)).alias("n"))


def _thresholds(counts: DataFrame, k: int, salts: int = 64) -> DataFrame:
    _allow_limit(counts.sparkSession, k)
    best_first = Window.partitionBy("word").orderBy(F.desc("score"))
    before = best_first.rowsBetween(Window.unboundedPreceding, -1)
    salted = Window.partitionBy("word", "_salt").orderBy(F.desc("score"))
    return (
        counts.withColumn("_salt", F.pmod(F.xxhash64("score"), F.lit(salts)))
        .withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= k).drop("_salt", "_r")
        .withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where(F.col("ahead") < k)
        .groupBy("word").agg(F.min("score").alias("threshold"))
    )


def example_order() -> list[Column]:
    """Best score first; ties by text, title and position, so that the order is total."""
    return [
        F.desc("score"), F.desc("sentence"), F.desc("title"),
        F.asc("doc_id"), F.asc("sent_id"), F.asc("tok_id"),
    ]


def top_examples(
    narrow: DataFrame, wide: DataFrame, vocabulary: DataFrame | Lookup, k: int = OUTPUTS_PER_WORD,
    limit: int = VOCABULARY_BYTES,
) -> DataFrame:
    """Best ``k`` occurrences per vocabulary word, ranked from 1.

    ``narrow`` and ``wide`` are the scored tokens of the same corpus without and with title and
    sentence. The narrow pass finds each word's threshold; only occurrences at or above it carry
    their text into the ranking shuffle. A vocabulary above ``limit`` bytes is not broadcast.
    """
    lookup = vocabulary if isinstance(vocabulary, Lookup) else Lookup(vocabulary)
    if not lookup.fits or lookup.bytes > limit:
        return _of_large_vocabulary(narrow, wide, lookup.table, k)
    thresholds = Lookup(score_thresholds(lookup.join(narrow, "word", "left_semi"), k))
    candidates = (
        thresholds.join(wide, "word").where(F.col("score") >= F.col("threshold")).drop("threshold")
    )
    return top_k(candidates, ["word"], example_order(), k)


def top_sentences(
    sents: DataFrame, vocabulary: DataFrame | Lookup, k: int = OUTPUTS_PER_WORD, limit: int = VOCABULARY_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``top_examples`` of all tokens of parsed sentences (with ``heads``), scored by simplicity.

    A sentence is shuffled once, packed with its tokens, to its part of the order that decides ties.
    From there each word's best ``k`` occurrences go to the word's bucket as a score and a number each, and
    those ranked come back to their sentences as numbers. No text is shuffled per token. A vocabulary
    above ``limit`` bytes meets the words in their buckets.
    """
    lookup = vocabulary if isinstance(vocabulary, Lookup) else Lookup(vocabulary)
    words = lookup.table.select(F.col("word").cast("string")).where("word IS NOT NULL")
    small = lookup.fits and lookup.bytes <= limit
    rows = sents.select(*postings.SENTENCE, "words", "heads")
    cuts = _cuts(rows, part_bytes)
    buckets = min(len(cuts) + 1, max(BUCKETS, len(cuts) // 2))
    known = sents.sparkSession.sparkContext.broadcast(_strings(words) if small else None)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return postings.records(batches, cuts, TaskContext.get().partitionId(), FLUSH_BYTES)

    def posted(key: tuple, table: pa.Table) -> pa.Table:
        bucket, made = postings.postings(postings.restored(table), known.value, k, buckets)
        return pa.table({"bucket": bucket, "part": pa.array(np.full(len(made), key[0].as_py(), np.int32)),
                         "data": pa.array(made, pa.binary())})

    def ranked(table: pa.Table, listed: pa.Array | None) -> pa.Table:
        part, made = postings.ranked(table, listed, k)
        return pa.table({"part": pa.array(part, pa.int32()), "data": pa.array(made, pa.binary())})

    def found(table: pa.Table, ranks: pa.Table) -> pa.Table:
        if not len(table) or not len(ranks):
            return made_of.empty_table()
        made = postings.hits(postings.restored(table), ranks["data"].to_pylist()).cast(made_of).combine_chunks()
        postings.release()
        # the JVM holds a batch at a time
        return pa.Table.from_batches(made.to_batches(max(1, len(made) * BATCH_BYTES // (made.nbytes + 1))), made_of)

    parts = rows.mapInArrow(packed, "part int, sentences binary, tokens binary")
    lists = parts.groupBy("part").applyInArrow(posted, "bucket int, part int, data binary").groupBy("bucket")
    if small:
        ranks = lists.applyInArrow(lambda t: ranked(t, None), "part int, data binary")
    else:
        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(postings.bucket_of(batch.column(0), buckets)), batch.column(0)], ["bucket", "word"])

        own = words.mapInArrow(dealt, "bucket int, word string").groupBy("bucket")
        ranks = lists.cogroup(own).applyInArrow(
            lambda t, w: ranked(t, w["word"].combine_chunks()), "part int, data binary")
    fields = [rows.schema[c] for c in postings.SENTENCE]
    hit = T.StructType([T.StructField("tok_id", T.IntegerType()), T.StructField("word", T.StringType()),
                        T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    made = T.StructType([*fields, T.StructField("hits", T.ArrayType(hit))])
    made_of = _arrow_schema(made)
    return parts.groupBy("part").cogroup(ranks.groupBy("part")).applyInArrow(found, made).select(
        *postings.SENTENCE, F.explode("hits").alias("_h")).select(
        "_h.word", "doc_id", "sent_id", "_h.tok_id", "title", "sentence", "_h.score", "_h.rank")


def _strings(words: DataFrame) -> pa.Array:
    return words.toArrow()["word"].combine_chunks()


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _cuts(rows: DataFrame, part_bytes: int) -> pa.Table:
    """Sentences that cut the order into parts of about ``part_bytes`` of text each.

    Every task shows some of its sentences, at equal distances of bytes; they decide where parts begin,
    not what is in them.
    """
    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, step, kept = 0, 1 << 10, []
        for batch in batches:
            upto = seen + np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy().astype(np.int64) + 1)
            marks = np.r_[seen, upto] // step
            at = np.flatnonzero(np.diff(marks))
            taken = pa.Table.from_batches([batch]).take(at)
            kept.append((taken.set_column(0, "sentence", pc.utf8_slice_codeunits(taken["sentence"], 0, SHOWN_CHARS)), marks[1:][at]))
            seen = int(upto[-1]) if len(batch) else seen
            while sum(len(t) for t, _ in kept) > SHOWN:
                step *= 2
                halves = [(t, m // 2, np.flatnonzero(np.diff(m // 2, prepend=-1))) for t, m in kept]
                kept = [(t.take(at), m[at]) for t, m, at in halves]
        if seen:
            of_task = pa.concat_tables([t for t, _ in kept])
            if not len(of_task):
                return
            weight = np.full(len(of_task), seen / len(of_task))
            yield from of_task.append_column("weight", pa.array(weight)).combine_chunks().to_batches()

    read = rows.select(*postings.SENTENCE)
    samples = read.mapInArrow(shown, T.StructType([*read.schema, T.StructField("weight", T.DoubleType())])).toArrow()
    total = pc.sum(samples["weight"]).as_py() or 0
    spark = rows.sparkSession
    least = min(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(total) >> 17)
    return postings.bounds(samples, max(1, least, round(total / part_bytes)))


def _of_large_vocabulary(narrow: DataFrame, wide: DataFrame, vocabulary: DataFrame, k: int) -> DataFrame:
    """``top_examples`` without a table of all words in one place.

    Only words seen more than ``k`` times need a threshold, and there are fewer of them than rows by
    ``k``: these are looked up. All occurrences of the others are candidates; they meet the vocabulary
    by a shuffle in which no word has more than ``k`` rows, and are ranked where they are.
    """
    known = vocabulary.select("word").hint("merge")
    counts = cut_lineage(_score_counts(narrow))
    frequent = cut_lineage(counts.groupBy("word").agg(F.sum("n").alias("_n")).where(F.col("_n") > k).select("word"))
    limits = _thresholds(Lookup(frequent).join(counts, "word", "left_semi").join(known, "word", "left_semi"), k)
    frequent = Lookup(frequent.join(limits, "word", "left").select("word", "threshold", F.lit(True).alias("_hot")))
    enough = F.when(F.col("_hot"), F.col("score") >= F.col("threshold")).otherwise(F.col("score").isNotNull())
    candidates = cut_lineage(frequent.join(wide, "word", "left").where(enough).drop("threshold"))
    hot = top_k(candidates.where("_hot").drop("_hot"), ["word"], example_order(), k)
    rest = candidates.where("_hot IS NULL").drop("_hot").join(known, "word", "left_semi")
    best_first = Window.partitionBy("word").orderBy(*example_order())
    return hot.unionByName(rest.withColumn("rank", F.row_number().over(best_first)))
