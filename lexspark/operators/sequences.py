"""Model inputs from example sentences: ids, sub-words, token ids, packing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import sequences as S
from lexspark.functions import text
from lexspark.functions.pieces import build_trie, match
from lexspark.operators.packed import looked_up
from lexspark.plans.order import with_position
from lexspark.plans.sizing import BROADCAST_BYTES, Lookup

MAX_WORD_CHARS = 200


def input_examples(sentences: DataFrame) -> DataFrame:
    """(word, n, sentence) -> running id ``word-n`` and the one or two text parts."""
    a, b = text.pair_parts(F.col("sentence"))
    return sentences.select(
        "word", "n", F.concat_ws("-", "word", "n").alias("unique_id"),
        a.alias("text_a"), b.alias("text_b"), "sentence",
    )


def token_vocabulary(tokens: DataFrame, specials: Sequence[str] = (S.PAD, S.UNKNOWN, S.CLS, S.SEP)) -> DataFrame:
    """(token, id): the specials first, then all distinct tokens in text order."""
    spark = tokens.sparkSession
    fixed = spark.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, id bigint")
    rest = tokens.select("token").distinct().where(~F.col("token").isin(*specials))
    return fixed.unionByName(with_position(rest, [F.asc("token")], "id", start=len(specials)))


def subwords(
    words: DataFrame, vocabulary: DataFrame, max_chars: int = MAX_WORD_CHARS, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(word) -> (word, pieces): greedy longest match from the left, for distinct words.

    A word with a place where no piece starts, or with more than ``max_chars`` characters, becomes the
    unknown piece. A vocabulary within ``limit`` bytes is broadcast as a trie that matches batches of
    words; a larger one is joined to the words' substrings.
    """
    pieces = vocabulary.select(
        F.when(F.col("token").startswith(S.PIECE_PREFIX), F.substring("token", 3, 1 << 30))
        .otherwise(F.col("token")).alias("text"),
        (~F.col("token").startswith(S.PIECE_PREFIX)).alias("initial"),
    )
    lookup = Lookup(pieces, limit)
    if lookup.fits:
        return _matched(words.select("word").distinct(), lookup, max_chars)
    # only substrings up to the longest vocabulary entry can match
    longest = lookup.table.agg(F.max(F.length("text"))).first()[0] or 1
    n = F.length("word")
    types = words.select("word").distinct()
    starts = types.where(n <= max_chars).select(
        "word", F.explode(F.sequence(F.lit(1), n)).alias("start")
    )
    spans = starts.select(
        "word", "start", (F.col("start") == 1).alias("initial"),
        F.explode(F.sequence(
            F.col("start"), F.least(n, F.col("start") + F.lit(longest - 1))
        )).alias("end"),
    ).withColumn("text", F.substring("word", F.col("start"), F.col("end") - F.col("start") + 1))
    longest_end = (
        lookup.join(spans, ["text", "initial"], "left_semi")
        .groupBy("word", "start").agg(F.max("end").alias("end"))
    )
    # at most max_chars entries per word
    ends = longest_end.groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("start", "end"))).alias("ends")
    )
    start = F.struct(
        F.lit(1).alias("at"), F.array().cast("array<string>").alias("pieces")
    )

    def step(state: Column, _: Column) -> Column:
        end = F.col("ends")[state["at"]]
        piece = F.concat(
            F.when(state["at"] > 1, S.PIECE_PREFIX).otherwise(""),
            F.substring(F.col("word"), state["at"], end - state["at"] + 1),
        )
        moved = F.struct(
            (end + 1).alias("at"), F.array_append(state["pieces"], piece).alias("pieces")
        )
        return F.when(end.isNotNull(), moved).otherwise(state)

    walk = F.aggregate(F.sequence(F.lit(1), n), start, step)
    return (
        types.join(ends, "word", "left")
        .withColumn("_w", F.when(F.col("ends").isNotNull(), walk))
        .select(
            "word",
            F.when(F.col("_w.at") > n, F.col("_w.pieces"))
            .otherwise(F.array(F.lit(S.UNKNOWN))).alias("pieces"),
        )
    )


def _matched(types: DataFrame, pieces: Lookup, max_chars: int) -> DataFrame:
    known = pieces.table.toPandas()
    initial = known["initial"].to_numpy(bool)
    trie = types.sparkSession.sparkContext.broadcast(
        build_trie(known["text"][initial].tolist(), known["text"][~initial].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            spans = match([w if w is not None and len(w) <= max_chars else "" for w in words], trie.value)
            found = [[S.UNKNOWN] if cuts is None else [(S.PIECE_PREFIX if a else "") + w[a:b] for a, b in cuts]
                     for w, cuts in zip(words, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.string()))], ["word", "pieces"])

    return types.mapInArrow(run, "word string, pieces array<string>")


def tokenize(rows: DataFrame, key: str, columns: Sequence[str], vocabulary: DataFrame) -> DataFrame:
    """Replace text columns by arrays of sub-word pieces, lower-cased; NULL text stays NULL.

    The rows are placed by key once, so taking texts apart and putting them together again moves
    no token through a shuffle while the table of distinct words is small enough to broadcast.
    """
    placed = rows.repartition(F.col(key))
    parts = F.array(*[
        F.struct(
            F.lit(i).alias("part"),
            text.lower_all(text.split_tokens(F.col(c))).alias("tokens"),
        )
        for i, c in enumerate(columns)
    ])
    words = placed.select(key, F.explode(parts).alias("_p")).select(
        key, "_p.part", F.posexplode("_p.tokens").alias("pos", "word")
    )
    split = Lookup(subwords(words, vocabulary)).join(words, "word")
    grouped = split.groupBy(key).agg(*[
        F.flatten(F.transform(
            F.sort_array(F.collect_list(F.when(F.col("part") == i, F.struct("pos", "pieces")))),
            lambda s: s["pieces"],
        )).alias(f"_{c}")
        for i, c in enumerate(columns)
    ])
    return placed.join(grouped, key, "left").select(
        *[
            F.when(F.col(c).isNotNull(), F.coalesce(f"_{c}", F.array().cast("array<string>"))).alias(c)
            if c in columns else F.col(c)
            for c in rows.columns
        ]
    )


def token_ids(
    rows: DataFrame, key: str, vocabulary: DataFrame, tokens: str = "tokens", limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, input_ids): ids of an array of tokens in order; an unlisted token has the unknown id.

    With a vocabulary above ``limit`` bytes only the different tokens of a part of the rows meet it, and
    rows of a key meet with their ids.
    """
    lookup = Lookup(vocabulary.select(F.col("token").alias("_t"), F.col("id").cast("int").alias("id")), limit)
    unknown = lookup.table.where(F.col("_t") == S.UNKNOWN).first()
    if not lookup.fits and lookup.table.groupBy("_t").count().where("count > 1 AND _t IS NOT NULL").isEmpty():
        return _looked_up_ids(rows.select(key, tokens), key, lookup, tokens, unknown["id"] if unknown else None)
    placed = rows.select(key, tokens).repartition(F.col(key))
    exploded = placed.select(key, F.posexplode(tokens).alias("pos", "_t"))
    found = lookup.join(exploded, "_t", "left").withColumn(
        "id", F.coalesce("id", F.lit(unknown["id"] if unknown else None).cast("int"))
    )
    return found.groupBy(key).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("pos", "id"))), lambda s: s["id"]
        ).alias("input_ids")
    )


def _looked_up_ids(rows: DataFrame, key: str, lookup: Lookup, tokens: str, unknown: int | None) -> DataFrame:
    found = looked_up(rows, tokens, lookup.table, "_ids").where(F.size(tokens) > 0)
    ids = F.transform("_ids", lambda v: F.coalesce(v.cast("int"), F.lit(unknown).cast("int")))
    lists = found.select(key, ids.alias("_ids")).groupBy(key).agg(F.collect_list("_ids").alias("_l"))
    together = F.sort_array(F.flatten(F.transform(
        "_l", lambda ids: F.transform(ids, lambda v, i: F.struct(i.alias("pos"), v.alias("id"))))))
    return lists.select(key, F.when(F.size("_l") == 1, F.get("_l", F.lit(0))).otherwise(
        F.transform(together, lambda s: s["id"])).alias("input_ids"))


def truncated(rows: DataFrame, max_len: int = S.MAX_SEQ_LENGTH) -> DataFrame:
    """Shorten ``tokens_a`` and ``tokens_b`` to what fits beside the markers."""
    has_b = F.coalesce(F.size("tokens_b"), F.lit(0)) > 0
    a, b = S.truncate_pair(F.col("tokens_a"), F.col("tokens_b"), max_len)
    return rows.withColumns({
        "tokens_a": F.when(has_b, a).otherwise(S.truncate_single(F.col("tokens_a"), max_len)),
        "tokens_b": F.when(has_b, b),
    })


def pack(
    rows: DataFrame, vocabulary: DataFrame, max_len: int = S.MAX_SEQ_LENGTH, key: str = "unique_id"
) -> DataFrame:
    """(unique_id, tokens_a, tokens_b) -> tokens, input_ids, input_mask, input_type_ids.

    The three number arrays all have ``max_len`` entries, which is asserted.
    """
    tokens, segments = S.assemble(F.col("tokens_a"), F.col("tokens_b"))
    packed = truncated(rows, max_len).select(
        key, tokens.alias("tokens"), segments.alias("segments")
    )
    full = packed.join(token_ids(packed, key, vocabulary), key).select(
        key, "tokens",
        S.pad(F.col("input_ids"), max_len).alias("input_ids"),
        S.mask(F.col("tokens"), max_len).alias("input_mask"),
        S.pad(F.col("segments"), max_len).alias("input_type_ids"),
    )
    arrays = ("input_ids", "input_mask", "input_type_ids")
    whole = F.lit(True)
    for name in arrays:
        whole = whole & (F.size(name) == max_len)
    return full.where(F.coalesce(F.assert_true(whole, F.lit("arrays of unequal length")).isNull(), whole))
