"""Sharding by rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage
from lexspark.plans.order import with_position

SHARDS = 16
HASH_DIGITS = 13


def _hash(key: Column, shard: int) -> Column:
    """52 bits of a hash of a record key and a shard."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, HASH_DIGITS), 16, 10).cast("bigint")


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the best score for ``key``: the least of ``-ln(u) / weight``.

    A shard's score does not depend on the others, so a new shard only takes the keys it wins, a
    removed one only gives its own away, and a shard holds keys in proportion to its weight.
    """
    def score(i: int, weight: float) -> Column:
        u = (_hash(key, i) + 1).cast("double") / float(1 << 4 * HASH_DIGITS)
        return F.struct((-F.log(u) / float(weight)).alias("score"), F.lit(i).alias("shard"))

    return F.array_min(F.array(*[score(i, w) for i, w in enumerate(weights)]))["shard"]


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None, new_weight: float = 1.0
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and its place in the shard.

    Columns: doc_id, size (bytes of the text and 1), text_crc32, law, shard, slot, grown_shard (the
    shard if there were one more, of ``new_weight``). The key is the doc_id alone: rows with one
    doc_id share a shard, and rows without doc_id share one, too. Slots count from 0 in each shard
    in the order of a hash of the key, then doc_id, text checksum and size; repeated rows follow each other.
    NULL texts have no bytes and checksum 0. Other columns are not read; an empty table gives an
    empty result.
    """
    weights = list(weights or [1.0] * shards)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut_lineage(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        key.alias("_key"),
    ).select(
        "doc_id", "size", "text_crc32", winner(F.col("_key"), weights).alias("shard"),
        winner(F.col("_key"), [*weights, new_weight]).alias("grown_shard"), _hash(F.col("_key"), -1).alias("_mix"),
        F.monotonically_increasing_id().alias("_row"),
    ))
    # the row number only splits ranges of repeated rows
    order = [F.col(c) for c in ("shard", "_mix", "doc_id", "text_crc32", "size", "_row")]
    placed = with_position(rows, order, "_at")
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    firsts = counts.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("_first"))
    # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_at") - F.col("_first")).alias("slot"), "grown_shard",
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, strlen(coalesce(text, '')) + 1 AS size,
    hex(encode(coalesce(text, ''))) AS h FROM documents),
t AS (
  SELECT list(c8 ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c8
    FROM range(256) AS r(i))),
c AS (
  SELECT doc_id, k, size, xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(1, (length(h) + 1)::BIGINT, 2),
      lambda p: (('0x' || substr(h, p, 2))::UBIGINT))),
    lambda a, b: xor(t.crc[(xor(a, b) & 255)::INT + 1], a >> 8)), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM d, t),
s AS (
  SELECT *, list_transform(range(17), lambda i: {'score':
    -ln((('0x' || substr(md5(k || ':' || i), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496.0::DOUBLE), 'shard': i}) AS scores,
    ('0x' || substr(md5(k || ':-1'), 1, 13))::BIGINT AS mix
  FROM c),
p AS (SELECT *, (list_min(scores[1:16])).shard::INT AS shard, (list_min(scores)).shard::INT AS grown_shard FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY mix, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM p
"""
