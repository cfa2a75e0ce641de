"""SimHash near-duplicates, found by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.components import connected
from lexspark.llm.perplexity import pieces
from lexspark.plans.lineage import cut_lineage
from lexspark.plans.sizing import Lookup

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 16
SMALL_BUCKET = 64
_ROWS = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in over half of the hashes of the text's word shingles."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    plain = b" ".join(parts)
    ends = [e - 1 for e in accumulate(len(p) + 1 for p in parts)]
    width = min(words, len(parts))
    starts = [0, *(e + 1 for e in ends[:-1])][: len(parts) - width + 1]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(plain[a:b], SEED) for a, b in zip(starts, ends[width - 1:])], np.uint64)
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), _ROWS):
        bits = np.unpackbits(hashes[a:a + _ROWS].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return run


def _keyed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64()), batch.column(2)], ["doc_id", "fp", "_key"])

    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row; a NULL or blank text has fingerprint zero."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(words), "doc_id bigint, fp bigint")


def _turned(fp: Column, bits: int) -> Column:
    """``fp`` turned right, so that the bits from ``bits`` on come first."""
    if bits == 0:
        return fp
    return F.shiftrightunsigned(fp, bits).bitwiseOR(F.shiftleft(fp, 64 - bits))


def _low(n_bits: int) -> int:
    value = (1 << n_bits) - 1
    return value - (1 << 64) if value >= 1 << 63 else value


def chain_keys(prints: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(key, fp): one row per place of the ring where a chain of equal segments may start.

    The budget of a chain of ``l`` segments is ``l * max_bits / segments``. Chains with a budget
    below one bit must be equal; the longest of them is the key.
    """
    width = 64 // segments
    exact = -(-segments // max_bits) - 1
    keys = [
        F.struct(F.lit(i).alias("at"), _turned(F.col("fp"), i * width).bitwiseAND(_low(exact * width)).alias("key"))
        for i in range(segments)
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.at", "k.key", "fp")


def within_budgets(at: Column, a: Column, b: Column, max_bits: int, segments: int) -> Column:
    """Whether all chains from segment ``at`` on stay within their budgets, then the whole ring."""
    width = 64 // segments
    differ = a.bitwiseXOR(b)
    turned = F.lit(None).cast("bigint")
    for i in reversed(range(segments)):
        turned = F.when(at == i, _turned(differ, i * width)).otherwise(turned)
    ok = F.lit(True)
    for budget in range(1, max_bits):
        longest = -(-(budget + 1) * segments // max_bits) - 1
        ok &= F.bit_count(turned.bitwiseAND(_low(longest * width))) <= budget
    return ok & (F.bit_count(differ) <= max_bits)


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, small: int = SMALL_BUCKET,
) -> DataFrame:
    """(a, b): links that join the same fingerprints as all pairs within ``max_bits`` do.

    ``prints`` has distinct fingerprints ``fp``. Fingerprints that share no chain key are no
    candidates. In buckets of up to ``small`` members pairs are compared. Members of larger buckets
    are too similar for keys to tell apart: each names the 65 values within one bit, and those that name
    the same value are linked to the least of them. Two fingerprints name a common value exactly if two
    bits or fewer differ, and the rows are in proportion to the members. Another ``max_bits`` has no
    such middle, so there all buckets compare pairs.
    """
    keyed = chain_keys(prints, max_bits, segments)
    buckets = cut_lineage(keyed.groupBy("at", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    ).where("n > 1"))
    two = buckets.where("n = 2").select("at", "a", "b")
    members = cut_lineage(keyed.join(
        buckets.where("n > 2").select("at", "key", "n"), ["at", "key"]).select("at", "key", "n", "fp"))
    few = members.where(F.col("n") <= small) if max_bits == 2 else members
    pairs = few.select("at", "key", F.col("fp").alias("a")).join(
        few.select("at", "key", F.col("fp").alias("b")), ["at", "key"]).where("a < b").select("at", "a", "b")
    close = two.unionByName(pairs).where(
        within_budgets(F.col("at"), F.col("a"), F.col("b"), max_bits, segments)).select("a", "b")
    if max_bits != 2:
        return close
    return close.unionByName(_by_middle(members.where(F.col("n") > small).select("fp").distinct()))


def _by_middle(prints: DataFrame) -> DataFrame:
    """Links among fingerprints up to two bits apart by the values in the middle between them."""
    flips = [0, *(1 << i if i < 63 else -(1 << 63) for i in range(64))]
    middle = prints.select("fp", F.explode(F.array(*[
        F.col("fp").bitwiseXOR(F.lit(f).cast("bigint")) for f in flips])).alias("middle"))
    # at most 65 fingerprints lie within one bit of a value
    near = middle.groupBy("middle").agg(F.collect_list("fp").alias("near")).where(F.size("near") > 1)
    return near.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a <> b").distinct()


def components_of(
    rows: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """(fp, label, component_id) for every fingerprint of ``rows`` (doc_id, fp): its component, named
    by a fingerprint, and the smallest doc_id in it."""
    prints = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = cut_lineage(connected(cut_lineage(links(prints.select("fp"), max_bits, segments))))
    linked = cut_lineage(labels.withColumnRenamed("node", "fp").join(prints, "fp"))
    least = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = linked.join(least, "label").select("fp", "label", "component_id")
    alone = F.col("label").isNull()
    return prints.join(named, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"),
        F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Two fingerprints are linked if they differ in ``max_bits`` bits at most; ``component_id`` is the
    smallest doc_id that can be reached over links. Equal fingerprints are one node, whatever the
    number of their rows. Rows without words have fingerprint zero, and are linked like others.
    Repeated rows each give a row. A NULL doc_id never is the smallest one, and a component without
    any doc_id has NULL. Other columns are not read; an empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs, words))
    known = cut_lineage(components_of(rows, max_bits, segments))
    return rows.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
) -> DataFrame:
    """One row of ``docs`` of each component of near-duplicates, with its columns.

    The row with the smallest doc_id stays, NULL last; among rows with one doc_id the smallest hash of the
    text decides, and of equal rows one stays. Texts are shuffled only if more rows go than a broadcast
    holds.
    """
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"),
                   F.coalesce(F.sha2("text", 256), F.lit(""))).alias("_key")
    named = docs.select(F.struct("*").alias("_doc"), key)
    hashed = docs.select("doc_id", "text", key)
    rows = cut_lineage(hashed.mapInArrow(_keyed(words), "doc_id bigint, fp bigint, _key string"))
    groups = cut_lineage(components_of(rows, max_bits, segments))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    grouped = cut_lineage(rows.join(groups, "fp").select("label", order.alias("place"), "_key"))
    stays = grouped.groupBy("label").agg(F.min("place")["_key"].alias("_key"))
    keys = cut_lineage(grouped.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).join(
        stays.withColumn("stays", F.lit(True)), "_key", "left"))
    left = Lookup(keys.where("stays IS NULL").select("_key")).join(named, "_key", "left_anti")
    repeated = Lookup(keys.where("stays AND n > 1").select("_key"))
    if repeated.table.isEmpty():
        return left.select("_doc.*")
    single = repeated.join(left, "_key", "left_anti")
    again = repeated.join(left, "_key", "left_semi").dropDuplicates(["_key"])
    return single.unionByName(again).select("_doc.*")
