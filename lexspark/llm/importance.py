"""Resampling towards a target distribution by bit-sliced aggregation of hashed n-grams.

A document's bucket counts are stored as planes of 10,000 bits: bit b of plane p is bit p of the count
of bucket b. Gains per bucket are planes too, one set for either sign. A document's weight is the sum
over all pairs of planes of 2**(p + q) times the number of bits they share.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage
from lexspark.plans.order import with_position

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42
SCALE = 1000
WORDS_64 = -(-BUCKETS // 64)
_BYTES = 8 * WORDS_64
_CHUNK = 1 << 17
_LONG_TEXT = 1 << 21
_PART_WORDS = 1 << 16
_PLANE_ROWS = 64
_MEMO = 1 << 20
# the class of word characters, after A-Z are lower-cased, on the bytes of UTF-8
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

PLANES = "doc_id bigint, n_words bigint, n_features bigint, planes binary"


class Shifts:
    """What n more zero bytes do to a CRC-32, for many checksums at once.

    The checksum of two strings one after the other is the first one's shifted by the length of the
    second, XOR the second one's. Shifting is linear over bits, so each power of two has a table of 256
    entries per byte of the checksum.
    """

    def __init__(self):
        def after_zero_byte(c: int) -> int:
            return zlib.crc32(b"\0", c ^ 0xFFFFFFFF) ^ 0xFFFFFFFF

        bits = [after_zero_byte(1 << i) for i in range(32)]
        self.tables = [self._table(bits)]

    @staticmethod
    def _table(bits: list[int]) -> np.ndarray:
        table = np.zeros((4, 256), np.uint32)
        for i, image in enumerate(bits):
            table[i // 8, np.arange(256) >> (i % 8) & 1 == 1] ^= np.uint32(image)
        return table

    def _power(self, j: int) -> np.ndarray:
        while len(self.tables) <= j:
            last = self.tables[-1]
            images = self._apply(last, self._apply(last, np.uint32(1) << np.arange(32, dtype=np.uint32)))
            self.tables.append(self._table(images.tolist()))
        return self.tables[j]

    @staticmethod
    def _apply(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return (table[0, sums & 255] ^ table[1, sums >> 8 & 255] ^ table[2, sums >> 16 & 255] ^ table[3, sums >> 24])

    def shift(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = sums.copy()
        for j in range(int(lengths.max(initial=0)).bit_length()):
            at = np.flatnonzero(lengths >> j & 1)
            out[at] = self._apply(self._power(j), out[at])
        return out


class _Memo(dict):
    """Checksum and length of a word, packed into 64 bits."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = zlib.crc32(word) | len(word) << 32
        return value


def features(words: list[list[bytes]], shifts: Shifts, memo: _Memo) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every run of one to three words of each document."""
    sizes = np.array([len(w) for w in words], np.int64)
    packed = np.fromiter(map(memo.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    lengths = (packed >> np.uint64(32)).astype(np.int64)
    single = packed.astype(np.uint32)
    space = np.full(1, zlib.crc32(b" "), np.uint32)
    sums, owners, run = [single], [owner], single
    different = np.unique(lengths)
    spaced = single ^ shifts.shift(np.repeat(space, len(different)), different)[np.searchsorted(different, lengths)]
    for n in range(2, LONGEST_RUN + 1):
        run = shifts.shift(run[:-1], lengths[n - 1:] + 1) ^ spaced[n - 1:] if len(run) > 1 else run[:0]
        inside = owner[: len(run)] == owner[n - 1: n - 1 + len(run)]
        sums.append(run[inside])
        owners.append(owner[: len(run)][inside])
    return np.concatenate(owners), (np.concatenate(sums) % BUCKETS).astype(np.int64)


def long_counts(text: bytes, shifts: Shifts, memo: _Memo) -> tuple[int, np.ndarray]:
    """(words, bucket counts) of a long text, some words at a time.

    Each part begins with the last words of the one before; runs within these are counted once.
    """
    def counted(words: list[bytes]) -> np.ndarray:
        return np.bincount(features([words], shifts, memo)[1], minlength=BUCKETS)

    found = (m.group() for m in _WORD.finditer(text))
    total, n_words, carried = np.zeros(BUCKETS, np.int64), 0, []
    while part := list(islice(found, _PART_WORDS)):
        n_words += len(part)
        total += counted(carried + part) - counted(carried)
        carried = (carried + part)[1 - LONGEST_RUN:]
    return n_words, total


def planes_of(counts: np.ndarray) -> list[bytes]:
    """Bit planes of each row of bucket counts, lowest bits first; none for a row of zeros."""
    out = []
    most = counts.max(axis=1, initial=0)
    for row, top in zip(counts, most.tolist(), strict=True):
        depth = int(top).bit_length()
        bits = np.zeros((depth, 64 * WORDS_64), np.uint8)
        bits[:, :BUCKETS] = row >> np.arange(depth)[:, None] & 1
        out.append(np.packbits(bits, axis=1, bitorder="little").tobytes())
    return out


def _unpacked(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, "<u8").reshape(-1, WORDS_64)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Planes of every text. Texts are taken together up to a limit of bytes, long ones alone."""
    shifts, memo = Shifts(), _Memo()

    def rows(ids: list, n_words: list[int], counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(counts.sum(axis=1)),
            pa.array(planes_of(counts), pa.binary()),
        ], ["doc_id", "n_words", "n_features", "planes"])

    def together(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        owner, bucket = features(words, shifts, memo)
        counts = np.bincount(owner * BUCKETS + bucket, minlength=len(ids) * BUCKETS)
        return rows(ids, [len(w) for w in words], counts.reshape(len(ids), BUCKETS))

    ids, words, held = [], [], 0
    for batch in batches:
        for at in range(0, len(batch), _PLANE_ROWS):
            part = batch.slice(at, _PLANE_ROWS)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                text = (text or b"").translate(_LOWER)
                if len(text) > _LONG_TEXT:
                    n_words, counts = long_counts(text, shifts, memo)
                    yield rows([doc_id], [n_words], counts[None])
                    continue
                ids.append(doc_id)
                words.append(_WORD.findall(text))
                held += len(text)
                if held >= _CHUNK or len(ids) == _PLANE_ROWS:
                    yield together(ids, words)
                    ids, words, held = [], [], 0
    if ids:
        yield together(ids, words)


def bit_planes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, planes) for every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(_sliced, PLANES)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket totals of a task: plane p counts 2**p for each of its bits."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for planes in batch.column(0).to_pylist():
            for p, plane in enumerate(_unpacked(planes)):
                total += np.unpackbits(plane.view(np.uint8), count=BUCKETS, bitorder="little").astype(np.int64) << p
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])


def bucket_totals(planes: DataFrame) -> np.ndarray:
    """Features of all rows per bucket; what reaches the driver is one number per bucket."""
    sums = planes.where("n_features > 0").select("planes").mapInArrow(_totals, "bucket int, n bigint").groupBy(
        "bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: the scaled logarithm of its smoothed share in target over corpus, floored."""
    all_corpus, all_target = float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(SCALE * math.log((t + 1.0) * (all_corpus + BUCKETS) / ((s + 1.0) * (all_target + BUCKETS))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planes, value of a shared bit of each): all bits of positive gains, then of negative ones."""
    rows, values = [], []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for q, plane in enumerate(planes_of(size[None])[0][i:i + _BYTES] for i in range(
                0, int(size.max(initial=0)).bit_length() * _BYTES, _BYTES)):
            rows.append(_unpacked(plane)[0])
            values.append(sign << q)
    return np.array(rows, "<u8").reshape(-1, WORDS_64), np.array(values, np.int64)


def _weighed(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, values = gain_planes(gain)
        for batch in batches:
            weights = np.zeros(len(batch), np.int64)
            for at in range(0, len(batch), _PLANE_ROWS):
                own = [_unpacked(p) for p in batch.column(3).slice(at, _PLANE_ROWS).to_pylist()]
                depth = np.array([len(p) for p in own])
                stacked = np.concatenate(own)
                shared = np.zeros(len(stacked), np.int64)
                for plane, value in zip(rows, values.tolist(), strict=True):
                    shared += value * np.bitwise_count(stacked & plane).sum(axis=1, dtype=np.int64)
                power = np.concatenate([np.arange(n) for n in depth]) if len(stacked) else np.zeros(0, np.int64)
                np.add.at(weights, at + np.repeat(np.arange(len(own)), depth), shared << power)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(weights)], ["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document's id, scaled and floored; a NULL id counts as the empty string."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    return F.floor(-float(SCALE) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row of ``docs``: the sum of its features' gains."""
    corpus = cut_lineage(bit_planes(docs))
    wanted = bit_planes(target.select(F.lit(None).alias("doc_id"), "text"))
    gain = gains(bucket_totals(corpus), bucket_totals(wanted))
    return corpus.mapInArrow(_weighed(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text).

    ``percent`` of the rows with ``min_words`` words or more are drawn without replacement, with odds that
    follow the likeness of their word runs to those of ``target`` (text): the highest scores of weight
    and noise, ranked 1, 2, ...; other rows have rank NULL. Ties go to the smaller doc_id, NULL last.
    NULL texts and texts without words have no features and weight 0. Texts of any length are read
    whole. Repeated rows have equal scores and take ranks of their own, any of them first. Other columns
    are not read; an empty table gives an empty result, an empty target gains from rare buckets only.
    """
    scored = cut_lineage(weighted(docs, target).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed)))
    drawn = scored.where(F.col("n_words") >= min_words).count() * percent // 100
    able = with_position(
        scored.where(F.col("n_words") >= min_words),
        [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank", start=1)
    ranked = able.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
