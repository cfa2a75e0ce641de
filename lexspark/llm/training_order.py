"""Token sequences materialised in training order: a keyed permutation and fixed-stride shards."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.byte_pairs import Codec
from lexspark.plans.lineage import scratch_path
from lexspark.plans.order import ranges
from lexspark.plans.sizing import Lookup

SEQUENCE_TOKENS = 256
SHARD_ROWS = 4096
ROUNDS = 6
#: Token ids are most of what is written; this takes a quarter less of the disk than the default.
COMPRESSION = "zstd"
#: A record: doc_id, sequence number, tokens, 1 if there is no doc_id; then the token ids.
HEADER = np.dtype([("doc_id", "<i8"), ("seq_no", "<u4"), ("n_tokens", "<u2"), ("no_id", "<u2")])
_MASK = (1 << 64) - 1


class Permutation:
    """A keyed order of the numbers below ``n``.

    A Feistel network permutes numbers of an even number of bits, fewer than four times ``n``; a
    number that leaves the range walks along its cycle until it is back, so no two meet.
    """

    def __init__(self, n: int, key: int):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [np.uint64((key + (i + 1) * 0x9E3779B97F4A7C15) & _MASK) for i in range(ROUNDS)]

    def _mixed(self, values: np.ndarray, key: np.uint64) -> np.ndarray:
        # fixed values: the finaliser of a well-known 64-bit mixing function
        x = values ^ key
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _once(self, values: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = values >> half, values & np.uint64((1 << self.half) - 1)
        for key in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return left << half | right

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        out = np.asarray(values).astype(np.uint64)
        open_ = np.arange(len(out))
        while len(open_):
            out[open_] = self._once(out[open_], back)
            open_ = open_[out[open_] >= self.n]
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(file.read(), pattern)


class Encoder:
    """Token ids of texts as 16-bit numbers, with an end token; larger vocabularies are refused."""

    def __init__(self, path: str, pattern: str):
        self.codec = codec(path, pattern)
        n = self.codec.split.n_vocab
        if n >= 1 << 16:
            raise ValueError(f"{path} has {n} tokens; ids are written as 16-bit numbers")
        self.end = np.array([n], "<u2").tobytes()

    def __call__(self, text: str) -> bytes:
        return self.codec.encode(text).astype("<u2").tobytes() + self.end


SEQUENCES = ("row bigint, doc_id bigint, text_hash bigint, seq_no int, n_seqs int, n_tokens int, ids binary")


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _fixed(data: bytes, width: int) -> pa.Array:
    n = len(data) // width
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _sequences(path: str, pattern: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, pattern)
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                encoded = [encode(t or "") for t in part.column(3).to_pylist()]
                sizes = np.array([len(e) // 2 for e in encoded], np.int64)
                many = -(-sizes // length)
                owner = np.repeat(np.arange(len(encoded)), many)
                seq = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                # the end token also fills the last sequence
                data = b"".join(e + encode.end * int(m * length - s) for e, m, s in zip(encoded, many, sizes))
                from_row = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    *[c.take(from_row) for c in part.columns[:3]], pa.array(seq.astype(np.int32)),
                    pa.array(many[owner].astype(np.int32)),
                    pa.array(np.minimum(sizes[owner] - seq * length, length).astype(np.int32)),
                    _fixed(data, 2 * length),
                ], _names(SEQUENCES))

    return run


def sequences(docs: DataFrame, path: str, pattern: str, length: int) -> DataFrame:
    """SEQUENCES: the tokens of every row and an end token, in sequences of ``length``."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(_sequences(path, pattern, length), SEQUENCES)


def first_numbers(rows: DataFrame) -> tuple[DataFrame, int]:
    """((row, first), number of sequences): where each row's sequences begin in the order of doc_id.

    Ranges of rows are summed in their own tasks and shifted by the sums before them. Rows with one
    doc_id go by the hash of their text; equal ones may change places.
    """
    order = [F.col("doc_id"), F.col("text_hash"), F.col("row")]
    placed = ranges(rows, *order)
    sums = placed.groupBy("_part").agg(F.sum("n_seqs").alias("n"))
    before = sums.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("before"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    inside = Window.partitionBy("_part").orderBy(*order)
    # one row per range
    return Lookup(before).join(placed, "_part").select(
        "row", (F.col("before") + F.sum("n_seqs").over(inside) - F.col("n_seqs")).alias("first")), total


def _slotted(permutation: Permutation, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            slots = pa.array(permutation.slots(numbers))
            yield pa.RecordBatch.from_arrays([slots, *batch.columns[1:]], fields)

    return run


SHARDS = "shard bigint, first_slot bigint, n_rows int, stride int, payload binary, crc32 bigint"


def _matrix(column: pa.BinaryArray) -> np.ndarray:
    """The bytes of values of one width, a row each, without a copy."""
    start, stop = (np.frombuffer(column.buffers()[1], np.int32)[i] for i in (column.offset, column.offset + len(column)))
    return np.frombuffer(column.buffers()[2], np.uint8)[start:stop].reshape(len(column), -1)


def _shards(shard_rows: int):
    def packed(shard: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        payload = b"".join([p.tobytes() for p in parts])
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([shard * shard_rows], pa.int64()),
            pa.array([sum(map(len, parts))], pa.int32()), pa.array([parts[0].shape[1]], pa.int32()),
            pa.array([payload], pa.binary()), pa.array([zlib.crc32(payload)], pa.int64()),
        ], _names(SHARDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = -1, []
        for batch in batches:
            if not len(batch):
                continue
            slots, ids, seqs, tokens, data = batch.columns
            head = np.zeros(len(batch), HEADER)
            head["doc_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            head["seq_no"], head["n_tokens"] = seqs.to_numpy(), tokens.to_numpy()
            head["no_id"] = ids.is_null().to_numpy(zero_copy_only=False)
            records = np.hstack([head.view(np.uint8).reshape(len(batch), -1), _matrix(data)])
            shard = slots.to_numpy() // shard_rows
            borders = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]).tolist()
            for at, stop in zip(borders, [*borders[1:], len(batch)], strict=True):
                if shard[at] != now:
                    if parts:
                        yield packed(now, parts)
                    now, parts = int(shard[at]), []
                parts.append(records[at:stop])
        if parts:
            yield packed(now, parts)

    return run


def write_training_order(
    docs: DataFrame, target: str, path: str, pattern: str, key: int,
    length: int = SEQUENCE_TOKENS, shard_rows: int = SHARD_ROWS,
) -> None:
    """Write the token sequences of ``docs`` (doc_id, text) to ``target`` in training order.

    ``path`` names a byte-level BPE vocabulary of ranks and ``pattern`` its parts; ids are 16-bit numbers,
    so one of 65,536 tokens or more is refused. Texts of any length are encoded whole. Each text is
    followed by the end token, which also fills its last sequence. Sequences are numbered by doc_id,
    and the permutation of ``key`` gives each its slot: one key gives one order, however
    rows are stored. Slot ``s`` is record ``s % shard_rows`` of shard ``s // shard_rows``; records have one
    size. Shards lie in ranges of the slots, sorted, so a range of slots is read without
    the rest. A NULL text is empty: one sequence with the end token. A NULL doc_id is marked as such. Repeated
    rows each have their own sequences. Other columns are not read; an empty table writes no shard.
    """
    spark = docs.sparkSession
    encoded = scratch_path(spark, "sequences")
    sequences(docs, path, pattern, length).write.option("compression", COMPRESSION).parquet(encoded)
    made = spark.read.schema(SEQUENCES).parquet(encoded)
    firsts, total = first_numbers(made.where("seq_no = 0").select("row", "doc_id", "text_hash", "n_seqs"))
    numbered = Lookup(firsts).join(made, "row").select(
        (F.col("first") + F.col("seq_no")).alias("slot"), "doc_id", "seq_no", "n_tokens", "ids")
    placed = numbered.mapInArrow(_slotted(Permutation(total, key), numbered.columns), numbered.schema)
    shards = max(1, -(-total // shard_rows))
    parts = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 512))
    at = F.floor(F.floor(F.col("slot") / shard_rows) * parts / shards).cast("int")
    placed.repartitionById(parts, at).sortWithinPartitions("slot").mapInArrow(
        _shards(shard_rows), SHARDS).write.option("compression", COMPRESSION).parquet(target)


RECORDS = ("slot bigint, shard bigint, offset bigint, doc_id bigint, seq_no int, n_tokens int, "
           "tokens array<int>, crc32 bigint")


def _records(start: int, stop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stride, n, first = row["stride"], row["n_rows"], row["first_slot"]
                raw = np.frombuffer(row["payload"], np.uint8).reshape(n, stride)
                a, b = max(0, start - first), min(n, stop - first)
                for low in range(a, b, 512):
                    part = np.ascontiguousarray(raw[low:min(b, low + 512)])
                    head = np.ascontiguousarray(part[:, :HEADER.itemsize]).view(HEADER).ravel()
                    body = np.ascontiguousarray(part[:, HEADER.itemsize:])
                    ids, sizes = body.view("<u2"), head["n_tokens"].astype(np.int32)
                    places = np.arange(low, low + len(part))
                    used = np.arange(ids.shape[1]) < sizes[:, None]
                    tokens = pa.ListArray.from_arrays(
                        np.r_[0, np.cumsum(sizes)].astype(np.int32), pa.array(ids[used].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(places + first), pa.array([row["shard"]] * len(part), pa.int64()),
                        pa.array(places * stride), pa.array(head["doc_id"], mask=head["no_id"] == 1),
                        pa.array(head["seq_no"].astype(np.int32)), pa.array(sizes), tokens,
                        pa.array([zlib.crc32(t[:2 * k]) for t, k in zip(body, sizes.tolist(), strict=True)], pa.int64()),
                    ], _names(RECORDS))

    return run


def read_training_order(spark, target: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """RECORDS of the slots from ``start`` to ``stop``, of whose shards alone the payload is read."""
    stop = 1 << 62 if stop is None else stop
    shards = spark.read.schema(SHARDS).parquet(target)
    most = shards.agg(F.max("n_rows")).first()[0] or 0
    # the first two conditions reach the scan, which passes over files and row groups by their least and largest slots
    shards = shards.where((F.col("first_slot") < stop) & (F.col("first_slot") > start - most)
                          & (F.col("first_slot") + F.col("n_rows") > start))
    return shards.mapInArrow(_records(start, stop), RECORDS)
