"""Byte-level BPE encoding and decoding by a rank file, with the tiktoken library in Arrow batches."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART_CHARS = 1 << 16
LONG_BLANK = 1 << 12
RANK_FILE_BYTES = 64 * 1024 * 1024
_ROWS = 256
# fixed values: the characters of Unicode's White_Space property, which \s stands for in the patterns
BLANK_CODES = (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_BLANKS = "".join(map(chr, BLANK_CODES))
_BORDER = re.compile(f"[^{_BLANKS}](?=[{_BLANKS}])")
_BLANK_RUN = re.compile(f"[{_BLANKS}]{{{LONG_BLANK},}}")
_CODECS: dict[str, Codec] = {}


class Codec:
    """Encoder and decoder of one rank file.

    ``pattern`` must be of the usual kind: no match goes on from another character into white space,
    and a run of white space is matched whole at the end of a text, else up to its last character.
    """

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=table, special_tokens={})
        self.tokens = {rank: token for token, rank in table.items()}

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as unsigned 32-bit integers.

        A long text is cut where no match can reach over. Its long runs of white space, which the
        pattern would match by backtracking over their whole length, are merged as single matches.
        """
        if len(text) <= PART_CHARS:
            return self.split.encode_to_numpy(text, disallowed_special=())
        ids = [(self.whole if single else self.split).encode_to_numpy(part, disallowed_special=())
               for part, single in safe_parts(text)]
        return np.concatenate(ids)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes the ids stand for; they need not be valid UTF-8. An unknown id raises KeyError."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _cut(text: str, start: int, stop: int) -> Iterator[str]:
    while stop - start > PART_CHARS:
        found = _BORDER.search(text, start + PART_CHARS, stop)
        if found is None or found.end() >= stop:
            break
        yield text[start:found.end()]
        start = found.end()
    if stop > start:
        yield text[start:stop]


def safe_parts(text: str) -> Iterator[tuple[str, bool]]:
    """(part, whether it is one match): parts whose matches are those of the whole text, in order."""
    at = 0
    for run in _BLANK_RUN.finditer(text):
        for part in _cut(text, at, run.start()):
            yield part, False
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start():at], True
    for part in _cut(text, at, len(text)):
        yield part, False


def _codec(shared: Broadcast, pattern: str) -> Codec:
    """The codec of a rank file's bytes, built once in each Python worker."""
    name = hashlib.sha256(shared.value + pattern.encode()).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(shared.value, pattern)
    return _CODECS[name]


def rank_file(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a rank file on the driver, handed to every executor; files over 64 MiB are refused."""
    with open(path, "rb") as file:
        content = file.read(RANK_FILE_BYTES + 1)
    if len(content) > RANK_FILE_BYTES:
        raise ValueError(f"{path} is larger than {RANK_FILE_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def _encoded(shared: Broadcast, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                ids = [codec.encode(t or "").astype("<u4", copy=False).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _decoded(shared: Broadcast, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                texts = [None if ids is None else codec.decode(np.frombuffer(ids, "<u4"))
                         for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text).

    ``ids`` are the token ids as little-endian unsigned 32-bit integers, in the order of the text; no
    special tokens are added or looked for. ``path`` names the rank file on the driver. Nothing is
    shuffled, and texts of any length are encoded whole, in parts of about 65,536 characters where they
    can be cut. A NULL text counts as empty and has no ids. Repeated rows each give a row, a NULL doc_id
    is kept. Other columns are not read; an empty table gives an empty result.
    """
    shared = rank_file(docs.sparkSession, path)
    return docs.select("doc_id", "text").mapInArrow(_encoded(shared, pattern), _schema(docs, "ids binary"))


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``rows`` (doc_id, ids): the raw bytes of the ids.

    Cut sequences may end inside a character: ``decoded`` is binary and not checked. NULL ids give NULL.
    Ids that the rank file does not have end the job with KeyError.
    """
    shared = rank_file(rows.sparkSession, path)
    return rows.select("doc_id", "ids").mapInArrow(
        _decoded(shared, pattern), _schema(rows, "ids binary, decoded binary"))


def _schema(rows: DataFrame, more: str) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {more}"


def token_count(ids: Column) -> Column:
    """Number of packed ids as bigint."""
    return F.floor(F.octet_length(ids) / 4).cast("bigint")


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows."""
    return rows.select("doc_id", token_count(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
