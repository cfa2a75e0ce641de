"""Sentences and occurrences of words packed into a few compressed records.

A record of sentences holds a part of the corpus in the order of the ranking's ties; tokens are numbered
in that order, so an occurrence is its score and one number. Strings are compared by their bytes, as
Spark does.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lexspark.functions.forests import Forest

SENTENCE = ("sentence", "title", "doc_id", "sent_id")
DESCENDING = ("sentence", "title")
MERGED = 1 << 22


def _bytes(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
        to.write_table(table)
    return out.getvalue().to_pybytes()


def release() -> None:
    """Hand back memory that is free but kept: a worker goes on with the next part, or waits, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _planes(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Whole numbers from 0 as columns of single bytes, which are packed apart."""
    values, top = values.astype(np.int64), int(values.max()) if len(values) else 0
    return {f"{name}{i}": (values >> (8 * i)).astype(np.uint8) for i in range(max(1, (top.bit_length() + 7) // 8))}


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    values, i = np.zeros(len(table), np.int32), 0
    while f"{name}{i}" in table.column_names:
        values = values.astype(np.int64) if i == 3 else values
        values |= pc.fill_null(table[f"{name}{i}"], 0).to_numpy().astype(values.dtype) << (8 * i)
        i += 1
    return values


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)


def _within(starts: np.ndarray, n: int) -> np.ndarray:
    """Place of each of ``n`` values in its run."""
    return np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))


def in_order(rows: pa.Table, last: str) -> np.ndarray:
    """Indexes of sentences in the order of the ranking's ties, equal ones by the column ``last``."""
    columns, keys = {}, []
    for name in SENTENCE:
        way = "descending" if name in DESCENDING else "ascending"
        if rows[name].null_count:  # first among ascending, last among descending ones
            columns[f"{name}?"] = pc.cast(pc.is_valid(rows[name]), pa.int8())
            keys.append((f"{name}?", way))
        columns[name] = rows[name]
        keys.append((name, way))
    columns[last] = rows[last]
    return pc.sort_indices(pa.table(columns), sort_keys=[*keys, (last, "ascending")]).to_numpy()


def _repeats(rows: pa.Table) -> np.ndarray:
    """Which of the ordered sentences are equal to the one before in all that decides ties."""
    same = np.ones(max(0, len(rows) - 1), bool)
    for name in SENTENCE:
        a, b = rows[name].slice(0, len(same)), rows[name].slice(1)
        both = pc.and_(pc.is_null(a), pc.is_null(b))
        same &= pc.or_(pc.fill_null(pc.equal(a, b), False), both).to_numpy()
    return np.r_[False, same][:len(rows)]


def bounds(samples: pa.Table, n: int) -> pa.Table:
    """At most ``n - 1`` sentences that cut the sampled ones into parts of about equal weight."""
    samples = samples.append_column("_at", pa.array(np.arange(len(samples))))
    ordered = samples.take(in_order(samples, "_at"))
    upto = np.cumsum(ordered["weight"].to_numpy())
    at = np.searchsorted(upto, np.arange(1, n) * (upto[-1] / n)) if len(upto) else []
    return ordered.take(np.unique(at).astype(np.int64)).select(SENTENCE)


class Chunk:
    """Sentences in order with their tokens: a word's number, and the share of the sentence in tokens."""

    def __init__(self, rows: pa.Table, sizes: np.ndarray, words: pa.Array, codes: np.ndarray, related: np.ndarray):
        self.rows, self.sizes, self.words, self.codes = rows, sizes, words, codes
        self.first = np.cumsum(sizes) - sizes
        self.scores = related / np.repeat(sizes, sizes)

    def numbered(self) -> np.ndarray:
        """Tokens in the order of the ranking's ties: those of equal sentences by their place first."""
        tokens, repeats = np.arange(len(self.codes)), _repeats(self.rows)
        if not repeats.any():
            return tokens
        place = tokens - np.repeat(self.first, self.sizes)
        return np.lexsort((tokens, place, np.repeat(np.cumsum(~repeats), self.sizes)))


def _bare(sentences: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.replace_substring_regex(sentences, r"\s+", ""))


def _measured(batch: pa.RecordBatch, seq: int) -> pa.Table:
    """Sentences with the number of tokens, their lengths and shares, and their text if it is not the
    sentence's in lower case. The batch ends with the columns ``words`` and ``heads``."""
    words, heads = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    forest = Forest(heads)
    flat = pc.list_flatten(pc.if_else(pc.is_valid(heads), words, None))
    ends = pa.array(np.r_[0, np.cumsum(forest.sizes)].astype(np.int32))
    text = pc.binary_join(pa.ListArray.from_arrays(ends, pc.fill_null(flat, "")), "")
    same = pc.fill_null(pc.equal(text, _bare(batch["sentence"])), False)
    length = pc.fill_null(pc.add(pc.binary_length(flat), 1), 0)  # 0: no word
    place = forest.own - forest.first
    beyond = forest.ancestors() + forest.children() + 1 - place
    return pa.table({
        **{c: batch[c] for c in SENTENCE}, "seq": pa.array(seq + np.arange(len(batch))), "size": pa.array(forest.sizes),
        "text": pc.if_else(same, None, text), "lengths": pa.ListArray.from_arrays(ends, length),
        "beyond": pa.ListArray.from_arrays(ends, pa.array(beyond.astype(np.int32)))})


def _record(rows: pa.Table) -> tuple[bytes, bytes]:
    beyond = pc.list_flatten(rows["beyond"]).to_numpy().astype(np.int64)
    tokens = {**_planes("length", pc.list_flatten(rows["lengths"]).to_numpy()), **_planes("beyond", beyond * 2 ^ beyond >> 63)}
    kept = rows.select([*SENTENCE, "text"])
    for name in ("seq", "size"):
        for plane, values in _planes(name, rows[name].to_numpy()).items():
            kept = kept.append_column(plane, pa.array(values))
    return _bytes(kept), _bytes(pa.table(tokens))


def records(batches: Iterator[pa.RecordBatch], cuts: pa.Table, task: int, flush: int) -> Iterator[pa.RecordBatch]:
    """(part, sentences, tokens): one record per part of the order and ``flush`` bytes of sentences."""
    chunks, held, seen = [], 0, task << 33

    def flushed() -> pa.RecordBatch:
        rows = pa.concat_tables(chunks)
        given = rows.select([*SENTENCE, "seq"])
        marks = cuts.append_column("seq", pa.array(np.full(len(cuts), -1))).cast(given.schema)
        order = in_order(pa.concat_tables([given, marks]), "seq")
        is_mark = order >= len(rows)
        part, rows = np.cumsum(is_mark)[~is_mark], rows.take(order[~is_mark])
        ends = np.r_[_starts(part), len(part)]
        made = [_record(rows.slice(a, b - a)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays([
            pa.array(part[ends[:-1]].astype(np.int32)), pa.array([m[0] for m in made], pa.binary()),
            pa.array([m[1] for m in made], pa.binary())], ["part", "sentences", "tokens"])

    for batch in batches:
        if not len(batch):
            continue
        chunks.append(_measured(batch, seen))
        seen += len(batch)
        held += chunks[-1].nbytes
        if held >= flush:
            yield flushed()
            chunks, held = [], 0
            release()
    if chunks:
        yield flushed()
    chunks.clear()
    release()


def _words(text: pa.Array, length: np.ndarray) -> pa.DictionaryArray:
    """Words one after the other in a text; ``length`` counts from 1, with 0 for NULL."""
    ends = np.cumsum(np.maximum(length - 1, 0))
    words = pa.StringArray.from_buffers(
        len(length), pa.py_buffer(np.r_[0, ends].astype(np.int32)), text.buffers()[2] or pa.py_buffer(b""))
    if (length == 0).any():
        words = pc.if_else(pa.array(length > 0), words, None)
    return words.dictionary_encode(null_encoding="encode")


def restored(table: pa.Table) -> Chunk:
    """All sentences of a part, in order."""
    release()
    rows = pa.concat_tables(map(_table, table["sentences"].to_pylist()), promote_options="default")
    tokens = [_table(data) for data in table["tokens"].to_pylist()]
    length = np.concatenate([_numbers(t, "length") for t in tokens])
    beyond = np.concatenate([_numbers(t, "beyond") for t in tokens])
    seq, sizes = (_numbers(rows, name) for name in ("seq", "size"))
    first = np.cumsum(sizes) - sizes
    text = pc.coalesce(rows["text"], _bare(rows["sentence"])).combine_chunks()
    words = _words(text, length)
    rows = rows.select(SENTENCE).append_column("seq", pa.array(seq))
    order = in_order(rows, "seq")
    before, sizes = first[order], sizes[order]
    at = np.repeat(before - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    related = (beyond >> 1 ^ -(beyond & 1))[at] + place
    return Chunk(rows.take(order), sizes, words.dictionary, words.indices.to_numpy()[at], related)


def bucket_of(words: pa.Array, n: int) -> np.ndarray:
    return np.array([crc32(w.encode()) % n for w in words.to_pylist()], np.int32)


def postings(chunk: Chunk, known: pa.Array | None, k: int, n: int) -> tuple[np.ndarray, list[bytes]]:
    """Best ``k`` occurrences per word of a part, best first: (bucket, record) for buckets of words."""
    listed = pc.is_valid(chunk.words) if known is None else pc.is_in(chunk.words, known)
    numbered = chunk.numbered()
    at = np.flatnonzero(listed.to_numpy(zero_copy_only=False)[chunk.codes[numbered]])
    codes, scores = chunk.codes[numbered[at]], chunk.scores[numbered[at]]
    used, codes = np.unique(codes, return_inverse=True)
    words = chunk.words.take(pa.array(used))
    bucket = bucket_of(words, n)
    place = np.empty(len(used), np.int32)
    place[by_bucket := np.argsort(bucket, kind="stable")] = np.arange(len(used))
    codes = place[codes]
    order = np.lexsort((-scores, codes))
    order = order[_within(_starts(codes[order]), len(order)) < k]
    at, scores, counts = at[order], scores[order], np.bincount(codes[order], minlength=len(used))
    words, bucket = words.take(pa.array(by_bucket)), bucket[by_bucket]
    first, ends, made = np.r_[0, np.cumsum(counts)], np.r_[_starts(bucket), len(bucket)], []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        own = slice(first[a], first[b])
        values, score = np.unique(scores[own], return_inverse=True)
        parts = [_bytes(t) for t in (
            pa.table({"word": words.slice(a, b - a), **_planes("n", counts[a:b])}), pa.table({"value": values}),
            pa.table({**_planes("score", score), **_planes("at", at[own])}))]
        made.append(len(parts[0]).to_bytes(8) + len(parts[1]).to_bytes(8) + b"".join(parts))
    return bucket[ends[:-1]], made


def ranked(table: pa.Table, known: pa.Array | None, k: int) -> tuple[np.ndarray, list[bytes]]:
    """Of the records of a bucket, best ``k`` occurrences per word: (part, record of tokens and ranks)."""
    read = []
    for part, data in zip(table["part"].to_pylist(), table["data"].to_pylist(), strict=True):
        a, b = int.from_bytes(data[:8]), int.from_bytes(data[8:16])
        read.append((part, _table(data[16:16 + a]), data[16 + a:16 + a + b], data[16 + a + b:]))
    if not read:
        return np.zeros(0, np.int32), []
    numbers = pa.chunked_array(
        [c for _, w, _, _ in read for c in w["word"].chunks], pa.string()).combine_chunks().dictionary_encode()
    listed = None if known is None else pc.is_in(numbers.dictionary, known).to_numpy(zero_copy_only=False)
    codes, done = numbers.indices.to_numpy(), 0
    held: list[tuple[np.ndarray, ...]] = []

    def best() -> tuple[np.ndarray, ...]:
        code, score, part, at = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((at, part, -score, code))
        order = order[_within(_starts(code[order]), len(order)) < k]
        return code[order], score[order], part[order], at[order]

    for part, w, values, data in read:
        kept = _table(data)
        code = np.repeat(codes[done:done + len(w)], _numbers(w, "n"))
        done += len(w)
        columns = (code, _table(values)["value"].to_numpy()[_numbers(kept, "score")],
                   np.full(len(code), part, np.int32), _numbers(kept, "at").astype(np.int32))
        held.append(columns if listed is None else tuple(c[listed[code]] for c in columns))
        if len(held) > 1 and sum(len(h[0]) for h in held[1:]) > MERGED:
            held = [best()]
    code, _, part, at = best()
    rank = _within(_starts(code), len(code)) + 1
    order = np.lexsort((at, part))
    part, at, rank = part[order], at[order], rank[order]
    ends = np.r_[_starts(part), len(part)]
    return part[ends[:-1]], [
        _bytes(pa.table({**_planes("step", np.diff(at[a:b], prepend=0)), **_planes("rank", rank[a:b])}))
        for a, b in zip(ends[:-1], ends[1:], strict=True)]


def hits(chunk: Chunk, data: Sequence[bytes]) -> pa.Table:
    """Sentences of a part with their ranked tokens (tok_id, word, score, rank)."""
    read = [_table(d) for d in data]
    at = chunk.numbered()[np.concatenate([np.cumsum(_numbers(t, "step")) for t in read])]
    rank = np.concatenate([_numbers(t, "rank") for t in read]).astype(np.int32)
    order = np.argsort(at)
    at, rank = at[order], rank[order]
    sentence = np.searchsorted(np.cumsum(chunk.sizes), at, "right")
    starts = _starts(sentence)
    found = pa.StructArray.from_arrays([
        pa.array((at - chunk.first[sentence]).astype(np.int32)), chunk.words.take(pa.array(chunk.codes[at])),
        pa.array(chunk.scores[at]), pa.array(rank)], ["tok_id", "word", "score", "rank"])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(at)].astype(np.int32)), found)
    return chunk.rows.take(sentence[starts]).select(SENTENCE).append_column("hits", lists)


def packed_lists(rows: pa.Table, column: str) -> bytes:
    """Rows with an array of words each as one record."""
    words = rows[column].combine_chunks()
    flat = pc.list_flatten(words)
    sizes = pc.fill_null(words.value_lengths(), 0).to_numpy().astype(np.int64)
    valid = pc.is_valid(words).to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.fill_null(pc.add(pc.binary_length(flat), 1), 0).to_numpy()
    text = pc.fill_null(pc.binary_join(pa.ListArray.from_arrays(
        pa.array([0, len(flat)], pa.int32()), pc.fill_null(flat, "")), ""), "")
    parts = [_bytes(t) for t in (
        rows.drop_columns(column), pa.table({**_planes("size", sizes), **_planes("valid", valid)}),
        pa.table(_planes("length", lengths)), pa.table({"text": text}))]
    return b"".join(len(p).to_bytes(8) + p for p in parts)


def unpacked_lists(data: bytes) -> tuple[pa.Table, np.ndarray, pa.DictionaryArray, np.ndarray]:
    """(other columns, which arrays are not NULL, words of all arrays, sizes) of a record."""
    parts, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8])
        parts.append(_table(data[at + 8:at + 8 + n]))
        at += 8 + n
    rest, sizes, lengths, text = parts
    return rest, _numbers(sizes, "valid") > 0, _words(text["text"].combine_chunks(), _numbers(lengths, "length")), _numbers(sizes, "size")


def by_bucket(words: pa.Array, n: int) -> tuple[np.ndarray, list[bytes]]:
    """(bucket, record of words and their places) of an array of different words; NULL is left out."""
    at = np.flatnonzero(pc.is_valid(words).to_numpy(zero_copy_only=False))
    bucket = bucket_of(words.take(pa.array(at)), n)
    order = np.argsort(bucket, kind="stable")
    at, bucket = at[order], bucket[order]
    ends = np.r_[_starts(bucket), len(bucket)]
    return bucket[ends[:-1]], [_bytes(pa.table({"word": words.take(pa.array(at[a:b])), **_planes("step", np.diff(at[a:b], prepend=0))}))
                               for a, b in zip(ends[:-1], ends[1:], strict=True)]


def values_of(data: bytes, table: pa.Table) -> bytes:
    """Of a record of words, the places and values of those in the table."""
    read = _table(data)
    where = pc.index_in(read["word"].combine_chunks(), table["word"].combine_chunks())
    hit = pc.is_valid(where).to_numpy(zero_copy_only=False)
    at = np.cumsum(_numbers(read, "step"))[hit]
    values = table["value"].combine_chunks().take(where.drop_null())
    return _bytes(pa.table({**_planes("step", np.diff(at, prepend=0)), "value": values}))


def gathered(data: Sequence[bytes], n: int) -> pa.Array:
    """Values of ``n`` places from records of places and values, NULL where there is none."""
    values, listed = np.zeros(n, np.int64), np.zeros(n, bool)
    for record in data:
        read = _table(record)
        at = np.cumsum(_numbers(read, "step"))
        values[at], listed[at] = pc.fill_null(read["value"], 0).to_numpy(), pc.is_valid(read["value"]).to_numpy()
    return pa.array(values, mask=~listed)
