"""Benchmark decontamination: q-gram counts in diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.perplexity import chunks, pieces
from lexspark.llm.quality import contained
from lexspark.llm.words import SPACES

#: Lengths of grams; an item has the longest of which a match must share enough, half its length.
QS = (8, 4, 2, 1)
EDIT_RATE = 0.1
LISTED = 1 << 21
REGION_CHARS = 1 << 15
BLOCK_CHARS = 8 << 20
CHUNK_CHARS = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint"


def fold_table() -> np.ndarray:
    """Lower case of each code point below 2**17, ASCII white space as a space, NUL as a space."""
    table = np.arange(1 << 17, dtype=np.uint32)
    for cp in range(1 << 17):
        low = chr(cp).lower() if not 0xD800 <= cp < 0xE000 else ""
        if len(low) == 1:
            table[cp] = ord(low)
    table[[0, *map(ord, SPACES)]] = 32
    return table


def folded(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, each ended by NUL; their place in the joined texts).

    Letters are in lower case and runs of white space are one space.
    """
    codes = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "replace"), np.uint32)
    out = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], codes)
    out[np.cumsum([len(t) + 1 for t in texts]) - 1] = 0
    space = out == 32
    keep = np.flatnonzero(~(space & np.r_[False, space[:-1]]))
    return out[keep], keep


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Each q-gram as one number, of eight bits per character; different ones may rarely agree."""
    out, width = np.where(codes < 128, codes, 128 + codes % 128).astype(np.uint64), 1
    while width < q:
        out, width = out[:-width] | out[width:] << np.uint64(8 * width), 2 * width
    return out


def shared_grams(size: int, edits: int) -> tuple[int, int]:
    """(q, the q-grams of an item of ``size`` characters that a match with ``edits`` edits shares at least)."""
    # the lemma: an edit takes part in q grams at most
    return next(((q, n) for q in QS if (n := size - q + 1 - q * edits) >= max(1, q // 2)), (0, 0))


@dataclass
class Index:
    """The q-grams of those items of a block that have grams of one length."""

    q: int
    ids: list[int | None]
    items: list[np.ndarray]
    edits: np.ndarray
    shared: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bits: int

    @classmethod
    def build(cls, rows: list[tuple[int | None, np.ndarray]], q: int, edit_rate: float) -> Index:
        ids, items = [r[0] for r in rows], [r[1] for r in rows]
        sizes = np.array([len(c) for c in items], np.int64)
        edits = (sizes * edit_rate).astype(np.int64)
        found = [grams(c, q) for c in items]
        every = np.concatenate(found)
        item = np.repeat(np.arange(len(items)), sizes - q + 1)
        offset = np.concatenate([np.arange(len(g)) for g in found])
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        return cls(q, ids, items, edits, sizes - q + 1 - q * edits, every[first], first,
                   np.diff(np.r_[first, len(every)]), item[order], offset[order],
                   int(min(26, max(16, np.ceil(np.log2(len(first) * 32))))))

    def bitmap(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, bool)
        out[(self.keys * _MIX) >> np.uint64(64 - self.bits)] = True
        return out


def indexes(rows: list[tuple[int | None, str]], edit_rate: float) -> list[Index]:
    """The indexes of a block of items, one for each length of grams that is in use."""
    if not 0 <= edit_rate < 1:
        raise ValueError("edit_rate must be at least 0 and below 1")
    table, by_q = fold_table(), {}
    for item_id, text in rows:
        codes = folded([text], table)[0][:-1]
        codes = codes[np.argmax(codes != 32):] if len(codes) else codes
        codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
        q, _ = shared_grams(len(codes), int(len(codes) * edit_rate))
        if q:
            by_q.setdefault(q, []).append((item_id, codes))
    return [Index.build(own, q, edit_rate) for q, own in by_q.items()]


def _listed(index: Index, at: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item and band, offset) of the postings of the grams at ``at``, some two million at a time."""
    stride = index.edits + 1
    shift = max(len(c) for c in index.items)
    ends = np.cumsum(index.count[key])
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LISTED, "right")))
        many = index.count[key[a:b]]
        posting = np.repeat(index.first[key[a:b]] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        item, offset = index.item[posting], index.offset[posting]
        yield item << 32 | (np.repeat(at[a:b], many) - offset + shift) // stride[item], offset
        a = b


def regions(codes: np.ndarray, index: Index, bitmap: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, start, end): parts of ``codes`` that share enough q-grams with an item.

    A match with up to e edits lies within e + 1 neighbouring diagonals, and so within two of the
    bands of e + 1 diagonals each that are counted together here. Grams that are often in the text and in
    items are counted in slices, so only bands are held, not all their hits.
    """
    if len(codes) < index.q:
        return
    every = grams(codes, index.q)
    at = np.flatnonzero(bitmap[(every * _MIX) >> np.uint64(64 - index.bits)])
    key = np.searchsorted(index.keys, every[at])
    key[key == len(index.keys)] = 0
    same = index.keys[key] == every[at]
    at, key = at[same], key[same]
    bands, together = np.empty(0, np.int64), np.empty(0, np.int64)
    for place, _ in _listed(index, at, key):
        own, hits = np.unique(place, return_counts=True)
        if len(bands):
            own, back = np.unique(np.concatenate([bands, own]), return_inverse=True)
            hits = np.bincount(back, np.concatenate([together, hits])).astype(np.int64)
        bands, together = own, hits
    shared = together.copy()
    follows = np.flatnonzero(bands[1:] == bands[:-1] + 1)
    together[follows] += shared[follows + 1]
    bands = bands[together >= index.shared[bands >> 32]]
    if not len(bands):
        return
    # now count each place of the item once: repeated words hit one place many times
    wanted = np.unique(np.concatenate([bands, bands + 1]))
    place, offset = np.empty(0, np.int64), np.empty(0, np.int64)
    for own, there in _listed(index, at, key):
        near = contained(own, wanted)
        place, offset = np.concatenate([place, own[near]]), np.concatenate([offset, there[near]])
        order = np.lexsort((offset, place))
        place, offset = place[order], offset[order]
        new = np.r_[True, (place[1:] != place[:-1]) | (offset[1:] != offset[:-1])][:len(place)]
        place, offset = place[new], offset[new]
    stride, shift = index.edits + 1, max(len(c) for c in index.items)
    lows, highs = np.searchsorted(place, bands), np.searchsorted(place, bands + 1, "right")
    for band, a, b in zip(bands.tolist(), lows, highs, strict=True):
        no = band >> 32
        if b - a >= index.shared[no] and len(set(offset[a:b].tolist())) >= index.shared[no]:
            low, spare = (band & 0xFFFFFFFF) * int(stride[no]) - shift, int(index.edits[no])
            yield no, max(0, low - spare), min(len(codes), low + 2 * int(stride[no]) + len(index.items[no]) + spare)


def merged(found: Iterator[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Regions of an item that overlap are one, up to a bounded length, and so are aligned once."""
    held = None
    for no, low, high in found:
        if held and held[0] == no and low <= held[2] and high - held[1] <= REGION_CHARS:
            held = no, held[1], max(high, held[2])
        else:
            if held:
                yield held
            held = no, low, high
    if held:
        yield held


def align(item: np.ndarray, text: np.ndarray, most: int, anchored: bool = False) -> tuple[int, int] | None:
    """(edits, end) of the best match of ``item`` in ``text`` with ``most`` edits at most.

    Only diagonals on which such a match can lie are computed. ``anchored`` matches begin at the
    first character of ``text``.
    """
    low = -most
    width = (most if anchored else max(0, len(text) - len(item)) + most) - low + 1
    steps = np.arange(width)
    padded = np.concatenate([np.full(most, -1, np.int64), text, np.full(width + len(item), -1, np.int64)])
    far = len(item) + len(text) + 1
    now = np.abs(steps + low) if anchored else np.zeros(width, np.int64)
    now[: -low] = far  # before the text
    for i, char in enumerate(item):
        cost = now + (padded[i: i + width] != char)
        cost[:-1] = np.minimum(cost[:-1], now[1:] + 1)
        ends = steps + low + i + 1
        cost[(ends < 0) | (ends > len(text))] = far
        now = np.minimum.accumulate(cost - steps) + steps
        now[(ends < 0) | (ends > len(text))] = far
        if now.min() > most:
            return None
    best = int(now.argmin())
    return int(now[best]), best + low + len(item)


def matches(texts: list[str], index: Index, bitmap: np.ndarray, table: np.ndarray) -> dict:
    """{(row, item): (distance, start, end)}: the best match of every item in every text."""
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    if not texts:
        return found
    codes, place = folded(texts, table)
    stops = np.flatnonzero(codes == 0)
    text_starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    for no, low, high in merged(regions(codes, index, bitmap)):
        item, most = index.items[no], int(index.edits[no])
        row = int(np.searchsorted(stops, low))
        while low < high and row < len(stops):
            end = min(high, int(stops[row]))
            known = found.get((row, no))
            if end - low >= len(item) - most and not (known and known[0] == 0):
                part = codes[low:end]
                exact = part.tobytes().decode("utf-32-le", "replace").find(
                    item.tobytes().decode("utf-32-le", "replace"))
                got = (0, exact + len(item)) if exact >= 0 else align(
                    item.astype(np.int64), part.astype(np.int64), most)
                if got:
                    back = (0, len(item)) if exact >= 0 else align(
                        item[::-1].astype(np.int64), part[: got[1]][::-1].astype(np.int64), most, True)
                    a, b = low + got[1] - back[1], low + got[1]
                    here = (got[0], int(place[a] - text_starts[row]), int(place[b - 1] - text_starts[row]) + 1)
                    found[row, no] = min(known or here, here)
            low, row = int(stops[row]) + 1, row + 1
    return found


def _found(block: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = fold_table()
        maps = [(own, own.bitmap()) for own in block.value]
        for batch in pieces(batches):
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows = [
                (ids[a + row], own.ids[no], start, end, distance)
                for a, b in chunks(texts, CHUNK_CHARS) for own, bitmap in maps
                for (row, no), (distance, start, end) in matches(texts[a:b], own, bitmap, table).items()
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def _without(block: Broadcast, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = fold_table()
        maps = [(own, own.bitmap()) for own in block.value]
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            hit = {a + row for a, b in chunks(texts, CHUNK_CHARS) for own, bitmap in maps
                   for row, _ in matches(texts[a:b], own, bitmap, table)}
            yield batch.take(pa.array([i for i in range(len(texts)) if i not in hit], pa.int64()))

    return run


def _blocks(benchmark: DataFrame, edit_rate: float, block_chars: int) -> Iterator[Broadcast]:
    """The indexes of each block of items; a block holds about ``block_chars`` characters."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    n = -(-chars // block_chars)
    for i in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = [(r["item_id"], r["text"]) for r in block.collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(indexes(rows, edit_rate))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, item_id, start, end, distance): the best match of an item in a row of ``docs``.

    A row (doc_id, text) matches an item (item_id, text) of ``benchmark`` if part of its text can be
    turned into the item by edits of single characters, ``edit_rate`` of the item's length at most;
    case and the amount of white space do not count. ``start`` and ``end`` are code points of the
    text. Items of any length are searched for, short ones by shorter grams: below ten characters only
    equal ones match, at the default rate. Items without a character match nothing. The benchmark
    is the query set: it goes over all rows in blocks of bounded size, and no row is shuffled. NULL
    texts match nothing; very long ones are counted in slices of bounded size. Repeated rows or items give a match each, and a NULL id is kept as it is. Other
    columns are not read; empty tables give an empty result.
    """
    found = [docs.select("doc_id", "text").mapInArrow(_found(block), SCHEMA)
             for block in _blocks(benchmark, edit_rate, block_chars)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], SCHEMA)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""
    at = docs.columns.index("text")
    for block in _blocks(benchmark, edit_rate, block_chars):
        docs = docs.mapInArrow(_without(block, at), docs.schema)
    return docs
