"""Token counts of a byte-level BPE tokenizer, by two deterministic transducers.

The first reads characters and marks where the parts begin that are tokenized on their own. The second
reads the bytes of a part; each of its transitions carries the number of tokens that it adds to
the count, which is negative where tokens merge.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from lexspark.llm.perplexity import pieces

LIMIT = 1024
CHUNK_CHARS = 1 << 19
SCAN_CHARS = 64
TRANSITIONS = 1 << 19
LONG_BYTES = 1 << 11
_MIX, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1

# classes of characters: letters are split by the part they can have in a contraction
END, LETTER, STMD, R, V, L, E, NUMBER, SPACE, WHITE, OTHER, QUOTE = range(12)
# states: nothing open, what is open, one or more white space characters that end with a space or not,
# an apostrophe that began a part, the same and a letter, a whole contraction
(NONE, IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACE_1, SPACES, WHITE_1, WHITES, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L,
 CLOSED) = range(13)
STATES, CLASSES = 13, 12
HERE, BEFORE = 1, 2


def _joining(codes: list[int], first: str) -> list[int]:
    """The code points that the library's parts join to ``first``."""
    text = "".join(first + chr(c) + "\n" for c in codes)
    starts = {span[0] for _, span in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)}
    return [c for i, c in enumerate(codes) if 3 * i + 1 not in starts]


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of each code point, in the library's version of Unicode.

    Python's version has fewer letters and numbers than the library's and the patterns' has more, so
    the library is asked about those between.
    """
    table = np.full(0x110000, OTHER, np.uint8)
    known = {c: unicodedata.category(chr(c))[0] for c in range(0x110000)}
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    newer = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", text) if known[ord(c)] not in "LN"]
    table[[c for c, kind in known.items() if kind == "L"] + _joining(newer, "b")] = LETTER
    table[[c for c, kind in known.items() if kind == "N"] + _joining(newer, "7")] = NUMBER
    table[[ord(c) for c in regex.findall(r"\s", text)]] = WHITE
    for chars, number in (("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E), (" ", SPACE), ("'", QUOTE)):
        table[[ord(c) for c in chars]] = number
    return table


def _opened(kind: int) -> int:
    return {NUMBER: IN_NUMBERS, SPACE: SPACE_1, WHITE: WHITE_1, OTHER: IN_OTHER, QUOTE: AFTER_QUOTE,
            END: NONE}.get(kind, IN_LETTERS)


def _step(state: int, kind: int) -> tuple[int, int]:
    """(next state, where parts begin: at this character, at the one before)."""
    letter, white = LETTER <= kind <= E, kind in (SPACE, WHITE)
    joined = _opened(OTHER if kind == QUOTE else kind)
    begun = _opened(kind), 0 if kind == END else HERE
    if state in (SPACE_1, SPACES, WHITE_1, WHITES) and white:
        return (SPACES if kind == SPACE else WHITES), 0
    if kind == END:
        return NONE, BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
    if state == IN_LETTERS and letter or state == IN_NUMBERS and kind == NUMBER:
        return state, 0
    if state in (IN_OTHER, AFTER_QUOTE) and kind in (OTHER, QUOTE):
        return IN_OTHER, 0
    if state == SPACE_1:
        return joined, 0
    if state == SPACES:
        return joined, BEFORE
    if state == WHITES:
        return begun[0], HERE | BEFORE
    if state == AFTER_QUOTE and kind in (STMD, R, V, L):
        return {STMD: CLOSED, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind], 0
    if (state in (QUOTE_R, QUOTE_V) and kind == E) or (state == QUOTE_L and kind == L):
        return CLOSED, 0
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        return (IN_LETTERS, BEFORE) if letter else (begun[0], HERE | BEFORE)
    return begun


@lru_cache(1)
def part_transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) for state * CLASSES + class."""
    steps = [_step(s, k) for s in range(STATES) for k in range(CLASSES)]
    return np.array([s[0] for s in steps], np.uint8), np.array([s[1] for s in steps], np.uint8)


def states_before(kinds: np.ndarray) -> np.ndarray:
    """The state in which each character is read.

    Stretches of the text run side by side from every state. The resulting maps of states are composed
    in a prefix scan whose steps double their reach; then each stretch runs from its true state.
    """
    after, _ = part_transducer()
    n = -(-len(kinds) // SCAN_CHARS)
    padded = np.full(n * SCAN_CHARS, END, np.intp)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(n, SCAN_CHARS).T)
    maps = np.tile(np.arange(STATES, dtype=np.uint8)[:, None], (1, n))
    for column in columns:
        maps = after[maps * np.intp(CLASSES) + column]
    reach = 1
    while reach < n:
        later = maps.copy()
        # first the earlier stretches' map, then this one's
        later[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].astype(np.intp), axis=0)
        maps, reach = later, reach * 2
    state = np.concatenate([[np.uint8(NONE)], maps[NONE, :-1]]).astype(np.uint8)
    out = np.empty((SCAN_CHARS, n), np.uint8)
    for i, column in enumerate(columns):
        out[i] = state
        state = after[state * np.intp(CLASSES) + column]
    return out.T.ravel()[: len(kinds)]


def part_starts(kinds: np.ndarray) -> np.ndarray:
    """Whether a part begins at each character; END characters begin none and end all."""
    _, marks = part_transducer()
    out = marks[states_before(kinds) * np.intp(CLASSES) + kinds]
    starts = (out & HERE) != 0
    starts[:-1] |= (out[1:] & BEFORE) != 0
    return starts


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if it is printable, else the next
    one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PartCounter:
    """The byte transducer of a vocabulary, compiled as its transitions are first used.

    A part's tokens are those by which each token and the next are what BPE makes of the two. So after
    some bytes, what is to come depends only on the places from which a longer token may still begin:
    where each stands in the tree of tokens, the last token before it, and the tokens up to it less
    those up to here. That is a state. States are finite, but too many to list for all texts.
    """

    def __init__(self, vocabulary: dict):
        letters = byte_letters()
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, merge in enumerate(vocabulary["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[bytes(letters[c] for c in a), bytes(letters[c] for c in b)] = rank
        self.special = [t["content"] for t in vocabulary["added_tokens"]]
        special = set(self.special)
        self.text = [bytes(letters[c] for c in t) for t in vocabulary["model"]["vocab"] if t not in special]
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        for number, text in enumerate(self.text):
            self._add(text, number)
        self.agree: dict[int, bool] = {}
        self._clear()

    def _add(self, text: bytes, number: int) -> None:
        node = 0
        for byte in text:
            if byte not in self.child[node]:
                self.child[node][byte] = len(self.child)
                self.child.append({})
                self.token.append(None)
            node = self.child[node][byte]
        self.token[node] = number

    def _clear(self) -> None:
        start = ((0, -1, 0),)
        self.numbers, self.states = {start: 0}, [start]
        self._table(TRANSITIONS.bit_length())

    def _table(self, bits: int) -> None:
        """An empty table of transitions, by a hash of state and byte."""
        self.bits, self.held = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.after, self.added = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int16)

    def _slot(self, key: int) -> int:
        slot = (key * _MIX & _ALL) >> 64 - self.bits
        while self.keys[slot] not in (-1, key):
            slot = slot + 1 & (1 << self.bits) - 1
        return slot

    def _put(self, key: int, state: int, count: int) -> None:
        if 2 * self.held > len(self.keys):
            old = self.keys, self.after, self.added
            self._table(self.bits + 1)
            for at in np.flatnonzero(old[0] >= 0).tolist():
                self._put(int(old[0][at]), int(old[1][at]), int(old[2][at]))
        slot = self._slot(key)
        self.keys[slot], self.after[slot], self.added[slot] = key, state, count
        self.held += 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each transition; that of a missing one is empty."""
        slots = ((keys.astype(np.uint64) * np.uint64(_MIX)) >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[slots]
        other = np.flatnonzero((held != keys) & (held >= 0))
        while len(other):
            slots[other] = slots[other] + 1 & (1 << self.bits) - 1
            held = self.keys[slots[other]]
            other = other[(held != keys[other]) & (held >= 0)]
        return slots

    def merged(self, text: bytes) -> list[bytes]:
        """Tokens of ``text`` by the merges in the order of their rank."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranked = [self.ranks.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            rank = min(ranked)
            if rank == 1 << 30:
                break
            i = ranked.index(rank)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, last: int, token: int) -> bool:
        """Whether BPE leaves the two tokens as they are; the first of a part (-1 before it) is free."""
        key = last * len(self.text) + token
        if key not in self.agree:
            own = [self.text[last], self.text[token]] if last >= 0 else [self.text[token]]
            self.agree[key] = self.merged(b"".join(own)) == own
        return self.agree[key]

    def compile(self, state: int, byte: int) -> None:
        """Add one transition, and the state it leads to if that is new."""
        open_places, token, count = [], -1, 0
        for node, last, tokens in self.states[state]:
            below = self.child[node].get(byte)
            if below is None:
                continue
            if token < 0 and self.token[below] is not None and self.follows(last, self.token[below]):
                token, count = self.token[below], tokens + 1
            if self.child[below]:
                open_places.append((below, last, tokens))
        new = (*((node, last, tokens - count) for node, last, tokens in open_places), (0, token, 0))
        number = self.numbers.setdefault(new, len(self.states))
        if number == len(self.states):
            self.states.append(new)
        self._put(state << 8 | byte, number, count)

    def counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each part of ``data``; short parts run side by side, and so do the chunks of a long one."""
        if self.held > TRANSITIONS:  # begin anew rather than grow with the texts
            self._clear()
        if len(self.agree) > TRANSITIONS:
            self.agree.clear()
        out = np.zeros(len(starts), np.int64)
        short = np.flatnonzero(sizes <= LONG_BYTES)
        out[short] = self.run(data, starts[short], sizes[short], np.zeros(len(short), np.int64))[1]
        for i in np.flatnonzero(sizes > LONG_BYTES):
            out[i] = self.long_count(data, int(starts[i]), int(sizes[i]))
        return out

    def run(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the state after, the tokens of) each stretch of ``data``, read from the state ``begin``."""
        out, ends = np.zeros(len(starts), np.int64), begin.copy()
        active = np.flatnonzero(sizes > 0)
        state = begin[active]
        step = 0
        while len(active):
            keys = state << 8 | data[starts[active] + step]
            slots = self.find(keys)
            missing = np.flatnonzero(self.keys[slots] < 0)
            if len(missing):
                bits = self.bits
                for key in set(keys[missing].tolist()):
                    self.compile(key >> 8, key & 255)
                if bits == self.bits:
                    slots[missing] = self.find(keys[missing])
                else:
                    slots = self.find(keys)
            out[active] += self.added[slots]
            state = self.after[slots].astype(np.int64)
            step += 1
            on = sizes[active] > step
            ends[active[~on]] = state[~on]
            active, state = active[on], state[on]
        return ends, out

    def long_count(self, data: np.ndarray, start: int, size: int) -> int:
        """Tokens of one long part: its chunks' maps (state before -> state after, tokens), composed.

        Which states a chunk may begin in is not known beforehand: it is tried from the start, then from
        those in which the chunk before it ended. Maps are composed in a prefix scan whose steps double
        their reach, until all chunks are known from their true state. States forget soon, so few rounds
        do; each settles one more chunk at least.
        """
        width = max(LONG_BYTES // 8, int(size ** 0.5))
        n = -(-size // width)
        starts = start + width * np.arange(n)
        sizes = np.minimum(width, start + size - starts)
        place, seen = {0: 0}, [0]
        after, added = np.full((n, 1), -1), np.zeros((n, 1), np.int64)
        chunk, entry = np.arange(n), np.zeros(n, np.int64)
        while True:
            ends, found = self.run(data, starts[chunk], sizes[chunk], np.array(seen, np.int64)[entry])
            for state in np.unique(ends).tolist():
                if state not in place:
                    place[state] = len(seen)
                    seen.append(state)
            more = len(seen) - after.shape[1]
            after, added = np.pad(after, ((0, 0), (0, more)), constant_values=-1), np.pad(added, ((0, 0), (0, more)))
            after[chunk, entry], added[chunk, entry] = [place[s] for s in ends.tolist()], found
            total, tokens = composed(after, added)
            known = int((total[:, 0] >= 0).sum())  # a prefix of the chunks
            if known == n:
                return int(tokens[-1, 0])
            # a later chunk is tried from where those before it can end; the first open one surely
            wanted = np.zeros((n, len(seen)), bool)
            before, state = np.nonzero(after[known - 1:-1] >= 0)
            wanted[known + before, after[known - 1 + before, state]] = True
            wanted[known] = False
            wanted[known, total[known - 1, 0]] = True
            chunk, entry = np.nonzero(wanted & (after < 0))


def composed(after: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, (state after, tokens) from each state before the first row; -1 where a map has a gap."""
    reach, n = 1, len(after)
    while reach < n:
        first, own = after[:-reach], np.maximum(after[:-reach], 0)
        gap = first < 0
        then, count = after.copy(), added.copy()
        then[reach:] = np.where(gap, -1, np.take_along_axis(after[reach:], own, axis=1))
        count[reach:] = added[:-reach] + np.take_along_axis(added[reach:], own, axis=1)
        after, added, reach = then, count, 2 * reach
    return after, added


@lru_cache(2)
def part_counter(path: str) -> PartCounter:
    with open(path, encoding="utf-8") as file:
        return PartCounter(json.load(file))


def count_tokens(texts: list[str], counter: PartCounter) -> list[int]:
    """Tokens of each text; a special token's string in a text is that one token."""
    pieces, owner, out = [], [], np.zeros(len(texts), np.int64)
    split = regex.compile("|".join(map(regex.escape, counter.special))) if counter.special else None
    for i, text in enumerate(texts):
        parts = split.split(text) if split and any(s in text for s in counter.special) else [text]
        out[i] += len(parts) - 1
        pieces += parts
        owner += [i] * len(parts)
    joined = "\0".join(pieces) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    kinds = character_classes()[codes].astype(np.intp)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    kinds[ends] = END
    begins = part_starts(kinds)
    begins[ends] = True
    bounds = np.flatnonzero(begins)
    data = np.frombuffer(joined.encode("utf-8", "replace"), np.uint8)
    width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    place = (np.cumsum(width) - width)[bounds]
    sizes = np.diff(np.r_[place, len(data)])
    sizes[np.searchsorted(bounds, ends)] = 0
    found = counter.counts(data, place, sizes)
    piece = np.searchsorted(ends, bounds)
    np.add.at(out, np.array(owner, np.int64), np.bincount(piece, found, len(pieces)).astype(np.int64))
    return out.tolist()


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = part_counter(path)
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens: list[int] = []
            start = total = 0
            for i, text in enumerate(texts):
                total += len(text)
                if total >= CHUNK_CHARS or i + 1 == len(texts):
                    tokens += count_tokens(texts[start:i + 1], counter)
                    start, total = i + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text).

    ``path`` names a byte-level BPE vocabulary file that every executor has. Nothing is shuffled. A NULL
    text counts as empty: no bytes, no tokens. Long texts, and long parts of them, are read in chunks side by side. Repeated rows each give a row; other columns are not
    read; an empty table gives an empty result.
    """
    read = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return read.mapInArrow(_counted(path), "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn(
        "over_limit", F.col("n_tokens") > limit)
