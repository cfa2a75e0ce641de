"""Resampling, whitening and byte-level BPE against plain versions."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lexspark.llm import byte_pairs, importance, whitening
from tests.llm.rows import documents, prose, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "a" * 70_000, " " * 9_000 + "x", "\n" * 6_000, "x" + "\t \n" * 30_000 + " y", "漢字と仮名" * 20_000,
       ("It's 1234 o'clock!!  \n" * 5_000), "😀́ é\x85\xa0　z", "a\x1c\x1d b" * 20_000, "<|endoftext|> x"]


def plain_words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_buckets(text: str | None) -> list[int]:
    w = plain_words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain_resampled(rows, target) -> Counter:
    corpus, wanted = Counter(), Counter()
    for r in rows:
        corpus.update(plain_buckets(r[1]))
    for text in target:
        wanted.update(plain_buckets(text))
    s_all, t_all = corpus.total(), wanted.total()
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((corpus[b] + 1) * (t_all + 10_000))))
            for b in range(10_000)]
    out = []
    for doc_id, text, *_ in rows:
        own = plain_buckets(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(own), weight, score, len(plain_words(text)) >= 20))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {i: r for i, r in enumerate(able[:5 * len(able) // 100], 1)}
    ranked = Counter((*r[:4], i) for i, r in drawn.items())
    rest = Counter(r[:4] for r in out) - Counter(r[:4] for r in drawn.values())
    return ranked + Counter({(*r, None): n for r, n in rest.items()})


def test_resampling(spark):
    rows = documents() + [(900 + i, prose(40 + i, i % 7) + " Ünï9 A_b", "en", "s") for i in range(80)]
    target = [prose(50, i) for i in range(5)] + [None, ""]
    wanted = plain_resampled(rows, target)
    docs = table(spark, rows)
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = importance.resampled(docs, texts)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == wanted
    assert Counter(map(tuple, importance.resampled(docs.repartition(9), texts).collect())) == wanted
    assert sum(r[4] is not None for r in wanted.elements()) >= 5
    assert importance.resampled(table(spark, []), texts).count() == 0
    alone = importance.resampled(table(spark, [(1, "a b", None, None)]), texts.limit(0)).collect()
    assert [(r.doc_id, r.n_features, r.rank) for r in alone] == [(1, 3, None)]


def test_checksums_of_word_runs():
    draw = random.Random(3)
    words = [["".join(draw.choice("ab0ü") for _ in range(draw.choice([1, 2, 3, 9, 40, 300]))) for _ in range(n)]
             for n in (0, 1, 2, 3, 50)]
    owner, bucket = importance.features([[w.encode() for w in own] for own in words], importance.Shifts(), importance._Memo())
    got = [sorted(bucket[owner == i].tolist()) for i in range(len(words))]
    assert got == [sorted(plain_buckets(" ".join(own))) for own in words]


def test_parts_of_a_long_text_count_each_run_once(monkeypatch):
    text = prose(500, 4)
    wanted = Counter(plain_buckets(text))
    for size in (1, 2, 3, 7, 499, 1000):
        monkeypatch.setattr(importance, "_PART_WORDS", size)
        n, counts = importance.long_counts(text.encode(), importance.Shifts(), importance._Memo())
        assert n == len(plain_words(text)) and {b: c for b, c in enumerate(counts.tolist()) if c} == wanted


def test_shared_bits_of_planes_are_products():
    draw = np.random.default_rng(5)
    counts = draw.integers(0, 2, (3, 10_000)) * draw.integers(0, 3000, (3, 10_000))
    gain = draw.integers(-20_000, 9_000, 10_000)
    rows, values = importance.gain_planes(gain)
    for own, planes in zip(counts, importance.planes_of(counts), strict=True):
        total = sum(int(v) * int(np.bitwise_count(p & g).sum()) << q
                    for q, p in enumerate(importance._unpacked(planes)) for g, v in zip(rows, values, strict=True))
        assert total == int(own @ gain)


def spectrum(values, seed=0) -> np.ndarray:
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    return (q * values) @ q.T


class Dense:
    def __init__(self, v: np.ndarray):
        self.v, self.d, self.passes = v, len(v), 0

    def times(self, block: np.ndarray) -> np.ndarray:
        self.passes += 1
        return self.v @ block


@pytest.mark.parametrize("values", [
    np.r_[106, 104, np.linspace(68.4, 57.9, 62)], 2.0 ** -np.arange(64), np.r_[np.arange(5, 0, -1.0), np.zeros(59)],
    np.ones(64), np.r_[1e6, np.random.default_rng(1).uniform(1, 2, 199)], np.linspace(10, 9.9, 300),
    np.r_[9, 9, 9, np.repeat(5.0, 30), np.repeat(2.0, 31)], np.arange(1, 21.0), np.array([4.0]), np.zeros(40),
])
def test_leading_components(values):
    v = spectrum(values)
    found = whitening.leading_components(Dense(v))
    want = np.linalg.eigvalsh(v)[::-1][:16]
    scale = max(want[0], 1e-300)
    assert np.abs(found.values - want).max() <= 1e-13 * scale
    assert np.linalg.norm(v @ found.vectors - found.vectors * found.values, axis=0).max() <= 2e-12 * scale
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(want))).max() < 1e-13


def plain_whitened(vectors: dict, k=16) -> dict:
    kept = {i: v for i, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in kept.items()}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    rows = np.array([[(n * c - s) / n for c, s in zip(f, sums, strict=True)] for f in fit])
    cov = rows.T @ rows / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    keep = values > 1e-12 * values[0]
    out = {}
    for i, own in x.items():
        dev = [n * c - s for c, s in zip(own, sums, strict=True)]
        out[i] = (n, sum(d * d for d in dev), np.array(dev) / n @ vecs[:, keep] / np.sqrt(values[keep]))
    return out, values[keep] / np.trace(cov)


@pytest.mark.parametrize(("d", "n"), [(40, 300), (5, 60), (64, 12)])
def test_whitening(spark, d, n):
    draw = np.random.default_rng(d)
    base = draw.standard_normal((n, d)) * np.linspace(0.3, 3, d)
    vectors = {i: [float(np.float32(c)) for c in row] for i, row in enumerate(base)}
    vectors |= {n + i: vectors[3] for i in range(40)}
    odd = {5000: None, 5001: [], 5002: [None] * d, 5003: [float("nan")] * d, 5004: [float("inf")] + [0.0] * (d - 1),
           5005: [1.0] * (d + 1)}
    schema = "vec_id bigint, embedding array<float>, n int, component string, x int, label int"
    rows = spark.createDataFrame([(i, v, 1, "c", 2, 3) for i, v in (vectors | odd).items()], schema)
    want, explained = plain_whitened(vectors)
    got = whitening.whitened(rows).collect()
    assert len(got) == len(want) * len(explained) and len({r.identity_error for r in got}) == 1
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        size, deviation, whitened = want[r.vec_id]
        assert (r.n, r.deviation) == (size, deviation)
        value = whitened[r.component - 1]
        sign.setdefault(r.component, 1 if value * r.whitened >= 0 else -1)
        assert r.whitened * sign[r.component] == pytest.approx(value, abs=1e-8)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-8


def test_whitening_of_large_numbers_and_of_nothing(spark):
    schema = "vec_id bigint, embedding array<double>"
    vectors = {i: [1e4 * i, 3.0 * i * i, 1e6 - i] for i in range(30)}
    rows = spark.createDataFrame([*vectors.items(), (None, vectors[2])], schema)
    want, _ = plain_whitened(vectors)
    for r in whitening.whitened(rows).collect():
        assert r.deviation == want[2 if r.vec_id is None else r.vec_id][1]
    for nothing in ([], [(1, None)], [(1, [1.0, 2.0])] * 3):
        assert whitening.whitened(spark.createDataFrame(nothing, schema)).count() == 0


def test_sums_beyond_64_bits_stay_exact():
    fit = whitening.Fit(10 ** 9, (10 ** 15, 0), (0, -10 ** 9), (2 * 10 ** 6, 10 ** 9))
    assert not fit.exact_in_64_bits
    assert fit.deviations(np.array([[2_000_000, 7]])).tolist() == [[10 ** 15, 7 * 10 ** 9]]


def plain_encoding() -> tiktoken.Encoding:
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs(spark):
    rows = documents() + [(1000 + i, t, "en", "s") for i, t in enumerate(ODD)]
    plain = plain_encoding()
    ids = byte_pairs.encode(table(spark, rows), RANKS, public_tokenizers.PATTERN)
    back = byte_pairs.decode(ids, RANKS, public_tokenizers.PATTERN)
    got = Counter(map(tuple, byte_pairs.digests(back).collect()))
    wanted = Counter()
    for doc_id, text, *_ in rows:
        own = plain.encode_ordinary(text or "")
        wanted[doc_id, len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(),
               hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == wanted
    assert byte_pairs.encode(table(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    assert ids.schema["doc_id"].dataType.simpleString() == "bigint"


def test_decoding_of_cut_and_missing_ids(spark):
    plain = plain_encoding()
    cut = np.array(plain.encode_ordinary("漢字😀")[:-1], "<u4").tobytes()
    rows = spark.createDataFrame([("a", cut), ("b", None), (None, b"")], "doc_id string, ids binary")
    got = {r.doc_id: r.decoded for r in byte_pairs.decode(rows, RANKS, public_tokenizers.PATTERN).collect()}
    assert bytes(got["a"]) == plain.decode_bytes(np.frombuffer(cut, "<u4").tolist())
    assert got["b"] is None and bytes(got[None]) == b""


def test_parts_of_long_texts(monkeypatch):
    """Cutting nearly everywhere changes no ids, and white space beyond the pattern's reach is encoded."""
    with open(RANKS, "rb") as file:
        codec = byte_pairs.Codec(file.read(), public_tokenizers.PATTERN)
    plain, draw = plain_encoding(), random.Random(1)
    monkeypatch.setattr(byte_pairs, "PART_CHARS", 1)
    monkeypatch.setattr(byte_pairs, "_BLANK_RUN", re.compile(f"[{byte_pairs._BLANKS}]{{3,}}"))
    for _ in range(2000):
        text = "".join(draw.choice(["a", "'s", "'", " ", "  ", "\n", "\t", "　", "\x85", "9", "!", "é", "漢", "\x1c", "   "])
                       for _ in range(draw.randrange(2, 30)))
        assert codec.encode(text).tolist() == plain.encode_ordinary(text), repr(text)
    monkeypatch.undo()
    blank = " " * 2_000_000
    assert byte_pairs.Codec.decode(codec, codec.encode(blank + "x")) == (blank + "x").encode()
    assert codec.encode(blank + "x")[-1] == plain.encode_ordinary(" x")[0]
