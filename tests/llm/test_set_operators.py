"""Mixing, tool calls, sharding, near-duplicates, line dedup, training order and the pipeline."""

from __future__ import annotations

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lexspark.llm import (components, line_dedup, mixing, quality, rendezvous, simhash, tool_calls, training_order)
from tests.llm.rows import documents, prose, table, words


def plain_targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    cut = set()
    while True:
        free = [s for s in order if s not in cut]
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in cut)
        level = rest / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in cut else level * weight[s] for s in order}
        cut |= more


def test_mixing(spark):
    rows = documents() + [(500, "one two three", "en", "same")] * 7
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    target = plain_targets(sizes)
    docs = table(spark, rows)
    named = {r[0]: r[3] for r in rows}
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    taken = defaultdict(int)
    largest = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        if r.doc_id is not None:
            assert r.source_size == sizes[named[r.doc_id]]
            assert r.target == pytest.approx(target[named[r.doc_id]])
        source = named[r.doc_id] if r.doc_id is not None else ("s2" if r.size else None)
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= max(largest[source] / 2, 7) + 1
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    copies = Counter((r.doc_id, r.text) for r in out.collect())
    for r in got:
        if r.doc_id not in (None, 70, 500):
            text = next(t for i, t, *_ in rows if i == r.doc_id)
            assert copies[r.doc_id, text] == (r.taken // r.size if r.size else 0)
    assert mixing.mix(table(spark, [])).count() == 0 and mixing.mixed(table(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(table(spark, [(1, None, None, None)])).collect()] == [0]


def test_columns_of_the_same_names_stay(spark):
    rows = [(1, "a b c\na b c", "k"), (1, "a b c\na b c", "k"), (2, "x \t", None), (3, " \t\n ", "v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns(
        {c: F.lit(c) for c in ("_key", "_id", "_gone", "_doc", "_row", "_copies")})
    for out in (simhash.deduplicated(docs), line_dedup.without_repeats(docs), mixing.mixed(docs)):
        assert out.columns == docs.columns
        assert all(r[c] == c for r in out.collect() for c in docs.columns[3:])
    assert {r.text for r in line_dedup.without_repeats(docs).where("doc_id = 1").collect()} == {"a b c"}


def test_budgets_are_nested(spark):
    docs = table(spark, [(i, prose(30, i), "en", "s") for i in range(60)])
    less = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.4).collect()}
    more = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.7).collect()}
    assert all(more[i] >= less[i] for i in less) and sum(more.values()) > sum(less.values())


def test_shards(spark):
    rows = documents() + [(None, "again", "en", "s")] * 40
    got = rendezvous.shard_rows(table(spark, rows)).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    shard, slots = {}, defaultdict(list)
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
        assert shard.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert rendezvous.shard_rows(table(spark, [])).count() == 0


def test_shards_follow_weights(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    got = Counter(r.shard for r in rendezvous.shard_rows(docs, 4, [1, 1, 2, 4]).select("shard").collect())
    for shard, weight in enumerate((1, 1, 2, 4)):
        assert abs(got[shard] - 20_000 * weight / 8) < 400
    moved = rendezvous.shard_rows(docs, 4).where("shard <> grown_shard").count()
    assert abs(moved - 4000) < 300


def plain_fingerprint(text) -> int:
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(nodes: list[int], linked) -> dict:
    root = {n: n for n in nodes}
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {n: low if r == high else r for n, r in root.items()}
    return root


def test_simhash(spark):
    rows = documents() + [(600 + i, "The  a\tb c D é", "en", "s") for i in range(3)]
    got = simhash.near_duplicates(table(spark, rows)).collect()
    prints = {(i, plain_fingerprint(t)) for i, t, *_ in rows}
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter(
        (i, f"{plain_fingerprint(t):016x}") for i, t, *_ in rows)
    values = sorted({p for _, p in prints})
    root = plain_components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {r: min((i for i, p in prints if root[p] == r and i is not None), default=None) for r in root.values()}
    for r in got:
        assert r.component_id == least[root[int(r.fingerprint, 16)]]
    docs = table(spark, rows)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(least.values(), key=str)
    assert simhash.near_duplicates(table(spark, [])).count() == 0 and simhash.deduplicated(table(spark, [])).count() == 0
    lone = simhash.near_duplicates(table(spark, [(None, "a", None, None)] * 2)).collect()
    assert [r.component_id for r in lone] == [None, None]
    assert simhash.deduplicated(table(spark, [(None, "a", None, None)] * 2)).count() == 1


@pytest.mark.parametrize(("bits", "segments"), [(2, 16), (2, 4), (3, 16), (1, 8)])
def test_pigeonring_links_what_all_pairs_link(spark, bits, segments):
    draw = random.Random(bits)
    values = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(12):
            base ^= sum(1 << draw.randrange(64) for _ in range(draw.randrange(1, 4)))
            values.add(base & (1 << 64) - 1)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    for small in (64, 2):
        edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), bits, segments, small)
        found = {(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in edges.collect()}
        assert all((a ^ b).bit_count() <= bits for a, b in found)
        root = plain_components(values, lambda a, b: (a ^ b).bit_count() <= bits)
        assert root == plain_components(values, lambda a, b: (a, b) in found or (b, a) in found)


def test_components(spark):
    draw = random.Random(2)
    for edges in ([(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                  [(draw.randrange(60), draw.randrange(60)) for _ in range(40)], [(1, 1)], []):
        got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
        assert got == plain_components(nodes, lambda a, b: (a, b) in edges or (b, a) in edges)


def test_lines(spark):
    draw = random.Random(9)
    base = [prose(14, 900 + i).replace("\n", " ").split() for i in range(12)]
    rows = documents()
    for i in range(30):
        lines = []
        for _ in range(4):
            line = list(draw.choice(base))
            for _ in range(draw.randrange(4)):
                line[draw.randrange(len(line))] = draw.choice(["q", "x", "the"])
            lines.append(" ".join(line))
        rows.append((700 + i, "\n".join([*lines, "", "a b", "  "]), "en", "s"))
    rows += [(800 + i, f"Page {i} of nine hundred pages in this book of lines", "en", "s") for i in range(12)]
    docs = table(spark, rows)
    places = sorted({(i is None, i or 0, n, line) for i, t, *_ in rows for n, line in enumerate((t or "").split("\n"))
                     if words(line)})
    first, removed = {}, set()
    for place in places:
        own = set(words(place[3]))
        if place[3] in first or any(9 * len(own & o) >= 4 * (len(own) + len(o)) for o in first.values()):
            removed.add(place)
        first.setdefault(place[3], own)
    # rows without doc_id are one document, as are the rows of doc 70: a place counts for each of its rows
    every = Counter((i is None, i or 0, n, line) for i, t, *_ in rows for n, line in enumerate((t or "").split("\n")) if words(line))
    for hot in (32, 1):
        got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.line_matches(docs, hot).collect()}
        assert set(got) == {r[0] for r in rows}
        for doc_id, (n, gone) in got.items():
            mine = {p: c for p, c in every.items() if (None if p[0] else p[1]) == doc_id}
            assert (n, gone) == (sum(mine.values()), sum(c for p, c in mine.items() if p in removed)), doc_id
    clean = line_dedup.without_repeats(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    for doc_id, text, *_ in rows:
        if doc_id not in (None, 70) and text is not None:
            kept = [line for n, line in enumerate(text.split("\n")) if (False, doc_id, n, line) not in removed]
            assert texts[doc_id] == "\n".join(kept)
    assert line_dedup.line_matches(table(spark, [])).count() == 0


def test_lines_of_frequent_tokens(spark, monkeypatch):
    """Keys of frequent tokens hold few lines, and pairs, single tokens and both find the same lines."""
    draw = random.Random(4)
    rows = []
    for i in range(60):
        line = draw.sample([f"w{k}" for k in range(30)], draw.randrange(1, 15))
        near = [w for w in line if draw.random() < 0.93] + [f"w{draw.randrange(30)}"]
        rows.append((i, " ".join(line) + "\n\t" + "\x0b".join(near) + " \f", "en", "s"))
    docs = table(spark, rows)
    places = [(i, n, set(words(line)), line) for i, text, *_ in rows for n, line in enumerate(text.split("\n"))]
    removed = Counter(i for i, n, own, line in places if any(
        (j, m) < (i, n) and (line == text or 9 * len(own & o) >= 4 * (len(own) + len(o))) for j, m, o, text in places))
    sizes = {}
    for paired, long in ((0, 320), (0, 9), (9, 320)):
        monkeypatch.setattr(line_dedup, "PAIRED", paired)
        monkeypatch.setattr(line_dedup, "LONG", long)
        for hot in (512, 2):
            got = {r.doc_id: r.n_removed for r in line_dedup.line_matches(docs, hot).collect()}
            assert got == {i: removed[i] for i in range(60)}, (paired, long, hot)
        keys = line_dedup._postings(line_dedup._prefixed(docs, line_dedup.rarity(docs)).where("n > 5")).groupBy("key").count()
        sizes[paired, long] = keys.agg(F.max("count")).first()[0]
    assert 2 * sizes[0, 320] < sizes[9, 320]


def test_tool_calls(spark):
    call = "conv_id bigint, turn bigint, call_id string, name string, arguments string, after array<string>, level int, position int"
    calls = [
        (1, 3, "c", "search", '{"query": "x", "limit": 3}', ["b", "a"]), (1, 1, "a", "search", '{"limit": 1.5, "query": 7}', []),
        (1, 2, "b", "lookup", '{"b": {"z": 1, "a": [2, 1]}, "query": "é\\n"}', ["a", "gone"]), (1, 9, None, "search", "no json", []),
        (2, 1, "a", "search", "[1]", ["z"]), (2, 2, "z", "chat", "{}", ["a"]), (2, 3, "w", "lookup", None, ["z"]),
        (2, 4, "free", "lookup", '{"query": null, "exact": true}', None), (None, 1, "a", "lookup", '{"query": "q"}', []),
        (3, 1, "d", "lookup", '{"query": "q"}', []), (3, 2, "d", "lookup", '{"query": "q"}', []),
    ]
    results = [(1, 4, "a", "late"), (1, 2, "a", "early"), (1, 5, "b", None), (9, 1, "c", "other"), (None, 2, "a", "r"), (1, 1, None, "x")]
    got = tool_calls.linked_calls(
        spark.createDataFrame([(*c, 1, 2) for c in calls], call),
        spark.createDataFrame(results, "conv_id bigint, turn bigint, call_id string, content string"), tool_calls.TOOLS).collect()
    lone = {(r.conv_id, r.call_id, r.name, r.turn, r.level, r.position, r.errors, r.canonical) for r in got if r.status == "unmatched"}
    assert lone == {(9, "c", None, 1, None, None, "", '{"arguments":null,"id":"c","name":null,"result":"other"}'),
                    (1, None, None, 1, None, None, "", '{"arguments":null,"id":null,"name":null,"result":"x"}')}
    got = [r for r in got if r.status != "unmatched"]
    by = {(r.conv_id, r.call_id): r for r in got if (r.conv_id, r.call_id) != (3, "d")}
    assert len(got) == len(calls)
    assert [by[1, c].level for c in "abc"] == [0, 1, 2] and [by[1, c].position for c in ("a", "b", "c", None)] == [0, 1, 2, 3]
    assert [by[2, c].level for c in ("a", "z", "w", "free")] == [None, None, None, 0] and by[2, "free"].position == 0
    assert [by[1, c].status for c in ("a", "b", "c", None)] == ["repeated", "linked", "unanswered", "ambiguous"]
    assert by[None, "a"].status == "linked" and [r.status for r in got if r.conv_id == 3] == ["ambiguous"] * 2
    assert by[1, "a"].errors == "limit is not integer; query is not string" and by[1, "c"].errors == ""
    assert by[1, "b"].errors == "unexpected b" and by[2, "z"].errors == "unknown tool"
    assert by[2, "a"].errors == by[2, "w"].errors == by[1, None].errors == "arguments are not a JSON object"
    assert by[2, "free"].errors == "query is not string"
    assert by[1, "b"].canonical == '{"arguments":{"b":{"a":[2,1],"z":1},"query":"é\\n"},"id":"b","name":"lookup","result":null}'
    assert json.loads(by[1, "a"].canonical)["result"] == "early"
    none = spark.createDataFrame([], call), spark.createDataFrame([], "conv_id bigint, turn bigint, call_id string, content string")
    assert tool_calls.linked_calls(*none, tool_calls.TOOLS).count() == 0


def test_levels_of_deep_chains(spark):
    draw = random.Random(5)
    waits = {f"a{i}": [f"a{i - 1}"] if i else [] for i in range(200)}
    waits |= {"loop1": ["loop3"], "loop2": ["loop1"], "loop3": ["loop2"], "after": ["loop2"], "both": ["loop2", "a3"], "own": ["own"]}
    waits |= {f"m{i}": [f"a{draw.randrange(200)}" for _ in range(3)] + ([f"n{i - 1}"] if i else []) for i in range(4)}
    waits |= {f"n{i}": [f"m{i}", "gone"] for i in range(4)} | {"last": ["n3"], "later": ["last", "both"]}

    known: dict[str, int] = {}
    while True:
        new = {c: 1 + max((known[w] for w in ws if w in waits), default=-1) for c, ws in waits.items()
               if c not in known and all(w in known or w not in waits for w in ws)}
        if not new:
            break
        known |= new
    rows = [(conv, c, w) for conv in ("x", "y") for c, w in waits.items()]
    got = tool_calls.levels(spark.createDataFrame(rows, "conv string, call_id string, after array<string>")).collect()
    assert sorted((r.conv, r.call_id, r.level) for r in got) == sorted((c, i, n) for c in ("x", "y") for i, n in known.items())


def test_long_tool_results_and_calls_without_results(spark):
    text = prose(20_000, 3)
    calls = spark.createDataFrame([(1, 1, "a", "search", json.dumps({"query": text, "limit": 1}), [])] * 1,
                                  "conv_id bigint, turn bigint, call_id string, name string, arguments string, after array<string>")
    results = spark.createDataFrame([(1, 2, "a", text), (1, 2, "b", text), (1, 2, "b", text)],
                                    "conv_id bigint, turn bigint, call_id string, content string")
    got = tool_calls.linked_calls(calls, results, tool_calls.TOOLS).collect()
    assert sorted(r.status for r in got) == ["linked", "unmatched", "unmatched"]
    assert all(json.loads(r.canonical)["result"] == text for r in got)
    lone = tool_calls.linked_calls(calls.limit(0), results, tool_calls.TOOLS).collect()
    assert [r.status for r in lone] == ["unmatched"] * 3


def test_tool_calls_in_messages(spark):
    text = 'Let me see. <tool_call>{"id": "1", "name": "search", "arguments": {"query": "a", "limit": 2}}</tool_call>' \
           '<tool_call>{"id": "2", "name": "lookup", "after": ["1"], "arguments": {"query": "b"}}</tool_call><tool_call>{</tool_call>'
    rows = [(1, 1, "assistant", text), (1, 2, "tool", '<tool_result>{"id": "2", "content": "x"}</tool_result>'),
            (1, 3, "assistant", None), (1, 4, "user", "<tool_call>{}</tool_call>")]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = tool_calls.linked_calls(*tool_calls.extracted(messages), tool_calls.TOOLS).orderBy("position").collect()
    assert [(r.call_id, r.level, r.status, r.errors) for r in got] == [
        ("1", 0, "unanswered", ""), ("2", 1, "linked", ""), (None, None, "ambiguous", "arguments are not a JSON object")]


def test_permutation():
    for n in (1, 2, 3, 5, 17, 1000, 4097):
        order = training_order.Permutation(n, 7)
        slots = order.slots(np.arange(n))
        assert sorted(slots) == list(range(n)) and (order.numbers(slots) == np.arange(n)).all()
    assert (training_order.Permutation(1000, 1).slots(np.arange(1000)) != training_order.Permutation(1000, 2).slots(np.arange(1000))).any()


def test_training_order(spark, tmp_path):
    rows, path = documents(), public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs, length = table(spark, rows), 32
    target = str(tmp_path / "order")
    training_order.write_training_order(docs, target, path, public_tokenizers.PATTERN, 5, length, 64)
    got = training_order.read_training_order(spark, target).collect()
    encoder = training_order.codec(path, public_tokenizers.PATTERN).split
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = [*encoder.encode_ordinary(text or ""), 50256]
        wanted.update((doc_id, i // length, tuple(ids[i:i + length])) for i in range(0, len(ids), length))
    assert wanted == Counter((r.doc_id, r.seq_no, tuple(r.tokens)) for r in got)
    assert sorted(r.slot for r in got) == list(range(len(got)))
    stride = training_order.HEADER.itemsize + 2 * length
    assert all((r.shard, r.offset) == (r.slot // 64, r.slot % 64 * stride) for r in got)
    part = training_order.read_training_order(spark, target, 100, 170).collect()
    assert sorted(map(str, part)) == sorted(str(r) for r in got if 100 <= r.slot < 170)
    again = str(tmp_path / "again")
    training_order.write_training_order(docs.repartition(9), again, path, public_tokenizers.PATTERN, 5, length, 64)
    assert sorted(map(str, training_order.read_training_order(spark, again).collect())) == sorted(map(str, got))
    none = str(tmp_path / "none")
    training_order.write_training_order(table(spark, []), none, path, public_tokenizers.PATTERN, 5)
    assert training_order.read_training_order(spark, none).count() == 0


def test_pipeline(spark, tmp_path):
    benchmark = [(1, prose(30, 4000)), (2, prose(40, 4001))]
    rows = [r for r in documents() if r[0] != 60] + [(900, prose(40, 1) + benchmark[0][1] + " " + prose(30, 2), "en", "s1")]
    docs = table(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id for r in quality.quality_rules(now).where("kept").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name.replace(" ", "-")))
        now = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
        seen.append([r.doc_id for r in now.select("doc_id").collect()])
        if name != "sharding":
            assert now.columns == docs.columns
    passed = [r for r in rows if r[0] in kept]
    assert set(seen[0]) == kept and {50, 51, 52, 54} & kept == set()
    values = sorted({plain_fingerprint(r[1]) for r in passed})
    root = plain_components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(seen[1], key=str) == sorted({min((r[0] for r in passed if root[plain_fingerprint(r[1])] == g and r[0] is not None),
                                                   default=None) for g in set(root.values())}, key=str)
    assert set(seen[1]) - set(seen[2]) == {900} & set(seen[1])
    assert set(seen[3]) <= set(seen[2]) and max(Counter(seen[3]).values()) <= 2 and len(seen[4]) == len(seen[3])
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, result.collect())) == sorted(map(str, now.collect()))
