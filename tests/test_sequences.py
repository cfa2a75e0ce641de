import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexspark.functions import sequences as S
from lexspark.functions import vectors as V
from lexspark.functions.pieces import build_trie, match
from lexspark.operators import model, sequences, vectors


def cut_one_by_one(a, b, limit):
    while a + b > limit:
        if a > b:
            a -= 1
        else:
            b -= 1
    return a, b


def test_pair_lengths_against_the_loop(spark):
    for limit in (5, 6, 13):
        rows = spark.createDataFrame([(a, b) for a in range(18) for b in range(18)], "a int, b int")
        keep = S.pair_lengths(F.col("a"), F.col("b"), limit)
        for r in rows.select("a", "b", keep[0].alias("ka"), keep[1].alias("kb")).collect():
            assert (r["ka"], r["kb"]) == cut_one_by_one(r["a"], r["b"], limit), (r, limit)


@pytest.fixture(scope="module")
def vocab(spark):
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "the", "dog", "a", "b", "un", "##aff", "##able", "##a"]
    return spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, id bigint").cache()


def test_packing(spark, vocab):
    rows = spark.createDataFrame(
        [("single", ["the", "dog"], None), ("pair", ["a"], ["b"]), ("empty", ["a"], []),
         ("long", ["the"] * 9, None), ("odd", ["zzz"], None)],
        "unique_id string, tokens_a array<string>, tokens_b array<string>",
    )
    got = {r["unique_id"]: r for r in sequences.pack(rows, vocab, 6).collect()}
    assert got["single"]["tokens"] == ["[CLS]", "the", "dog", "[SEP]"]
    assert got["single"]["input_ids"] == [2, 4, 5, 3, 0, 0]
    assert got["single"]["input_mask"] == [1, 1, 1, 1, 0, 0]
    assert got["single"]["input_type_ids"] == [0] * 6
    assert got["pair"]["tokens"] == ["[CLS]", "a", "[SEP]", "b", "[SEP]"]
    assert got["pair"]["input_type_ids"] == [0, 0, 0, 1, 1, 0]
    assert got["empty"]["tokens"] == ["[CLS]", "a", "[SEP]"]
    assert got["long"]["input_ids"] == [2, 4, 4, 4, 4, 3]
    assert got["odd"]["input_ids"][:3] == [2, 1, 3]


def test_subwords(spark, vocab):
    words = spark.createDataFrame(
        [("unaffable",), ("unaffable",), ("dog",), ("unx",), ("una",), ("aa",), ("x",)], "word string"
    )
    got = {r["word"]: r["pieces"] for r in sequences.subwords(words, vocab).collect()}
    assert got == {
        "unaffable": ["un", "##aff", "##able"], "dog": ["dog"], "unx": ["[UNK]"],
        "una": ["un", "##a"], "aa": ["a", "##a"], "x": ["[UNK]"],
    }
    short = sequences.subwords(words, vocab, max_chars=3)
    assert {r["word"]: r["pieces"] for r in short.collect()}["unaffable"] == ["[UNK]"]


def test_tokenize(spark, vocab):
    rows = spark.createDataFrame(
        [("1", "The unaffable Dog", None), ("2", "", "dog a")], "k string, a string, b string"
    )
    got = {r["k"]: (r["a"], r["b"]) for r in sequences.tokenize(rows, "k", ["a", "b"], vocab).collect()}
    assert got == {
        "1": (["the", "un", "##aff", "##able", "dog"], None), "2": ([], ["dog", "a"]),
    }


def test_token_vocabulary_and_running_ids(spark):
    tokens = spark.createDataFrame([("b",), ("a",), ("b",)], "token string")
    got = {r["token"]: r["id"] for r in sequences.token_vocabulary(tokens).collect()}
    assert got == {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "a": 4, "b": 5}
    rows = spark.createDataFrame(
        [("w1", 0, "x"), ("w1", 1, "p ||| q"), ("w2", 0, "z")], "word string, n int, sentence string"
    )
    ids = {r["unique_id"]: (r["text_a"], r["text_b"]) for r in sequences.input_examples(rows).collect()}
    assert ids == {"w1-0": ("x", None), "w1-1": ("p", "q"), "w2-0": ("z", None)}


def plain_vector(words, at, width):
    import hashlib

    sums = [0.0] * V.DIMENSIONS
    for j, w in enumerate(words):
        if j == at or abs(j - at) > width or not w.isalnum():
            continue
        h = hashlib.md5(w.encode()).hexdigest()
        sums[int(h[:4], 16) % V.DIMENSIONS] += (1 if h[4] < "8" else -1) / abs(j - at)
    norm = sum(s * s for s in sums) ** 0.5
    return [s / norm if norm else 0.0 for s in sums]


WORDS = "the cat sat on a mat , and the cat ran to the mat near a cat".split()


def test_context_vectors(spark):
    sents = spark.createDataFrame([(1, 0, WORDS), (1, 1, ["alone"])],
                                  "doc_id bigint, sent_id int, words array<string>")
    for width in (5, 40):
        rows = vectors.context_vectors(vectors.context_windows(sents, width), width).collect()
        assert len(rows) == len(WORDS) + 1
        for r in rows:
            words = WORDS if r["sent_id"] == 0 else ["alone"]
            assert r["vec"] == pytest.approx(plain_vector(words, r["tok_id"], width), abs=2e-6)


def test_batches_and_expression_agree(spark):
    sents = spark.createDataFrame([(1, 0, WORDS * 3)], "doc_id bigint, sent_id int, words array<string>")
    around = F.col("around")
    rows = vectors.context_windows(sents, 40).select(
        V.hashed(around, list(V.LAYER_WIDTHS.values())).alias("batch"),
        V.layers(around, list(V.LAYER_WIDTHS), 40)["values"].alias("expression"),
    ).collect()
    assert len(rows) == 3 * len(WORDS)
    for r in rows:
        for one, other in zip(r["batch"], r["expression"], strict=True):
            assert one == pytest.approx(other, abs=1.1e-6)


def test_layers_and_feature_records(spark):
    sents = spark.createDataFrame([(1, 0, WORDS)], "doc_id bigint, sent_id int, words array<string>")
    windows = vectors.context_windows(sents, 40)
    full = vectors.vector_layers(windows, full_output=True).where("tok_id = 8").first()["layers"]
    assert [layer["index"] for layer in full] == [-1, -2, -3, -4]
    for layer in full:
        assert layer["values"] == pytest.approx(
            plain_vector(WORDS, 8, V.LAYER_WIDTHS[layer["index"]]), abs=2e-6
        )
    first = vectors.vector_layers(windows).where("tok_id = 8").first()["layers"]
    assert [tuple(x) for x in first] == [tuple(full[0])]

    rows = spark.createDataFrame([("cat-0", "cat", "s", WORDS)],
                                 "unique_id string, word string, sentence string, tokens array<string>")
    own = vectors.feature_records(rows, None, own_word="word").first()
    assert [f["token"] for f in own["features"]] == ["cat"] * 3
    assert own["features"][0]["layers"][0]["values"] == pytest.approx(plain_vector(WORDS, 1, 5), abs=2e-6)
    some = vectors.feature_records(rows, ["mat", "ran"]).first()
    assert [f["token"] for f in some["features"]] == ["mat", "ran", "mat"]
    every = vectors.feature_records(rows, None, full_output=True).first()
    assert len(every["features"]) == len(WORDS)
    assert len(every["features"][0]["layers"]) == 4
    targets = vectors.target_tokens(rows, "unique_id", ["mat"]).collect()
    assert sorted(r["pos"] for r in targets) == [5, 13]


def test_encoder_hook(spark):
    rows = spark.createDataFrame([(["a", "b"], i % 2) for i in range(20)],
                                 "words array<string>, target_pos int")
    sizes = []

    def encoder(words, at):
        sizes.append(len(words))
        assert len(words) <= 8
        return pd.Series([[float(p), 0.12345678] for p in at])

    got = vectors.encode(rows, encoder).collect()
    assert len(got) == 20
    assert all(r["vec"] == [float(r["target_pos"]), 0.123457] for r in got)


def longest_pieces(word, whole, rest):
    out, at = [], 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (rest if at else whole)), None)
        if end is None:
            return None
        out.append((at, end))
        at = end
    return out or None


def test_trie_against_trying_all_ends():
    draw = random.Random(1)

    def some(n):
        return ["".join(draw.choice("abc\u00e9\U0001f600") for _ in range(draw.randrange(1, 5))) for _ in range(n)]

    for n in (0, 1, 3, 20, 60):
        for _ in range(20):
            whole, rest, words = some(n), some(n), [*some(30), "", "abcabcabca"]
            assert match(words, build_trie(whole, rest)) == [longest_pieces(w, set(whole), set(rest)) for w in words]


def test_subwords_beyond_the_broadcast_limit(spark):
    draw = random.Random(2)
    tokens = {"".join(draw.choice("abc") for _ in range(draw.randrange(1, 4))) for _ in range(30)}
    vocabulary = spark.createDataFrame(
        [(t, i) for i, t in enumerate(["[UNK]", *tokens, *("##" + t for t in list(tokens)[:20])])], "token string, id bigint")
    words = spark.createDataFrame([("".join(draw.choice("abcd") for _ in range(draw.randrange(1, 9))),) for _ in range(80)], "word string")
    broadcast, joined = (
        {(r["word"], tuple(r["pieces"])) for r in sequences.subwords(words, vocabulary, 7, limit).collect()} for limit in (1 << 20, 0))
    assert broadcast == joined and any(p != ("[UNK]",) for _, p in joined)


def ids_and_places(batches):
    for batch in batches:
        places = np.broadcast_to(np.arange(batch.input_ids.shape[1]), batch.input_ids.shape)
        layer = np.stack([batch.input_ids, places, batch.input_mask, batch.input_type_ids], axis=2) + 0.1234567
        yield np.stack([layer, layer * 2], axis=1)


def test_model_features(spark):
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "the", "dog", "un", "##do"]
    vocabulary = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, id bigint")
    examples = [("dog", "dog-0", "the Dog the dog", None), ("undo", "undo-0", "undo the dog", None),
                ("dog", "dog-1", "the " * 9 + "dog", None), ("dog", "dog-2", "the", "dog")]
    inputs = spark.createDataFrame([(*e, e[2]) for e in examples], "word string, unique_id string, text_a string, text_b string, sentence string")
    packed = model.packed_examples(inputs, vocabulary, max_len=8)
    got = {r["linex_index"]: [(f["token"], [(x["index"], x["values"]) for x in f["layers"]]) for f in r["features"]]
           for r in model.model_features(packed, ids_and_places, own_word="word", batch_size=3).collect()}
    plus = [0.123457] * 4
    assert got["dog-0"] == [("dog", [(-1, [round(a + b, 6) for a, b in zip((5, i, 1, 0), plus)])]) for i in (2, 4)]
    # split into pieces, cut off, in the second segment
    assert got["undo-0"] == [] and got["dog-1"] == []
    assert got["dog-2"] == [("dog", [(-1, [round(a + b, 6) for a, b in zip((5, 3, 1, 1), plus)])])]
    chosen = {r["linex_index"]: [f["token"] for f in r["features"]]
              for r in model.model_features(packed, ids_and_places, ["the", "##do"]).collect()}
    assert chosen == {"dog-0": ["the", "the"], "undo-0": ["##do", "the"], "dog-1": ["the"] * 6, "dog-2": ["the"]}
    whole = model.model_features(packed, ids_and_places, full_output=True, indexes=(-1, -2)).where("linex_index = 'dog-2'").first()
    assert [f["token"] for f in whole["features"]] == ["[CLS]", "the", "[SEP]", "dog", "[SEP]"]
    assert [x["index"] for x in whole["features"][0]["layers"]] == [-1, -2]


def test_vectors_and_their_text_take_one_pass_of_python(spark):
    """Vectors are written out where they are built: they do not return to the JVM in between."""
    sents = spark.createDataFrame([(1, 0, WORDS), (1, 1, ["alone"])],
                                  "doc_id bigint, sent_id int, words array<string>")
    built = vectors.context_vectors(vectors.context_windows(sents))
    written = built.select("sent_id", "tok_id", V.sparse_text(F.col("vec"), 1e6).alias("vec"))
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    got = {(r.sent_id, r.tok_id): r.vec for r in written.collect()}
    for r in built.collect():
        assert got[r.sent_id, r.tok_id] == " ".join(f"{i}:{round(v * 1e6)}" for i, v in enumerate(r.vec) if v)
    assert got[1, 0] == ""
