import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexspark import flows
from lexspark.functions import trees
from lexspark.operators import corpus, ranking, runs, vocabulary
from lexspark.plans.order import with_position
from lexspark.plans.sizing import Lookup


def ancestors_of(heads, i):
    out = []
    while heads[i] != i:
        i = heads[i]
        out.append(i)
    return out


def tree(rng, n):
    """A random tree with a random numbering."""
    names = list(range(n))
    rng.shuffle(names)
    heads = [0] * n
    for k, name in enumerate(names):
        heads[name] = name if k == 0 else names[rng.randrange(k)]
    return heads


def test_trees_against_brute_force(spark):
    rng = random.Random(1)
    cases = [[1, 1, 1, 2, 3, 3], [3, 3, 3, 3], [0]] + [tree(rng, rng.randint(1, 60)) for _ in range(60)]
    cases.append([max(0, i - 1) for i in range(3000)])
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, heads array<int>")
    h = F.col("heads")
    got = rows.select(
        "id", trees.ancestor_counts(h).alias("anc"), trees.children_counts(h).alias("ch"),
        trees.leftmost_ancestors(h).alias("left"), trees.rightmost_children(h).alias("right"),
        corpus.simplicity_per_token(h).alias("simp"), corpus.coverage_per_token(h).alias("cov"),
    ).orderBy("id").collect()
    for heads, row in zip(cases, got, strict=True):
        n = len(heads)
        anc = [ancestors_of(heads, i) for i in range(n)]
        ch = [[j for j in range(n) if heads[j] == i and j != i] for i in range(n)] if n < 100 else None
        assert row["anc"] == [len(a) for a in anc]
        assert row["left"] == [min(a) if a else i for i, a in enumerate(anc)]
        if ch is None:
            continue
        assert row["ch"] == [len(c) for c in ch]
        right = [max([i, *c]) for i, c in enumerate(ch)]
        assert row["right"] == right
        assert row["simp"] == [(len(a) + len(c) + 1) / n for a, c in zip(anc, ch, strict=True)]
        assert row["cov"] == [
            (r - (min(a) if a else i)) / n for i, (a, r) in enumerate(zip(anc, right, strict=True))
        ]


def test_hand_checked_scores(spark):
    h = F.col("heads")
    row = spark.createDataFrame([([1, 1, 1, 2, 3, 3],)], "heads array<int>").select(
        corpus.simplicity_per_token(h)[3], corpus.coverage_per_token(h)[3], corpus.coverage_per_token(h)[1]
    ).first()
    assert tuple(row) == (5 / 6, 4 / 6, 1 / 6)
    negative = spark.createDataFrame([([3, 3, 3, 3],)], "heads array<int>").select(
        corpus.coverage_per_token(h)[0]
    ).first()[0]
    assert negative == -3 / 4


@pytest.mark.parametrize(
    ("words", "heads"),
    [
        (["we", "saw", ",", "birds", "."], [0, 0, 3, 1, 3]),
        (["the", "of"], [0, 0]),
        (["the", "dog", "of"], [1, 1, 1]),
        (["."], [0]),
    ],
)
def test_chain_heads(spark, words, heads):
    df = spark.createDataFrame([(words,)], "words array<string>")
    assert df.select(trees.chain_heads(F.col("words"), ["the", "of"])).first()[0] == heads


def articles(spark, texts):
    return spark.createDataFrame(
        [(i, f"t{i}", t) for i, t in enumerate(texts)], "doc_id bigint, title string, article string"
    )


def test_sentences_and_tokens(spark):
    sents = corpus.sentences(articles(spark, ["Is it? Yes, 3.5!  Done.", "  "])).orderBy("sent_id").collect()
    assert [r["sentence"] for r in sents] == ["Is it?", "Yes, 3.5!", "Done."]
    assert sents[1]["tokens"] == ["Yes", ",", "3", ".", "5", "!"]
    assert sents[1]["words"][0] == "yes"


TEXTS = [
    "The bank closed. A bank by a river is a bank. Rivers run. Bank!",
    "Bank notes. The bank closed. Big bank, big river, big town, big sky.",
    "Bank! Bank! The bank closed.",
]


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_examples_against_brute_force(spark, k, parts):
    sents = corpus.with_chain_heads(
        corpus.sentences(articles(spark, TEXTS).repartition(parts)), ["the", "a", "by", "is"]
    )
    words = spark.createDataFrame([("bank",), ("river",)], "word string")
    all_rows = corpus.scored_tokens(sents, ["title", "sentence"]).where("word IN ('bank', 'river')").collect()
    got = flows.best_sentences(sents, Lookup(words), k).collect()
    for word in ("bank", "river"):
        mine = sorted((r for r in got if r["word"] == word), key=lambda r: r["rank"])
        rows = [r for r in all_rows if r["word"] == word]
        rows.sort(key=lambda r: (r["doc_id"], r["sent_id"], r["tok_id"]))
        rows.sort(key=lambda r: (r["score"], r["sentence"], r["title"]), reverse=True)
        keys = ("score", "sentence", "title", "doc_id", "sent_id", "tok_id")
        assert [tuple(r[c] for c in keys) for r in mine] == [tuple(r[c] for c in keys) for r in rows[:k]]
        assert all(r["suitability"] == 1000 * r["score"] for r in mine)
    # a word twice in a sentence is two occurrences
    if k == 50:
        assert sum(r["sentence"].startswith("A bank by") and r["word"] == "bank" for r in got) == 2


def test_hot_word_and_large_lookup(spark):
    # a third of all rows are copies of one word with equal scores
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("sent_id"), F.lit(0).alias("tok_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("word"),
        F.lit("t").alias("title"), F.lit("same").alias("sentence"), F.lit(0.5).alias("score"),
    ).repartition(6)
    words = rows.select("word").distinct()
    small = ranking.top_examples(rows, rows, Lookup(words), 5).select("word", "doc_id", "rank")
    large = ranking.top_examples(rows, rows, Lookup(words, limit=0, salts=4), 5).select("word", "doc_id", "rank")
    want = sorted(map(tuple, small.collect()))
    assert want == sorted(map(tuple, large.collect()))
    assert [w[1] for w in want if w[0] == "hot"] == [0, 3, 6, 9, 12]


def test_large_lookups_are_not_broadcast(spark):
    # the stored table is small to the planner, but not its repeats in memory
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("key"))
    far = Lookup(spark.createDataFrame([(1, "a"), (3, "b")], "key bigint, name string"), limit=0).join(rows, "key")
    assert "Broadcast" not in far._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 3, 50])
def test_ranking_with_a_large_vocabulary(spark, k):
    sents = corpus.with_chain_heads(corpus.sentences(articles(spark, [*TEXTS, "No such. No."])), ["the", "a", "by", "is"])
    narrow, wide = corpus.scored_tokens(sents), corpus.scored_tokens(sents, ["title", "sentence"])
    odd = spark.createDataFrame([(9, 0, 0, "t", "s", "bank", None), (9, 1, 0, "t", "s", "odd", None), (9, 2, 0, None, None, None, 1.0)],
                                "doc_id bigint, sent_id int, tok_id int, title string, sentence string, word string, score double")
    narrow, wide = narrow.unionByName(odd.select(*narrow.columns)), wide.unionByName(odd.select(*wide.columns))
    words = Lookup(spark.createDataFrame([("bank",), ("river",), ("big",), ("odd",), (None,)], "word string"))
    near = ranking.top_examples(narrow, wide, words, k)
    far = ranking.top_examples(narrow, wide, words, k, limit=0)
    assert far.columns == near.columns
    assert sorted(map(str, far.collect())) == sorted(map(str, near.collect()))


def test_large_k_is_limited_before_the_shuffle(spark):
    rows = spark.range(10000).select(
        (F.col("id") % 3).alias("word"), F.col("id").cast("double").alias("score")
    )
    best = ranking.top_k(rows, ["word"], [F.desc("score")], 3000)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert best.count() == 9000


def test_lookup_joins_agree(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("key"))
    table = spark.createDataFrame([(1, "a"), (3, "b")], "key bigint, name string")
    for how in ("inner", "left_semi", "left"):
        near = Lookup(table).join(rows, "key", how)
        far = Lookup(table, limit=0, salts=3).join(rows, "key", how)
        assert near.columns == far.columns
        assert near.exceptAll(far).isEmpty()
        assert far.exceptAll(near).isEmpty()


def test_vocabulary(spark):
    tokens = spark.createDataFrame([(w,) for w in ["a"] * 5 + ["b"] * 4 + ["c"] * 6 + ["1"] * 9], "word string")
    found = vocabulary.effective_vocabulary(
        vocabulary.frequent_words(tokens, 5), spark.createDataFrame([("c",)], "word string")
    )
    assert [r[0] for r in found.collect()] == ["a"]


def test_letters_are_looked_for_in_counted_words(spark):
    tokens = spark.createDataFrame([("a",), ("1",)], "word string")
    plan = vocabulary.frequent_words(tokens, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("Aggregate")


def test_sentences_with_words(spark):
    sents = corpus.with_chain_heads(corpus.sentences(articles(spark, TEXTS)), ["the", "a", "by", "is"])
    words = Lookup(spark.createDataFrame([("river",), ("sky",)], "word string"))
    few = corpus.with_words(sents, ["river", "sky"])
    assert 0 < few.count() < sents.count()
    assert sorted(map(str, flows.best_sentences(few, words, 3).collect())) == sorted(
        map(str, flows.best_sentences(sents, words, 3).collect()))


def test_requested_sentences_are_split_once(spark, tmp_path):
    from checks.tables import Tables

    spark.createDataFrame([("d", "s", "With that. No. For it."), (None, None, None)], "doc_id string, source string, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = Tables(spark, str(tmp_path)).requested_inputs()
    assert sorted((r.word, r.sentence) for r in rows.collect()) == [("for", "For it."), ("that", "With that."), ("with", "With that.")]
    assert "documents.parquet" not in rows._jdf.queryExecution().executedPlan().toString()


def test_example_rows_keep_top_titles(spark):
    weights = spark.createDataFrame([("t0", 5), ("t1", 9), ("t2", 1)], "title string, pageviews bigint")
    got = flows.example_rows(
        articles(spark, TEXTS), spark.createDataFrame([("bank",), ("the",)], "word string"),
        spark.createDataFrame([("the",)], "word string"), ["the"], weights, 10, 2,
    ).collect()
    assert {r["title"] for r in got} == {"t0", "t1"}
    assert {r["word"] for r in got} == {"bank"}


def test_parser_hook(spark):
    sents = corpus.with_parser(
        corpus.sentences(articles(spark, ["One two three."])),
        lambda tokens: pd.Series([[0] * len(t) for t in tokens]),
    )
    row = corpus.scored_tokens(sents).orderBy("tok_id").collect()
    assert [r["score"] for r in row] == [1.0, 0.5, 0.5, 0.5]


def test_runs_and_partition(spark):
    labels = "aabaccca"
    for parts in (1, 5):
        rows = spark.createDataFrame(
            [(i, c) for i, c in enumerate(labels)], "at bigint, label string"
        ).repartition(parts)
        got = [r["run"] for r in runs.label_runs(rows, "at", "label").orderBy("at").collect()]
        assert got == [0, 0, 1, 2, 3, 3, 3, 4]
        part = [r["part"] for r in runs.label_partition(rows, "at", "label").orderBy("at").collect()]
        assert part == [0, 0, 1, 1, 1, 1, 1, 1]
    one = spark.createDataFrame([(1, "x"), (2, "x")], "at bigint, label string")
    assert {r["part"] for r in runs.label_partition(one, "at", "label").collect()} == {0}


def test_positions(spark):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("v")).repartition(5)
    got = with_position(rows, [F.desc("v")], "at", start=3).collect()
    assert all(r["at"] == 499 - r["v"] + 3 for r in got)


def test_batch_measures_equal_the_expressions(spark, monkeypatch):
    rng = random.Random(4)
    cases = [[1, 1, 1, 2, 3, 3], [0], [], None] + [tree(rng, rng.randint(1, 60)) for _ in range(40)]
    rows = [(i, 0, "t", None if c is None else [f"w{k}" for k in range(len(c))], c) for i, c in enumerate(cases)]
    sents = spark.createDataFrame(rows, "doc_id bigint, sent_id int, title string, words array<string>, heads array<int>")
    h = F.col("heads")
    arrays = sents.where("size(heads) > 0").select("doc_id", "words", trees.ancestor_counts(h).alias("a"), trees.children_counts(h).alias("c"),
                          corpus.simplicity_per_token(h).alias("s"), corpus.coverage_per_token(h).alias("v")).collect()
    wanted = {(r.doc_id, i): (r.words[i], r.a[i], r.c[i], r.s[i], r.v[i]) for r in arrays for i in range(len(r.words or []))}
    for size in (1 << 17, 10):
        monkeypatch.setattr(corpus, "TOKENS_PER_PART", size)
        got = corpus.measured_tokens(sents, ["ancestors", "children", "simplicity", "coverage"], ["title"]).collect()
        assert {(r.doc_id, r.tok_id): (r.word, r.ancestors, r.children, r.simplicity, r.coverage) for r in got} == wanted
        assert len(got) == len(wanted) and all(r.title == "t" for r in got)


def test_a_very_long_sentence(spark):
    n = 100_000
    heads = [max(0, i - 1) for i in range(n)]
    sents = spark.createDataFrame([(1, 0, ["w"] * n, heads)], "doc_id bigint, sent_id int, words array<string>, heads array<int>")
    got = corpus.measured_tokens(sents, ["ancestors", "children", "coverage"]).orderBy("tok_id").collect()
    assert [r.ancestors for r in got] == list(range(n))
    assert all(r.children == (1 if i < n - 1 else 0) for i, r in enumerate(got)) and got[5].coverage == 6 / n
