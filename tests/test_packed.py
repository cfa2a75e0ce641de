"""Work done on packed sentences: ranking without a text per token."""

import pytest
from pyspark.sql import functions as F

from lexspark import flows
from lexspark.operators import corpus, ranking, sequences, vectors, vocabulary
from lexspark.plans.sizing import Lookup, spread

STOP = ["the", "a"]
TEXTS = [
    "The bank closed. A bank by a river is a bank. İstanbul İİ. Rivers run. Bank!",
    "Big bank, big river. ΣΟΦΟΣ bank\x0bbank. The bank closed.", None, "", "bank " * 50 + "river",
]


def parsed(spark, copies=2):
    rows = [(i if i else None, None if i == 1 else f"t{i % 2}", t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows * copies, "doc_id bigint, title string, article string").repartition(3)
    return corpus.with_chain_heads(corpus.sentences(docs), STOP)


def as_rows(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("k", [1, 4, 200])
@pytest.mark.parametrize("limit", [0, ranking.VOCABULARY_BYTES])
def test_packed_ranking_equals_ranking_of_rows(spark, k, limit):
    sents = parsed(spark)
    words = Lookup(spark.createDataFrame([("bank",), ("river",), ("big",), ("i̇stanbul",), (None,)], "word string"))
    want = ranking.top_examples(corpus.scored_tokens(sents), corpus.scored_tokens(sents, ["title", "sentence"]), words, k)
    got = ranking.top_sentences(sents, words, k, limit=limit, part_bytes=40)
    assert got.columns == want.columns
    # copies of a sentence can't be told apart, but have ranks of their own
    assert as_rows(got) == as_rows(want)


def test_given_words_and_trees_are_kept(spark):
    sents = spark.createDataFrame(
        [(1, 0, "t", "One two", ["x", None, "one"], [0, 0, 1]), (2, 0, "t", None, ["x"], [0]), (3, 0, "t", "no", ["x"], None),
         (4, 0, "t", "none", [], []), (5, 0, None, "x", ["x", "x"], [1, 1])],
        "doc_id int, sent_id int, title string, sentence string, words array<string>, heads array<int>")
    words = Lookup(spark.createDataFrame([("x",), ("one",), ("no",)], "word string"))
    got = ranking.top_sentences(sents, words, 10).select("word", "rank", "doc_id", "tok_id", "score").collect()
    assert sorted(map(tuple, got)) == [
        ("one", 1, 1, 2, 1.0), ("x", 1, 5, 0, 1.0), ("x", 2, 5, 1, 1.0), ("x", 3, 2, 0, 1.0), ("x", 4, 1, 0, 2 / 3)]


def test_no_corpus_gives_no_examples(spark):
    assert flows.best_sentences(parsed(spark).where("false"), Lookup(spark.createDataFrame([("bank",)], "word string")), 3).count() == 0


def test_no_text_is_shuffled_per_token(spark):
    best = flows.best_sentences(parsed(spark), Lookup(spark.createDataFrame([("bank",)], "word string")), 3)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    # the sentence is in no window, join or aggregation of tokens: its part is read, and tokens are its arrays
    assert "Window" not in plan and "Join" not in plan


def test_tables_of_many_files_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    assert "Exchange" not in spread(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    few = str(tmp_path / "few")
    spark.range(100).repartition(1).write.parquet(few)
    assert spread(spark.read.parquet(few)).select(F.spark_partition_id()).distinct().count() > 1


def test_ids_of_a_large_vocabulary(spark):
    rows = spark.createDataFrame(
        [("a", ["x", "y", None, "é"]), ("a", ["y"]), ("b", []), ("c", None), (None, ["x"]), (None, ["q", "q"])],
        "unique_id string, tokens array<string>").repartition(3)
    known = spark.createDataFrame([("x", 1), ("y", 2), ("é", 3), ("[UNK]", 9), (None, 4), ("z", None)], "token string, id bigint")
    twice = known.unionByName(spark.createDataFrame([("x", 7)], "token string, id bigint"))
    for vocabulary in (known, known.where("token <> '[UNK]'"), twice):
        near = sequences.token_ids(rows, "unique_id", vocabulary)
        far = sequences.token_ids(rows, "unique_id", vocabulary, limit=0)
        assert far.dtypes == near.dtypes
        assert as_rows(far) == as_rows(near)
    plan = sequences.token_ids(rows, "unique_id", known, limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


@pytest.mark.parametrize("words", [["bank", "river", "i̇stanbul", None, "bank"], []])
def test_windows_of_a_large_vocabulary(spark, words):
    sents = parsed(spark).select("doc_id", "sent_id", "words")
    table = spark.createDataFrame([(w,) for w in words], "word string")
    near = vocabulary.keep_vocabulary(vectors.context_windows(sents), table)
    far = vocabulary.keep_vocabulary_tokens(sents, Lookup(table, limit=-1), vectors.context_windows)
    same = vocabulary.keep_vocabulary_tokens(sents, table, vectors.context_windows)
    columns = sorted(near.columns)
    assert as_rows(far.select(*columns)) == as_rows(near.select(*columns)) == as_rows(same.select(*columns))
    assert "Join" not in far._jdf.queryExecution().optimizedPlan().toString()
