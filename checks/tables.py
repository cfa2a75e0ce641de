"""The given tables as the records the library works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators import corpus, sequences, vocabulary
from lexspark.operators.ranking import OUTPUTS_PER_WORD
from lexspark.plans.lineage import cut_lineage, scratch_path
from lexspark.plans.sizing import Lookup, spread

STOP_LIST = ("the", "of", "and", "to", "in", "a", "is", "it")
MIN_COUNT = 5
TOP = OUTPUTS_PER_WORD
WORDS = ("with", "that", "for")
USAGE_WORD = "with"


class Tables:
    """Derivations from one folder of tables; each is a plan, nothing is read before it is used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return spread(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def articles(self) -> DataFrame:
        return self.table("documents").select(
            "doc_id", F.concat("source", F.lit(" "), "doc_id").alias("title"),
            F.col("text").alias("article"), "source",
        )

    def sentences(self) -> DataFrame:
        return corpus.sentences(self.articles())

    def parsed(self) -> DataFrame:
        return corpus.with_chain_heads(self.sentences(), STOP_LIST)

    def tokens(self) -> DataFrame:
        return corpus.tokens(self.sentences())

    def frequent(self) -> DataFrame:
        return vocabulary.frequent_words(self.tokens(), MIN_COUNT)

    def stopwords(self) -> DataFrame:
        return self.spark.createDataFrame([(w,) for w in STOP_LIST], "word string")

    def vocabulary(self) -> Lookup:
        return Lookup(vocabulary.effective_vocabulary(self.frequent(), self.stopwords()))

    def examples(self, k: int = TOP) -> DataFrame:
        from lexspark.flows import best_sentences

        return best_sentences(self.parsed(), self.vocabulary(), k)

    def example_inputs(self, k: int = TOP) -> DataFrame:
        return sequences.input_examples(
            self.examples(k).select("word", (F.col("rank") - 1).alias("n"), "sentence")
        )

    def requested_inputs(self) -> DataFrame:
        """All examples of the requested words, up to the default number per word."""
        from lexspark.flows import best_sentences

        words = Lookup(self.spark.createDataFrame([(w,) for w in WORDS], "word string"))
        sents = cut_lineage(corpus.with_words(self.parsed(), WORDS))
        ranked = best_sentences(sents, words, OUTPUTS_PER_WORD)
        return sequences.input_examples(
            ranked.select("word", (F.col("rank") - 1).alias("n"), "sentence")
        )

    def token_vocabulary(self) -> DataFrame:
        """Frequent words, single letters and their continuation forms, with ids."""
        words = cut_lineage(self.frequent())
        letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct()
        return cut_lineage(sequences.token_vocabulary(
            words.select(F.col("word").alias("token"))
            .unionByName(letters.select(F.col("c").alias("token")))
            .unionByName(letters.select(F.concat(F.lit("##"), "c").alias("token")))
        ))

    def pairs(self) -> DataFrame:
        """Consecutive turns of a conversation, line breaks as spaces, joined by the separator."""
        turns = self.table("conversations").select(
            "conv_id", "turn", F.regexp_replace("text", r"\n", " ").alias("text")
        )
        after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
        return turns.join(after, ["conv_id", "turn"]).select(
            F.concat_ws(":", "conv_id", "turn").alias("pair_id"),
            F.concat_ws(" ||| ", "text", "next").alias("sentence"),
        )

    def points(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("label").cast("string").alias("word"), F.col("vec_id").alias("occ_id"),
            F.concat_ws("-", "label", "vec_id").alias("sentence"),
            F.col("embedding").cast("array<double>").alias("vec"),
        )

    def plane(self) -> DataFrame:
        """Orders as points: price in thousands and day, grouped by status."""
        day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("double")
        return self.table("orders").select(
            F.col("o_orderstatus").alias("word"), F.col("o_orderkey").alias("occ_id"),
            F.array(F.col("o_totalprice") / 1000, day).alias("vec"))

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


def millionths(values: Column) -> Column:
    """A vector as text: its values as whole millionths."""
    return F.array_join(F.transform(values, lambda v: F.round(v * 1e6).cast("bigint").cast("string")), " ")
