"""From a corpus to examples and to usage clusters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.operators import corpus, density, layout, neighbours, ranking, vectors
from lexspark.operators.tiles import TILE_ROWS
from lexspark.operators.vocabulary import effective_vocabulary
from lexspark.plans.lineage import cut_lineage
from lexspark.plans.order import with_position
from lexspark.plans.sizing import Lookup
from lexspark.sources.lines import top_titles


def example_rows(
    articles: DataFrame, vocabulary: DataFrame, stopwords: DataFrame, stop_list: Sequence[str],
    title_weights: DataFrame | None = None, k: int = ranking.OUTPUTS_PER_WORD,
    n_titles: int | None = None,
) -> DataFrame:
    """Best ``k`` sentences per vocabulary word with their suitability, best first.

    ``stop_list`` holds the stopwords the default tree skips. With ``title_weights`` only the
    ``n_titles`` most viewed titles are read (None: all that are listed).
    """
    if title_weights is not None:
        articles = corpus.keep_titles(articles, top_titles(title_weights, n_titles))
    sents = corpus.with_chain_heads(corpus.sentences(articles), stop_list)
    words = Lookup(effective_vocabulary(vocabulary, stopwords))
    return best_sentences(sents, words, k)


def best_sentences(sents: DataFrame, words: Lookup, k: int) -> DataFrame:
    """Best ``k`` occurrences per word of parsed sentences (with ``heads``)."""
    ranked = ranking.top_sentences(sents, words, k)
    return ranked.withColumn("suitability", F.col("score") * ranking.SUITABILITY_SCALE)


def pack_struct(ranked: DataFrame) -> DataFrame:
    """(word, packaged_parse): title, word, sentence and simplicity as one struct."""
    return ranked.select("word", F.struct(
        "title", "word", "sentence", F.col("score").alias("simplicity")
    ).alias("packaged_parse"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Number all occurrences of every word from 1 as ``rank``, in the order of the corpus.

    Only keys are sorted, by ranges; no task holds all occurrences of a word.
    """
    keys = ["word", *corpus.KEYS]
    placed = cut_lineage(with_position(rows.select(*keys), [F.asc(c) for c in keys], "_at"))
    firsts = Lookup(placed.groupBy("word").agg(F.min("_at").alias("_first")))
    ranks = firsts.join(placed, "word").select(*keys, (F.col("_at") - F.col("_first") + 1).alias("rank"))
    return rows.join(ranks, keys)


def occurrences_of(
    sents: DataFrame, words: Sequence[str], k: int | None = None,
    width: int = 5, encoder: Callable | None = None,
) -> DataFrame:
    """All occurrences of the requested words with vectors, or the best ``k``: the points to cluster.

    Sentences without a requested word are dropped before they are scored. ``occ_id`` numbers the points
    of a word; ``point_id`` (``word-number``) tells points of all words apart, as clustering several
    words together needs. A sentence is (doc_id, sent_id), given once.
    """
    with_word = corpus.with_words(sents, words)
    wanted = F.col("word").isin(*words)
    wide = corpus.scored_tokens(with_word, ["title", "sentence"]).where(wanted).join(
        with_word.select("doc_id", "sent_id", "words"), ["doc_id", "sent_id"])
    if k is None:
        ranked = _numbered(cut_lineage(wide))
    else:
        requested = sents.sparkSession.createDataFrame([(w,) for w in words], "word string")
        ranked = ranking.top_examples(corpus.scored_tokens(with_word).where(wanted), wide, requested, k)
    if encoder is None:
        encoded = vectors.context_vectors(vectors.context_around(ranked, width), width)
    else:
        encoded = vectors.encode(ranked.withColumn("target_pos", F.col("tok_id")), encoder)
    return encoded.select(
        "word", (F.col("rank") - 1).alias("occ_id"), "title", "sentence",
        F.col("score").alias("simplicity"), "vec", F.concat_ws("-", "word", "rank").alias("point_id"),
    )


def place_and_cluster(
    points: DataFrame, group: str = "word", key: str = "occ_id", space: str = "layout",
    k: int = neighbours.N_NEIGHBOURS, epochs: int = layout.EPOCHS, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(group, id, x, y, cluster). Clusters are found in the layout, or with ``space="vector"`` in
    the vectors themselves; then there is no layout and x and y are NULL."""
    if space == "vector":
        labels = density.usage_clusters(points, group, key, "vec", tile_rows=tile_rows)
        nothing = F.lit(None).cast("double")
        return labels.select(group, key, nothing.alias("x"), nothing.alias("y"), "cluster")
    near = cut_lineage(neighbours.knn(points, k, group, key, "vec", tile_rows))
    edges = neighbours.fuzzy_graph(near, group, key)
    placed = cut_lineage(layout.layout_2d(points.select(group, key), edges, group, key, epochs))
    labels = density.usage_clusters(
        placed.withColumn("at", F.array("x", "y")), group, key, "at", tile_rows=tile_rows
    )
    return placed.join(labels, [group, key])


def _point_key(labels: DataFrame) -> list[str]:
    return ["point_id"] if "point_id" in labels.columns else ["word", "occ_id"]


def clustered_rows(points: DataFrame, labels: DataFrame) -> DataFrame:
    """(title, word, sentence, simplicity, cluster) for every point, noise included."""
    key = _point_key(labels)
    return points.join(labels.select(*key, "cluster"), key).select(
        "title", "word", "sentence", "simplicity", "cluster"
    )


def drop_noise(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("cluster") >= 0)


def plot_points(points: DataFrame, labels: DataFrame, title: str = "word") -> DataFrame:
    """Chart rows: title, x, y, cluster as colour, sentence as hover text; noise is left out."""
    key = _point_key(labels)
    shown = points.select(*dict.fromkeys([*key, "word", "sentence"]))
    return drop_noise(labels).join(shown, key).select(F.col(title).alias("title"), "x", "y", "cluster", F.col("sentence").alias("hovertext"))


def word_usage(
    sents: DataFrame, words: Sequence[str], k: int | None = None,
    space: str = "layout", encoder: Callable | None = None,
) -> DataFrame:
    """Clustered rows of the requested words: how many distinct usages each has. All occurrences are
    clustered, or the best ``k`` of each word.

    ``encoder`` replaces the default vectors by a model's: batches of (words, target position) in,
    vectors out.
    """
    points = cut_lineage(occurrences_of(sents, words, k, encoder=encoder))
    return clustered_rows(points, place_and_cluster(points, space=space))
