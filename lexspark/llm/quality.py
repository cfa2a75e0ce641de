"""Quality rules: word counts, repetition, and language-specific perplexity bands."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm import perplexity as ppl
from lexspark.llm.words import SPACES
from lexspark.plans.lineage import cut_lineage
from lexspark.plans.sizing import Lookup

SIGNS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LOWER_WIDTH = 5.0
UPPER_WIDTH = 15.0
LEAST_QUARTILE = 0.02

SCHEMA = ("doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, "
          "n_dup_lines bigint, n_repeat_words bigint, perplexity double")


def contained(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each value is among the ``ordered`` ones."""
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def repeated_words(words: list) -> int:
    """Words inside a three-word window that occurs twice or more in the text."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 21:  # three numbers would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    inorder = np.sort(windows)
    again = inorder[1:][inorder[1:] == inorder[:-1]]
    if not len(again):
        return 0
    hit = contained(windows, again)
    marked = np.zeros(len(words), bool)
    for i in range(3):
        marked[i:len(words) - 2 + i] |= hit
    return int(marked.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def _kinds() -> np.ndarray:
    """Of each code point: 1 white space, 2 sign."""
    table = np.zeros(0x110000, np.uint8)
    table[[ord(c) for c in SPACES]] = 1
    table[[ord(c) for c in SIGNS]] = 2
    return table


def measures(texts: list[str], kinds: np.ndarray) -> list[list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text.

    Words are hashed for all texts at once. Texts in which no two windows have the same hash have
    no repeated window; in the others the windows themselves are compared.
    """
    if not texts:
        return [[] for _ in range(5)]
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "replace"), np.uint32)
    kind = kinds[codes]
    space = kind == 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, ends - sizes - 1, dtype=np.int64)

    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(space & np.r_[False, ~space[:-1]])
    n_words = per_text(first)
    owner = np.repeat(np.arange(len(texts)), n_words)
    chars = sizes - per_text(space) + 1
    signs = per_text(kind == 2)

    power = np.empty(len(codes), np.uint64)
    power[0], power[1:] = 1, 0x9E3779B97F4A7C15
    np.cumprod(power, out=power)
    total = np.r_[np.uint64(0), np.cumsum((codes + np.uint32(1)) * power)]
    hashed = (total[stops] - total[starts]) * power[len(power) - 1 - starts]
    suspects = set()
    if len(hashed) > 3:
        window = (hashed[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[1:-1]) * np.uint64(
            0x165667B19E3779F9) + hashed[2:] + owner[:-2].astype(np.uint64) * np.uint64(0x27D4EB2F165667C5)
        window, mine = window[owner[:-2] == owner[2:]], owner[:-2][owner[:-2] == owner[2:]]
        ordered = np.sort(window)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(again):
            suspects = set(mine[contained(window, again)].tolist())
    repeats = [repeated_words(t.encode("utf-8", "replace").split()) if i in suspects else 0
               for i, t in enumerate(texts)]
    return [n_words.tolist(), chars.tolist(), signs.tolist(), [duplicate_lines(t) for t in texts], repeats]


def _measured(model: Broadcast | None):
    """SCHEMA of rows (doc_id, lang, text); further columns are handed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, kinds = model.value if model else ppl.Scorer({}), _kinds()
        for batch in ppl.pieces(batches):
            ids, langs, texts = (c.to_pylist() for c in batch.columns[:3])
            texts = [t or "" for t in texts]
            scores: list = [None] * len(texts)
            for lang in set(langs):
                if lang not in scorer.orders:
                    continue
                own = [i for i, at in enumerate(langs) if at == lang]
                for i, p in zip(own, scorer.perplexities(lang, [texts[i] for i in own]), strict=True):
                    scores[i] = p
            counted: list[list[int]] = [[] for _ in range(5)]
            for a, b in ppl.chunks(texts):
                for column, part in zip(counted, measures(texts[a:b], kinds), strict=True):
                    column += part
            columns = [ids, langs, *counted, scores]
            yield pa.RecordBatch.from_arrays([
                pa.array(c, pa.string() if i == 1 else pa.float64() if i == 7 else pa.int64())
                for i, c in enumerate(columns)
            ] + batch.columns[3:], [x.split()[0] for x in SCHEMA.split(", ")] + batch.schema.names[3:])

    return run


def _part_sums(model: Broadcast):
    """(lang, digest, total, n) of rows (lang, digest, text) by one part of a language's model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.value
        for batch in ppl.pieces(batches):
            found = list(scorer.sums(batch.column(0)[0].as_py(), batch.column(2).to_pylist())) if len(batch) else []
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.float64()),
                pa.array([n for _, n in found], pa.int64()),
            ], ["lang", "digest", "total", "n"])

    return run


def _by_parts(docs: DataFrame, model: DataFrame, lang: str, parts: int) -> DataFrame:
    """(lang, digest, perplexity) of the different texts of a language whose model is split.

    One part at a time is sent to the tasks, which add up what it scores.
    """
    texts = docs.select(ppl.language(F.col("lang")).alias("lang"), F.sha2("text", 256).alias("digest"), "text").where(
        (F.col("lang") == lang) & (F.col("text") != ""))
    found = []
    for part in range(parts):
        arrays = cut_lineage(ppl.hash_arrays(ppl.part_of(model, part, parts)))
        (_, scorer), = ppl.scorers(arrays)
        scorer.part, scorer.parts = part, parts
        sent = docs.sparkSession.sparkContext.broadcast(scorer)
        sums = texts.mapInArrow(_part_sums(sent), "lang string, digest string, total double, n bigint")
        found.append(cut_lineage(sums.groupBy("lang", "digest").agg(F.first("total").alias("total"), F.first("n").alias("n"))))
        sent.destroy()
    return reduce(DataFrame.unionByName, found).groupBy("lang", "digest").agg(
        F.exp(-F.sum("total") / F.first("n")).alias("perplexity"))


@dataclass
class Models:
    """Scorers of groups of languages, each with the rows it is for; texts of larger models are scored already."""

    groups: list[tuple[Column, Broadcast]]
    large: Column | None = None
    scores: Lookup | None = None


def _models(docs: DataFrame, limit: int) -> Models:
    """Models of all languages: within ``limit`` bytes they are held by a task, larger ones are split."""
    spark = docs.sparkSession
    model = cut_lineage(ppl.kneser_ney(cut_lineage(ppl.gram_counts(docs))))
    sizes = {r["lang"]: r["count"] * ppl.ENTRY_BYTES for r in model.groupBy("lang").count().collect()}
    large = sorted(x for x, size in sizes.items() if size > limit)
    lang = ppl.language(F.col("lang"))
    arrays = cut_lineage(ppl.hash_arrays(model.where(~F.col("lang").isin(large))))
    groups = []
    for langs, scorer in ppl.scorers(arrays, limit):
        # languages without a single character have no model; they go with the first group
        own = lang.isin(langs) if groups else ~lang.isin([x for x in sizes if x not in langs])
        groups.append((own, spark.sparkContext.broadcast(scorer)))
    groups = groups or [(~lang.isin(large), spark.sparkContext.broadcast(ppl.Scorer({})))]
    if not large:
        return Models(groups)
    scores = [_by_parts(docs, model.where(F.col("lang") == x), x, -(-sizes[x] // limit)) for x in large]
    return Models(groups, lang.isin(large), Lookup(reduce(DataFrame.unionByName, scores)))


def scored_texts(docs: DataFrame, models: Models) -> DataFrame:
    """SCHEMA: the measures and perplexity of every row."""
    read = docs.select("doc_id", ppl.language(F.col("lang")), "text").toDF("doc_id", "lang", "text")
    parts = [read.where(own).mapInArrow(_measured(model), SCHEMA) for own, model in models.groups]
    if models.scores:
        named = _named(read.where(models.large)).mapInArrow(_measured(None), SCHEMA + ", digest string")
        parts.append(models.scores.join(named.drop("perplexity"), ["lang", "digest"], "left").select(parts[0].columns))
    return reduce(DataFrame.unionByName, parts)


def _named(docs: DataFrame) -> DataFrame:
    return docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))


@dataclass
class Rules:
    """Limits of the quality rules."""

    min_words: int = MIN_WORDS
    max_repeat_percent: int = MAX_REPEAT_PERCENT
    lower_width: float = LOWER_WIDTH
    upper_width: float = UPPER_WIDTH
    least_quartile: float = LEAST_QUARTILE

    def failed(self, n_words, n_repeat_words):
        return (n_words < self.min_words) | (100 * n_repeat_words > self.max_repeat_percent * n_words)

    def bands(self, judged: DataFrame) -> DataFrame:
        return ppl.bands(judged.where(~F.col("base_failed")), self.lower_width, self.upper_width,
                         self.least_quartile)


def _judged(docs: DataFrame, rules: Rules, models: Models) -> DataFrame:
    scored = cut_lineage(scored_texts(docs, models))
    return scored.withColumn("base_failed", rules.failed(F.col("n_words"), F.col("n_repeat_words")))


def quality_rules(docs: DataFrame, rules: Rules | None = None, limit: int = ppl.MODEL_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang) with its measures and verdict.

    The model is counted over all texts, then each text is scored with its language's model, and is
    kept if the base rules hold and its perplexity lies inside the language's band. The band follows
    the texts that pass the base rules. NULL texts count as empty: no words, so they fail. NULL
    languages share one model. Repeated rows are judged alike, once each. A NULL doc_id is kept as it
    is. Other columns of ``docs`` are not read. An empty table gives an empty result. A language's model
    above ``limit`` bytes is split, with a pass over its texts for each part.
    """
    rules = rules or Rules()
    judged = _judged(docs, rules, _models(docs, limit))
    inside = F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return Lookup(rules.bands(judged)).join(judged, "lang", "left").withColumn(
        "kept", ~F.col("base_failed") & inside)


def _passing(model: Broadcast, bounds: dict, rules: Rules, text_at: int, lang_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _measured(model)
        for batch in ppl.pieces(batches):
            langs = pa.array([ppl.NO_LANGUAGE if x is None else x for x in batch.column(lang_at).to_pylist()], pa.string())
            rows = pa.RecordBatch.from_arrays(
                [pa.nulls(len(batch), pa.int64()), langs, batch.column(text_at)], ["doc_id", "lang", "text"])
            kept = [i for x in score(iter([rows])) for i, r in enumerate(x.to_pylist())
                    if not rules.failed(r["n_words"], r["n_repeat_words"]) and r["perplexity"] is not None
                    and r["lang"] in bounds and bounds[r["lang"]][0] <= r["perplexity"] <= bounds[r["lang"]][1]]
            yield batch.take(pa.array(kept, pa.int64()))

    return run


def passing(docs: DataFrame, rules: Rules | None = None, limit: int = ppl.MODEL_BYTES) -> DataFrame:
    """The rows of ``docs`` that pass the quality rules, with all their columns.

    The model is counted once. Texts are scored twice, for the bands and to filter, so that none has
    to be shuffled; those of a split model are scored once and found by their digests. Language codes
    are few, and so are their bounds.
    """
    rules = rules or Rules()
    models = _models(docs, limit)
    bounds = {r["lang"]: (r["lower"], r["upper"]) for r in rules.bands(_judged(docs, rules, models)).collect()}
    at = docs.columns.index("text"), docs.columns.index("lang")
    kept = [docs.where(own).mapInArrow(_passing(model, bounds, rules, *at), docs.schema) for own, model in models.groups]
    if models.scores:
        inside = reduce(Column.__or__, [
            (F.col("lang") == x) & F.col("perplexity").between(*bounds[x]) for x in bounds], F.lit(False))
        named = docs.where(models.large).select(F.struct("*").alias("_doc"), F.sha2("text", 256).alias("digest"),
                                                ppl.language(F.col("lang")).alias("lang"))
        usual = Lookup(models.scores.table.where(inside).select("lang", "digest")).join(named, ["lang", "digest"], "left_semi")
        based = usual.select("_doc.*").mapInArrow(_based(rules, at[0]), docs.schema)
        kept.append(based)
    return reduce(DataFrame.unionByName, kept)


def _based(rules: Rules, text_at: int):
    """The rows that hold the base rules."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _kinds()
        for batch in ppl.pieces(batches):
            texts, kept = [t or "" for t in batch.column(text_at).to_pylist()], []
            for a, b in ppl.chunks(texts):
                n_words, _, _, _, repeats = measures(texts[a:b], kinds)
                kept += [a + i for i, (n, r) in enumerate(zip(n_words, repeats, strict=True)) if not rules.failed(n, r)]
            yield batch.take(pa.array(kept, pa.int64()))

    return run
