"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.words import word_count
from lexspark.plans.lineage import cut_lineage
from lexspark.plans.order import with_position
from lexspark.plans.sizing import Lookup

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
KEY_BITS = 60
LEVEL_BITS = 12


def row_key(doc_id: Column, text: Column) -> Column:
    """60 bits of a hash of a row's id and text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _source(source: Column) -> Column:
    """A source's name as join key; NULL is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, src, size, key) of every row: what mixing has to know of it."""
    return docs.select(
        "doc_id", _source(F.col("source")).alias("src"), word_count(F.col("text")).alias("size"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
    )


def targets(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(src, source_size, target) for every source.

    Sources in code point order, NULL last, take the weights in turn. Together they get ``share`` of
    all words; a target above ``most`` times its source is cut, and the excess is shared by weight
    among the others, until none is above.
    """
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    ranked = with_position(sizes, [F.col("src") == "n", F.col("src")], "at")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    parts = cut_lineage(ranked.select(
        "src", "source_size", F.get(cycle, (F.col("at") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * float(most)).alias("cap"),
    ))
    budget = (parts.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level, cut = None, 0
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > F.col("cap")
        got = parts.agg(
            F.coalesce(F.sum(F.when(above, 1)), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights"),
        ).first()
        if level is not None and got["n"] == cut:
            break
        cut = got["n"]
        if not got["weights"]:
            level = float("inf") if cut else 0.0
            break
        level = (budget - got["given"]) / got["weights"]
    share_of = F.col("weight") * F.lit(level)
    return parts.select("src", "source_size", F.when(share_of > F.col("cap"), F.col("cap")).otherwise(
        share_of).alias("target"))


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source: ``full`` copies of all rows, and the key up to which one more copy is taken.

    Histograms of words by the next bits of the key find the bucket in which the budget ends; only
    that bucket's rows are counted in the next level. The last level knows the whole key: ``bound``
    is the key at which the budget ends, with ``rest`` words of the ``tie_words`` in its
    ``tie_rows`` rows left to take. Budgets are nested: a larger one takes the same rows and more.
    """
    whole = F.floor("target").cast("bigint")
    state = wanted.where("source_size > 0").select(
        "src", (whole - whole % F.col("source_size")).alias("given"), F.lit(0).cast("bigint").alias("bound"),
        (whole % F.col("source_size")).alias("rest"),
        F.lit(0).cast("bigint").alias("tie_words"), F.lit(0).cast("bigint").alias("tie_rows"),
    )
    for known in range(0, KEY_BITS, LEVEL_BITS):
        left = KEY_BITS - known - LEVEL_BITS
        now = Lookup(state)
        inside = now.join(rows, "src").where(
            F.shiftright("key", KEY_BITS - known) == F.col("bound")) if known else now.join(rows, "src")
        counted = inside.groupBy("src", F.shiftright("key", left).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("src").orderBy("bucket")
        summed = counted.withColumn("upto", F.sum("words").over(order)).join(
            now.table.select("src", "given", "rest"), "src")
        ends = summed.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
        state = cut_lineage(ends.select(
            "src", "given", F.col("bucket").alias("bound"),
            (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"),
            F.col("words").alias("tie_words"), F.col("n").alias("tie_rows"),
        ))
    return wanted.join(state, "src", "left").select(
        "src", "source_size", "target",
        F.coalesce(F.try_divide("given", "source_size"), F.lit(0)).cast("bigint").alias("full"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("bound", "rest", "tie_words", "tie_rows")],
    )


def words_taken() -> Column:
    """Words the mix takes of a row joined to its source's thresholds.

    The row in which the budget ends is taken if that comes nearer to the target. Rows with one key
    cannot be told apart: several of them share what is left.
    """
    at_bound = F.when(
        F.col("tie_rows") > 1,
        F.floor(F.col("size") * F.col("rest").cast("double") / F.col("tie_words")).cast("bigint"),
    ).otherwise(F.when(2 * F.col("rest") >= F.col("size"), F.col("size")).otherwise(0))
    more = F.when(F.col("key") < F.col("bound"), F.col("size")).when(
        F.col("key") == F.col("bound"), at_bound).otherwise(0)
    return F.col("full") * F.col("size") + more


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs`` (doc_id, text, source).

    NULL texts have size 0 and are never taken; NULL is a source of its own. Repeated rows have one
    key and share words alike. Reruns agree, as keys are hashes. Other columns are not read; an empty
    table gives an empty result. Takes the options of ``targets``.
    """
    rows = cut_lineage(measured(docs))
    found = Lookup(thresholds(rows, cut_lineage(targets(rows, **options))))
    return found.join(rows, "src").select(
        "doc_id", "size", "source_size", "target", words_taken().alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    Rows that share the end of a budget are taken or left together, whichever is nearer. Rows without
    words are never taken, as in ``mix``.
    """
    rows = cut_lineage(measured(docs))
    found = Lookup(thresholds(rows, cut_lineage(targets(rows, **options))))
    more = (F.col("_row.key") < F.col("bound")) | (
        (F.col("_row.key") == F.col("bound")) & (2 * F.col("rest") >= F.col("tie_words")))
    keyed = docs.select(F.struct("*").alias("_doc"), F.struct(
        row_key(F.col("doc_id"), F.col("text")).alias("key")).alias("_row"),
        _source(F.col("source")).alias("src"))
    copies = F.when(word_count(F.col("_doc.text")) == 0, 0).otherwise(F.col("full") + more.cast("bigint"))
    joined = found.join(keyed, "src").withColumn("_copies", copies).where("_copies > 0")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*")


ORACLE = """
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT source, source_size, source_size * 2.0::DOUBLE AS cap, ([5.0, 2.0, 1.0]::DOUBLE[])[
    ((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 + 1)::INT] AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS k FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
v AS (SELECT level FROM l WHERE level * weight <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN weight * (SELECT level FROM v) > cap THEN cap
    ELSE weight * (SELECT level FROM v) END AS target FROM w),
g AS (SELECT source, key, sum(size)::BIGINT AS words, count(*) AS n,
    sum(sum(size)) OVER (PARTITION BY source ORDER BY key)::BIGINT AS upto FROM r GROUP BY source, key),
b AS (SELECT t.*, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS full_copies,
    CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest FROM t)
SELECT r.doc_id, r.size, b.source_size, b.target,
  (b.full_copies * r.size + CASE
    WHEN g.upto <= b.rest THEN r.size
    WHEN g.upto - g.words > b.rest THEN 0
    WHEN g.n > 1 THEN floor(r.size * (b.rest - g.upto + g.words)::DOUBLE / g.words)::BIGINT
    WHEN 2 * (b.rest - g.upto + g.words) >= r.size THEN r.size ELSE 0 END)::BIGINT AS taken
FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
JOIN g ON r.source IS NOT DISTINCT FROM g.source AND r.key = g.key
"""
