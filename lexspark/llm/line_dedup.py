"""Line deduplication by an exact set-similarity join."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.binding import let
from lexspark.llm.words import SPACES
from lexspark.plans.lineage import cut_lineage
from lexspark.plans.sizing import Lookup

RARITY_BITS = (16, 22)
# a token counted 2**PAIRED times or more is looked up together with the next shared one
PAIRED = 9
HOT_KEY = 1 << PAIRED
# lines of up to LONG tokens pair their frequent tokens; 4 / 5 of it and more post them alone
LONG = 320
_SLOTS = 16
_AT_BITS = 20
# two sets of n and m tokens are similar if 9 * shared >= 4 * (n + m): a Jaccard index of 0.8


def _plain(text: Column) -> Column:
    """``text`` with spaces for all white space."""
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_plain(text), " "), "")


def _hashes(text: Column) -> Column:
    return F.array_distinct(F.transform(_words(text), lambda w: F.xxhash64(w)))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of every line with a word."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(
        F.ltrim("line", F.lit(SPACES)) != "")


def rarity(docs: DataFrame) -> Callable[[Column], Column]:
    """A function of a token's hash: 59 bits of it below four bits of rarity.

    Rarity is the logarithm of the number of tokens in a bucket of hashes, so it takes a bounded amount of memory: 2**16 to 2**22
    buckets, of 2**PAIRED tokens on average if that allows it, in one constant array of 16 buckets an item. Tokens of one class go by
    their hash, so the order is total and one for all lines, which is all that the filters need to be exact.
    """
    tokens = docs.select(F.explode(F.split(_plain(F.col("text")), " ")).alias("w")).where("w <> ''")
    counts = cut_lineage(tokens.groupBy(
        F.xxhash64("w").bitwiseAND((1 << RARITY_BITS[1]) - 1).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("c")))
    total = counts.agg(F.sum("c")).first()[0] or 0
    bits = min(max((total >> PAIRED).bit_length(), RARITY_BITS[0]), RARITY_BITS[1])
    items = (1 << bits) // _SLOTS
    ranks = counts.groupBy(F.col("bucket").bitwiseAND((1 << bits) - 1).alias("bucket")).agg(
        F.least(F.floor(F.log2(F.sum("c"))), F.lit(_SLOTS - 1)).alias("rank"))
    packed = ranks.groupBy(F.col("bucket").bitwiseAND(items - 1).alias("item")).agg(F.bit_or(F.call_function(
        "shiftleft", F.col("rank"), F.floor(F.col("bucket") / items).cast("int") * 4)).alias("ranks"))
    held = {r["item"]: r["ranks"] for r in packed.collect()}
    order = F.from_json(F.lit(json.dumps([held.get(i, 0) for i in range(items)])), "array<bigint>")

    def token(h: Column) -> Column:
        of = F.coalesce(F.get(order, h.bitwiseAND(items - 1).cast("int")), F.lit(0).cast("bigint"))
        slot = F.shiftrightunsigned(h, items.bit_length() - 3).bitwiseAND(4 * (_SLOTS - 1)).cast("int")
        rank = F.call_function("shiftrightunsigned", of, slot).bitwiseAND(_SLOTS - 1)
        return F.shiftleft(rank, 59).bitwiseOR(F.shiftrightunsigned(h, 5))

    return token


def _identity(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _prefixed(docs: DataFrame, token: Callable[[Column], Column]) -> DataFrame:
    """(id, line, x, doc_id, line_no, n, bits, prefix, many): every different line, named by its hash.

    ``doc_id`` and ``line_no`` are its first place and ``many`` tells whether there are more. Of ``n`` tokens a
    similar line may lack n / 5: ``prefix`` has one more, the rarest, and the next one. ``bits`` has a bit
    for each residue of token hashes that an odd number of tokens have.
    """
    n = F.size("_h")
    rows = lines_of(docs).select("doc_id", "line_no", _identity(F.col("line")).alias("line"), _hashes(F.col("line")).alias("_h"))
    rows = rows.select(
        "line", F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "line_no").alias("at"), F.struct(
            n.alias("n"),
            F.aggregate("_h", F.lit(0).cast("bigint"), lambda bits, h: bits.bitwiseXOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int")))).alias("bits"),
            F.slice(F.sort_array(F.transform("_h", token)), F.lit(1),
                    F.floor(n / 5).cast("int") + 2).alias("prefix"),
        ).alias("of"))
    return rows.groupBy("line").agg(
        F.min("at").alias("at"), F.first("of").alias("of"), F.count(F.lit(1)).alias("c")
    ).select(F.monotonically_increasing_id().alias("id"), "line", "at.x", "at.doc_id", "at.line_no", "of.*", (F.col("c") > 1).alias("many"))


def _postings(lines: DataFrame) -> DataFrame:
    """(key, id, ni, bits): the keys of every line; similar lines have one in common. Odd keys are of rare tokens.

    Of two similar lines take the shared tokens in the order of rarity. The first is in both prefixes, without the
    token that comes last, and the second one in both prefixes. A rare first token is a key; a
    frequent one and the second are a key together, so that no key has the lines of a frequent token. Long
    lines post frequent tokens alone, as their pairs are many. ``ni`` holds n and, below it, how
    many tokens of the line are certainly not shared if the key is of the first shared tokens.
    """
    n, top = F.col("n"), (1 << _AT_BITS) - 1

    def item(key: Column, lacks: Column, rare: int = 0) -> Column:
        return F.shiftleft(key, _AT_BITS + 1).bitwiseOR(F.least(lacks, F.lit(top)).cast("bigint") + (rare << _AT_BITS))

    def keys(t: Column, i: Column) -> Column:
        alone = F.array(item(t, i))
        pairs = F.transform(F.slice("prefix", i + 2, n), lambda u, j: item(F.xxhash64(t, u), i + j))
        return F.when(F.shiftright(t, 59) < PAIRED, F.array(item(t, i, 1))).when((n == 1) | (n > LONG), alone).when(
            5 * n < 4 * LONG, pairs).otherwise(F.concat(alone, pairs))

    first = F.slice("prefix", F.lit(1), F.floor(n / 5).cast("int") + 1)
    return lines.select("id", "n", "bits", F.explode(F.flatten(F.transform(first, keys))).alias("_k")).select(
        F.shiftrightunsigned("_k", _AT_BITS).alias("key"), "id",
        F.shiftleft(n.cast("bigint"), _AT_BITS).bitwiseOR(F.col("_k").bitwiseAND(top)).alias("ni"), "bits")


def _possible(a: str, b: str) -> Column:
    """Filters on two postings of one key: length, position, differing bits."""
    def both(side: str) -> tuple[Column, Column]:
        n = F.shiftright(f"{side}.ni", _AT_BITS)
        return n, n - F.col(f"{side}.ni").bitwiseAND((1 << _AT_BITS) - 1)

    (n, left), (m, right) = both(a), both(b)
    return (
        (F.col(f"{a}.key") == F.col(f"{b}.key"))
        # tokens in one line only: n + m - 2 * shared <= (n + m) / 9
        & (9 * _distance(a, b) <= n + m)
        & (5 * n >= 4 * m) & (5 * m >= 4 * n) & (9 * F.least(left, right) >= 4 * (n + m))
    )


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits")))


def _pairs(left: DataFrame, right: DataFrame, more: Column) -> DataFrame:
    """(a, b, d): possible pairs of postings and the number of bits that differ."""
    return left.alias("a").join(right.alias("b"), _possible("a", "b") & more).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b"), _distance("a", "b").alias("d"))


def _placed(ids: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, line, x, doc_id, line_no) of some lines."""
    return Lookup(ids.distinct()).join(lines.select("id", "line", "x", "doc_id", "line_no"), "id")


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id): the later lines of ``pairs`` (id, other) with a Jaccard index of 0.8 or more."""
    both = pairs.alias("p").join(texts.alias("a"), F.col("p.id") == F.col("a.id")).join(
        texts.alias("b"), F.col("p.other") == F.col("b.id"))
    shared = F.size(F.array_intersect(_words(F.col("a.text")), _words(F.col("b.text"))))
    return both.where(9 * shared >= 4 * (F.col("a.n") + F.col("b.n"))).select("p.id").distinct()


def _verified(pairs: DataFrame, lines: DataFrame, docs: DataFrame) -> DataFrame:
    """(id): the lines of ``pairs`` (a, b, d) with an earlier similar one among them.

    Each line is compared with its nearest one first, by their bits; only the lines left are compared with the others.
    """
    pairs = cut_lineage(pairs.distinct())
    named = Lookup(_placed(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), lines).select(
        "id", "line", "x", F.col("doc_id").alias("_doc"), F.col("line_no").alias("_no")))
    texts = cut_lineage(
        named.join(lines_of(docs).select("doc_id", "line_no", _identity(F.col("line")).alias("line"), F.col("line").alias("text")), "line")
        .where(F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("line_no") == F.col("_no")))
        .groupBy("id").agg(F.first("text").alias("text"))
        .select("id", "text", F.size(F.array_distinct(_words(F.col("text")))).alias("n")))
    place = F.struct("x", F.col("_doc").alias("doc_id"), F.col("_no").alias("line_no"), "line")
    at = named.table.select("id", place.alias("at"))
    placed = pairs.join(at.select(F.col("id").alias("a"), F.col("at").alias("_a")), "a").join(
        at.select(F.col("id").alias("b"), F.col("at").alias("_b")), "b")
    turned = F.col("_a") < F.col("_b")
    placed = cut_lineage(placed.select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("id"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("other"), "d"))
    nearest = placed.groupBy("id").agg(F.min(F.struct("d", "other")).alias("_n")).select("id", "_n.other")
    settled = Lookup(_similar(nearest, texts))
    others = settled.join(placed, "id", "left_anti").select("id", "other")
    return settled.table.union(_similar(others, texts))


def matched(docs: DataFrame, hot: int = HOT_KEY) -> DataFrame:
    """(line, x, doc_id, line_no, many, later): the lines that repeat or match an earlier line.

    ``later`` tells whether an earlier different line is similar. Lines that share a key of
    up to ``hot`` lines are compared in pairs. Of a key of more lines, all lines are first compared with
    the earliest one, which settles groups of copies; only the lines left are compared with all before.
    """
    lines = cut_lineage(_prefixed(docs, rarity(docs)))
    postings = _postings(lines)
    # rare tokens have less than 2**PAIRED lines
    risky = postings.where(F.col("key").bitwiseAND(1) == 0) if hot >= 1 << PAIRED else postings
    busy = Lookup(risky.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot).select("key"))
    few = busy.join(postings, "key", "left_anti")
    pairs = _pairs(few, few, F.col("b.id") < F.col("a.id"))
    crowd = cut_lineage(busy.join(postings, "key", "left_semi"))
    places = _placed(crowd.select("id"), lines).select("id", F.struct("x", "doc_id", "line_no", "line").alias("at"))
    crowd = cut_lineage(crowd.join(places, "id"))
    head = crowd.groupBy("key").agg(F.min(F.struct("at", "id", "ni", "bits")).alias("m")).select("key", "m.*")
    earlier = F.col("b.at") < F.col("a.at")
    settled = Lookup(_verified(pairs.union(_pairs(crowd, head, earlier)), lines, docs))
    more = _verified(_pairs(settled.join(crowd, "id", "left_anti"), crowd, earlier), lines, docs)
    later = Lookup(settled.table.union(more).select("id", F.lit(True).alias("later")))
    return later.join(lines.select("id", "line", "x", "doc_id", "line_no", "many"), "id", "left").where(
        "many OR later").select("line", "x", "doc_id", "line_no", "many", F.coalesce("later", F.lit(False)).alias("later"))


def _flagged(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, line_no, removed) of every line."""
    rows = lines_of(docs).select("doc_id", "line_no", _identity(F.col("line")).alias("line"))
    known = found.select("line", F.col("doc_id").alias("_doc"), F.col("line_no").alias("_no"), "later")
    first = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("line_no") == F.col("_no"))
    return Lookup(known).join(rows, "line", "left").select(
        "doc_id", "line_no", F.when(F.col("_no").isNull(), False).otherwise(F.col("later") | ~first).alias("removed"))


def line_matches(docs: DataFrame, hot: int = HOT_KEY) -> DataFrame:
    """(doc_id, n_lines, n_removed): per document, its lines with a word and how many of them go.

    Lines come in the order of doc_id, NULL last, and their place in the text. A line goes if an
    earlier line, kept or not, has an equal text or a token set with a Jaccard index of 0.8 or more. Tokens are
    words as they stand. NULL texts and texts without words have no lines and count 0. Rows with one
    doc_id are one document, and so are rows without: lines at one place of equal rows are one line.
    Other columns are not read; an empty table gives an empty result.
    """
    flagged = _flagged(docs, matched(docs, hot))
    per_doc = flagged.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("removed").cast("bigint")).alias("n_removed"))
    empty = docs.select("doc_id", F.lit(0).cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_removed"))
    return per_doc.unionByName(empty).groupBy("doc_id").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_removed").alias("n_removed"))


def without_repeats(docs: DataFrame, hot: int = HOT_KEY) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``; all columns stay."""
    gone = _flagged(docs, matched(docs, hot)).where("removed").groupBy("doc_id").agg(
        F.collect_set("line_no").alias("_gone")).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), "_gone")
    kept = let(F.struct("_doc.text", "_gone"), lambda d: F.array_join(F.filter(
        F.split(d["text"], "\n"), lambda line, i: ~F.array_contains(d["_gone"], i)), "\n"))
    named = docs.select(F.struct("*").alias("_doc"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"))
    text = F.when(F.col("_gone").isNull(), F.col("_doc.text")).otherwise(kept)
    return Lookup(gone).join(named, "_id", "left").withColumn("_doc", F.col("_doc").withField("text", text)).select("_doc.*")


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line_no, lines[i] AS line FROM (
    SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
      SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
  WHERE regexp_matches(lines[i], '[^\x20\x09-\x0D]')),
d AS (
  SELECT line, min({'d': doc_id, 'n': line_no}) AS at,
    list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l GROUP BY line),
s AS (SELECT *, len(w) AS n FROM d),
m AS (
  SELECT DISTINCT a.line FROM s a JOIN s b ON b.at < a.at AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  WHERE 9 * len(list_intersect(a.w, b.w)) >= 4 * (a.n + b.n)),
f AS (
  SELECT l.doc_id, (m.line IS NOT NULL OR s.at <> {'d': l.doc_id, 'n': l.line_no})::BIGINT AS removed
  FROM l JOIN s USING (line) LEFT JOIN m USING (line)),
c AS (SELECT doc_id, count(*) AS n_lines, sum(removed)::BIGINT AS n_removed FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN c USING (doc_id)
"""
