"""Secret scans: patterns, and randomness tests of long tokens under false-discovery control."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.binding import let
from lexspark.plans.lineage import cut_lineage

ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))" "[\"']?" r"\x20*[:=]\x20*" "[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 8
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ALPHA = 0.01
STEPS = 50
CLASSES = 32
_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order they are tried: the shape of a token, its alphabet.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", _DIGITS + _UPPER.lower()),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$", _UPPER + _UPPER.lower() + _DIGITS + "+/"),
)


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>> of the leftmost matches that do not overlap, in code points.

    The parts between the matches give their places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(m: Column) -> Column:
        lengths = F.zip_with(m["gaps"], m["whole"], lambda g, w: F.struct(
            F.length(g).alias("gap"), F.length(w).alias("size")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
        walked = F.aggregate(F.slice(lengths, F.lit(1), F.size(m["whole"])), start, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end")))).alias("out"),
        ))["out"]
        return F.zip_with(walked, m["found"], lambda s, v: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(F.struct(text.alias("text"), found.alias("found")), lambda t: F.when(
        F.size(t["found"]) == 0, none
    ).otherwise(let(F.struct(
        t["found"].alias("found"), F.split(t["text"], pattern).alias("gaps"),
        (F.regexp_extract_all(t["text"], F.lit(pattern), F.lit(0)) if group else t["found"]).alias("whole"),
    ), placed)))


def _marked(found: Column, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def joined(marks: Column) -> Column:
    """``kind:start:end`` by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(marks), lambda m: F.concat_ws(
        ":", F.get(names, m["kind"]), m["start"], m["end"])), ",")


def log_erfc(x: Column) -> Column:
    """Logarithm of the complementary error function of ``x >= 0``, to seven digits."""
    # fixed values: the rational approximation of the error function in five terms
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    t = 1 / (1 + 0.3275911 * x)
    poly = F.lit(0.0)
    for c in reversed(a):
        poly = (poly + c) * t
    return F.log(poly) - x * x


def _two_sided(z: Column) -> Column:
    return log_erfc(F.abs(z) / math.sqrt(2))


def _upper(z: Column) -> Column:
    tail = log_erfc(F.abs(z) / math.sqrt(2)) - math.log(2)
    return F.when(z >= 0, tail).otherwise(F.log1p(-F.exp(tail)))


def battery(values: Column, k: int) -> Column:
    """Logarithm of the p-value that ``values`` are drawn evenly from 0 to ``k - 1``.

    Three tests: chi-squared of the counts of each symbol, number of runs in either half of the
    alphabet, and correlation of neighbours. The least p-value counts, times three.
    """
    def tests(v: Column) -> Column:
        n = F.size(v).cast("double")
        squares = F.aggregate(F.array_distinct(v), F.lit(0.0), lambda acc, d: acc + F.pow(
            F.size(F.filter(v, lambda x: x == d)).cast("double"), F.lit(2.0)))
        df = float(k - 1)
        chi = F.pow((squares * k / n - n) / df, F.lit(1 / 3))
        even = _upper((chi - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
        following = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1),
                               lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        changes = F.aggregate(following, F.lit(0.0), lambda acc, p: acc + (
            (p["a"] < k // 2) != (p["b"] < k // 2)).cast("double"))
        runs = _two_sided((2 * changes - (n - 1)) / F.sqrt(n - 1))
        mean, variance = (k - 1) / 2, (k * k - 1) / 12
        product = F.aggregate(following, F.lit(0.0), lambda acc, p: acc + (p["a"] - mean) * (p["b"] - mean))
        serial = _two_sided(product / (variance * F.sqrt(n - 1)))
        return F.least(F.least(even, runs, serial) + math.log(3), F.lit(0.0))

    return let(values, tests)


def _place_in(alphabet: str):
    return lambda c: F.call_function("instr", F.lit(alphabet), c) - 1


def token_score(token: Column) -> Column:
    """Logarithm of the p-value of ``token`` under its inferred encoding, NULL if it has none."""
    out = F.lit(None).cast("double")
    for name, shape, alphabet in reversed(ENCODINGS):
        plain = F.lower(token) if name == "hex" else F.translate(token, "-_", "+/")
        values = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), _place_in(alphabet))
        out = F.when(token.rlike(shape), battery(values, len(alphabet))).otherwise(out)
    return out


def _candidates(text: Column, base: Column) -> Column:
    """array<struct<start, end, length class, step of -log p>> of tokens outside the base spans."""
    scored = F.transform(spans(text, TOKEN), lambda s: let(F.rtrim(s["value"], F.lit("=")), lambda token: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.floor(F.log2(F.length(token))).cast("int").alias("size"),
        F.floor(-token_score(token) * STEPS).cast("int").alias("step"))))
    return let(base, lambda b: F.filter(scored, lambda s: s["step"].isNotNull() & ~F.exists(
        b, lambda x: (x["start"] <= s["start"]) & (s["end"] <= x["end"]))))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base spans, candidates) of every row; no text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(spans(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= MIN_VALUE)
    found = docs.select("doc_id", text.alias("text"), assign.alias("assign"), spans(text, ACCESS).alias("access"),
                        spans(text, HEX).alias("hex"))
    base = found.select(
        "doc_id", "text", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.concat(*[_marked(F.col(k), k) for k in KINDS[:3]]).alias("base"))
    return base.select("doc_id", "n_assign", "n_access", "n_hex", "base",
                       _candidates(F.col("text"), F.col("base")).alias("tokens"))


def dismissal_steps(rows: DataFrame, alpha: float) -> list[int | None]:
    """Per length class the step of -log p from which on tokens count as not random.

    Benjamini and Hochberg's rule within each class of lengths: of the tokens dismissed, a share of
    ``alpha`` at most is expected to be random. Classes are powers of two, as short tokens give weak
    evidence that would otherwise be judged by that of long ones. P-values are rounded up to steps,
    so a histogram decides instead of a sort.
    """
    counts = rows.select(F.inline("tokens")).groupBy("size", "step").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("size").orderBy(F.desc("step"))
    summed = counts.select("size", "step", F.sum("n").over(down).alias("beyond"),
                           F.sum("n").over(Window.partitionBy("size")).alias("all"))
    ends = summed.where(F.exp(-F.col("step") / STEPS) <= alpha * F.col("beyond") / F.col("all")).groupBy("size").agg(
        F.min("step").alias("step"))
    found = {r["size"]: r["step"] for r in ends.collect()}
    return [found.get(i) for i in range(CLASSES)]


def scan(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) for every row of ``docs``.

    The base patterns give spans of three kinds. Other tokens of 20 characters or more whose shape is
    that of an encoding are tested for randomness; those not dismissed are spans of kind ``random``. A NULL text counts as empty: no spans. Repeated rows each give a row and
    each count as evidence. Other columns are not read; an empty table gives an empty result.
    """
    rows = cut_lineage(scanned(docs))
    limits = F.array(*[F.lit(s).cast("int") for s in dismissal_steps(rows, alpha)])
    random = F.transform(F.filter("tokens", lambda t: F.coalesce(
        t["step"] < F.get(limits, t["size"]), F.lit(True))), lambda t: F.struct(
        t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    return rows.withColumn("_random", random).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "_random")).alias("spans"), F.size("_random").cast("bigint").alias("n_random"))
