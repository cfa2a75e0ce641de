"""Fixed-length model inputs: truncation, markers, segments, padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the input format
CLS, SEP, UNKNOWN, PAD = "[CLS]", "[SEP]", "[UNK]", "[PAD]"
PIECE_PREFIX = "##"
MAX_SEQ_LENGTH = 128
SINGLE_MARKERS, PAIR_MARKERS = 2, 3


def truncate_single(tokens: Column, max_len: int = MAX_SEQ_LENGTH) -> Column:
    return F.slice(tokens, 1, max_len - SINGLE_MARKERS)


def pair_lengths(a: Column, b: Column, limit: int) -> tuple[Column, Column]:
    """Lengths left when the longer part loses tokens one by one, the second part on ties."""
    upper, lower = (limit + 1) // 2, limit // 2
    keep_a = (
        F.when(a + b <= limit, a)
        .when(a <= upper, a)
        .when(b <= lower, limit - b)
        .otherwise(F.lit(upper))
    )
    return keep_a, F.least(b, limit - keep_a)


def truncate_pair(
    a: Column, b: Column, max_len: int = MAX_SEQ_LENGTH
) -> tuple[Column, Column]:
    keep_a, keep_b = pair_lengths(F.size(a), F.size(b), max_len - PAIR_MARKERS)
    return F.slice(a, F.lit(1), keep_a), F.slice(b, F.lit(1), keep_b)


def assemble(a: Column, b: Column) -> tuple[Column, Column]:
    """Tokens with markers and their segment numbers; ``b`` may be NULL or empty."""
    has_b = F.coalesce(F.size(b), F.lit(0)) > 0
    first = F.concat(F.array(F.lit(CLS)), a, F.array(F.lit(SEP)))
    tokens = F.when(has_b, F.concat(first, b, F.array(F.lit(SEP)))).otherwise(first)
    zeros = F.array_repeat(F.lit(0), F.size(a) + 2)
    segments = F.when(
        has_b, F.concat(zeros, F.array_repeat(F.lit(1), F.size(b) + 1))
    ).otherwise(zeros)
    return tokens, segments


def pad(values: Column, max_len: int) -> Column:
    """Zero-pad to ``max_len``."""
    return F.concat(values, F.array_repeat(F.lit(0), F.lit(max_len) - F.size(values)))


def mask(tokens: Column, max_len: int) -> Column:
    return pad(F.array_repeat(F.lit(1), F.size(tokens)), max_len)
