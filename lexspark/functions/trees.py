"""Dependency-tree expressions over ``heads``: one head index per token, a root points to itself.

All of them work inside one sentence row, so scoring a corpus needs no shuffle. Every expression is
linear or n log n in the sentence length, as sentences of many thousand tokens occur.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions.binding import let
from lexspark.functions.text import is_letters

_CHILD_BITS = 32
_KEY = 1 << _CHILD_BITS


def _positions(array: Column) -> Column:
    return F.sequence(F.lit(0), F.size(array) - 1)


def chain_heads(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Default tree for text without a parse.

    Content tokens (letters only, no stopword) hang on the content token before them, the first
    being the root; other tokens hang on the next content token, else on the previous one. A
    sentence without content tokens hangs on its first token. Tokens must be lower-cased.
    """
    content_flags = F.transform(tokens, lambda t: is_letters(t) & ~t.isin(*stopwords))

    def from_content(n: Column, content: Column) -> Column:
        first = F.get(content, F.lit(0))
        last = F.element_at(content, -1)
        # between two content tokens: the tokens in the gap and then the second one itself
        gaps = F.transform(
            F.slice(content, F.lit(2), F.size(content)),
            lambda at, k: F.concat(
                F.array_repeat(at, at - F.get(content, k) - 1), F.array(F.get(content, k))
            ),
        )
        chain = F.flatten(F.concat(
            F.array(F.array_repeat(first, first + 1)),
            gaps,
            F.array(F.array_repeat(last, n - 1 - last)),
        ))
        return F.when(F.size(content) > 0, chain).otherwise(F.array_repeat(F.lit(0), n))

    return let(content_flags, lambda flags: let(
        F.filter(_positions(flags), lambda i: F.get(flags, i)),
        lambda content: from_content(F.size(flags), content),
    ))


def _climb(heads: Column, start: Column, step: Callable[[Column], Column]) -> Column:
    """Pointer doubling: after r rounds every token has seen its 2^r nearest ancestors."""
    rounds = F.ceil(F.log2(F.greatest(F.size(heads), F.lit(2)))).cast("int")
    return F.aggregate(F.sequence(F.lit(1), rounds), start, lambda state, _: step(state))


def ancestor_counts(heads: Column) -> Column:
    """Number of ancestors of every token."""

    def climb(up: Column) -> Column:
        start = F.struct(
            up.alias("up"),
            F.transform(up, lambda h, i: F.when(h == i, 0).otherwise(1)).alias("depth"),
        )
        return _climb(up, start, lambda s: F.struct(
            F.transform(s["up"], lambda u: F.get(s["up"], u)).alias("up"),
            F.zip_with(s["depth"], s["up"], lambda d, u: d + F.get(s["depth"], u)).alias("depth"),
        ))["depth"]

    return let(heads, climb)


def leftmost_ancestors(heads: Column) -> Column:
    """Smallest index among the ancestors of every token; the token's own index for a root."""

    def climb(up: Column) -> Column:
        start = F.struct(up.alias("up"), up.alias("left"))
        return _climb(up, start, lambda s: F.struct(
            F.transform(s["up"], lambda u: F.get(s["up"], u)).alias("up"),
            F.zip_with(
                s["left"], s["up"], lambda m, u: F.least(m, F.get(s["left"], u))
            ).alias("left"),
        ))["left"]

    return let(heads, climb)


def _families(heads: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body(keys, starts)`` over the children of all tokens of a sentence.

    ``keys`` is one sorted array: per token a marker ``i * KEY`` and then ``i * KEY + child + 1`` for
    all tokens with head ``i``. ``starts`` holds the positions of the markers, one per token.
    """
    keys = F.sort_array(F.concat(
        F.transform(heads, lambda h, i: h.cast("bigint") * F.lit(_KEY) + i + 1),
        F.transform(heads, lambda h, i: i.cast("bigint") * F.lit(_KEY)),
    ))
    return let(keys, lambda k: let(
        F.filter(_positions(k), lambda p: F.get(k, p) % F.lit(_KEY) == 0),
        lambda starts: body(k, starts),
    ))


def children_counts(heads: Column) -> Column:
    """Number of immediate children of every token (a root is no child of its own)."""

    def count(up: Column) -> Column:
        return _families(up, lambda keys, starts: F.transform(starts, lambda p, i: (
            F.coalesce(F.get(starts, i + 1), F.size(keys)) - p - 1
            - F.when(F.get(up, i) == i, 1).otherwise(0)
        )))

    return let(heads, count)


def rightmost_children(heads: Column) -> Column:
    """Largest index among a token and its children."""

    def right(keys: Column, starts: Column) -> Column:
        return F.transform(starts, lambda p, i: F.greatest(
            i,
            (F.get(keys, F.coalesce(F.get(starts, i + 1), F.size(keys)) - 1) % F.lit(_KEY))
            .cast("int") - 1,
        ))

    return let(heads, lambda up: _families(up, right))


def simplicity(ancestors: Column, children: Column) -> Column:
    """Per token: share of the sentence made up of the token, its ancestors and its children."""
    related = F.zip_with(ancestors, children, lambda a, c: a + c + 1)
    return let(related, lambda r: F.transform(r, lambda v: v / F.size(r)))


def span_coverage(leftmost: Column, rightmost: Column) -> Column:
    """Per token: (right end of token and children - leftmost ancestor, else token) / length.

    The left end is the leftmost *ancestor* even where the token stands further left, so values
    may be negative.
    """
    spans = F.zip_with(leftmost, rightmost, lambda m, r: r - m)
    return let(spans, lambda s: F.transform(s, lambda v: v / F.size(s)))
