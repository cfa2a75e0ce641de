"""Text expressions: sentences, tokens, pairs, titles, word lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. White space as text tools outside the JVM see it: the ASCII blanks, the separator
# control characters, NEL and every Unicode space separator.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
SENTENCE_END = r"([.!?])\s+"
CUT = "\x01"


def trim_space(text: Column) -> Column:
    """Strip white space of every kind from both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def first_field(line: Column) -> Column:
    """First white-space-separated field of a line, lower-cased."""
    return F.lower(F.regexp_extract(trim_space(line), r"^([^\s\x0b\x1c-\x1f\x85\p{Z}]*)", 1))


def doc_title(header: Column) -> Column:
    """Title attribute of an article header line (the last one on the line); NULL without one."""
    return F.when(
        header.contains('title="'), F.regexp_extract(header, r'(?s).*title="([^"]*)', 1)
    )


def split_sentences(text: Column) -> Column:
    """Array of sentences: a cut follows a full stop, ! or ? and white space."""
    return F.split(F.regexp_replace(text, SENTENCE_END, "$1" + CUT), CUT)


def split_tokens(sentence: Column) -> Column:
    """Array of tokens: runs of letters and digits, and every other visible character alone."""
    return F.regexp_extract_all(sentence, F.lit(TOKEN), F.lit(0))


def lower_all(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def is_letters(token: Column) -> Column:
    return token.rlike(r"^\p{L}+$")


def is_alphanumeric(token: Column) -> Column:
    return token.rlike(r"^[\p{L}\p{N}]+$")


def pair_parts(sentence: Column) -> tuple[Column, Column]:
    """Split ``a ||| b`` at the last separator; without one, ``a`` is the sentence and ``b`` NULL.

    Neither part may hold a line break.
    """
    pattern = r"^([^\n]*) \|\|\| ([^\n]*)\n?\z"
    hit = sentence.contains(" ||| ") & sentence.rlike(pattern)
    return (
        F.when(hit, F.regexp_extract(sentence, pattern, 1)).otherwise(sentence),
        F.when(hit, F.regexp_extract(sentence, pattern, 2)),
    )


def requested_words(words: str) -> Column:
    """Array of the distinct words of a hyphen-separated list."""
    return F.array_distinct(F.split(F.lit(words), "-"))


def word_of_id(unique_id: Column) -> Column:
    """Word part of a running id ``word-n``: the text before the first hyphen."""
    return F.substring_index(unique_id, "-", 1)


def strip_running_number(unique_id: Column) -> Column:
    """Running id without its ``-n`` parts."""
    return F.regexp_replace(unique_id, r"-\d*", "")
