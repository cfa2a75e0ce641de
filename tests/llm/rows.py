"""Small tables with the odd rows that every operator has to take."""

from __future__ import annotations

import random
import re

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "size int, label string, key string, shard int, kept boolean, word string, line string, fp bigint")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    parts = ["the", "re", "on", "ti", "an", "es", "ing", "ou", "wh", "ble"]
    words = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(n)]
    return "".join(w + (".\n" if draw.random() < 0.1 else " ") for w in words)


def documents() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """(doc_id, text, lang, source): prose, copies, NULLs, blanks, a long text, repeated rows."""
    rows = [(i, prose(60 + i, i), "en" if i % 3 else "fr", f"s{i % 4}") for i in range(1, 31)]
    rows += [(40 + i, rows[5][1], "en", "s1") for i in range(4)]
    rows += [(50, None, "en", "s0"), (51, "", "en", "s0"), (52, " \t\n ", None, None), (None, prose(80, 99), "en", "s2")]
    rows += [(None, None, None, None), (53, "é " * 3 + "Straße 😀 x", "de", None), (54, "a b", "en", "s9")]
    rows += [(60, prose(30_000, 7), "en", "s3")]
    rows += [(70, prose(75, 70), "en", "s2")] * 3 + [(70, "other text", "en", "s2")]
    return rows


def table(spark, rows):
    """Rows with more columns, of names that operators might use themselves."""
    full = [(*r, len(r[1] or ""), 1, "x", "k", 2, False, "w", "l", 5) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
