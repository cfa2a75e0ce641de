"""The words of a text: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as bigint, 0 for NULL."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    kept = F.translate(gaps, SPACES, "")
    return F.length(kept).cast("bigint")
