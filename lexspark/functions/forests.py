"""Measures of dependency trees for whole Arrow batches of sentences.

The same measures as in :mod:`lexspark.functions.trees`, which are column expressions of one sentence.
Here the heads of all sentences of a batch are one flat array, and n log n steps over it serve them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Forest:
    """The trees of a batch as one forest: indexes run over the whole batch; NULL heads have no tokens."""

    def __init__(self, heads: pa.ListArray):
        self.sizes = pc.fill_null(heads.value_lengths(), 0).to_numpy().astype(np.int64)
        self.first = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.own = np.arange(len(self.first))
        self.up = heads.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + self.first

    def climb(self, values: np.ndarray, merge: np.ufunc) -> np.ndarray:
        """Pointer doubling: merge every token's value with those of all its ancestors.

        After r rounds a token has seen its 2^r nearest ancestors. Only tokens that have not reached a
        root go on, so that one long sentence does not slow down the others.
        """
        up, values = self.up.copy(), values.copy()
        going = np.flatnonzero(up[up] != up)
        while len(going):
            ahead = up[going]
            values[going] = merge(values[going], values[ahead])
            up[going] = up[ahead]
            going = going[up[up[going]] != up[going]]
        return values

    def ancestors(self) -> np.ndarray:
        return self.climb((self.up != self.own).astype(np.int64), np.add)

    def children(self) -> np.ndarray:
        return np.bincount(self.up[self.up != self.own], minlength=len(self.up))

    def leftmost(self) -> np.ndarray:
        """Smallest index among a token's ancestors; a root's own."""
        return self.climb(self.up, np.minimum)

    def rightmost(self) -> np.ndarray:
        """Largest index among a token and its children."""
        right = self.own.copy()
        np.maximum.at(right, self.up, self.own)
        return right

    def simplicity(self) -> np.ndarray:
        return (self.ancestors() + self.children() + 1) / np.repeat(self.sizes, self.sizes)

    def coverage(self) -> np.ndarray:
        return (self.rightmost() - self.leftmost()) / np.repeat(self.sizes, self.sizes)


def sentence_rows(batch: pa.RecordBatch, measures: list[str]) -> pa.RecordBatch:
    """The batch with one more column of arrays per measure; its last column holds the heads."""
    forest = Forest(batch.columns[-1])
    offsets = pa.array(np.r_[0, np.cumsum(forest.sizes)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(getattr(forest, m)())) for m in measures]
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], [*batch.schema.names[:-1], *measures])


def token_rows(batch: pa.RecordBatch, measures: list[str]) -> pa.RecordBatch:
    """One row per token: the columns of its sentence, its place, its word, and the measures asked for.

    The batch ends with the columns ``words`` and ``heads``.
    """
    words, heads = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    forest = Forest(heads)
    sentence = pa.array(np.repeat(np.arange(len(batch)), forest.sizes))
    columns = [c.take(sentence) for c in batch.columns[:-2]]
    columns += [pa.array((forest.own - forest.first).astype(np.int32)), words.flatten()]
    columns += [pa.array(getattr(forest, m)()) for m in measures]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "tok_id", "word", *measures])
