"""Features of a user's model: packed sequences in, vectors at the positions of the wanted words out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark import schemas
from lexspark.functions import sequences as S
from lexspark.functions import vectors
from lexspark.operators import sequences
from lexspark.operators.vectors import ENCODER_BATCH, LAYERS


@dataclass
class Batch:
    """Packed sequences of equal length: one row each."""

    input_ids: np.ndarray
    input_mask: np.ndarray
    input_type_ids: np.ndarray


# gets the batches of one task one after the other, so that a model is loaded once per task; yields for
# each batch an array of (rows, layers, positions, dimensions), layers in the order they were asked for
Encoder = Callable[[Iterator[Batch]], Iterator[np.ndarray]]


def packed_examples(inputs: DataFrame, vocabulary: DataFrame, max_len: int = S.MAX_SEQ_LENGTH) -> DataFrame:
    """(word, unique_id, text_a, text_b, sentence) -> the same examples split into pieces, cut and packed:
    (word, unique_id, sentence, tokens, input_ids, input_mask, input_type_ids)."""
    pieces = sequences.tokenize(inputs, "unique_id", ["text_a", "text_b"], vocabulary).withColumnsRenamed(
        {"text_a": "tokens_a", "text_b": "tokens_b"})
    packed = sequences.pack(pieces, vocabulary, max_len)
    return packed.join(inputs.select("unique_id", "word", "sentence"), "unique_id")


def model_features(
    packed: DataFrame, encoder: Encoder, words: Sequence[str] | None = None, indexes: Sequence[int] = LAYERS, *,
    full_output: bool = False, own_word: str | None = None, batch_size: int = ENCODER_BATCH,
) -> DataFrame:
    """Feature records (linex_index, original_sentence, features) of packed sequences.

    ``packed`` has unique_id, sentence, tokens, input_ids, input_mask, input_type_ids. A record keeps the
    features of the tokens among ``words``, or equal to the row's own word in the column ``own_word``;
    ``full_output`` keeps all tokens and all layers, else the first of ``indexes`` is kept. Positions are
    those of the packed tokens: a word that was cut off or split into pieces has no feature. Values are
    rounded to six decimals.
    """
    kept_layers = list(indexes) if full_output else list(indexes)[:1]
    own = F.col(own_word) if own_word else F.lit(None).cast("string")
    read = packed.select("unique_id", "sentence", "tokens", own.alias("own"), "input_ids", "input_mask", "input_type_ids")
    wanted = None if words is None else set(words)
    kind = pa.list_(pa.struct([("token", pa.string()), ("layers", pa.list_(pa.struct([
        ("index", pa.int32()), ("values", pa.list_(pa.float64()))])))]))

    def places(tokens: list[str], word: str | None) -> list[int]:
        if full_output:
            return list(range(len(tokens)))
        if own_word:
            return [i for i, t in enumerate(tokens) if t == word]
        return list(range(len(tokens))) if wanted is None else [i for i, t in enumerate(tokens) if t in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []

        def feed() -> Iterator[Batch]:
            for arrow in batches:
                for at in range(0, len(arrow), batch_size):
                    part = arrow.slice(at, batch_size)
                    waiting.append(part)
                    yield Batch(*[c.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1) for c in part.columns[4:]])

        for values in encoder(feed()):
            part = waiting.pop(0)
            rounded = np.round(np.asarray(values, float), vectors.DECIMALS)
            features = []
            for row, (tokens, word) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                features.append([{"token": tokens[i], "layers": [
                    {"index": index, "values": rounded[row, n, i]} for n, index in enumerate(kept_layers)]}
                    for i in places(tokens, word)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(features, kind)], schemas.FEATURE_RECORD.names)

    return read.mapInArrow(run, schemas.FEATURE_RECORD)
