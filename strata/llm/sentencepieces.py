"""Sampled SentencePiece encoding and lossless decoding.

The forward filter sums the weights of all segmentations of each segment; the
backward pass draws a segmentation from its end, each piece in proportion to
the weight of all segmentations that it leaves open.  Draws are hashes of the
seed, the row's key and the byte position, so a row gets the same pieces in any
partition, batch or run.  Weights follow the public vocabulary's order of
pieces (Zipf's law), to the power ``sharpness``.

Scale: one pass each way without a shuffle; the vocabulary is of fixed size and
broadcast; a task works on one or two megabytes of text at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mix, slices
from strata.llm.lattice import (TILT, VOCABULARY, Segments, Vocabulary, forward_parts, long_forward,
                                panel_pieces, panel_weight, panels, piece_matrix)

_U = np.uint64


def _seeds(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The keys moved on by ``at`` bytes."""
    return key + at.astype(_U) * _U(0x9E3779B97F4A7C15)


def _uniform(seed: np.ndarray) -> np.ndarray:
    return (mix(seed) >> _U(11)).astype(np.float64) * 2.0 ** -53


def _draws(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each text's key and byte position."""
    return _uniform(_seeds(key, at))


def _sample_long(vocabulary, weight, matrix, length, key, first):
    """For long segments that begin at byte ``first`` of texts seeded by ``key``:
    rows, positions and pieces of a sampled segmentation.  The length that would end
    at each position is drawn for all positions of a panel, then the drawn lengths
    are followed back from the end."""
    alpha = long_forward(vocabulary, matrix, length, weight, TILT)
    wide, at_end = vocabulary.longest, length.tolist()
    for lo, hi in reversed(panels(len(matrix), matrix.shape[1] - 1)):  # ends lo + 1 to hi
        left = max(0, lo + 1 - wide)
        pieces = panel_pieces(vocabulary, matrix, length, left, hi)
        share = panel_weight(pieces, weight, TILT)
        end = np.arange(lo + 1, hi + 1)
        begin = end[:, None] - np.arange(1, wide + 1)
        l_index = np.arange(wide)
        ids = np.where(begin >= 0, pieces[:, begin - left, l_index], -1)
        inside = end <= length[:, None]
        with np.errstate(invalid="ignore"):
            part = share[:, begin - left, l_index] * np.exp(alpha[:, np.maximum(begin, 0)] - alpha[:, end][:, :, None])
        cum = np.cumsum(np.where((ids >= 0) & inside[:, :, None], part, 0), axis=2)
        u = _draws(key[:, None], first[:, None] + end) * cum[:, :, -1]
        chosen = (cum[:, :, :-1] <= u[:, :, None]).sum(axis=2)
        picked = np.take_along_axis(ids, chosen[:, :, None], axis=2)[:, :, 0]
        while (inside & (picked < 0)).any():  # rounding only: step back to a length that has a piece
            chosen = np.where(inside & (picked < 0), chosen - 1, chosen)
            picked = np.take_along_axis(ids, chosen[:, :, None], axis=2)[:, :, 0]
        rows, places = [], []
        for r, steps in enumerate((chosen + 1).tolist()):
            e = at_end[r]
            while e > lo:
                rows.append(r)
                places.append(e)
                e -= steps[e - lo - 1]
            at_end[r] = e
        rows, places = np.array(rows, np.int64), np.array(places, np.int64)
        yield rows, places - chosen[rows, places - lo - 1] - 1, picked[rows, places - lo - 1]


def sample_pieces(vocabulary: Vocabulary, weight: np.ndarray, buf: np.ndarray, offsets: np.ndarray,
                  keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(pieces, first)``: the pieces of all texts of a slice and where each text's
    begin; ``keys`` seeds each text."""
    at_byte = np.full(len(buf), -1, np.int32)
    segments = Segments(buf, offsets)
    tilted = np.append(weight * TILT ** vocabulary.length, 0.0)
    for of, matrix, row in segments.groups():
        rows, size = matrix.shape
        pieces = piece_matrix(vocabulary, matrix)
        parts = forward_parts(pieces, tilted)
        # All pieces in one array: of length l at byte i of row r at ``base[l - 1] + i * rows + r``.
        base = np.cumsum([0, *(p.size for p in pieces)])
        ids_of = np.concatenate([p.T.ravel() for p in pieces])
        start, text = segments.start[of], segments.text[of]
        seed = _seeds(keys[text], start - offsets[text])
        pos = np.full(len(of), size, np.int8)
        for e in range(size, 0, -1):
            here = np.flatnonzero(pos == e)
            if not len(here):
                continue
            r, part = row[here], parts[e - 1]
            u = _uniform(_seeds(seed[here], np.array([e]))) * part[-1][r]
            l = np.ones(len(here), np.int8)
            for shorter in part[:-1]:
                l += shorter[r] <= u
            ids = ids_of[base[l - 1] + (e - l.astype(np.int64)) * rows + r]
            while (ids < 0).any():  # rounding only: step back to a length that has a piece
                l = np.where(ids < 0, l - 1, l)
                ids = ids_of[base[l - 1] + (e - l.astype(np.int64)) * rows + r]
            pos[here] = e - l
            at_byte[start[here] + e - l] = ids
    for of, matrix, length in segments.long_groups():
        start, text = segments.start[of], segments.text[of]
        for r, at, ids in _sample_long(vocabulary, weight, matrix, length, keys[text], start - offsets[text]):
            at_byte[start[r] + at] = ids
    filled = np.flatnonzero(at_byte >= 0)
    return at_byte[filled], np.searchsorted(filled, offsets)


def encode(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", seed: int = 1,
           sharpness: float = 0.7, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(key, text, pieces)`` per row: one sampled segmentation, as ids of the
    vocabulary.  An empty text has no pieces, a null text null pieces; a null key
    draws as one more key; rows that repeat a key and a text get equal pieces.
    Other columns are not read."""
    vocab = Vocabulary.load(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(
        (vocab.pieces, vocab.is_byte, vocab.byte_id, vocab.usable, vocab.rank))
    docs = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    key_type = docs.schema["key"].dataType.simpleString()
    hashed = docs.withColumn("draw", F.xxhash64(F.lit(seed), F.col("key").cast("string")))

    def run(batches):
        v = Vocabulary(*shared.value)
        weight = v.zipf(sharpness)
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text", 1 << 20):
                keys = rows.column("draw").to_numpy(zero_copy_only=False).view(_U)
                ids, first = sample_pieces(v, weight, buf, offsets, keys)
                text = rows.column("text")
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()),
                                                 mask=text.is_null() if text.null_count else None)
                yield pa.RecordBatch.from_arrays([rows.column("key"), text, lists], ["key", "text", "pieces"])
    return hashed.mapInArrow(run, f"key {key_type}, text string, pieces array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns and ``decoded``, the text that ``pieces`` spell (null: null)."""
    vocab = Vocabulary.load(vocabulary)
    shared = encoded.sparkSession.sparkContext.broadcast(
        (vocab.pieces, vocab.is_byte, vocab.byte_id, vocab.usable, vocab.rank))
    encoded = encoded.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches):
        v = Vocabulary(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                col = part.column("pieces")
                first = col.offsets.to_numpy().astype(np.int64)
                ids = col.values.to_numpy(zero_copy_only=False)[first[0]:first[-1]]
                ends = np.concatenate([[0], np.cumsum(v.length[ids])])[first - first[0]]
                text = pa.StringArray.from_buffers(len(part), pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                   pa.py_buffer(v.decode(ids).tobytes()))
                if col.null_count:
                    text = pa.array([None if n else t for n, t in
                                     zip(col.is_null().to_pylist(), text.to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, "decoded"])
    return encoded.mapInArrow(run, f"{fields}, decoded string")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, pieces, n_pieces, lossless)``: the sampled pieces and whether
    decoding gives the text back."""
    back = decode(encode(docs, **options))
    return back.select(F.col("key").alias("doc_id"), "pieces",
                       F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))
