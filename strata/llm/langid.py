"""Language identification by segmentation-marginalised unigrams.

Each language has a distribution over the pieces of a fixed public vocabulary.
The likelihood of a text is the sum over all its segmentations into pieces,
found by the forward algorithm on each segment; no segmentation is chosen.
Piece probabilities come from one expectation step: expected piece counts over
all segmentations under the vocabulary's own rank weights, smoothed by these.

Scale: the model is fitted on about ``per_language`` labelled texts of each
language (a documented bound, taken by a hash of the id); expected counts are
summed in Spark and are as many as languages times pieces.  Scoring is one pass
without a shuffle, on the distinct segments of a slice of text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import remainder, slices
from strata.llm.lattice import (TILT, VOCABULARY, LongBackward, Segments, Vocabulary, forward, long_forward,
                                long_likelihood, panel_pieces, panel_weight, panels, piece_matrix)

PER_LANGUAGE = 3_000
SMOOTHING = 2_000.0
UNDETERMINED = "und"


def expected_counts(vocabulary: Vocabulary, weight: np.ndarray, buf: np.ndarray, offsets: np.ndarray,
                    label: np.ndarray, labels: int) -> np.ndarray:
    """Expected piece counts per label, over all segmentations of each segment."""
    counts = np.zeros((labels, len(weight)))
    segments = Segments(buf, offsets)
    for of, matrix, row in segments.groups():
        n, size = matrix.shape
        pieces = piece_matrix(vocabulary, matrix)
        alpha, _ = forward(pieces, weight, TILT)
        beta = np.zeros((n, size + 1))
        beta[:, size] = 1
        for i in range(size - 1, -1, -1):
            for l in range(1, min(size - i, len(pieces)) + 1):
                p = pieces[l - 1][:, i]
                beta[:, i] += np.where(p >= 0, weight[p], 0) * TILT ** l * beta[:, i + l]
        times = np.bincount(row * labels + label[segments.text[of]], minlength=n * labels).reshape(n, labels)
        scale = times / alpha[:, size:]
        for l in range(1, len(pieces) + 1):
            at = np.nonzero(pieces[l - 1] >= 0)
            p = pieces[l - 1][at]
            share = alpha[at[0], at[1]] * weight[p] * TILT ** l * beta[at[0], at[1] + l]
            for k in range(labels):
                counts[k] += np.bincount(p, share * scale[at[0], k], len(weight))
    for of, matrix, length in segments.long_groups():
        alpha = long_forward(vocabulary, matrix, length, weight, TILT)
        whole, of_label = alpha[np.arange(len(of)), length], label[segments.text[of]]
        back = LongBackward(length, vocabulary.longest)
        for lo, hi in reversed(panels(*matrix.shape)):
            pieces = panel_pieces(vocabulary, matrix, length, lo, hi)
            w = panel_weight(pieces, weight, TILT)
            beta = back.step(w, lo)
            r, i, l = np.nonzero(pieces >= 0)
            share = w[r, i, l] * np.exp(alpha[r, lo + i] + beta[r, i + l + 1] - whole[r])
            for k in range(labels):
                of_k = of_label[r] == k
                counts[k] += np.bincount(pieces[r, i, l][of_k], share[of_k], len(weight))
    return counts


def log_likelihood(vocabulary: Vocabulary, weights: list[np.ndarray], buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each text of a slice under each distribution."""
    out = np.zeros((len(offsets) - 1, len(weights)))
    segments = Segments(buf, offsets)
    for of, matrix, row in segments.groups():
        pieces = piece_matrix(vocabulary, matrix)
        text = segments.text[of]
        for k, w in enumerate(weights):
            out[:, k] += np.bincount(text, forward(pieces, w, TILT)[1][row], len(out))
    for of, matrix, length in segments.long_groups():
        np.add.at(out, segments.text[of], long_likelihood(vocabulary, matrix, length, weights, TILT))
    return out


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    piece: np.ndarray  # probabilities, one row a language


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, vocabulary: str = VOCABULARY) -> Model:
    """Learn from ``text`` and ``lang`` of documents; rows with a null id, text or
    language teach nothing.  Without any, the model knows no language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(n)
    vocab = Vocabulary.load(vocabulary)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, len(vocab.pieces))))
    spark = docs.sparkSession
    rate = spark.createDataFrame([(k, i, min(1.0, per_language / n[k])) for i, k in enumerate(languages)],
                                 "lang string, label int, rate double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / (1 << 30)
    sample = rows.join(F.broadcast(rate), "lang").where(draw < F.col("rate")).select("label", "text")
    shared = spark.sparkContext.broadcast((vocab.pieces, vocab.is_byte, vocab.byte_id, vocab.usable, vocab.rank))
    size = len(languages)

    def run(batches):
        v = Vocabulary(*shared.value)
        weight, total = v.zipf(), np.zeros((size, len(v.pieces)))
        for batch in batches:
            for part, buf, offsets in slices(batch, "text", 1 << 20):
                total += expected_counts(v, weight, buf, offsets, part.column("label").to_numpy(), size)
        label, piece = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(piece, pa.int32()),
                                          pa.array(total[label, piece])], ["label", "piece", "count"])
    counts = (sample.mapInArrow(run, "label int, piece int, count double")
              .groupBy("label", "piece").agg(F.sum("count").alias("count")).toPandas())
    table = np.zeros((size, len(vocab.pieces)))
    table[counts["label"], counts["piece"]] = counts["count"]
    table += SMOOTHING * vocab.zipf()
    prior = np.array([n[k] for k in languages], float)
    return Model(languages, prior / prior.sum(), table / table.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: Model, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row; ``score`` is the posterior
    probability.  Null texts and texts without a letter are ``und`` with score 0;
    so is every text if the model knows no language.  Only the text is read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if not model.languages:
        return docs.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    vocab = Vocabulary.load(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(
        ((vocab.pieces, vocab.is_byte, vocab.byte_id, vocab.usable, vocab.rank), model))

    def run(batches):
        parts, m = shared.value
        v = Vocabulary(*parts)
        names = np.array(m.languages, object)
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text", 1 << 20):
                ll = log_likelihood(v, list(m.piece), buf, offsets) + np.log(m.prior)
                best = ll.argmax(axis=1)
                score = 1 / np.exp(ll - ll.max(axis=1, keepdims=True)).sum(axis=1)
                known = rows.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array(np.where(known, names[best], UNDETERMINED), pa.string()),
                    pa.array(np.where(known, score, 0.0))], ["doc_id", "lang_pred", "score"])
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language(docs: DataFrame, fold: int = 0, folds: int = 5) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``; documents whose crc32(id) modulo
    ``folds`` is ``fold`` are held out of the training."""
    model = fit(docs.where(remainder("doc_id", folds) != fold))
    return predict(docs, model).select("doc_id", F.coalesce(remainder("doc_id", folds) == fold, F.lit(False)).alias("held_out"),
                                       "lang_pred", "score")
