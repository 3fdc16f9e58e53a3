"""Toxicity by a subsequence string-kernel support vector machine.

The kernel of two words sums, over all letter triples ``u``, the product of the
words' weights for ``u``: the sum of ``DECAY ** span`` over all places where
``u`` occurs as a subsequence, gaps included, with a span of at most ``SPAN``;
it is normalised to 1 for equal words and squared.  A word with inserted characters
(``id-i.ot``) thus stays close to the plain one.  Characters that are neither
letters nor digits take a place but match nothing.  Runs of one-character words
are read as one more word (``i d i o t``).  A word or run longer than a landmark
is also compared window by window (``WINDOWS``), so that what stands around an
insult does not hide it.

Landmarks are words and word beginnings of labelled texts that are commoner in label 1, picked to
cover those texts.  A text's kernel with a landmark is the largest over its
words (values under ``FLOOR`` count as 0), and the Nystroem map multiplies these
by the inverse square root of the landmarks' own kernel matrix.  A linear
support vector machine is trained on the mapped texts and its margin is
calibrated with a logistic curve.

Scale: landmarks, machine and curve are fitted on at most ``sample`` labelled
texts (a documented bound; their ids are broadcast).  Scoring is one pass over
the texts without a shuffle; the model is a few kilobytes.  A task works on half a
megabyte of text at a time and on each distinct word once, as long as it
remembers it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, Words, remainder, slices

DECAY, SPAN, FLOOR, POWER = 0.8, 9, 0.4, 2
LANDMARKS, LANDMARK_DOCS, STEM = 64, 5, 5
COVERS, ALIKE = 4, 0.85
#: Labelled texts fitted on, and words among which landmarks are chosen.
SAMPLE, CANDIDATES = 20_000, 1_000
MAX_LANDMARK_BYTES = 40
#: Words compared with the landmarks at once (bounds a task's memory, not the words).
WORD_BLOCK = 4_096
#: Window lengths for a landmark of length l, and bytes of a piece of a long word
#: and of the pieces that are compared at once.
WINDOWS = (lambda l: l + 1 if l > 4 else l + 3, lambda l: 2 * l + 1)
PIECE, PIECE_BLOCK = 512, 16_384
#: Words whose kernels a task remembers; beyond, it forgets them all and starts anew.
REMEMBERED = 200_000
#: Bytes of words whose norms are taken at once, and of text that a task scores at once.
NORM_BLOCK, TEXT_BYTES = 16_384, 1 << 19

_U = np.uint64
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[48:58] = np.arange(27, 37)
_SYMBOL[128:] = 37 + np.arange(128) % 26
_BASE = 63


def _triples(symbols: np.ndarray, left: np.ndarray):
    """``(position, code, weight)`` of the letter triples of concatenated words;
    ``left`` is the number of bytes from a position to its word's end."""
    n = len(symbols)
    for b in range(2, SPAN):
        if b >= n:
            break
        ok = np.flatnonzero((left[:n - b] > b) & (symbols[:n - b] > 0) & (symbols[b:] > 0))
        ends = symbols[ok] * (_BASE * _BASE) + symbols[ok + b]
        for a in range(1, b):
            mid = symbols[ok + a]
            yield ok, ends + mid * _BASE, mid > 0, DECAY ** (b + 1)


def word_vector(word: bytes) -> dict[int, float]:
    s = _SYMBOL[np.frombuffer(word, np.uint8)]
    out: dict[int, float] = {}
    for _, code, ok, weight in _triples(s, np.arange(len(s), 0, -1)):
        for c in code[ok].tolist():
            out[c] = out.get(c, 0.0) + weight
    return out


def word_norms(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Norm of each word's triple vector; the words stand one after the other in ``data``."""
    out = np.zeros(len(length))
    end = np.cumsum(length)
    cuts = np.unique(np.searchsorted(end, np.arange(0, int(length.sum()) + 1, NORM_BLOCK)))
    for lo, hi in zip(cuts, [*cuts[1:], len(length)]):
        if lo == hi:
            continue
        size = length[lo:hi]
        part = data[end[lo] - size[0]:end[hi - 1]]
        stop = np.cumsum(size)
        left = np.repeat(stop, size) - np.arange(len(part))
        first = np.repeat(np.arange(hi - lo), size) * _BASE ** 3
        keys, weights = [], []
        for at, code, ok, weight in _triples(_SYMBOL[part], left):
            keys.append((first[at] + code)[ok])
            weights.append(np.full(len(keys[-1]), weight))
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        if len(key):
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sums = np.add.reduceat(np.concatenate(weights)[order], heads)
            out[lo:hi] = np.sqrt(np.bincount(key[heads] // _BASE ** 3, sums * sums, hi - lo))
    return out


def kernel(a: dict[int, float], b: dict[int, float]) -> float:
    dot = sum(v * b[c] for c, v in a.items() if c in b)
    norm = (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
    return dot / norm if norm else 0.0


def gather(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of several stretches of ``buf``, one after the other."""
    at = np.cumsum(length) - length
    return buf[np.repeat(start - at, length) + np.arange(int(length.sum()))]


@dataclass
class Landmarks:
    """Landmark words with their triples as a table: the triples ``code`` with
    ``row[code] = r > 0`` are in landmarks ``mark[first[r]:first[r + 1]]``."""
    words: list[bytes]
    row: np.ndarray
    first: np.ndarray
    mark: np.ndarray
    weight: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, words: list[bytes]) -> Landmarks:
        vectors = [word_vector(w) for w in words]
        entries = []
        for j, x in enumerate(vectors):
            norm = sum(v * v for v in x.values()) ** 0.5
            entries += [(c, j, v / norm) for c, v in x.items()]
        entries.sort()
        row = np.zeros(_BASE ** 3, np.int32)
        code = np.array([e[0] for e in entries], np.int64)
        codes = np.unique(code)
        row[codes] = np.arange(1, len(codes) + 1)
        first = np.concatenate([[0], np.searchsorted(code, codes), [len(code)]])
        gram = np.array([[kernel(x, y) ** POWER for y in vectors] for x in vectors]).reshape(len(words), len(words))
        root = gram
        if len(words):
            value, vector = np.linalg.eigh(gram)
            root = vector @ np.diag(np.where(value > 1e-6, np.maximum(value, 1e-6) ** -0.5, 0)) @ vector.T
        return cls(words, row, first, np.array([e[1] for e in entries], np.int64),
                   np.array([e[2] for e in entries]), root)

    def of_words(self, data: np.ndarray, length: np.ndarray, may: np.ndarray | None = None
                 ) -> tuple[np.ndarray, np.ndarray]:
        """``(word index, kernel with each landmark)`` of the words that reach
        FLOOR; the words stand one after the other in ``data``.  ``may`` is set to
        whether a window of the word can reach it."""
        at = np.concatenate([[0], np.cumsum(length)])
        blocks = [(lo, *self._of_block(data[at[lo]:at[min(lo + WORD_BLOCK, len(length))]], length[lo:lo + WORD_BLOCK],
                                       None if may is None else may[lo:lo + WORD_BLOCK]))
                  for lo in range(0, max(1, len(length)), WORD_BLOCK)]
        return np.concatenate([lo + live for lo, live, _ in blocks]), np.concatenate([k for _, _, k in blocks])

    def _of_block(self, data: np.ndarray, length: np.ndarray, may: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        n, m = len(length), len(self.words)
        none = np.zeros(0, np.int64), np.zeros((0, m))
        if not n or not m:
            return none
        symbols = _SYMBOL[data]
        end = np.cumsum(length)
        left = np.repeat(end, length) - np.arange(len(symbols))
        word = np.repeat(np.arange(n), length)
        square, place, value = np.zeros(n), [none[0]], [np.zeros(0)]
        for at, code, ok, weight in _triples(symbols, left):
            of = word[at[ok]]
            square += np.bincount(of, minlength=n) * (weight * weight)
            r = self.row[code[ok]]
            hit = np.flatnonzero(r)
            r, of = r[hit], of[hit]
            count = self.first[r + 1] - self.first[r]
            e = gather(np.arange(len(self.mark)), self.first[r], count)
            place.append(np.repeat(of, count) * m + self.mark[e])
            value.append(self.weight[e] * weight)
        dots = np.bincount(np.concatenate(place), np.concatenate(value), n * m).reshape(n, m)
        if may is not None:
            # A window's products are at most the word's.  Where all bytes match something,
            # every window of a width has the same sum of squares.
            plain = np.bincount(word, symbols == 0, n) == 0
            may[:] = ~plain | (dots >= self._window_floor() * 0.999999).any(axis=1)
        # The sum of squares is at most the norm's square: a bound before the exact norm.
        live = np.flatnonzero((dots.max(axis=1) >= FLOOR * np.sqrt(square) * 0.999999) & (square > 0))
        if not len(live):
            return none
        norm = word_norms(gather(data, end[live] - length[live], length[live]), length[live])
        k = dots[live] / norm[:, None]
        return live, np.where(k < FLOOR, 0, k) ** POWER

    def _window_floor(self) -> np.ndarray:
        """Per landmark FLOOR times the root of the sum of squares of its narrowest window."""
        widths = [min(size(len(w)) for size in WINDOWS) for w in self.words]
        return FLOOR * np.array([sum((w - b) * (b - 1) * DECAY ** (2 * b + 2) for b in range(2, min(SPAN, w)))
                                 for w in widths]) ** 0.5

    def of_windows(self, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``of_words``, by the best window of each word that is longer than the
        window.  Long words are cut into pieces that overlap by a window."""
        widths = [np.array([size(len(w)) for w in self.words], np.int64) for size in WINDOWS] if self.words else []
        least = min((int(w.min()) for w in widths), default=0)
        long = np.flatnonzero(length > least) if self.words else np.zeros(0, np.int64)
        if not len(long):
            return long, np.zeros((0, len(self.words)))
        step = PIECE - max(int(w.max()) for w in widths) + 1
        count = 1 + np.maximum(0, -(-(length[long] - PIECE) // step))
        of = np.repeat(np.arange(len(long)), count)
        at = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * step
        start = (np.cumsum(length) - length)[long[of]] + at
        size = np.minimum(length[long[of]] - at, PIECE)
        best = np.zeros((len(long), len(self.words)))
        cuts = np.unique(np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()), PIECE_BLOCK)))
        for lo, hi in zip(cuts, [*cuts[1:], len(size)]):
            row, mark, k = self._of_pieces(gather(data, start[lo:hi], size[lo:hi]), size[lo:hi],
                                           length[long[of[lo:hi]]], widths)
            np.maximum.at(best, (of[lo:hi][row], mark), k)
        live = np.flatnonzero(best.any(axis=1))
        return long[live], best[live]

    def _of_pieces(self, data: np.ndarray, size: np.ndarray, whole: np.ndarray, widths: list[np.ndarray],
                   chosen: bool = False):
        """``(piece, landmark, kernel)`` of the windows that reach FLOOR; ``whole`` is
        the length of each piece's word.  A first look passes over the pieces none of
        whose windows can: a window's products with a landmark are at most the piece's."""
        n, m = len(data), len(self.words)
        end = np.cumsum(size)
        left = np.repeat(end, size) - np.arange(n)
        piece, begin = np.repeat(np.arange(len(size)), size), np.repeat(end - size, size)
        square, hits = np.zeros((SPAN, n)), []
        for at, code, ok, weight in _triples(_SYMBOL[data], left):
            span = round(np.log(weight) / np.log(DECAY))
            at, r = at[ok], self.row[code[ok]]
            square[span - 1, at] += weight * weight
            found = np.flatnonzero(r)
            at, r = at[found], r[found]
            many = self.first[r + 1] - self.first[r]
            e = gather(np.arange(len(self.mark)), self.first[r], many)
            hits.append((np.repeat(at, many), np.full(len(e), span), self.mark[e], self.weight[e] * weight))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if not hits:
            return out[0]
        at, span, mark, value = (np.concatenate(x) for x in zip(*hits))
        total = np.concatenate([np.zeros((SPAN, 1)), np.cumsum(square, axis=1)], axis=1)

        def starts(w: int) -> tuple[np.ndarray, np.ndarray]:
            """Where a window of ``w`` bytes starts, and its sum of squares: at most the
            norm's square, as in _of_block."""
            s = np.flatnonzero((left >= w) & (whole[piece] > w))
            bound = sum(total[b, s + w - b] - total[b, s] for b in range(2, min(SPAN, w)))
            return s, np.maximum(bound, 0) + np.zeros(len(s))

        if not chosen:
            most = np.bincount(piece[at] * m + mark, value, len(size) * m).reshape(len(size), m)
            may = np.zeros(len(size), bool)
            for w in np.unique(np.concatenate(widths)).tolist():
                s, bound = starts(w)
                if len(s):
                    least = np.full(len(size), np.inf)
                    np.minimum.at(least, piece[s], bound)
                    of_width = most[:, np.flatnonzero((widths[0] == w) | (widths[1] == w))].max(axis=1)
                    may |= (of_width >= FLOOR * np.sqrt(least) * 0.999999) & (of_width > 1e-6)
            left_over = np.flatnonzero(may)
            if not len(left_over):
                return out[0]
            row, marks, k = self._of_pieces(gather(data, (end - size)[left_over], size[left_over]), size[left_over],
                                            whole[left_over], widths, chosen=True)
            return left_over[row], marks, k
        for width in widths:
            # A triple is in the windows that start between its end less the width and its start.
            fits = span <= width[mark]
            a, j, v = at[fits], mark[fits], value[fits]
            lo = np.maximum(a + span[fits] - width[j], begin[a])
            dots = np.bincount(np.concatenate([lo * m + j, (a + 1) * m + j]), np.concatenate([v, -v]), (n + 1) * m)
            dots = np.cumsum(dots.reshape(n + 1, m), axis=0)
            for w in np.unique(width).tolist():
                s, bound = starts(w)
                marks = np.flatnonzero(width == w)
                d = dots[np.ix_(s, marks)]
                x, y = np.nonzero((d >= FLOOR * np.sqrt(bound)[:, None] * 0.999999) & (d > 1e-6))
                if len(x):
                    # equal windows have one norm
                    begins, which = np.unique(x, return_inverse=True)
                    windows = data[s[begins][:, None] + np.arange(w)]
                    _, first, same = np.unique(windows.view(f"V{w}").ravel(), return_index=True, return_inverse=True)
                    norm = word_norms(windows[first].ravel(), np.full(len(first), w))[same][which]
                    k = d[x, y] / norm
                    ok = k >= FLOOR
                    out.append((piece[s[x[ok]]], marks[y[ok]], k[ok] ** POWER))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _kernels(self, hashes: np.ndarray, buf: np.ndarray, start: np.ndarray, length: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """For distinct words (by ascending hash) the place of each one's kernels in the
        returned rows, -1 for a word far from all landmarks.  Words met before in the
        same task are not compared again."""
        seen, live, rows = self.__dict__.get("_met") or (np.zeros(0, _U), np.zeros(0, _U), np.zeros((0, len(self.words))))
        if len(seen) > REMEMBERED:
            seen, live, rows = seen[:0], live[:0], rows[:0]
        to = np.searchsorted(seen, hashes)
        new = np.flatnonzero((to == len(seen)) | (seen[np.minimum(to, len(seen) - 1)] != hashes) if len(seen)
                             else np.ones(len(hashes), bool))
        if len(new):
            data, size = gather(buf, start[new], length[new]), length[new]
            fresh = np.zeros((len(new), len(self.words)))
            may = np.zeros(len(new), bool)
            at, fresh_rows = self.of_words(data, size, may)
            fresh[at] = fresh_rows
            again = np.flatnonzero(may)
            at, k = self.of_windows(gather(buf, start[new[again]], size[again]), size[again])
            fresh[again[at]] = np.maximum(fresh[again[at]], k)
            seen = np.insert(seen, to[new], hashes[new])
            near = np.flatnonzero(fresh.any(axis=1))
            to = np.searchsorted(live, hashes[new[near]])
            live, rows = np.insert(live, to, hashes[new[near]]), np.insert(rows, to, fresh[near], axis=0)
            self.__dict__["_met"] = seen, live, rows
        place = np.searchsorted(live, hashes)
        found = live[np.minimum(place, len(live) - 1)] == hashes if len(live) else np.zeros(len(hashes), bool)
        return np.where(found, place, -1), rows

    def of_texts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The Nystroem-mapped kernel row of each text of a slice."""
        n = len(offsets) - 1
        best = np.zeros((n, len(self.words)))
        words = Words(buf, offsets)
        if len(words.hash) and self.words:
            hashes, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
            text = np.repeat(np.arange(n), np.diff(words.first))
            place, rows = self._kernels(hashes, buf, words.start[first], words.end[first] - words.start[first])
            at = place[inverse]
            hit = np.flatnonzero(at >= 0)
            np.maximum.at(best, text[hit], rows[at[hit]])
            # Runs of three or more words of one character of a text.
            chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
            single = (chars[words.end] - chars[words.start] == 1).astype(np.int8)
            step = np.diff(np.concatenate([[0], single, [0]]))
            runs, ids = [], []
            for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
                cuts = [a, *words.first[(words.first > a) & (words.first < b)].tolist(), b] if b - a >= 3 else []
                for x, y in zip(cuts, cuts[1:]):
                    if y - x >= 3:
                        runs.append(gather(buf, words.start[x:y], words.end[x:y] - words.start[x:y]))
                        ids.append(text[x])
            if runs:
                data, length = np.concatenate(runs), np.array([len(r) for r in runs])
                for live, k in (self.of_words(data, length), self.of_windows(data, length)):
                    np.maximum.at(best, np.array(ids, np.int64)[live], k)
        return best @ self.root


@dataclass
class Model:
    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margin = self.landmarks.of_texts(buf, offsets) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -700, 700)))


def _mapped(landmarks: Landmarks):
    def run(batches):
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text", TEXT_BYTES):
                x = landmarks.of_texts(buf, offsets)
                yield pa.RecordBatch.from_arrays([rows.column("label"), pa.array(list(x), pa.list_(pa.float64()))],
                                                 ["label", "x"])
    return run


def stems(words):
    """Distinct words and their first ``STEM`` letters: word families with many endings."""
    return F.array_distinct(F.concat(words, F.transform(words, lambda w: F.substring(w, 1, STEM))))


def cover(candidates: list[tuple[str, set, float]], size: int) -> list[bytes]:
    """Words picked one by one for the label-1 texts they add less the (scaled)
    label-0 texts they are in.  A text counts until ``COVERS`` of its words are
    picked, so that a group of copies brings few words, and near variants
    (kernel over ``ALIKE``) of a picked word are passed over."""
    left = {w: (set(of), q, word_vector(w.encode())) for w, of, q in candidates}
    left = {w: x for w, x in left.items() if x[2]}
    covered: dict[int, int] = {}
    out = []
    while left and len(out) < size:
        w = min(left, key=lambda w: (left[w][1] - len(left[w][0]), w))
        of, q, vector = left.pop(w)
        if len(of) - q < 2:
            break
        out.append(w.encode())
        full = set()
        for n in of:
            covered[n] = covered.get(n, 0) + 1
            if covered[n] == COVERS:
                full.add(n)
        for other, x in list(left.items()):
            x[0].difference_update(full)
            if kernel(vector, x[2]) > ALIKE:
                del left[other]
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE,
        landmarks: int = LANDMARKS, candidates: int = CANDIDATES) -> Model:
    """Train on about ``sample`` labelled documents (all, if fewer), drawn by a hash
    of their ids.  Null ids, labels and texts are left out.  With no label of a
    class the model gives every text the share of label 1 (0 without labels)."""
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from strata.llm.common import keep_table

    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
           .where("doc_id IS NOT NULL AND label IN (0, 1)"))
    share = min(1.0, sample / max(1, ids.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / (1 << 30)
    ids = keep_table(ids.where(draw < share), "labelled")  # about `sample` narrow rows: bounded, so broadcast
    texts = keep_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
                       .join(F.broadcast(ids), "doc_id")
                       .select("label", "text", F.monotonically_increasing_id().alias("n"))
                       .repartition(max(2, docs.sparkSession.sparkContext.defaultParallelism)), "texts")
    n = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        share = pos / (pos + neg) if pos + neg else 0.0
        shift = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return Model(Landmarks.of([]), np.zeros(0), 0.0, 0.0, shift)
    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\s]", "")
    words = (texts.select("label", "n", F.explode(stems(F.split(plain, BLANKS))).alias("w"))
             .where(f"length(w) >= 3 AND octet_length(w) <= {MAX_LANDMARK_BYTES}"))
    counts = (words.groupBy("w").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
              .where(f"p + q >= {LANDMARK_DOCS}"))
    odds = F.log((F.col("p") + 0.5) / (pos + 1)) - F.log((F.col("q") + 0.5) / (neg + 1))
    best = counts.where(odds > 0).withColumn("z", odds * F.sqrt("p")).orderBy(F.desc("z"), "w").limit(candidates)
    seen = (words.join(F.broadcast(best.select("w", "z")), "w")
            .groupBy("w", "z").agg(F.collect_list(F.when(F.col("label") == 1, F.col("n"))).alias("of"),
                                   F.sum(1 - F.col("label")).alias("q")).collect())
    chosen = cover([(r["w"], set(r["of"]), r["q"] * pos / neg) for r in seen], landmarks)
    marks = Landmarks.of(chosen)
    if not chosen:
        return Model(marks, np.zeros(0), 0.0, 0.0, float(np.log(pos / neg)))
    train = texts.mapInArrow(_mapped(marks), "label int, x array<double>")
    train = keep_table(train, "mapped").select(F.col("label").cast("double").alias("label"),
                                               array_to_vector("x").alias("features")).cache()
    svm = LinearSVC(maxIter=40, regParam=1e-3, standardization=False).fit(train)
    weights, bias = svm.coefficients.toArray(), float(svm.intercept)
    dot = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b),
                      F.lit(0.0), lambda a, b: a + b) + bias
    from pyspark.ml.functions import vector_to_array
    margins = train.select("label", vector_to_array("features").alias("x")).select(
        "label", array_to_vector(F.array(dot)).alias("features"))
    curve = LogisticRegression(maxIter=50, regParam=1e-6).fit(margins)
    train.unpersist()
    return Model(marks, weights, bias, float(curve.coefficients[0]), float(curve.intercept))


def with_score(docs: DataFrame, model: Model, column: str = "toxic_score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of its ``text``; a null or
    blank text is scored as one without words.  A column of that name is replaced."""
    docs = docs.drop(column)

    def run(batches):
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text", TEXT_BYTES):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(model.score(buf, offsets))],
                                                 [*rows.schema.names, column])
    from pyspark.sql.types import DoubleType, StructType
    schema = StructType(list(docs.schema.fields)).add(column, DoubleType())
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per document; labels of documents
    whose crc32(id) modulo ``folds`` is ``fold`` are not learnt from."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, labels.where(remainder("doc_id", folds) != fold))
    return with_score(docs, model, "score").select(
        "doc_id", F.coalesce(remainder("doc_id", folds) == fold, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents (all columns) scored under ``threshold``."""
    name = "_toxic_score"
    while name in docs.columns:
        name += "_"
    return with_score(docs, fit(docs, labels), name).where(F.col(name) < threshold).drop(name)
