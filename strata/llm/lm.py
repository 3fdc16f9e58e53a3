"""A hidden Markov language model, trained by Baum-Welch over all training texts.

Hidden states move by a transition matrix and emit word classes: the end mark and
every training word seen ``OWN_COUNT`` times or more have a class of their own (of
more than ``LISTED`` such words the commonest), all other words (unknown ones too)
share classes by hash.  Within a shared class a word has the
chance ``(c + 1) / (N + V + 1)`` of its training count, the class's tokens and
its distinct words, one of the ``V + 1`` being for unknown words.  The
probability of a text is thus that of its class sequence, exact by the scaled
forward recursion, times those of its words within their classes.

Training stops once a round adds less than ``GAIN`` to the training texts' mean
log10 probability of a token, after ``ROUNDS`` rounds at the latest.

Scale: counts are summed map-side by task, then over the cluster, into a table
that grows with the vocabulary.  The ``LISTED`` commonest words with their
counts (a fixed number) are broadcast and cover most tokens; the rest of a
text's words meet the table in a shuffle join on the word, so the whole
vocabulary is used.  Every Baum-Welch round is one pass over the class
sequences (four bytes a token); its counts are summed in Spark and are at most as
many as states times classes.  A task runs the recursions of about a million tokens
in step, sorted by length, rescaled every few tokens; scoring keeps no variables
of past tokens.  A text of ``LONG`` tokens is cut into pieces that run in
step too: a piece's product of moves and emissions, from every state, carries the
forward and backward variables over it, so nothing changes but the order of sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, keep_table, mix, remainder, slices

STATES, OWN_COUNT, SHARED = 8, 5, 2048
LISTED, ROUNDS, GAIN = 100_000, 12, 0.005
#: A state's emissions are smoothed by the class frequencies, as many tokens of them as
#: this share of a state's mean tokens (and one).
SMOOTH = 0.02
#: Start of the training: the chance to stay in a state, and the spread of the states' emissions.
STAY, SPREAD = 0.99, 2.0
CLASSES = LISTED + SHARED + 1  # at most
STEP_TOKENS = 1 << 20
LONG, PIECE = 1 << 14, 1 << 10
MERGE_ROWS = 1 << 20
#: Steps between rescalings of the recursions: a step's chances of 1e-30 stay within range.
RESCALE = 8

_U = np.uint64
END = np.int64(0x454E44)  # the end mark's key in the count table


def _merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, row = np.unique(np.concatenate(hashes), return_inverse=True)
    return key, np.bincount(row, np.concatenate(counts), len(key)).astype(np.int64)


def _count(batches):
    held, counts, size, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, 0

    def out():
        key, n = _merged(held, counts)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["word", "c"])
    for batch in batches:
        for rows, buf, offsets in slices(batch, "text"):
            key, n = np.unique(Words(buf, offsets).hash.view(np.int64), return_counts=True)
            held.append(key)
            counts.append(n)
            size += len(key)
            ends += rows.num_rows
            if size > MERGE_ROWS:
                key, n = _merged(held, counts)
                if len(key) > MERGE_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["word", "c"])
                    key, n = key[:0], n[:0]
                held, counts, size = [key], [n], len(key)
    held.append(np.array([END]))
    counts.append(np.array([ends]))
    yield out()


@dataclass
class Counts:
    """What of the training counts every task holds: the commonest words by key with
    counts and classes, and each shared class's tokens plus distinct words."""
    tokens: int
    distinct: int
    word: np.ndarray
    count: np.ndarray
    own: np.ndarray
    shared: np.ndarray
    class_count: np.ndarray

    @property
    def own_words(self) -> int:
        return len(self.class_count) - SHARED - 1

    def shared_class(self, words: np.ndarray) -> np.ndarray:
        return self.own_words + (words.view(_U) % _U(SHARED)).astype(np.int64)

    def find(self, words: np.ndarray) -> np.ndarray:
        """Row of each word in the list, or -1."""
        if not len(self.word):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.word, words), len(self.word) - 1)
        return np.where(self.word[at] == words, at, -1)


def count_words(docs: DataFrame) -> tuple[DataFrame, Counts]:
    """The table ``(word, c)`` of the training texts, and its head."""
    table = keep_table(docs.select("text").mapInArrow(_count, "word long, c long")
                       .groupBy("word").agg(F.sum("c").alias("c")).where("c > 0"), "counts")
    total = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                      F.coalesce(F.max(F.when(F.col("word") == int(END), F.col("c"))), F.lit(0)).alias("ends")).first()
    # The listed words: all with at least the count that at most LISTED words have,
    # from a histogram of counts (eight leading bits), so no partition sends its own top.
    step = F.expr("shiftleft(1L, greatest(length(bin(c)) - 8, 0))")
    bins = (table.groupBy((F.col("c") - F.col("c") % step).alias("least")).agg(F.count("*").alias("n"))
            .toPandas().sort_values("least", ascending=False))
    fit = bins["least"][bins["n"].cumsum() <= LISTED]
    least = int(fit.min()) if len(fit) else int(bins["least"].max() if len(bins) else 0) * 2 + 1
    head = (table.where((F.col("c") >= least) & (F.col("word") != int(END))).toArrow().to_pandas()
            .sort_values(["c", "word"], ascending=[False, True], ignore_index=True))
    n_own = int((head["c"] >= OWN_COUNT).sum())
    own = np.full(len(head), -1, np.int64)
    own[:n_own] = np.arange(n_own)
    rest = table.where((F.col("word") != int(END)) & (F.col("c") < max(least, OWN_COUNT)))
    # As unsigned, to match the tasks' arithmetic: SHARED is a power of two, so the low bits decide.
    by_class = (rest.groupBy(F.col("word").bitwiseAND(SHARED - 1).alias("k"))
                .agg(F.sum("c").alias("n"), F.count("*").alias("v")).toPandas())
    shared = np.ones(SHARED)
    shared[by_class["k"].to_numpy(np.int64)] += (by_class["n"] + by_class["v"]).to_numpy(float)
    per_class = np.zeros(n_own + SHARED + 1)
    per_class[:n_own] = head["c"].to_numpy()[:n_own]
    per_class[n_own + by_class["k"].to_numpy(np.int64)] = by_class["n"].to_numpy(float)
    per_class[-1] = total["ends"]
    order = np.argsort(head["word"].to_numpy(np.int64))
    return table, Counts(int(total["n"]), int(total["v"]), head["word"].to_numpy(np.int64)[order],
                         head["c"].to_numpy(np.int64)[order], own[order], shared, per_class)


def _tokens(shared):
    def run(batches):
        c: Counts = shared.value
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text"):
                words = Words(buf, offsets)
                key, text = words.hash.view(np.int64), np.repeat(np.arange(rows.num_rows), np.diff(words.first))
                at = c.find(key)
                listed = at >= 0
                own = np.where(listed, c.own[at], -1) if len(c.word) else at
                cls = np.where(own >= 0, own, c.shared_class(key))
                n = rows.num_rows
                log_c = np.where(listed, np.log10(c.count[at] + 1.0), 0) if len(c.word) else np.zeros(len(key))
                whole = np.bincount(text, log_c, n)
                inside = np.bincount(text, np.where(own >= 0, 0, log_c), n)
                inside -= np.bincount(text, np.where(own >= 0, 0, np.log10(c.shared[np.where(own >= 0, 0, cls - c.own_words)])), n)
                # Class sequences with the end mark.
                seq = np.full(len(key) + n, len(c.class_count) - 1, np.int32)
                first = words.first + np.arange(n + 1)
                seq[np.arange(len(key)) + text] = cls
                lists = [seq[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                # The words that are not listed, with their number in the text.
                rare = np.flatnonzero(~listed)
                order = np.lexsort((key[rare], text[rare]))
                k, t = key[rare][order], text[rare][order]
                new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])) if len(k) else rare
                ends = np.searchsorted(t[new], np.arange(n + 1)).astype(np.int32)
                times = np.diff(np.append(new, len(k)))
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), rows.column("held_out"), rows.column("learnt"),
                    pa.array(np.diff(words.first).astype(np.int64) + 1),
                    pa.array(np.bincount(text[listed], minlength=n).astype(np.int64)), pa.array(whole), pa.array(inside),
                    pa.array(lists, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(k[new])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32)))],
                    ["doc_id", "held_out", "learnt", "n_tokens", "known", "whole", "inside", "classes", "rare", "times"])
    return run


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states


@dataclass
class Borders:
    """What the pieces of a long text take from their neighbours, a row each: the chances
    of the states before the first token, the forward variables at the previous piece's
    end (zero for the first piece) and the backward variables at the piece's own end."""
    enter: np.ndarray
    before: np.ndarray
    after: np.ndarray


class Steps:
    """Class sequences laid out by time step, longest first, for recursions in step."""

    def __init__(self, sequences: list[np.ndarray], borders: Borders | None = None):
        length = np.array([len(s) for s in sequences])
        self.order = np.argsort(-length, kind="stable")
        sorted_length = length[self.order]
        doc = np.repeat(np.arange(len(sequences)), sorted_length)
        t = np.arange(len(doc)) - np.repeat(np.cumsum(sorted_length) - sorted_length, sorted_length)
        self.live = np.bincount(t)
        self.base = np.concatenate([[0], np.cumsum(self.live)])
        self.cls = np.zeros(len(doc), np.int64)
        doc += self.base[t]
        self.cls[doc] = np.concatenate([sequences[i] for i in self.order.tolist()])
        self.borders = borders and Borders(*(x[self.order] for x in (borders.enter, borders.before, borders.after)))

    def forward(self, m: Model, keep: bool = False) -> tuple[np.ndarray | None, list[np.ndarray], np.ndarray]:
        """Forward variables (if ``keep``, else none are held beyond a step), the scales of
        every ``RESCALE``th step, and each sequence's log10 likelihood."""
        live, states = self.live.tolist(), len(m.start)
        alpha = np.empty((len(self.cls), states)) if keep else None
        spare = [np.empty((live[0], states)) for _ in range(1 if keep else 3)]
        like, scales, one = np.zeros(len(self.order)), [], np.ones(states)
        before = self.borders.enter if self.borders else np.broadcast_to(m.start, (live[0], states))
        for t, (n, after) in enumerate(zip(live, [*live[1:], 0])):
            lo = self.base[t]
            a = alpha[lo:lo + n] if keep else spare[1 + t % 2][:n]
            np.take(m.emit, self.cls[lo:lo + n], axis=0, out=a, mode="clip")
            a *= before[:n] if t == 0 else np.matmul(before[:n], m.move, out=spare[0][:n])
            if t % RESCALE == RESCALE - 1:
                scales.append(a @ one)
                a /= scales[-1][:, None]
                like[:n] += np.log10(scales[-1])
            if after < n:
                like[after:n] += np.log10(a[after:] @ one)
            before = a
        out = np.empty(len(like))
        out[self.order] = like
        return alpha, scales, out

    def expected(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions (forward-backward); ``like`` is set to the
        sequences' log10 likelihood."""
        alpha, scales, like = self.forward(m, keep=True)
        self.like = float(like.sum())
        moves, back, ahead = np.zeros_like(m.move), np.ascontiguousarray(m.move.T), None
        held, *spare = (np.empty((self.live[0], len(m.start))) for _ in range(3))
        for t in range(len(self.live) - 1, -1, -1):
            lo, n = self.base[t], self.live[t]
            a, beta = alpha[lo:lo + n], held[:n]
            k = 0 if ahead is None else len(ahead)
            if k < n:
                beta[k:] = self.borders.after[k:n] if self.borders else 1
                beta[k:] /= (a[k:] * beta[k:]).sum(axis=1, keepdims=True)
            if k:
                moves += a[:k].T @ ahead
                np.matmul(ahead, back, out=beta[:k])
            ahead = spare[t % 2][:n]
            np.take(m.emit, self.cls[lo:lo + n], axis=0, out=ahead, mode="clip")
            ahead *= beta
            if t % RESCALE == RESCALE - 1:
                ahead /= scales[t // RESCALE][:, None]
            a *= beta
        starts = alpha[:self.live[0]]
        if self.borders:
            moves += self.borders.before.T @ ahead
            starts = starts[~self.borders.before.any(axis=1)]
        emits = np.stack([np.bincount(self.cls, alpha[:, k], len(m.emit)) for k in range(len(m.start))], axis=1)
        return starts.sum(axis=0), moves * m.move, emits


def _transfer(block: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of equally long pieces (a row each): the scaled forward variables at their ends from
    each state before their first token, and the logarithms of the scales."""
    k, n = len(block), len(m.start)
    a, log = np.tile(np.eye(n), (k, 1)), np.zeros(k * n)
    for t in range(block.shape[1]):
        if t:
            a = a @ m.move
        a *= np.repeat(m.emit[block[:, t]], n, axis=0)
        scale = a.sum(axis=1)
        # A state that cannot lead here at all keeps a row of zeros.
        a /= np.where(scale > 0, scale, 1)[:, None]
        with np.errstate(divide="ignore"):
            log += np.log(scale)
    return a.reshape(k, n, n), log.reshape(k, n)


def cut(sequence: np.ndarray, m: Model) -> tuple[list[np.ndarray], Borders, float]:
    """A long sequence in pieces, their borders and the whole's log10 likelihood."""
    pieces = [sequence[i:i + PIECE] for i in range(0, len(sequence), PIECE)]
    whole, n = len(sequence) // PIECE, len(m.start)
    block = sequence[:whole * PIECE].reshape(whole, PIECE)
    width = max(1, STEP_TOKENS // (PIECE * n))
    got = [_transfer(block[i:i + width], m) for i in range(0, whole, width)]
    if len(pieces) > whole:
        got.append(_transfer(pieces[-1][None], m))
    ends, logs = np.concatenate([a for a, _ in got]), np.concatenate([b for _, b in got])
    top = logs.max(axis=1)
    through = np.exp(logs - top[:, None])[:, :, None] * ends  # state before a piece x state at its end
    enter, before, after = (np.zeros((len(pieces), n)) for _ in range(3))
    enter[0], like = m.start, 0.0
    for i in range(len(pieces)):
        end = enter[i] @ through[i]
        like += (np.log(end.sum()) + top[i]) / np.log(10)
        end /= end.sum()
        if i + 1 < len(pieces):
            before[i + 1], enter[i + 1] = end, end @ m.move
    after[-1] = 1
    for i in range(len(pieces) - 1, 0, -1):
        back = m.move @ (through[i] @ after[i])
        after[i - 1] = back / back.sum()
    return pieces, Borders(enter, before, after), float(like)


def _sequences(column: pa.Array) -> list[np.ndarray]:
    """The class sequences of a binary column, as views of its buffer."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[:ends[-1]].view(np.int32)
    return [data[a:b] for a, b in zip((ends[:-1] // 4).tolist(), (ends[1:] // 4).tolist())]


def _chunks(batches):
    """Row numbers and class sequences: about a million tokens at a time, or one text of
    ``LONG`` tokens or more."""
    rows, held, size = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        for row, s in zip(batch.column("row").to_pylist(), _sequences(batch.column("classes").cast(pa.binary()))):
            if len(s) >= LONG:
                yield [row], [s]
                continue
            rows.append(row)
            held.append(s)
            size += len(s)
            if size >= STEP_TOKENS:
                yield rows, held
                rows, held, size = [], [], 0
    if held:
        yield rows, held


def _steps(held: list[np.ndarray], m: Model):
    """The recursions' portions of a chunk: the chunk itself, or a long text's pieces."""
    if len(held[0]) < LONG:
        yield Steps(held)
        return
    pieces, b, _ = cut(held[0], m)
    width = STEP_TOKENS // PIECE
    for i in range(0, len(pieces), width):
        to = i + width
        yield Steps(pieces[i:to], Borders(b.enter[i:to], b.before[i:to], b.after[i:to]))


def _expect(shared):
    def run(batches):
        model: Model = shared.value
        start, move, emit, like = np.zeros_like(model.start), np.zeros_like(model.move), np.zeros_like(model.emit), 0.0
        for _, held in _chunks(batches):
            for steps in _steps(held, model):
                a, b, c = steps.expected(model)
                start += a
                move += b
                emit += c
                like += steps.like
        likes = np.zeros_like(start)
        likes[0] = like
        every = np.vstack([likes, start, move, emit])
        at = np.flatnonzero(every.any(axis=1))
        # A task's counts travel in single precision; the cluster's are summed in double.
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(x) for x in every[at].T.astype(np.float32))],
                                         ["at", *_states(len(start))])
    return run


def _states(n: int) -> list[str]:
    return [f"n{k}" for k in range(n)]


def first_model(counts: Counts, states: int) -> Model:
    """A start that stays in its state, with the class frequencies disturbed by a
    fixed draw per state: a text's words together then favour one state, so the
    states part (by language and subject) within a few rounds.  From a start
    near one common distribution they hardly do."""
    share = (counts.class_count + 1) / (counts.class_count + 1).sum()
    n = len(share)
    draw = mix(np.arange(n * states, dtype=_U) + _U(1)).astype(float).reshape(n, states) / 2.0 ** 64
    emit = share[:, None] * np.exp(SPREAD * (draw - 0.5))
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def baum_welch(sequences: DataFrame, counts: Counts, states: int = STATES, rounds: int = ROUNDS,
               gain: float = GAIN) -> Model:
    """Train on all ``classes`` of the table ``sequences`` until a round's model is less than
    ``gain`` better than the one before; counts are smoothed by the class frequencies (see
    ``SMOOTH``), so every class can be emitted and a word seen in few states is not ruled
    out in the others."""
    model = first_model(counts, states)
    share = (counts.class_count + 1) / (counts.class_count + 1).sum()
    prior = (1 + SMOOTH * counts.tokens / states) * share[:, None]
    sc, last, sums = sequences.sparkSession.sparkContext, -np.inf, _states(states)
    for _ in range(rounds):
        # A row of sums over the states for the likelihood, the starts, each state's moves and each class.
        got = (sequences.select("row", "classes")
               .mapInArrow(_expect(sc.broadcast(model)), ", ".join(["at int", *(f"{k} float" for k in sums)]))
               .groupBy("at").agg(*(F.sum(k).alias(k) for k in sums)).toArrow())
        every = np.zeros((2 + states + len(share), states))
        every[got["at"].to_numpy()] = np.stack([got[k].to_numpy() for k in sums], axis=1)
        start, move, emit = every[1] + 1, every[2:2 + states] + 1, every[2 + states:] + prior
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
        now = every[0, 0] / max(1, counts.tokens)
        if now - last < gain:
            break
        last = now
    return model


def _score(shared):
    def run(batches):
        model: Model = shared.value
        for rows, held in _chunks(batches):
            like = Steps(held).forward(model)[2] if len(held[0]) < LONG else np.array([cut(held[0], model)[2]])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(like)], ["row", "like"])
    return run


def language_model(docs: DataFrame, fold: int = 2, folds: int = 7, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per
    row.  Texts whose crc32(id) modulo ``folds`` is ``fold`` (or whose id is null)
    are not learnt from.  A null or blank text is its end mark alone; repeated rows
    count as often as they occur; without training texts every word is unknown."""
    r = remainder("doc_id", folds)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(r == fold, F.lit(False)).alias("held_out"),
                       F.coalesce(r != fold, F.lit(False)).alias("learnt"), F.coalesce("text", F.lit("")).alias("text"))
    table, counts = count_words(docs.where("learnt"))
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    rows = docs.mapInArrow(_tokens(shared), "doc_id long, held_out boolean, learnt boolean, n_tokens long, known long, "
                           "whole double, inside double, classes binary, rare array<long>, times array<int>")
    rows = keep_table(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")
    model = baum_welch(rows.where("learnt"), counts, states, rounds)
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    met = rare.join(table, "word").groupBy("row").agg(
        F.sum("times").alias("met"), F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("log_c"))
    model = docs.sparkSession.sparkContext.broadcast(model)
    like = rows.select("row", "classes").mapInArrow(_score(model), "row long, like double")
    n, v, ends = counts.tokens, counts.distinct, int(counts.class_count[-1])
    unit = float(np.log10(n + 1.0 * (v + 1)))
    end = float(np.log10(ends + 1.0))
    out = (rows.drop("classes", "rare", "times").join(like, "row").join(met, "row", "left")
           .withColumn("log_c", F.coalesce("log_c", F.lit(0.0))))
    return out.select("doc_id", "held_out", "n_tokens",
                      (F.col("known") + F.coalesce("met", F.lit(0)) + (1 if ends else 0)).cast("long").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("whole") + F.col("log_c") + end - F.col("n_tokens") * unit).alias("base_score"),
                      (F.col("like") + F.col("inside") + F.col("log_c")).alias("score"))
