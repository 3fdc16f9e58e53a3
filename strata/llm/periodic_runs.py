"""Periodic runs of words (boilerplate loops, stuck generators, pasted copies).

A run is a maximal stretch of words with smallest period q and a length of at
least ``exponent * q`` and ``min_length``.  Every run holds a Lyndon root: a
Lyndon word as long as its period that is the longest one starting there under
one of the two opposite word orders.  So the runs come from two Lyndon arrays:

1. :func:`lyndon_array` is the first phase of Baier's suffix sorter: suffixes
   stand in groups by a known prefix, groups are taken from the highest down,
   and the nearest earlier suffix of a lower group takes the group's prefix on.
   The prefix length of a suffix's last group is its Lyndon length, so no
   second phase and no suffix array is needed.
2. :func:`word_runs` extends roots that follow one another by comparing the
   text with itself shifted by the period (longest common extension both ways).

:func:`candidate_stretches` first cuts away what cannot hold a run: inside a run
every stretch of two or three words occurs at least ``exponent - 1`` times, so
stretches whose words do not recur like that are never in one.  This is exact.

Nulls and edges: null or blank text has no words and no run; a null id is never
folded.  Repeated rows each give their row.  Texts are split in pieces, so a very
long text costs its word numbers (4 bytes a word) and its vocabulary.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_numbers(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and the word of each number."""
    seen: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(data):
        cut = _GAP.search(data, at + PIECE_BYTES)
        to = cut.start() if cut else len(data)
        words = data[at:to].split()  # bytes.split() cuts at 0x20 and 0x09-0x0D only
        for w in words:
            if w not in seen:
                seen[w] = len(seen)
        parts.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
        at = to
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(seen)


def lyndon_array(x: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word starting at each place of ``x``."""
    n = len(x)
    if n == 0:
        return np.zeros(0, np.int64)
    _, start = np.unique(x, return_inverse=True)
    group = start.tolist()
    k = max(group) + 1
    order = np.argsort(start, kind="stable")
    bounds = np.searchsorted(start[order], np.arange(k + 1)).tolist()
    order = order.tolist()
    members: list[list[int]] = [order[bounds[g]:bounds[g + 1]] for g in range(k)]
    size = [1] * k                       # length of a group's known prefix
    above = list(range(1, k)) + [-1]
    below = list(range(-1, k - 1))
    left = list(range(n + 1))            # left[i + 1]: nearest place <= i of a group not yet taken, plus 1
    g = k - 1
    while g >= 0:
        took = [i for i in members[g] if group[i] == g]
        members[g] = None
        for i in took:
            left[i + 1] = i
        count: dict[int, int] = {}
        for i in took:
            r = left[i]
            while left[r] != r:          # halve the path on the way
                left[r] = r = left[left[r]]
            left[i + 1] = r
            if r:
                count[r - 1] = count.get(r - 1, 0) + 1
        if count:
            grown = size[g]
            moves: dict[tuple[int, int], list[int]] = {}
            for j, c in count.items():
                moves.setdefault((c, group[j]), []).append(j)
            for c, h in sorted(moves, reverse=True) if len(moves) > 1 else moves:
                new, up = len(size), above[h]
                places = moves[c, h]
                size.append(size[h] + c * grown)
                members.append(places)
                above.append(up)
                below.append(h)
                above[h] = new
                below[up] = new          # a lower group always has one above it
                for j in places:
                    group[j] = new
        g = below[g]
    return np.array(size, np.int64)[group]


def _common(x: np.ndarray, i: int, j: int, limit: int, step: int) -> int:
    """Longest common extension of places i and j (step 1: to the right, i < j;
    step -1: to the left), at most ``limit``."""
    done, width = 0, 16
    while done < limit:
        w = min(width, limit - done)
        if step > 0:
            same = x[i + done:i + done + w] == x[j + done:j + done + w]
        else:
            same = (x[i - done - w + 1:i - done + 1] == x[j - done - w + 1:j - done + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, width = done + w, width * 4
    return done


def word_runs(x: np.ndarray, exponent: int = 4, min_length: int = 6) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of ``x`` by start, then period."""
    n, found = len(x), set()
    need = max(exponent - 1, 1)          # whole roots that any such run holds one after the other
    for ranks in (x, -x.astype(np.int64)):
        lam = lyndon_array(ranks)
        at = np.flatnonzero(np.arange(n) + need * lam <= n)
        for c in range(1, need):
            at = at[lam[at + c * lam[at]] == lam[at]]
        known: dict[int, int] = {}       # period -> end of its last run, places ascending
        for i in at.tolist():
            q = int(lam[i])
            if i + q <= known.get(q, -1):
                continue
            right = _common(x, i, i + q, n - i - q, 1)
            back = _common(x, i - 1, i + q - 1, i, -1) if i else 0
            start, length = i - back, back + q + right
            if length >= 2 * q:
                known[q] = start + length
                if length >= max(min_length, exponent * q):
                    found.add((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def candidate_stretches(x: np.ndarray, exponent: int = 4, min_length: int = 6) -> list[tuple[int, int]]:
    """Stretches (from, to) of ``x`` outside which no run can lie.

    A run of period q has at least ``exponent * q`` words, so each of its stretches
    of w <= q + 1 words occurs ``exponent - 1`` times in it; for q = 1 the stretches
    are all equal and ``min_length - w + 1`` of them are there."""
    w = 3 if min_length - 2 >= exponent - 1 else 2
    out, todo = [], [(0, len(x))]
    while todo:
        a, b = todo.pop()
        if b - a < max(min_length, exponent):
            continue
        part = x[a:b]
        key = part[:1 - w].astype(np.int64)
        for k in range(1, w):            # numbers of pairs, then of triples: exact, no hashing
            top = int(part.max()) + 1
            key = key * top + part[k:len(part) - w + 1 + k]
            if k < w - 1:
                key = np.unique(key, return_inverse=True)[1]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        good = np.concatenate([[False], times[which] >= exponent - 1, [False]])
        edge = np.flatnonzero(good[1:] != good[:-1])
        ranges = [(a + int(s), a + int(e) + w - 1) for s, e in zip(edge[::2], edge[1::2])]
        if ranges == [(a, b)]:
            out.append((a, b))
        else:                            # a run lies in one range whole, so count again inside it
            todo.extend(ranges)
    return sorted(out)


def runs_of(x: np.ndarray, exponent: int = 4, min_length: int = 6) -> list[tuple[int, int, int]]:
    """:func:`word_runs` over the stretches that can hold runs.  Stretches may share
    a word or two at their ends; a run lies in one of them whole."""
    out = {(a + s, length, q) for a, b in candidate_stretches(x, exponent, min_length)
           for s, length, q in word_runs(x[a:b], exponent, min_length)}
    return sorted(out, key=lambda r: (r[0], r[2]))


def fold_tail(x: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The probe of the query: for every tenth id (by crc32) the words from a place
    on are replaced by a repetition of the first of them."""
    n = len(x)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or n == 0:
        return x
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([x[:a], x[a + np.arange(n - a) % p]])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is reduced to its first period."""
    depth = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        depth[s + q] += 1
        depth[s + length] -= 1
    return np.cumsum(depth[:n]) == 0


def _joined(x: np.ndarray, words: list[bytes]) -> Iterator[bytes]:
    for at in range(0, len(x), 1 << 16):
        yield (b" " if at else b"") + b" ".join([words[i] for i in x[at:at + (1 << 16)].tolist()])


OUT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
       "runs_sha256 string, collapsed_sha256 string")


def audit_runs(docs: DataFrame, exponent: int = 4, min_length: int = 6,
               before: Callable[[np.ndarray, int | None], np.ndarray] | None = None) -> DataFrame:
    """Per document the number of runs, the strongest one and digests of all runs
    and of the text with every run reduced to its first period.

    ``before(numbers, doc_id)`` may change the words first.  One pass, no shuffle."""
    def work(batches):
        for batch in batches:
            cols = {k: [] for k in range(8)}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                x, words = word_numbers(data)
                if before is not None:
                    x = before(x, doc_id)
                runs = runs_of(x, exponent, min_length)
                top = strongest(runs)
                kept = hashlib.sha256()
                for piece in _joined(x[kept_words(len(x), runs)] if runs else x, words):
                    kept.update(piece)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                row = (doc_id, len(runs), *(top or (None,) * 3),
                       1000 * top[1] // top[2] if top else None,
                       hashlib.sha256(listed.encode()).hexdigest(), kept.hexdigest())
                for k, v in enumerate(row):
                    cols[k].append(v)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in enumerate(kinds)],
                                             names=["doc_id", "n_runs", "start", "length", "period",
                                                    "exponent_milli", "runs_sha256", "collapsed_sha256"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, OUT)


def collapse_runs(docs: DataFrame, exponent: int = 4, min_length: int = 6) -> DataFrame:
    """The documents with every run reduced to its first period (words joined by one
    space where a run was found; other texts stay as they are).  Columns are kept."""
    def work(batches):
        for batch in batches:
            k = batch.schema.get_field_index("text")
            out = []
            for text in batch.column(k):
                if not text.is_valid:
                    out.append(None)
                    continue
                x, words = word_numbers(text.as_buffer().to_pybytes())
                runs = runs_of(x, exponent, min_length)
                out.append(text.as_py() if not runs else
                           b"".join(_joined(x[kept_words(len(x), runs)], words)).decode())
            yield batch.set_column(k, batch.schema.field(k), pa.array(out, batch.schema.field(k).type))
    return docs.mapInArrow(work, docs.schema)
