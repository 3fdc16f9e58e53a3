"""The lattice of all segmentations of texts into pieces of a fixed vocabulary.

Texts are cut into segments: a run of spaces with the non-spaces after it, of any
length.  No piece has a space after another byte, so no piece crosses a cut.
Within a segment a piece of the vocabulary may stand wherever its bytes do, and
every byte has a piece of its own, so any text has a segmentation and any
segmentation spells the text.

Segments of up to ``SEGMENT`` bytes are handled by length, all distinct ones of a
slice at once.  Longer ones (text without spaces) run whole, side by side with
others of similar length: a panel of positions at a time, with sums as wide as the
longest piece, rescaled every ``BLOCK`` positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from strata.llm.common import _P, _P_INV, _TABLES, mix

SEGMENT = 32
#: Longer segments: rows times positions of a panel, rows side by side, positions between rescalings.
PANEL, ROWS, BLOCK = 1 << 15, 512, 16
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

_U = np.uint64
_SLOTS = 20


@dataclass
class Vocabulary:
    """Pieces as bytes (space for the word mark), ``weight`` by the model's order
    of pieces (Zipf's law; byte pieces last), and a hash table of the pieces."""
    pieces: list[bytes]
    is_byte: np.ndarray
    byte_id: np.ndarray
    usable: np.ndarray
    rank: np.ndarray

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Vocabulary:
        """Read a SentencePiece model (on the driver; the vocabulary is of fixed size)."""
        import sentencepiece
        with open(path, "rb") as f:
            model = sentencepiece.SentencePieceProcessor(model_proto=f.read())
        n = model.get_piece_size()
        pieces, is_byte, byte_id, usable = [], np.zeros(n, bool), np.full(256, -1, np.int32), np.zeros(n, bool)
        for i in range(n):
            if model.is_byte(i):
                b = int(model.id_to_piece(i)[3:5], 16)
                pieces.append(bytes([b]))
                is_byte[i], byte_id[b] = True, i
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                pieces.append(b"")
            else:
                pieces.append(model.id_to_piece(i).replace("▁", " ").encode())
                usable[i] = b" " not in pieces[-1].lstrip(b" ")
        if (byte_id < 0).any():
            raise ValueError("the vocabulary needs a piece for every byte")
        order = sorted(np.flatnonzero(usable).tolist(), key=lambda i: (-model.get_score(i), i))
        rank = np.full(n, len(order), np.int64)
        rank[order] = np.arange(len(order))
        return cls(pieces, is_byte, byte_id, usable, rank)

    def __post_init__(self):
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.longest = int(self.length[self.usable].max(initial=1))
        self.data = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.start = np.cumsum(self.length) - self.length
        self.powers = np.array([pow(_P, j, 1 << 64) for j in range(max(self.longest, SEGMENT) + 1)], _U)
        ids = np.flatnonzero(self.usable)
        keys = np.array([segment_hash(self.pieces[i]) for i in ids.tolist()], _U)
        self.table = np.zeros((2, 1 << _SLOTS), np.int32)
        self.key = np.zeros(len(self.pieces), _U)
        self.key[ids] = keys
        self.taken = np.zeros(1 << _SLOTS, bool)
        self.taken[(keys >> _U(64 - _SLOTS)).astype(np.int64)] = True
        for i, k in zip(ids.tolist(), keys.tolist()):
            first = k >> (64 - _SLOTS)
            second = k & ((1 << _SLOTS) - 1)
            if self.table[0, first] == 0:
                self.table[0, first] = i
            elif self.table[1, second] == 0:
                self.table[1, second] = i
            else:
                raise ValueError("piece table is full")

    def zipf(self, power: float = 1.0) -> np.ndarray:
        """Piece probabilities by rank."""
        w = np.where(self.usable | self.is_byte, (self.rank + 1.0) ** -power, 0)
        w[self.is_byte] *= 1e-2
        return w / w.sum()

    def lookup(self, key: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        flat = key.ravel()
        first = (flat >> _U(64 - _SLOTS)).astype(np.int64)
        out = np.full(len(flat), -1, np.int32)
        # A piece is in the second table only if another has its slot in the first.
        at = np.flatnonzero(self.taken[first])
        key_at, one = flat[at], self.table[0, first[at]]
        two = self.table[1, (key_at & _U((1 << _SLOTS) - 1)).astype(np.int64)]
        out[at] = np.where(self.key[one] == key_at, one, np.where(self.key[two] == key_at, two, -1))
        return out.reshape(key.shape)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        at = np.cumsum(length) - length
        return self.data[np.repeat(self.start[ids] - at, length) + np.arange(int(length.sum()))]


def segment_hash(piece: bytes) -> int:
    acc = 0
    for j, b in enumerate(piece):
        acc += int(_TABLES[False][b]) * pow(_P, j, 1 << 64)
    return int(mix(np.array([(acc + len(piece)) & ((1 << 64) - 1)], _U))[0])


_SMALL = np.array([pow(_P, j, 1 << 64) for j in range(SEGMENT + 1)], _U)


class Segments:
    """The segments of a slice: ``groups`` yields those of up to ``SEGMENT`` bytes by
    length, ``long_groups`` the others."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        n = len(buf)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if n:
            space = buf == 32
            cut[1:n] |= space[1:] & ~space[:-1]
        start = np.flatnonzero(cut[:n])
        length = np.diff(np.append(start, n)) if len(start) else np.zeros(0, np.int64)
        self.buf, self.start, self.length = buf, start, length
        self.text = np.searchsorted(offsets, start, "right") - 1

    def groups(self):
        """For each length: indices of the segments, the distinct ones as a byte
        matrix, and for each segment its row in that matrix."""
        order = np.argsort(self.length, kind="stable")
        sizes = np.bincount(np.minimum(self.length, SEGMENT + 1), minlength=SEGMENT + 1)
        ends = np.cumsum(sizes)
        for size in range(1, SEGMENT + 1):
            if not sizes[size]:
                continue
            of = order[ends[size] - sizes[size]:ends[size]]
            matrix = self.buf[self.start[of][:, None] + np.arange(size)]
            key = mix((_TABLES[False][matrix] * _SMALL[:size]).sum(axis=1, dtype=_U))
            _, first, row = np.unique(key, return_index=True, return_inverse=True)
            yield of, matrix[first], row

    def long_groups(self):
        """Up to ``ROWS`` segments of similar length at a time: their indices, their
        bytes (short rows padded) and lengths."""
        of = np.flatnonzero(self.length > SEGMENT)
        of = of[np.argsort(self.length[of], kind="stable")]
        while len(of):
            length = self.length[of]
            most = 2 * int(length[0])
            n = min(int(np.searchsorted(length, most, "right")), ROWS, max(1, (1 << 20) // most))
            group, length, of = of[:n], length[:n], of[n:]
            if n > 1:
                at = self.start[group][:, None] + np.minimum(np.arange(length[-1]), length[:, None] - 1)
                yield group, self.buf[at], length
            else:
                yield group, self.buf[self.start[group[0]]:self.start[group[0]] + length[0]][None], length


def piece_matrix(vocabulary: Vocabulary, matrix: np.ndarray) -> list[np.ndarray]:
    """``out[l - 1][:, i]``: the piece of length l at byte i (-1: none); for
    length 1, where no plain piece stands, the byte's own piece."""
    n, size = matrix.shape
    columns = np.ascontiguousarray(matrix.T)  # a column of ``out`` lies together
    table = _TABLES[False][columns]
    out = []
    key = np.zeros((size, n), _U)
    for l in range(1, min(size, vocabulary.longest) + 1):
        key = key[:size - l + 1] + table[l - 1:] * vocabulary.powers[l - 1]
        found = vocabulary.lookup(mix(key + _U(l)))
        if l == 1:
            found = np.where(found < 0, vocabulary.byte_id[columns], found)
        out.append(found.T)
    return out


def forward(pieces: list[np.ndarray], weight: np.ndarray, tilt: float) -> tuple[np.ndarray, np.ndarray]:
    """``alpha[:, e]``, the summed weight of all segmentations of the first e bytes
    under ``weight * tilt ** length`` scaled per byte, and the log scale per row.
    (Scaling keeps 32 bytes of rare pieces within floating-point range.)"""
    n, size = pieces[0].shape
    alpha = np.zeros((size + 1, n)).T
    alpha[:, 0] = 1
    weight = np.append(weight, 0.0)  # no piece (-1) has no weight
    for e in range(1, size + 1):
        total = alpha[:, e]
        for l in range(1, min(e, len(pieces)) + 1):
            total += weight[pieces[l - 1][:, e - l]] * tilt ** l * alpha[:, e - l]
    return alpha, np.log(alpha[:, size]) - size * np.log(tilt)


def forward_parts(pieces: list[np.ndarray], tilted: np.ndarray) -> list[np.ndarray]:
    """The sums of ``forward`` by the length of the last piece: ``out[e - 1][l - 1]`` is
    the weight of all segmentations of the first e bytes that end in a piece of up to
    l bytes.  ``tilted``: a weight per piece, tilted by its length, and 0 for none (-1)."""
    n, size = pieces[0].shape
    share, alpha, out = [tilted[p.T] for p in pieces], [np.ones(n)], []
    for e in range(1, size + 1):
        part = np.empty((min(e, len(pieces)), n))
        for l in range(1, len(part) + 1):
            np.multiply(share[l - 1][e - l], alpha[e - l], out=part[l - 1])
            if l > 1:
                part[l - 1] += part[l - 2]
        out.append(part)
        alpha.append(part[-1])
    return out


TILT = 64.0


def panels(rows: int, size: int) -> list[tuple[int, int]]:
    """Positions 0 to ``size`` of ``rows`` long segments, cut into panels."""
    step = max(PANEL // rows, 1)
    return [(lo, min(lo + step, size + 1)) for lo in range(0, size + 1, step)]


def panel_pieces(vocabulary: Vocabulary, matrix: np.ndarray, length: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """``out[r, i, l - 1]``: the piece of length l at byte ``lo + i`` of row r (-1:
    none); for length 1, where no plain piece stands, the byte's own piece."""
    rows, size = matrix.shape
    part = matrix[:, lo:min(hi + vocabulary.longest - 1, size)]
    table = _TABLES[False][part]
    out = np.full((rows, hi - lo, vocabulary.longest), -1, np.int32)
    key = np.zeros((rows, hi - lo), _U)
    for l in range(1, vocabulary.longest + 1):
        n = min(hi, size - l + 1) - lo
        if n <= 0:
            break
        key = key[:, :n] + table[:, l - 1:l - 1 + n] * vocabulary.powers[l - 1]
        found = vocabulary.lookup(mix(key + _U(l)))
        if l == 1:
            found = np.where(found < 0, vocabulary.byte_id[part[:, :n]], found)
        out[:, :n, l - 1] = np.where(lo + np.arange(n) + l <= length[:, None], found, -1)
    return out


def panel_weight(pieces: np.ndarray, weight: np.ndarray, tilt: float) -> np.ndarray:
    """The weight of each piece of a panel, tilted per byte; 0 where there is none."""
    return np.where(pieces >= 0, weight[pieces], 0) * tilt ** np.arange(1, pieces.shape[2] + 1)


class LongForward:
    """The forward sums of long segments, panel by panel from the left.  Between
    panels only the sums already begun are kept, as many as the longest piece."""

    def __init__(self, rows: int, longest: int):
        self.ahead = np.zeros((rows, longest))
        self.ahead[:, 0] = 1
        self.scale = np.zeros(rows)

    def step(self, weight: np.ndarray) -> np.ndarray:
        """Log sums before each position of a panel (-inf beyond a row's end)."""
        rows, size, wide = weight.shape
        acc = np.zeros((rows, size + wide))
        acc[:, :wide] = self.ahead
        out = np.empty((rows, size))
        for a in range(0, size, BLOCK):
            b = min(a + BLOCK, size)
            head = np.where(acc[:, a] > 0, acc[:, a], 1)
            acc[:, a:a + wide] /= head[:, None]
            self.scale += np.log(head)
            for i in range(a, b):
                acc[:, i + 1:i + 1 + wide] += weight[:, i] * acc[:, i, None]
            with np.errstate(divide="ignore"):
                out[:, a:b] = np.log(acc[:, a:b]) + self.scale[:, None]
        self.ahead = acc[:, size:]
        return out


class LongBackward:
    """The sums from each position to its row's end, panel by panel from the right."""

    def __init__(self, length: np.ndarray, longest: int):
        self.length = length
        self.behind = np.zeros((len(length), longest))
        self.scale = np.zeros(len(length))

    def step(self, weight: np.ndarray, lo: int) -> np.ndarray:
        """Log sums from each position of the panel that begins at ``lo`` and from as
        many positions after it as the longest piece has bytes."""
        rows, size, wide = weight.shape
        acc = np.concatenate([np.zeros((rows, size)), self.behind], axis=1)
        out = np.empty((rows, size + wide))
        ends = lo + np.arange(size) == self.length[:, None]
        with np.errstate(divide="ignore"):
            out[:, size:] = np.log(self.behind) + self.scale[:, None]
            for b in range(size, 0, -BLOCK):
                a = max(b - BLOCK, 0)
                head = np.where(acc[:, b] > 0, acc[:, b], 1)
                acc[:, b:b + wide] /= head[:, None]
                self.scale += np.log(head)
                for i in range(b - 1, a - 1, -1):
                    acc[:, i] = np.einsum("rl,rl->r", weight[:, i], acc[:, i + 1:i + 1 + wide]) + ends[:, i]
                out[:, a:b] = np.log(acc[:, a:b]) + self.scale[:, None]
        self.behind = acc[:, :wide].copy() if size >= wide else acc[:, :wide]
        return out


def long_forward(vocabulary: Vocabulary, matrix: np.ndarray, length: np.ndarray, weight: np.ndarray,
                 tilt: float) -> np.ndarray:
    """``log alpha[:, e]`` of every position of long segments, tilted per byte."""
    run = LongForward(len(matrix), vocabulary.longest)
    return np.concatenate([run.step(panel_weight(panel_pieces(vocabulary, matrix, length, lo, hi), weight, tilt))
                           for lo, hi in panels(*matrix.shape)], axis=1)


def long_likelihood(vocabulary: Vocabulary, matrix: np.ndarray, length: np.ndarray, weights: list[np.ndarray],
                    tilt: float) -> np.ndarray:
    """Natural log of the summed weight of all segmentations, per row and distribution."""
    runs = [LongForward(len(matrix), vocabulary.longest) for _ in weights]
    out = np.zeros((len(matrix), len(weights)))
    for lo, hi in panels(*matrix.shape):
        pieces = panel_pieces(vocabulary, matrix, length, lo, hi)
        here = np.flatnonzero((length >= lo) & (length < hi))
        for k, w in enumerate(weights):
            out[here, k] = runs[k].step(panel_weight(pieces, w, tilt))[here, length[here] - lo]
    return out - length[:, None] * np.log(tilt)
