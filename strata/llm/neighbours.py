"""Approximate nearest neighbours by inner product: NN-descent graphs and greedy search.

The nodes are dealt by the hash of their id into parts that a task can hold.  A
part's neighbour graph starts from stretches of rows that are consecutive along a
few random projections, and is improved by rounds of NN-descent: every node's
neighbours (and a sample of those that have it as one) are compared with each
other, and each keeps its best ones, until a round changes hardly any.  A query
walks the graph of every part: a beam of its best nodes is held, the best not yet
expanded are replaced by their neighbours, until all held nodes are expanded.  Its
walk starts from its own place, where the part has it, and from the best of some
nodes spread over the part.  The degree grows with the number of nodes of a part;
the beams of all parts together are at least what ``widths`` says for all nodes,
and each is at least ``BEAM``.

Scale: equal vectors are one node, with the few smallest ids that an answer can
name, so a vector that a third of all rows share is one node and one search.
A middle node compares at most three times the degree's members, and only pairs
that a new edge brings together.  Vectors travel once for each pass over the
parts (a pass makes several rounds), queries once for each part; candidates never
leave their task.  A part has a bounded number of bytes, so there are more
parts, not larger ones, when vectors are many.
Graph and beam score in double precision unless the rounding of single precision
is a small share of how scores differ, and the answer always scores the original
single-precision vectors in double: near copies and very small or large vectors
keep their order.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop_table, freed_shuffles, keep_table

#: Least degree and beam (see ``widths``), and the share of a beam that is expanded in a round.
DEGREE, BEAM, EXPAND = 24, 320, 5
PROJECTIONS, STRETCH = 4, 64
#: NN-descent ends when a round changes the neighbours of less than this share of the nodes.
SETTLED = 0.001
#: Best partners that a node takes from one middle node in a round.
PER_MIDDLE = 6
#: A part's bytes of vectors (of 64 components at least); so many parts, if each has PART_LEAST nodes.
PART_BYTES, LEAST_PARTS, PART_LEAST = 25_600_000, 12, 4096
#: A search task's queries at most.
BLOCK_QUERIES = 100_000
#: A walk starts from the best of so many times the beam's nodes.
STARTS = 8
#: Single precision serves where its rounding is less than this share of the scores' spread.
FINE = 0.001
#: Numbers that a step of the pairs, and edges that a step of the merge, hold at once.
PAIRS, MERGED = 3_000_000, 2_000_000


def widths(n: int) -> tuple[int, int]:
    """Degree and beam for ``n`` nodes: the degree grows with the logarithm, the
    beam with the square root."""
    return DEGREE + max(0, math.ceil(2 * math.log2(max(n, 1) / 2000))), max(BEAM, math.ceil(2 * n ** 0.5))


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part: an id, and a vector of the
    commonest length, finite, without null components and not zero.  An id with
    several vectors has the smallest of them; repeated rows count once."""
    v = F.col("embedding")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<float>").alias("vec"), fine.alias("f"))
    rows = rows.where(F.col("f") & F.col("vec_id").isNotNull() & F.exists("vec", lambda x: x != 0)).select("vec_id", "vec")
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    rows = rows.where(F.size("vec") == (common["n"] if common else 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _pack(batches):
    for batch in batches:
        if batch.num_rows:
            col = batch.column("vec")
            x = col.flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), col, pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["node", "vec", "raw"])


class Space:
    """The vectors of one part: rows by rising node id.  Scores are made in single
    precision where its rounding is a small share of how scores differ, else in double."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.raw = ids[order], x[order]
        n, d = self.raw.shape
        wide = self.raw.astype(np.float64)
        norm = np.sqrt((wide * wide).sum(axis=1))
        some = np.unique(np.linspace(0, n - 1, min(n, 256)).astype(np.int64))
        with np.errstate(all="ignore"):  # what is not a number means double
            low, high = np.percentile(wide[some] / norm[some, None] @ wide[some].T, [25, 75])
            #: What a score is off by at most, as a share of the other vector's length.
            self.rounding = d * 1.2e-7 * norm.max() + d * 1e-37 / norm.min()
            self.x = self.raw if self.rounding < FINE * (high - low) and norm.max() < 1e18 else wide
            if self.x is wide:
                self.rounding = d * 2.3e-16 * norm.max()

    def lookup(self, nodes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, nodes)

    def best(self, at: np.ndarray, s: np.ndarray, query: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``keep`` best of the rows ``at``, which come by falling score ``s``, with their inner
        products in double precision, summed component by component; ties to the smaller id."""
        query = query.astype(np.float64)
        if len(at) > keep:
            at = at[s >= s[keep - 1] - 2 * self.rounding * np.sqrt(query @ query)]
        score = np.cumsum(self.raw[at].astype(np.float64) * query, axis=1)[:, -1]
        order = np.lexsort((at, -score))[:keep]
        return at[order], score[order]


class Graph:
    """The ``degree`` best neighbours known of each row of a space: ``near`` (rows by
    falling score ``s``; ``n`` where there are fewer) and ``fresh``, the edges whose
    pairs have not been compared yet."""

    def __init__(self, space: Space, degree: int):
        n = len(space.ids)
        self.space, self.degree = space, degree
        self.near = np.full((n, degree), n, np.int32)
        self.s = np.full((n, degree), -np.inf, space.x.dtype)
        self.fresh = np.zeros((n, degree), bool)

    @property
    def held(self) -> np.ndarray:
        return self.near < len(self.near)

    def fill(self, a: np.ndarray, c: np.ndarray, fresh: np.ndarray) -> None:
        """The edges of a graph that was written; at most ``degree`` a row."""
        x, s = self.space.x, np.empty(len(a), self.s.dtype)
        for at in range(0, len(a), 1 << 17):
            part = slice(at, at + (1 << 17))
            s[part] = np.einsum("ij,ij->i", x[a[part]], x[c[part]])
        order = _by_score(a, s)
        a, c, s, fresh = (z[order] for z in (a, c, s, fresh))
        count = np.bincount(a, minlength=len(self.near))
        place = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        self.near[a, place], self.s[a, place], self.fresh[a, place] = c, s, fresh

    def add(self, a: np.ndarray, c: np.ndarray, s: np.ndarray) -> None:
        """Merge found edges: each row keeps its best distinct ones; a held edge stays
        as it is when it is found again."""
        n, degree = self.near.shape
        for at in range(0, len(a), MERGED):  # bounds the memory of the merge
            part = slice(at, at + MERGED)
            ok = np.flatnonzero(s[part] > self.s[a[part], -1])
            b, d, t = a[part][ok], c[part][ok], s[part][ok]
            ok = np.flatnonzero(~(self.near[b] == d[:, None]).any(axis=1))
            if not len(ok):
                continue
            b, d, t = b[ok].astype(np.int64), d[ok], t[ok]
            order = np.argsort(b * n + d)
            b, d, t = b[order], d[order], t[order]
            ok = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (d[1:] != d[:-1])]))
            b, d, t = b[ok], d[ok], t[ok]
            order = _by_score(b, t)
            d, t = d[order], t[order]  # b is as before
            start = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            count = np.diff(np.append(start, len(b)))
            place = np.arange(len(b)) - np.repeat(start, count)
            best = np.flatnonzero(place < degree)
            row, rows = np.repeat(np.arange(len(start)), count)[best], b[start]
            width = degree + min(degree, int(count.max()))
            near = np.full((len(rows), width), n, np.int32)
            score = np.full((len(rows), width), -np.inf, self.s.dtype)
            fresh = np.zeros((len(rows), width), bool)
            near[:, :degree], score[:, :degree], fresh[:, :degree] = self.near[rows], self.s[rows], self.fresh[rows]
            to = degree + place[best]
            near[row, to], score[row, to], fresh[row, to] = d[best], t[best], True
            keep = np.argsort(-score, axis=1)[:, :degree] + np.arange(0, score.size, width)[:, None]
            self.near[rows], self.s[rows], self.fresh[rows] = (x.ravel()[keep] for x in (near, score, fresh))

    def stirred(self) -> np.ndarray:
        """The rows that a fresh edge leaves or reaches."""
        mark = self.fresh.any(axis=1)
        mark[self.near[self.fresh]] = True
        return np.flatnonzero(mark)

    def members(self, salt: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each of ``rows`` its neighbours and a sample of up to twice the degree of those
        it is a neighbour of: members by row, those by a fresh edge first, ``n`` behind
        them; how many there are, and how many of them by a fresh edge."""
        n, degree = self.near.shape
        at = np.full(n + 1, -1, np.int32)
        at[rows] = np.arange(len(rows), dtype=np.int32)
        edge = np.flatnonzero(at[self.near.ravel()] >= 0)
        edge = edge[np.random.default_rng(salt + 1).permutation(len(edge))]
        c = at[self.near.ravel()[edge]]
        order = np.argsort(c, kind="stable")
        c, edge = c[order], edge[order]
        count = np.bincount(c, minlength=len(rows))
        place = np.arange(len(c)) - np.repeat(np.cumsum(count) - count, count)
        some = np.flatnonzero(place < 2 * degree)
        c, edge, place = c[some], edge[some], place[some]
        key = np.full((len(rows), degree + min(2 * degree, int(count.max(initial=0)))), 2 * n + 1, np.int32)
        near, fresh = self.near[rows], self.fresh[rows]
        key[:, :degree] = np.where(near < n, near * 2 + ~fresh, 2 * n + 1)
        key[c, degree + place] = edge // degree * 2 + ~self.fresh.ravel()[edge]
        key.sort(axis=1)  # a member by a fresh edge comes before itself by another
        key[:, 1:][key[:, 1:] >> 1 == key[:, :-1] >> 1] = 2 * n + 1
        found = key < 2 * n
        key = np.where(found, (key >> 1) + np.where(key & 1, n + 1, 0), 2 * n + 1).astype(np.int32)
        key.sort(axis=1)
        total, first = found.sum(axis=1), (key < n).sum(axis=1)
        key = np.where(key > n, key - (n + 1), key)
        return np.ascontiguousarray(key[:, :max(1, total.max(initial=0))]), total, first


def _by_score(a: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Order by rising ``a``, then falling ``s``."""
    if s.dtype != np.float32:
        return np.lexsort((-s, a))
    bits = (s + np.float32(0)).view(np.int32)  # one zero; integers that rise with s
    bits = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))
    return np.argsort((a << 32) + (0x7FFFFFFF - bits.astype(np.int64)))


def _start(graph: Graph) -> None:
    """Stretches of rows that are consecutive along a few random directions."""
    space, (n, d) = graph.space, graph.space.raw.shape
    for i in range(PROJECTIONS):
        order = np.argsort(space.x @ np.random.default_rng(i).normal(size=d).astype(space.x.dtype), kind="stable")
        at = np.arange(0, max(1, n - STRETCH // 2), STRETCH // 2)  # half overlapping
        rows = np.append(order, np.full(STRETCH, n)).astype(np.int32)[at[:, None] + np.arange(STRETCH)]
        step = max(1, PAIRS // (STRETCH * max(STRETCH, d)))
        for some in (rows[j:j + step] for j in range(0, len(rows), step)):
            total = (some < n).sum(axis=1)
            graph.add(*_pairs(graph, some, total, total, graph.degree))


def _pairs(graph: Graph, members: np.ndarray, total: np.ndarray, first: np.ndarray, keep: int):
    """Pairs of the members of each group, one of them among its ``first``, that beat what
    a member holds: for each member its ``keep`` best partners."""
    n, x = len(graph.near), graph.space.x
    most, lead = int(total.max()), int(first.max())
    ids = members[:, :most]
    safe = np.minimum(ids, n - 1)
    y = x[safe]
    s = y[:, :lead] @ y.transpose(0, 2, 1)
    least = np.where(ids < n, graph.s[safe, -1], np.inf)
    one = np.arange(lead) < first[:, None]
    s[~one] = -np.inf
    s[np.broadcast_to((np.arange(most) >= total[:, None])[:, None, :], s.shape)] = -np.inf
    s[:, np.arange(lead), np.arange(lead)] = -np.inf
    found = []
    for t, mine, other, mark in ((s, ids[:, :lead], ids, least[:, :lead]), (s.transpose(0, 2, 1), ids, ids[:, :lead], least)):
        hit = t > mark[:, :, None]
        if t is not s:
            hit[:, :lead][one] = False  # both among the first: found above
        count = np.count_nonzero(hit)
        if count > hit.shape[0] * hit.shape[1] * keep // 2 and keep < hit.shape[2]:
            t = np.where(hit, t, -np.inf)
            best = np.argpartition(t, hit.shape[2] - keep, axis=2)[:, :, -keep:]
            g, i, j = np.nonzero(np.take_along_axis(hit, best, 2))
            j = best[g, i, j]
        else:
            g, i, j = np.nonzero(hit)
        found.append((mine[g, i], other[g, j], t[g, i, j]))
    return [np.concatenate(z) for z in zip(*found)]


def _descend(graph: Graph, rounds: int, settled: float, salt: int) -> None:
    """Rounds of NN-descent, until one changes at most a share ``settled`` of the rows.
    Pairs of which neither came since they were members together are not compared again."""
    d = graph.space.raw.shape[1]
    for i in range(rounds):
        members, total, first = graph.members(salt + i, graph.stirred())
        graph.fresh[:] = False
        order = np.lexsort((total, first))
        order = order[(first > 0)[order] & (total > 1)[order]]
        at = 0
        while at < len(order):
            most = int(total[order[at:at + 1024]].max())
            some = order[at:at + max(16, min(1024, PAIRS // (most * max(most, d))))]
            at += len(some)
            graph.add(*_pairs(graph, members[some], total[some], first[some], PER_MIDDLE))
        if np.count_nonzero(graph.fresh.any(axis=1)) <= settled * len(graph.near):
            return


class Walker:
    """Greedy search in the graph of one part."""

    def __init__(self, graph: Graph, beam: int):
        self.space, self.beam, self.expand = graph.space, beam, math.ceil(beam / EXPAND)
        n = len(graph.near)
        near, count, _ = graph.members(-1, np.arange(n))
        width = int(np.percentile(count, 75))  # few rows have more members
        self.near, self.more, self.longer = near[:, :width].copy(), near[:, width:].copy(), count > width
        #: Nodes spread over the part: a walk starts from the best of them, and its own place.
        self.spread = np.unique(np.linspace(0, n - 1, min(n, STARTS * beam)).astype(np.int32))
        self.stamp, self.place = np.zeros(n + 1, np.int32), np.arange(self.expand * near.shape[1], dtype=np.int32)

    def walks(self, nodes: np.ndarray, queries: np.ndarray):
        """For each query the rows of its beam and their scores, once all of them are expanded."""
        queries = queries.astype(self.space.x.dtype)
        own = np.minimum(self.space.lookup(nodes), len(self.space.ids) - 1)
        score = queries @ self.space.x[self.spread].T
        for node, at, q, s in zip(nodes, own, queries, score):
            top = np.arange(len(s)) if len(s) <= self.beam else np.argpartition(s, len(s) - self.beam)[-self.beam:]
            ids, s = self.spread[top], s[top]
            if self.space.ids[at] == node and at not in ids:
                ids, s = np.append(ids, np.int32(at)), np.append(s, self.space.x[at] @ q)
            yield self.walk(ids, s, q)

    def walk(self, ids: np.ndarray, s: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, beam = len(self.space.ids), self.beam
        seen, done = np.zeros(n + 1, bool), np.zeros(len(ids), bool)
        seen[n] = seen[ids] = True
        while True:
            if len(ids) > 2 * beam:
                top = np.flatnonzero(s >= np.partition(s, len(s) - beam)[len(s) - beam])
                ids, s, done = ids[top], s[top], done[top]
            order = np.argsort(-s)
            if (s[order[1:]] == s[order[:-1]]).any():  # ties to the smaller id
                order = np.lexsort((ids, -s))
            order = order[:beam]
            ids, s, done = ids[order], s[order], done[order]
            pick = np.flatnonzero(~done)[:self.expand]
            if not len(pick):
                return ids, s
            done[pick] = True
            at = ids[pick]
            new = np.concatenate([self.near.take(at, axis=0).ravel(), self.more.take(at[self.longer[at]], axis=0).ravel()])
            new = new[~seen[new]]
            place = self.place[:len(new)]
            self.stamp[new] = place
            new = new[self.stamp[new] == place]  # once each
            seen[new] = True
            t = self.space.x.take(new, axis=0) @ q
            if len(ids) == beam:
                better = t >= s[-1]
                new, t = new[better], t[better]
            ids, s, done = np.concatenate([ids, new]), np.concatenate([s, t]), np.concatenate([done, np.zeros(len(new), bool)])


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


def _by_kind(batches) -> list[pa.Table]:
    """The rows of a part: its nodes, edges and queries."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return []
    rows = pa.Table.from_batches(batches)
    return [rows.filter(pc.equal(rows.column("kind"), kind)).combine_chunks() for kind in (NODE, EDGES, QUERY)]


def _read(nodes: pa.Table, edges: pa.Table, degree: int) -> Graph:
    space = Space(nodes.column("node").to_numpy(), _vectors(nodes.column("raw")))
    graph = Graph(space, degree)
    if edges.num_rows:
        near = edges.column("near").combine_chunks()
        size = pc.list_value_length(near).to_numpy()
        graph.fill(np.repeat(space.lookup(edges.column("node").to_numpy()), size),
                   space.lookup(near.flatten().to_numpy()),
                   np.repeat(edges.column("new").to_numpy(), size))
    return graph


def _rows(graph: Graph):
    """``(a, near, new)``: of each node the old edges and the new ones, by falling score."""
    ids = graph.space.ids
    for new in (False, True):
        for at in range(0, len(ids), OUT_ROWS):
            rows = slice(at, at + OUT_ROWS)
            held = graph.held[rows] & (graph.fresh[rows] == new)
            size = held.sum(axis=1)
            some = size > 0
            if some.any():
                cuts = np.concatenate([[0], np.cumsum(size[some])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows][some]), pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids[graph.near[rows][held]])),
                     pa.array(np.full(int(some.sum()), new))], ["a", "near", "new"])


def _improve(degree: int, rounds: int, settled: float, salt: int):
    def run(batches):
        tables = _by_kind(batches)
        if tables:
            graph = _read(tables[0], tables[1], degree)
            if not tables[1].num_rows:
                _start(graph)
            _descend(graph, rounds, settled, salt)
            yield from _rows(graph)
    return run


def _answer(degree: int, beam: int, keep: int):
    def run(batches):
        tables = _by_kind(batches)
        if not tables or not tables[0].num_rows or not tables[2].num_rows:
            return
        graph = _read(tables[0], tables[1], degree)
        space, walker = graph.space, Walker(graph, beam)
        for batch in tables[2].to_batches(max_chunksize=256):
            nodes, queries, out = batch.column("node").to_numpy(), _vectors(batch.column("raw")), []
            for query, vec, (found, s) in zip(nodes, queries, walker.walks(nodes, queries)):
                found, score = space.best(found, s, vec, keep)
                out.append((np.full(len(found), query), space.ids[found], score))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "id", "score"])
    return run


#: Kinds of rows that meet in a part, and rows of a graph that leave it at once.
NODE, EDGES, QUERY, OUT_ROWS = 0, 1, 2, 4096


def parts_of(nodes: DataFrame) -> tuple[int, int]:
    """How many nodes there are, and how many parts they are dealt into."""
    row = nodes.agg(F.count("*").alias("n"), F.max(F.octet_length("raw")).alias("bytes")).first()
    return row["n"], max(1, min(LEAST_PARTS, math.ceil(row["n"] / PART_LEAST)),
                         math.ceil(row["n"] * max(256, row["bytes"] or 0) / PART_BYTES))


def _dealt(rows: DataFrame, parts: int, kind: int, **columns) -> DataFrame:
    """``rows`` with their part and the columns of all kinds."""
    null = {"raw": "binary", "near": "array<long>", "new": "boolean"}
    part = columns.pop("part", F.pmod(F.xxhash64(columns["node"]), F.lit(parts)).cast("int"))
    return rows.select(part.alias("part"), F.lit(kind).alias("kind"), columns["node"].alias("node"),
                       *(columns.get(c, F.lit(None).cast(t)).alias(c) for c, t in null.items()))


def _node_rows(nodes: DataFrame, graph: DataFrame | None, parts: int) -> DataFrame:
    rows = _dealt(nodes, parts, NODE, node=F.col("node"), raw=F.col("raw"))
    if graph is None:
        return rows
    return rows.union(_dealt(graph, parts, EDGES, node=F.col("a"), near=F.col("near"), new=F.col("new")))


def neighbour_graph(nodes: DataFrame, degree: int = DEGREE, settled: float = SETTLED, parts: int | None = None) -> DataFrame:
    """NN-descent over ``nodes(node, raw)``, each part on its own: ``(a, near, new)``, a row for
    a node's old edges and one for those that the last round brought."""
    parts = parts or parts_of(nodes)[1]
    graph = last = None
    for i in itertools.count():  # the first passes are short: the start is far from settled
        rows = _node_rows(nodes, graph, parts).repartitionById(parts, F.col("part"))
        last, graph = graph, keep_table(rows.mapInArrow(_improve(degree, 1 << i, settled, i << 20), "a long, near array<long>, new boolean"), "graph")
        if last is not None:
            drop_table(last)
        if graph.where("new").count() <= settled * graph.count():
            return graph


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, keep: int, degree: int = DEGREE, beam: int = BEAM,
           parts: int | None = None) -> DataFrame:
    """Greedy search of each query node in the graph of every part: ``(query, id, score)``,
    the ``keep`` best of each part."""
    parts = parts or parts_of(nodes)[1]
    splits = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    held = _node_rows(nodes, graph, parts)
    if splits > 1:
        held = (held.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
                .withColumn("part", F.col("part") * splits + F.col("split")).drop("split"))
    own = nodes.select(F.col("node").alias("query"), "raw").join(queries, "query")
    asked = own.select("query", "raw", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"))
    asked = _dealt(asked, parts, QUERY, node=F.col("query"), raw=F.col("raw"),
                   part=F.col("p") * splits + F.pmod(F.xxhash64("query", F.lit(1)), F.lit(splits)).cast("int"))
    rows = held.union(asked).repartitionById(parts * splits, F.col("part"))
    return keep_table(rows.mapInArrow(_answer(degree, beam, keep), "query long, id long, score double"), "found")


def _found(vectors: DataFrame, k: int, every: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept tables: each asked id with its node, the ids of each node that an answer can
    name, and each asked node's best nodes."""
    rows = keep_table(usable(vectors).withColumn("key", F.struct(F.xxhash64("vec"), F.xxhash64(F.lit(1), "vec"))), "vectors")
    order = Window.partitionBy("key").orderBy("vec_id")
    alike = rows.select("key", "vec_id").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    first = alike.where("r = 1").select("key", F.col("vec_id").alias("node"))
    alike = keep_table(alike.select("key", "vec_id").join(first, "key").select("node", "vec_id"), "alike")
    nodes = rows.join(first.select("node"), F.col("vec_id") == F.col("node"), "left_semi").select(F.col("vec_id").alias("node"), "vec")
    nodes = keep_table(nodes.mapInArrow(_pack, "node long, vec array<float>, raw binary").select("node", "raw"), "nodes")
    asked = keep_table(rows.where(F.col("vec_id") % every == 0).select("key", F.col("vec_id").alias("query_id"))
                       .join(first, "key").select("query_id", F.col("node").alias("query")), "queries")
    drop_table(rows)
    n, parts = parts_of(nodes)
    degree, beam = widths(math.ceil(n / parts))[0], max(BEAM, math.ceil(widths(n)[1] / parts))
    graph = neighbour_graph(nodes, degree, parts=parts)
    found = search(graph, nodes, asked.select("query").distinct(), k + 1, degree, beam, parts)
    drop_table(graph)
    drop_table(nodes)
    few = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = keep_table(found.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1).drop("r"), "best")
    drop_table(found)
    return asked, alike, best


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by
    ``every`` its ``k`` nearest others found, by inner product, ties to the smaller
    id.  With fewer candidates all are returned; without usable rows, none."""
    with freed_shuffles(vectors.sparkSession):
        asked, alike, found = _found(vectors, k, every)
    # The ids that share the vectors of the best nodes.
    scored = found.join(alike, F.col("id") == F.col("node")).select("query", "vec_id", "score")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    short = scored.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    answer = asked.join(short, "query").where("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answer.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
