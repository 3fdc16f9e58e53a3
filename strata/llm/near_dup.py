"""Near-duplicate documents by HyperMinHash.

Each document is a set of word shingles.  One hash per shingle fills 256
buckets; a bucket keeps its minimum as a 16-bit register: the count of leading
zeros (6 bits) and the 10 bits after the first one.  Empty buckets of short
documents take the register of a filled bucket picked by a fixed random order,
so that two documents agree on any register with a chance of about their
Jaccard similarity.  42 bands of 6 registers give candidates: a pair at
similarity 0.8 shares no band with a chance of 3e-6, and at 0.3 shares one with
3 %.  Candidates pass the collision-corrected estimate of the similarity (with
five standard deviations to spare) and are then confirmed on the full sets.

Scale: documents with equal sets are one node from the start, so copies never
meet in a join.  In each bucket all nodes are first compared with its smallest
node; where one component remains, as among near copies, the bucket is done.
Only pairs across components are left; these are compared in blocks of bounded
size, many blocks for a large bucket, and a block returns no more links than
join its components.  No pair that shares a bucket and lies in two components
is left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, free_name, keep_table, mix, slices, small_batches
from strata.llm.components import components

BUCKETS = 256
LZ_BITS, MANTISSA_BITS = 6, 10
BANDS, BAND_WIDTH = 42, 6

#: Rows and set bytes of one block of a bucket's residual comparison.
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20

#: Bytes of text a task turns into sets at once, and pairs of sets it confirms at once.
SET_BYTES, PAIR_ROWS = 1 << 19, 500

#: Nodes (8 bytes each) up to which the list of candidates is broadcast; beyond, it is shuffled.
BROADCAST_NODES = 2_000_000

_U = np.uint64
_EDGES = (np.arange(BUCKETS, dtype=_U) << _U(56))
_ORDER = np.random.default_rng(20240131).permuted(
    np.tile(np.arange(BUCKETS, dtype=np.int16), (BUCKETS, 1)), axis=1)
_WEIGHTS = [3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41]


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice; a text with
    fewer words than ``width`` has its whole sequence as one shingle."""
    h = words.hash
    weights = [_U(_WEIGHTS[i % 12] + 48 * (i // 12)) for i in range(width)]
    n = len(h)
    acc = np.zeros(max(0, n - width + 1), _U)
    for i, w in enumerate(weights if n >= width else []):
        acc += h[i:n - width + 1 + i] * w
    acc = mix(acc)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(acc[a:b - width + 1]))
        elif b > a:
            part = np.sum(h[a:b] * np.array(weights[:b - a], _U), dtype=_U) + _U(b - a)
            out.append(mix(mix(np.array([part], _U))))
        else:
            out.append(np.zeros(0, _U))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The HyperMinHash registers (uint16) of each set; zeros for an empty set."""
    least = np.zeros((len(sets), BUCKETS), _U)
    for i, s in enumerate(sets):
        if not len(s):
            continue
        at = np.searchsorted(s, _EDGES)
        filled = at < np.append(at[1:], len(s))
        row = least[i]
        row[filled] = s[at[filled]]
        if not filled.all():
            src, gaps = np.flatnonzero(filled), np.flatnonzero(~filled)
            row[gaps] = row[src[_ORDER[gaps][:, src].argmin(axis=1)]]
    top = (least << _U(8)) >> _U(11)  # 53 bits, exact as a double
    _, exponent = np.frexp(top.astype(np.float64))
    zeros = np.minimum(53 - exponent, (1 << LZ_BITS) - 1)
    after = (top << np.minimum(zeros + 1, 53).astype(_U)) & _U((1 << 53) - 1)
    mantissa = after >> _U(53 - MANTISSA_BITS)
    return ((zeros.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa.astype(np.uint16))


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    r = regs[:, :BANDS * BAND_WIDTH].astype(_U).reshape(len(regs), BANDS, BAND_WIDTH)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), r.shape[:2]).copy()
    for j in range(BAND_WIDTH):
        key = mix(key * _U(1 << 16) + r[:, :, j] + _U(1))
    return key


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a, n_b) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less the share that
    would agree by chance: for a register cell of width w at height x the chance
    that both minima fall there is l*m*w*w*exp(-(l+m)x), with l and m elements
    per bucket, summed over the cells of each leading-zero count."""
    equal = (regs_a == regs_b).mean(axis=1)
    lam = np.maximum(np.asarray(n_a, float) / BUCKETS, 1e-9)
    mu = np.maximum(np.asarray(n_b, float) / BUCKETS, 1e-9)
    chance = np.zeros(np.broadcast(lam, mu).shape)
    for k in range(1 << LZ_BITS):
        low = 0.5 ** (k + 1)
        w = low / (1 << MANTISSA_BITS)
        chance += lam * mu * w / (lam + mu) * (np.exp(-(lam + mu) * low) - np.exp(-(lam + mu) * 2 * low))
    filled = (1 - np.exp(-lam)) * (1 - np.exp(-mu))
    chance = np.minimum(chance / np.maximum(filled, 1e-9), 0.5)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def slack(threshold: float) -> float:
    """Estimates below this are not verified: five standard deviations under the threshold."""
    return threshold - 5 * (threshold * (1 - threshold) / BUCKETS) ** 0.5


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _signatures(width: int):
    def run(batches):
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text", SET_BYTES):
                sets = shingle_sets(Words(buf, offsets), width)
                keys = band_keys(registers(sets))
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([k.view(np.int64) if len(s) else None for k, s in zip(keys, sets)],
                             pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_key", "bands"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for rows, buf, offsets in slices(batch, "text", SET_BYTES):
                sets = shingle_sets(Words(buf, offsets), width)
                regs = registers(sets)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "regs", "shingles"])
    return run


def _binary(column, dtype):
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _confirm(percent: int):
    def run(batches):
        floor = slack(percent / 100)
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (_binary(batch.column(f"shingles_{x}"), _U) for x in "ab")
            ra, rb = (np.array(_binary(batch.column(f"regs_{x}"), np.uint16)) for x in "ab")
            near = estimate(ra, rb, [len(x) for x in a], [len(x) for x in b]) >= floor
            keep = [i for i in np.flatnonzero(near).tolist() if similar(a[i], b[i], percent)]
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, pa.int64())),
                                              batch.column("b").take(pa.array(keep, pa.int64()))], ["a", "b"])
    return run


def _block_links(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        floor = slack(percent / 100)
        sets = [np.frombuffer(x, _U) for x in pdf["shingles"]]
        regs = np.array([np.frombuffer(x, np.uint16) for x in pdf["regs"]])
        size = np.array([len(s) for s in sets])
        node, side = pdf["node"].to_numpy(), pdf["side"].to_numpy()
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        label = pdf["label"].to_numpy().copy()
        found = []
        for x in range(len(node)):
            if i != j and side[x] != i:
                continue
            far = (label != label[x]) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
            if i == j:
                far[:x + 1] = False
            else:
                far &= side == j
            ys = np.flatnonzero(far)
            if not len(ys):
                continue
            est = estimate(regs[ys], regs[x][None, :], size[ys], np.full(len(ys), size[x]))
            order = np.argsort(-est, kind="stable")
            for y in ys[order[est[order] >= floor]].tolist():
                if label[y] != label[x] and similar(sets[x], sets[y], percent):
                    found.append((node[x], node[y]))
                    label[label == label[y]] = label[x]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def links(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between ``nodes(node, n_shingles, bands)`` that join the
    same components as all links would."""
    banded = nodes.select("node", "n_shingles", F.explode("bands").alias("key"))
    stars = (banded.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
             .where("n > 1").select("key", "hub"))
    shared = keep_table(banded.join(stars, "key"), "buckets")
    busy = keep_table(shared.select(F.col("node").alias("doc_id")).distinct(), "busy")
    few = busy.count() <= BROADCAST_NODES
    sets = (docs.join(F.broadcast(busy) if few else busy, "doc_id", "left_semi")
            .mapInArrow(_sets(width), "node long, regs binary, shingles binary"))
    sets = keep_table(sets.dropDuplicates(["node", "shingles"]), "sets")
    a, b = (sets.select(F.col("node").alias(x), F.col("regs").alias(f"regs_{x}"),
                        F.col("shingles").alias(f"shingles_{x}")) for x in "ab")
    pairs = shared.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    with small_batches(docs.sparkSession, PAIR_ROWS):
        star = keep_table(pairs.join(b, "b").join(a, "a").mapInArrow(_confirm(percent), "a long, b long"), "star")
    first = components(star)
    labelled = keep_table(shared.join(first, "node", "left").select(
        "key", "node", "n_shingles", F.coalesce("label", "node").alias("label")), "labelled")
    open_ = (labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                 F.count("*").alias("n"), F.sum(F.col("n_shingles") * 8).alias("bytes"))
             .where("lo <> hi")
             .select("key", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES))
                     .cast("int").alias("blocks")))
    parts = (labelled.join(open_, "key")
             .withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")))
    found = (parts.select("key", "i", "j", "side", "node", "label").join(sets, "node")
             .groupBy("key", "i", "j").applyInPandas(_block_links(percent), "a long, b long"))
    return star.union(found)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80) -> DataFrame:
    """Input rows as ``(doc_id, n_shingles, component_id, kept)``.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` over
    their sets of ``width``-word shingles; ``component_id`` is the smallest id
    reachable over links, ``kept`` says that it is the document's own.  A null
    or blank text has an empty set and no link.  Rows that share an id count as
    one document and are all returned (with several texts under an id, each
    row has its text's component).  A null id takes no part: null component,
    kept.  An empty table gives no rows; other columns are not read."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = keep_table(docs.mapInArrow(_signatures(width), "doc_id long, n_shingles long, set_key binary, "
                                                         "bands array<long>"), "signatures")
    linkable = sig.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = (linkable.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r"))
               .select("set_key", F.col("r.doc_id").alias("node"), "r.n_shingles", "r.bands"))
    classes = keep_table(classes, "classes")
    labels = components(links(classes.select("node", "n_shingles", "bands"), docs, width, percent))
    of_class = (classes.select("set_key", "node").join(labels, "node", "left")
                .select("set_key", F.coalesce("label", "node").alias("component")))
    out = sig.select("doc_id", "n_shingles", F.when(F.expr("doc_id IS NOT NULL AND n_shingles > 0"),
                                                    F.col("set_key")).alias("set_key"))
    component = F.coalesce("component", "doc_id")
    return (out.join(of_class, "set_key", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents, one of each group of near duplicates (that with the smallest
    id); all columns stay.

    Rows are judged, not ids: of rows with one id and one text a single one stays,
    and rows with one id but different texts are documents of their own, so that a
    clean text is not lost with another's copy.  Rows without an id all stay."""
    name = free_name(docs.columns, "_near")
    key, several = f"{name}_key", f"{name}_several"
    ids = docs.select(F.col("doc_id").cast("long").alias(key)).where(F.col(key).isNotNull())
    repeated = keep_table(ids.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated-ids")
    n = repeated.count()
    rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    if n == 0:
        rows = rows.withColumn(several, F.lit(False))
    else:
        mark = repeated.withColumn(several, F.lit(True))
        rows = rows.join(F.broadcast(mark) if n <= BROADCAST_NODES else mark, key, "left").withColumn(
            several, F.coalesce(several, F.lit(False)))
        # an id of several rows gives way to a negative one of id and text
        own = -1 - F.pmod(F.xxhash64(key, F.coalesce("text", F.lit(""))), F.lit(1 << 62))
        rows = rows.withColumn(key, F.when(F.col(several), own).otherwise(F.col(key)))
    judged = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), width=width, percent=percent)
    if n == 0:
        seen = judged.where("NOT kept").select(F.col("doc_id").alias(key)).distinct()
        return rows.join(seen, key, "left_anti").select(*docs.columns)
    of = (judged.where("doc_id IS NOT NULL").select(F.col("doc_id").alias(key), "component_id").distinct()
          .join(rows.select(key, F.col("doc_id").cast("long").alias("doc_id")).distinct(), key))
    best = of.groupBy("component_id").agg(F.min(F.struct("doc_id", key)).alias("r")).select(F.col(f"r.{key}").alias(key))
    left = rows.join(best, key, "left_semi")
    return (left.where(~F.col(several)).unionByName(left.where(several).dropDuplicates([key]))
            .unionByName(rows.where(F.col(key).isNull())).select(*docs.columns))
