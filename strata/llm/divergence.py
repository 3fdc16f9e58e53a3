"""Divergence audit of sources: how far the vocabulary of each source of a language
lies from that of the others, and which terms set it apart.

Terms are maximal runs of ASCII letters and non-ASCII characters, A-Z lower-cased.
A language keeps the V terms that at least ``min_docs`` of its documents hold.  A
group is a (language, source) pair; each group, and each language as a whole, gives
every kept term

    p = 1 + floor(10^9 * (count + 2) / (N + 2 V))      N: its kept occurrences

and two such p and q differ by ``f = floor((p - q)^2 / (p + q))``.  Part ``pair``
sums f over the kept terms for every two sources of a language; part ``term`` ranks
the terms that a source uses more than its language.  All arithmetic is exact.

Steps: (1) ``partial_counts`` runs Arrow kernels inside ``mapInArrow`` (lower-casing,
splitting, dictionary encoding, hash grouping) and sends one row per task, language
and term, with the counts of its sources as lists; (2) these rows meet by language and
term and are merged into columnar shards with the kept terms only; (3) numpy sums the
divergences of all pairs of a shard, so no row per pair and term is ever made; (4) the
shards' sums are added and ranked.  A hot source or language is many shards, as a shard
is chosen by term, and the commonest term costs one row a task.

Nulls: text, lang and source count as ''.  A group without terms takes part with
count 0; a language without kept terms has pairs of value 0 and no terms.  Repeated
rows are documents of their own.  Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep_table, slices

SEPARATORS = r"[\x00-\x60\x7B-\x7F]+"   # after lower-casing, A-Z are gone from the texts
SCALE = 1_000_000_000
#: Rows of partial counts that a task holds before it merges them, and sends them on if that does not halve them.
HOLD_ROWS = 300_000
#: Text bytes whose partial counts one task merges.
MERGE_BYTES = 32 << 20
#: Kept (source, term) counts a shard is meant to hold.
SHARD_ROWS = 500_000
#: Cells of the dense blocks (terms x sources, sources x sources) inside a shard.
BLOCK_CELLS = 1 << 20

PACKED = "lang string, term string, docs long, n long, sources array<string>, counts array<long>"
_KEYS = ["lang", "term", "source"]


def _sum(tables: list[pa.Table], keys: list[str], values: list[str]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(v, "sum") for v in values])
    return t.rename_columns(keys + values)


def _pack(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row per language and term, its sources and their counts as lists."""
    t = t.group_by(["lang", "term"], use_threads=False).aggregate(
        [("docs", "sum"), ("n", "sum"), ("source", "list"), ("n", "list")])
    yield from t.rename_columns(["lang", "term", "docs", "n", "sources", "counts"]).to_batches(max_chunksize=1 << 15)


def _unpack(t: pa.RecordBatch | pa.Table, docs: bool = True) -> pa.Table:
    """A row per (language, term, source); a term's documents stand in the first of its rows."""
    row = pc.list_parent_indices(t["sources"])
    row = row.combine_chunks() if isinstance(row, pa.ChunkedArray) else row
    out = {"lang": t["lang"].take(row), "term": t["term"].take(row), "source": pc.list_flatten(t["sources"]),
           "n": pc.list_flatten(t["counts"])}
    if docs:
        at = row.to_numpy(zero_copy_only=False)
        first = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
        out["docs"] = pa.array(np.where(first, t["docs"].to_numpy(zero_copy_only=False)[at], 0))
    return pa.table(out)


def _slice_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Counts of one slice; a row with null term per group counts its documents."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATORS)
    flat, parent = pc.list_flatten(words), pc.list_parent_indices(words)
    real = pc.not_equal(flat, "")
    code = flat.filter(real).dictionary_encode()
    group = pa.table({"lang": lang, "source": source, "row": np.arange(len(text))})
    group = group.group_by(["lang", "source"], use_threads=False).aggregate([("row", "list")])
    of = np.empty(len(text), np.int64)
    of[group["row_list"].combine_chunks().flatten().to_numpy()] = pc.list_parent_indices(group["row_list"]).to_numpy()
    per_doc = (pa.table({"row": parent.filter(real), "code": code.indices})
               .group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")]))
    t = (pa.table({"group": of[per_doc["row"].to_numpy()], "code": per_doc["code"], "n": per_doc["count_all"]})
         .group_by(["group", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")]))
    at = t["group"].combine_chunks()
    g_lang, g_source = group["lang"].combine_chunks(), group["source"].combine_chunks()
    once = pa.table({"lang": g_lang.take(at), "term": code.dictionary.take(t["code"].combine_chunks()),
                     "source": g_source.take(at), "n": t["n_sum"], "docs": t["n_count"]})
    size = pa.array(np.bincount(of, minlength=len(group)))
    return pa.concat_tables([once, pa.table({"lang": g_lang, "term": pa.nulls(len(group), pa.string()),
                                             "source": g_source, "n": size, "docs": size})])


def _merged(tables: Iterator[pa.Table], send: bool) -> Iterator[pa.Table]:
    """Sum tables of counts while they come; with ``send`` what no longer shrinks goes out early."""
    held, rows, limit = [], 0, HOLD_ROWS
    for t in tables:
        held.append(t)
        rows += len(t)
        if rows > limit:
            whole = _sum(held, _KEYS, ["n", "docs"])
            held, rows = [whole], len(whole)
            if send and rows > HOLD_ROWS // 2:
                yield whole
                held, rows = [], 0
            limit = max(HOLD_ROWS, 2 * rows)
    if held:
        yield _sum(held, _KEYS, ["n", "docs"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = (part for batch in batches for part, _, _ in slices(batch, "text"))
    for t in _merged((_slice_counts(p.column("lang"), p.column("source"), p.column("text")) for p in parts), True):
        yield from _pack(t)


def partial_counts(docs: DataFrame) -> DataFrame:
    """Occurrences and documents per language, term and source of each task's rows;
    a row with null term has the documents of a language's sources."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*cols).mapInArrow(_count_batches, PACKED)


def kept_shards(partials: DataFrame, min_docs: int, tasks: int) -> DataFrame:
    """The merged counts of the terms in at least ``min_docs`` documents of their
    language, one row per language and term; rows with null term stay."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _merged((_unpack(b) for b in batches), False):
            docs = _sum([t.select(["lang", "term", "docs"])], ["lang", "term"], ["docs"])
            docs = docs.filter(pc.and_(pc.greater_equal(docs["docs"], min_docs), pc.is_valid(docs["term"])))
            kept = t.drop_columns(["docs"]).join(docs, ["lang", "term"], join_type="inner", use_threads=False)
            marks = t.filter(pc.is_null(t["term"]))
            yield from _pack(pa.concat_tables([kept.select(["lang", "term", "source", "n", "docs"]),
                                               marks.select(["lang", "term", "source", "n", "docs"])]))

    return partials.repartition(tasks, "lang", "term").mapInArrow(work, PACKED)


def _shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """p of every count; Python integers where a product could leave 64 bits."""
    below = total + 2 * kept
    if counts.size and int(counts.max()) + 2 > (1 << 63) // SCALE - 1:
        return (1 + SCALE * (counts.astype(object) + 2) // below.astype(object)).astype(np.int64)
    return 1 + SCALE * (counts + 2) // below


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _shard(counts: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Divergence sums of all pairs and the leading terms, of one shard of terms.

    ``groups`` has every source of the language with its total, V and the language's
    total; ``counts`` the shard's kept (source, term, n, lang_n) rows."""
    groups = groups.sort_by("source")
    source, kept = groups["source"].combine_chunks(), int(groups["kept"][0].as_py())
    total = groups["total"].to_numpy()
    lang, n_src = groups["lang"][0].as_py(), len(source)
    out: dict[str, list] = {k: [] for k in ("source", "part", "item", "value")}
    if len(counts) == 0:
        return pa.table({"lang": pa.array([], pa.string()), "source": pa.array([], pa.string()),
                         "part": pa.array([], pa.string()), "item": pa.array([], pa.string()),
                         "value": pa.array([], pa.int64())})
    term = counts["term"].combine_chunks().dictionary_encode()
    t_of, s_of = term.indices.to_numpy(), pc.index_in(counts["source"], source).to_numpy()
    n, lang_n = counts["n"].to_numpy(), counts["lang_n"].to_numpy()
    n_terms = len(term.dictionary)
    order = np.argsort(t_of, kind="stable")
    t_sorted = t_of[order]
    step = max(1, BLOCK_CELLS // n_src)
    for s0 in range(0, n_src - 1, step):                  # a block of sources against all later ones
        s1 = min(s0 + step, n_src - 1)
        sums = np.zeros((s1 - s0, n_src), np.int64)
        for t0 in range(0, n_terms, step):
            a, b = np.searchsorted(t_sorted, [t0, t0 + step])
            at = order[a:b]
            dense = np.zeros((n_src, min(step, n_terms - t0)), np.int64)
            dense[s_of[at], t_of[at] - t0] = n[at]
            p = _shares(dense, total[:, None], kept)
            for s in range(s0, s1):
                sums[s - s0, s + 1:] += _apart(p[s + 1:], p[s]).sum(axis=1)
        for s in range(s0, s1):
            out["source"].append(source.take(pa.array(np.full(n_src - s - 1, s))))
            out["item"].append(source.slice(s + 1))
            out["value"].append(sums[s - s0, s + 1:].copy())
            out["part"].append(np.full(n_src - s - 1, "pair", object))
    p = _shares(n, total[s_of], kept)
    q = _shares(lang_n, np.full(len(n), groups["lang_total"][0].as_py()), kept)
    more = np.flatnonzero((n > 0) & (p > q))
    lead = pa.table({"s": s_of[more], "f": _apart(p[more], q[more]), "term": counts["term"].combine_chunks().take(pa.array(more))})
    by = pc.sort_indices(lead, [("s", "ascending"), ("f", "descending"), ("term", "ascending")])
    lead = lead.take(by)
    s = lead["s"].to_numpy()
    place = np.arange(len(s)) - np.searchsorted(s, s)
    lead = lead.filter(pa.array(place < top))
    out["source"].append(source.take(lead["s"].combine_chunks()))
    out["item"].append(lead["term"].combine_chunks())
    out["value"].append(lead["f"].to_numpy())
    out["part"].append(np.full(len(lead), "term", object))
    cols = {k: pa.chunked_array([pa.array(v, pa.int64() if k == "value" else pa.string()) for v in parts])
            for k, parts in out.items()}
    rows = len(cols["value"])
    return pa.table({"lang": pa.array([lang] * rows, pa.string()), **cols})


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10,
                      shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank`` (see the module docstring)."""
    spark = docs.sparkSession
    size = docs.select(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // MERGE_BYTES))
    merged = keep_table(kept_shards(partial_counts(docs), min_docs, tasks), "kept-terms")
    terms = merged.where(F.col("term").isNotNull())
    marks = merged.where(F.col("term").isNull()).select("lang", F.explode("sources").alias("source"))
    cells = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    per_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"),
                                         F.sum(F.size("sources")).alias("cells"))
    per_group = (cells.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("total")))
    groups = (marks.join(per_lang, "lang", "left").join(per_group, ["lang", "source"], "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                          for c in ("kept", "lang_total", "total", "cells")]))
    groups = keep_table(groups, "term-groups")
    # a language has as many shards as its counts need
    n_shards = F.ceil(F.col("cells") / F.lit(shard_rows)).cast("int")
    copies = groups.where("kept > 0").withColumn("shard", F.explode(F.sequence(F.lit(0), n_shards - 1)))
    dealt = (terms.join(groups.where("kept > 0").select("lang", n_shards.alias("shards")).distinct(), "lang")
             .select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"),
                     "term", "n", "sources", "counts"))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        cells = _unpack(left.select(["lang", "term", "sources", "counts"]), docs=False)
        lang_n = left["n"].take(pc.list_parent_indices(left["sources"]))
        return _shard(cells.append_column("lang_n", lang_n), right, top)

    found = (dealt.groupBy("lang", "shard").cogroup(copies.groupBy("lang", "shard"))
             .applyInArrow(work, "lang string, source string, part string, item string, value long"))
    found = keep_table(found, "shard-divergence")
    # every pair of a language's sources is a result row, so they are joined on the language;
    # a language without kept terms has no shard, and its pairs get 0
    sums = (found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    bare = groups.where("kept = 0").select("lang", "source")
    zero = (bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item")
            .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    pairs = both.unionByName(zero).select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                                          rank.alias("rank"))
    terms = (found.where("part = 'term'").select("lang", "source", "part", "item", "value", rank.alias("rank"))
             .where(F.col("rank") <= top))
    return pairs.unionByName(terms)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept k ON k.lang = w.lang AND k.term = w.term
      GROUP BY w.lang, w.source, w.term),
g AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
gt AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
       FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
p AS (SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (gt.total + 2 * s.v) AS p,
             1 + (1000000000 * (k.n + 2)) // (s.total + 2 * s.v) AS lp
      FROM gt JOIN size s ON s.lang = gt.lang JOIN kept k ON k.lang = gt.lang
      LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
         GROUP BY a.lang, a.source, b.source),
out AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(pair.value, 0)::BIGINT AS value
        FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
        LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source
        UNION ALL
        SELECT lang, source, 'term', term, ((p - lp) * (p - lp) // (p + lp))::BIGINT FROM p WHERE n > 0 AND p > lp),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM out)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
