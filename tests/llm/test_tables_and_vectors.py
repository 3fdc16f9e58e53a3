"""Quality rules, mixing, archives, vectors, and the pipeline."""

import base64
import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import DUCK_TYPE, canon, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    from strata.llm.common import ship_package
    ship_package(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def edges(spark):
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [(1, None, None, None, None), (None, "one two three", "en", "a", 13), (2, "", "en", None, 0),
            (3, " \t\n ", None, "a", 4), (6, long, "en", "a", len(long)), (7, long, "en", "b", len(long)),
            (7, long, "en", "b", len(long)), (8, "x" * 5000, "de", "a", 5000)]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in (
        "bins", "rate", "kept", "n_words", "t", "w", "l", "label", "score", "row")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF).execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TYPE.get(t, t.upper()) for c, t in types.items()} == {d[0]: str(d[1]) for d in res.description}
    assert canon(df.columns, rows) == canon(columns, res.fetchall())


def test_all_ten_and_the_pipeline_are_registered():
    names = set(E.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


# ---------------------------------------------------------------- quality

def test_quality_edges(edges, empty):
    from strata.llm.quality_rules import quality
    got = {r.doc_id: r for r in quality(edges).collect()}
    assert len(quality(edges).collect()) == 8
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[3].n_words == 0 and got[2].word_chars == 0
    assert got[6].n_words == 20_000 and got[6].n_repeat_words == 20_000 and got[6].base_failed
    assert quality(empty).count() == 0


def test_sketches_merge_by_adding(documents):
    from strata.llm.quality_rules import quantiles, sketches, statistics
    stats = statistics(documents.limit(150).cache())
    s = sketches(stats)
    whole = {(r["rate"], r["bucket"]): r["n"] for r in s.where("level = 2").collect()}
    summed = {(r["rate"], r["bucket"]): r["n"] for r in s.where("level = 0").groupBy("rate", "bucket").agg(F.sum("n").alias("n")).collect()}
    assert whole == summed
    words = sorted(100 * r["word_chars"] // r["n_words"] for r in stats.where("n_words > 0").collect())
    q = quantiles(s.where("level = 2"), ["rate"]).where("rate = 'word_length'").first()
    for got, share in ((q["q25"], 0.25), (q["q75"], 0.75)):
        exact = words[-(-int(len(words) * share * 4) // 4) - 1] if len(words) * share % 1 == 0 else words[int(len(words) * share)]
        assert got <= exact <= got * (1 + 1 / 64) + 1


# ---------------------------------------------------------------- mixing

def test_rates_meet_the_targets(documents, labels):
    from strata.llm.mixing import TARGETS, labelled_domains, mix
    rows = mix(documents, labelled_domains(documents, labels)).collect()
    total = sum(r.n_tokens for r in rows)
    assert len(rows) == documents.count() and all(r.rate >= 0 for r in rows)
    for d, want in TARGETS.items():
        got = sum(r.rate * r.n_tokens * r.posterior[d] for r in rows) / total
        assert abs(got - want / sum(TARGETS.values())) < 1e-3


def test_rates_follow_projected_gradient(spark):
    """Against the same steps over single documents in numpy, with rates held at zero."""
    from strata.llm.mixing import fit_rates
    r = np.random.default_rng(1)
    p = r.dirichlet(np.ones(3), 40)
    tokens = r.integers(1, 100, 40).astype(float)
    for want, exact in ((np.array([0.6, 0.3, 0.1]), True), (np.array([0.7, 0.2, 0.1]), False)):
        cells = spark.createDataFrame([([i], float(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p))],
                                      "bins array<int>, tokens double, p array<double>")
        got = {r_["bins"][0]: r_["rate"] for r_ in fit_rates(cells, want.tolist()).collect()}
        rate = np.array([got[i] for i in range(40)])
        inverse = np.linalg.inv((p * tokens[:, None]).T @ p / tokens.sum())
        x = np.ones(40)
        for _ in range(200):
            x = np.maximum(0, x - p @ (inverse @ ((x * tokens) @ p / tokens.sum() - want)))
        def loss(z):
            e = (z * tokens) @ p / tokens.sum() - want
            return e @ inverse @ e
        assert (rate >= 0).all() and loss(rate) <= loss(x) + 1e-3
        assert not exact or loss(rate) < 1e-6


def test_applied_rates_and_edges(documents, labels, edges, empty):
    from strata.llm.mixing import apply_rates, labelled_domains, mix
    marks = labelled_domains(documents, labels)
    rates = {r.doc_id: r.rate for r in mix(documents, marks).collect()}
    out = apply_rates(documents, marks)
    assert out.columns == documents.columns
    copies = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(int(rates[i]) <= copies.get(i, 0) <= int(rates[i]) + 1 for i in rates)
    assert mix(edges, marks).count() == 8 and apply_rates(edges, marks.limit(0)).columns == edges.columns
    assert mix(empty, marks).count() == 0 and apply_rates(empty, marks).count() == 0


# ---------------------------------------------------------------- archives

PAGES = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "u", "é\r\n\r\n"),
         (5, "u", "é\r\n\r\n"), (None, "v", "same"), (0, "w", "x" * 300_000), (9, "z", "x" * 300_000)]


def test_archives_hold_every_record(spark, documents):
    from strata.llm.warc import archive_folder, read_archives, write_archives
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha1", F.lit("clash"))
    folder = archive_folder(spark)
    manifest = write_archives(df.repartition(3), folder, archive_bytes=1000)
    rows = read_archives(manifest, folder).collect()
    assert len(rows) == len(PAGES) and manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    for r in rows:
        payload = next((h or "").encode() for i, _, h in PAGES if i == r.page_id)
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.payload == payload) if r.record_type == "response" else r.payload is None
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert kinds == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), 5: ("response", None),
                     None: ("response", None), 0: ("response", None), 9: ("revisit", 0)}


def test_archive_layout(documents):
    import struct
    import zstandard
    from strata.llm.warc import SKIPPABLE, archive, parse, record, records_of
    records = [record(i, "http://x", f"<html>{i} {'lorem ipsum ' * (i % 50)}</html>".encode(), "D", "response", None) for i in range(500)]
    data = archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == SKIPPABLE and size > 0
    assert list(records_of(data)) == records
    assert len(data) < len(b"".join(zstandard.ZstdCompressor().compress(r) for r in records))
    head, block = parse(records[7])
    assert head["WARC-Type"] == "response" and block.startswith(b"<html>7")
    assert list(records_of(archive(records[:1]))) == records[:1]


def test_small_payloads_and_no_pages(spark, documents):
    from strata.llm.warc import archive_folder, read_archives, write_archives
    df = spark.createDataFrame(PAGES[:2], "page_id long, url string, html string")
    folder = archive_folder(spark)
    assert {r.record_type for r in read_archives(write_archives(df, folder, min_bytes=5), folder).collect()} == {"response"}
    folder = archive_folder(spark)
    assert read_archives(write_archives(df.limit(0), folder), folder).count() == 0


# ---------------------------------------------------------------- vectors

def brute_nearest(rows, k, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            s = x @ x[n]
            order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_of_embeddings(spark, documents):
    from strata.llm.neighbours import nearest
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute_nearest([(r.vec_id, r.embedding) for r in df.collect()], 20, 20)
    got = {}
    for r in nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys() and all(sorted(x[0] for x in v) == list(range(1, 21)) for v in got.values())
    hits = sum(len({x[1] for x in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_copies_ties_and_odd_vectors(spark, documents):
    """Many equal vectors, few others: everything is found, ties go to smaller ids."""
    from strata.llm.neighbours import nearest
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(100, 160)] + [(i, [0.5, float(i), 1.0]) for i in range(5)]
    odd = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 0.0]), (260, [float("nan"), 1.0, 1.0]),
           (280, [float("inf"), 1.0, 1.0]), (300, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (100, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("key", F.lit(2))
    got = {}
    for r in nearest(df, k=20, every=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_nearest(rows, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    assert nearest(df.limit(0)).count() == 0
    assert nearest(spark.createDataFrame(rows[:1], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("n, noise, scale", [(5000, 1e-5, 1.0), (1000, 1.0, 1e-9), (1000, 1.0, 1e6)])
def test_recall_of_near_copies_and_odd_norms(spark, documents, n, noise, scale):
    """Near copies of one unit vector, and vectors outside the range of half precision."""
    from strata.llm.neighbours import nearest
    rng = np.random.default_rng(7)
    one = np.full(64, 0.125)
    x = ((one + rng.uniform(-noise, noise, (n, 64))) * scale).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    want = brute_nearest(rows, 20, 100)
    got = {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=100).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_graph_is_built_until_it_settles(spark, documents, monkeypatch):
    """Rounds end by the share of changed edges; degree and beam grow with the nodes."""
    from strata.llm import neighbours
    rounds = []

    def keep(df, name, real=neighbours.keep_table):
        out = real(df, name)
        rounds.append(out.where("new").count() / max(1, out.count()))
        return out
    x = np.random.default_rng(3).normal(size=(1500, 32)).astype(np.float32)
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "node long, vec array<float>")
    nodes = rows.mapInArrow(neighbours._pack, "node long, vec array<float>, raw binary").cache()
    monkeypatch.setattr(neighbours, "keep_table", keep)
    neighbours.neighbour_graph(nodes)
    assert rounds[-1] <= neighbours.SETTLED < min(rounds[1:-1])
    sizes = [neighbours.widths(n) for n in (0, 2_000, 51_282, 10_000_000)]
    assert sizes[:2] == [(24, 320)] * 2 and sizes[2] < sizes[3] and sizes[2][1] > 320


def test_edges_and_candidates_do_not_travel_one_by_one(spark, documents, monkeypatch):
    """What is written between the steps is a few rows a node and a query, in every round."""
    from strata.llm import neighbours
    kept = []

    def keep(df, name, real=neighbours.keep_table):
        out = real(df, name)
        kept.append(out.count())
        return out
    monkeypatch.setattr(neighbours, "keep_table", keep)
    x = np.random.default_rng(5).normal(size=(2000, 16)).astype(np.float32)
    got = neighbours.nearest(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>"))
    assert got.count() == 100 * 20
    assert max(kept) <= 2 * 2000 + 100 * 21


def test_tables_that_nothing_reads_any_more_go(spark, documents, monkeypatch):
    """Of the kept tables those stay that the answer reads; the session's settings are as before."""
    from urllib.parse import urlparse

    from strata.llm import neighbours
    kept = {}

    def keep(df, name, real=neighbours.keep_table):
        out = real(df, name)
        kept.setdefault(name, []).append(urlparse(out.inputFiles()[0]).path.rsplit("/", 1)[0])
        return out
    monkeypatch.setattr(neighbours, "keep_table", keep)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    x = np.random.default_rng(6).normal(size=(300, 8)).astype(np.float32)
    got = neighbours.nearest(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>"))
    assert spark.conf.get(key) == before
    there = {name for name, paths in kept.items() if any(os.path.exists(p) for p in paths)}
    assert there == {"queries", "alike", "best"} and len(kept["graph"]) > 1
    assert got.count() == 15 * 20


def test_recall_over_many_parts_and_portions(spark, documents, monkeypatch):
    """Every part is searched for every query, whatever portion the query is in."""
    from strata.llm import neighbours
    monkeypatch.setattr(neighbours, "PART_LEAST", 150)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 40)
    monkeypatch.setattr(neighbours, "BEAM", 40)
    x = np.random.default_rng(9).normal(size=(1600, 24)).astype(np.float32)
    rows = list(enumerate(x.tolist()))
    want = brute_nearest(rows, 20, 20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert neighbours.parts_of(df.select(F.col("vec_id").alias("node"), F.lit(b"0" * 96).alias("raw"))) == (1600, 11)
    got = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert got.keys() == want.keys()
    assert all(np.isclose(got[q][i], s) for q in want for i, s in want[q] if i in got[q])
    assert sum(len(got[q].keys() & {i for i, _ in want[q]}) for q in want) / (20 * len(want)) >= 0.9


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages_take_effect(spark, documents):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.lossless for r in rows)
    assert {r.doc_id for r in rows} <= {r.doc_id for r in documents.collect()}


def test_stages_keep_columns_and_take_odd_rows(spark, documents, edges, empty):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "secret_scan", "source_mixing", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, documents, SF)
        assert out.columns == documents.columns, name
        assert stage(spark, edges, SF).columns == edges.columns, name
        assert stage(spark, empty, SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_stage_decisions_equal_their_operators(spark, documents, labels):
    from strata.llm.near_dup import near_duplicates
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in near_duplicates(documents).where("kept").collect()}
    assert {r.doc_id for r in stages["near_dedup"](spark, documents, SF).collect()} == kept
    scanned = stages["secret_scan"](spark, documents, SF)
    assert scanned.count() == documents.count()
    assert scanned.where("text LIKE '%[SECRET]%'").count() > 0
