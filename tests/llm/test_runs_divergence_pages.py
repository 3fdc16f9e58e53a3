"""Periodic runs, source divergence and main text against brute force, SQL and stated pages."""

from __future__ import annotations

import hashlib
import html as html_module
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from strata.llm import divergence, main_text, periodic_runs, queries

SF = "/root/testdata/sf0.001"


# ---- periodic runs -------------------------------------------------------------

def lyndon_brute(x):
    """Longest Lyndon word at each place, from the definition."""
    out = []
    for i in range(len(x)):
        fits = [n for n in range(1, len(x) - i + 1)
                if all(x[i:i + n] < x[i + k:i + n] for k in range(1, n))]
        out.append(max(fits))
    return out


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(a == b for a, b in zip(w, w[q:])))


def runs_brute(x, exponent, min_length):
    """Every stretch is looked at: its smallest period, and whether a neighbour keeps it."""
    n, out = len(x), []
    for s in range(n):
        for e in range(s + 1, n + 1):
            q = smallest_period(x[s:e])
            if (e - s >= max(min_length, exponent * q) and not (s and x[s - 1] == x[s - 1 + q])
                    and not (e < n and x[e] == x[e - q])):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng, n):
    x = [rng.randrange(rng.randint(1, 4)) for _ in range(n)]
    if n and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randint(1, 5)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    return x


def test_lyndon_array_is_that_of_the_definition_under_both_orders():
    rng = random.Random(5)
    for _ in range(400):
        x = random_words(rng, rng.randint(0, 22))
        for y in (x, [-v for v in x]):
            assert periodic_runs.lyndon_array(np.array(y, np.int64)).tolist() == lyndon_brute(y)


@pytest.mark.parametrize("exponent,min_length", [(4, 6), (2, 2), (3, 4)])
def test_runs_are_those_of_every_stretch(exponent, min_length):
    rng = random.Random(exponent)
    for _ in range(150):
        x = random_words(rng, rng.randint(0, 24))
        a = np.array(x, np.int32)
        want = runs_brute(x, exponent, min_length)
        assert periodic_runs.word_runs(a, exponent, min_length) == want
        assert periodic_runs.runs_of(a, exponent, min_length) == want


def test_nested_and_touching_runs():
    x = ([0] * 7 + [1]) * 5 + [2, 3] * 5
    assert periodic_runs.runs_of(np.array(x, np.int32)) == runs_brute(x, 4, 6)


def run_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs, dropped = runs_brute(words, 4, 6), set()
    for s, length, q in runs:
        dropped |= set(range(s + q, s + length))
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


RUN_TEXTS = [None, "", "  \t ", "a", "a a a a a", "a a a a a a", "x " + "a b " * 4 + "y", "a b c " * 3,
             "A a A a A a A a", "z\x0bz\x0cz z z\nz", "é è " * 4, "n b " * 6, "p q r p q r p q r p q r p q s"]


def test_run_query_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, t, 1) for i, t in enumerate(RUN_TEXTS)] + [(3, "a", 1), (None, "k k k k k k k", 2)]
    tenth = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows += [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))), 0) for i in tenth]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs int")
    got = periodic_runs.audit_runs(docs, before=periodic_runs.fold_tail).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(run_row(i, t)) for i, t, _ in rows)


def test_runs_of_an_empty_table_and_a_very_long_text(spark):
    schema = "doc_id long, text string"
    assert periodic_runs.audit_runs(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(str(i) for i in range(300_000)) + " stuck here" * 100_000
    row = periodic_runs.audit_runs(spark.createDataFrame([(1, text)], schema)).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 300_000, 200_000, 2)


def test_collapse_keeps_columns_and_clean_texts(spark):
    docs = spark.createDataFrame([(1, "go  on", "x"), (2, "s " + "a b " * 6 + "e", None), (3, None, "z")],
                                 "doc_id long, text string, start string")
    got = {r.doc_id: (r.text, r.start) for r in periodic_runs.collapse_runs(docs).collect()}
    assert got == {1: ("go  on", "x"), 2: ("s a b e", None), 3: (None, "z")}


# ---- source divergence ---------------------------------------------------------

DIVERGENCE = "doc_id long, text string, lang string, source string, rank string, value int, term string"


def by_sql(docs):
    con = duckdb.connect()
    con.register("given", docs.select("doc_id", "text", "lang", "source").toArrow())
    con.sql("CREATE TABLE documents AS SELECT * FROM given")
    return sorted(con.sql(divergence.ORACLE).fetchall())


def test_divergence_equals_sql_with_nulls_ties_and_groups_without_terms(spark):
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "gamma", "été", "Été", "x-y", "don't", "a1b", "数据", "İx"]
    rows = [(i % 40, " ".join(rng.choice(vocabulary[:3 + i % 8]) for _ in range(rng.randint(0, 12))),
             rng.choice(["en", "en", None, "fr"]), rng.choice(["s1", "s1", "s2", None, "s3"]), "r", 1, "t")
            for i in range(260)]
    rows += [(900, None, "en", "bare", "r", 1, "t"), (901, "12 34", "en", "digits", "r", 1, "t"),
             (902, "seldom", "xx", "p", "r", 1, "t"), (903, "", "xx", "q", "r", 1, "t"), (904, "one", "yy", "only", "r", 1, "t")]
    rows += [(7, "alpha " * 50, "en", "s1", "r", 1, "t")] * 30
    docs = spark.createDataFrame(rows, DIVERGENCE)
    want = by_sql(docs)
    for shard_rows in (divergence.SHARD_ROWS, 5):  # one shard, and many
        got = divergence.source_divergence(docs, shard_rows=shard_rows)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == want
    assert ("xx", "p", "pair", "q", 0, 1) in want


def test_divergence_in_small_blocks_and_slices(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = by_sql(docs)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 64)   # seen by the pickled task through its module
    counts = divergence.partial_counts(docs)
    assert counts.where("term is null").agg({"docs": "sum"}).first()[0] == docs.count()
    assert sorted(map(tuple, divergence.source_divergence(docs).collect())) == want


def test_shard_blocks_give_the_same_sums(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(1)
    sources = [f"s{i}" for i in range(7)]
    cells = [(s, f"t{t}", int(rng.integers(1, 9))) for s in sources for t in range(30) if rng.random() < 0.4]
    total = {s: sum(n for a, _, n in cells if a == s) for s in sources}
    lang_n = {}
    for _, t, n in cells:
        lang_n[t] = lang_n.get(t, 0) + n
    counts = pa.table({"source": [c[0] for c in cells], "term": [c[1] for c in cells],
                       "n": [c[2] for c in cells], "lang_n": [lang_n[c[1]] for c in cells]})
    groups = pa.table({"lang": ["l"] * 7, "source": sources, "kept": [len(lang_n)] * 7,
                       "lang_total": [sum(lang_n.values())] * 7, "total": [total[s] for s in sources]})
    whole = divergence._shard(counts, groups, 10).to_pylist()
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 14)
    key = lambda r: sorted(r.items())
    assert sorted(divergence._shard(counts, groups, 10).to_pylist(), key=key) == sorted(whole, key=key)


def test_shares_are_exact_beyond_64_bits():
    n = np.array([10 ** 12, 5], np.int64)
    total = np.array([3 * 10 ** 12, 7], np.int64)
    assert divergence._shares(n, total, 11).tolist() == [1 + 10 ** 9 * (a + 2) // (b + 22) for a, b in zip(n.tolist(), total.tolist())]


def test_divergence_of_an_empty_table(spark):
    assert divergence.source_divergence(spark.createDataFrame([], DIVERGENCE)).collect() == []


# ---- main text -----------------------------------------------------------------

def cut_cost(gain, edges, labels):
    return (sum(-g for g, y in zip(gain, labels) if g < 0 and y) + sum(g for g, y in zip(gain, labels) if g > 0 and not y)
            + sum(w for a, b, w in edges if labels[a] != labels[b]))


def test_min_cut_costs_what_the_best_labelling_costs():
    rng = random.Random(2)
    for _ in range(600):
        n = rng.randint(1, 8)
        gain = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 5)) for _ in range(rng.randint(0, 14))]
        best = min(cut_cost(gain, edges, y) for y in itertools.product([False, True], repeat=n))
        assert cut_cost(gain, edges, main_text.min_cut(gain, edges)) == best


def article_of(page):
    """The article of the given pages, which all follow one template."""
    body = page[page.index("<article>") + 9:].split("</article>")[0]
    body = re.sub(r"<[^>]*$", "", body)
    blocks = [" ".join(html_module.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_given_pages_give_their_article(spark):
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    got = queries.queries()["op13_html_extraction"](spark, "/root/testdata/sf0.01").collect()
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in got} == {
        p["page_id"]: (p["url"], article_of(p["html"]), len(article_of(p["html"]))) for p in pages}


FULL = """<html><head><title>T</title><style>p{}</style></head><body class="no-sidebar has-ads">
<header><h1>Site</h1><a href=/>Home</a></header><nav><a href="/a">A</a> <a href=/b>B</a></nav>
<div class="cookie-notice">We use cookies on this site to make it better, and to measure its use.</div>
<div class="layout-with-sidebar"><main><article><header><h1>Title &lt;here&gt;</h1></header>
<p>Long text is here, and it goes on &amp; on for quite a while.\n It has two sentences.<p>Ok.
<aside>Related stuff that is here and is long enough to be a sentence of the article.</aside>
<div class="ad">Buy this thing now, it is good for you, your house and your friends.</div>
<ul><li>One item<li>Two items</ul><form><p>Sign up for our letter now, please, it is free.</p><input></form>
<p title="a > b">1 < 2 &nbsp; and 3.</p><script>if (a < b) document.write("<p>x</p>")</script>
<section id="comments"><h2>Comments</h2><p>I like this text a lot, it is the best one I read this year.</p></section>
</article></main><div class="sidebar"><p>Some other text of the site, which is long enough to be read, too.</p></div></div>
<div role="alert">Please note that our office stays closed this week, from Monday on.</div>
<footer>&copy; 2024 Somebody</footer></body></html>"""

PLAIN = """<body><div><a href=/>Home</a> | <a href=/x>News</a> | <a>About</a></div><div><h2>Some title of the day</h2>
<div>The story begins here, with a sentence that goes on for some time. Then there is another.</div><div>Yes.</div>
<div>And a third paragraph which is also long enough, I think, to be main text.</div></div>
<div><a href=1>Link one</a> <a href=2>Link two</a></div><div>© 2020 Corp | All rights</div></body>"""


def test_parts_that_are_not_the_article_go():
    got = main_text.main_text(FULL, main_text.DEFAULT_SHAPE).split("\n")
    assert got == ["Title <here>", "Long text is here, and it goes on & on for quite a while. It has two sentences.",
                   "Ok.", "One item", "Two items", "1 < 2 and 3."]


def test_a_page_without_named_parts_is_told_by_shape_and_neighbours():
    got = main_text.main_text(PLAIN, main_text.DEFAULT_SHAPE).split("\n")
    assert [g[:9] for g in got] == ["Some titl", "The story", "Yes.", "And a thi"]
    page = main_text.Page(PLAIN)
    alone = (np.array(page.shape) @ main_text.DEFAULT_SHAPE) > 0  # without the cut the short line is lost
    assert not alone[page.texts.index("Yes.")]


def test_shape_model_follows_its_blocks():
    rng = np.random.default_rng(4)
    n = 400
    y = rng.integers(0, 2, n)
    x = np.zeros((n, len(main_text.DEFAULT_SHAPE)))
    x[:, 0], x[:, 3] = 1, np.where(y == 1, 0.1, 0.9)
    w = main_text.fit_shape(x, y)
    assert w[3] < 0 and (((x @ w) > (x @ w).mean()) == (y == 1)).all()
    assert (main_text.fit_shape(x, np.ones(n, int)) == main_text.DEFAULT_SHAPE).all()


def test_deeply_nested_pages_and_stray_closing_tags():
    deep = "<article>" + "<div>A line of text, with a few words.</p></li>" * 20_000
    assert main_text.main_text(deep, main_text.DEFAULT_SHAPE).count("\n") == 19_999


def test_extraction_edges(spark):
    rows = [(1, "u", None), (1, "u", ""), (2, None, "   "), (3, "u", "<article><p>a &amp"), (3, "u", "<article><p>a &amp"),
            (4, "u", "<p"), (5, "u", "<article><p>x</p><foot"), (None, "u", "<article><h1>no id</h1></article>"),
            (6, "u", "<article>" + "<p>very long page, with a sentence.</p>" * 100_000), (7, "u", "<div>" * 30_000 + "deep"),
            (8, "u", "<article><p>a<!-- <p>b -->c</p><p>d<!-- open")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(map(repr, ((r.page_id, r.url, r.text[:24], r.n_chars) for r in main_text.extract(pages).collect())))
    long = "\n".join(["very long page, with a sentence."] * 100_000)
    want = [(1, "u", "", 0), (1, "u", "", 0), (2, None, "", 0), (3, "u", "a &", 3), (3, "u", "a &", 3), (4, "u", "", 0),
            (5, "u", "x", 1), (None, "u", "no id", 5), (6, "u", long[:24], len(long)), (8, "u", "ac\nd", 4)]
    assert [g for g in got if not g.startswith("(7,")] == sorted(map(repr, want))
    assert main_text.extract(pages.where("false")).collect() == []
