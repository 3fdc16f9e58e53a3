"""Rows with shared ids, clashing column names, column order and held-out flags."""

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string"
LONG = " ".join(f"word{i}" for i in range(60))
NEAR = LONG + " and one"


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    from strata.llm.common import ship_package
    ship_package(spark)


def test_near_dedup_judges_rows_not_ids(spark):
    from strata.llm.near_dup import drop_near_duplicates
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(1, LONG, "a"), (5, NEAR, "b"), (5, other, "c"),         # a clean text under the id of a near copy
            (7, "some text of its own here", "d"), (7, "some text of its own here", "e"),  # one row under an id twice
            (8, None, "f"), (8, "", "g"), (None, LONG, "h"), (None, LONG, "i"), (9, "x", "j")]
    got = drop_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    texts = sorted((r.doc_id or 0, (r.text or "")[:8]) for r in got)
    assert (5, "other0 o") in texts and (7, "some tex") in texts and (9, "x") in texts
    assert [t for t in texts if t[0] == 7] == [(7, "some tex")]
    assert sum(t[0] == 0 for t in texts) == 2 and sum(t[0] == 8 for t in texts) == 1
    assert len([t for t in texts if t[0] and t[1] == LONG[:8]]) == 1


def test_near_dedup_of_a_shuffled_id_list_and_clashing_columns(spark, monkeypatch):
    from strata.llm import near_dup
    rows = [(1, LONG, "a"), (5, NEAR, "b"), (5, "clean text with its own few words", "c")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"_near_key": F.lit("x"), "_NEAR_several": F.lit("y")})
    monkeypatch.setattr(near_dup, "BROADCAST_NODES", 0)
    got = near_dup.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert {r.text[:5] for r in got.collect()} in ({"word0", "clean"},)


def test_mixing_takes_columns_of_its_own_names(spark):
    from strata.llm.mixing import apply_rates
    docs = spark.createDataFrame([(i, "der die das und " * 9, "de") for i in range(20)], DOCS).withColumns(
        {"_mix_rate": F.lit(1), "_mix_bins": F.lit(2), "_MIX_N": F.lit(3), "_mix_i": F.lit(4)})
    labels = docs.select("doc_id", F.col("lang").alias("domain"))
    got = apply_rates(docs, labels, {"de": 1.0})
    assert got.columns == docs.columns and got.count() == 20


def test_columns_of_the_secret_digest(spark):
    from strata.llm.secret_scan import digests, scan
    got = digests(scan(spark.createDataFrame([(1, "token: abcdefghijkl1234 x", None)], DOCS)))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]


def test_held_out_is_never_null(spark):
    from strata.llm.langid import language
    from strata.llm.toxicity import toxicity
    docs = spark.createDataFrame([(None, "ein text", "de"), (1, "one text", "en"), (2, "noch ein text", "de")], DOCS)
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert all(r.held_out is not None for r in language(docs).collect())
    assert all(r.held_out is not None for r in toxicity(docs, labels).collect())


def test_norms_of_a_block_are_those_of_its_words(monkeypatch):
    from strata.llm import toxicity as t
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(33, 127, int(n), dtype=np.uint8)) for n in rng.integers(1, 40, 200)] + [b"a", b"ab"]
    data = np.frombuffer(b"".join(words), np.uint8)
    length = np.array([len(w) for w in words])
    want = [sum(v * v for v in t.word_vector(w).values()) ** 0.5 for w in words]
    assert np.allclose(t.word_norms(data, length), want)
    monkeypatch.setattr(t, "NORM_BLOCK", 64)
    assert np.allclose(t.word_norms(data, length), want)


def test_pieces_passed_over_have_no_window_at_the_floor():
    from strata.llm import toxicity as t
    marks = t.Landmarks.of([b"idiot", b"stupid", b"loser", b"moron"])
    rng = np.random.default_rng(1)
    words = []
    for _ in range(300):
        w = bytearray(rng.integers(97, 123, int(rng.integers(8, 60)), dtype=np.uint8).tobytes())
        if rng.random() < 0.4:
            at, mark = int(rng.integers(0, len(w))), marks.words[int(rng.integers(0, 4))]
            w[at:at] = b"-".join(mark[i:i + 1] for i in range(len(mark))) if rng.random() < 0.3 else mark
        words.append(bytes(w))
    data, length = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    widths = [np.array([f(len(w)) for w in marks.words], np.int64) for f in t.WINDOWS]
    plain = marks._of_pieces(data, length, length, widths, chosen=True)
    quick = marks._of_pieces(data, length, length, widths)
    as_set = lambda found: sorted(zip(found[0].tolist(), found[1].tolist(), np.round(found[2], 9).tolist()))
    assert as_set(quick) == as_set(plain) and len(plain[0]) > 50


def test_words_without_a_window_at_the_floor_are_told_and_remembered(monkeypatch):
    from strata.llm import toxicity as t
    marks = t.Landmarks.of([b"idiot", b"stupid", b"loser"])
    rng = np.random.default_rng(2)
    words = [rng.integers(97, 105, int(n), dtype=np.uint8).tobytes() for n in rng.integers(1, 30, 400)]
    words += [w[:5] + m + w[5:] for w in words[:80] for m in marks.words] + [b"x-" + b"-".join([b"i", b"d", b"i", b"o", b"t"]) + b"-y"]
    data, length = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    may = np.zeros(len(words), bool)
    marks.of_words(data, length, may)
    found = marks.of_windows(data, length)[0]
    assert may[found].all() and not may.all()
    text = b" ".join(words) + b" "
    buf, offsets = np.frombuffer(text * 3, np.uint8), np.arange(4) * len(text)
    whole = marks.of_texts(buf, offsets)
    fresh = t.Landmarks.of(marks.words).of_texts(buf, offsets)
    monkeypatch.setattr(t, "REMEMBERED", 10)
    forgetful = t.Landmarks.of(marks.words)
    parts = [forgetful.of_texts(buf[:len(text)], offsets[:2]) for _ in range(3)]
    assert np.allclose(marks.of_texts(buf, offsets), whole) and np.allclose(whole, fresh)
    assert all(np.allclose(p[0], whole[0]) for p in parts)
