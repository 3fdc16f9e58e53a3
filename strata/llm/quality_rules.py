"""Quality rules with adaptive thresholds, in DataFrame and SQL functions only.

Four rates of each text are compared with fences of its language and source:
``q75 + max(3 * (q75 - q25), slack)`` above and, for the word length, the
mirror image below.  Quantiles come from mergeable sketches: counts per bucket,
where a value keeps its eight leading bits (relative error under 1/128).
Sketches merge by adding, so those of a language and of the whole corpus are
sums of those of the sources; a group of fewer than ``MIN_GROUP`` documents uses
its language's, and a small language the corpus's.  Sums do not depend on the
order of rows or on lost tasks.

Scale: one pass over the texts; the statistics (narrow rows) are written once
and read twice.  A sketch has at most a few thousand buckets whatever its
group's size, is summed map-side, and is joined to the rows by language and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep_table, word_array

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
MIN_GROUP = 100

#: Rate: (numerator, denominator, factor, slack, has a lower fence).
RATES = {"symbol_rate": ("n_symbols", "word_chars", 10_000, 200, False),
         "dup_line_rate": ("n_dup_lines", "n_lines", 10_000, 2_000, False),
         "repeat_rate": ("n_repeat_words", "n_words", 10_000, 1_000, False),
         "word_length": ("word_chars", "n_words", 100, 100, True)}


def _let(value, body):
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words, size: int = WINDOW):
    """Words inside windows of ``size`` words that occur twice or more (by 64-bit hash)."""
    def covered(at):
        return F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(at, i + 1) - p, F.lit(size)))),
                           F.lit(0), lambda a, b: a + b)

    def repeated(pairs):
        at = F.transform(pairs, lambda x, i: F.when(
            F.get(pairs, i - 1)["h"].eqNullSafe(x["h"]) | F.get(pairs, i + 1)["h"].eqNullSafe(x["h"]), x["i"]))
        return _let(F.sort_array(F.filter(at, lambda p: p.isNotNull())), covered)

    def of_hashes(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(pairs, repeated)).otherwise(0)
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) > size, _let(hashes, of_hashes)).otherwise(0)


def statistics(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source and the counts of its text (null: empty)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), t.alias("t"), word_array(F.col("text")).alias("w"),
                       lines.alias("l"))
    return base.select("doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"),
                       F.length(F.translate("t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
                       (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                       F.size("l").cast("long").alias("n_lines"),
                       (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                       repeat_words(F.col("w")).cast("long").alias("n_repeat_words"))


def _rate(name: str):
    top, bottom, factor, _, _ = RATES[name]
    return F.expr(f"CASE WHEN {bottom} > 0 THEN {factor} * {top} DIV {bottom} ELSE 0 END")


def sketches(stats: DataFrame) -> DataFrame:
    """``(level, lang, source, rate, bucket, n)`` for sources (level 0), languages
    (1) and the corpus (2); texts without words are left out."""
    long = stats.where("n_words > 0").select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(k).alias("rate"), _rate(k).alias("v")) for k in RATES])).alias("x"))
    v = F.col("x.v")
    step = F.expr("shiftleft(1L, greatest(length(bin(x.v)) - 8, 0))")
    fine = long.select("lang", "source", "x.rate", (v - v % step).alias("bucket")).groupBy(
        "lang", "source", "rate", "bucket").agg(F.count("*").alias("n"))
    fine = keep_table(fine, "sketches")
    by_lang = fine.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n"))
    whole = by_lang.groupBy("rate", "bucket").agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    return (fine.select(F.lit(0).alias("level"), "lang", "source", "rate", "bucket", "n")
            .union(by_lang.select(F.lit(1), "lang", none, "rate", "bucket", "n"))
            .union(whole.select(F.lit(2), none, none, "rate", "bucket", "n")))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``n``, ``q25`` and ``q75`` of each sketch: the least bucket that reaches the
    share.  A sketch is one sorted array of at most a few thousand buckets."""
    def at(quarter):
        start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("long").alias("v"))
        return F.aggregate("b", start, lambda a, x: F.struct(
            (a["c"] + x["n"]).alias("c"),
            F.coalesce(a["v"], F.when(4 * (a["c"] + x["n"]) >= quarter * F.col("n"), x["bucket"])).alias("v")))["v"]
    one = sketch.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("b"),
                                    F.sum("n").alias("n"))
    return one.select(*keys, "n", at(1).alias("q25"), at(3).alias("q75"))


def fences(sketch: DataFrame) -> DataFrame:
    """``(lang, source, <rate>_hi, <rate>_lo)`` for each source of each language."""
    q = quantiles(sketch, ["level", "lang", "source", "rate"])
    value = F.struct("n", "q25", "q75")
    wide = q.groupBy("level", "lang", "source").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("rate") == k, value)).alias(k) for k in RATES])
    level = {i: wide.where(F.col("level") == i).drop("level") for i in range(3)}
    a, b = level[0].alias("a"), level[1].drop("source").alias("b")
    joined = a.join(b, F.expr("a.lang <=> b.lang"))
    whole = level[2].first()  # one row: the corpus

    def of_corpus(rate):
        q = whole[rate] if whole else None
        return F.struct(*[F.lit(q[x] if q else None).cast("long").alias(x) for x in ("n", "q25", "q75")])
    columns = [F.col("a.lang").alias("lang"), F.col("a.source").alias("source")]
    for k, (_, _, _, slack, lower) in RATES.items():
        s = F.when(F.col("a.n") >= MIN_GROUP, F.col(f"a.{k}")).when(
            F.col("b.n") >= MIN_GROUP, F.col(f"b.{k}")).otherwise(of_corpus(k))
        spread = F.greatest(3 * (s["q75"] - s["q25"]), F.lit(slack))
        columns.append((s["q75"] + spread).alias(f"{k}_hi"))
        if lower:
            columns.append((s["q25"] - spread).alias(f"{k}_lo"))
    return joined.select(*columns)


def quality(docs: DataFrame) -> DataFrame:
    """Counts and verdict per row.  ``base_failed``: fewer than 20 words, or over
    30 % of them in repeated windows.  ``kept``: not failed and within the fences
    of its language and source (null languages and sources are groups of their
    own).  Null texts count as empty and fail; repeated rows are each returned."""
    stats = keep_table(statistics(docs), "statistics")
    limits = fences(sketches(stats))
    on = F.expr("s.lang <=> f.lang AND s.source <=> f.source")
    rows = stats.alias("s").join(limits.alias("f"), on, "left")
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    inside = F.lit(True)
    for k, (_, _, _, _, lower) in RATES.items():
        inside = inside & (_rate(k) <= F.col(f"{k}_hi"))
        if lower:
            inside = inside & (_rate(k) >= F.col(f"{k}_lo"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), F.coalesce(~failed & inside, F.lit(False)).alias("kept"))


_FENCE_SQL = ",\n".join(
    f"max(CASE WHEN rate = '{k}' THEN q75 + greatest(3 * (q75 - q25), {r[3]}) END) AS {k}_hi"
    + (f",\nmax(CASE WHEN rate = '{k}' THEN q25 - greatest(3 * (q75 - q25), {r[3]}) END) AS {k}_lo" if r[4] else "")
    for k, r in RATES.items())
_RATE_SQL = {k: f"CASE WHEN {r[1]} > 0 THEN {r[2]} * {r[0]} // {r[1]} ELSE 0 END" for k, r in RATES.items()}
_INSIDE_SQL = " AND ".join(f"{_RATE_SQL[k]} <= {k}_hi" + (f" AND {_RATE_SQL[k]} >= {k}_lo" if r[4] else "")
                           for k, r in RATES.items())
_LONG_SQL = " UNION ALL ".join(
    f"SELECT lang, source, '{k}' AS rate, {_RATE_SQL[k]} AS v FROM st WHERE n_words > 0" for k in RATES)

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, sum(least(8, coalesce(nx - i, 8)))::BIGINT AS n
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM rep) GROUP BY r),
st AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words,
              length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
              (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
              len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
              coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov USING (r)),
lv AS ({_LONG_SQL}),
bk AS (SELECT lang, source, rate, v - v % (1::BIGINT << greatest(length(bin(v)) - 8, 0)) AS bucket FROM lv),
sk AS (SELECT CASE WHEN grouping(lang) = 1 THEN 2 ELSE grouping(source) END AS level, lang, source, rate, bucket, count(*) AS n
       FROM bk GROUP BY GROUPING SETS ((lang, source, rate, bucket), (lang, rate, bucket), (rate, bucket))),
cu AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS c,
              sum(n) OVER (PARTITION BY level, lang, source, rate) AS total FROM sk),
q AS (SELECT level, lang, source, rate, max(total) AS total, min(bucket) FILTER (4 * c >= total) AS q25,
             min(bucket) FILTER (4 * c >= 3 * total) AS q75 FROM cu GROUP BY ALL),
pick AS (SELECT a.lang, a.source, a.rate,
                CASE WHEN a.total >= {MIN_GROUP} THEN a.q25 WHEN b.total >= {MIN_GROUP} THEN b.q25 ELSE c.q25 END AS q25,
                CASE WHEN a.total >= {MIN_GROUP} THEN a.q75 WHEN b.total >= {MIN_GROUP} THEN b.q75 ELSE c.q75 END AS q75
         FROM q a JOIN q b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang AND a.rate = b.rate
         JOIN q c ON c.level = 2 AND a.rate = c.rate WHERE a.level = 0),
f AS (SELECT lang, source, {_FENCE_SQL} FROM pick GROUP BY lang, source),
o AS (SELECT st.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
             {_INSIDE_SQL} AS inside
      FROM st LEFT JOIN f ON st.lang IS NOT DISTINCT FROM f.lang AND st.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND inside, false) AS kept FROM o"""
