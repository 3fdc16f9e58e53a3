"""Mixing documents to target domain weights, in DataFrame and SQL functions only.

A naive Bayes classifier, trained on a labelled table over binned text
features, gives each document a posterior over domains (soft membership).
Rates ``r >= 0`` per document are fitted by projected-gradient least squares so
that the expected tokens of each domain, the sum of ``rate * tokens *
posterior``, match ``target * all tokens``.  The residual is weighted by the
inverse of the domains' Gram matrix, which makes the unprojected problem well
conditioned; rates start at 1, so among the exact fits one near the corpus as
it is comes out.

The gradient of a document depends only on its posterior, and that only on its
feature bins: documents with equal bins share a rate, and the iterations run on
one row per combination of bins that occurs.  Each iteration is a distributed
aggregate of one number per domain.

Scale: one pass over the texts writes narrow rows; classifier and gradient are
map-side sums over them, of a size bounded by bins and domains; no key of the
documents (source, domain) is grouped by, so none can be hot.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, keep_table, word_array

#: Letters whose share of the text is a feature, and symbols counted together.
LETTERS = "whqzäéñó"
SYMBOLS = "#*$%&|<>"
#: Upper ends of the bins of the shares (per 1000 characters), lengths (words) and word length (x 10).
SHARE_BINS = (0, 2, 6, 15, 35)
WORD_BINS = (0, 19, 100, 1000)
LENGTH_BINS = (30, 45, 60, 75)
ITERATIONS, TOLERANCE = 200, 1e-7

#: Target weights of the registered query and the pipeline: share of tokens per domain.
TARGETS = {"en": 0.55, "fr": 0.15, "de": 0.15, "es": 0.12, "low": 0.03}


def _bin(value, ends):
    out = F.lit(len(ends))
    for i in reversed(range(len(ends))):
        out = F.when(value <= ends[i], i).otherwise(out)
    return out.cast("int")


def _count(text, what):
    return F.length(text) - F.length(F.replace(text, F.lit(what)))


def with_bins(docs: DataFrame, mix: str = "_mix") -> DataFrame:
    """All columns, the number of words ``<mix>_tokens`` and the feature bins
    ``<mix>_bins`` of ``text``; a null text counts as empty."""
    columns = docs.columns
    t = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("*", t.alias(f"{mix}_text"), F.lower(t).alias(f"{mix}_lower"),
                       F.size(word_array(F.col("text"))).cast("long").alias(f"{mix}_tokens"),
                       F.filter(F.split(t, "\n"), lambda l: F.trim(l) != "").alias(f"{mix}_lines"))
    text, lower, n, lines = (F.col(f"{mix}_{x}") for x in ("text", "lower", "tokens", "lines"))
    chars = F.greatest(F.length(text), F.lit(1))
    symbols = sum((_count(text, s) for s in SYMBOLS[1:]), _count(text, SYMBOLS[0]))
    repeated = 1000 * (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.size(lines), F.lit(1))
    bins = [_bin(F.floor(1000 * _count(lower, x) / chars), SHARE_BINS) for x in LETTERS]
    bins += [_bin(F.floor(1000 * symbols / chars), SHARE_BINS), _bin(n, WORD_BINS),
             _bin(F.floor(10 * chars / F.greatest(n, F.lit(1))), LENGTH_BINS), _bin(repeated, (0, 200, 500))]
    return base.select(*columns, f"{mix}_tokens", F.array(*bins).alias(f"{mix}_bins"))


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, n_tokens, bins)`` per row."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), "text")
    return with_bins(narrow).select("doc_id", "source", F.col("_mix_tokens").alias("n_tokens"),
                                    F.col("_mix_bins").alias("bins"))


def classifier(feats: DataFrame, labelled: DataFrame, domains: list[str]):
    """The posterior over ``domains`` as an array expression over ``bins``, learnt
    from ``labelled(doc_id, domain)``: one array of log-chances per feature and bin."""
    rows = feats.select("doc_id", "bins").join(
        labelled.where(F.col("domain").isin(domains)).select(F.col("doc_id").cast("long").alias("doc_id"), "domain"), "doc_id")
    counts = (rows.select("domain", F.posexplode("bins").alias("feature", "bin"))
              .groupBy("domain", "feature", "bin").agg(F.count("*").alias("n")).collect())
    width = len(LETTERS) + 4
    most = max(len(SHARE_BINS), len(WORD_BINS), len(LENGTH_BINS)) + 1
    table = np.ones((len(domains), width, most))
    for r in counts:  # at most domains x features x bins rows
        table[domains.index(r["domain"]), r["feature"], r["bin"]] += r["n"]
    prior = np.log(table[:, 0].sum(axis=1) / table[:, 0].sum())
    chance = np.log(table / table.sum(axis=2, keepdims=True))
    logs = []
    for k in range(len(domains)):
        total = F.lit(float(prior[k]))
        for j in range(width):
            total = total + F.get(F.array(*[F.lit(float(x)) for x in chance[k, j]]), F.get("bins", F.lit(j)))
        logs.append(total)
    return F.array(*logs)


def posteriors(cells: DataFrame, logs, domains: list[str]) -> DataFrame:
    out = cells.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    out = out.withColumn("odds", F.transform("logs", lambda x: F.exp(x - F.col("top"))))
    return out.withColumn("p", F.transform("odds", lambda x: x / F.aggregate(
        "odds", F.lit(0.0), lambda a, b: a + b))).drop("logs", "top", "odds")


def fit_rates(cells: DataFrame, targets: list[float]) -> DataFrame:
    """``cells(bins, tokens, p)`` with the fitted ``rate``."""
    k = len(targets)
    p = [F.get("p", F.lit(i)) for i in range(k)]
    sums = cells.agg(F.sum("tokens").alias("t"), *[F.sum(F.col("tokens") * p[i] * p[j]).alias(f"m{i}_{j}")
                                                    for i in range(k) for j in range(i, k)]).first()
    total = float(sums["t"] or 0)
    if not total:
        return cells.withColumn("rate", F.lit(1.0))
    gram = np.array([[sums[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float) / total
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    want, best = np.array(targets, float), float("inf")
    current = cells.withColumn("rate", F.lit(1.0))
    for step in range(ITERATIONS):
        row = current.agg(*[F.sum(F.col("rate") * F.col("tokens") * p[i]).alias(f"s{i}") for i in range(k)]).first()
        residual = np.array(list(row), float) / total - want
        pull = inverse @ residual
        loss = float(residual @ pull)  # falls with every step
        if np.abs(residual).max() < TOLERANCE or (step > 10 and loss > 0.9999 * best):
            break
        best = loss
        move = sum((p[i] * float(pull[i]) for i in range(1, k)), p[0] * float(pull[0]))
        current = current.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - move))
        if step % 8 == 7:
            current = keep_table(current, "rates")
    return current


def fit(feats: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``(bins, p, rate)`` for the combinations of bins that occur."""
    domains = sorted(targets)
    logs = classifier(feats, labelled, domains)
    cells = feats.groupBy("bins").agg(F.sum("n_tokens").cast("double").alias("tokens"))
    cells = keep_table(posteriors(cells, logs, domains), "cells")
    rates = fit_rates(cells, [targets[d] / sum(targets.values()) for d in domains])
    return keep_table(rates.select("bins", "p", "rate"), "rates")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens, posterior, rate)`` per row, ``posterior`` a map
    from domain.  ``labelled(doc_id, domain)`` is the labelled table; labels that
    are null or not among the targets teach nothing (without labels posteriors
    are uniform).  Null and empty texts have no tokens and the rate of their
    bins; repeated rows count as often as they occur; an empty table gives none."""
    targets = targets or TARGETS
    feats = keep_table(features(docs), "features")
    names = F.array(*[F.lit(d) for d in sorted(targets)])
    return feats.join(fit(feats, labelled, targets), "bins").select(
        "doc_id", "source", "n_tokens", F.map_from_arrays(names, "p").alias("posterior"), "rate")


def apply_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents (all columns), each as often as its rate says: the whole part
    of the rate, and once more with the chance of the rest, drawn by a hash of the
    id.  The texts are binned a second time rather than shuffled."""
    rates = fit(keep_table(features(docs), "features"), labelled, targets or TARGETS)
    name = free_name(docs.columns, "_mix")
    rate, n = (F.col(f"{name}_{x}") for x in ("rate", "n"))
    rows = with_bins(docs, name).join(rates.select(F.col("bins").alias(f"{name}_bins"), F.col("rate").alias(f"{name}_rate")),
                                      f"{name}_bins")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1 << 30)) / (1 << 30)
    whole = F.floor(rate)
    copies = (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("int")
    return (rows.withColumn(f"{name}_n", copies).where(n > 0)
            .withColumn(f"{name}_i", F.explode(F.sequence(F.lit(1), n))).select(*docs.columns))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the registered query: labelled documents are of domain
    ``low`` if marked as of low quality, else of their language's."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("quality IS NOT NULL")
            .join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang"), "doc_id")
            .select("doc_id", F.when(F.col("quality") == 0, F.lit("low")).otherwise(F.col("lang")).alias("domain")))
