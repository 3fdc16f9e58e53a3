"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import divergence, quality_rules
from strata.llm.common import ship_package

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir.rstrip("/"))
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@register("op1_minhash_near_dedup")
def op1(spark, sf_dir):
    """Near-duplicate classes of ``documents`` over 4-word shingles, similarity 0.8."""
    from strata.llm.near_dup import near_duplicates
    return near_duplicates(_read(spark, sf_dir, "documents"), width=4, percent=80)


@register("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity score of every document."""
    from strata.llm.toxicity import toxicity
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@register("op2_secret_scan")
def op2(spark, sf_dir):
    """Secret spans of every document."""
    from strata.llm.secret_scan import digests, scan
    return digests(scan(_read(spark, sf_dir, "documents")))


@register("op7_sentencepiece_sampling")
def op7(spark, sf_dir):
    """Sampled pieces of every document and the round trip."""
    from strata.llm.sentencepieces import round_trip
    return round_trip(_read(spark, sf_dir, "documents"))


@register("op4_language_id")
def op4(spark, sf_dir):
    """Predicted language of every document."""
    from strata.llm.langid import language
    return language(_read(spark, sf_dir, "documents"))


@register("op5_quality_rules", quality_rules.ORACLE)
def op5(spark, sf_dir):
    """Counts and adaptive verdict of every document."""
    return quality_rules.quality(_read(spark, sf_dir, "documents"))


@register("op3_source_mixing")
def op3(spark, sf_dir):
    """Domain posterior and fitted rate of every document."""
    from strata.llm.mixing import labelled_domains, mix
    docs = _read(spark, sf_dir, "documents")
    return mix(docs, labelled_domains(docs, _read(spark, sf_dir, "labels")))


@register("op8_warc_round_trip", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT b, min(page_id) AS first_id FROM p WHERE page_id IS NOT NULL GROUP BY b)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM (SELECT p.*, f.first_id,
             list_aggregate(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + list_aggregate(list_transform(range(0, 5), lambda k: ((('0x' || substr(sha1(p.b), 1 + (g * 5 + k) // 4, 1))::INTEGER
                 >> (3 - (g * 5 + k) % 4)) & 1) << (4 - k)), 'sum')::INTEGER, 1)), 'string_agg', '') AS digest
      FROM p LEFT JOIN f ON p.b = f.b)""")
def op8(spark, sf_dir):
    """Pages written as archives and read back."""
    from strata.llm.warc import archive_folder, read_archives, write_archives
    folder = archive_folder(spark)
    manifest = write_archives(_read(spark, sf_dir, "pages"), folder, min_bytes=0)
    return read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_hmm_language_model")
def op6(spark, sf_dir):
    """Unigram and hidden Markov log-probabilities of every document."""
    from strata.llm.lm import language_model
    return language_model(_read(spark, sf_dir, "documents"))


@register("op9_nearest_neighbours")
def op9(spark, sf_dir):
    """The 20 nearest others of every 20th row of ``embeddings``."""
    from strata.llm.neighbours import nearest
    return nearest(_read(spark, sf_dir, "embeddings"), k=20, every=20)


@register("op11_periodic_runs")
def op11(spark, sf_dir):
    """Periodic runs of words of every document, a tenth of them folded at the tail."""
    from strata.llm.periodic_runs import audit_runs, fold_tail
    return audit_runs(_read(spark, sf_dir, "documents"), before=fold_tail)


@register("op12_source_divergence", divergence.ORACLE)
def op12(spark, sf_dir):
    """Divergence of every two sources of a language, and each source's leading terms."""
    return divergence.source_divergence(_read(spark, sf_dir, "documents"))


@register("op13_html_extraction")
def op13(spark, sf_dir):
    """Main text of every page."""
    from strata.llm.main_text import extract
    return extract(_read(spark, sf_dir, "pages"))
