"""Catalogue entries: silver cleaning / dedup, gold aggregates, quality,
incremental loads and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import not_blank, ts_text
from strata.operators import gold, incremental, quality, silver
from strata.plans import fixtures as fx
from strata.plans.queries import AS_OF, F1_SILVER_SQL, f1_layers, register
from strata.session import scratch_path
from strata.sinks.writers import expire_partitions, read_current, write, write_fingerprinted, write_version
from strata.sources.tables import table

W = fx.with_ctes
TS = "'%Y-%m-%d %H:%M:%S'"


# ---------------------------------------------------------------- medallion (M1 slice)

@register("medallion_gold", W(F1_SILVER_SQL) + """
SELECT coalesce(prio, 'unknown') AS prio, count(*) AS "count" FROM silver GROUP BY 1""")
def medallion_gold(spark, sf_dir):
    """M1 flagship: bronze (F1) -> required key -> keep-first -> count by group."""
    return f1_layers(spark, sf_dir).gold


@register("medallion_gold_members", W(F1_SILVER_SQL) + """
SELECT coalesce(prio, 'unknown') AS prio, id, ord FROM silver""")
def medallion_gold_members(spark, sf_dir):
    """A1 member list in long form: (group, member id, file-order ordinal)."""
    return f1_layers(spark, sf_dir).members


@register("silver_keep_first", W(F1_SILVER_SQL) + "SELECT ord, id, prio, status, price FROM silver")
def silver_keep_first(spark, sf_dir):
    """P4 + D1: non-blank key, first row per key in file order."""
    return f1_layers(spark, sf_dir).silver


# ---------------------------------------------------------------- silver

@register("silver_keep_latest", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def silver_keep_latest(spark, sf_dir):
    """Latest line per (order, line number), ties broken on every column."""
    li = table(spark, sf_dir, "lineitem")
    return silver.keep_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("silver_distinct_rows", W(fx.F1_SQL) + "SELECT DISTINCT id, prio, price FROM f1")
def silver_distinct_rows(spark, sf_dir):
    """Whole-row distinct over the data columns (the ordinal is provenance)."""
    b = fx.messy_orders(spark, sf_dir).select(F.col("ord").alias("_ord"), "id", "prio", "price")
    return silver.distinct_rows(b).drop("_ord")


@register("silver_drop_any_null", W(fx.F1_SQL) + """
SELECT * FROM f1 WHERE ord IS NOT NULL AND id IS NOT NULL AND prio IS NOT NULL
  AND status IS NOT NULL AND price IS NOT NULL""")
def silver_drop_any_null(spark, sf_dir):
    """Drop rows with a null in any column."""
    return silver.drop_nulls(fx.messy_orders(spark, sf_dir))


@register("silver_required_cols", W(fx.F2_SQL) + """
SELECT * FROM f2 WHERE email IS NOT NULL AND phone IS NOT NULL""")
def silver_required_cols(spark, sf_dir):
    """Drop rows with a null in the required columns."""
    return silver.drop_nulls(fx.messy_contacts(spark, sf_dir), ["email", "phone"])


# The reference's accepted statuses, and in the query its flag names.  The
# rest is the rules of P11, P12 and P15 put independently of the Spark side.
_STATUSES = "['active', 'inactive', 'suspended']"
_FACTS_SQL = """,
facts AS (SELECT *, array_to_string(list_filter(string_split(phone, ''), lambda c: contains('0123456789', c)), '') AS digits,
                 strpos(email, '@') AS at_sign FROM f2)
"""
_NORMALISED_SQL = f"""
SELECT customer_id, source_system, list_extract(list_filter({_STATUSES} || ['unknown'],
         lambda s: s = status OR (s = 'unknown' AND NOT coalesce(list_contains({_STATUSES}, status), false))), 1) AS status,
       upper(trim(customer_name)) AS customer_name, trim(lower(email)) AS email, digits AS phone_normalized,
       CAST(coalesce(length(email), 0) = 0 AS INTEGER) AS missing_email_flag,
       CAST(coalesce(at_sign = 0, false) AS INTEGER) AS invalid_email_flag,
       CAST(coalesce(length(digits), 0) < 10 AS INTEGER) AS invalid_phone_flag
FROM facts WHERE NOT (customer_id IS NULL OR customer_name IS NULL)"""


def _normalised(spark, sf_dir):
    c = fx.messy_contacts(spark, sf_dir).drop("segment", "nation_key")
    return silver.normalise_contacts(c, key="customer_id")


@register("silver_normalised_contacts", W(fx.F2_SQL) + _FACTS_SQL + _NORMALISED_SQL)
def silver_normalised_contacts(spark, sf_dir):
    """P15 + P11 + P12 + P7: the silver contact model in one projection."""
    return _normalised(spark, sf_dir)


@register("conformed_orders", W(fx.F1_SQL) + """
SELECT ord, TRY_CAST(id AS BIGINT) AS order_id, prio AS priority, status,
       CASE WHEN id IS NOT NULL AND TRY_CAST(id AS BIGINT) IS NULL THEN 'id' ELSE '' END AS cast_errors
FROM f1""")
def conformed_orders(spark, sf_dir):
    """Typed columns and standard names; unconvertible values listed."""
    b = fx.messy_orders(spark, sf_dir).select("ord", "id", "prio", "status")
    out = silver.conform_types(b, {"id": "bigint"}, {"id": "order_id", "prio": "priority"})
    return out.withColumn("cast_errors", F.array_join("_cast_errors", ";")).drop("_cast_errors")


# ---------------------------------------------------------------- gold

@register("gold_count", W(F1_SILVER_SQL) + 'SELECT status, count(*) AS "count" FROM silver GROUP BY 1')
def gold_count(spark, sf_dir):
    """A2: group count on the silver layer."""
    return gold.group_count(f1_layers(spark, sf_dir).silver, "status", missing=None)


@register("gold_count_desc_topk", W(F1_SILVER_SQL) + """
SELECT prio, count(*) AS "count" FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def gold_count_desc_topk(spark, sf_dir):
    """A3 + L3: the three largest groups (ties by key)."""
    return gold.top_groups(f1_layers(spark, sf_dir).silver, "prio", 3)


_STAR_SQL = """star AS (
  SELECT l.l_orderkey, l.l_quantity,
         CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(15,2))) AS revenue,
         o.o_orderdate, n.n_name, r.r_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _star(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return gold.enrich_sales(t("lineitem"), t("orders"), t("customer"), t("nation"), t("region"))


@register("star_enriched_sales", W(_STAR_SQL) + """
SELECT r_name, n_name, count(*) AS lines, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue,
       CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM star GROUP BY 1, 2""")
def star_enriched_sales(spark, sf_dir):
    """Fact joined to its customer / nation / region dimensions, by nation."""
    return (_star(spark, sf_dir).groupBy("r_name", "n_name")
            .agg(F.count(F.lit(1)).alias("lines"), gold.money(gold.units_sum("revenue")).alias("revenue"),
                 F.sum("l_quantity").alias("quantity")))


@register("sales_rollup", W(_STAR_SQL) + """
SELECT r_name, n_name, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, count(*) AS lines,
       CAST(grouping(r_name, n_name) AS INTEGER) AS level
FROM star GROUP BY ROLLUP (r_name, n_name)""")
def sales_rollup(spark, sf_dir):
    """Region / nation hierarchy with subtotals and a grand total."""
    return gold.sales_rollup(_star(spark, sf_dir)).withColumn("level", F.col("level").cast("int"))


@register("monthly_sales", W(_STAR_SQL) + """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, r_name,
       CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, round(avg(l_quantity), 6) AS avg_qty, count(*) AS lines
FROM star GROUP BY 1, 2""")
def monthly_sales(spark, sf_dir):
    """Month x region revenue, average quantity and line count."""
    return gold.monthly_sales(_star(spark, sf_dir))


# ---------------------------------------------------------------- quality

@register("layer_retention", W(fx.F1_SQL) + """
SELECT count(*) AS bronze_rows,
       count(*) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')) AS ids_present,
       count(*) FILTER (WHERE NOT (id IS NOT NULL AND regexp_matches(id, '[^[:space:]]'))) AS ids_blank,
       count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')) AS silver_rows,
       count(*) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]'))
         - count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')) AS duplicates,
       round(CASE WHEN count(*) = 0 THEN 0.0 ELSE count(DISTINCT id) FILTER (
         WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')) / count(*) END, 6) AS retention
FROM f1""")
def layer_retention(spark, sf_dir):
    """A4 + A6 + A7: bronze rows, key presence, silver rows, retention: one pass."""
    return quality.retention_report(fx.messy_orders(spark, sf_dir), "id")


_F1_COLS = ("ord", "id", "prio", "status", "price")


@register("null_profile", W(fx.F1_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_rate FROM f1" for c in _F1_COLS))
def null_profile(spark, sf_dir):
    """A5 / Q3: null counts of every column from one scan."""
    return quality.null_profile(fx.messy_orders(spark, sf_dir))


@register("column_profile")
def column_profile(spark, sf_dir):
    """Q12: nulls, min, max and approximate distinct counts of every column
    (approximate, so checked for shape only)."""
    return quality.column_profile(fx.messy_orders(spark, sf_dir))


_PROFILED = ["ord", "id", "prio", "status"]


@register("column_profile_exact", W(fx.F1_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM f1" for c in _PROFILED))
def column_profile_exact(spark, sf_dir):
    """Q12: the exact columns of the profile (all but the approximate distinct count)."""
    p = quality.column_profile(fx.messy_orders(spark, sf_dir), _PROFILED)
    return p.select("column_name", "row_count", "null_count", "min_value", "max_value")


@register("null_rate_gate", W(fx.F1_SQL) + """
SELECT 'id' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE id IS NULL) AS null_count,
       round(count(*) FILTER (WHERE id IS NULL) / count(*), 6) AS null_rate, CAST(0.05 AS DOUBLE) AS threshold,
       round(count(*) FILTER (WHERE id IS NULL) / count(*), 6) <= 0.05 AS passed
FROM f1""")
def null_rate_gate(spark, sf_dir):
    """A8 + Q4: null share of the key against the 0.05 limit."""
    return quality.null_rate_gate(fx.messy_orders(spark, sf_dir), "id")


@register("score_gate", W(fx.F1_SQL) + """
SELECT round(count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]'))
             / count(*), 6) AS score, CAST(0.85 AS DOUBLE) AS threshold,
       round(count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]'))
             / count(*), 6) >= 0.85 AS passed
FROM f1""")
def score_gate(spark, sf_dir):
    """A7 + Q5: silver/bronze retention against the 0.85 minimum score."""
    return quality.score_gate(quality.retention_report(fx.messy_orders(spark, sf_dir), "id"))


def _check_sql(name, ctype, passed, failed, status):
    return (f"SELECT {passed} AS passed_count, {failed} AS failed_count, '{name}' AS check_name, "
            f"'{ctype}' AS check_type, {status} AS status")


_QUALITY_SQL = W(fx.F1_SQL, fx.F2_SQL) + """,
checks AS (
  SELECT 'bronze.orders' AS table_name, 'id_completeness' AS check_name, 'completeness' AS check_type,
         count(*) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')) AS p,
         count(*) FILTER (WHERE NOT coalesce(regexp_matches(id, '[^[:space:]]'), false)) AS f,
         NULL AS st FROM f1
  UNION ALL
  SELECT 'bronze.orders', 'deduplication', 'uniqueness',
         count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')),
         count(*) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]'))
           - count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')),
         'passed' FROM f1
  UNION ALL
  SELECT 'bronze.contacts', 'email_format', 'validity',
         count(*) FILTER (WHERE regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$')),
         count(*) FILTER (WHERE NOT coalesce(
           regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'), false)),
         NULL FROM f2
  UNION ALL
  SELECT 'bronze.contacts', 'status_accepted_values', 'accepted_values',
         count(*) FILTER (WHERE status IN ('active', 'inactive', 'suspended')),
         count(*) FILTER (WHERE NOT coalesce(status IN ('active', 'inactive', 'suspended'), false)),
         NULL FROM f2
  UNION ALL
  SELECT 'bronze.contacts', 'source_system_accepted_values', 'accepted_values',
         count(*) FILTER (WHERE source_system IN ('crm', 'erp', 'website')),
         count(*) FILTER (WHERE NOT coalesce(source_system IN ('crm', 'erp', 'website'), false)),
         NULL FROM f2)
SELECT table_name, check_name, check_type,
       coalesce(st, CASE WHEN f = 0 THEN 'passed'
                         WHEN check_type = 'completeness' THEN 'warning' ELSE 'failed' END) AS status,
       p AS passed_count, f AS failed_count,
       round(CASE WHEN p + f = 0 THEN 0.0 ELSE f / (p + f) END, 6) AS error_rate
FROM checks"""


@register("quality_results", _QUALITY_SQL)
def quality_results(spark, sf_dir):
    """Check-result rows as appended to the quality log."""
    b = fx.messy_orders(spark, sf_dir)
    c = fx.messy_contacts(spark, sf_dir)
    return quality.run_checks(b, "bronze.orders", [quality.completeness("id"), quality.uniqueness("id")]).unionByName(
        quality.run_checks(c, "bronze.contacts", [
            quality.pattern("email", name="email_format"),
            quality.accepted_values("status", silver.ACCEPTED_STATUS),
            quality.accepted_values("source_system", ("crm", "erp", "website"))]))


@register("quality_flag_rates", W(fx.F2_SQL) + _FACTS_SQL + """,
n AS (""" + _NORMALISED_SQL + """)
SELECT count(*) AS row_count, round(avg(missing_email_flag), 6) AS missing_email_flag_rate,
       round(avg(invalid_email_flag), 6) AS invalid_email_flag_rate,
       round(avg(invalid_phone_flag), 6) AS invalid_phone_flag_rate FROM n""")
def quality_flag_rates(spark, sf_dir):
    """Q14: share of silver rows raising each data-quality flag."""
    return quality.flag_rates(_normalised(spark, sf_dir),
                              ["missing_email_flag", "invalid_email_flag", "invalid_phone_flag"])


@register("quarantine_rows", W(fx.F2_SQL) + """,
r AS (
  SELECT customer_id, list_filter([
    CASE WHEN email NOT LIKE '%@%' THEN 'invalid_email' END,
    CASE WHEN phone IS NULL OR length(regexp_replace(phone, '[^0-9]', '', 'g')) < 10 THEN 'invalid_phone' END,
    CASE WHEN email IS NULL OR email = '' THEN 'missing_email' END,
    CASE WHEN NOT coalesce(status IN ('active', 'inactive', 'suspended'), false) THEN 'status_domain' END
  ], lambda x: x IS NOT NULL) AS rules FROM f2)
SELECT customer_id, array_to_string(rules, ';') AS failed_rules FROM r WHERE len(rules) > 0""")
def quarantine_rows(spark, sf_dir):
    """Q9: rows that break a rule, with the sorted names of the rules broken."""
    c = fx.messy_contacts(spark, sf_dir)
    e, p, s = F.col("email"), F.col("phone"), F.col("status")
    rules = {"missing_email": e.isNull() | (e == ""),
             "invalid_email": ~e.like("%@%"),
             "invalid_phone": p.isNull() | (F.length(F.regexp_replace(p, "[^0-9]", "")) < 10),
             "status_domain": ~F.coalesce(s.isin(list(silver.ACCEPTED_STATUS)), F.lit(False))}
    _, bad = quality.quarantine(c, rules)
    return bad.select("customer_id", F.array_join("failed_rules", ";").alias("failed_rules"))


@register("layer_reconcile", W(F1_SILVER_SQL) + """
SELECT (SELECT count(*) FROM f1) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM silver) AS gold_total,
       (SELECT count(DISTINCT coalesce(prio, 'unknown')) FROM silver) AS gold_groups,
       (SELECT count(*) FROM silver) AS member_rows, CAST(0 AS BIGINT) AS missing_in_gold,
       CAST(0 AS BIGINT) AS extra_in_gold,
       true AS conserved""")
def layer_reconcile(spark, sf_dir):
    """U3 + U4 + Q10: the layer invariants of one medallion run."""
    L = f1_layers(spark, sf_dir)
    return quality.reconcile(L.bronze, L.silver, L.gold, L.members, key="id")


@register("write_reconcile", W(F1_SILVER_SQL) + """,
n AS (SELECT (SELECT count(*) FROM f1) AS b,
             (SELECT count(*) FROM f1 WHERE id IS NULL OR NOT regexp_matches(id, '[^[:space:]]')) AS bad)
SELECT 'split' AS check_name, 'passed' AS status, b AS source_rows, b AS target_rows, 'equal' AS details FROM n
UNION ALL SELECT 'published', 'passed', b - bad, b - bad, 'equal' FROM n
UNION ALL SELECT 'lost', 'failed', b - bad, b - bad - 1, 'rows differ' FROM n
UNION ALL SELECT 'doubled', 'failed', b - bad, b - bad + 1, 'rows differ' FROM n
UNION ALL SELECT 'changed', 'failed', b - bad, b - bad, 'contents differ' FROM n""")
def write_reconcile(spark, sf_dir):
    """U3 + U4 + Q10: layers reconciled by the fingerprints of their writes: a split into
    clean and quarantined rows, a copy, and copies with one row lost, doubled or changed."""
    base = scratch_path(spark, "reconcile")
    bronze = fx.messy_orders(spark, sf_dir)
    blank = ~not_blank("id")

    def put(df, name):
        return write_fingerprinted(df, f"{base}/{name}")

    whole, clean, bad = put(bronze, "bronze"), put(bronze.filter(~blank), "clean"), put(bronze.filter(blank), "bad")
    kept = spark.read.schema(bronze.schema).parquet(f"{base}/clean")
    first = kept.agg(F.min("ord")).first()[0]
    one = F.col("ord") == F.lit(first)
    published = put(kept.repartition(3), "published")
    lost, doubled = put(kept.filter(~one), "lost"), put(kept.unionByName(kept.filter(one)), "doubled")
    changed = put(kept.withColumn("price", F.when(one, F.col("price") + 1).otherwise(F.col("price"))), "changed")
    return quality.reconcile_writes(spark, [
        ("split", whole, clean + bad), ("published", clean, published), ("lost", clean, lost),
        ("doubled", clean, doubled), ("changed", clean, changed)]).drop("check_type")


# ---------------------------------------------------------------- incremental, history

_EVENTS_WM = "2024-01-20 00:00:00"


@register("incremental_append", f"""
SELECT * FROM events WHERE ts > TIMESTAMP '{_EVENTS_WM}'""")
def incremental_append(spark, sf_dir):
    """I1 + P10 + U1: the batch appended after the stored watermark."""
    ev = table(spark, sf_dir, "events")
    state = spark.createDataFrame([("events", _EVENTS_WM)], "table_name string, watermark string") \
        .withColumn("watermark", F.col("watermark").cast("timestamp_ntz"))
    return incremental.new_rows(ev, "ts", incremental.watermark_of(state, "events"))


@register("incremental_state", f"""
SELECT 'events' AS table_name, strftime(coalesce(max(ts), TIMESTAMP '{_EVENTS_WM}'), {TS}) AS watermark
FROM events WHERE ts > TIMESTAMP '{_EVENTS_WM}'""")
def incremental_state(spark, sf_dir):
    """The state row after the append: the newest timestamp processed."""
    ev = table(spark, sf_dir, "events")
    batch = incremental.new_rows(ev, "ts", _EVENTS_WM)
    st = incremental.next_state(batch, "events", "ts", _EVENTS_WM)
    return st.select("table_name", ts_text("watermark").alias("watermark"))


@register("incremental_load", """
SELECT *, CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN 1 ELSE 2 END AS load FROM events""")
def incremental_load(spark, sf_dir):
    """I1 + U1 end to end: a first load, a second one from the stored watermark, a
    third that finds nothing new; then everything that was appended."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "increment")
    first = ev.filter(F.col("ts") <= F.lit("2024-01-10").cast("timestamp_ntz"))
    incremental.load_increment(first.withColumn("load", F.lit(1)), "events", "ts", root)
    for n in (2, 3):
        incremental.load_increment(ev.withColumn("load", F.lit(n)), "events", "ts", root)
    return incremental.loaded(spark, "events", root, ev.withColumn("load", F.lit(1)).schema)


@register("incremental_lookback", """
WITH tgt AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND event_id % 5 <> 0),
wm AS (SELECT max(ts) AS w FROM tgt)
SELECT * FROM events WHERE ts > (SELECT w FROM wm) - INTERVAL 2 DAY
UNION ALL
SELECT * FROM tgt WHERE ts <= (SELECT w FROM wm) - INTERVAL 2 DAY""")
def incremental_lookback(spark, sf_dir):
    """Rows that arrived late (every fifth) are picked up as far as two days
    behind the target's newest row."""
    ev = table(spark, sf_dir, "events")
    target = ev.filter((F.col("ts") <= F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("event_id") % 5 != 0))
    return incremental.incremental_model(ev, target, "event_id", "ts", lookback="2 days")


@register("rows_to_update", """
SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def rows_to_update(spark, sf_dir):
    """Customers touched by a finished order (semi join; a key may change often)."""
    changed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return incremental.rows_to_update(table(spark, sf_dir, "customer"), changed, "c_custkey")


_MERGE_SQL = W(fx.F1_SQL) + """,
base AS (SELECT * FROM f1 WHERE ord < 1000000000 AND id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')),
tgt AS (SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1),
src AS (SELECT ord, id, prio, status, 'replay' AS channel FROM f1
        WHERE ord >= 1000000000 AND id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')
          AND ord > (SELECT coalesce(max(ord), 0) FROM tgt)),
upd AS (SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1)
SELECT ord, id, prio, status, channel FROM upd
UNION ALL
SELECT ord, id, prio, status, NULL FROM tgt WHERE id NOT IN (SELECT id FROM upd)"""


@register("incremental_merge", _MERGE_SQL)
def incremental_merge(spark, sf_dir):
    """I2 + J4 + D3 + D4 + D5: incremental model merged on its unique key.

    Target = first load (original rows); source = replayed rows.  Only source
    rows newer than the target's newest ordinal are taken (scalar subquery),
    reduced to the latest per key and merged; the source's schema wins
    (``channel`` added, ``price`` dropped).
    """
    b = silver.require_keys(fx.messy_orders(spark, sf_dir), "id")
    first = b.filter(F.col("ord") < 1_000_000_000)
    target = silver.keep_latest(first, "id", ["ord"], tiebreak=[])
    src = (b.filter(F.col("ord") >= 1_000_000_000).drop("price")
           .withColumn("channel", F.lit("replay")))
    return incremental.incremental_model(src, target, "id", "ord").select(
        "ord", "id", "prio", "status", "channel")


_CDC_SQL = W(fx.F1_SQL) + """,
ch AS (SELECT ord AS seq, id, prio, price,
              CASE WHEN ord < 1000000000 THEN 'I' WHEN ord % 2 = 0 THEN 'D' ELSE 'U' END AS op
       FROM f1 WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')),
latest AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
SELECT seq, id, prio, price FROM latest WHERE op <> 'D'"""


@register("cdc_apply", _CDC_SQL)
def cdc_apply(spark, sf_dir):
    """Insert / update / delete feed applied per key (latest change wins)."""
    b = silver.require_keys(fx.messy_orders(spark, sf_dir), "id")
    ch = b.select(F.col("ord").alias("seq"), "id", "prio", "price",
                  F.when(F.col("ord") < 1_000_000_000, "I").when(F.col("ord") % 2 == 0, "D")
                  .otherwise("U").alias("op"))
    return incremental.cdc_apply(None, ch, "id", op_col="op", order_col="seq")


# A target with an order and tombstones, and two batches: changes of which a third is
# older than the target's row, then for every second delete an update from before it.
_CDC_STATE_SQL = W(fx.F1_SQL) + """,
ok AS (SELECT * FROM f1 WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]')),
target AS (SELECT ord * 10 AS seq, id, prio, price, CASE WHEN ord % 17 = 0 THEN 'D' ELSE 'I' END AS op
           FROM ok WHERE ord < 1000000000),
ch AS (SELECT ord - 1000000000 AS n, id, status, price FROM ok WHERE ord >= 1000000000),
first AS (SELECT n * 10 + CASE n % 3 WHEN 0 THEN -5 ELSE 5 END AS seq, id, status AS prio, price + 1 AS price,
                 CASE WHEN n % 2 = 0 THEN 'D' ELSE 'U' END AS op FROM ch),
late AS (SELECT n * 10 + 1 AS seq, id, 'late' AS prio, price + 2 AS price, 'U' AS op FROM ch WHERE n % 4 = 0),
moves AS (SELECT * FROM target UNION ALL SELECT * FROM first UNION ALL SELECT * FROM late),
state AS (SELECT * FROM moves QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
"""


def _cdc_state(spark, sf_dir):
    b = silver.require_keys(fx.messy_orders(spark, sf_dir), "id")
    o = F.col("ord")
    target = b.filter(o < 1_000_000_000).select(
        (o * 10).alias("seq"), "id", "prio", "price", F.when(o % 17 == 0, "D").otherwise("I").alias("op"))
    ch = b.filter(o >= 1_000_000_000).withColumn("n", o - 1_000_000_000)
    n = F.col("n")
    first = ch.select((n * 10 + F.when(n % 3 == 0, -5).otherwise(5)).alias("seq"), "id", F.col("status").alias("prio"),
                      (F.col("price") + 1).alias("price"), F.when(n % 2 == 0, "D").otherwise("U").alias("op"))
    late = ch.filter(n % 4 == 0).select((n * 10 + 1).alias("seq"), "id", F.lit("late").alias("prio"),
                                        (F.col("price") + 2).alias("price"), F.lit("U").alias("op"))
    return incremental.cdc_merge(incremental.cdc_merge(target, first, "id"), late, "id")


@register("cdc_ordered", _CDC_STATE_SQL + "SELECT seq, id, prio, price FROM state WHERE op <> 'D'")
def cdc_ordered(spark, sf_dir):
    """Changes applied to a target with newer rows, then updates from before a delete."""
    return incremental.cdc_rows(_cdc_state(spark, sf_dir)).select("seq", "id", "prio", "price")


@register("cdc_state", _CDC_STATE_SQL + "SELECT op, count(*) AS keys, CAST(sum(seq) AS BIGINT) AS seqs FROM state GROUP BY op")
def cdc_state(spark, sf_dir):
    """The change state behind it, tombstones included, per operation."""
    return _cdc_state(spark, sf_dir).groupBy("op").agg(F.count(F.lit(1)).alias("keys"), F.sum("seq").alias("seqs"))


@register("snapshot_history", f"""
SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, {TS}) AS valid_from,
       strftime(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), {TS})
         AS valid_to,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
FROM orders""")
def snapshot_history(spark, sf_dir):
    """D6 + W4: SCD-2 history of each customer's order state."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    h = incremental.snapshot_history(o, "o_custkey", "o_orderdate", ["o_orderkey"])
    return h.select("o_custkey", "o_orderkey", "o_orderstatus",
                    ts_text("valid_from").alias("valid_from"), ts_text("valid_to").alias("valid_to"),
                    "is_current")


_RETENTION_DAYS = {"bronze": 7, "silver": 14, "gold": 21}
def _ev_layer():
    return F.element_at(F.array(*[F.lit(x) for x in fx.LAYERS]), (F.col("event_id") % 3 + 1).cast("int"))
_EV_LAYER_SQL = "CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END"
_EV_DAYS_SQL = "CASE event_id % 3 WHEN 0 THEN 7 WHEN 1 THEN 14 ELSE 21 END"


def _layered_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("layer", _ev_layer())


@register("retention_report", f"""
SELECT {_EV_LAYER_SQL} AS layer,
       count(*) FILTER (WHERE ts >= TIMESTAMP '{AS_OF}' - to_days({_EV_DAYS_SQL})) AS kept_rows,
       count(*) FILTER (WHERE ts < TIMESTAMP '{AS_OF}' - to_days({_EV_DAYS_SQL})) AS expired_rows,
       min({_EV_DAYS_SQL}) AS retention_days
FROM events GROUP BY 1""")
def retention_report(spark, sf_dir):
    """I4: rows kept / expired per layer at the pinned ``as_of`` (7/14/21 days)."""
    return incremental.retention_report(_layered_events(spark, sf_dir), "layer", "ts",
                                        _RETENTION_DAYS, as_of=AS_OF)


@register("retention_keep", f"""
SELECT *, {_EV_LAYER_SQL} AS layer FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' - to_days({_EV_DAYS_SQL})""")
def retention_keep(spark, sf_dir):
    """The rows that survive expiry (the rest is archived)."""
    ev = _layered_events(spark, sf_dir)
    days = F.element_at(F.create_map(*[x for k, v in _RETENTION_DAYS.items() for x in (F.lit(k), F.lit(v))]),
                        F.col("layer"))
    kept, _ = incremental.retention_split(ev, "ts", days, as_of=AS_OF)
    return kept


_CUTOFF = "2024-01-17 09:30:00"


@register("retention_partitions", f"""
SELECT event_id, user_id, event_type, strftime(ts, {TS}) AS ts FROM events WHERE ts >= TIMESTAMP '{_CUTOFF}'""")
def retention_partitions(spark, sf_dir):
    """I4: expiry of a date-partitioned log: whole days by their folders, the day of the
    cutoff rewritten, all later days untouched."""
    path = scratch_path(spark, "expiring")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    write(ev.withColumn("date", F.to_date("ts")), path, partition_by=["date"], count=False)
    expire_partitions(spark, path, "date", "ts", _CUTOFF)
    return spark.read.schema(ev.schema).parquet(path).select("event_id", "user_id", "event_type", ts_text("ts").alias("ts"))


@register("retention_archive", f"""
SELECT *, {_EV_LAYER_SQL} AS layer, CAST(CAST(ts AS DATE) AS VARCHAR) AS archive_date FROM events
WHERE ts < TIMESTAMP '{AS_OF}' - to_days({_EV_DAYS_SQL})""")
def retention_archive(spark, sf_dir):
    """The expired rows written to a dated archive (twice: a repeat replaces) and read back."""
    ev = _layered_events(spark, sf_dir)
    days = F.element_at(F.create_map(*[x for k, v in _RETENTION_DAYS.items() for x in (F.lit(k), F.lit(v))]),
                        F.col("layer"))
    path = scratch_path(spark, "archive")
    for _ in range(2):
        incremental.archive_expired(ev, "ts", days, path, as_of=AS_OF)
    stored = ev.withColumn("archive_date", F.lit("").cast("string"))
    return spark.read.schema(stored.schema).parquet(path).select(*stored.columns)


@register("erase_layers", """
WITH gone AS (SELECT user_id FROM events WHERE event_type = 'signup' AND value >= 90)
SELECT 'bronze' AS layer, event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM gone)
UNION ALL
SELECT 'silver', event_id, user_id FROM events
WHERE event_type <> 'view' AND user_id NOT IN (SELECT user_id FROM gone)""")
def erase_layers(spark, sf_dir):
    """The subjects leave every layer; each erasure is audited."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "erase")
    write_version(ev, f"{root}/bronze")
    write_version(ev.filter("event_type <> 'view'"), f"{root}/silver")
    subjects = ev.filter((F.col("event_type") == "signup") & (F.col("value") >= 90)).select("user_id")
    layers = {k: (f"{root}/{k}", "user_id") for k in ("bronze", "silver")}
    incremental.erase_in_layers(spark, layers, subjects, "user_id", f"{root}/governance")
    parts = [read_current(spark, p).select(F.lit(k).alias("layer"), "event_id", "user_id") for k, (p, _) in layers.items()]
    return parts[0].unionByName(parts[1])


@register("erase_subject", """
SELECT * FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value >= 90)""")
def erase_subject(spark, sf_dir):
    """Remove every row of the subjects who asked to be erased (anti join)."""
    ev = table(spark, sf_dir, "events")
    subjects = ev.filter((F.col("event_type") == "signup") & (F.col("value") >= 90)).select("user_id")
    return incremental.erase_subjects(ev, subjects, "user_id")


# ---------------------------------------------------------------- privacy

_SALT = "strata-salt"


@register("masked_customers", f"""
SELECT sha256('{_SALT}' || CAST(c_custkey AS VARCHAR)) AS customer_token,
       regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'),
                      '[0-9]', 'n', 'g') AS masked_name,
       c_nationkey, c_mktsegment FROM customer""")
def masked_customers(spark, sf_dir):
    """Masking (``mask``) and salted tokenising (``sha2``) of personal columns."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.sha2(F.concat(F.lit(_SALT), F.col("c_custkey").cast("string")), 256)
                    .alias("customer_token"),
                    F.mask("c_name").alias("masked_name"), "c_nationkey", "c_mktsegment")


# Patterns for personal data detection (find anywhere in the text).
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}",
}


@register("pii_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS pii_type, count(*) AS row_count, "
    f"count(*) FILTER (WHERE regexp_matches({c}, '{v}')) AS matching_rows, "
    f"round(count(*) FILTER (WHERE regexp_matches({c}, '{v}')) / count(*), 6) AS match_rate FROM documents"
    for c in ("text", "source") for k, v in PII_PATTERNS.items()))
def pii_columns(spark, sf_dir):
    """Q13: share of rows of each text column that contain personal data."""
    d = table(spark, sf_dir, "documents").select("text", "source")
    return quality.pii_scan(d, ["text", "source"], PII_PATTERNS, required={"email": "@"})


@register("silver_keep_first_counts", W(fx.F1_SQL) + """,
ok AS (SELECT * FROM f1 WHERE id IS NOT NULL AND regexp_matches(id, '[^[:space:]]'))
SELECT id, min(ord) AS ord, count(*) AS _copies FROM ok GROUP BY id""")
def silver_keep_first_counts(spark, sf_dir):
    """D1 with the duplicate count: the kept row's ordinal and how many rows
    shared its key (one aggregate: the row pick and the count together)."""
    b = silver.require_keys(fx.messy_orders(spark, sf_dir), "id")
    return silver.keep_first_with_count(b, "id", "ord").select("id", "ord", "_copies")
