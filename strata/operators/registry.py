"""Table registry (G1-G5, G19, G20, G23, G24, K7) as append-only Spark tables.

The registry is two append-only tables:

* ``tables``: one row per registered version ``(full_name, catalog_name,
  schema_name, table_name, format, version, row_count, size_bytes,
  updated_at, ...)``; an "update" appends a newer version;
* ``columns``: ``(full_name, version, column_name, data_type, nullable,
  position)``.

Reads are queries over them: the current view is the newest version per
name (``max_by``, partial aggregation), never an in-place update.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG = "lakehouse"
# Layer -> table kind, as the reference names them.
TABLE_KIND = {"bronze": "raw", "silver": "cleaned", "gold": "aggregate"}

TABLES_SCHEMA = T.StructType([
    T.StructField("full_name", T.StringType()), T.StructField("catalog_name", T.StringType()),
    T.StructField("schema_name", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("table_type", T.StringType()), T.StructField("location", T.StringType()),
    T.StructField("format", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("owner", T.StringType()), T.StructField("version", T.IntegerType()),
    T.StructField("row_count", T.LongType()), T.StructField("size_bytes", T.LongType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("updated_at", T.TimestampNTZType()),
])
COLUMNS_SCHEMA = T.StructType([
    T.StructField("full_name", T.StringType()), T.StructField("version", T.IntegerType()),
    T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
    T.StructField("nullable", T.BooleanType()), T.StructField("position", T.IntegerType()),
    T.StructField("description", T.StringType()),
])


def full_name(layer: str, table: str, catalog: str = CATALOG) -> str:
    return f"{catalog}.{layer}.{table}"


# ---------------------------------------------------------------- write side

def _read(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    from strata.sinks.writers import _fs
    fs, p, _ = _fs(spark, f"{root}/{name}")
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def registry_tables(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "tables", TABLES_SCHEMA)


def registry_columns(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "columns", COLUMNS_SCHEMA)


def _append_tables(rows: DataFrame, root: str) -> None:
    # Partitioned by layer: per-layer listings and summaries prune folders.
    rows.write.mode("append").partitionBy("schema_name").parquet(f"{root}/tables")


def schema_rows(schema: T.StructType) -> list[dict]:
    """G2 input from ``df.schema``: position = field index."""
    return [{"column_name": f.name, "data_type": f.dataType.simpleString(),
             "nullable": f.nullable, "position": i} for i, f in enumerate(schema.fields)]


def register_table(spark: SparkSession, root: str, layer: str, table_name: str, *,
                   location: str | None = None, schema: T.StructType | None = None,
                   columns: Sequence[dict] | None = None, fmt: str = "parquet",
                   row_count: int | None = None, size_bytes: int | None = None,
                   description: str | None = None, owner: str | None = None,
                   properties: dict | None = None, if_exists: str = "error",
                   as_of: _dt.datetime | None = None) -> int:
    """G1 + G2: append a table version and its columns; returns the version.

    ``if_exists='error'`` refuses a second registration (the reference's
    unique constraint) *before* anything is written; ``'replace'`` appends a
    new version instead.
    """
    fq = full_name(layer, table_name)
    cur = (registry_tables(spark, root)
           .filter((F.col("schema_name") == layer) & (F.col("full_name") == fq))  # prunes to the layer
           .agg(F.max("version")).first()[0])
    if cur is not None and if_exists == "error":
        raise ValueError(f"table {fq} is already registered")
    version = (cur or 0) + 1
    ts = as_of or _dt.datetime.now()
    props ={k: (v if isinstance(v, str) else json.dumps(v)) for k, v in (properties or {}).items()}
    row = (fq, CATALOG, layer, table_name, TABLE_KIND.get(layer, "table"), location, fmt,
           description, owner, version, row_count, size_bytes, props, ts)
    _append_tables(spark.createDataFrame([row], TABLES_SCHEMA), root)
    cols = list(columns or (schema_rows(schema) if schema is not None else []))
    if cols:
        rows = [(fq, version, c["column_name"], c.get("data_type", "string"), c.get("nullable", True),
                 c.get("position", i), c.get("description")) for i, c in enumerate(cols)]
        spark.createDataFrame(rows, COLUMNS_SCHEMA).write.mode("append").parquet(f"{root}/columns")
    return version


def update_table_stats(spark: SparkSession, root: str, layer: str, table_name: str, *,
                       row_count: int | None = None, size_bytes: int | None = None,
                       as_of: _dt.datetime | None = None) -> int:
    """A new version carrying the new statistics (columns unchanged)."""
    fq = full_name(layer, table_name)
    cur = current_tables(registry_tables(spark, root)).filter(F.col("full_name") == fq).first()
    if cur is None:
        raise KeyError(fq)
    d = cur.asDict()
    ts = as_of or _dt.datetime.now()
    d.update(version=d["version"] + 1, updated_at=ts,
             row_count=row_count if row_count is not None else d["row_count"],
             size_bytes=size_bytes if size_bytes is not None else d["size_bytes"])
    _append_tables(spark.createDataFrame([tuple(d[f.name] for f in TABLES_SCHEMA.fields)], TABLES_SCHEMA),
                   root)
    cols = registry_columns(spark, root).filter(
        (F.col("full_name") == fq) & (F.col("version") == cur["version"]))
    cols.withColumn("version", F.lit(d["version"])).write.mode("append").parquet(f"{root}/columns")
    return d["version"]


# ---------------------------------------------------------------- read side

def current_tables(versions: DataFrame, key: str = "full_name") -> DataFrame:
    """G5 current view: newest version per table (partial aggregation), with the time of
    its first version as ``created_at``."""
    rest = [c for c in versions.columns if c not in (key, "created_at")]
    first = F.min("created_at" if "created_at" in versions.columns else "updated_at")
    picked = versions.groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct("version", "updated_at")).alias("_r"), first.alias("created_at"))
    return picked.select(key, *[F.col("_r")[c].alias(c) for c in rest], "created_at")


def current_columns(current: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns of the current version of every table (semi join on name+version)."""
    return columns.join(current.select("full_name", "version"), ["full_name", "version"], "left_semi")


def list_tables(current: DataFrame, layer: str | None = None) -> DataFrame:
    """Tables of a layer (or all), ordered by name."""
    df = current.filter(F.col("schema_name") == layer) if layer else current
    return df.orderBy("schema_name", "table_name")


def list_schemas(current: DataFrame) -> DataFrame:
    """Schemas (layers) with their table counts, ordered by name."""
    return (current.groupBy("catalog_name", "schema_name").agg(F.count(F.lit(1)).alias("table_count"))
            .orderBy("catalog_name", "schema_name"))


def list_catalogs(current: DataFrame) -> DataFrame:
    """Catalogs with their schema and table counts."""
    return (current.groupBy("catalog_name")
            .agg(F.count_distinct("schema_name").alias("schema_count"),
                 F.count(F.lit(1)).alias("table_count"))
            .orderBy("catalog_name"))


def _column_fields(columns: DataFrame) -> list[str]:
    fields = ["position", "column_name", "data_type", "nullable", "description"]
    return [c for c in fields if c in columns.columns]


def table_info(current: DataFrame, columns: DataFrame) -> DataFrame:
    """G3 + J1 + J2: each table with its ordered column list.

    A table's column list is bounded by its schema width, so collecting it
    per table is safe; the table count is not bounded and stays in rows.
    """
    cols = (current_columns(current, columns).groupBy("full_name")
            .agg(F.sort_array(F.collect_list(F.struct(*_column_fields(columns)))).alias("columns")))
    return current.join(cols, "full_name", "left")


def columns_text(c="columns"):
    """Ordered column list as ``name:type`` text (engine-neutral)."""
    return F.array_join(F.transform(F.col(c), lambda x: F.concat(x["column_name"], F.lit(":"),
                                                                 x["data_type"])), ",")


def governance_summary(current: DataFrame, layers: Sequence[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """Tables and records per layer plus a total row (ROLLUP).

    Layers without tables still appear with zeros; null row counts count as 0.
    Table names are listed by :func:`list_tables`, not packed into one row.
    """
    spark = current.sparkSession
    # Aggregate first (partial aggregation: a layer holding most tables costs
    # one row per map task), then attach the fixed list of layers so empty
    # layers appear with zeros, then add the total over that small result.
    per = (current.filter(F.col("schema_name").isin(list(layers))).groupBy("schema_name")
           .agg(F.count(F.lit(1)).alias("table_count"),
                F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("total_records")))
    base = spark.createDataFrame([(x,) for x in layers], "schema_name string")
    full = base.join(per, "schema_name", "left").fillna(0, ["table_count", "total_records"])
    return (full.rollup("schema_name")
            .agg(F.sum("table_count").cast("long").alias("table_count"),
                 F.sum("total_records").cast("long").alias("total_records"))
            .select(F.coalesce("schema_name", F.lit("_total")).alias("layer"), "table_count",
                    "total_records"))


def layer_tables(current: DataFrame, layers: Sequence[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """The table names of each layer of the summary, one row per table
    (a layer's list is not bounded, so it is not packed into one row)."""
    return current.filter(F.col("schema_name").isin(list(layers))).select(
        F.col("schema_name").alias("layer"), "table_name")


def export_rows(current: DataFrame, columns: DataFrame) -> DataFrame:
    """One nested row per table (layer, metadata, ordered columns)."""
    info = table_info(current, columns)
    meta = [c for c in ("schema_name", "table_name", "full_name", "catalog_name", "table_type", "location",
                        "format", "description", "owner", "version", "row_count", "size_bytes",
                        "properties") if c in info.columns]
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("updated_at", "created_at")
             if c in info.columns]
    return info.select(*meta, *times, "columns")


def export_catalog(current: DataFrame, columns: DataFrame, path: str, *, gov_root: str | None = None,
                   user: str = "system", as_of: _dt.datetime | None = None) -> int | None:
    """Write the registry export as JSON Lines partitioned by layer; with
    ``gov_root`` the export is an ``export_catalog`` row of the audit log."""
    from strata.operators.audit import log_action
    from strata.sinks.writers import write
    n = write(export_rows(current, columns), path, fmt="json", partition_by=["schema_name"])
    if gov_root:
        log_action(current.sparkSession, gov_root, user, "export_catalog", "catalog", CATALOG,
                   details={"path": path, "tables": n}, as_of=as_of)
    return n


def restore_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(tables, columns) back from an export."""
    schema = T.StructType([
        T.StructField("table_name", T.StringType()), T.StructField("full_name", T.StringType()),
        T.StructField("catalog_name", T.StringType()),
        T.StructField("table_type", T.StringType()), T.StructField("location", T.StringType()),
        T.StructField("format", T.StringType()), T.StructField("description", T.StringType()),
        T.StructField("owner", T.StringType()), T.StructField("version", T.IntegerType()),
        T.StructField("row_count", T.LongType()), T.StructField("size_bytes", T.LongType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("updated_at", T.StringType()), T.StructField("created_at", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StructType([
            T.StructField("position", T.IntegerType()), T.StructField("column_name", T.StringType()),
            T.StructField("data_type", T.StringType()), T.StructField("nullable", T.BooleanType()),
            T.StructField("description", T.StringType())]))),
        T.StructField("schema_name", T.StringType()),
    ])
    raw = spark.read.schema(schema).json(path)
    tables = raw.drop("columns").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("updated_at", "created_at")})
    cols = raw.select("full_name", "version", F.inline("columns"))
    return tables, cols


def schema_diff(columns: DataFrame, old_version: int | str = "previous",
                new_version: int | str = "current") -> DataFrame:
    """Per table, columns added, removed or retyped between its two
    newest versions (or the given version numbers)."""
    if old_version == "previous" and new_version == "current":
        # the greatest two version numbers that have columns: there may be gaps
        newest = F.reverse(F.array_sort(F.collect_set("version")))   # as many as a table has versions
        vs = columns.groupBy("full_name").agg(newest.alias("_v")).filter(F.size("_v") > 1).select(
            "full_name", F.get("_v", F.lit(0)).alias("_new"), F.get("_v", F.lit(1)).alias("_old"))
        x = columns.join(vs, "full_name")
    else:
        x = columns.withColumns({"_new": F.lit(new_version), "_old": F.lit(old_version)})
    old, new = F.col("version") == F.col("_old"), F.col("version") == F.col("_new")
    x = x.filter(old | new).groupBy("full_name", "column_name").agg(
        F.max(F.when(old, F.col("data_type"))).alias("old_type"), F.max(F.when(new, F.col("data_type"))).alias("new_type"))
    if old_version != "previous" or new_version != "current":  # only tables that have both versions are compared
        both = x.groupBy("full_name").agg(F.max("old_type").alias("_o"), F.max("new_type").alias("_n")).filter(
            "_o IS NOT NULL AND _n IS NOT NULL")
        x = x.join(both.select("full_name"), "full_name", "left_semi")
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
              .when(F.col("old_type") != F.col("new_type"), "retyped"))
    return x.withColumn("change", change).filter(F.col("change").isNotNull())
