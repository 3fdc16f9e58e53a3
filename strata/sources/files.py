"""Readers for the raw and layered datasets.

All readers return lazy DataFrames; nothing is pulled to the driver except
the CSV header line needed to build the all-string schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ORD = "_ord"


def _csv_header(spark: SparkSession, path: str, sep: str) -> list[str]:
    # One line from the first file; the same names Spark itself would derive.
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def read_csv_strings(spark: SparkSession, path: str, *, sep: str = ",",
                     multiline: bool = False, with_ordinal: bool = True,
                     keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header, every column a string (schema on read).

    * doubled quotes are unescaped (``escape='"'``);
    * an empty field is ``''`` and a field missing from a short row is null;
      a long row keeps its declared fields (surplus ones only in the raw line);
    * ``_ord`` is a file-order ordinal ``struct(file, block, row)`` used by
      keep-first deduplication.  Each file block is read in order by one task.
    """
    names = _csv_header(spark, path, sep)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                          + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(schema)
          .option("header", True).option("sep", sep)
          .option("escape", '"').option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT)
          .option("multiLine", multiline)
          .csv(path))
    last = names[-1]
    # Not flagged, or flagged with its last declared field present (a long row):
    # every declared field exists, so a null can only have been an empty field.
    complete = F.col(CORRUPT).isNull() | F.col(last).isNotNull()
    cols = [F.when(complete, F.coalesce(F.col(n), F.lit(""))).otherwise(F.col(n)).alias(n)
            for n in names]
    if with_ordinal:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("row")).alias(ORD))
    if keep_corrupt:
        cols.append(F.col(CORRUPT))
    return df.select(*cols)


def read_csv_typed(spark: SparkSession, path: str, *, schema: T.StructType | str | None = None,
                   sep: str = ",") -> DataFrame:
    """CSV with header and types (explicit schema preferred at scale;
    inference costs a full extra pass over the input)."""
    r = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, *, schema: T.StructType | str | None = None,
              multiline: bool = False) -> DataFrame:
    """S3: JSON Lines (default) or one JSON array per file (``multiline``)."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A table by catalog name, or a dataset folder in format ``fmt``."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """Files under ``path`` with their sizes, without reading contents.

    Columns: path, length (bytes), modificationTime, layer, table.  ``layer`` is
    the first folder below ``path``; ``table`` is the file stem, or the folder
    name for a dataset folder of part files.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    base = path.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _re_escape(base) + "/", "")
    parts = F.split(rel, "/")
    stem = F.regexp_extract(F.element_at(parts, -1), r"([^/]+?)(\.[^./]*)?$", 1)
    table = F.when(F.size(parts) >= 3, F.element_at(parts, 2)).otherwise(stem)
    return df.select("path", "length", "modificationTime",
                     F.when(F.size(parts) >= 2, F.element_at(parts, 1)).alias("layer"),
                     table.alias("table"))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
