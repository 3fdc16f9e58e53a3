"""Provenance stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import as_of_ts

INGESTED = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
PROCESSED = "_processed_timestamp"
AGGREGATED = "_aggregation_timestamp"
SOURCE_SYSTEM = "source_system"


def stamp_ingestion(df: DataFrame, source: str | None = None, *, as_of=None) -> DataFrame:
    """Ingestion time and source file.

    ``source=None`` takes the real file of each row from the scan metadata
    (only for file sources); otherwise the given text is stamped.
    """
    src = F.col("_metadata.file_path") if source is None else F.lit(str(source))
    return df.withColumns({INGESTED: as_of_ts(as_of), SOURCE_FILE: src})


def stamp_source_system(df: DataFrame, name: str, col: str = SOURCE_SYSTEM) -> DataFrame:
    """The system a batch came from."""
    return df.withColumn(col, F.lit(name))


def stamp_time(df: DataFrame, col: str = PROCESSED, *, as_of=None) -> DataFrame:
    """Processed / aggregated / computed time (one value per query)."""
    return df.withColumn(col, as_of_ts(as_of))
