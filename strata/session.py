"""Session helpers: building a local session for tests and cutting lineage.

The library never creates or stops the caller's session; these helpers are for
tests, the bench and the command line only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every plan in this package.  AQE re-plans joins and
# coalesces shuffle partitions at runtime, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (dedup keys, open windows / sessions) lives in RocksDB:
    # off the JVM heap and spilled to local disk, checkpointed with the query.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used by library code)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a scratch one only on a local master.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local fallback would lose data when an
    executor goes away, so there we refuse instead of guessing.
    """
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this job")
    d = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to reliable storage and return a plan that reads it.

    Reliable checkpoints survive executor loss (unlike local checkpoints).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
