"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def build_session(master: str | None = None, app: str = "framelake", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, STATE_STORE[0]: STATE_STORE[1], **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors keep their state in RocksDB; a session made elsewhere may not say so."""
    spark.conf.set(*STATE_STORE)


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session may lack the setting; it then gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="framelake-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the scratch folder: lineage ends here."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
