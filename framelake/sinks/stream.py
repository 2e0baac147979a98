"""Replay-safe tables behind a stream of value rows.

A micro-batch writes its files of all tables first and its commit record last: one small file, put in place by a rename, that names them. Readers
see committed batches only, so a batch shows in all tables or in none, and any earlier state by the number of its last batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelake.operators import statistic
from framelake.operators.selection import valuable_only
from framelake.sinks import frames as frame_sink


TABLES = ("frames", "statistic", "manifest")
COMMIT = "batch_id long, files array<string>"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def commit(spark: SparkSession, root: str, batch_id: int) -> None:
    """Make a written batch visible."""
    files = []
    for table in TABLES:
        place, fs = _place(spark, f"{root}/{table}/batch_id={batch_id}")
        if fs.exists(place):
            found = fs.listFiles(place, True)  # of one batch
            while found.hasNext():
                files.append(found.next().getPath().toString())
    record, fs = _place(spark, f"{root}/commits/{batch_id}.json")
    waiting, _ = _place(spark, f"{root}/commits/_{batch_id}.json")
    out = fs.create(waiting, True)
    out.write(bytearray(json.dumps({"batch_id": batch_id, "files": sorted(f for f in files if f.endswith(".parquet"))}).encode()))
    out.close()
    fs.rename(waiting, record)


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    place, fs = _place(spark, f"{root}/commits/{batch_id}.json")
    return fs.exists(place)


def commits(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The committed batches and their files, up to a number if one is given."""
    seen = spark.read.schema(COMMIT).json(f"{root}/commits")
    return seen if upto is None else seen.filter(F.col("batch_id") <= upto)


def _committed(spark: SparkSession, root: str, table: str, upto: int | None) -> DataFrame:
    """Rows of the committed batches; batches are a partition column, so the others' files aren't read."""
    rows = spark.read.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}").withColumn("batch_id", F.col("batch_id").cast("long"))
    return rows.join(commits(spark, root, upto).select("batch_id").distinct(), "batch_id", "left_semi")


def write_batch(root: str, store_prefix: str, url_prefix: str, tmp_prefix: str | None = None) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch: its valuable frames and its statistic delta, each under its batch number, then its commit record.

    With `tmp_prefix` also a manifest: which pictures to archive, and which temporary ones to delete.
    A batch that failed is written anew, one that was committed stays as it is, so nothing counts twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, root, batch_id):
            return
        # both tables come from one pass over the batch, whose state must not be advanced twice
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = frame_sink.frame_rows(valuable_only(batch), store_prefix, url_prefix, "frame_num")
            rows = rows.withColumnRenamed("frame_num", "seq").withColumn("arrival", F.lit(batch_id).cast("long"))
            rows.write.mode("overwrite").partitionBy("store_date").parquet(f"{root}/frames/batch_id={batch_id}")
            delta = statistic.scene_statistic(batch)
            delta.write.mode("overwrite").parquet(f"{root}/statistic/batch_id={batch_id}")
            if tmp_prefix is not None:
                jobs = frame_sink.librarian(batch, store_prefix, tmp_prefix).select("action", "key")
                jobs.write.mode("overwrite").parquet(f"{root}/manifest/batch_id={batch_id}")
        finally:
            batch.unpersist()
        commit(spark, root, batch_id)
    return write


def sink_stream(values: DataFrame, root: str, checkpoint: str, store_prefix: str, url_prefix: str,
                trigger: dict | None = None, tmp_prefix: str | None = None) -> StreamingQuery:
    """Start the sink of a value stream."""
    return (values.writeStream.foreachBatch(write_batch(root, store_prefix, url_prefix, tmp_prefix))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def read_frames(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Rows of the frames log as of a batch (the last, if none is given): the latest batch wins, within a batch the higher frame number."""
    log = _committed(spark, root, "frames", upto).drop("batch_id")
    log = log.withColumn("store_date", F.col("store_date").cast("string"))
    ranked = log.withColumn("arrival", F.struct("arrival", "seq")).drop("seq")
    return frame_sink.latest_rows(ranked).drop("arrival")


def read_statistic(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Counters as of a batch: the sum of all deltas up to it."""
    deltas = _committed(spark, root, "statistic", upto)
    return statistic.merge_statistic(deltas, deltas.limit(0))


def read_manifest(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """What to do with pictures, by batch."""
    return _committed(spark, root, "manifest", upto)


def compact(spark: SparkSession, root: str, target: str) -> None:
    """Write the current rows and counters to a new folder, as batch -1 of a log that any stream can continue there."""
    frames = read_frames(spark, root).withColumns({"arrival": F.lit(-1).cast("long"), "seq": F.lit(0).cast("long")})
    frames.write.partitionBy("store_date").parquet(f"{target}/frames/batch_id=-1")
    read_statistic(spark, root).write.parquet(f"{target}/statistic/batch_id=-1")
    commit(spark, target, -1)
