"""Frame messages as tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake import schemas

REJECT = "rejected"


def parse_messages(df: DataFrame, schema: T.StructType = schemas.DETECTED_FRAME, value: str = "value") -> DataFrame:
    """JSON text as typed columns; a malformed message keeps its text in `rejected`, its other columns are null."""
    typed = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    body = F.from_json(F.col(value).cast("string"), typed,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT})
    parsed = df.withColumn("_m", body)
    kept = [c for c in df.columns if c != value]
    broken = F.col(f"_m.{REJECT}").isNotNull()
    fields = [F.when(~broken, F.col(f"_m.`{f.name}`")).alias(f.name) for f in schema.fields]
    return parsed.select(*kept, *fields, F.col(f"_m.{REJECT}").alias(REJECT))


def read_frame_messages(spark: SparkSession, path: str, schema: T.StructType = schemas.DETECTED_FRAME) -> DataFrame:
    """Messages of a folder of JSON lines."""
    return parse_messages(spark.read.text(path), schema)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejects(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT).isNotNull())


def topic_options(servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None,
                  fail_on_loss: bool = True) -> dict[str, str]:
    """Options of a topic subscription from the earliest offset; the session needs the Kafka connector.

    Messages that left the topic unread stop the query, unless `fail_on_loss` is off.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
               "failOnDataLoss": str(fail_on_loss).lower()}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_wire(spark: SparkSession, topic: str, servers: str | None = None, starting: str = "earliest",
                max_per_trigger: int | None = None) -> DataFrame:
    """A stream of `key`, `arrival` and JSON `value`: of a topic, or of a folder of JSON lines.

    `arrival` is the offset in the topic. Lines of files have no common order, so there it is the number that the message
    itself carries as `arrival`, null where it has none.
    """
    if servers:
        raw = spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, max_per_trigger)).load()
        return raw.select(F.col("key").cast("string").alias("key"), F.col("offset").alias("arrival"),
                          F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    place = F.get_json_object("value", "$.arrival").try_cast("long")
    return reader.load(topic).select(F.lit(None).cast("string").alias("key"), place.alias("arrival"), "value")


def stream_messages(spark: SparkSession, topic: str, servers: str | None = None, starting: str = "earliest",
                    schema: T.StructType = schemas.DETECTED_FRAME, max_per_trigger: int | None = None) -> DataFrame:
    """A stream of typed messages with `key` and `arrival`."""
    return parse_messages(stream_wire(spark, topic, servers, starting, max_per_trigger), schema)
