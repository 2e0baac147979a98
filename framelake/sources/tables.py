"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_statistic(spark: SparkSession, name: str) -> DataFrame:
    """The statistic table of the session catalog, which may be a federated one (`catalog.schema.table`)."""
    return spark.table(name)


def rows_as_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("json"))


def rows_from_json(df: DataFrame, schema: str) -> DataFrame:
    return df.select(F.from_json("json", schema).alias("r")).select("r.*")


def federated_catalog(name: str, implementation: str, **options: str) -> dict[str, str]:
    """Session settings that mount an outside store as a catalog, so `spark.sql` reaches its tables."""
    prefix = f"spark.sql.catalog.{name}"
    return {prefix: implementation, **{f"{prefix}.{k}": v for k, v in options.items()}}


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int,
              **options: str) -> DataFrame:
    """A table behind JDBC, read by `parts` tasks over ranges of an integer key."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower),
                                              upperBound=str(upper), numPartitions=str(parts), **options).load())
