"""Stream scans. A message is a row ``(key, value, topic, partition, offset, timestamp)``.

The consumer group of a job is its checkpoint folder: a restart on the same
folder resumes behind the last finished batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 offsets: dict[int, int] | str = "latest", **options: str) -> DataFrame:
    """Messages of one topic from the latest offset or from given offsets per
    partition. Needs the Kafka connector on the class path."""
    start = offsets if isinstance(offsets, str) else json.dumps(
        {topic: {str(p): o for p, o in offsets.items()}})
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
        .load()
    )
    return raw.selectExpr("cast(key as string) key", "cast(value as string) value",
                          "topic", "partition", "offset", "timestamp",
                          *(["headers"] if "includeHeaders" in options else []))


def once_per_origin(messages: DataFrame, keep: str = "10 minutes") -> DataFrame:
    """Kafka messages without those sent again under the same ``origin`` header.
    Messages without one are told apart by their offsets."""
    header = F.filter("headers", lambda h: h["key"] == "origin")
    origin = F.coalesce(F.try_element_at(header, F.lit(1))["value"].cast("string"),
                        F.concat_ws(":", "topic", "partition", "offset"))
    return messages.withColumn("origin", origin).withWatermark(
        "timestamp", keep).dropDuplicatesWithinWatermark(["origin"]).drop("origin")


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                files_per_trigger: int | None = None) -> DataFrame:
    """Rows of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
