"""Turning a table into a stream: rows arrive chunk by chunk in a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brookmart.session import work_dir
from brookmart.sinks import manifest
from brookmart.sources.streams import file_stream

CHUNKS = 4
Span = tuple[int, int]


def span(rows: DataFrame, at: Column) -> Span:
    """First and last time in whole seconds."""
    seconds = F.unix_seconds(at)
    return tuple(rows.agg(F.min(seconds), F.max(seconds)).first())


def by_time(rows: DataFrame, at: Column, within: Span, chunks: int = CHUNKS) -> DataFrame:
    """Add ``_chunk``, one of ``chunks`` equal spans of time; what comes after the
    last time goes to the last chunk."""
    lo, hi = within
    share = F.call_function("div", (F.unix_seconds(at) - F.lit(lo)) * chunks, F.lit(hi - lo + 1))
    return rows.withColumn("_chunk", F.least(share.cast("int"), F.lit(chunks - 1)))


class Replay:
    """A stream source fed with one chunk at a time.

    The rows are written once, split by ``_chunk``; ``feed`` then moves a chunk's
    files into the folder the stream reads. Only for more ``times`` are they copied.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame, name: str):
        self.spark = spark
        self.stage = work_dir(spark, f"{name}-stage")
        self.path = work_dir(spark, f"{name}-in")
        self.schema = T.StructType([f for f in rows.schema.fields if f.name != "_chunk"])
        rows.write.partitionBy("_chunk").parquet(self.stage)
        spark.createDataFrame([], self.schema).write.parquet(self.path)

    def feed(self, chunk: int, times: int = 1) -> None:
        part = self.spark.read.schema(self.schema).parquet(f"{self.stage}/_chunk={chunk}")
        for _ in range(times - 1):
            part.write.mode("append").parquet(self.path)
        manifest.move(self.spark, f"{self.stage}/_chunk={chunk}", self.path, f"chunk{chunk}-")

    def stream(self, files_per_trigger: int | None = None) -> DataFrame:
        return file_stream(self.spark, self.path, self.schema, files_per_trigger)
