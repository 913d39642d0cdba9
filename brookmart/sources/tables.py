"""Dimension and document tables read by SQL, by key list or by id."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from brookmart.functions.text import word_count


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Rows of a SQL text; ``{name}`` in it stands for the table of that name."""
    return spark.sql(sql, **tables)


def jdbc_table(spark: SparkSession, url: str, table: str, **options: Any) -> DataFrame:
    """A database table or sub-query. Pass partitionColumn, lowerBound, upperBound
    and numPartitions to read it with several tasks."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def by_keys(dim: DataFrame, dim_key: str, batch: DataFrame, batch_key: str) -> DataFrame:
    """The dimension rows whose key occurs in the batch, each once.

    The keys are made distinct on the map side first, so a key that fills a
    third of the batch crosses the shuffle once per task.
    """
    keys = batch.select(F.col(batch_key).cast("string").alias("_key")).distinct()
    return dim.join(keys, dim[dim_key].cast("string") == keys["_key"], "left_semi")


def get_document(docs: DataFrame, key: str, value: Any) -> DataFrame:
    """Lookup by id; the predicate reaches the scan."""
    return docs.where(F.col(key) == F.lit(value))


def search_documents(docs: DataFrame, word: str, text: str, objects: str, field: str,
                     value: Any, key: str, size: int = 10) -> DataFrame:
    """Documents that hold ``word`` and have an element of the array of structs
    ``objects`` whose ``field`` is ``value``; best ``size`` by word frequency."""
    scored = docs.where(
        F.exists(objects, lambda o: o[field] == F.lit(value))
    ).select(key, word_count(F.col(text), word).alias("score"))
    # filtered last: before the limit the words would be counted twice
    return scored.orderBy(F.desc("score"), F.asc(key)).limit(size).where("score > 0")
