"""Tables written batch by batch.

Batch N lives in the folder ``batch_id=N`` and is written with overwrite, so a
batch that runs again after a failure replaces its own rows and nothing else:
with a replayable source the table holds every batch exactly once. When its job
is done, a batch is committed by a marker file in the table's ``_commits`` folder;
readers see committed batches only, whatever markers Spark's writers leave.

Keyed tables are merged when read: the newest row of a key wins. Every
``FULL_EVERY`` batches the merged rows are also written as ``full_id=N``, from
which a reader starts, so that reading does not slow down as batches add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brookmart.operators.keyed import last_per_key

BATCH, FULL, COMMITS = "batch_id", "full_id", "_commits"
FULL_EVERY = 100


def write_batch(rows: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """Write one batch; ``by`` adds partition folders, such as the day.

    Rows are rebalanced on the partition columns, which keeps files few and
    splits a day too large for one file.
    """
    _write(rows, path, f"{BATCH}={batch_id}", by)


def _write(rows: DataFrame, path: str, name: str, by: Sequence[str]) -> None:
    fs, folder = _folder(rows.sparkSession, path)
    marker = folder.suffix(f"/{COMMITS}/{name}")
    fs.delete(marker, False)
    if by:
        rows = rows.hint("rebalance", *by)
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}")
    fs.create(marker, True).close()


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder.suffix(f"/{COMMITS}/{BATCH}={batch_id}"))


def upsert(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str],
           version: Sequence[str] = (), full_every: int = FULL_EVERY, tidy: bool = False) -> None:
    """Write one batch of a keyed table, and from time to time all of it.

    ``tidy`` deletes then what only readers of long past batches would need.
    """
    write_batch(rows, path, batch_id)
    if batch_id % full_every == full_every - 1:
        everything = read_latest(rows.sparkSession, path, rows.schema, keys, version, before=batch_id + 1)
        _write(everything, path, f"{FULL}={batch_id}", ())
        if tidy:
            expire(rows.sparkSession, path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table that is only appended to, with the batch they came in."""
    if not _ids(spark, path, BATCH):
        return spark.createDataFrame([], _with_batch(schema))
    return spark.read.schema(_with_batch(schema)).parquet(path).where(committed(spark, path))


def committed(spark: SparkSession, path: str) -> Column:
    """A condition on the batch column: batches begun but not committed are left out."""
    fs, folder = _folder(spark, path)
    begun = {int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder)
             if s.getPath().getName().startswith(f"{BATCH}=")}
    return ~F.col(BATCH).isin(sorted(begun.difference(_ids(spark, path, BATCH))))


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """The rows of one batch; none before the first. A batch that is not there raises."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    if not is_committed(spark, path, batch_id):
        raise LookupError(f"batch {batch_id} of {path} is not committed")
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id}")


def read_changes(spark: SparkSession, path: str, schema: T.StructType,
                 before: int | None = None) -> DataFrame:
    """Rows of a keyed table from its last full writing on, with their batch.
    With ``before``, as the table stood before that batch."""
    def known(kind: str) -> list[int]:
        return [i for i in _ids(spark, path, kind) if before is None or i < before]

    full = max(known(FULL), default=-1)
    newer = [f"{path}/{BATCH}={i}" for i in known(BATCH) if i > full]
    rows = spark.createDataFrame([], _with_batch(schema))
    if full >= 0:
        rows = spark.read.schema(schema).parquet(f"{path}/{FULL}={full}").withColumn(
            BATCH, F.lit(full).cast("bigint"))
    if newer:
        changed = spark.read.schema(_with_batch(schema)).option("basePath", path).parquet(*newer)
        rows = rows.unionByName(changed) if full >= 0 else changed
    return rows


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                version: Sequence[str] = (), drop_deletes: str | None = None,
                before: int | None = None) -> DataFrame:
    """The current row of each key: of the latest batch, and in it of the
    greatest ``version``. ``drop_deletes`` names a column that holds "delete"
    for a removed key; without it a deleted row stays, as an upsert."""
    rows = last_per_key(read_changes(spark, path, schema, before), keys, [BATCH, *version])
    if drop_deletes:
        rows = rows.where(F.coalesce(F.col(drop_deletes) != "delete", F.lit(True)))
    return rows.drop(BATCH)


def expire(spark: SparkSession, path: str) -> int:
    """Delete the folders of a keyed table that no reader starts from any more:
    those up to the last full writing but one. Returns how many were deleted."""
    fulls = _ids(spark, path, FULL)
    if len(fulls) < 2:
        return 0
    old = [f"{BATCH}={i}" for i in _ids(spark, path, BATCH) if i <= fulls[-2]]
    return _delete(spark, path, old + [f"{FULL}={i}" for i in fulls[:-2]])


def expire_before(spark: SparkSession, path: str, batch_id: int) -> int:
    """Delete the batches before ``batch_id`` of a table of which only the last counts."""
    return _delete(spark, path, [f"{BATCH}={i}" for i in _ids(spark, path, BATCH) if i < batch_id])


def _delete(spark: SparkSession, path: str, names: list[str]) -> int:
    fs, folder = _folder(spark, path)
    for name in names:
        # without its marker a folder is not read any more
        fs.delete(folder.suffix(f"/{COMMITS}/{name}"), False)
        fs.delete(folder.suffix(f"/{name}"), True)
    return len(names)


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != BATCH]
                        + [T.StructField(BATCH, T.LongType())])


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _ids(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Ids of the committed folders of a table."""
    fs, folder = _folder(spark, path)
    commits = folder.suffix(f"/{COMMITS}")
    if not fs.exists(commits):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(commits)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))
