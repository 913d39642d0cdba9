"""Starting and draining of streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the micro-batch interval of a running job.
INTERVAL = "5 seconds"
#: Parts that state lies in at least, if the session has as many shuffle partitions.
LEAST_STATE_PARTS = 8

Handler = Callable[[DataFrame, int], None]


@contextmanager
def _set(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings (``__`` stands for a dot) for the time of a block."""
    conf = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_parts(spark: SparkSession) -> int:
    """In how many parts a new stream keeps its state, which its checkpoint fixes for good.

    A batch opens and commits every store of every part, up to six in these jobs, however
    few rows there are; so there are as many parts as cores, or few times as many up to
    ``LEAST_STATE_PARTS`` so that no core waits for another's last part, not as many as a
    batch shuffle has. ``spark.brookmart.state.partitions`` says otherwise, for a cluster that
    will grow.
    """
    chosen = spark.conf.get("spark.brookmart.state.partitions", None)
    if chosen:
        return int(chosen)
    cores = spark.sparkContext.defaultParallelism
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), cores * -(-LEAST_STATE_PARTS // cores))


def _adaptive(handler: Handler, parts: str) -> Handler:
    """Let Spark re-plan at run time what the handler does with its batch, from as many
    ``parts`` as the session shuffles into. Spark turns that off for stateful streams,
    whose own plan is fixed by then. Rows that are kept lie in no more parts than they need."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        with _set(batch.sparkSession, spark__sql__adaptive__enabled="true",
                  spark__sql__adaptive__coalescePartitions__initialPartitionNum=parts,
                  spark__sql__optimizer__canChangeCachedPlanOutputPartitioning="true"):
            handler(batch, batch_id)

    return handle


def start(rows: DataFrame, handler: Handler, checkpoint: str, mode: str = "append",
          drain: bool = False) -> StreamingQuery:
    """Run ``handler(batch, batch_id)`` on every micro-batch.

    Progress is committed to ``checkpoint`` after the handler returns, so a
    batch may come again after a failure, with the same id and rows. With
    ``drain`` the query stops by itself when the input present is used up.
    """
    spark = rows.sparkSession
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    writer = rows.writeStream.foreachBatch(_adaptive(handler, parts)).outputMode(mode).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=INTERVAL)
    # a stream goes on with the settings that it was started under
    with _set(spark, spark__sql__shuffle__partitions=str(state_parts(spark))):
        return writer.start()


def console(rows: DataFrame, n: int = 1000) -> StreamingQuery:
    """Print the first ``n`` rows of every batch."""
    return (rows.writeStream.format("console").option("numRows", n).option("truncate", False)
            .trigger(processingTime=INTERVAL).start())


def offsets(query: StreamingQuery) -> list[dict]:
    """Where each source of the query stood before and after its last batch."""
    last = query.lastProgress
    return [] if last is None else [
        {k: s[k] for k in ("description", "startOffset", "endOffset", "numInputRows")}
        for s in last["sources"]]


def drain(rows: DataFrame, handler: Handler, checkpoint: str, mode: str = "append") -> StreamingQuery:
    query = start(rows, handler, checkpoint, mode, drain=True)
    query.awaitTermination()
    return query
