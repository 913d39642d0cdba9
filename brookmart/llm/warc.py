"""WARC files of pages, and a Merkle audit of the copies of such files.

``write_warc`` writes pages as WARC 1.1 response records, each a gzip member of its
own, to a file per task, there in ascending order of page id, and stores an index: file,
offset and length of each record and the sha256 of its bytes. Pages are not shuffled.
``tree`` builds a Merkle tree per file over its records in
order of offset: a leaf hashes a record's hash together with its range, a node its
up to ``FANOUT`` children in order, and the roots of the files are the leaves of one
more such tree. ``audit`` compares the trees of two replicas from the top: only
children of nodes that differ are looked at on the next level, down to the records.
The leaf of a file holds its size as well, so surplus bytes show in the root;
``audit_files`` names the files of wrong size, those lost and those that are too many.

Trees are tables (level, node, hash), each level one grouping by (file, parent),
which has no more than ``FANOUT`` rows per group. A replica's leaves are read from
its bytes, every one of them.

Null urls and texts are written empty; a null id comes first. Repeated rows have a
record each. No rows give no files and an empty audit. Other columns are not used.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.llm.common import column, folder, stored
from brookmart.llm.records import file_system

FANOUT = 16
_INDEX = "part int, file string, at long, page_id long, offset long, length long, payload_bytes long, payload_sha256 string, sha256 binary"


def record(page_id: int | None, url: str | None, html: str | None) -> tuple[bytes, str, int]:
    """The record's bytes, and the sha256 (hex) and size of its payload."""
    body = (html or "").encode("utf-8", "surrogatepass")
    digest = hashlib.sha256(body).hexdigest()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + body
    where = "".join(c for c in url or "" if c not in "\r\n")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {where} {digest}")
    head = (
        "WARC/1.1\r\nWARC-Type: response\r\n"
        f"WARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Target-URI: {where}\r\n"
        "WARC-Date: 1970-01-01T00:00:00Z\r\n"
        f"WARC-Payload-Digest: sha256:{digest}\r\n"
        "Content-Type: application/http; msgtype=response\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    ).encode("utf-8", "surrogatepass")
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0), digest, len(body)


def _write(target: str):
    schema = pa.schema([
        ("part", pa.int32()), ("file", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()),
        ("offset", pa.int64()), ("length", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_sha256", pa.string()), ("sha256", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(target)
        part = TaskContext.get().partitionId()
        name, draft = f"pages-{part:06d}.warc.gz", f"{root}/.{uuid.uuid4().hex}"
        out, offset, at = None, 0, 0
        for batch in batches:
            rows = []
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                data, digest, size = record(key, url, html)
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(draft)
                out.write(data)
                rows.append((part, name, at, key, offset, len(data), size, digest, hashlib.sha256(data).digest()))
                offset, at = offset + len(data), at + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        if out is not None:
            # a repeated attempt replaces the file by an equal one
            out.close()
            system.move(draft, f"{root}/{name}")
    return run


def write_warc(pages: DataFrame, target: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Writes the files to ``target``; returns the stored index."""
    rows = pages.select(column(pages, id_col).cast("long").alias("page_id"),
                        column(pages, url_col).cast("string").alias("url"),
                        column(pages, html_col).cast("string").alias("html"))
    order = [F.asc_nulls_first("page_id"), F.xxhash64("url", "html")]
    return stored(rows.sortWithinPartitions(*order).mapInArrow(_write(target), _INDEX), "warc-index")


def _copy(source: str, target: str, change: Callable[[int | None, bytes], bytes] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(source)
        _, to = file_system(target)
        opened, given, out, draft, copied = None, None, None, "", []

        def close() -> None:
            if out is not None:
                out.close()
                system.move(draft, f"{to}/{opened}")
                copied.append(opened)
        for batch in batches:
            for name, offset, length, key in zip(*(c.to_pylist() for c in batch.columns)):
                if name != opened:
                    close()
                    system.create_dir(to, recursive=True)
                    opened, draft = name, f"{to}/.{uuid.uuid4().hex}"
                    given, out = system.open_input_file(f"{root}/{name}"), system.open_output_stream(draft)
                data = given.read_at(length, offset)
                out.write(change(key, data) if change else data)
        close()
        yield pa.RecordBatch.from_arrays([pa.array(copied, pa.string())], names=["file"])
    return run


def replicate(index: DataFrame, source: str, target: str,
              change: Callable[[int | None, bytes], bytes] | None = None) -> int:
    """Copies all files record by record; returns their number.

    ``change`` may damage the bytes of a record (page id, bytes) on their way.
    """
    rows = index.repartition("part").sortWithinPartitions("part", "offset").select(
        "file", "offset", "length", "page_id")
    return stored(rows.mapInArrow(_copy(source, target, change), "file string"), "copied").count()


def _hash_ranges(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(target)
        opened, source = None, None
        for batch in batches:
            found = []
            for name, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if name != opened:
                    opened = name
                    try:
                        source = system.open_input_file(f"{root}/{name}")
                    except FileNotFoundError:
                        source = None  # all records of the file are lost
                data = source.read_at(length, offset) if source else b""
                found.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], batch.column(3), batch.column(2), pa.array(found, pa.binary())],
                names=["file", "offset", "at", "length", "sha256"])
    return run


def read_hashes(index: DataFrame, target: str) -> DataFrame:
    """The hashes of the bytes that a replica really has at the ranges of the index."""
    rows = index.select("file", "offset", "length", "at").repartitionByRange("file", "offset").sortWithinPartitions(
        "file", "offset")
    return rows.mapInArrow(_hash_ranges(target), "file string, offset long, at long, length long, sha256 binary")


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level above: each node the hash of its children's hashes in order."""
    return nodes.groupBy("file", F.floor(F.col("node") / fanout).alias("node")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))), lambda x: x["hash"]), "")
        .alias("children")).select("file", "node", F.sha2("children", 256).alias("hash"))


def meant_sizes(index: DataFrame) -> DataFrame:
    """(file, bytes) as the index has them."""
    return index.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("bytes"))


def real_sizes(spark: SparkSession, target: str) -> DataFrame:
    """(file, bytes) of the files that are there; one row for each."""
    from pyarrow import fs
    system, root = file_system(target)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    rows = [(f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith(".")]
    return spark.createDataFrame(rows, "file string, bytes long")


def tree(leaves: DataFrame, fanout: int = FANOUT, sizes: DataFrame | None = None) -> list[DataFrame]:
    """The levels (file, node, hash) over (file, at, offset, length, sha256), leaves first.

    ``sizes`` (file, bytes) become part of the leaves of the files.

    The highest level has one node for each file; above it come the levels over the
    files, whose ``file`` is empty, up to a single root.
    """
    hashed = F.sha2(F.concat_ws(":", F.hex("sha256"), "offset", "length"), 256)
    levels = [stored(leaves.select("file", F.col("at").alias("node"), hashed.alias("hash")), "leaves")]
    most = levels[0].agg(F.max("node")).first()[0]
    while most:
        levels.append(stored(_parents(levels[-1], fanout), "nodes"))
        most //= fanout
    top = levels[-1].withColumn("bytes", F.lit(None).cast("long")) if sizes is None else levels[-1].join(
        sizes, "file", "left")
    files = top.select(
        F.lit("").alias("file"), F.regexp_extract("file", "([0-9]+)", 1).cast("long").alias("node"),
        F.sha2(F.concat_ws(":", "file", "hash", "bytes"), 256).alias("hash"))
    levels.append(stored(files, "files"))
    most = levels[-1].agg(F.max("node")).first()[0]
    while most:
        levels.append(stored(_parents(levels[-1], fanout), "nodes"))
        most //= fanout
    return levels


def differing(one: list[DataFrame], other: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, at) of the records below differing roots, found from the top down."""
    n_files = next((i for i, _ in enumerate(one) if i and one[i].filter("file = ''").limit(1).count()), len(one))
    wanted = None
    for i in reversed(range(len(one))):
        a, b = one[i], other[i]
        if wanted is not None:
            # the children of nodes that differ; nothing else is compared
            if i == n_files - 1:
                key = [F.regexp_extract("file", "([0-9]+)", 1).cast("long") == F.col("up_node")]
            else:
                key = [F.col("file") == F.col("up_file"), F.floor(F.col("node") / fanout) == F.col("up_node")]
            cond = key[0] if len(key) == 1 else key[0] & key[1]
            a = a.join(wanted, cond, "left_semi")
        found = a.join(b.withColumnRenamed("hash", "other"), ["file", "node"], "left").filter(
            ~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")
        wanted = stored(found.select(F.col("file").alias("up_file"), F.col("node").alias("up_node")), "differing")
    return wanted.select(F.col("up_file").alias("file"), F.col("up_node").alias("at"))


def audit(index: DataFrame, replica: str, fanout: int = FANOUT) -> DataFrame:
    """The index with a column ``damaged``: the replica's bytes differ from what was meant."""
    meant = tree(index.select("file", "at", "offset", "length", "sha256"), fanout, meant_sizes(index))
    there = tree(read_hashes(index, replica), fanout, real_sizes(index.sparkSession, replica))
    bad = differing(meant, there, fanout).withColumn("damaged", F.lit(True))
    return index.join(bad, ["file", "at"], "left").withColumn("damaged", F.coalesce("damaged", F.lit(False)))


def audit_files(index: DataFrame, replica: str, fanout: int = FANOUT) -> DataFrame:
    """(file, meant_bytes, real_bytes, n_damaged, damaged) of all files meant or found.

    A file is damaged if records of it are, if it is lost (no real bytes), is longer
    or shorter than meant, or is in the replica without being meant (no meant bytes).
    """
    records = audit(index, replica, fanout).groupBy("file").agg(F.count_if("damaged").alias("n_damaged"))
    meant = meant_sizes(index).withColumnRenamed("bytes", "meant_bytes")
    real = real_sizes(index.sparkSession, replica).withColumnRenamed("bytes", "real_bytes")
    both = meant.join(real, "file", "full").join(records, "file", "left")
    return both.select("file", "meant_bytes", "real_bytes", F.coalesce("n_damaged", F.lit(0)).alias("n_damaged")).withColumn(
        "damaged", ~F.col("meant_bytes").eqNullSafe(F.col("real_bytes")) | (F.col("n_damaged") > 0))


def flip(page_id: int | None, data: bytes) -> bytes:
    """Turns over a bit in the middle of the record of every 50th page."""
    if page_id is None or page_id % 50:
        return data
    at = len(data) // 2
    return data[:at] + bytes([data[at] ^ 1]) + data[at + 1:]


def damaged_replica(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` and a replica in which every 50th page is damaged; audits it."""
    source, replica = (folder(pages.sparkSession, name) for name in ("warc", "replica"))
    index = write_warc(pages, source)
    replicate(index, source, replica, flip)
    return audit(index, replica)
