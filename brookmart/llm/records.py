"""Token ids in files of length-delimited records, with an offset index beside them.

A record is framed as: 8 bytes of length, the masked crc32 of these bytes, the
payload, the masked crc32 of the payload; all numbers are little-endian. The
payload holds a flag for a null id, the id (8 bytes), the size of a token id in
bytes, and the token ids. Files are numbered in ascending order of document id
(nulls first; rows of one id in order of their text's hash), and so are the
records in them. The index has a row for each record: file, offset and length,
which is what a shuffled read needs.

A task writes its file under a name of its own and renames it when it is complete,
so a repeated attempt replaces the file by an equal one. Files go through
``pyarrow.fs``, which knows local paths, HDFS (with libhdfs on the executors) and
object stores.

Null texts are empty and have the end id only. Rows that repeat have a record each.
No rows give no files and an empty index. Other columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import column, crc32_ids, folder, stored
from brookmart.llm.tokens import TEXTS, encoder

END_ID = 2
_INDEX = "part int, file string, doc_id long, at long, offset long, length long, n_tokens long"
_HEAD = "<?qB"


class DamagedRecord(ValueError):
    """A frame whose lengths or checksums do not agree with its bytes."""


def masked(data: bytes) -> int:
    """The crc32 turned and shifted, so that checksums of checksums differ."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def body_size(head: bytes) -> int:
    """The payload's size, from the first 12 bytes of a frame."""
    if len(head) < 12 or struct.unpack_from("<I", head, 8)[0] != masked(head[:8]):
        raise DamagedRecord("length")
    return struct.unpack_from("<Q", head)[0]


def body(data: bytes) -> bytes:
    """The payload, from what follows the first 12 bytes of a frame."""
    if len(data) < 4 or struct.unpack("<I", data[-4:])[0] != masked(data[:-4]):
        raise DamagedRecord("payload")
    return data[:-4]


def unframe(data: bytes) -> bytes:
    """The payload of one whole frame."""
    size = body_size(data[:12])
    if len(data) != size + 16:
        raise DamagedRecord("frame is cut short")
    return body(data[12:])


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(_HEAD, doc_id is None, doc_id or 0, width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    null, doc_id, width = struct.unpack_from(_HEAD, payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_HEAD))


def file_system(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def _write(target: str, vocabulary: str, end_id: int):
    schema = pa.schema([
        ("part", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()),
        ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(target)
        part = TaskContext.get().partitionId()
        name, draft = f"part-{part:06d}.records", f"{root}/.{uuid.uuid4().hex}"
        tokens = encoder(vocabulary, spaces=False)
        end = np.asarray([end_id], tokens.dtype).tobytes()
        out, offset, at = None, 0, 0
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                some = batch.slice(i, TEXTS)
                rows = []
                for key, ids in zip(some.column(0).to_pylist(), tokens.encode(some.column(1))):
                    data = frame(pack(key, ids.tobytes() + end, tokens.dtype.itemsize))
                    if out is None:
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(draft)
                    out.write(data)
                    rows.append((part, name, key, at, offset, len(data), len(ids) + 1))
                    offset, at = offset + len(data), at + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        if out is not None:
            out.close()
            system.move(draft, f"{root}/{name}")
    return run


def write_records(docs: DataFrame, target: str, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Writes the files to ``target``; returns the stored index."""
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        column(docs, text_col).cast("string").alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    # the text is what is shuffled, so ranges are found without encoding anything
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.mapInArrow(_write(target, vocabulary, end_id), _INDEX), "offsets")


def _read(target: str):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32())),
    ])

    def of(payload: bytes, start: int, whole: bool) -> dict:
        key, ids = unpack(payload)
        return {"doc_id": key, "start": start, "n_tokens": len(ids), "ids_crc32": crc32_ids(ids),
                "ids": ids.astype(np.int32) if whole else None}

    def files(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, root = file_system(target)
            for batch in batches:
                for name, n, start in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    with system.open_input_stream(f"{root}/{name}", buffer_size=1 << 20) as source:
                        rows = []
                        for _ in range(n):
                            size = body_size(source.read(12))
                            rows.append(of(body(source.read(size + 4)), start, whole))
                            start += rows[-1]["n_tokens"]
                            if len(rows) >= 512:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows = []
                        if source.read(1):
                            raise DamagedRecord(f"{name}: more records than in its index")
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)
        return run

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(target)
        source, opened = None, None
        for batch in batches:
            rows = []
            for name, offset, length, start in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if name != opened:
                    source, opened = system.open_input_file(f"{root}/{name}"), name
                rows.append(of(unframe(source.read_at(length, offset)), start, True))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
    return files, picked


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"


def with_starts(index: DataFrame) -> DataFrame:
    """One row per file: its records, and the tokens of all files before it."""
    files = index.groupBy("part", "file").agg(
        F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per file, not per record
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_records(index: DataFrame, target: str, ids: bool = True) -> DataFrame:
    """Every record of the files, each file by one task from its beginning to its end."""
    files = stored(with_starts(index), "files")
    n = files.count()
    if n == 0:
        return files.limit(0).selectExpr("start AS doc_id").select(
            *[F.lit(None).cast(t).alias(c) for c, t in (f.split(" ") for f in _READ.split(", "))])
    rows = files.repartitionByRange(n, "part").select("file", "n", "start")
    return rows.mapInArrow(_read(target)[0](ids), _READ)


def fetch(wanted: DataFrame, target: str) -> DataFrame:
    """The records that rows of the index name, in any selection or order.

    ``start`` is the index's ``at``: the record's place in its file.
    """
    rows = wanted.select("file", "offset", "length", "at")
    return rows.mapInArrow(_read(target)[1], _READ).withColumnRenamed("start", "at")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
               end_id: int = END_ID) -> DataFrame:
    """Writes ``docs`` to new files and reads these back."""
    target = folder(docs.sparkSession, "records")
    return read_records(write_records(docs, target, vocabulary, id_col, text_col, end_id), target, ids=False)
