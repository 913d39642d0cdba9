"""SimHash fingerprints of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from brookmart.llm.common import column

SHINGLE = 4
SEED = 42


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """64-bit hashes of the word shingles, in order.

    Words are runs of other bytes than a space and 0x09 to 0x0D, A-Z lower-cased;
    fewer words than a shingle are one shingle, and no words give none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, "<u8")
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    starts = (ends - size).tolist()
    ends = (ends - 1)[shingle - 1:].tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), "<u8", len(ends))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is in over half the hashes of the word shingles.

    Without words all bits are 0.
    """
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        some = hashes[i:i + (1 << 16)]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                fingerprint(memoryview(t.as_buffer()).tobytes(), shingle) if t.is_valid else 0
                for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "fingerprint"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of each row; a null text is empty."""
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        column(docs, text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fingerprint long")
