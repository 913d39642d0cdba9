"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.session import work_dir

#: ASCII white space as the contracts define it: a space and 0x09 to 0x0D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\x09-\\x0D]+"

#: A-Z in lower case and all ASCII that is no letter or digit a space; other bytes stay.
ALNUM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see."""
    return work_dir(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    It cuts the lineage: what reads the result does not depend on executors that
    may be lost, nor is anything computed twice.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ...: no name clashes or needs quoting."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def column(df: DataFrame, name: str) -> Column:
    """The column of just this name, whatever dots or marks are in it."""
    return df["`" + name.replace("`", "``") + "`"]


def crc32_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data)


def partitions_for(spark: SparkSession, n: int, each: int) -> int:
    """As many partitions as ``n`` rows need at ``each`` rows, two at least."""
    return max(2, -(-n // each))


def lower_ascii(name: str | Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def some_texts(texts: DataFrame, sample: int, pool: int, longest: int, where: Column | None = None) -> list[str]:
    """At most ``sample`` different texts of the column ``text``, by their hash.

    About ``pool`` rows are picked by hash, wherever they are and in whatever order;
    of those that are not empty, no longer than ``longest`` and meet ``where``, the
    ones of least hash are taken. So tasks send on little, however many they are.
    """
    n = texts.count()
    share = min(1.0, pool / max(n, 1))
    h = F.xxhash64("text")
    picked = texts.filter((F.pmod(h, F.lit(1 << 30)) < int(share * (1 << 30))) & F.length("text").between(1, longest))
    if where is not None:
        picked = picked.filter(where)
    few = picked.distinct().select(h.alias("h"), "text").orderBy("h", "text").limit(sample)
    return [r.text for r in few.collect()]
