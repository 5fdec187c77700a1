"""Helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.session import materialize, ship_package

# Batches between the JVM and Python stay small whatever a row weighs.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# A key with more than one row in this many is heavy; there are at most so
# many heavy keys, whatever the input.
HEAVY_PARTS = 1000

# A side is broadcast only if its measured bytes stay below this.
BROADCAST_BYTES = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Let workers import this package and bound the batches they get."""
    ship_package(spark)
    for key, value in _BATCHES.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of ``left`` with the one row per key of ``right``, safe for hot keys.

    ``right`` is a written table; its column ``count`` bounds the rows that
    ``left`` has for the key. Keys holding over a thousandth of that total, a
    thousand at most, are broadcast; the rows they match are then spread over
    all partitions of the ordinary join that serves the other keys.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    values = [c for c in right.columns if c not in keys]
    packed = right.select(*keys, F.struct(*values).alias("_light"))
    over = F.col(f"_light.{count}") * HEAVY_PARTS > F.lit(total)
    heavy = F.broadcast(packed.filter(over).withColumnRenamed("_light", "_heavy"))
    light = packed.filter(~over).withColumn("_spread", F.lit(-1).cast("bigint"))
    spread = F.when(F.col("_heavy").isNotNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("bigint"))
    marked = left.join(heavy, keys, "left").withColumn("_spread", spread)
    joined = marked.join(light, [*keys, "_spread"], "left").withColumn("_found", F.coalesce("_heavy", "_light"))
    return joined.filter("_found IS NOT NULL").select(*left.columns, *[F.col(f"_found.{v}").alias(v) for v in values])


def small(df: DataFrame, bytes_a_row: int) -> bool:
    """Whether the rows of ``df``, a written or small table, may be broadcast."""
    return df.count() * bytes_a_row <= BROADCAST_BYTES


def binary(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


# Word bytes of the letter-and-digit word class; A-Z become a-z,
# all else in ASCII separates.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def lowered(text: bytes) -> bytes:
    """A-Z in lower case, all other characters as they are."""
    return text.translate(_LOWER)


def letter_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all non-ASCII characters."""
    return text.translate(_ALNUM).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Runs between space, tab, line feed, vertical tab, form feed and return."""
    return text.split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes, by its start."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    powers = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers, out=sums[1:])
    inverse = np.multiply.accumulate(np.full(n - width + 1, _INVERSE, np.uint64))
    return mixed((sums[width:] - sums[: n - width + 1]) * inverse)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finalizer; other seeds give independent values."""
    x = x ^ np.uint64((seed * 0xD6E8FEB86659FD93) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def document_key(id_col: str, text_col: str) -> list[Column]:
    """Columns that tell rows apart: the id and a hash of the text.

    Rows equal in both are one document: they get one result, each.
    """
    return [F.col(id_col), F.xxhash64(F.col(text_col)).alias("_thash")]


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns``, and whole rows in one, so that no name of ``docs`` can clash with another."""
    return docs.select(F.struct("*").alias("_row"), *[F.col(f"`{c}`") for c in columns])


def unpacked(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The columns ``names`` of the rows packed in ``df``, some of them changed."""
    return df.select(*[(changed[n] if n in changed else F.col("_row").getField(n)).alias(n) for n in names])


__all__ = [
    "binary", "document_key", "hash_words", "join_counted", "letter_words", "lowered", "materialize", "mixed", "prepare",
    "packed", "rolling", "small", "space_words", "unpacked",
]
