"""Stable running numbers for rows of files, without sorting the rows.

A file split is read front to back by one task, so rows of a split are numbered
by ``monotonically_increasing_id``. One small count per split and a running sum
over those counts turn that into numbers per file or over all files. Only the
counts are shuffled. Parquet readers number rows themselves, and footers have the
counts, so there nothing is counted. Split counts grow with the data (one row per split), so
they are written out, counted, and broadcast only when small; beyond that the
rows are joined on the split key, of which no group exceeds one split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawlake.session import bounded_broadcast, materialize

Decorate = Callable[[DataFrame], DataFrame]

SPLIT = ["_tord", "_fp", "_bs"]


def tag_scan(df: DataFrame, template_ord: int = 0) -> DataFrame:
    """Add file, split start and file facts to a scan of files.

    All of them are constant per split; ``_fp`` is the path as the scan gives
    it, so nothing is computed per row here.
    """
    return df.withColumns(
        {
            "_tord": F.lit(template_ord),
            "_fp": F.col("_metadata.file_path"),
            "_bs": F.col("_metadata.file_block_start"),
            "_mtime": F.col("_metadata.file_modification_time"),
            "_size": F.col("_metadata.file_size"),
        }
    )


def running_offsets(counts: DataFrame, value: str, label: str) -> DataFrame:
    """Exclusive running sum of ``value`` in split order: ``_goff`` over all
    files and ``_foff`` within the file.

    Range-partitioned, so no task sees more than its share of the splits; only
    one total per range is summed in one place.
    """
    ranged = counts.repartitionByRange(*SPLIT).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, label)
    in_range = Window.partitionBy("_range").orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_n"))
    starts = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # At most one row per shuffle partition.
    offsets = ranged.join(F.broadcast(starts), "_range").withColumn(
        "_goff", F.col("_start") + F.coalesce(F.sum(value).over(in_range), F.lit(0))
    )
    first = offsets.groupBy("_tord", "_fp").agg(
        F.min("_goff").alias("_first"), F.sum(value).alias("_file_rows")
    )
    offsets = offsets.join(first, ["_tord", "_fp"]).withColumn("_foff", F.col("_goff") - F.col("_first"))
    return offsets.drop("_range", "_start", "_first")


def split_offsets(df: DataFrame, decorate: Decorate | None = None) -> DataFrame:
    """Offsets of every split of ``df`` (which carries ``_mid``), written out.

    ``decorate`` adds what follows from the path, once per split.
    """
    counts = df.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    offsets = running_offsets(counts, "_n", "split-counts")
    return materialize(decorate(offsets) if decorate else offsets, "split-offsets")


def file_offsets(files: DataFrame, decorate: Decorate | None = None) -> tuple[DataFrame, bool]:
    """As ``split_offsets`` for a scan whose reader numbers the rows of a file: one row
    per file (``files`` has its ``_n``), hinted for broadcast if the flag is set."""
    offsets = running_offsets(files, "_n", "file-counts").select("_fp", "_goff")
    offsets = materialize(decorate(offsets) if decorate else offsets, "file-offsets")
    return bounded_broadcast(offsets)


def join_file_offsets(df: DataFrame, side: DataFrame) -> DataFrame:
    """Bring file offsets to rows that have ``_findex``; filters on other columns pass through."""
    joined = df.withColumn("_bs", F.lit(0).cast("bigint")).join(side, "_fp", "left")
    return joined.withColumn("_gindex", F.col("_goff") + F.col("_findex")).drop("_goff")


def join_offsets(df: DataFrame, offsets: DataFrame) -> tuple[DataFrame, bool]:
    """Bring split offsets to rows; the flag tells if rows kept their order."""
    side, small = bounded_broadcast(offsets)
    joined = df.join(side, SPLIT, "left")
    at = F.col("_mid") - F.col("_m0")
    # A scan laid out differently from the counted one must not pass silently.
    sound = F.col("_n").isNotNull() & (at >= 0) & (at < F.col("_n"))
    wrong = F.raise_error(F.concat(F.lit("File changed or split differently while reading: "), F.col("_fp")))
    return joined.withColumn("_at", F.when(sound, at).otherwise(wrong.cast("bigint"))), small


_SCRATCH = ["_mid", "_m0", "_n", "_goff", "_foff", "_at", "_file_rows"]


def _numbers(df: DataFrame) -> DataFrame:
    at = F.col("_at")
    numbers = {"_findex": F.col("_foff") + at, "_gindex": F.col("_goff") + at}
    return df.withColumns(numbers).drop(*_SCRATCH)


def number_scan(df: DataFrame, decorate: Decorate | None = None) -> tuple[DataFrame, DataFrame]:
    """Number the rows of a tagged scan in file order.

    ``_findex`` restarts at 0 in each file; ``_gindex`` runs on over all files,
    by template, path and position. The second frame has the split offsets.
    """
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    offsets = split_offsets(tagged, decorate)
    joined, _ = join_offsets(tagged, offsets)
    return _numbers(joined), offsets


def renumber(df: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Number rows that carry split keys and an order column but have lost
    their place in a scan. Windows cover one split each, so a huge file never
    meets in one task."""
    within = Window.partitionBy(*SPLIT).orderBy(order)
    counts = df.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_n"))
    offsets = materialize(running_offsets(counts, "_n", "split-counts"), "split-offsets")
    side, _ = bounded_broadcast(offsets)
    placed = df.withColumn("_at", F.row_number().over(within) - 1).join(side, SPLIT)
    return _numbers(placed), offsets


def number_across(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Replace ``_gindex`` for rows of several scans numbered one by one;
    ``counts`` has the split counts of all of them."""
    offsets = materialize(running_offsets(counts, "_n", "split-counts"), "split-offsets")
    side, _ = bounded_broadcast(offsets.select(*SPLIT, "_goff", "_foff"))
    joined = df.drop("_gindex").join(side, SPLIT)
    return joined.withColumn("_gindex", F.col("_findex") - F.col("_foff") + F.col("_goff")).drop("_goff", "_foff")
