"""Incremental ingest: every newly arrived file exactly once.

The stream carries file paths only; each micro-batch runs the batch ingest over
its files. Which files are new is the stream checkpoint's business, so a restart
goes on where the last run stopped. Batches write under their template and id and
replace what an interrupted attempt may have left. Several templates of a table
share a target, each with a checkpoint of its own, and run one after the other.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rawlake.operators import sink
from rawlake.plans.ingest import Found
from rawlake.session import materialize
from rawlake.sources.inventory import describe, plain_path, zip_members

_FILE_STREAM = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(job: Any, template_ord: int = 0) -> DataFrame:
    """Stream of the files a template finds."""
    pattern = job.templates[template_ord].glob()
    files = job.spark.readStream.schema(_FILE_STREAM).format("binaryFile").load(pattern)
    return files.select("path", "modificationTime", "length")


def ingest_batch(job: Any, files: DataFrame, batch_id: int, target: str, template_ord: int = 0) -> int:
    """Ingest the files of one micro-batch into ``target/data/template=<i>/batch=<id>``.

    Row numbers per file are as in a batch run. In aggregate mode they go on
    from the rows of earlier batches, counted next to the data; a batch that
    runs again takes the numbers it had. A file that gives no input raises.
    """
    spark = files.sparkSession
    nothing = {"zfile_name": "string", "zfile_mtime": "timestamp", "zfile_size": "bigint", "zfile_compress_size": "bigint"}
    listed = files.select(
        plain_path(F.col("path")).alias("path"),
        F.col("modificationTime").alias("file_mtime"),
        F.col("length").alias("file_size"),
        *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()],
    )
    template = job.templates[template_ord]
    if template.is_zip:
        listed = zip_members(listed, template.regexes()[1])
    inventory = materialize(describe(listed, template, job.creation_time).where("matched"), "stream-inventory")
    used = inventory.select(F.substring_index("path", "|", 1).alias("path"))
    lost = files.select(plain_path(F.col("path")).alias("path")).join(used, "path", "left_anti").orderBy("path").first()
    if lost is not None:
        raise ValueError(f"'{lost['path']}' is listed for '{template.template}', but nothing in it matches")
    nothing_new = inventory.limit(0)
    inventories = [Found(inventory if i == template_ord else nothing_new) for i in range(len(job.templates))]
    rows = job.rows(inventories=inventories)
    first = 0
    if job.aggregate and "_index" in rows.columns:
        first = rows_before(job, target, batch_id, template_ord)
        rows = rows.withColumn("_index", F.col("_index") + first)
    place = f"template={template_ord}/batch={batch_id}"
    sink.write_parquet(rows, f"{target}/data/{place}")
    written = spark.read.parquet(f"{target}/data/{place}")
    count = written.agg(F.lit(first).cast("bigint").alias("first"), F.count(F.lit(1)).alias("rows"))
    sink.write_parquet(count, f"{target}/counts/{place}")
    return batch_id


def rows_before(job: Any, target: str, batch_id: int, template_ord: int = 0) -> int:
    """Rows written before this batch, from the counts kept with the target."""
    if not sink.exists(job.spark, f"{target}/counts"):
        return 0
    counts = job.spark.read.parquet(f"{target}/counts")
    own = (F.col("template") == template_ord) & (F.col("batch") == batch_id)
    again, total = counts.agg(F.max(F.when(own, F.col("first"))), F.sum("rows")).first()
    return again if again is not None else total or 0


def start(job: Any, target: str, checkpoint: str, template_ord: int = 0, max_files: int | None = None) -> StreamingQuery:
    """Ingest all files not seen before, then stop."""
    stream = file_stream(job, template_ord)
    if max_files:
        pattern = job.templates[template_ord].glob()
        reader = job.spark.readStream.schema(_FILE_STREAM).format("binaryFile").option("maxFilesPerTrigger", max_files)
        stream = reader.load(pattern).select("path", "modificationTime", "length")
    return (
        stream.writeStream.foreachBatch(lambda df, i: ingest_batch(job, df, i, target, template_ord) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_target(job: Any, target: str) -> DataFrame:
    return job.spark.read.parquet(f"{target}/data").drop("template", "batch")
