"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast joins are used for a side only after it was measured; above this
# size the join is left to a shuffle on keys that are bounded per group.
MAX_BROADCAST_BYTES = 512 * 1024 * 1024

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Ragged rows are only noticed when the CSV parser sees every column.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Date parts MM and mm, and source columns, differ by case alone.
    "spark.sql.caseSensitive": "true",
    # Wide projections of guarded conversions generate methods the JVM would
    # not compile; beyond its limit Spark shall use its split-up form.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job here needs; safe to call often."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # File splits depend on this number. Pinning it keeps the split layout of
    # two scans of one DataFrame equal while executors come and go.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set(
            "spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism)
        )
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor."""
    from rawlake.sources import remote

    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent).as_posix())
    path = f"{shared_dir(spark)}/rawlake/package-{application}/rawlake.zip"
    with remote.open_output(path) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a session within one process may do without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if root.startswith("/"):
        # The same place for Spark and for tasks that open files themselves.
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        full = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
        root = root if full.startswith("file:") else full
    return root.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/rawlake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that outlives lost executors, and freezes values
    such as partition ids that a recomputation could change.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size: text by its length, other cells as 16 bytes."""
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    fixed = 16 * (len(df.columns) + 2)
    nested = [
        F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        for f in df.schema
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
    ]
    per_row = sum([*text, *nested], F.lit(fixed)).cast("bigint")
    return df.agg(F.sum(per_row)).first()[0] or 0


def bounded_broadcast(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast if it takes at most ``limit`` bytes.

    Returns the frame and whether the hint was given, so that callers can take
    a shuffle-safe way otherwise. ``df`` is a written table, cheap to measure.
    """
    limit = MAX_BROADCAST_BYTES if limit is None else limit
    small = measured_bytes(df) <= limit
    return (F.broadcast(df) if small else df), small
