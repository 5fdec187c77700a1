"""Raw-file discovery as a relation: one row per file or archive member."""

from __future__ import annotations

import datetime as dt
import os
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.sources import remote
from rawlake.sources.templates import PARTS, PathTemplate

FILE_SCHEMA = (
    "path string, file_mtime timestamp, file_size bigint, zfile_name string, "
    "zfile_mtime timestamp, zfile_size bigint, zfile_compress_size bigint"
)


def plain_path(path: Column) -> Column:
    """Local paths without scheme, others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def decoded_path(path: Column) -> Column:
    """Plain form of a path as scans report it (URI-encoded)."""
    return plain_path(F.url_decode(F.regexp_replace(path, r"\+", "%2B")))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def one_glob(globs: list[str]) -> str:
    """A single glob for several, with their differing ends as alternatives."""
    if len(globs) == 1:
        return globs[0]
    shared = os.path.commonprefix(globs).rpartition("/")[0] + "/"
    return shared + "{" + ",".join(g.removeprefix(shared) for g in globs) + "}"


def list_files(spark: SparkSession, globs: list[str]) -> DataFrame:
    """Files below the globs; contents are never read."""
    pattern = one_glob(globs)
    try:
        found = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)
    return found.select(
        plain_path(F.col("path")).alias("path"),
        F.col("modificationTime").alias("file_mtime"),
        F.col("length").alias("file_size"),
        F.lit(None).cast("string").alias("zfile_name"),
        F.lit(None).cast("timestamp").alias("zfile_mtime"),
        F.lit(None).cast("bigint").alias("zfile_size"),
        F.lit(None).cast("bigint").alias("zfile_compress_size"),
    )


def zip_members(files: DataFrame, member_pattern: str) -> DataFrame:
    """One row per archive member whose name matches; only directories of the
    archives are read."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with remote.open_input(row.path) as raw, zipfile.ZipFile(raw) as archive:
                    yield pd.DataFrame(
                        [
                            (
                                f"{row.path}|{info.filename}",
                                pd.Timestamp(*info.date_time, tz="UTC"),
                                info.file_size,
                                row.path.rsplit("/", 1)[-1],
                                row.file_mtime,
                                row.file_size,
                                info.compress_size,
                            )
                            for info in archive.infolist()
                            if not info.is_dir()
                        ],
                        columns=[f.name for f in schema],
                    )

    schema = T._parse_datatype_string(FILE_SCHEMA)
    width = files.sparkSession.sparkContext.defaultParallelism
    members = files.repartition(width, "path").mapInPandas(expand, schema)
    member = F.substring_index("path", "|", -1)
    return members.where(member.rlike(f"^(?:{member_pattern})"))


def describe(files: DataFrame, template: PathTemplate, creation_time: dt.datetime | None = None) -> DataFrame:
    """Add name, date parts, key and variables to rows that have a ``path``."""
    path = F.col("path")
    full_name = base_name(path)
    parts = template.parts(path)
    variables = template.variables(path)
    pairs = [x for k, v in variables.items() for x in (F.lit(k), v.cast("string"))]
    stamp = F.current_timestamp() if creation_time is None else F.lit(creation_time)
    return files.withColumns(
        {
            "full_file_name": full_name,
            "file_name": F.substring_index(full_name, "|", 1),
            "member_name": F.when(full_name.contains("|"), F.substring_index(path, "|", -1)),
            "is_zip": F.lit(template.is_zip),
            "file_type": F.lit(template.file_type),
            "d": template.key(path),
            **parts,
            "extract_vars": F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>"),
            "matched": template.matched(path),
            "creation_time": stamp.cast("timestamp"),
        }
    )


def within(inventory: DataFrame, after: str | None = None, before: str | None = None) -> DataFrame:
    """Keep files strictly between two keys; files without a key stay."""
    key = F.col("d").cast("bigint")
    keep = F.lit(True)
    if before is not None:
        keep = keep & (key < int(before))
    if after is not None:
        keep = keep & (key > int(after))
    return inventory.where(F.col("d").isNull() | keep)


def calendar(spark: SparkSession, start: str, end: str, file_type: str = "date") -> DataFrame:
    """Every key of an inclusive range: days, months or integers."""
    if file_type in ("date", "month"):
        tail, pattern, step = ("", "yyyyMMdd", "1 day") if file_type == "date" else ("01", "yyyyMM", "1 month")
        low, high = (dt.datetime.strptime(x + tail, "%Y%m%d").date() for x in (start, end))
        if low > high:
            raise ValueError(f"Range start {start} is after its end {end}")
        days = F.sequence(F.lit(low), F.lit(high), F.expr(f"interval {step}"))
        return spark.range(1).select(F.explode(days).alias("day")).select(F.date_format("day", pattern).alias("d"))
    if int(start) > int(end):
        raise ValueError(f"Range start {start} is after its end {end}")
    return spark.range(int(start), int(end) + 1).select(F.col("id").cast("string").alias("d"))


def in_range(inventory: DataFrame, start: str, end: str, file_type: str = "date") -> DataFrame:
    """Keep files whose key lies in an inclusive range."""
    if file_type not in ("date", "month"):
        if int(start) > int(end):
            raise ValueError(f"Range start {start} is after its end {end}")
        # Keys compare as numbers, so '007' is the same delta as '7'.
        return inventory.where(F.col("d").try_cast("bigint").between(int(start), int(end)))
    keys = calendar(inventory.sparkSession, start, end, file_type)
    return inventory.join(keys, "d", "left_semi")


def range_globs(template: PathTemplate, start: str, end: str) -> list[str]:
    """Globs of a range: one per day or month, so that listing skips other folders.

    Numbers can be padded to any width, so they are listed all and filtered after.
    """
    globs: dict[str, None] = {}
    if template.file_type in ("date", "month"):
        tail = "" if template.file_type == "date" else "01"
        day, last = (dt.datetime.strptime(x + tail, "%Y%m%d").date() for x in (start, end))
        while day <= last:
            values = {
                "YYYY": f"{day:%Y}", "MM": f"{day:%m}", "YY": f"{day:%y}",
                "YYYYMM": f"{day:%Y%m}", "YYMM": f"{day:%y%m}",
            }
            values |= {"DD": f"{day:%d}", "YYYYMMDD": f"{day:%Y%m%d}", "YYMMDD": f"{day:%y%m%d}"}
            globs[template.glob(values)] = None
            if template.file_type == "date":
                day += dt.timedelta(days=1)
            else:
                day = (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        return list(globs)
    return [template.glob()]


def discover(
    spark: SparkSession,
    template: PathTemplate,
    start: str | None = None,
    end: str | None = None,
    after: str | None = None,
    before: str | None = None,
    creation_time: dt.datetime | None = None,
) -> DataFrame:
    """Inventory of a template: everything, or an inclusive key range
    (``start``/``end``), optionally cut by exclusive bounds."""
    globs = [template.glob()] if start is None else range_globs(template, start, end)
    files = list_files(spark, globs)
    if template.is_zip:
        files = zip_members(files, template.regexes()[1])
    found = describe(files, template, creation_time)
    if start is not None:
        found = in_range(found, start, end, template.file_type)
    return within(found, after, before)


def discover_many(spark: SparkSession, templates: list[PathTemplate], **kwargs) -> DataFrame:
    """Union of several templates, in their order."""
    found = [
        discover(spark, t, **kwargs).withColumn("template_ord", F.lit(i)) for i, t in enumerate(templates)
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


def sample_files(inventory: DataFrame, n: int | None, seed: int = 0) -> DataFrame:
    """Random sample of ``n`` files; all of them if there are no more."""
    return inventory if n is None else inventory.orderBy(F.rand(seed)).limit(n)


INVENTORY_COLUMNS = ["path", "full_file_name", "file_name", "member_name", "is_zip", "file_type", "d", *PARTS]
