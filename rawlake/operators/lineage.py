"""Lineage columns: where a row came from and when it was known.

What the path says is computed on the row's path column; file facts come from
the scan itself. Only a time read out of file headers needs a per-file table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import apply_functions
from rawlake.functions.timeformat import to_spark_pattern
from rawlake.operators.columns import safe_cast
from rawlake.session import bounded_broadcast, materialize
from rawlake.sources import heads
from rawlake.sources.inventory import base_name
from rawlake.sources.templates import PathTemplate
from rawlake.types import parse_type

KNOWLEDGE_SOURCES = (None, "file_name", "file_mtime", "csv_header")

# Date layouts tried for header times when the job names none.
HEADER_FORMATS = [
    "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d",
    "%Y%m%d%H%M%S", "%Y%m%dT%H%M%S", "%Y%m%d", "%d-%b-%Y %H:%M:%S", "%d-%b-%Y",
]


def file_facts() -> dict[str, Column]:
    """Fields a ``metadata.<field>`` source may name."""
    path = F.col("_path")
    member = F.substring_index(path, "|", -1)
    return {
        "file_path": path,
        "file_name": F.when(path.contains("|"), member).otherwise(base_name(path)),
        "file_mtime": F.col("_mtime"),
        "file_size": F.col("_size"),
        "zfile_name": F.col("_zname"),
        "zfile_mtime": F.col("_zmtime"),
        "zfile_size": F.col("_zsize"),
        "zfile_compress_size": F.col("_zcsize"),
    }


def name_time(parts: dict[str, Column], tz: str = "UTC") -> Column:
    """Knowledge time from date parts of the path, as an instant."""

    def number(part: str, default: int) -> Column:
        return F.coalesce(parts[part].cast("int"), F.lit(default))

    micros = F.coalesce(parts["us"].cast("int"), parts["ms"].cast("int") * 1000, F.lit(0))
    seconds = number("ss", 0).cast("decimal(8,6)") + (micros.cast("decimal(12,6)") / 1000000)
    local = F.make_timestamp_ntz(
        parts["YYYY"].cast("int"), parts["MM"].cast("int"), number("DD", 1),
        number("hh", 0), number("mm", 0), seconds.cast("decimal(8,6)"),
    )
    missing = F.raise_error(F.lit("A path without a year gives no knowledge time")).cast("timestamp_ntz")
    return to_instant(F.when(parts["YYYY"].isNotNull(), local).otherwise(missing), tz)


def to_instant(local: Column, tz: str) -> Column:
    """Instant of a wall-clock time in ``tz`` (session zone is UTC)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local).cast("timestamp")


def header_times(
    inventory: DataFrame,
    pattern: str,
    line: int = 1,
    tz: str = "UTC",
    fmt: str | list[str] | None = None,
    encoding: str = "utf-8",
) -> DataFrame:
    """Knowledge time per file (``_path``, ``_ktime``) from a line of its head."""
    peeked = heads.peek(inventory, has_header=False, encoding=encoding, keep=line)
    target = F.trim(F.get("head", F.lit(line - 1)))
    found = F.regexp_extract(target, java_regex(pattern), 1)
    formats = [fmt] if isinstance(fmt, str) else (fmt or HEADER_FORMATS)
    tries = []
    for f in formats:
        parsed = F.try_to_timestamp(found, F.lit(to_spark_pattern(f)))
        tries.append(parsed if "%z" in f else to_instant(parsed.cast("timestamp_ntz"), tz))

    def fail(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(text), F.col("path"))).cast("timestamp")

    value = (
        F.when(target.isNull(), fail(f"File has fewer than {line} lines: "))
        .when(~target.rlike(java_regex(pattern)), fail(f"Header pattern not found in line {line} of "))
        .otherwise(F.coalesce(*tries, fail("Header time cannot be read in ")))
    )
    return peeked.select(F.col("path").alias("_path"), value.alias("_ktime"))


def java_regex(pattern: str) -> str:
    """Python's named groups in the JVM's spelling."""
    return pattern.replace("(?P<", "(?<")


def path_columns(
    template: PathTemplate,
    metadata: dict[str, Any] | None,
    inventory: DataFrame,
    encoding: str = "utf-8",
    output_key: Column | None = None,
) -> Callable[[DataFrame], DataFrame]:
    """A function that adds to any frame with ``_path`` all that the file says
    about its rows: name, variables, knowledge time, output key.

    Numbered scans run it on their table of splits, so that patterns are
    matched once per split and not once per row.
    """
    metadata = metadata or {}
    standard = metadata.get("standard_metadata", True)
    knowledge = metadata.get("knowledge_time") or {}
    source, tz = knowledge.get("from"), knowledge.get("tz", "UTC")
    if source not in KNOWLEDGE_SOURCES:
        raise ValueError(f"Unknown knowledge_time source '{source}'")
    times = None
    if standard and source == "csv_header":
        if not knowledge.get("header_pattern"):
            raise ValueError("knowledge_time from csv_header needs header_pattern")
        found = header_times(
            inventory, knowledge["header_pattern"], knowledge.get("header_line") or 1, tz,
            knowledge.get("format"), encoding,
        )
        times = materialize(found, "header-times")

    def decorate(df: DataFrame) -> DataFrame:
        path = F.col("_path")
        columns = {f"_v_{name}": value for name, value in template.variables(path).items()}
        if standard:
            columns["_source_file"] = base_name(path)
            if source in (None, "file_name"):
                columns["_ktime"] = name_time(template.parts(path), tz)
        if output_key is not None:
            columns["_out_key"] = output_key
        df = df.withColumns(columns) if columns else df
        if times is not None:
            df = df.join(bounded_broadcast(times)[0], "_path", "left")
        return df

    return decorate


def add_lineage(df: DataFrame, metadata: dict[str, Any] | None, creation_time: dt.datetime) -> DataFrame:
    """Append additional columns, then the standard ones.

    ``df`` carries file tags, the columns of ``path_columns`` and, if standard
    columns are wanted, ``_index``.
    """
    metadata = metadata or {}
    waiting: dict[str, dict[str, Any]] = {}
    for name, spec in (metadata.get("additional_metadata") or {}).items():
        if spec["source"].partition(".")[2].split(".")[0] in waiting:
            df, waiting = _additional(df, waiting), {}
        waiting[name] = spec
    df = _additional(df, waiting)
    if not metadata.get("standard_metadata", True):
        return df
    from_mtime = (metadata.get("knowledge_time") or {}).get("from") == "file_mtime"
    known = F.col("_mtime") if from_mtime else F.col("_ktime")
    return df.withColumns(
        {
            "_source_file_mtime": F.col("_mtime"),
            "_creation_time": F.lit(creation_time).cast("timestamp"),
            "_knowledge_time": known,
            "_knowledge_date": F.to_date(known),
        }
    )


def _additional(df: DataFrame, specs: dict[str, dict[str, Any]]) -> DataFrame:
    """Add columns none of which is the source of another."""
    if not specs:
        return df
    df = df.withColumns({name: _source(spec) for name, spec in specs.items()})
    calls = [
        (name, spec["func"], name, tuple(spec.get("func_args") or []), spec.get("func_kwargs") or {})
        for name, spec in specs.items() if spec.get("func")
    ]
    df = apply_functions(df, calls)
    casts = {}
    for name, spec in specs.items():
        have = df.schema[name].dataType
        target, _ = parse_type(spec["dtype"])
        plain = isinstance(have, T.NullType) or have == target
        casts[name] = F.col(f"`{name}`").cast(target) if plain else safe_cast(F.col(f"`{name}`"), have, target)
    return df.withColumns(casts)


def _source(spec: dict[str, Any]) -> Column:
    kind, _, key = spec["source"].partition(".")
    key = key.split(".")[0]
    if kind == "extract_vars":
        return F.col(f"`_v_{key}`")
    if kind == "metadata":
        return file_facts()[key]
    if kind == "column":
        return F.col(f"`{key}`")
    raise ValueError(f"Unknown source: {spec['source']}")
