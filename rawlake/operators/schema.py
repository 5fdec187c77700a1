"""Header checks, optional and ignored columns, output conformance."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.operators.columns import safe_cast
from rawlake.operators.convert import attempt, complaint, convert
from rawlake.types import OPTIONAL, REQUIRED, operation, output_schema


def header_findings(headers: DataFrame, schema: T.StructType) -> DataFrame:
    """Per file: sorted missing required columns and unknown extra ones.

    ``headers`` has ``path`` and ``names``.
    """
    required = F.array(*[F.lit(f.name) for f in schema if operation(f) == REQUIRED]).cast("array<string>")
    known = F.array(*[F.lit(f.name) for f in schema]).cast("array<string>")
    return headers.select(
        "path",
        F.sort_array(F.array_except(required, "names")).alias("missing"),
        F.sort_array(F.array_except("names", known)).alias("extra"),
    )


def check_headers(headers: DataFrame, schema: T.StructType, extra: str = "raise") -> None:
    """Raise for the first file with missing or, by default, extra columns."""
    findings = header_findings(headers, schema)
    bad = F.size("missing") > 0
    if extra == "raise":
        bad = bad | (F.size("extra") > 0)
    row = findings.where(bad).orderBy("path").first()
    if row is None:
        return
    if row["missing"]:
        raise ValueError(f"Required columns missing from '{row['path']}': {row['missing']}")
    raise ValueError(f"Columns of '{row['path']}' are not in the manifest: {row['extra']}")


def refused_headers(headers: DataFrame, schema: T.StructType, extra: str = "raise") -> DataFrame:
    """``path`` and ``message`` of the files that ``check_headers`` would raise for, and of those with repeated names."""
    repeated = F.size("names") > F.size(F.array_distinct("names"))
    findings = header_findings(headers, schema).join(headers.select("path", repeated.alias("repeated")), "path")

    def listed(label: str, names: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.array_join(names, ", "))

    message = F.when(F.size("missing") > 0, listed("required columns missing", "missing")).when(F.col("repeated"), "header repeats column names")
    if extra == "raise":
        message = message.when(F.size("extra") > 0, listed("columns that are not in the manifest", "extra"))
    return findings.select("path", message.alias("message")).where("message IS NOT NULL")


def required_columns(headers: DataFrame, schema: T.StructType) -> DataFrame:
    """Required columns no header cell answers, one row per file and column.

    ``headers`` has one row per file and column (``path``, ``name``).
    """
    names = F.array(*[F.lit(f.name) for f in schema if operation(f) == REQUIRED])
    wanted = headers.select("path").distinct().withColumn("name", F.explode(names))
    return wanted.join(headers, ["path", "name"], "left_anti")


def typed_columns(
    columns: list[str], schema: T.StructType, options: dict[str, Any] | None = None, sparse: bool = False
) -> list[Column]:
    """Output columns from text cells: typed, in manifest order.

    Optional columns the source lacks become typed nulls; with ``sparse``, so do
    null cells of optional columns, as rows of some files lack them; a null in a column
    declared not null raises.
    """
    out = []
    for field in output_schema(schema):
        if field.name in columns:
            cell = F.col(f"`{field.name}`")
            value = convert(cell, field, options)
            if sparse and operation(field) == OPTIONAL:
                value = F.when(cell.isNotNull(), value)
        elif operation(field) == OPTIONAL:
            value = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"Required columns missing from source: ['{field.name}']")
        out.append(_guarded(value, field))
    return out


Problem = tuple[str, Column, Column]  # of which column, whether a row has it, what it is


def tried_columns(
    columns: list[str], schema: T.StructType, options: dict[str, Any] | None = None, sparse: bool = False, have: T.StructType | None = None
) -> tuple[list[Column], list[Problem]]:
    """The columns of ``typed_columns``, or of ``native_columns`` if it is told what types they ``have``,
    with nulls where those raise, and the problems of such rows."""
    native, stored = have is not None, {f.name: f.dataType for f in have or []}
    values, problems = [], []
    for field in output_schema(schema):
        cell, present = F.col(f"`{field.name}`"), field.name in columns
        if not present and operation(field) != OPTIONAL and not native:
            raise ValueError(f"Required columns missing from source: ['{field.name}']")
        wrong = None
        if not present:
            value = F.lit(None).cast(field.dataType)
        elif native:
            value = cell.cast(field.dataType)
            if isinstance(stored.get(field.name), T.LongType) and isinstance(field.dataType, T.DoubleType):
                wrong = ~cell.between(-(2**53), 2**53)
        else:
            value, wrong = attempt(cell, field, options)
            if sparse and operation(field) == OPTIONAL:
                value = F.when(cell.isNotNull(), value)
                wrong = None if wrong is None else cell.isNotNull() & wrong
        if wrong is not None:
            problems.append((field.name, wrong, complaint(cell.cast("string"), field)))
        if not field.nullable:
            lacking = value.isNull() if wrong is None else value.isNull() & ~wrong
            problems.append((field.name, lacking, F.lit("is declared not null")))
        values.append(value.alias(field.name, metadata=field.metadata or {}))
    return values, problems


def native_columns(columns: list[str], schema: T.StructType, have: T.StructType | None = None) -> list[Column]:
    """Output columns from typed (Parquet) columns, of the types that ``have`` tells."""
    stored = {f.name: f.dataType for f in have or []}
    out = []
    for field in output_schema(schema):
        cell = F.col(f"`{field.name}`")
        if field.name not in columns:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(stored.get(field.name), T.LongType) and isinstance(field.dataType, T.DoubleType):
            value = safe_cast(cell, stored[field.name], field.dataType)
        else:
            value = cell.cast(field.dataType)
        out.append(_guarded(value, field))
    return out


def _guarded(value: Column, field: T.StructField) -> Column:
    if not field.nullable:
        message = F.raise_error(F.lit(f"Column '{field.name}' is declared not null")).cast(field.dataType)
        value = F.coalesce(value, message)
    return value.alias(field.name, metadata=field.metadata or {})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns, order and types of ``schema``; else an error."""
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        raise ValueError(f"Output lacks columns: {sorted(missing)}")
    for field in schema:
        if have[field.name] != field.dataType:
            raise ValueError(
                f"Output column '{field.name}' is {have[field.name].simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return df.select(*[_guarded(F.col(f"`{f.name}`"), f) for f in schema])
