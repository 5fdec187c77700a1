"""Raw files the example queries read, staged once per session and scale.

Every file set is written by Spark from a sample table, all rows of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.fixtures.staging import csv_line, stage_lines
from rawlake.session import work_path

_DONE: dict[tuple[str, str, str], str] = {}

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_TYPES = {
    "o_orderkey": "int64", "o_custkey": "int64", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "date32", "o_orderpriority": "string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def once(spark: SparkSession, sf: str, label: str, write: Callable[[str], object]) -> str:
    """Root folder of a staged file set."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _DONE:
        root = work_path(spark, f"raw-{label}")
        write(root)
        _DONE[key] = root
    return _DONE[key]


def text(name: str) -> Column:
    return F.col(name).cast("string")


def day(name: str = "o_orderdate") -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def order_cells(names: list[str] | None = None) -> list[Column]:
    return [day() if n == "o_orderdate" else text(n) for n in names or ORDER_COLUMNS]


def month_path(name: str = "orders", suffix: str = "csv", at: str = "o_orderdate") -> Column:
    return F.concat(
        F.date_format(at, "yyyy/MM/"), F.lit(f"{name}_"), F.date_format(at, "yyyyMM01"), F.lit(f".{suffix}")
    )


MONTHLY = "{YYYY}/{MM}/orders_{YYYYMMDD}.csv"


def monthly_orders(spark: SparkSession, sf: str) -> str:
    """Orders as one CSV per month, sorted by key: ``MONTHLY`` below the root."""

    def write(root: str) -> None:
        head = F.lit(",".join(ORDER_COLUMNS))
        stage_lines(table(spark, sf, "orders"), root, month_path(), csv_line(*order_cells()), [F.col("o_orderkey")], head)

    return once(spark, sf, "orders", write)


def manifest(types: dict[str, str], operations: dict[str, str] | None = None, not_null: tuple[str, ...] = ()) -> dict:
    operations = operations or {}
    return {
        "schema": {
            str(i): {
                "name": name, "type": kind, "nullable": name not in not_null,
                "column_operation": operations.get(name, "source_required"),
            }
            for i, (name, kind) in enumerate(types.items(), start=1)
        }
    }


def config(
    raw_files: list[str],
    types: dict[str, str],
    input: dict | None = None,
    metadata: dict | None = None,
    operations: dict[str, str] | None = None,
    aggregate: bool = False,
    basedir: str = "",
    file_template: str = "",
    extract_vars: dict | None = None,
    not_null: tuple[str, ...] = (),
) -> dict:
    return {
        "input": {"file_type": "date", **(input or {})},
        "output": {
            "basedir": basedir,
            "file_template": file_template,
            "metadata": {"standard_metadata": False} if metadata is None else metadata,
        },
        "manifest": manifest(types, operations, not_null),
        "tables": {"t": {"raw_files": raw_files, "aggregate": aggregate}},
        "extract_vars": extract_vars,
    }
