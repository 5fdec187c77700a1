"""Named column functions: ``name -> builder(value, dtype, *args, **kwargs)``.

Names and results follow the columnar compute functions job configs refer to;
results keep one value per row. Where such a function would wrap around on
integer overflow, the builder here raises instead.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[..., Column]

REGISTRY: dict[str, Builder] = {}


def function(*names: str) -> Callable[[Builder], Builder]:
    """Register a builder under its names; also the way to add one's own."""

    def add(builder: Builder) -> Builder:
        for name in names:
            REGISTRY[name] = builder
        return builder

    return add


def fail(message: str, dtype: T.DataType | str) -> Column:
    return F.raise_error(F.lit(message)).cast(dtype)


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_int(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType)


def build(name: str, value: Column, dtype: T.DataType, *args: Any, **kwargs: Any) -> Column:
    """Column for a registered function of ``value``."""
    _load()
    if name not in REGISTRY:
        raise KeyError(f"Unknown function '{name}'")
    return REGISTRY[name](value, dtype, *args, **kwargs)


def apply_function(
    df: DataFrame,
    column: str,
    name: str,
    *args: Any,
    into: str | None = None,
    row_order: tuple[str, str] | None = None,
    **kwargs: Any,
) -> DataFrame:
    """Replace ``column`` (or fill ``into``) by a function of it.

    Order-dependent functions need ``row_order``: the columns that name the file
    and the row number in it. They default to the ones of a scan.
    """
    call = (column, name, into or column, args, kwargs)
    return apply_functions(df, [call], row_order)


def apply_functions(
    df: DataFrame, calls: list[tuple[str, str, str, tuple, dict[str, Any]]], row_order: tuple[str, str] | None = None
) -> DataFrame:
    """Apply ``(column, name, into, args, kwargs)`` in turn; neighbouring
    order-dependent functions share their passes over the rows."""
    from rawlake.functions import ordered

    _load()
    waiting: list[ordered.Call] = []
    for column, name, into, args, kwargs in calls:
        if ordered.known(name):
            keys = row_order or _order_columns(df, name)
            waiting.append(ordered.Call(name, column, into, tuple(args), kwargs))
            continue
        if waiting:
            df, waiting = ordered.apply(df, waiting, *keys), []
        value = F.col(f"`{column}`")
        df = df.withColumn(into, build(name, value, df.schema[column].dataType, *args, **kwargs))
    return ordered.apply(df, waiting, *keys) if waiting else df


def _order_columns(df: DataFrame, name: str) -> tuple[str, str]:
    if "_index" not in df.columns:
        raise ValueError(f"Function '{name}' depends on row order and needs the _index column")
    return ("_fp" if "_fp" in df.columns else "_source_file"), "_index"


def names() -> list[str]:
    from rawlake.functions import ordered

    _load()
    return sorted(set(REGISTRY) | ordered.names())


def _load() -> None:
    from rawlake.functions import logic, mathematics, nested, search, strings, temporal  # noqa: F401
