"""Column operators: constants, copies, replacement, safe casts, predicates."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.types import spark_type

Type = T.DataType | str


def _type(dtype: Type) -> T.DataType:
    return spark_type(dtype) if isinstance(dtype, str) else dtype


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double: ``1``, ``0.5``, ``1e+20``.

    Plain notation from 1e-6 up to (not including) 1e10, exponents otherwise.
    """
    java = value.cast("string")
    sign = F.when(java.startswith("-"), "-").otherwise("")
    magnitude = F.abs(value)
    # Java already prints the shortest digits; only the notation differs.
    mantissa = F.regexp_extract(java, r"^-?([0-9]+\.[0-9]+)", 1)
    exponent = F.coalesce(F.nullif(F.regexp_extract(java, r"E(-?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    whole = F.substring_index(mantissa, ".", 1)
    fraction = F.regexp_replace(F.substring_index(mantissa, ".", -1), "0+$", "")
    raw_digits = F.concat(whole, fraction)
    digits = F.regexp_replace(F.regexp_replace(raw_digits, "^0+", ""), "0+$", "")
    # Position of the decimal point counted from the first significant digit.
    leading_zeros = F.length(raw_digits) - F.length(F.regexp_replace(raw_digits, "^0+", ""))
    point = F.length(whole) + exponent - leading_zeros
    n = F.length(digits)
    fixed = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n)))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n)))
    )
    power = point - 1
    rest = F.substring(digits, F.lit(2), n)
    scientific = F.concat(
        F.substring(digits, 1, 1),
        F.when(n > 1, F.concat(F.lit("."), rest)).otherwise(""),
        F.when(power < 0, "e-").otherwise("e+"),
        F.abs(power).cast("string"),
    )
    plain = (power >= -6) & (power < 10)
    return (
        F.when(F.isnan(value), "nan")
        .when(magnitude == float("inf"), F.concat(sign, F.lit("inf")))
        .when(magnitude == 0, F.concat(sign, F.lit("0")))
        .otherwise(F.concat(sign, F.when(plain, fixed).otherwise(scientific)))
    )


def safe_cast(value: Column, source: Type, target: Type) -> Column:
    """Cast that raises instead of losing anything: overflow, fractions,
    text that is no value of the type."""
    source, target = _type(source), _type(target)
    if source == target:
        return value
    floating = isinstance(source, (T.DoubleType, T.FloatType))
    bad = F.raise_error(
        F.concat(F.lit(f"Cast to {target.simpleString()} would change "), value.cast("string"))
    ).cast(target)
    if floating and isinstance(target, T.IntegralType):
        fits = (value >= -(2.0**63)) & (value < 2.0**63)
        exact = F.when(fits & (value == F.floor(value)), value.cast(target))
        return F.when(value.isNull(), None).otherwise(F.coalesce(exact, bad))
    if isinstance(source, T.LongType) and isinstance(target, T.DoubleType):
        limit = 2**53
        return F.when(value.isNull() | value.between(-limit, limit), value.cast(target)).otherwise(bad)
    if isinstance(target, T.StringType):
        if floating:
            return number_text(value.cast("double"))
        if isinstance(source, T.BooleanType):
            return value.cast("string")
        if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            # Timestamps print all six digits of their unit.
            suffix = "'Z'" if isinstance(source, T.TimestampType) else ""
            return F.date_format(value, f"yyyy-MM-dd HH:mm:ss.SSSSSS{suffix}")
        return value.cast("string")
    if isinstance(source, T.StringType):
        if isinstance(target, T.LongType):
            return F.when(value.isNull() | value.rlike(r"^-?\d+$"), value.cast(target)).otherwise(bad)
        if isinstance(target, T.DoubleType):
            number = r"(?i)^[+-]?(inf|infinity|nan)$|^-?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"
            return F.when(value.isNull() | value.rlike(number), value.cast(target)).otherwise(bad)
        if isinstance(target, T.BooleanType):
            low = F.lower(value)
            return F.when(value.isNull(), None).when(low.isin("1", "true"), True).when(
                low.isin("0", "false"), False
            ).otherwise(bad)
        if isinstance(target, T.DateType):
            return F.when(value.isNull() | value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value.cast(target)).otherwise(bad)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(target, T.DateType):
        midnight = value == F.date_trunc("day", value)
        return F.when(value.isNull() | midnight, value.cast(target)).otherwise(bad)
    if isinstance(source, T.BooleanType) and isinstance(target, (T.LongType, T.DoubleType)):
        return value.cast("int").cast(target)
    if isinstance(target, T.BooleanType) and isinstance(source, T.NumericType):
        return value != 0
    if isinstance(source, T.IntegralType) and isinstance(target, (T.TimestampNTZType, T.TimestampType)):
        instant = F.timestamp_micros(value.cast("bigint"))
        return instant.cast(target)
    if isinstance(source, T.TimestampNTZType) and isinstance(target, T.TimestampType):
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), value).cast(target)
    return value.cast(target)


def append_constants(df: DataFrame, constants: dict[str, Any], types: dict[str, Type] | None = None) -> DataFrame:
    types = types or {}
    columns = {}
    for name, value in constants.items():
        column = F.lit(value)
        columns[name] = column.cast(_type(types[name])) if name in types else column
    return df.withColumns(columns)


def _source_type(df: DataFrame, value: Column) -> T.DataType:
    return df.select(value.alias("v")).schema["v"].dataType


def append_column(df: DataFrame, name: str, value: Column | str, dtype: Type | None = None) -> DataFrame:
    if name in df.columns:
        raise ValueError(f"Column '{name}' exists already")
    column = F.col(f"`{value}`") if isinstance(value, str) else value
    if dtype is not None:
        column = safe_cast(column, _source_type(df, column), dtype)
    return df.withColumn(name, column)


def replace_column(df: DataFrame, name: str, value: Column, dtype: Type | None = None) -> DataFrame:
    """Replace a column where it stands."""
    if name not in df.columns:
        raise ValueError(f"Column '{name}' does not exist")
    if dtype is not None:
        value = safe_cast(value, _source_type(df, value), dtype)
    return df.withColumn(name, value)


def cast_column(df: DataFrame, name: str, dtype: Type) -> DataFrame:
    return replace_column(df, name, F.col(f"`{name}`"), dtype)


_COMPARE = {
    "==": lambda c, v: c == v,
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
    "not in": lambda c, v: ~c.isin(*v),
}


def condition(filters: list) -> Column:
    """``[(column, op, value), ...]`` (all must hold) or a list of such lists
    (any may hold) as one predicate of plain comparisons."""
    groups = filters if isinstance(filters[0][0], (list, tuple)) else [filters]
    anyof = F.lit(False)
    for group in groups:
        allof = F.lit(True)
        for name, op, value in group:
            allof = allof & _COMPARE[op](F.col(f"`{name}`"), value)
        anyof = allof if len(groups) == 1 else anyof | allof
    return anyof


def apply_filters(df: DataFrame, filters: list) -> DataFrame:
    """Keep rows for which the filters hold; scans take plain predicates over."""
    return df.where(condition(filters)) if filters else df
