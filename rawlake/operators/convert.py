"""Text cells to typed values with strict CSV conversion rules.

Spark's casts accept more than the rules allow (``+1``, ``1d``, ``y``,
``2024-1-2``), so every cast stands behind a pattern check that raises.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.timeformat import to_spark_pattern

# Default tokens of the conversion.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]
TRUE_TOKENS = ["1", "True", "TRUE", "true"]
FALSE_TOKENS = ["0", "False", "FALSE", "false"]
TIMESTAMP_FORMATS = ["%Y%m%d"]
ISO8601 = "ISO8601"

_INT = r"^-?(\d+)$"
_HEX = r"^0[xX]([0-9a-fA-F]{1,16})$"
_DOUBLE = r"^[+-]?(inf|infinity|nan)$|^-?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_ISO_NAIVE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?)?$"
_ISO_ZONED = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2}|[+-]\d{2})$"


def _fail(text: Column, name: str, dtype: T.DataType) -> Column:
    message = F.concat(
        F.lit(f"Column '{name}': invalid value for {dtype.simpleString()}: '"), text, F.lit("'")
    )
    return F.raise_error(message).cast(dtype)


def _iso_text(text: Column) -> Column:
    """ISO timestamps with hours only, padded to what Spark reads."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}$"), F.concat(text, F.lit(":00"))).otherwise(text)


def _timestamp(text: Column, dtype: T.DataType, formats: list[str], tz: str | None) -> Column:
    zoned = isinstance(dtype, T.TimestampType)
    tries = []
    for fmt in formats:
        if fmt == ISO8601:
            iso = _iso_text(text)
            if zoned:
                tries.append(F.when(text.rlike(_ISO_ZONED), F.try_to_timestamp(iso)))
            if not zoned or tz:
                tries.append(F.when(text.rlike(_ISO_NAIVE), iso.try_cast("timestamp_ntz")))
        else:
            pattern = F.lit(to_spark_pattern(fmt))
            if "%z" in fmt:
                tries.append(F.try_to_timestamp(text, pattern))
            elif not zoned or tz:
                tries.append(F.try_to_timestamp(text, pattern).cast("timestamp_ntz"))
    if zoned:
        tries = [_localize(t, tz) if i in _naive_positions(formats, tz) else t for i, t in enumerate(tries)]
    return F.coalesce(*tries) if tries else F.lit(None).cast(dtype)


def _naive_positions(formats: list[str], tz: str | None) -> set[int]:
    at, naive = 0, set()
    for fmt in formats:
        if fmt == ISO8601:
            at += 1
            if tz:
                naive.add(at)
                at += 1
        elif "%z" in fmt:
            at += 1
        elif tz:
            naive.add(at)
            at += 1
    return naive


def _localize(naive: Column, tz: str) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), naive).cast("timestamp")


def convert(
    cell: Column,
    field: T.StructField,
    options: dict[str, Any] | None = None,
    strings_can_be_null: bool | None = None,
) -> Column:
    """Typed value of a text cell; a value that does not fit raises.

    ``options`` takes ``null_values``, ``true_values``, ``false_values``,
    ``strings_can_be_null``, ``timestamp_parsers`` and ``timezone`` (for zoned
    timestamps written without an offset).
    """
    text, absent = _cell(cell, options)
    if isinstance(field.dataType, T.StringType):
        return _text(text, absent, options, strings_can_be_null)
    bad = _fail(text, field.name, field.dataType)
    return F.when(~absent, _typed(text, field, options or {}, bad, Column.cast))


def attempt(cell: Column, field: T.StructField, options: dict[str, Any] | None = None) -> tuple[Column, Column | None]:
    """As ``convert``, but a value that does not fit is null, and whether that is so (None: it cannot be)."""
    text, absent = _cell(cell, options)
    if isinstance(field.dataType, T.StringType):
        return _text(text, absent, options, None), None
    nothing = F.lit(None).cast(field.dataType)
    value = F.when(~absent, _typed(text, field, options or {}, nothing, Column.try_cast))
    return value, ~absent & value.isNull()


def complaint(cell: Column, field: T.StructField) -> Column:
    """What is said of a cell that does not fit."""
    return F.concat(F.lit(f"invalid value for {field.dataType.simpleString()}: '"), F.coalesce(cell, F.lit("")), F.lit("'"))


def _cell(cell: Column, options: dict[str, Any] | None) -> tuple[Column, Column]:
    nulls = (options or {}).get("null_values", NULL_TOKENS)
    text = F.coalesce(cell, F.lit(""))
    return text, text.isin(*nulls) if nulls else F.lit(False)


def _text(text: Column, absent: Column, options: dict[str, Any] | None, nullable: bool | None) -> Column:
    if nullable is None:
        nullable = (options or {}).get("strings_can_be_null", False)
    return F.when(~absent, text) if nullable else text


def _typed(
    text: Column, field: T.StructField, options: dict[str, Any], bad: Column, cast: Callable[[Column, str], Column]
) -> Column:
    """Value of a text that stands for one, else ``bad``."""
    name, dtype = field.name, field.dataType
    if isinstance(dtype, T.LongType):
        trimmed = F.btrim(text, F.lit(" \t"))
        return (
            F.when(trimmed.rlike(_INT), cast(trimmed, "bigint"))
            .when(trimmed.rlike(_HEX), F.conv(F.substring(trimmed, 3, 16), 16, -10).cast("bigint"))
            .otherwise(bad)
        )
    if isinstance(dtype, T.DoubleType):
        trimmed = F.lower(F.btrim(text, F.lit(" \t")))
        return F.when(trimmed.rlike(_DOUBLE), cast(trimmed, "double")).otherwise(bad)
    if isinstance(dtype, T.BooleanType):
        trues = options.get("true_values", TRUE_TOKENS)
        falses = options.get("false_values", FALSE_TOKENS)
        return F.when(text.isin(*trues), True).when(text.isin(*falses), False).otherwise(bad)
    if isinstance(dtype, T.DateType):
        trimmed = F.btrim(text, F.lit(" \t"))
        return F.when(trimmed.rlike(_DATE), cast(trimmed, "date")).otherwise(bad)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        formats = options.get("timestamp_parsers") or TIMESTAMP_FORMATS
        return F.coalesce(_timestamp(text, dtype, formats, options.get("timezone")), bad)
    raise ValueError(f"Column '{name}': text cannot become {dtype.simpleString()}")
