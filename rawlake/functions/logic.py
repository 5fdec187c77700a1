"""Comparison, three-valued logic, nulls, choices and conversion."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import function, is_float


def _compare(op, nan_answer: bool):
    """Comparison where NaN is unordered, as Spark holds NaN equal to itself
    and above everything."""

    def builder(value: Column, dtype: T.DataType, other: Any) -> Column:
        result = op(value, F.lit(other))
        if isinstance(other, float) and math.isnan(other):
            return F.when(value.isNotNull(), F.lit(nan_answer))
        if is_float(dtype):
            result = F.when(F.isnan(value), F.lit(nan_answer)).otherwise(result)
        return result

    return builder


function("equal")(_compare(lambda a, b: a == b, False))
function("not_equal")(_compare(lambda a, b: a != b, True))
function("less")(_compare(lambda a, b: a < b, False))
function("less_equal")(_compare(lambda a, b: a <= b, False))
function("greater")(_compare(lambda a, b: a > b, False))
function("greater_equal")(_compare(lambda a, b: a >= b, False))


def _flag(other: bool | None) -> Column:
    return F.lit(other).cast("boolean")


function("and_kleene")(lambda value, dtype, other: value & _flag(other))
function("or_kleene")(lambda value, dtype, other: value | _flag(other))
function("and_not_kleene")(lambda value, dtype, other: value & ~_flag(other))


def _strict(op):
    """Any null makes the result null."""
    return lambda value, dtype, other: F.when(value.isNull() | _flag(other).isNull(), None).otherwise(
        op(value, _flag(other))
    )


function("and", "and_")(_strict(lambda a, b: a & b))
function("or", "or_")(_strict(lambda a, b: a | b))
function("and_not")(_strict(lambda a, b: a & ~b))
function("xor")(_strict(lambda a, b: a != b))
function("invert")(lambda value, dtype: ~value)


@function("is_null")
def is_null(value: Column, dtype: T.DataType, nan_is_null: bool = False) -> Column:
    return value.isNull() | F.isnan(value) if nan_is_null and is_float(dtype) else value.isNull()


function("is_valid")(lambda value, dtype: value.isNotNull())
function("true_unless_null")(lambda value, dtype: F.when(value.isNotNull(), True))


def _float_test(test, otherwise: bool):
    def builder(value: Column, dtype: T.DataType) -> Column:
        return F.when(value.isNotNull(), test(value) if is_float(dtype) else F.lit(otherwise))

    return builder


function("is_nan")(_float_test(F.isnan, False))
function("is_inf")(_float_test(lambda v: F.abs(v) == float("inf"), False))
function("is_finite")(_float_test(lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")), True))


@function("coalesce", "fill_null")
def coalesce(value: Column, dtype: T.DataType, *others: Any) -> Column:
    return F.coalesce(value, *[F.lit(o) for o in others])


@function("if_else")
def if_else(value: Column, dtype: T.DataType, left: Any, right: Any) -> Column:
    return F.when(value, F.lit(left)).when(~value, F.lit(right))


@function("choose")
def choose(value: Column, dtype: T.DataType, *choices: Any) -> Column:
    inside = F.element_at(F.array(*[F.lit(c) for c in choices]), (value + 1).cast("int"))
    bad = F.raise_error(F.concat(F.lit("choose: index out of range: "), value.cast("string")))
    return F.when(value.isNull(), None).when((value >= 0) & (value < len(choices)), inside).otherwise(bad)


@function("case_when")
def case_when(value: Column, dtype: T.StructType, *cases: Any) -> Column:
    """First case whose condition (a field of the struct) holds."""
    result = F.lit(cases[len(dtype)]) if len(cases) > len(dtype) else F.lit(None)
    for name, case in reversed(list(zip(dtype.names, cases))):
        result = F.when(value[name], F.lit(case)).otherwise(result)
    return result


@function("is_in")
def is_in(value: Column, dtype: T.DataType, value_set: list, skip_nulls: bool = False) -> Column:
    present = [v for v in value_set if v is not None]
    found = F.coalesce(value.isin(*present), F.lit(False)) if present else F.lit(False)
    return found | value.isNull() if None in value_set and not skip_nulls else found


@function("index_in")
def index_in(value: Column, dtype: T.DataType, value_set: list, skip_nulls: bool = False) -> Column:
    result = F.lit(None).cast("int")
    for at, item in reversed(list(enumerate(value_set))):
        if item is None:
            result = result if skip_nulls else F.when(value.isNull(), at).otherwise(result)
        else:
            result = F.when(value == F.lit(item), at).otherwise(result)
    return result


@function("cast")
def cast(value: Column, dtype: T.DataType, target_type: str, safe: bool = True) -> Column:
    from rawlake.operators.columns import safe_cast
    from rawlake.types import spark_type

    target = spark_type(target_type)
    return safe_cast(value, dtype, target) if safe else value.cast(target)
