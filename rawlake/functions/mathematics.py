"""Arithmetic, rounding, logarithms, trigonometry and bits."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import fail, function, is_float, is_int

INF, NAN = float("inf"), float("nan")
EXACT = 2.0**52  # doubles from here on are whole numbers


def _floating(dtype: T.DataType, *args: Any) -> bool:
    return is_float(dtype) or any(isinstance(a, float) for a in args)


@function("add", "add_checked")
def add(value: Column, dtype: T.DataType, other: Any) -> Column:
    return value + F.lit(other)


@function("subtract", "subtract_checked")
def subtract(value: Column, dtype: T.DataType, other: Any) -> Column:
    return value - F.lit(other)


@function("multiply", "multiply_checked")
def multiply(value: Column, dtype: T.DataType, other: Any) -> Column:
    return value * F.lit(other)


@function("divide")
def divide(value: Column, dtype: T.DataType, other: Any) -> Column:
    if not _floating(dtype, other):
        return divide_checked(value, dtype, other)
    other, number = float(other), value.cast("double")
    if other != 0:
        return number / F.lit(other)
    above, below = (INF, -INF) if math.copysign(1, other) > 0 else (-INF, INF)
    return F.when(F.isnan(number) | (number == 0), NAN).when(number > 0, above).when(number < 0, below)


@function("divide_checked")
def divide_checked(value: Column, dtype: T.DataType, other: Any) -> Column:
    if _floating(dtype, other):
        return value.cast("double") / F.lit(float(other))
    # Whole quotient, cut towards zero.
    number, other = value.cast("bigint"), F.lit(int(other)).cast("bigint")
    return F.call_function("div", number, other)


@function("abs", "abs_checked")
def absolute(value: Column, dtype: T.DataType) -> Column:
    return F.abs(value)


@function("negate", "negate_checked")
def negate(value: Column, dtype: T.DataType) -> Column:
    return -value


@function("sign")
def sign(value: Column, dtype: T.DataType) -> Column:
    result = F.signum(value)
    return result.cast("bigint") if is_int(dtype) else result


@function("power", "power_checked")
def power(value: Column, dtype: T.DataType, exponent: Any) -> Column:
    if _floating(dtype, exponent):
        return F.pow(value.cast("double"), F.lit(float(exponent)))
    if exponent < 0:
        return fail("integers to negative integer powers are not allowed", "bigint")
    # Exact, by repeated squaring; overflow raises.
    result, square, left = None, value.cast("bigint"), exponent
    while left:
        if left % 2:
            result = square if result is None else result * square
        left //= 2
        square = square * square if left else square
    return F.when(value.isNotNull(), F.lit(1).cast("bigint")) if result is None else result


def _real(fn):
    return lambda value, dtype: fn(value.cast("double"))


def _checked(fn, bad, message: str):
    """Raise where ``bad`` holds instead of answering NaN or infinity."""

    def builder(value: Column, dtype: T.DataType) -> Column:
        number = value.cast("double")
        return F.when(bad(number), fail(message, "double")).otherwise(fn(number))

    return builder


for _name, _fn in {
    "exp": F.exp, "expm1": F.expm1, "sqrt": F.sqrt, "sin": F.sin, "cos": F.cos, "tan": F.tan,
    "asin": F.asin, "acos": F.acos, "sinh": F.sinh, "cosh": F.cosh, "tanh": F.tanh,
    "asinh": F.asinh, "acosh": F.acosh, "atan": F.atan,
}.items():
    function(_name)(_real(_fn))


def _atanh(number: Column) -> Column:
    return F.when(number == 1, INF).when(number == -1, -INF).otherwise(F.atanh(number))


function("atanh")(_real(_atanh))

function("sqrt_checked")(_checked(F.sqrt, lambda x: x < 0, "square root of negative number"))
for _name, _fn in {"sin_checked": F.sin, "cos_checked": F.cos, "tan_checked": F.tan}.items():
    function(_name)(_checked(_fn, lambda x: F.abs(x) == INF, "domain error"))
for _name, _fn in {"asin_checked": F.asin, "acos_checked": F.acos}.items():
    function(_name)(_checked(_fn, lambda x: ~F.isnan(x) & (F.abs(x) > 1), "domain error"))
function("acosh_checked")(_checked(F.acosh, lambda x: x < 1, "domain error"))
function("atanh_checked")(_checked(F.atanh, lambda x: ~F.isnan(x) & (F.abs(x) >= 1), "domain error"))


@function("atan2")
def atan2(value: Column, dtype: T.DataType, other: Any) -> Column:
    return F.atan2(value.cast("double"), F.lit(float(other)))


def _log(fn, pole: float = 0.0):
    """Logarithm with -inf at the pole and NaN below it, where Spark has null."""
    return lambda x: F.when(x == pole, -INF).when(x < pole, NAN).otherwise(fn(x))


for _name, _fn, _pole in [
    ("ln", F.ln, 0.0), ("log10", F.log10, 0.0), ("log2", F.log2, 0.0), ("log1p", F.log1p, -1.0),
]:
    function(_name)(_real(_log(_fn, _pole)))
    function(f"{_name}_checked")(_checked(_fn, lambda x, p=_pole: x <= p, f"logarithm of {_pole:g} or less"))


@function("logb")
def logb(value: Column, dtype: T.DataType, base: float) -> Column:
    number = value.cast("double")
    return _log(lambda x: F.ln(x) / F.lit(math.log(base)))(number)


@function("logb_checked")
def logb_checked(value: Column, dtype: T.DataType, base: float) -> Column:
    number = value.cast("double")
    return F.when(number <= 0, fail("logarithm of zero or less", "double")).otherwise(logb(value, dtype, base))


# -- rounding ------------------------------------------------------------------


def _floor(number: Column) -> Column:
    """floor that stays a double and holds for any magnitude."""
    return F.when((F.abs(number) >= EXACT) | (number == 0), number).otherwise(F.floor(number).cast("double"))


def _ceil(number: Column) -> Column:
    # Through floor, so that what rounds up to zero keeps its sign.
    return -_floor(-number)


@function("floor")
def floor(value: Column, dtype: T.DataType) -> Column:
    return value.cast("double") if is_int(dtype) else _floor(value)


@function("ceil")
def ceil(value: Column, dtype: T.DataType) -> Column:
    return value.cast("double") if is_int(dtype) else _ceil(value)


@function("trunc")
def trunc(value: Column, dtype: T.DataType) -> Column:
    return value.cast("double") if is_int(dtype) else F.when(value < 0, _ceil(value)).otherwise(_floor(value))


def _round_whole(number: Column, mode: str) -> Column:
    """Round a double to a whole one under any of the rounding modes."""
    low, high = _floor(number), _ceil(number)
    nearest = F.rint(number)
    tie = (number - low) == 0.5
    positive = number >= 0
    even_low = F.pmod(low, F.lit(2.0)) == 0
    choices = {
        "down": low,
        "up": high,
        "towards_zero": F.when(positive, low).otherwise(high),
        "towards_infinity": F.when(positive, high).otherwise(low),
        "half_to_even": nearest,
        "half_down": F.when(tie, low).otherwise(nearest),
        "half_up": F.when(tie, high).otherwise(nearest),
        "half_towards_zero": F.when(tie, F.when(positive, low).otherwise(high)).otherwise(nearest),
        "half_towards_infinity": F.when(tie, F.when(positive, high).otherwise(low)).otherwise(nearest),
        "half_to_odd": F.when(tie, F.when(even_low, high).otherwise(low)).otherwise(nearest),
    }
    if mode not in choices:
        raise ValueError(f"Unknown round_mode '{mode}'")
    return choices[mode]


def _round_int(number: Column, multiple: int, mode: str) -> Column:
    """Round a whole number to a multiple, in integers."""
    step = F.lit(multiple).cast("bigint")
    low = number - F.pmod(number, step)
    rest = number - low
    high = F.when(rest == 0, low).otherwise(low + step)
    near = F.when(rest * 2 < step, low).otherwise(high)
    tie, positive = rest * 2 == step, number >= 0
    even_low = F.pmod(F.call_function("div", low, step), F.lit(2)) == 0
    choices = {
        "down": low,
        "up": high,
        "towards_zero": F.when(positive, low).otherwise(high),
        "towards_infinity": F.when(positive, high).otherwise(low),
        "half_to_even": F.when(tie & even_low, low).otherwise(near),
        "half_down": F.when(tie, low).otherwise(near),
        "half_up": near,
        "half_towards_zero": F.when(tie & positive, low).otherwise(near),
        "half_towards_infinity": F.when(tie & ~positive, low).otherwise(near),
        "half_to_odd": F.when(tie & ~even_low, low).otherwise(near),
    }
    if mode not in choices:
        raise ValueError(f"Unknown round_mode '{mode}'")
    return choices[mode]


@function("round", "round_binary")
def round_digits(value: Column, dtype: T.DataType, ndigits: int = 0, round_mode: str = "half_to_even") -> Column:
    if is_int(dtype):
        return value if ndigits >= 0 else _round_int(value.cast("bigint"), 10**-ndigits, round_mode)
    scale = F.lit(float(10 ** abs(ndigits)))
    scaled = value * scale if ndigits >= 0 else value / scale
    whole = _round_whole(scaled, round_mode)
    result = whole / scale if ndigits >= 0 else whole * scale
    # Already whole at this scale, or out of range: the value stays.
    stays = (scaled == _floor(scaled)) | F.isnan(result) | (F.abs(result) == INF)
    return F.when(stays, value).otherwise(result)


@function("round_to_multiple")
def round_to_multiple(
    value: Column, dtype: T.DataType, multiple: float = 1.0, round_mode: str = "half_to_even"
) -> Column:
    if is_int(dtype) and float(multiple).is_integer():
        return _round_int(value.cast("bigint"), int(multiple), round_mode)
    number, step = value.cast("double"), F.lit(abs(float(multiple)))
    scaled = number / step
    result = _round_whole(scaled, round_mode) * step
    stays = (scaled == _floor(scaled)) | F.isnan(result) | (F.abs(result) == INF)
    return F.when(stays, number).otherwise(result)


# -- bits and extremes -----------------------------------------------------------


@function("bit_wise_and")
def bit_and(value: Column, dtype: T.DataType, other: int) -> Column:
    return value.cast("bigint").bitwiseAND(F.lit(other).cast("bigint"))


@function("bit_wise_or")
def bit_or(value: Column, dtype: T.DataType, other: int) -> Column:
    return value.cast("bigint").bitwiseOR(F.lit(other).cast("bigint"))


@function("bit_wise_xor")
def bit_xor(value: Column, dtype: T.DataType, other: int) -> Column:
    return value.cast("bigint").bitwiseXOR(F.lit(other).cast("bigint"))


@function("bit_wise_not")
def bit_not(value: Column, dtype: T.DataType) -> Column:
    return F.bitwise_not(value.cast("bigint"))


def _shift(fn, checked: bool):
    def builder(value: Column, dtype: T.DataType, bits: int) -> Column:
        number = value.cast("bigint")
        if 0 <= bits < 64:
            return fn(number, bits)
        return fail("shift amount must be >= 0 and less than precision of type", "bigint") if checked else number

    return builder


for _name, _fn in {"shift_left": F.shiftleft, "shift_right": F.shiftright}.items():
    function(_name)(_shift(_fn, False))
    function(f"{_name}_checked")(_shift(_fn, True))


def _extreme(fn):
    def builder(value: Column, dtype: T.DataType, *others: Any, skip_nulls: bool = True) -> Column:
        candidates = [value, *[F.lit(o) for o in others]]
        if _floating(dtype, *others):
            # Numbers win over NaN whichever end is asked for.
            numbers = [F.when(~F.isnan(c.cast("double")), c.cast("double")) for c in candidates]
            best = F.coalesce(fn(*numbers) if len(numbers) > 1 else numbers[0], F.coalesce(*candidates).cast("double"))
        else:
            best = fn(*candidates) if len(candidates) > 1 else value
        if skip_nulls:
            return best
        missing = value.isNull()
        return F.when(missing | F.lit(any(o is None for o in others)), None).otherwise(best)

    return builder


function("max_element_wise")(_extreme(F.greatest))
function("min_element_wise")(_extreme(F.least))
