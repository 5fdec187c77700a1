"""Text transforms. Positions and lengths count code points."""

from __future__ import annotations

import re
import string
import unicodedata
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import function

# Whitespace by ASCII and by Unicode.
ASCII_SPACE = r"[ \t\n\x0B\f\r]"
UNICODE_SPACE = r"[\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85]"

_LOWER, _UPPER = string.ascii_lowercase, string.ascii_uppercase


def upper(value: Column) -> Column:
    # One code point stays one code point: sharp s has a capital of its own.
    return F.upper(F.replace(value, F.lit("ß"), F.lit("ẞ")))


def ascii_upper(value: Column) -> Column:
    return F.translate(value, _LOWER, _UPPER)


def ascii_lower(value: Column) -> Column:
    return F.translate(value, _UPPER, _LOWER)


def _first_rest(up, low):
    return lambda value: F.concat(up(F.substring(value, 1, 1)), low(F.substring(value, F.lit(2), F.length(value))))


def _swap(value: Column) -> Column:
    chars = F.split(value, "")
    return F.array_join(F.transform(chars, lambda c: F.when(c == F.lower(c), upper(c)).otherwise(F.lower(c))), "")


def _title(letters: str, up, low):
    """First letter of every run of letters in upper case, the others lower."""

    def apply(value: Column) -> Column:
        runs = F.regexp_extract_all(value, F.lit(rf"(?s)({letters}+|(?!{letters}).)"), F.lit(1))
        return F.array_join(F.transform(runs, _first_rest(up, low)), "")

    return apply


def _simple(fn):
    return lambda value, dtype: fn(value)


for _name, _fn in {
    "utf8_upper": upper,
    "ascii_upper": ascii_upper,
    "utf8_lower": F.lower,
    "ascii_lower": ascii_lower,
    "utf8_swapcase": _swap,
    "ascii_swapcase": lambda v: F.translate(v, _LOWER + _UPPER, _UPPER + _LOWER),
    "utf8_capitalize": _first_rest(upper, F.lower),
    "ascii_capitalize": _first_rest(ascii_upper, ascii_lower),
    "utf8_title": _title(r"\p{L}", upper, F.lower),
    "ascii_title": _title("[A-Za-z]", ascii_upper, ascii_lower),
    "utf8_reverse": F.reverse,
    "ascii_reverse": F.reverse,
    "binary_reverse": F.reverse,
}.items():
    function(_name)(_simple(_fn))


@function("binary_repeat")
def repeat(value: Column, dtype: T.DataType, num_repeats: int) -> Column:
    return F.repeat(value, num_repeats)


# -- padding and trimming ----------------------------------------------------------


def _pad(where: str, size):
    def builder(
        value: Column, dtype: T.DataType, width: int, padding: str = " ", lean_left_on_odd_padding: bool = True
    ) -> Column:
        room = F.greatest(F.lit(width) - size(value), F.lit(0))
        if where == "center":
            left = F.floor((room if lean_left_on_odd_padding else room + 1) / 2).cast("int")
        else:
            left = room if where == "left" else F.lit(0)
        return F.concat(F.repeat(F.lit(padding), left), value, F.repeat(F.lit(padding), room - left))

    return builder


# The ASCII variants measure bytes.
for _kind, _size in (("utf8", F.length), ("ascii", F.octet_length)):
    function(f"{_kind}_lpad")(_pad("left", _size))
    function(f"{_kind}_rpad")(_pad("right", _size))
    function(f"{_kind}_center")(_pad("center", _size))


@function("utf8_zero_fill", "utf8_zfill")
def zero_fill(value: Column, dtype: T.DataType, width: int, padding: str = "0") -> Column:
    signed = F.substring(value, 1, 1).isin("+", "-")
    fill = F.repeat(F.lit(padding), F.greatest(F.lit(width) - F.length(value), F.lit(0)))
    rest = F.substring(value, F.lit(2), F.length(value))
    return F.when(signed, F.concat(F.substring(value, 1, 1), fill, rest)).otherwise(F.concat(fill, value))


for _kind in ("utf8", "ascii"):
    function(f"{_kind}_trim")(lambda value, dtype, characters: F.btrim(value, F.lit(characters)))
    function(f"{_kind}_ltrim")(lambda value, dtype, characters: F.ltrim(value, F.lit(characters)))
    function(f"{_kind}_rtrim")(lambda value, dtype, characters: F.rtrim(value, F.lit(characters)))
for _kind, _space in (("utf8", UNICODE_SPACE), ("ascii", ASCII_SPACE)):
    for _side, _rx in (("", rf"\A{_space}+|{_space}+\z"), ("l", rf"\A{_space}+"), ("r", rf"{_space}+\z")):
        function(f"{_kind}_{_side}trim_whitespace")(
            lambda value, dtype, rx=_rx: F.regexp_replace(value, rx, "")
        )


# -- slices ------------------------------------------------------------------------


def _clip(at: Column | int, size: Column) -> Column:
    """Position within 0..size; negative ones count from the end."""
    at = F.lit(at)
    return F.least(F.greatest(F.when(at < 0, size + at).otherwise(at), F.lit(0)), size)


@function("utf8_slice_codeunits", "binary_slice")
def slice_text(value: Column, dtype: T.DataType, start: int, stop: int | None = None, step: int = 1) -> Column:
    size = F.length(value)
    if step > 0:
        low = _clip(start, size)
        high = size if stop is None else _clip(stop, size)
        if step == 1:
            return F.substring(value, low + 1, F.greatest(high - low, F.lit(0)))
        last = high - 1
        empty = low >= high
    else:
        low = F.least(F.when(F.lit(start) < 0, size + start).otherwise(F.lit(start)), size - 1)
        last = F.lit(0) if stop is None else F.when(F.lit(stop) < 0, size + stop).otherwise(F.lit(stop)) + 1
        last = F.greatest(last, F.lit(0))
        empty = low < last
    spots = F.sequence(low, F.when(empty, low).otherwise(last), F.lit(step))
    text = F.array_join(F.transform(spots, lambda i: F.substring(value, i + 1, F.lit(1))), "")
    return F.when(value.isNull(), None).when(empty, "").otherwise(text)


@function("utf8_replace_slice", "binary_replace_slice")
def replace_slice(value: Column, dtype: T.DataType, start: int, stop: int, replacement: str) -> Column:
    size = F.length(value)
    low = _clip(start, size)
    high = F.greatest(_clip(stop, size), low)
    return F.concat(F.substring(value, F.lit(1), low), F.lit(replacement), F.substring(value, high + 1, size))


# -- replacing -----------------------------------------------------------------------


def quote_regex(text: str) -> str:
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def java_replacement(text: str) -> str:
    """Back-references as the JVM writes them."""
    return re.sub(
        r"\\(\d|\\)|\$", lambda m: {"$": r"\$", "\\\\": r"\\"}.get(m[0], f"${m[1]}"), text
    )


@function("replace_substring")
def replace_substring(
    value: Column, dtype: T.DataType, pattern: str, replacement: str, max_replacements: int | None = None
) -> Column:
    if max_replacements is None or max_replacements < 0:
        return F.replace(value, F.lit(pattern), F.lit(replacement))
    return F.array_join(F.split(value, quote_regex(pattern), max_replacements + 1), replacement)


@function("replace_substring_regex")
def replace_substring_regex(
    value: Column, dtype: T.DataType, pattern: str, replacement: str, max_replacements: int | None = None
) -> Column:
    pattern, replacement = pattern.replace("(?P<", "(?<"), java_replacement(replacement)
    if max_replacements is None or max_replacements < 0:
        return F.regexp_replace(value, pattern, replacement)
    if max_replacements == 0:
        return value
    # Pieces between the first matches, and those matches replaced one by one.
    pieces = F.split(value, pattern, max_replacements + 1)
    found = F.slice(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), 1, max_replacements)
    swapped = F.transform(found, lambda m: F.regexp_replace(m, pattern, replacement))
    return F.array_join(F.zip_with(pieces, swapped, lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")


@function("utf8_normalize")
def normalize(value: Column, dtype: T.DataType, form: str) -> Column:
    # No built-in counterpart: Arrow batches through Python.
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    return run(value)


# -- joining ---------------------------------------------------------------------------


@function("binary_join_element_wise")
def join_element_wise(
    value: Column, dtype: T.DataType, *others: Any, null_handling: str = "emit_null", null_replacement: str = ""
) -> Column:
    """The last argument is the separator."""
    *texts, separator = others
    cells = [value, *[F.lit(t).cast("string") for t in texts]]
    if null_handling == "skip":
        return F.concat_ws(separator, *cells)
    if null_handling == "replace":
        return F.concat_ws(separator, *[F.coalesce(c, F.lit(null_replacement)) for c in cells])
    if null_handling != "emit_null":
        raise ValueError(f"Unknown null_handling '{null_handling}'")
    pieces = [x for c in cells for x in (F.lit(separator), c)][1:]
    return F.concat(*pieces)


@function("binary_join")
def join_list(value: Column, dtype: T.DataType, separator: str) -> Column:
    return F.when(~F.exists(value, lambda x: x.isNull()), F.array_join(value, separator))
