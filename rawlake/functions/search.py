"""Text tests, search, extraction and splitting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import function
from rawlake.functions.strings import ASCII_SPACE, UNICODE_SPACE, quote_regex

function("utf8_length")(lambda value, dtype: F.length(value))
function("binary_length")(lambda value, dtype: F.octet_length(value))


_REST = "restbehind"


def _fold(value: Column, pattern: str, ignore_case: bool) -> tuple[Column, Column]:
    return (F.lower(value), F.lit(pattern.lower())) if ignore_case else (value, F.lit(pattern))


def _regex(pattern: str, ignore_case: bool = False) -> str:
    return ("(?i)" if ignore_case else "") + pattern.replace("(?P<", "(?<")


@function("starts_with")
def starts_with(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    text, part = _fold(value, pattern, ignore_case)
    return F.startswith(text, part)


@function("ends_with")
def ends_with(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    text, part = _fold(value, pattern, ignore_case)
    return F.endswith(text, part)


@function("match_substring")
def match_substring(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    text, part = _fold(value, pattern, ignore_case)
    return F.contains(text, part)


@function("match_substring_regex")
def match_regex(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    return value.rlike(_regex(pattern, ignore_case))


@function("match_like")
def match_like(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    return value.ilike(pattern) if ignore_case else value.like(pattern)


@function("count_substring")
def count_substring(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_count(value, F.lit(("(?iu)" if ignore_case else "") + quote_regex(pattern)))


@function("count_substring_regex")
def count_regex(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_count(value, F.lit(_regex(pattern, ignore_case)))


def _byte_index(value: Column, position: Column) -> Column:
    """Byte offset of a 1-based character position; -1 for none."""
    before = F.octet_length(F.substring(value, F.lit(1), position - 1))
    return F.when(position == 0, -1).otherwise(before)


@function("find_substring")
def find_substring(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    text, part = _fold(value, pattern, ignore_case)
    return _byte_index(value, F.locate(pattern.lower() if ignore_case else pattern, text))


@function("find_substring_regex")
def find_regex(value: Column, dtype: T.DataType, pattern: str, ignore_case: bool = False) -> Column:
    return _byte_index(value, F.regexp_instr(value, F.lit(_regex(pattern, ignore_case))))


@function("extract_regex")
def extract_regex(value: Column, dtype: T.DataType, pattern: str) -> Column:
    groups = re.compile(pattern).groupindex
    java = _regex(pattern)
    cells = [F.regexp_extract(value, java, at).alias(name) for name, at in groups.items()]
    return F.when(value.rlike(java), F.struct(*cells))


@function("extract_regex_span")
def extract_regex_span(value: Column, dtype: T.DataType, pattern: str) -> Column:
    """Byte offset and length of each named group, the latter 0 for one that has no part in the match.

    A look ahead at the front of a group takes all that follows, which tells where the
    group begins. It is a group of its own, so numbered back-references are refused.
    """
    if re.search(r"(?<!\\)(?:\\\\)*\\[1-9]", pattern):
        raise ValueError("Spans are not to be had of a pattern with numbered back-references")
    spans = []
    for name in re.compile(pattern).groupindex:
        opening = f"(?P<{name}>"
        looking = pattern.replace(opening, f"{opening}(?=(?P<{_REST}>[\\s\\S]*))", 1)
        at = re.compile(looking).groupindex
        rest, own = (F.regexp_extract(value, _regex(looking), at[g]) for g in (_REST, name))
        before = F.octet_length(value) - F.octet_length(rest)
        spans.append(F.array(before.cast("bigint"), F.octet_length(own).cast("bigint")).alias(name))
    return F.when(value.rlike(_regex(pattern)), F.struct(*spans))


# -- splitting -------------------------------------------------------------------------


def _split(value: Column, regex: str, joiner: str | None, max_splits: int | None, reverse: bool) -> Column:
    if max_splits is None or max_splits < 0:
        return F.split(value, regex, -1)
    if not reverse:
        return F.split(value, regex, max_splits + 1)
    parts = F.split(value, regex, -1)
    lead = F.greatest(F.size(parts) - max_splits, F.lit(1))
    head = F.array_join(F.slice(parts, F.lit(1), lead), joiner)
    tail = F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead, F.lit(0)))
    return F.when(value.isNotNull(), F.concat(F.array(head), tail))


@function("split_pattern")
def split_pattern(
    value: Column, dtype: T.DataType, pattern: str, max_splits: int | None = None, reverse: bool = False
) -> Column:
    return _split(value, quote_regex(pattern), pattern, max_splits, reverse)


@function("split_pattern_regex")
def split_regex(
    value: Column, dtype: T.DataType, pattern: str, max_splits: int | None = None, reverse: bool = False
) -> Column:
    if reverse:
        raise ValueError("Cannot split in reverse with regex")
    return _split(value, _regex(pattern), None, max_splits, False)


def _whitespace(space: str):
    def builder(value: Column, dtype: T.DataType, max_splits: int | None = None, reverse: bool = False) -> Column:
        if not reverse or max_splits is None or max_splits < 0:
            return _split(value, f"{space}+", None, max_splits, False)
        # The last runs of whitespace, found from the end.
        flipped = F.split(F.reverse(value), f"{space}+", max_splits + 1)
        return F.reverse(F.transform(flipped, F.reverse))

    return builder


function("utf8_split_whitespace")(_whitespace(UNICODE_SPACE))
function("ascii_split_whitespace")(_whitespace(ASCII_SPACE))


# -- character classes --------------------------------------------------------------------

_ALL = {
    "utf8_is_alnum": r"[\p{L}\p{N}]",
    "ascii_is_alnum": "[A-Za-z0-9]",
    "utf8_is_alpha": r"\p{L}",
    "ascii_is_alpha": "[A-Za-z]",
    "utf8_is_decimal": r"\p{Nd}",
    "ascii_is_decimal": "[0-9]",
    "utf8_is_digit": r"\p{Nd}",
    "utf8_is_numeric": r"\p{N}",
    "utf8_is_space": UNICODE_SPACE,
    "ascii_is_space": ASCII_SPACE,
}
for _name, _class in _ALL.items():
    function(_name)(lambda value, dtype, rx=rf"\A{_class}+\z": value.rlike(rx))

# Empty text is printable and plain.
_EVERY = {
    "utf8_is_printable": r"(?:[^\p{C}\p{Z}]| )",
    "ascii_is_printable": r"[\x20-\x7E]",
    "string_is_ascii": r"[\x00-\x7F]",
}
for _name, _class in _EVERY.items():
    function(_name)(lambda value, dtype, rx=rf"\A{_class}*\z": value.rlike(rx))

_CASED = {"utf8": (r"\p{Ll}", r"[\p{Lu}\p{Lt}]", r"[\p{Ll}\p{Lu}\p{Lt}]"), "ascii": ("[a-z]", "[A-Z]", "[A-Za-z]")}
for _kind, (_low, _up, _any) in _CASED.items():
    function(f"{_kind}_is_lower")(lambda value, dtype, a=_low, b=_up: value.rlike(a) & ~value.rlike(b))
    function(f"{_kind}_is_upper")(lambda value, dtype, a=_up, b=_low: value.rlike(a) & ~value.rlike(b))
    # Upper case only at the start of a run of letters, lower case only inside.
    function(f"{_kind}_is_title")(
        lambda value, dtype, a=_low, b=_up, c=_any: value.rlike(c)
        & ~value.rlike(f"{c}{b}")
        & ~value.rlike(f"(?<!{c}){a}")
    )
