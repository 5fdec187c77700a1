"""Lists, structs and maps."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import function

function("list_value_length")(lambda value, dtype: F.when(value.isNotNull(), F.size(value)))


@function("list_element")
def list_element(value: Column, dtype: T.ArrayType, index: int) -> Column:
    bad = F.raise_error(F.lit(f"list_element: index {index} is out of bounds")).cast(dtype.elementType)
    inside = F.when(F.size(value) > index, F.get(value, F.lit(index))).otherwise(bad)
    return F.when(value.isNotNull(), inside)


@function("list_slice")
def list_slice(
    value: Column, dtype: T.ArrayType, start: int, stop: int | None = None, step: int = 1, **_: Any
) -> Column:
    size = F.size(value) if stop is None else F.least(F.size(value), F.lit(stop))
    part = F.slice(value, F.lit(start + 1), F.greatest(size - start, F.lit(0)))
    return part if step == 1 else F.filter(part, lambda x, i: i % step == 0)


@function("struct_field")
def struct_field(value: Column, dtype: T.StructType, indices: Any) -> Column:
    """Field by name or position, or by a path of them."""
    for step in indices if isinstance(indices, (list, tuple)) else [indices]:
        field = dtype[step]
        value, dtype = value[field.name], field.dataType
    return value


@function("map_lookup")
def map_lookup(value: Column, dtype: T.MapType, query_key: Any, occurrence: str = "first") -> Column:
    # Keys of a Spark map are unique, so first and last are the same entry.
    found = F.try_element_at(value, F.lit(query_key))
    return F.when(found.isNotNull(), F.array(found)) if occurrence == "all" else found


@function("make_struct")
def make_struct(value: Column, dtype: T.DataType, *others: Any, field_names: list[str] | None = None) -> Column:
    names = field_names or [str(i) for i in range(len(others) + 1)]
    cells = [value, *[F.lit(o) for o in others]]
    return F.struct(*[c.alias(n) for c, n in zip(cells, names)])
