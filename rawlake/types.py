"""Type strings, manifests and schemas as Spark ``StructType`` values."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Type names a manifest may use.
TYPE_NAMES = {
    "string": "string",
    "int": "int64",
    "int64": "int64",
    "double": "double",
    "float": "double",
    "float64": "double",
    "real": "double",
    "decimal": "double",
    "numeric": "double",
    "number": "double",
    "date32": "date32",
    "date64": "date64",
    "date": "date64",
    "bool": "bool",
}

REQUIRED, OPTIONAL, IGNORED = "source_required", "source_optional", "output_ignored"

_SPARK = {
    "string": T.StringType(),
    "int64": T.LongType(),
    "double": T.DoubleType(),
    "date32": T.DateType(),
    "date64": T.DateType(),
    "bool": T.BooleanType(),
}

# Standard lineage columns, in output order.
STANDARD_COLUMNS = [
    ("_source_file", "string"),
    ("_source_file_mtime", "timestamp[us, tz=UTC]"),
    ("_creation_time", "timestamp[us, tz=UTC]"),
    ("_knowledge_time", "timestamp[us, tz=UTC]"),
    ("_knowledge_date", "date32"),
    ("_index", "int64"),
]


def parse_type(text: str) -> tuple[T.DataType, dict[str, Any]]:
    """Spark type of a manifest type string, and facts Spark types cannot hold.

    The second value keeps the logical name and, for timestamps, unit and zone.
    """
    text = text.strip()
    if text.startswith("list<"):
        closing = text.rfind(">")
        if closing < 0:
            raise ValueError(f"Invalid list type: {text}")
        inner = text[len("list<") : closing].strip()
        nullable = not inner.endswith(" not null")
        element, facts = parse_type(inner.removesuffix(" not null"))
        return T.ArrayType(element, nullable), {"logical": "list", "element": facts}
    stamp = re.fullmatch(r"timestamp(?:\[\s*(?P<unit>s|ms|us|ns)?\s*,?\s*(?:tz\s*=\s*(?P<zone>[^\],=\s]+))?\s*\])?(?: not null)?", text)
    if stamp:
        unit, zone = stamp["unit"] or "us", stamp["zone"]
        if unit not in ("s", "ms", "us"):
            raise ValueError(f"Timestamp unit '{unit}' is finer than Spark's microseconds: {text}")
        spark_type = T.TimestampType() if zone else T.TimestampNTZType()
        return spark_type, {"logical": "timestamp", "unit": unit, "tz": zone}
    name = text.replace(" not null", "").strip()
    if name not in TYPE_NAMES:
        raise ValueError(f"Unknown dtype: {name}")
    logical = TYPE_NAMES[name]
    return _SPARK[logical], {"logical": logical}


def spark_type(text: str) -> T.DataType:
    return parse_type(text)[0]


def type_name(dtype: T.DataType) -> str:
    """Manifest type string of a Spark type; what has none is text."""
    if isinstance(dtype, T.IntegralType):
        return "int64"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return "double"
    if isinstance(dtype, T.TimestampType):
        return "timestamp[us, tz=UTC]"
    if isinstance(dtype, T.ArrayType):
        return f"list<{type_name(dtype.elementType)}>"
    names = {T.DateType: "date32", T.BooleanType: "bool", T.TimestampNTZType: "timestamp[us]"}
    return names.get(type(dtype), "string")


def load_manifest(spark: SparkSession, source: str | dict) -> T.StructType:
    """Manifest (dict, JSON text or path) to ``StructType``.

    Field order follows the integer value of the position keys; the column
    operation and the logical type are kept in the field metadata.
    """
    if isinstance(source, str):
        if not source.lstrip().startswith("{"):
            source = spark.read.text(source, wholetext=True).first()[0]
        source = json.loads(source)
    columns = source["schema"]
    fields = []
    for position in sorted(columns, key=int):
        spec = columns[position]
        dtype, facts = parse_type(spec["type"])
        operation = spec.get("column_operation", REQUIRED)
        if operation not in (REQUIRED, OPTIONAL, IGNORED):
            raise ValueError(f"Column '{spec['name']}': unknown column_operation '{operation}'")
        meta = {**facts, "column_operation": operation, "type": spec["type"]}
        fields.append(T.StructField(spec["name"], dtype, spec.get("nullable", True), meta))
    return T.StructType(fields)


def operation(field: T.StructField) -> str:
    return (field.metadata or {}).get("column_operation", REQUIRED)


def reading_schema(manifest: T.StructType) -> T.StructType:
    """Columns the source has to carry."""
    return T.StructType([f for f in manifest if operation(f) != OPTIONAL])


def output_schema(manifest: T.StructType) -> T.StructType:
    """Columns the output carries."""
    return T.StructType([f for f in manifest if operation(f) != IGNORED])


def lineage_schema(metadata: dict | None) -> T.StructType:
    """Additional lineage columns first, then the standard ones."""
    metadata = metadata or {}
    fields = []
    for name, spec in (metadata.get("additional_metadata") or {}).items():
        dtype, facts = parse_type(spec["dtype"])
        fields.append(T.StructField(name, dtype, True, {**facts, "type": spec["dtype"]}))
    if metadata.get("standard_metadata", True):
        for name, text in STANDARD_COLUMNS:
            dtype, facts = parse_type(text)
            fields.append(T.StructField(name, dtype, True, {**facts, "type": text}))
    return T.StructType(fields)


def unify(*schemas: T.StructType) -> T.StructType:
    """Field-wise merge without widening; a name with two types is an error."""
    merged: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema):
        known = merged.get(field.name)
        if known is None:
            merged[field.name] = field
        elif known.dataType != field.dataType:
            raise ValueError(
                f"Column '{field.name}' has conflicting types: "
                f"{known.dataType.simpleString()} and {field.dataType.simpleString()}"
            )
        elif field.nullable and not known.nullable:
            merged[field.name] = T.StructField(known.name, known.dataType, True, known.metadata)
    return T.StructType(list(merged.values()))
