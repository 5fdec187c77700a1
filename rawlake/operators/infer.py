"""Manifest inference: column types from the text, or the footers, of sampled files.

One aggregation per scan decides, for each file and column, which types all of
its cells fit; only files times columns remain for the fold to a common type.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlake.operators.convert import FALSE_TOKENS, ISO8601, NULL_TOKENS, TIMESTAMP_FORMATS, TRUE_TOKENS
from rawlake.functions.timeformat import to_spark_pattern
from rawlake.session import materialize
from rawlake.sources.scan import Scan
from rawlake.types import REQUIRED

# Rank of each type, from most to least restrictive.
RANKS = {"bool": 10, "int64": 20, "double": 40, "date32": 50, "date64": 51, "string": 100}
NUMERIC, DATES = ("bool", "int64", "double"), ("date32", "date64")

_INT = r"^[ \t]*(-?\d{1,19}|0[xX][0-9a-fA-F]{1,16})[ \t]*$"
_DOUBLE = r"(?i)^[ \t]*([+-]?(inf|infinity|nan)|-?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?)[ \t]*$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_SECONDS = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2})?)?)?$"
_ZONED = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?(Z|[+-]\d{2}:?\d{2})$"
_FRACTION = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?)?$"


# The whole bits of a mask: no value at all, and every type.
EMPTY = 1 << 30
ANY = (1 << 30) - 1


def _candidates(text: Column, options: dict[str, Any]) -> list[tuple[str, Column]]:
    """Types in the order they are tried, and what a cell must look like.

    Tests that cost much stand behind ones that cost little.
    """
    formats = options.get("timestamp_parsers") or TIMESTAMP_FORMATS
    lead = F.substring(text, 1, 1)
    digit = lead.between("0", "9")
    number = digit | lead.isin("-", " ", "\t")
    # No date lacks this dash, and no whole number that begins with a digit has it; fractions may (123e-5).
    dated = digit & (F.substring(text, 5, 1) == "-")
    fits = F.length(text) <= 18
    found = [
        ("int64", number & ~dated & text.rlike(_INT) & (fits | text.rlike("^[ \t]*0[xX]") | text.try_cast("decimal(38,0)").between(-(2**63), 2**63 - 1))),
        ("bool", text.isin(*options.get("true_values", TRUE_TOKENS), *options.get("false_values", FALSE_TOKENS))),
        ("date32", dated & (F.length(text) == 10) & text.rlike(_DATE) & text.try_cast("date").isNotNull()),
    ]
    patterns = [f for f in formats if f != ISO8601]
    if patterns:
        anyof = F.lit(False)
        for fmt in patterns:
            parsed = F.try_to_timestamp(text, F.lit(to_spark_pattern(fmt))).isNotNull()
            # Text that does not fit makes the parser throw, so plain dates are looked at first.
            anyof = anyof | (digit & text.rlike(r"^\d{8}$") & parsed if fmt == "%Y%m%d" else parsed)
        found.append(("timestamp[s]", anyof))
    if ISO8601 in formats:
        padded = F.when(text.rlike(r"[ T]\d{2}$"), F.concat(text, F.lit(":00"))).otherwise(text)
        real = padded.try_cast("timestamp_ntz").isNotNull()
        found += [
            ("timestamp[s]", dated & text.rlike(_SECONDS) & real),
            ("timestamp[s, tz=UTC]", dated & text.rlike(_ZONED) & F.try_to_timestamp(text).isNotNull()),
            ("timestamp[us]", dated & text.rlike(_FRACTION) & real),
        ]
    found.append(("double", (number | lead.isin(".", "+", "i", "I", "n", "N")) & text.rlike(_DOUBLE)))
    return found


def cell_mask(cell: Column, options: dict[str, Any] | None = None) -> Column:
    """A bit for each candidate type that a cell may have; all of them for a cell without a value."""
    options = options or {}
    text = F.coalesce(cell, F.lit(""))
    bits = [F.when(test, F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, test) in enumerate(_candidates(text, options))]
    fits = bits[0]
    for bit in bits[1:]:
        fits = fits.bitwiseOR(bit)
    return F.when(text.isin(*options.get("null_values", NULL_TOKENS)), F.lit(EMPTY | ANY)).otherwise(fits)


def mask_type(mask: Column, options: dict[str, Any] | None = None) -> Column:
    """The first type that is left in the masks of all cells."""
    kind = F.lit("string")
    for k, (name, _) in reversed(list(enumerate(_candidates(F.lit(""), options or {})))):
        kind = F.when(mask.bitwiseAND(F.lit(1 << k)) != 0, name).otherwise(kind)
    return F.when(mask.bitwiseAND(F.lit(EMPTY)) != 0, "null").otherwise(kind)


def file_types(scan: Scan, options: dict[str, Any] | None = None) -> DataFrame:
    """``path, col_ord, name, type`` of every file and column of a scan.

    Each cell is looked at once, for all types; what is left of its mask in all
    cells of a file tells the type. A column without any value has the type ``null``.
    Cells come as rows of their own, so one piece of code, short enough for the JVM
    to compile, looks at those of all columns.
    """
    cells = F.posexplode(F.array(*[F.col(f"`{name}`") for name in scan.columns])).alias("col_ord", "cell")
    masks = scan.df.select(F.col("_fp").alias("path"), cells).groupBy("path", "col_ord").agg(F.bit_and(cell_mask(F.col("cell"), options)).alias("mask"))
    name = F.element_at(F.array(*[F.lit(name) for name in scan.columns]), F.col("col_ord") + 1)
    return masks.select("path", "col_ord", name.alias("name"), mask_type(F.col("mask"), options).alias("type"))


def stored_types(footers: DataFrame) -> DataFrame:
    """As ``file_types``, from the footers of Parquet files (``path``, ``names``, ``types``)."""
    each = F.posexplode(F.arrays_zip("names", "types")).alias("col_ord", "t")
    return footers.select("path", each).select("path", "col_ord", F.col("t.names").alias("name"), F.col("t.types").alias("type"))


def logical_type(kind: Column) -> Column:
    """Physical names folded to the logical types a manifest knows."""
    text = F.lower(F.trim(kind))
    return (
        F.when(text.rlike(r"^u?int(8|16|32|64)$"), "int64")
        .when(text.rlike(r"^(float|double|halffloat|decimal(32|64|128|256)?)(\(.*\))?$|^float\d+$"), "double")
        .when(text.isin("bool", "date32", "date64"), text)
        .when(text.rlike(r"^date32\[.*\]$"), "date32")
        .when(text.rlike(r"^date64\[.*\]$"), "date64")
        .when(text.startswith("timestamp"), kind)
        .otherwise("string")
    )


def common_type(kind: str = "type") -> Column:
    """Aggregate: the type all of a group's types can become.

    Independent of the order of the rows: equal types stay, numbers and dates
    take the widest of their kind, everything else is text.
    """
    name = F.col(kind)
    rank = F.lit(200)
    for known, value in RANKS.items():
        rank = F.when(name == known, value).otherwise(rank)
    family = F.when(name.isin(*NUMERIC), "number").when(name.isin(*DATES), "date").otherwise(name)
    one_family = F.min(family) == F.max(family)
    return F.when(one_family, F.max_by(name, rank)).otherwise("string")


def fold_types(types: DataFrame, files: int | None = None) -> DataFrame:
    """``name, type`` for all files together; a column that some of the
    ``files`` lack is text."""
    if files is None:
        files = types.select("path").distinct().count()
    folded = types.withColumn("type", logical_type(F.col("type"))).groupBy("name").agg(
        common_type().alias("common"), F.count_distinct("path").alias("files")
    )
    kind = F.when(F.col("files") < files, "string").otherwise(F.col("common"))
    return folded.select("name", kind.alias("type"))


def column_order(headers: DataFrame) -> DataFrame:
    """Columns in the order first seen (``path, col_ord, name``), by path."""
    first = headers.groupBy("name").agg(F.min(F.struct("path", "col_ord")).alias("seen"))
    # One row per column of the table.
    positions = first.orderBy("seen").select("name", "seen")
    return positions.select("name", F.col("seen.path").alias("first_path"), F.col("seen.col_ord").alias("first_ord"))


def infer_manifest(scans: list[Scan], options: dict[str, Any] | None = None) -> dict[str, Any]:
    """Manifest of the sampled files, as a dict ready for JSON."""
    types = None
    for scan in scans:
        found = file_types(scan, options)
        types = found if types is None else types.unionByName(found)
    return manifest_of(types)


def manifest_of(types: DataFrame, exact: dict[str, str] | None = None) -> dict[str, Any]:
    """Manifest of ``path, col_ord, name, type``. Columns that all files have, with one
    type, keep the name that ``exact`` has for that type, if any."""
    types = materialize(types, "file-types")
    same = types.groupBy("name").agg(F.count_distinct("path").alias("n"), F.min("type").alias("low"), F.max("type").alias("high"))
    alike = F.when((F.col("low") == F.col("high")) & (F.col("n") == types.select("path").distinct().count()), F.col("low"))
    rows = fold_types(types).join(column_order(types), "name").join(same.select("name", alike.alias("alike")), "name")
    entries = {
        str(i): {"name": r["name"], "type": (exact or {}).get(r["alike"], r["type"]), "column_operation": REQUIRED, "nullable": True}
        for i, r in enumerate(rows.orderBy("first_path", "first_ord").collect(), start=1)
    }
    return {"schema": entries}


__all__ = ["TIMESTAMP_FORMATS", "column_order", "common_type", "file_types", "fold_types", "infer_manifest", "logical_type", "manifest_of", "stored_types"]
