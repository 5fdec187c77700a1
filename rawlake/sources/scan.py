"""Scans of raw files: all cells as text, columns by name, rows in file order.

Three ways to read, chosen per file:

* plain CSV: Spark's own CSV source, splittable, one scan per distinct header;
* line-wise: preambles, trailers and sections are cut by line number, then the
  remaining lines are parsed with ``from_csv``;
* unpacked: archives and codecs Spark does not know are first streamed into a
  table of lines (see ``archive``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.operators import ordinal
from rawlake.session import materialize
from rawlake.sources import archive, heads, remote
from rawlake.sources.inventory import decoded_path, plain_path

# More distinct headers than this are resolved row by row instead of one scan
# per header.
MAX_HEADERS = 64

# Holds a record that has not as many cells as its header, in scans that keep such records.
CORRUPT = "_corrupt"

TAGS = ["_tord", "_fp", "_bs", "_mtime", "_size"]
ZIP_TAGS = {"_zname": "string", "_zmtime": "timestamp", "_zsize": "bigint", "_zcsize": "bigint"}
NUMBERS = ["_findex", "_gindex"]

# Defaults of the pipe-separated vendor preset.
PIPE_PRESET = {"skipfooter": 1, "skip_rows": 2, "delimiter": "|"}


@dataclass
class TextFormat:
    """How raw text files are laid out."""

    skip_rows: int = 0
    skip_rows_after_names: int = 0
    column_names: list[str] | None = None
    autogenerate_column_names: bool = False
    skipfooter: int = 0
    delimiter: str = ","
    quote_char: str | None = '"'
    double_quote: bool = True
    escape_char: str | None = None
    newlines_in_values: bool = False
    ignore_empty_lines: bool = True
    encoding: str = "utf-8"
    sectioned: bool = False
    convert: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def from_options(cls, options: dict | None = None, **direct: Any) -> TextFormat:
        """From ``read_options`` / ``parse_options`` / ``convert_options``."""
        options = deepcopy(options or {})
        read, parse = options.get("read_options", {}), options.get("parse_options", {})
        read.pop("block_size", None)  # spark.sql.files.maxPartitionBytes
        for key in ("quote_char", "escape_char"):
            if parse.get(key) is False:
                parse[key] = None
        return cls(**read, **parse, convert=options.get("convert_options", {}), **direct)

    @classmethod
    def pipe_preset(cls, options: dict | None = None, **direct: Any) -> TextFormat:
        options = deepcopy(options or {})
        options.setdefault("read_options", {}).setdefault("skip_rows", PIPE_PRESET["skip_rows"])
        options.setdefault("parse_options", {}).setdefault("delimiter", PIPE_PRESET["delimiter"])
        direct.setdefault("skipfooter", PIPE_PRESET["skipfooter"])
        return cls.from_options(options, **direct)

    @classmethod
    def sections(cls, **direct: Any) -> TextFormat:
        convert = {"null_values": ["N.A."], "strings_can_be_null": True}
        return cls(delimiter="|", sectioned=True, convert=convert, **direct)

    @property
    def has_header(self) -> bool:
        return not (self.column_names or self.autogenerate_column_names or self.sectioned)

    @property
    def by_line(self) -> bool:
        return bool(
            self.sectioned or self.skip_rows or self.skip_rows_after_names or self.skipfooter
            or not self.ignore_empty_lines
        )

    @property
    def utf8(self) -> bool:
        return self.encoding.lower().replace("_", "-") in ("utf-8", "utf8")

    @property
    def wide(self) -> bool:
        """Whether a line end is more than one byte, which no byte splitter finds."""
        return self.encoding.lower().replace("_", "-").startswith(("utf-16", "utf16", "utf-32", "utf32"))

    def csv_options(self, lenient: bool = False) -> dict[str, str]:
        quote = self.quote_char or "\u0000"
        escape = self.escape_char or (quote if self.double_quote else "\u0000")
        return {
            "sep": self.delimiter,
            "quote": quote,
            "escape": escape,
            **({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if lenient else {"mode": "FAILFAST"}),
            "multiLine": str(self.newlines_in_values).lower(),
            "maxCharsPerColumn": "-1",
        }


@dataclass
class Scan:
    """Tagged rows of raw files.

    ``order`` names the column that holds the line number when rows no longer
    come in scan order. ``counts`` has the rows of every split once the rows
    are numbered. ``decorated`` tells that path-derived columns are there,
    ``sparse`` that a null cell means a column which the row's file lacks. ``files``
    has the rows of every file where the reader itself numbers them (``_findex``).
    """

    df: DataFrame
    columns: list[str]
    order: str | None = None
    counts: DataFrame | None = None
    decorated: bool = False
    sparse: bool = False
    files: DataFrame | None = None

    def number(self, decorate: ordinal.Decorate | None = None) -> Scan:
        """Add the row number within the file and within the scan.

        ``decorate`` adds path-derived columns, on the split side if it can.
        """
        if self.counts is not None:
            return self
        if self.order:
            df, offsets = ordinal.renumber(self.df, self.order)
            return Scan(df, self.columns, self.order, offsets.select(*ordinal.SPLIT, "_n"), self.decorated)
        decorate = None if self.decorated else decorate
        if self.files is not None:
            side, small = ordinal.file_offsets(self.files, decorate)
            if small:
                # Nothing here depends on how the scan is cut up, so filters get through to the reader.
                df, counts = ordinal.join_file_offsets(self.df, side), self.files.select(*ordinal.SPLIT, "_n")
                return Scan(df, self.columns, None, counts, self.decorated or decorate is not None)
        df, offsets = ordinal.number_scan(self.df, decorate)
        counts = offsets.select(*ordinal.SPLIT, "_n")
        return Scan(df, self.columns, None, counts, self.decorated or decorate is not None)


def path_list(files: DataFrame) -> list[str]:
    """Path list for a reader; Spark's file index holds the same list."""
    escaped = F.regexp_replace("path", r"([\[\]{}*?\\])", r"\\$1")
    return [r[0] for r in files.select(escaped).collect()]


def escaped(path: str) -> str:
    """A path as a pattern that only it matches."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _with_zip_tags(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(t) for n, t in ZIP_TAGS.items() if n not in df.columns})


def _rename(names: list[str]) -> list[Column]:
    return [F.col(f"c{i}").alias(n) for i, n in enumerate(names)]


def _cells_schema(width: int, lenient: bool = False) -> T.StructType:
    names = [*[f"c{i}" for i in range(width)], *[CORRUPT] * lenient]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _check_names(names: list[str]) -> None:
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise ValueError(f"Header repeats column names: {sorted(repeated)}")


def with_path(df: DataFrame, encoded: bool) -> DataFrame:
    """Add the plain path; scans report it encoded, unpacked lines do not."""
    return df.withColumn("_path", decoded_path(F.col("_fp")) if encoded else F.col("_fp"))


# -- plain CSV ---------------------------------------------------------------


def read_plain(spark: SparkSession, paths: list[str], names: list[str], fmt: TextFormat, tord: int, lenient: bool = False) -> DataFrame:
    """Splittable CSV scan of files that share one header."""
    reader = spark.read.schema(_cells_schema(len(names), lenient)).options(**fmt.csv_options(lenient))
    reader = reader.option("header", str(fmt.has_header).lower()).option("encoding", fmt.encoding)
    df = ordinal.tag_scan(reader.csv(paths), tord)
    return _with_zip_tags(df.select(*_rename(names), *[CORRUPT] * lenient, *TAGS))


# -- line-wise ---------------------------------------------------------------


def text_lines(spark: SparkSession, paths: list[str], fmt: TextFormat, tord: int) -> DataFrame:
    """Tagged lines of text files, numbered within their task."""
    value = F.col("value") if fmt.utf8 else F.decode(F.col("value").cast("binary"), fmt.encoding)
    df = ordinal.tag_scan(spark.read.text(paths), tord).withColumn("value", value)
    return _with_zip_tags(df).withColumn("_mid", F.monotonically_increasing_id())


def _overlap(low: Column, high: Column) -> Column:
    """Lines of a split that fall into [low, high)."""
    end = F.least(F.col("_foff") + F.col("_n"), high)
    return F.greatest(F.lit(0).cast("bigint"), end - F.greatest(F.col("_foff"), low))


def data_lines(
    lines: DataFrame, starts: DataFrame, fmt: TextFormat, keep_order: bool, decorate: ordinal.Decorate | None = None
) -> Scan:
    """Cut preamble, trailer, sections and blank lines.

    ``starts`` has ``_path`` and ``_start`` (line number of the first data
    line) plus columns to carry over to the rows.
    """
    trimmed = F.regexp_replace("value", r"\s+$", "")
    extra = [F.count_if(F.col("value") == "").alias("_blank")]
    if fmt.sectioned:
        mark = F.when(trimmed.isin(heads.START_DATA, heads.END_DATA), F.struct("_mid", trimmed.alias("kind")))
        extra.append(F.collect_list(mark).alias("_marks"))
    counted = lines.groupBy(*ordinal.SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"), *extra)
    splits = ordinal.running_offsets(counted, "_n", "split-counts")
    splits = with_path(splits, encoded=keep_order).join(starts, "_path", "left")
    if decorate:
        splits = decorate(splits)
    start, stop = F.col("_start"), F.col("_file_rows") - fmt.skipfooter
    if fmt.sectioned:
        sections = materialize(_sections(splits), "sections")
        splits = splits.drop("_marks", "_start").join(sections, ["_tord", "_fp"], "left")
        low, high = F.col("_spans")[0]["low"], F.col("_spans")[0]["high"]
    else:
        low, high = start, stop
    splits = splits.withColumns({"_kept": _overlap(low, high), "_low": low, "_high": high})
    splits = materialize(splits.drop("_goff"), "split-lines")

    facts = splits.agg(F.sum("_blank"), F.max(F.size("_spans")) if fmt.sectioned else F.lit(1)).first()
    simple = not facts[0] and (facts[1] or 1) <= 1
    if simple:
        # Without blank lines the kept rows of a split follow from its range,
        # so the row numbers need no further pass over the data.
        tiny = splits.select(*ordinal.SPLIT, "_kept")
        numbers = ordinal.running_offsets(tiny, "_kept", "kept-counts")
        numbers = numbers.select(
            *ordinal.SPLIT, F.col("_goff").alias("_gkept"), F.col("_foff").alias("_fkept")
        )
        splits = materialize(splits.join(numbers, ordinal.SPLIT), "split-numbers")

    joined, small = ordinal.join_offsets(lines, splits)
    joined = joined.withColumn("_line", F.col("_foff") + F.col("_at"))
    line = F.col("_line")
    if fmt.sectioned and not simple:
        keep = F.exists("_spans", lambda s: (line >= s["low"]) & (line < s["high"]))
    else:
        keep = (line >= F.col("_low")) & (line < F.col("_high"))
    if fmt.ignore_empty_lines:
        keep = keep & (F.col("value") != "")
    kept = joined.where(keep)
    if fmt.sectioned:
        kept = kept.withColumn("value", F.regexp_replace("value", r"\s+$", ""))
        kept = kept.withColumn("value", F.regexp_replace("value", r"\|$", ""))
    numbered = []
    if simple:
        inside = line - F.greatest(F.col("_foff"), F.col("_low"))
        kept = kept.withColumns({"_findex": F.col("_fkept") + inside, "_gindex": F.col("_gkept") + inside})
        numbered = NUMBERS
    own = {*lines.columns, *counted.columns, "_goff", "_foff", "_file_rows", "_start", "_spans"}
    carry = [c for c in splits.columns if c not in own and c not in ("_kept", "_low", "_high", "_gkept", "_fkept")]
    df = kept.select("value", *TAGS, *ZIP_TAGS, "_line", *numbered, *carry)
    order = None if small and keep_order else "_line"
    counts = splits.select(*ordinal.SPLIT, F.col("_kept").alias("_n")) if simple else None
    return Scan(df, [], order, counts, decorate is not None)


def _sections(splits: DataFrame) -> DataFrame:
    """Line ranges between data markers, per file; an open one raises."""
    marks = splits.select("_tord", "_fp", "_foff", "_m0", F.explode("_marks").alias("mark")).select(
        "_tord", "_fp", (F.col("_foff") + F.col("mark._mid") - F.col("_m0")).alias("line"), F.col("mark.kind").alias("kind")
    )
    # A few markers per file.
    after = Window.partitionBy("_tord", "_fp").orderBy("line")
    marks = marks.withColumns({"next": F.lead("line").over(after), "closer": F.lead("kind").over(after)})
    opened = marks.where(F.col("kind") == heads.START_DATA)
    high = F.when(F.col("closer") == heads.END_DATA, F.col("next")).otherwise(
        F.raise_error(F.concat(F.lit(f"{heads.END_DATA} is missing in "), F.col("_fp"))).cast("bigint")
    )
    spans = opened.groupBy("_tord", "_fp").agg(
        F.sort_array(F.collect_list(F.struct((F.col("line") + 1).alias("low"), high.alias("high")))).alias("_spans")
    )
    return spans


def parse_lines(scan: Scan, names: list[str], fmt: TextFormat, lenient: bool = False) -> Scan:
    """Lines to named text cells; a line of another width raises, or is kept in ``_corrupt`` if ``lenient``."""
    options = {k: v for k, v in fmt.csv_options(lenient).items() if k != "multiLine"}
    if fmt.newlines_in_values:
        options["lineSep"] = "\u0002"
    row = F.from_csv("value", _cells_schema(len(names), lenient).simpleString()[len("struct<") : -1].replace(":", " "), options)
    tags = [c for c in scan.df.columns if c not in ("value", "names")]
    df = scan.df.withColumn("_row", row)
    cells = [F.col("_row")[f"c{i}"].alias(n) for i, n in enumerate(names)]
    cells += [F.col("_row")[CORRUPT].alias(CORRUPT)] * lenient
    return Scan(df.select(*cells, *tags), names, scan.order, scan.counts, scan.decorated)


def parse_mixed(scan: Scan, wanted: list[str], fmt: TextFormat, widths: list[int], lenient: bool = False) -> Scan:
    """Lines of files with arbitrarily many headers: cells are parsed by the
    header's width and looked up by the header's names."""
    options = {k: v for k, v in fmt.csv_options(lenient).items() if k != "multiLine"}
    cells, corrupt = F.lit(None).cast("array<string>"), F.lit(None).cast("string")
    for width in widths:
        ddl = ", ".join(f"{f.name} string" for f in _cells_schema(width, lenient))
        row = F.from_csv("value", ddl, options)
        parsed = F.array(*[row[f"c{i}"] for i in range(width)])
        cells = F.when(F.size("names") == width, parsed).otherwise(cells)
        if lenient:
            corrupt = F.when(F.size("names") == width, row[CORRUPT]).otherwise(corrupt)
    df = scan.df.withColumn("_cells", F.map_from_arrays("names", cells))
    tags = [c for c in scan.df.columns if c not in ("value", "names")]
    picked = [
        F.when(F.array_contains("names", n), F.coalesce(F.try_element_at("_cells", F.lit(n)), F.lit(""))).alias(n) for n in wanted
    ]
    picked += [corrupt.alias(CORRUPT)] * lenient
    return Scan(df.select(*picked, *tags), wanted, scan.order, scan.counts, scan.decorated, sparse=True)


# -- choosing ----------------------------------------------------------------


def scan_text(
    inventory: DataFrame,
    fmt: TextFormat,
    schema: T.StructType,
    template_ord: int = 0,
    extra: str = "raise",
    decorate: ordinal.Decorate | None = None,
    glob: str | None = None,
    refused: list[DataFrame] | None = None,
) -> list[Scan]:
    """Text scans covering all files of ``inventory``.

    Checks every file's header against ``schema`` before anything is read:
    missing required columns and unknown extra ones raise. ``glob`` names the
    same files, if there is one that does. With a list ``refused`` nothing raises:
    it gets a table of such files (``path, message``), the scans cover the others,
    and records of a wrong width are kept in ``_corrupt``.
    """
    from rawlake.operators.schema import check_headers, refused_headers

    lenient = refused is not None

    spark = inventory.sparkSession
    peeked = heads.peek(
        inventory, fmt.skip_rows, fmt.skip_rows_after_names, fmt.has_header,
        fmt.delimiter, fmt.quote_char, fmt.encoding, fmt.sectioned,
        keep=fmt.skip_rows + 1 if fmt.autogenerate_column_names else 0,
        joined=fmt.newlines_in_values, escape=fmt.escape_char, lenient=lenient,
    )
    if fmt.column_names:
        peeked = peeked.withColumn("names", F.array(*[F.lit(n) for n in fmt.column_names]))
    elif fmt.autogenerate_column_names:
        width = F.size(F.split(F.element_at("head", fmt.skip_rows + 1), f"\\Q{fmt.delimiter}\\E", -1))
        peeked = peeked.withColumn(
            "names", F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.concat(F.lit("f"), i.cast("string")))
        )
    heads_of = materialize(peeked, "heads")
    peeked = heads_of.where(F.col("names").isNotNull())  # files without any line
    if lenient:
        unread = heads_of.where(F.col("failure").isNotNull()).select("path", F.col("failure").alias("message"))
        out = materialize(unread.unionByName(refused_headers(peeked, schema, extra)), "refused")
        refused.append(out)
        if not out.isEmpty():
            peeked, glob = materialize(peeked.join(out, "path", "left_anti"), "heads"), None
    else:
        check_headers(peeked, schema, extra)

    groups = heads.header_groups(peeked, MAX_HEADERS)
    packed = peeked.where(F.col("codec").isNotNull())
    has_packed = not packed.isEmpty()
    plain = peeked.where(F.col("codec").isNull())
    by_line = fmt.by_line or (groups is None and not fmt.newlines_in_values)
    scans: list[Scan] = []

    if groups is not None and len(groups) == 0:
        return []
    if fmt.newlines_in_values and (fmt.quote_char or fmt.by_line or groups is None) or fmt.by_line and fmt.wide:
        packed, has_packed, plain = peeked, True, peeked.limit(0)

    if has_packed:
        # Spark reads some codecs itself, so a null alone does not say that a file is plain.
        coded = F.col("path").contains("|") | F.lower("path").rlike(r"\.(gz|bz2|xz|lzma)$")
        codec = F.when(F.col("codec") == "plain", None).otherwise(F.coalesce("codec", F.when(coded, "suffix"))).alias("codec")
        chosen = inventory.join(packed.select("path", codec), "path")
        quote = fmt.quote_char if fmt.newlines_in_values else None
        lines = archive.unpack_lines(chosen, template_ord, fmt.encoding, quote, fmt.escape_char)
        scans += _parse_groups(lines, packed, fmt, schema, groups, False, decorate, lenient)
    if by_line:
        if not plain.isEmpty():
            paths = [glob] if glob and not has_packed else path_list(plain)
            lines = text_lines(spark, paths, fmt, template_ord)
            scans += _parse_groups(lines, plain, fmt, schema, groups, True, decorate, lenient)
        return scans
    for group in groups or []:
        _check_names(group["names"])
        members = plain.where(F.col("names") == F.array(*[F.lit(n) for n in group["names"]]))
        paths = [glob] if glob and len(groups) == 1 and not has_packed else path_list(members)
        if paths:
            scans.append(Scan(read_plain(spark, paths, group["names"], fmt, template_ord, lenient), group["names"]))
    return scans


def _parse_groups(
    lines: DataFrame, peeked: DataFrame, fmt: TextFormat, schema: T.StructType, groups: list | None, keep_order: bool,
    decorate: ordinal.Decorate | None, lenient: bool = False,
) -> list[Scan]:
    starts = peeked.select(F.col("path").alias("_path"), F.col("data_start").alias("_start"), "names")
    single = groups is not None and len(groups) == 1
    scan = data_lines(lines, starts.drop("names") if single else starts, fmt, keep_order, decorate)
    if single:
        _check_names(groups[0]["names"])
        return [parse_lines(scan, groups[0]["names"], fmt, lenient)]
    widths = sorted(r[0] for r in peeked.select(F.size("names")).distinct().collect())
    # Without a schema, all columns that any header names.
    wanted = [f.name for f in schema] or sorted(r[0] for r in peeked.select(F.explode("names")).distinct().collect())
    return [parse_mixed(scan, wanted, fmt, widths, lenient)]


def union_scans(scans: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


# -- Parquet -----------------------------------------------------------------


def footers(files: DataFrame, lenient: bool = False) -> DataFrame:
    """Column names and types, stored schema and number of rows of every Parquet file, read in tasks.

    A file without a sound footer raises; if ``lenient``, ``failure`` tells why.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([tried(p) for p in batch["path"]], columns=["path", "names", "types", "stored", "rows", "failure"])

    def tried(path: str) -> tuple:
        try:
            with remote.open_input(path) as file:
                found = pq.ParquetFile(file)
                fields = found.schema_arrow
                types = [str(fields.field(i).type) for i in range(len(fields.names))]
                return path, fields.names, types, str(found.schema).partition("\n")[2], found.metadata.num_rows, None
        except Exception as e:
            if not lenient:
                raise
            return path, None, None, None, 0, f"{type(e).__name__}: {e}"

    width = files.sparkSession.sparkContext.defaultParallelism
    schema = "path string, names array<string>, types array<string>, stored string, rows bigint, failure string"
    return files.select("path").repartition(width, "path").mapInPandas(read, schema)


def scan_parquet(
    files: DataFrame,
    paths: list[str] | None,
    schema: T.StructType,
    template_ord: int = 0,
    extra: str = "raise",
    refused: list[DataFrame] | None = None,
) -> list[Scan]:
    """Parquet scan by column name, of ``paths`` or, if there are none, of ``files`` one by one.

    Every file must have the required columns with the manifest's types or ones that widen
    to them exactly; an optional column may lack in some files and is null there.
    Columns beyond the manifest raise unless ``extra`` is ``drop``. With a list ``refused``
    nothing raises: it gets a table of such files (``path, message``), and the scan covers the others.
    """
    from rawlake.operators.schema import check_headers, refused_headers

    spark, lenient = files.sparkSession, refused is not None
    stored = materialize(footers(files, lenient), "footers")
    sound = stored.where(F.col("failure").isNull()) if lenient else stored
    groups: dict[tuple, dict[str, set[T.DataType]]] = {}
    members: list[tuple[str, int]] = []
    wrong: list[tuple[str, str]] = []
    # One look by Spark per distinct stored schema.
    for example in sound.groupBy("stored").agg(F.min("path").alias("path")).orderBy("path").collect():
        found = spark.read.parquet(escaped(example["path"])).schema
        odd = [
            f"column '{f.name}' is {f.dataType.simpleString()}, not {schema[f.name].dataType.simpleString()}"
            for f in found if f.name in schema.names and f.dataType != schema[f.name].dataType and not _widens(f.dataType, schema[f.name].dataType)
        ]
        if odd and not lenient:
            raise ValueError(f"{odd[0][0].upper()}{odd[0][1:].replace(' is ', f" of '{example['path']}' is ", 1)}")
        if odd:
            wrong.append((example["stored"], odd[0]))
            continue
        # What a reader widens itself can be read together, other types apart.
        key = tuple(sorted(f.name for f in found if f.name in schema.names and _apart(f.dataType, schema[f.name].dataType)))
        have = groups.setdefault(key, {})
        members.append((example["stored"], list(groups).index(key)))
        for f in found:
            have.setdefault(f.name, set()).add(f.dataType)
    if lenient:
        odd = sound.join(spark.createDataFrame(wrong, "stored string, message string"), "stored").select("path", "message")
        unread = stored.where(F.col("failure").isNotNull()).select("path", F.col("failure").alias("message"))
        out = unread.unionByName(odd).unionByName(refused_headers(sound, schema, extra)).groupBy("path").agg(F.min("message").alias("message"))
        out = materialize(out, "refused")
        refused.append(out)
        if not out.isEmpty():
            sound, paths = sound.join(out, "path", "left_anti"), None
    else:
        check_headers(stored, schema, extra)
    scans = []
    numbered = sound.join(spark.createDataFrame(members, "stored string, member int"), "stored")
    for k, have in enumerate(groups.values()):
        own = numbered.where(F.col("member") == k) if len(groups) > 1 else sound
        of_group = path_list(own) if paths is None or len(groups) > 1 else paths
        if not of_group:
            continue
        fields = [T.StructField(f.name, next(iter(have[f.name])) if len(have[f.name]) == 1 else f.dataType) for f in schema if f.name in have]
        raw = spark.read.schema(T.StructType(fields)).parquet(*of_group)
        df = _with_zip_tags(ordinal.tag_scan(raw, template_ord)).withColumn("_findex", F.col("_metadata.row_index"))
        scans.append(Scan(df, raw.columns, files=_parquet_files(own, of_group, template_ord)))
    return scans


def _parquet_files(stored: DataFrame, paths: list[str], template_ord: int) -> DataFrame | None:
    """Rows of every file by the path its scan reports, from the footers read already."""
    spark = stored.sparkSession
    named = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("_fp"), plain_path(F.col("path")).alias("path"))
    split = [F.lit(template_ord).alias("_tord"), "_fp", F.lit(0).cast("bigint").alias("_bs")]
    files = materialize(named.join(stored.select("path", F.col("rows").alias("_n")), "path").select(*split, "_n"), "file-rows")
    # A path that is spelled in another way than expected must not leave rows without a number.
    return files if files.count() == stored.count() else None


def _apart(have: T.DataType, want: T.DataType) -> bool:
    """Whether only a cast of one's own makes one of the other."""
    return isinstance(want, T.DoubleType) and isinstance(have, T.LongType)


def _widens(have: T.DataType, want: T.DataType) -> bool:
    """Widenings a Parquet column may take to its manifest type (whole numbers beyond 2^53 raise on the way to a double)."""
    if isinstance(want, T.LongType):
        return isinstance(have, (T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(want, T.DoubleType):
        return isinstance(have, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return have.elementType == want.elementType or _widens(have.elementType, want.elementType) and not _apart(have.elementType, want.elementType)
    return False
