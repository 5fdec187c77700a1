"""First lines of every file: headers, preambles, codecs.

One streaming open per file in a task; files are never read past the lines
asked for, so the cost follows the number of files, not their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.sources import remote

HEAD_SCHEMA = (
    "path string, codec string, head array<string>, names array<string>, data_start bigint, failure string"
)

# Markers and leading columns of sectioned files.
START_FIELDS, END_FIELDS = "START-OF-FIELDS", "END-OF-FIELDS"
START_DATA, END_DATA = "START-OF-DATA", "END-OF-DATA"
LEADING_FIELDS = ["sec_desc", "rcode", "nfields"]


def suffix_repeats(names: list[str]) -> list[str]:
    """Make repeated names unique by their occurrence: ``x, x_1, x_2``."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        count = seen.get(name, 0)
        seen[name] = count + 1
        out.append(f"{name}_{count}" if count else name)
    return out


def _section_fields(lines: Iterator[str]) -> tuple[list[str], int]:
    names, inside = list(LEADING_FIELDS), False
    for at, line in enumerate(lines):
        line = line.rstrip()
        if line == START_DATA:
            return suffix_repeats(names), at + 1
        if line in (START_FIELDS, END_FIELDS):
            inside = line == START_FIELDS
        elif inside and line and not line.startswith("#"):
            names.append(line)
    raise ValueError(f"no {START_DATA} line")


def peek(
    inventory: DataFrame,
    skip: int = 0,
    skip_after: int = 0,
    has_header: bool = True,
    delimiter: str = ",",
    quote: str | None = '"',
    encoding: str = "utf-8",
    sectioned: bool = False,
    keep: int = 0,
    joined: bool = False,
    escape: str | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Per file: codec, the first ``keep`` lines, header names, and the line
    number at which data begins. With ``joined`` a line is a whole CSV record.
    A file that cannot be read so far raises; if ``lenient``, ``failure`` tells why."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([tried(p) for p in batch["path"]], columns=columns)

    def tried(path: str) -> tuple:
        try:
            return (*one(path), None)
        except Exception as e:
            if not lenient:
                raise
            return path, None, [], None, 0, f"{type(e).__name__}: {e}"

    def one(path: str) -> tuple:
        stream, codec = remote.open_decoded(path)
        stream.close()
        if codec in ("gzip", "bz2") and remote.suffix_codec(path) == codec and "|" not in path:
            codec = None  # the suffix tells Spark all it needs
        elif codec is None and remote.suffix_codec(path):
            codec = "plain"
        head: list[str] = []

        def kept() -> Iterator[str]:
            physical = remote.lines(path, encoding)
            for line in remote.records(physical, quote, escape) if joined and quote else physical:
                if len(head) < keep:
                    head.append(line)
                yield line

        names, start, stream_lines = None, skip, kept()
        if sectioned:
            names, start = _section_fields(stream_lines)
        elif has_header:
            for at, line in enumerate(stream_lines):
                if at >= skip and line:
                    names, start = remote.csv_cells(line, delimiter, quote, escape), at + 1
                    break
        while len(head) < keep and next(stream_lines, None) is not None:
            pass
        return path, codec, head, names, start + skip_after

    columns = ["path", "codec", "head", "names", "data_start", "failure"]
    width = inventory.sparkSession.sparkContext.defaultParallelism
    return inventory.select("path").repartition(width, "path").mapInPandas(read, HEAD_SCHEMA)


def header_groups(heads: DataFrame, limit: int) -> list | None:
    """Distinct headers with their file counts, or None beyond ``limit``."""
    groups = heads.groupBy("names").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("example"))
    rows = groups.orderBy("example").limit(limit + 1).collect()
    return rows if len(rows) <= limit else None
