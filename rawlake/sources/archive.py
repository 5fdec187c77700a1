"""Text files Spark cannot split or decode: zip members, xz, wrong suffixes.

Each file or member is streamed once, by one task, into a table of lines in the
shared folder. From there on it is splittable, so parsing, counting and lineage
run at full width however large a single archive is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from rawlake.session import materialize
from rawlake.sources import records, remote

BATCH_LINES = 20_000
CHUNK_LINES = 500_000

FACTS = ["file_mtime", "file_size", "zfile_name", "zfile_mtime", "zfile_size", "zfile_compress_size"]

LINES_SCHEMA = (
    "_tord int, _fp string, _bs bigint, _mid bigint, value string, _mtime timestamp, _size bigint, "
    "_zname string, _zmtime timestamp, _zsize bigint, _zcsize bigint"
)


def unpack_lines(
    inventory: DataFrame,
    template_ord: int = 0,
    encoding: str = "utf-8",
    join_quoted: str | None = None,
    escape: str | None = None,
) -> DataFrame:
    """Numbered lines of all files of ``inventory``, as a written table.

    With ``join_quoted`` (a quote character) a line is a whole CSV record. Files that a
    column ``codec`` calls uncompressed (null) are then cut in ranges of bytes.
    """
    if join_quoted and "codec" in inventory.columns and records.cuttable(encoding, join_quoted, escape):
        whole = inventory.where("codec IS NULL").drop("codec")
        packed = inventory.where("codec IS NOT NULL").drop("codec")
        if not whole.isEmpty():
            lines = materialize(records.cut(whole, LINES_SCHEMA, template_ord, encoding, join_quoted, escape), "records")
            return lines if packed.isEmpty() else lines.unionByName(unpack_lines(packed, template_ord, encoding, join_quoted, escape))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from one(row)

    def one(row: dict) -> Iterator[pa.RecordBatch]:
        lines = remote.lines(row["path"], encoding)
        if join_quoted:
            lines = remote.records(lines, join_quoted, escape)
        start, held = 0, []
        for line in lines:
            held.append(line)
            if len(held) == BATCH_LINES:
                yield table(row, start, held)
                start, held = start + len(held), []
        if held:
            yield table(row, start, held)

    def table(row: dict, start: int, held: list[str]) -> pa.RecordBatch:
        n = len(held)
        numbers = pa.array(range(start, start + n), pa.int64())
        facts = [pa.repeat(pa.scalar(row[f], types[f]), n) for f in FACTS]
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(template_ord, pa.int32()), n),
                pa.repeat(row["path"], n),
                pa.repeat(pa.scalar(start // CHUNK_LINES, pa.int64()), n),
                numbers,
                pa.array(held, pa.string()),
                *facts,
            ],
            names=["_tord", "_fp", "_bs", "_mid", "value", "_mtime", "_size", "_zname", "_zmtime", "_zsize", "_zcsize"],
        )

    stamp = pa.timestamp("us", "UTC")
    types = {
        "file_mtime": stamp, "file_size": pa.int64(), "zfile_name": pa.string(),
        "zfile_mtime": stamp, "zfile_size": pa.int64(), "zfile_compress_size": pa.int64(),
    }
    # One file per task where there are enough tasks; big files do not queue
    # behind each other.
    files = inventory.select("path", *FACTS)
    width = max(files.sparkSession.sparkContext.defaultParallelism, min(files.count(), 10_000))
    lines = files.repartition(width, "path").mapInArrow(unpack, LINES_SCHEMA)
    return materialize(lines, "lines")
