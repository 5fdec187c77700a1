"""Raw files for tests and example queries, written by tasks from a DataFrame.

Only these need files of exact names and codecs; ingestion itself never writes
text. Rows are put in order by ranges of bounded size, so a task's work does not
grow with a file: each writes the parts of files that lie in its range, and tasks
then put the parts into their places. Archives, and stores in which nothing can be
written at a place, take one stream per file.
"""

from __future__ import annotations

import bz2
import gzip
import lzma
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawlake.session import materialize, measured_bytes
from rawlake.sources import remote

# A task puts rows of about this size in order, as measured in memory, and of FULLEST times it at most.
PART_BYTES = 64 << 20
FULLEST = 4

_WRITERS = {"gzip": gzip.open, "bz2": bz2.open, "xz": lzma.open}
_PARTS = "path string, part int, place string, size bigint, head bigint, tail bigint"
_CHUNK = 4 << 20


def stage_lines(
    rows: DataFrame,
    root: str,
    path: Column,
    line: Column,
    order: list[Column],
    head: Column | None = None,
    tail: Column | None = None,
    codec: str | None = "suffix",
    encoding: str = "utf-8",
) -> int:
    """Write ``line`` of every row to the file ``root/path``, in ``order``, which tells rows apart.

    ``head`` and ``tail`` are texts put around the rows of each file. A path
    ``x.zip|member`` goes into an archive. Returns the number of files.
    """
    root = root.rstrip("/")
    width = rows.sparkSession.sparkContext.defaultParallelism
    streamed = int(rows.sparkSession.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    tasks = _ranges(measured_bytes(rows), width, streamed)
    keys = {"_path": path, **{f"_order{i}": c for i, c in enumerate(order)}}
    ordered = rows.withColumns(keys).repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    texts = [(F.lit("") if text is None else text).alias(name) for name, text in (("head", head), ("tail", tail))]
    writer = _Parts(f"{root}-parts-{uuid.uuid4().hex}", codec, encoding)
    parts = materialize(ordered.select("_path", line.alias("line"), *texts).mapInArrow(writer.write, _PARTS), "staged-parts")
    placed = materialize(_placed(parts, root), "staged-places")

    single = F.col("target").contains("|") if remote.writes_in_place(root) else F.lit(True)
    whole = placed.where(single).repartition(width, F.substring_index("target", "|", 1)).sortWithinPartitions("target", "part")
    whole.mapInArrow(_write_streams, "place string").write.format("noop").mode("overwrite").save()
    many = max(1, min(placed.count(), 100_000))
    placed.where(~single).repartition(many, "place").mapInArrow(_write_places, "place string").write.format("noop").mode("overwrite").save()
    remote.delete(writer.folder)
    return placed.select("target").distinct().count()


def _ranges(size: int, width: int, streamed: int) -> int:
    """Into how many ranges rows of ``size`` bytes go. Spark writes rows to ``streamed`` ranges or fewer as they
    come, but for more a task gathers all it has read, so parts get fuller before there are more of them."""
    many = -(-size // PART_BYTES)
    if many > streamed:
        many = max(streamed, -(-size // (FULLEST * PART_BYTES)))
    return max(1, min(width, size >> 20), many)


def _placed(parts: DataFrame, root: str) -> DataFrame:
    """What of each part goes where: only the first of a file keeps its head, only the last its tail."""
    # One row for each task that has rows of a file.
    file = Window.partitionBy("path")
    first, last = F.col("part") == F.min("part").over(file), F.col("part") == F.max("part").over(file)
    begin = F.when(first, F.lit(0)).otherwise(F.col("head")).cast("bigint")
    end = F.when(last, F.col("size")).otherwise(F.col("size") - F.col("tail"))
    cut = parts.withColumns({"begin": begin, "end": end, "alone": first & last})
    before = file.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.col("end") - F.col("begin")).over(before), F.lit(0).cast("bigint"))
    return cut.select(F.concat(F.lit(root + "/"), F.col("path")).alias("target"), "part", "place", "begin", "end", at.alias("at"), "alone", last.alias("last"))


def _read(row: dict) -> Iterator[bytes]:
    with remote.open_input(row["place"]) as file:
        file.seek(row["begin"])
        left = row["end"] - row["begin"]
        while left:
            data = file.read(min(left, _CHUNK))
            left -= len(data)
            yield data


def _write_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            if not row["alone"]:
                with remote.open_place(row["target"], row["at"]) as file:
                    for data in _read(row):
                        file.write(data)
                    if row["last"]:
                        file.truncate()  # of what stood there before
            elif remote.exists(row["place"]):  # a task that runs again has moved it
                remote.move(row["place"], row["target"])
        yield pa.RecordBatch.from_arrays([batch.column("place")], names=["place"])


def _write_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order, as whole files or members of archives, one open at a time."""
    target = outer = raw = archive = stream = None

    def end(archive_too: bool) -> None:
        if archive is not None and stream is not None:
            stream.close()
        if raw is not None and archive_too:
            if archive is not None:
                archive.close()
            raw.close()

    for batch in batches:
        for row in batch.to_pylist():
            if row["target"] != target:
                name, bar, member = row["target"].partition("|")
                end(name != outer)
                if name != outer:
                    raw = remote.open_output(name)
                    archive = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) if bar else None
                stream = archive.open(member, "w") if bar else raw
                target, outer = row["target"], name
            for data in _read(row):
                stream.write(data)
        yield pa.RecordBatch.from_arrays([batch.column("place")], names=["place"])
    end(True)


class _Parts:
    """Writes the rows a task has of each file to a file of their own."""

    def __init__(self, folder: str, codec: str | None, encoding: str) -> None:
        self.folder, self.codec, self.encoding = folder, codec, encoding

    def write(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, attempt = context.partitionId(), context.taskAttemptId()
        done, open_part = [], None
        for batch in batches:
            paths = pc.run_end_encode(batch.column(0))
            lines, start = batch.column(1).to_pylist(), 0
            for path, stop in zip(paths.values.to_pylist(), paths.run_ends.to_pylist()):
                if open_part is None or path != open_part.path:
                    if open_part is not None:
                        done.append((open_part.path, number, open_part.place, *open_part.close()))
                    head, tail = batch.column(2)[start].as_py(), batch.column(3)[start].as_py()
                    open_part = _Part(path, f"{self.folder}/{number}-{attempt}-{len(done)}", self._codec(path), self.encoding, head, tail)
                open_part.put(lines[start:stop])
                start = stop
        if open_part is not None:
            done.append((open_part.path, number, open_part.place, *open_part.close()))
        types = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["path", "part", "place", "size", "head", "tail"]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=names)

    def _codec(self, path: str) -> str | None:
        if "|" in path:
            return None
        return remote.suffix_codec(path) if self.codec == "suffix" else self.codec


class _Part:
    """A part being written. Head, lines and tail are streams of their own in a compressed file."""

    def __init__(self, path: str, place: str, codec: str | None, encoding: str, head: str, tail: str) -> None:
        self.path, self.place, self.codec, self.encoding, self.tail = path, place, codec, encoding, tail
        self.raw = remote.open_output(place)
        self.head_bytes = self._alone(head)
        self.stream = self._stream()

    def _stream(self):
        return _WRITERS[self.codec](self.raw, "wb") if self.codec else self.raw

    def _alone(self, text: str) -> int:
        before = self.raw.tell()
        if text:
            self.stream = self._stream()
            self.put([text])
            self._end_stream()
        return self.raw.tell() - before

    def _end_stream(self) -> None:
        if self.stream is not self.raw:
            self.stream.close()

    def put(self, lines: list[str]) -> None:
        self.stream.write(("\n".join(lines) + "\n").encode(self.encoding))

    def close(self) -> tuple[int, int, int]:
        """Bytes of the part, and of its head and tail."""
        self._end_stream()
        tail_bytes = self._alone(self.tail)
        size = self.raw.tell()
        self.raw.close()
        return size, self.head_bytes, tail_bytes


def csv_line(*cells: Column, sep: str = ",") -> Column:
    """CSV text of a row: null is empty, text is quoted where it has to be."""
    out = []
    for cell in cells:
        text = cell.cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        needs = text.rlike(rf'[\n\r"]') | text.contains(sep) | (text == "")
        out.append(F.coalesce(F.when(needs, quoted).otherwise(text), F.lit("")))
    return F.concat_ws(sep, *out)
