"""CSV records with line breaks in quoted cells, cut in one task per byte range.

Whether a range begins within a quoted cell shows only from all that stands
before it. But a quote is all that changes this, so each range is read once for
both cases: whether it has an odd number of quotes, and how many records begin
in it either way. Running sums over these few numbers tell each range how it
begins and what number its first record has. A second reading cuts the records:
each range gives those that begin in it, read on to their ends.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.operators import ordinal
from rawlake.session import materialize
from rawlake.sources import remote

CHUNK = 4 << 20  # bytes looked at together
RECORD_BYTES = 256 << 20  # a longer record raises: most likely a quote is missing

_FACTS = ["file_mtime", "file_size", "zfile_name", "zfile_mtime", "zfile_size", "zfile_compress_size"]


def single_bytes(encoding: str, *marks: str | None) -> bool:
    """Whether ``marks`` and line ends are single bytes that occur in no other character of the encoding."""
    name = codecs.lookup(encoding).name
    narrow = name in ("utf-8", "ascii", "utf-8-sig") or name.startswith(("iso8859", "cp125", "koi8"))
    return narrow and _marks(marks)


# Every character takes whole units, and no unit of a longer one is that of a mark or line end.
_UNITS = {"utf-16-le": "<u2", "utf-16-be": ">u2", "utf-32-le": "<u4", "utf-32-be": ">u4"}


def cuttable(encoding: str, *marks: str | None) -> bool:
    """Whether ``marks`` and line ends are single bytes, or units of known order, of no other character."""
    return single_bytes(encoding, *marks) or (codecs.lookup(encoding).name in _UNITS and _marks(marks))


def _marks(marks: tuple[str | None, ...]) -> bool:
    return all(m is None or (len(m) == 1 and m.isascii()) for m in marks)


def range_bytes(spark) -> int:
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    units = {"b": 1, "kb": 1 << 10, "k": 1 << 10, "mb": 1 << 20, "m": 1 << 20, "gb": 1 << 30, "g": 1 << 30}
    number = size.rstrip("bkmg")
    return max(1, int(number) * units.get(size[len(number) :] or "b", 1))


def cut(
    files: DataFrame, schema: str, template_ord: int, encoding: str, quote: str, escape: str | None = None, width: int | None = None
) -> DataFrame:
    """Numbered records of uncompressed files, as a frame of tagged lines (``schema``).

    ``files`` has ``path`` and the facts of an inventory. Ranges take ``width`` bytes, by
    default ``spark.sql.files.maxPartitionBytes``, rounded down to whole units; records do not depend on it. A doubled
    quote closes and opens again; an ``escape`` character hides the one behind it within
    its line. A quote that is open at the end of a file raises, naming file and line, and so
    does a record longer than ``RECORD_BYTES``.
    """
    spark = files.sparkSession
    look = _Look(width or range_bytes(spark), encoding, quote, escape)
    width = look.width
    begins = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("file_size") - 1, F.lit(0)), F.lit(width).cast("bigint")))
    ranges = files.select("path", *_FACTS, begins.alias("begin"))
    # Neighbours in a file are far apart in tasks, so big files do not queue behind each other.
    many = files.agg(F.sum(F.ceil(F.col("file_size") / width))).first()[0] or 0
    many = max(spark.sparkContext.defaultParallelism, min(many, 100_000))
    ranges = materialize(ranges.repartition(many, "path", "begin"), "byte-ranges")
    facts = ranges.mapInPandas(look.facts, "path string, begin bigint, odd bigint, outside bigint, inside bigint, ends bigint, last_outside bigint, last_inside bigint")
    split = [F.lit(template_ord).alias("_tord"), F.col("path").alias("_fp"), F.col("begin").alias("_bs")]
    facts = materialize(facts.select(*split, "odd", "outside", "inside", "ends", "last_outside", "last_inside"), "range-facts")
    states = ordinal.running_offsets(facts, "odd", "range-states")
    within = F.col("_foff") % 2 == 1
    number = F.when(within, F.col("inside")).otherwise(F.col("outside")).alias("_n")
    last = F.when(within, F.col("last_inside")).otherwise(F.col("last_outside")).alias("last")
    states = states.select(*ordinal.SPLIT, within.alias("within"), number, "ends", last, (F.col("_file_rows") % 2 == 1).alias("open"))
    states = materialize(states, "range-beginnings")
    broken = states.where("open").agg(F.min("_fp")).first()[0]
    if broken is not None:
        _raise_open(states.where(F.col("_fp") == broken), broken)
    numbered = ordinal.running_offsets(states, "_n", "range-records").where("_n > 0")
    numbered = numbered.select(F.col("_fp").alias("path"), F.col("_bs").alias("begin"), "within", F.col("_foff").alias("first"))
    todo = ranges.join(numbered, ["path", "begin"]).select("path", *_FACTS, "begin", "within", "first")
    # The table is small, whatever its ranges hold: joined rows may have come together in one task.
    return todo.repartition(many, "path", "begin").mapInArrow(look.records(template_ord), schema)


def _raise_open(states: DataFrame, path: str) -> None:
    lines = ordinal.running_offsets(states, "ends", "range-lines")
    at = lines.where("last >= 0").orderBy(F.col("_bs").desc()).first()
    line = at["_foff"] + at["last"] + 1 if at is not None else 1
    raise ValueError(f"A quote in the record that begins in line {line} of '{path}' is never closed")


class _Look:
    """How bytes of one layout are read."""

    def __init__(self, width: int, encoding: str, quote: str, escape: str | None) -> None:
        self.encoding, self.quote = encoding, ord(quote)
        self.escape = ord(escape) if escape and escape != quote else None
        self.kind = np.dtype(_UNITS.get(codecs.lookup(encoding).name, "u1"))
        self.unit = self.kind.itemsize  # bytes
        self.width, self.chunk = (max(1, n // self.unit) * self.unit for n in (width, CHUNK))

    def _units(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.kind, len(data) // self.unit)

    def chunks(self, file, begin: int, size: int) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
        """From ``begin`` on: place and bytes, and where in them quotes and line ends begin."""
        at, run = begin, self._escapes_before(file, begin)
        while at < size:
            file.seek(at)
            data = file.read(self.chunk + self.unit)
            ahead = self._units(data[self.chunk :])
            data = data[: self.chunk]
            values = self._units(data)
            feeds, returns = values == 10, values == 13
            # A line feed behind a return is one end with it: that of the line feed.
            following = np.append(feeds[1:], ahead == 10 if len(ahead) else False)[: len(values)]
            ends = np.flatnonzero(feeds | (returns & ~following))
            quotes = np.flatnonzero(values == self.quote)
            if self.escape is not None:
                quotes, run = self._unescaped(values, quotes, run)
            yield at, data, quotes * self.unit, ends * self.unit
            at += len(data)

    def _escapes_before(self, file, begin: int) -> int:
        """How many escape characters in a row stand right before ``begin``."""
        run = 0
        while self.escape is not None and begin - run * self.unit > 0:
            step = min(4096, begin - run * self.unit)
            file.seek(begin - run * self.unit - step)
            others = np.flatnonzero(self._units(file.read(step)) != self.escape)
            if len(others):
                run += step // self.unit - 1 - int(others[-1])
                break
            run += step // self.unit
        return run

    def _unescaped(self, values: np.ndarray, quotes: np.ndarray, run: int) -> tuple[np.ndarray, int]:
        others = np.flatnonzero(values != self.escape)
        # The last byte before each quote that is no escape character; what lies between hides each other in pairs.
        at = np.searchsorted(others, quotes) - 1
        before = np.where(at >= 0, others[np.maximum(at, 0)], -1 - run) if len(others) else np.full(len(quotes), -1 - run)
        after = len(values) - 1 - int(others[-1]) if len(others) else run + len(values)
        return quotes[(quotes - 1 - before) % 2 == 0], after

    def _ended_before(self, file, begin: int) -> bool:
        """Whether a line end stands right before ``begin``."""
        if begin == 0:
            return False
        file.seek(begin - self.unit)
        pair = self._units(file.read(2 * self.unit)).tolist()
        return pair[:1] == [10] or (pair[:1] == [13] and pair[1:] != [10])

    def facts(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, begin in zip(batch["path"], batch["begin"].tolist()):
                with remote.open_input(path) as file:
                    found.append((path, begin, *self._facts(file, begin)))
            yield pd.DataFrame(found, columns=["path", "begin", "odd", "outside", "inside", "ends", "last_outside", "last_inside"])

    def _facts(self, file, begin: int) -> tuple:
        size = file.size()
        stop = min(begin + self.width, size)
        started = self._ended_before(file, begin) if begin else size > 0
        # Records that begin here if the range begins outside of quotes, or inside; lines before the last of them.
        counts, last = [int(started), 0], [0 if started else -1, -1]
        odd, lines = 0, 0
        for at, data, quotes, ends in self.chunks(file, begin, size):
            if at >= stop:
                break
            quotes, ends = quotes[quotes + at < stop], ends[ends + at < stop]
            inside = (np.searchsorted(quotes, ends) + odd) % 2 == 1
            leads = ends + at + self.unit < stop  # another record can begin behind it in this range
            for state in (0, 1):
                own = np.flatnonzero((inside == bool(state)) & leads)
                if len(own):
                    counts[state] += len(own)
                    last[state] = lines + int(own[-1]) + 1
            odd = (odd + len(quotes)) % 2
            lines += len(ends)
        return odd, *counts, lines, *last

    def records(self, template_ord: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    number = row["first"]
                    for held in self._records(row["path"], row["begin"], row["within"], number):
                        yield self._batch(row, template_ord, number, held)
                        number += len(held)

        return run

    def _records(self, path: str, begin: int, within: bool, first: int) -> Iterator[list[bytes]]:
        """Records that begin in the range, in lists of bounded size."""
        with remote.open_input(path) as file:
            size = file.size()
            stop = min(begin + self.width, size)
            # Where the next record begins, if it has begun, and what is there of it.
            going = begin == 0 and size > 0 or (not within and self._ended_before(file, begin))
            pending: list[bytes] = []
            waiting, odd, done = 0, int(within), 0
            for at, data, quotes, ends in self.chunks(file, begin, size):
                outside = (np.searchsorted(quotes, ends) + odd) % 2 == 0
                odd = (odd + len(quotes)) % 2
                held, start = [], 0
                for end in ends[outside].tolist():
                    if going:
                        pending.append(data[start : end + self.unit])
                        held.append(self._plain(b"".join(pending)))
                        pending, waiting = [], 0
                    start = end + self.unit
                    going = at + start < stop
                    if not going and at + start >= stop:
                        break
                done += len(held)
                if held:
                    yield held
                if not going and at + len(data) >= stop:
                    return
                if going:
                    pending.append(data[start:])
                    waiting += len(data) - start
                    if waiting > RECORD_BYTES:
                        raise ValueError(f"Record {first + done} of '{path}' is longer than {RECORD_BYTES} bytes")
            if going and waiting:
                yield [self._plain(b"".join(pending))]

    def _plain(self, record: bytes) -> bytes:
        """Without its end; other line ends as line feeds. What has units of several bytes becomes UTF-8."""
        if self.unit > 1:
            record = record.decode(self.encoding).encode()
        if b"\r" in record:
            record = record.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
        return record.removesuffix(b"\n")

    def _batch(self, row: dict, template_ord: int, number: int, held: list[bytes]) -> pa.RecordBatch:
        if number == 0 and held[0].startswith(codecs.BOM_UTF8) and codecs.lookup(self.encoding).name.startswith("utf-8"):
            held[0] = held[0].removeprefix(codecs.BOM_UTF8)  # a byte order mark is no data
        if self.unit > 1 or codecs.lookup(self.encoding).name in ("utf-8", "utf-8-sig", "ascii"):
            values = pa.array(held, pa.binary()).cast(pa.string())
        else:
            values = pa.array([h.decode(self.encoding) for h in held], pa.string())
        n, stamp = len(held), pa.timestamp("us", "UTC")
        types = [stamp, pa.int64(), pa.string(), stamp, pa.int64(), pa.int64()]
        facts = [pa.repeat(pa.scalar(row[f], t), n) for f, t in zip(_FACTS, types)]
        numbers = pa.array(np.arange(number, number + n, dtype=np.int64))
        columns = [pa.repeat(pa.scalar(template_ord, pa.int32()), n), pa.repeat(row["path"], n), pa.repeat(pa.scalar(row["begin"], pa.int64()), n)]
        names = ["_tord", "_fp", "_bs", "_mid", "value", "_mtime", "_size", "_zname", "_zmtime", "_zsize", "_zcsize"]
        return pa.RecordBatch.from_arrays([*columns, numbers, values, *facts], names=names)
