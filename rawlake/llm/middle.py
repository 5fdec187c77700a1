"""Fill-in-middle forms of texts, and the texts back.

The units of a text are words with the white space before them, and white space
at the end. Where units end is found eight bytes at a time: a text is viewed as
64-bit words, arithmetic on the seven low bits of all bytes at once marks white
space in their high bits, a mark is an end if the byte before it has none, and
counting bits gives the units that end in each word. A running sum finds the
word in which a unit ends, and dropping its lowest marks the byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import binary, packed, prepare, unpacked

# Marks of the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM = 50, 80  # per cent of texts that are cut, and of these that have the suffix first
SEED = 42

_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_OUT = ["n", "form", "prefix_chars", "middle_chars", "output"]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM, seed: int = SEED
) -> DataFrame:
    """The form of every whole text: plain, or cut at two places and put in another order.

    One row per input row: the id, ``n`` (units), ``form`` (``plain``, ``psm`` or
    ``spm``), ``prefix_chars`` and ``middle_chars`` (code points, null if plain) and
    ``output``. Places, whether a text is cut (``rate`` per cent) and its form
    (``spm`` per cent) follow from a hash of seed and id alone, so reruns agree.
    Null and empty texts are plain and give an empty output, as does a text that
    holds a mark its own text. Rows without an id count as one of an empty id;
    rows of equal id and text have equal results. Other columns are not read.
    """
    prepare(docs.sparkSession)
    number = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(number, 1 + 8 * k, 8), 16, 10).cast("bigint").alias(f"h{k}") for k in range(4)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), *draws)
    kind = docs.schema[id_col].dataType.simpleString()
    done = rows.mapInArrow(_forms(rate, spm), f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return done.select(F.col("id").alias(id_col), *_OUT)


def restore(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from: no text that is cut holds a mark, so the marks found are those set."""
    part = F.split(output, "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def restored(formed: DataFrame, text_col: str = "text") -> DataFrame:
    """``formed`` (any columns, ``form`` and ``output`` among them) with the text rebuilt in ``text_col``.

    An existing column of that name is replaced; a null output gives null.
    """
    names = [c for c in formed.columns if c != text_col]
    rows = packed(formed, "form", "output")
    return unpacked(rows, [*names, text_col], **{text_col: restore(F.col("form"), F.col("output"))})


def _forms(rate: int, spm: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = zip(*[batch.column(k).to_pylist() for k in range(2, 6)])
            found = [one(text, *own) for text, own in zip(binary(batch.column(1)), draws)]
            n, form, first, middle, output = zip(*found) if found else [()] * 5
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()), pa.array(middle, pa.int64())]
            # The parts are cut between characters, so they are UTF-8 as the text is.
            text = pa.array(output, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, text], ["id", *_OUT])

    def one(text: bytes, h1: int, h2: int, h3: int, h4: int) -> tuple:
        ends = UnitEnds(text)
        if not text or h3 % 100 >= rate or any(m in text for m in marks):
            return ends.n, "plain", None, None, text
        a, b = (ends.place(k) for k in sorted((h1 % (ends.n + 1), h2 % (ends.n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        chars = [code_points(prefix), code_points(middle)]
        if h4 % 100 < spm:
            return ends.n, "spm", *chars, b"".join([marks[1], suffix, marks[0], prefix, marks[2], middle])
        return ends.n, "psm", *chars, b"".join([marks[0], prefix, marks[1], suffix, marks[2], middle])

    return run


def words_of(text: bytes, fill: int) -> np.ndarray:
    """The bytes as 64-bit words, the first byte lowest, filled up with ``fill``."""
    return np.frombuffer(text + bytes([fill]) * (-len(text) % 8), "<u8")


def spaces(words: np.ndarray) -> np.ndarray:
    """The high bits of all bytes that are a space, a tab or one of the four behind it.

    Sums of seven-bit parts do not reach the next byte, so no byte sways another.
    """
    low = words & _LOW
    from_tab, beyond = low + _each(0x80 - 0x09), low + _each(0x80 - 0x0E)
    blank = (low ^ _each(0x20)) + _LOW  # high bit set unless the part is that of a space
    return ((from_tab & ~beyond) | ~blank) & ~words & _HIGH


def _each(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


class UnitEnds:
    """Where the units of a text end."""

    def __init__(self, text: bytes) -> None:
        self.size = len(text)
        words = words_of(text + b" ", 0x20)
        space = spaces(words)
        # The mark of the byte before, from the word before where need be.
        before = space << np.uint64(8)
        before[1:] |= space[:-1] >> np.uint64(56)
        before[0] |= np.uint64(0x80)
        # A blank behind something else: there a unit has ended.
        self.marks = space & ~before
        self.sums = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)
        self.words = int(self.sums[-1])
        self.n = self.words + (text[-1:] in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))

    def place(self, k: int) -> int:
        """The number of bytes that the first ``k`` units take."""
        if k == 0 or k > self.words:
            return self.size if k else 0
        at = int(np.searchsorted(self.sums, k))
        word = int(self.marks[at])
        for _ in range(k - 1 - (int(self.sums[at - 1]) if at else 0)):
            word &= word - 1
        return 8 * at + ((word & -word).bit_length() - 1) // 8


def code_points(text: bytes) -> int:
    """Bytes that do not carry a character on: all but those that begin with the bits 10."""
    words = words_of(text, 0x80)
    return 8 * len(words) - int(np.bitwise_count(words & ~(words << np.uint64(1)) & _HIGH).sum(dtype=np.int64))
