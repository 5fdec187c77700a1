"""Exact removal of repeated word sequences, prefiltered by a count-min sketch.

The corpus is packed once into compressed bundles of whole texts. Each bundle
asks, for the cells its windows fall into, whether the merged sketch counts
them twice or more; a cell's count never falls short of its windows' true
counts, so no repeated window is lost. Only windows that every sketch row
holds for repeated are then grouped exactly, by 96 bits of a strong hash of
their words. Both questions are shuffled as compact sorted lists by ranges of
the hash, and answered with one bit each, so neither the sketch nor any list of
windows has to fit in one place, and a window that occurs everywhere costs one
entry per bundle.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import binary, hash_words, materialize, mixed, prepare, rolling, space_words

WINDOW = 35  # words
DEPTH = 2  # rows of the sketch
CELLS_PER_WINDOW = 4  # width of a row for each window of the corpus
BLOCK_BITS = 22  # cells of a row that one task merges
PACK_BYTES = 4 << 20  # text in a bundle, unless one text is longer

_FINGERPRINT = np.dtype([("a", "<u8"), ("b", "<u4")])
_EXACT = 1 << 20  # number of the exact question, behind the sketch rows


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove every word that a window of ``window`` words covers which also starts elsewhere.

    One row per input row: the id, ``n_words``, ``n_removed`` and ``text``,
    the kept words joined by one space. Words are runs of anything but the
    six ASCII white-space characters. Null and empty texts have no words and
    give an empty text; texts shorter than the window keep all; ids are only
    carried, so they may be null or repeat. Repeated rows count as occurrences.
    Other columns of ``docs`` are not read.
    """
    spark = prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    packs = materialize(rows.mapInArrow(_pack, "pack bigint, n_bytes bigint, blob binary"), "packs")
    total = packs.agg(F.sum("n_bytes")).first()[0] or 0
    # A word and its separator take a handful of bytes; the width needs no more than that.
    bits = max(BLOCK_BITS, (CELLS_PER_WINDOW * total // 6).bit_length())
    shape = _Shape(window, bits)

    asked = packs.mapInArrow(shape.ask_sketch, _ASK)
    counted = materialize(asked.groupBy("row", "block").applyInPandas(lambda asked: shape.merge_cells(asked), _ANSWER), "sketch-answers")
    asked = _with_answers(packs, counted).mapInArrow(shape.ask_exact, _ASK)
    exact = materialize(asked.groupBy("row", "block").applyInPandas(_merge_exact, _ANSWER), "exact-answers")
    out = f"{id_col} {id_type}, n_words bigint, n_removed bigint, text string"
    return _with_answers(packs, counted.unionByName(exact)).mapInArrow(shape.cut, out)


_ASK = "row int, block bigint, pack bigint, keys binary, twice binary"
_ANSWER = "row int, block bigint, pack bigint, bits binary"


def _with_answers(packs: DataFrame, answers: DataFrame) -> DataFrame:
    per_pack = answers.groupBy("pack").agg(F.collect_list(F.struct("row", "block", "bits")).alias("answers"))
    return packs.join(per_pack, "pack", "left").select("pack", "blob", "answers")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, size, held = TaskContext.get().partitionId(), 0, 0, []

    def bundle() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        table = pa.Table.from_batches(held).combine_chunks()
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table)
        blob = sink.getvalue().to_pybytes()
        return pa.RecordBatch.from_pydict(
            {"pack": pa.array([(part << 32) + number], pa.int64()), "n_bytes": pa.array([size], pa.int64()), "blob": pa.array([blob], pa.binary())}
        )

    for batch in batches:
        start = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
            if size and size + n > PACK_BYTES:
                held.append(batch.slice(start, i - start))
                yield bundle()
                start, size, held, number = i, 0, [], number + 1
            size += n
        held.append(batch.slice(start))
    if any(b.num_rows for b in held):
        yield bundle()


class _Shape:
    """Window length and sketch width; what tasks do with bundles."""

    def __init__(self, window: int, bits: int) -> None:
        self.window, self.bits = window, bits

    def windows(self, blob: bytes):
        """Ids, words of each text, start of each text, starts of windows, and their hashes."""
        table = pa.ipc.open_stream(blob).read_all().combine_chunks()
        words = [space_words(t) for t in chain.from_iterable(binary(c) for c in table.column(1).chunks)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        hashes = hash_words(list(chain.from_iterable(words)))
        rolled = rolling(hashes, self.window)
        inside = np.arange(len(rolled)) + self.window <= np.repeat(ends, lengths)[: len(rolled)]
        starts = np.flatnonzero(inside)
        return table.column(0), words, ends - lengths, starts, rolled[starts]

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return mixed(hashes, row + 1) >> np.uint64(64 - self.bits)

    def ask_sketch(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, blob in _rows(batches, "pack", "blob"):
            *_, hashes = self.windows(blob)
            for row in range(DEPTH):
                cells, counts = np.unique(self.cells(hashes, row), return_counts=True)
                yield from _asks(row, pack, cells, counts > 1, BLOCK_BITS, lambda v: encode(v & np.uint64((1 << BLOCK_BITS) - 1), BLOCK_BITS))

    def merge_cells(self, asked: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << BLOCK_BITS, np.uint8)
        lists = [decode(k, BLOCK_BITS) for k in asked["keys"]]
        for cells, twice in zip(lists, asked["twice"]):
            more = np.ones(len(cells), np.uint8)
            more[decode(twice, len(cells).bit_length())] = 2
            counts[cells] = np.minimum(counts[cells] + more, 2)
        bits = [_bits(counts[cells] > 1) for cells in lists]
        return pd.DataFrame({"row": asked["row"], "block": asked["block"], "pack": asked["pack"], "bits": bits})

    def estimated(self, hashes: np.ndarray, answers: dict) -> np.ndarray:
        """Which windows every row of the sketch counts twice or more."""
        hot = np.ones(len(hashes), bool)
        for row in range(DEPTH):
            cells, where = np.unique(self.cells(hashes, row), return_inverse=True)
            hot &= _flags(answers, row, cells >> np.uint64(BLOCK_BITS))[where]
        return hot

    def candidates(self, blob: bytes, answers: dict):
        """As ``windows``, for the windows estimated repeated, with their exact fingerprints."""
        ids, words, begins, starts, hashes = self.windows(blob)
        starts = starts[self.estimated(hashes, answers)]
        flat = list(chain.from_iterable(words))
        joined = b" ".join(flat)
        ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)) + 1) - 1
        first = np.concatenate([[0], ends[:-1] + 1]) if len(flat) else ends
        digest = xxhash.xxh3_128_digest
        whole = b"".join([digest(joined[a:b])[:12] for a, b in zip(first[starts].tolist(), ends[starts + self.window - 1].tolist())])
        return ids, words, begins, starts, np.frombuffer(whole, _FINGERPRINT)

    def ask_exact(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, blob, answers in _rows(batches, "pack", "blob", "answers"):
            *_, prints = self.candidates(blob, _answers(answers))
            distinct, _, counts = _distinct(prints)
            yield from _asks(_EXACT, pack, distinct, counts > 1, self.exact_shift, lambda v: v.tobytes())

    @property
    def exact_shift(self) -> int:
        return 64 - (self.bits - BLOCK_BITS)

    def cut(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for _, blob, answers in _rows(batches, "pack", "blob", "answers"):
            answers = _answers(answers)
            ids, words, begins, starts, prints = self.candidates(blob, answers)
            distinct, where, _ = _distinct(prints)
            repeated = _flags(answers, _EXACT, _block(distinct["a"], self.exact_shift))[where]
            edges = np.zeros(sum(map(len, words)) + 1, np.int32)
            np.add.at(edges, starts[repeated], 1)
            np.add.at(edges, starts[repeated] + self.window, -1)
            covered = np.cumsum(edges) > 0
            removed, kept = [], []
            for begin, own in zip(begins.tolist(), words):
                out = covered[begin : begin + len(own)]
                n = int(out.sum())
                removed.append(n)
                kept.append(b" ".join([w for w, gone in zip(own, out.tolist()) if not gone] if n else own))
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            columns = [ids, pa.array([len(w) for w in words], pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            schema = schema or pa.schema([("id", ids.type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _merge_exact(asked: pd.DataFrame) -> pd.DataFrame:
    lists = [np.frombuffer(k, _FINGERPRINT) for k in asked["keys"]]
    weights = []
    for prints, twice in zip(lists, asked["twice"]):
        more = np.ones(len(prints), np.int64)
        more[decode(twice, len(prints).bit_length())] = 2
        weights.append(more)
    _, where, _ = _distinct(np.concatenate(lists))
    repeated = np.bincount(where, np.concatenate(weights))[where] > 1
    parts = np.split(repeated, np.cumsum([len(x) for x in lists])[:-1])
    return pd.DataFrame({"row": asked["row"], "block": asked["block"], "pack": asked["pack"], "bits": [_bits(p) for p in parts]})


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _block(values: np.ndarray, shift: int) -> np.ndarray:
    return values >> np.uint64(shift) if shift < 64 else np.zeros(len(values), np.uint64)


def _asks(row: int, pack: int, keys: np.ndarray, twice: np.ndarray, shift: int, packed) -> Iterator[pa.RecordBatch]:
    """One question for each block that the sorted keys touch."""
    if not len(keys):
        return
    blocks = _block(keys["a"] if keys.dtype == _FINGERPRINT else keys, shift)
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    own = [(packed(keys[a:b]), encode(np.flatnonzero(twice[a:b]).astype(np.uint64), int(b - a).bit_length())) for a, b in zip(begins, ends)]
    yield pa.RecordBatch.from_pydict(
        {
            "row": pa.array(np.full(len(own), row, np.int32)),
            "block": pa.array(blocks[begins].astype(np.int64)),
            "pack": pa.array(np.full(len(own), pack, np.int64)),
            "keys": pa.array([k for k, _ in own], pa.binary()),
            "twice": pa.array([t for _, t in own], pa.binary()),
        }
    )


def _answers(rows: list[dict] | None) -> dict[tuple[int, int], bytes]:
    return {(r["row"], r["block"]): r["bits"] for r in rows or []}


def _flags(answers: dict, row: int, blocks: np.ndarray) -> np.ndarray:
    """Answers in the order of the sorted keys whose blocks are given."""
    if not len(blocks):
        return np.zeros(0, bool)
    own, counts = np.unique(blocks, return_counts=True)
    return np.concatenate([np.unpackbits(np.frombuffer(answers[row, int(b)], np.uint8), count=n).astype(bool) for b, n in zip(own, counts.tolist())])


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _distinct(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints, the place of each among them, and their counts."""
    order = np.lexsort((prints["b"], prints["a"]))
    ordered = prints[order]
    new = np.ones(len(prints), bool)
    new[1:] = (ordered["a"][1:] != ordered["a"][:-1]) | (ordered["b"][1:] != ordered["b"][:-1])
    where = np.empty(len(prints), np.int64)
    where[order] = np.cumsum(new) - 1
    return ordered[new], where, np.bincount(where) if len(prints) else np.zeros(0, np.int64)


def encode(values: np.ndarray, bits: int) -> bytes:
    """Elias-Fano code of sorted distinct numbers below ``2 ** bits``."""
    n = len(values)
    if not n:
        return b""
    low = max(0, bits - n.bit_length())
    tails = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    heads = np.zeros(int(places[-1]) + 1, np.uint8)
    heads[places] = 1
    return struct.pack("<I", n) + np.packbits(np.concatenate([tails, heads])).tobytes()


def decode(data: bytes, bits: int) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    (n,) = struct.unpack_from("<I", data)
    low = max(0, bits - n.bit_length())
    flags = np.unpackbits(np.frombuffer(data, np.uint8, offset=4))
    tails = flags[: n * low].reshape(n, low).astype(np.int64) @ (1 << np.arange(low, dtype=np.int64))
    return ((np.flatnonzero(flags[n * low :])[:n] - np.arange(n)) << low) | tails
