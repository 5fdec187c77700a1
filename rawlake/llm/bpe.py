"""Byte-level byte-pair encoding by ranks, and back.

A text is split by a pattern, each match is encoded apart, byte by byte mapped
to Latin-1 so that one automaton of all tokens finds the longest token at a
place. A sequence of tokens is what the merges give exactly if every two
neighbours are what the merges make of their joined bytes. So a match is walked
from the front, longest token first; a token that does not go with the one
before it gives way to the next shorter one, and a place with none left sends
the walk one token back and is never entered again: at most one visit for each
place and token, however long the match is. Whether two tokens go together is
worked out once and remembered.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import binary, prepare
from rawlake.sources import remote

PAIRS = 1 << 20  # pairs of tokens, and
PIECES = 1 << 19  # short matches, that a worker remembers
SHORT = 32  # bytes of a match that is worth remembering
SLICE = 1 << 16  # ids that are decoded at once


def encode(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", packed: bool = False
) -> DataFrame:
    """Token ids of every whole text.

    ``ranks`` is the path of a file with a token in base 64 and its rank on each
    line, all 256 single bytes among them; ``pattern`` splits a text, and what it
    does not match is left out. Special tokens are ordinary text. One row per
    input row: the id and ``ids``, an array of ints, or with ``packed`` their
    little-endian unsigned 32-bit form in one binary. Null and empty texts have no
    ids; null ids are carried, repeated rows are each encoded. Other columns are
    not read. The vocabulary travels with the job; tasks open no file. Neighbours tell
    all only where every token is the join of two of lower rank; with any other
    vocabulary the merges are done one by one.
    """
    spark = prepare(docs.sparkSession)
    source = _read(ranks)
    walk = vocabulary(source, pattern).ordered()
    kind = "binary" if packed else "array<int>"
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(source, pattern)
        coder.walk = walk
        for batch in batches:
            found = [coder.encode(t.decode("utf-8", "replace") if t else "") for t in binary(batch.column(1))]
            ids = pa.array(found, pa.binary()) if packed else pa.array([np.frombuffer(i, "<i4") for i in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    out = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids {kind}")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with one more column ``decoded``: the bytes its ``ids`` (either form) stand for.

    Null ids decode to null, none to no bytes; an id beyond the vocabulary raises.
    """
    prepare(encoded.sparkSession)
    source = _read(ranks)
    at = encoded.columns.index("ids")
    if "decoded" in encoded.columns:
        raise ValueError("There is a column 'decoded' already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(source, None)
        for batch in batches:
            found = []
            for ids in batch.column(at).to_pylist():
                ids = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else ids
                found.append(None if ids is None else tokens.decode(np.asarray(ids, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"])

    schema = encoded.withColumn("decoded", F.lit(None).cast("binary")).schema
    return encoded.mapInArrow(run, schema)


def _read(path: str) -> bytes:
    with remote.open_input(path) as file:
        return file.read()


_LOADED: dict[tuple[str, str | None], Vocabulary] = {}


def vocabulary(source: bytes, pattern: str | None) -> Vocabulary:
    """The vocabulary of a rank file's contents; a worker builds it once."""
    key = hashlib.sha256(source).hexdigest(), pattern
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(source, pattern)
    return _LOADED[key]


class Vocabulary:
    def __init__(self, source: bytes, pattern: str | None) -> None:
        pairs = (line.split() for line in source.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"The vocabulary lacks the single bytes {missing[:5]}")
        sizes = np.zeros(max(self.tokens) + 2, np.int64)
        sizes[np.fromiter(self.tokens, np.int64) + 1] = [len(t) for t in self.tokens.values()]
        self.ends = np.cumsum(sizes)
        self.joined = np.frombuffer(b"".join([self.tokens[r] for r in sorted(self.tokens)]), np.uint8)
        if pattern is None:
            return
        self.split = regex.compile(pattern).findall
        self.width = max(map(len, self.ranks))
        self.words = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.words.add_word(token.decode("latin-1"), rank)
        self.words.make_automaton()
        self.length = {rank: len(token) for rank, token in self.tokens.items()}
        self.shorter = {rank: self._shorter(token) for rank, token in self.tokens.items()}
        self.together: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self)
        self.walk = True

    def ordered(self) -> bool:
        """Whether each token of several bytes is what the merges make of two tokens of lower rank."""
        for token, rank in list(self.ranks.items()):
            if len(token) > 1:
                del self.ranks[token]
                parts = self.merge(token)
                self.ranks[token] = rank
                if len(parts) != 2 or max(parts) > rank or self.merge(token) != [rank]:
                    return False
        return True

    def encode(self, text: str) -> bytes:
        """Ids of a text, in little-endian unsigned 32-bit form."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(ids), SLICE):
            own = ids[at : at + SLICE]
            if own.min() < 0 or own.max() + 1 >= len(self.ends) or not (sizes := self.ends[own + 1] - self.ends[own]).all():
                raise ValueError("An id is not in the vocabulary")
            # From where each token stands among all tokens to where it comes to stand.
            shifts = self.ends[own] - (np.cumsum(sizes) - sizes)
            out.append(self.joined[np.arange(sizes.sum()) + np.repeat(shifts, sizes)].tobytes())
        return b"".join(out)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match: walk longest tokens first, back where none fits."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not self.walk:
            return self.merge(piece)
        latin, size, length, shorter = piece.decode("latin-1"), len(piece), self.length, self.shorter
        find, together = self.words.iter_long, self.together
        # The automaton copies what it is given, so of a long match it gets no more than one token can take.
        reach = size if size <= SHORT else self.width
        chosen: list[int] = []
        dead: set[int] = set()
        at, last = 0, -1
        ahead = find(latin[:reach])
        token = next(ahead)[1]
        straight = reach == size  # whether ``ahead`` goes on from where the walk is
        while True:
            end = at + length[token]
            fits = end not in dead
            if fits and last >= 0:
                fits = together.get((last, token))
                if fits is None:
                    fits = self._goes(last, token)
            if fits:
                chosen.append(token)
                if end == size:
                    return chosen
                at, last = end, token
                if not straight:
                    ahead = find(latin[at : at + reach])
                    straight = reach == size
                token = next(ahead)[1]
                continue
            straight = False
            token = shorter[token]
            while token < 0:
                # No token leads on from here: the one that led here was wrong.
                dead.add(at)
                wrong = chosen.pop()
                at -= length[wrong]
                last = chosen[-1] if chosen else -1
                token = shorter[wrong]

    def _shorter(self, token: bytes) -> int:
        """The longest token that begins ``token`` and is shorter; -1 if none."""
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), -1)

    def _goes(self, left: int, right: int) -> bool:
        if len(self.together) >= PAIRS:
            self.together.clear()
        found = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        self.together[left, right] = found
        return found

    def merge(self, raw: bytes) -> list[int]:
        """The merges one by one, lowest rank first, the first of equal ones first."""
        rank, none = self.ranks.get, len(self.ends)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        joins = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while joins and (least := min(joins)) < none:
            k = joins.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del joins[k]
            if k:
                joins[k - 1] = rank(parts[k - 1] + parts[k], none)
            if k < len(joins):
                joins[k] = rank(parts[k] + parts[k + 1], none)
        return [self.ranks[p] for p in parts]


class _Pieces(dict):
    """Packed ids of matches; short ones are remembered, as most matches come again."""

    def __init__(self, coder: Vocabulary) -> None:
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        found = self.coder.encode_piece(raw)
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(raw) <= SHORT:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids
