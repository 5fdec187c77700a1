"""Collocations: phrases that occur more often than their parts explain.

Counting. The corpus is packed once into bundles. Each bundle asks, for the
cells that its words and word pairs fall into, whether all bundles together
count a cell often enough; a cell never counts less than what falls into it, so
no frequent phrase is lost, and a phrase can only be frequent where all its
words and pairs may be. Bundles then count the phrases that are left as they
stand, word by word, and hand them on as compressed lists in prefix order, dealt
out evenly; these are added up list by list.

Joining. The counts are kept as one stream for each length. In prefix order the
stream of a length and the next shorter one run side by side, each phrase next
to its first words; in suffix order next to its last words. So two passes of
merge joins over sorted streams bring the counts of all first and last parts,
and the counts of longer phrases come back the same way. No table of phrases is
looked up by hash. A phrase lies in a longer one that is as frequent just if it
does so with one more word at either end, as what lies between is no rarer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawlake.llm.common import binary, materialize, mixed, prepare
from rawlake.llm.substrings import decode, encode

WORDS = 4  # in the longest phrase
LEAST = 30  # occurrences of a candidate
TOP = 2000  # phrases of each language
SCALE = 2_000_000
SHARE = 80  # per cent of a phrase's occurrences that a longer one must take to stand for it
PACK_BYTES, MOST_PACK_BYTES = 8 << 20, 64 << 20  # text in a bundle, for small and for large corpora
BLOCK_BITS, MOST_BLOCK_BITS = 22, 26  # cells that one task sums up, likewise
LIST_BYTES = 8 << 20  # text for each of the shares that phrases are dealt into

# What ends a piece, and what stands for it (no UTF-8 text has that byte).
_ENDS = b".,;:!?\n\v\f\r"
_CUT = 0xFF
_FOLD = bytes(_CUT if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = WORDS, least: int = LEAST, top: int = TOP, share: int = SHARE
) -> DataFrame:
    """The ``top`` collocations of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased, texts end at ``.,;:!?`` and line ends into pieces, pieces
    at spaces and tabs into words. Candidates are phrases of two to ``words`` words
    with ``least`` occurrences or more (``a``) within pieces; of the ways to cut one
    in two, with ``l`` and ``r`` occurrences of the parts, that with the least
    ``score`` = floor(2,000,000 a / (l + r)) counts, the first of equal ones. Those
    inside a longer candidate with ``share`` per cent of their occurrences go. ``n``
    is the number of words of the language. Ranks go by score and ``a``, descending,
    then by the bytes of the phrase. Null texts are empty, a null language is
    ``und``; repeated rows count as often as they stand there. Other columns are not read.
    """
    kept = counts(docs, text_col, lang_col, words, least)
    found = scored(with_parts(kept, words), share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # No language is ranked whole in one place: only the first of each share of it meet.
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    portion = Window.partitionBy("lang", "_portion").orderBy(*order)
    found = found.withColumn("_portion", F.pmod(F.xxhash64("phrase"), F.lit(width)))
    found = found.withColumn("_place", F.row_number().over(portion)).filter(F.col("_place") <= top)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    totals = kept.filter("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# -- counting ----------------------------------------------------------------


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = WORDS, least: int = LEAST) -> DataFrame:
    """``lang, n, phrase, f``: all phrases of up to ``words`` words that occur ``least`` times or more,
    and each language's number of words as a phrase of none, as a written table."""
    prepare(docs.sparkSession)
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shape = _Shape(total, words, least)
    packs = materialize(rows.mapInArrow(shape.pack, "pack bigint, blob binary"), "phrase-packs")
    asked = packs.mapInArrow(shape.ask, "block bigint, pack bigint, cells binary, more binary, counts binary")
    answers = asked.groupBy("block").applyInPandas(lambda asked: shape.sum_up(asked), "block bigint, pack bigint, bits binary")
    per_pack = answers.groupBy("pack").agg(F.collect_list(F.struct("block", "bits")).alias("answers"))
    answered = packs.join(per_pack, "pack", "left").select("blob", "answers")
    lists = answered.mapInArrow(shape.count, "share bigint, list binary")
    summed = lists.groupBy("share").applyInArrow(lambda lists: shape.add_up(lists), "lang string, n int, phrase string, f bigint")
    return materialize(summed, "phrase-counts")


def _squeezed() -> pa.ipc.IpcWriteOptions:
    return pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 5))


class _Shape:
    """Sizes that follow the corpus, and what tasks do with bundles."""

    def __init__(self, total: int, words: int, least: int) -> None:
        self.words, self.least = words, least
        # About one cell for each word and each pair.
        self.bits = max(BLOCK_BITS, (total // 4).bit_length())
        self.shares = max(64, total // LIST_BYTES)
        self.block_bits = min(max(BLOCK_BITS, self.bits - 8), MOST_BLOCK_BITS)
        self.pack_bytes = min(max(PACK_BYTES, total >> 14), MOST_PACK_BYTES)

    def pack(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size, held = TaskContext.get().partitionId(), 0, 0, []

        def bundle() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(sink, table.schema, options=_squeezed()) as writer:
                writer.write_table(table)
            blob = sink.getvalue().to_pybytes()
            return pa.RecordBatch.from_pydict({"pack": pa.array([(part << 32) + number], pa.int64()), "blob": pa.array([blob], pa.binary())})

        for batch in batches:
            start = 0
            for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                if size and size + n > self.pack_bytes:
                    held.append(batch.slice(start, i - start))
                    yield bundle()
                    start, size, held, number = i, 0, [], number + 1
                size += n
            held.append(batch.slice(start))
        if any(b.num_rows for b in held):
            yield bundle()

    def ask(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _Bundle(blob.as_buffer())
                cells, counted = np.unique(self.cells(own), return_counts=True)
                yield from self.questions(pack, cells, np.minimum(counted, self.least))

    def cells(self, own: _Bundle) -> np.ndarray:
        """Cells of all words, then of all pairs."""
        words, pairs = own.hashes()
        return np.concatenate([words[own.word], pairs[own.paired]]) >> np.uint64(64 - self.bits)

    def questions(self, pack: int, cells: np.ndarray, counted: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(cells):
            return
        blocks = cells >> np.uint64(self.block_bits)
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(cells)]
        lists, more, extra = [], [], []
        for a, b in zip(edges, edges[1:]):
            lists.append(encode(cells[a:b] & np.uint64((1 << self.block_bits) - 1), self.block_bits))
            often = np.flatnonzero(counted[a:b] > 1)
            more.append(encode(often.astype(np.uint64), int(b - a).bit_length()))
            extra.append(counted[a:b][often].astype("<u4").tobytes() if self.least > 255 else counted[a:b][often].astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(blocks[edges[:-1]].astype(np.int64)),
                "pack": pa.array(np.full(len(lists), pack, np.int64)),
                "cells": pa.array(lists, pa.binary()),
                "more": pa.array(more, pa.binary()),
                "counts": pa.array(extra, pa.binary()),
            }
        )

    def sum_up(self, asked: pd.DataFrame) -> pd.DataFrame:
        """Which of each bundle's cells count ``least`` over all bundles."""
        kind = np.dtype("<u4" if self.least > 255 else np.uint8)
        sums = np.zeros(1 << self.block_bits, kind)

        def each() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for cells, more, extra in zip(asked["cells"], asked["more"], asked["counts"]):
                cells = decode(cells, self.block_bits)
                counted = np.ones(len(cells), np.int64)
                counted[decode(more, len(cells).bit_length())] = np.frombuffer(extra, kind)
                yield cells, counted

        for cells, counted in each():
            sums[cells] = np.minimum(sums[cells] + counted, self.least)
        bits = [np.packbits(sums[cells] >= self.least).tobytes() for cells, _ in each()]
        return pd.DataFrame({"block": asked["block"], "pack": asked["pack"], "bits": bits})

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, answers in zip(batch.column(0), batch.column(1).to_pylist()):
                yield from self.lists(_Bundle(blob.as_buffer()), answers)

    def lists(self, own: _Bundle, answers: list[dict] | None) -> Iterator[pa.RecordBatch]:
        """The phrases of a bundle, one list for each share that has any."""
        tables, shares = [], []
        for langs, n, phrases, found, hashes in own.phrases(*self.frequent(own, answers), self.words):
            columns = [pa.array(langs, pa.string()).dictionary_encode(), pa.array(np.full(len(found), n, np.int32)), pa.array(phrases, pa.binary()), pa.array(found)]
            tables.append(pa.Table.from_arrays(columns, ["lang", "n", "phrase", "f"]))
            shares.append((hashes % np.uint64(self.shares)).astype(np.int64))
        table, share = pa.concat_tables(tables).unify_dictionaries(), np.concatenate(shares)
        # Within a share phrases stay in the order they have, each behind those with the same first words.
        order = np.argsort(share, kind="stable")
        table, share = table.take(order).combine_chunks(), share[order]
        edges = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(share)]
        for a, b in zip(edges, edges[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=_squeezed()) as writer:
                writer.write_table(table.slice(a, b - a))
            found = {"share": pa.array([share[a]], pa.int64()), "list": pa.array([sink.getvalue().to_pybytes()], pa.binary())}
            yield pa.RecordBatch.from_pydict(found)

    def add_up(self, lists: pa.Table) -> pa.Table:
        """Counts of a share over all its lists; those below ``least`` go."""
        tables = [pa.ipc.open_stream(blob.as_buffer()).read_all() for chunk in lists.column("list").chunks for blob in chunk]
        plain = [t.set_column(0, "lang", t.column(0).cast(pa.string())) for t in tables]
        summed = pa.concat_tables(plain).group_by(["lang", "n", "phrase"]).aggregate([("f", "sum")])
        kept = summed.filter(pc.or_(pc.greater_equal(summed["f_sum"], self.least), pc.equal(summed["n"], 0)))
        return pa.table({"lang": kept["lang"], "n": kept["n"], "phrase": kept["phrase"].cast(pa.string()), "f": kept["f_sum"]})

    def frequent(self, own: _Bundle, answers: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of words, and of pairs, whose cell counts often enough."""
        cells, where = np.unique(self.cells(own), return_inverse=True)
        blocks, sizes = np.unique(cells >> np.uint64(self.block_bits), return_counts=True)
        bits = {a["block"]: a["bits"] for a in answers or []}
        flags = [np.unpackbits(np.frombuffer(bits[int(b)], np.uint8), count=n) for b, n in zip(blocks, sizes.tolist())]
        flags = np.concatenate(flags).astype(bool)[where] if flags else np.zeros(0, bool)
        words, pairs = np.zeros(len(own.ids), bool), np.zeros(len(own.ids), bool)
        at = np.flatnonzero(own.word)
        words[at], pairs[own.paired] = flags[: len(at)], flags[len(at) :]
        return words, pairs


class _Bundle:
    """Words of a bundle's texts in a row, with a mark behind every piece."""

    def __init__(self, blob: pa.Buffer) -> None:
        table = pa.ipc.open_stream(blob).read_all()
        mark = bytes([_CUT])
        tokens: list[bytes] = []
        lengths = []
        for chunk in table.column(1).chunks:
            for text in binary(chunk):
                own = text.translate(_FOLD).replace(mark, b" \xff ").split()
                own.append(mark)
                tokens += own
                lengths.append(len(own))
        coded = pa.array(tokens, pa.binary()).dictionary_encode()
        del tokens
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.values = coded.dictionary.to_pylist()
        langs = table.column(0).combine_chunks().dictionary_encode()
        langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        self.langs = langs.dictionary.to_pylist()
        self.lang = np.repeat(langs.indices.to_numpy().astype(np.int64), lengths)
        cut = self.values.index(mark) if self.values else -1
        self.word = self.ids != cut
        self.paired = np.flatnonzero(self.word[:-1] & self.word[1:])

    def lang_hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(v.encode()) for v in self.langs), np.uint64, len(self.langs))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the language with the word at each place, and with the pair there."""
        of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, self.values), np.uint64, len(self.values))
        plain = of_word[self.ids]
        words = mixed(plain + self.lang_hashes()[self.lang], 3)
        return words, mixed(words[:-1] + plain[1:], 5)

    def phrases(
        self, words: np.ndarray, pairs: np.ndarray, most: int
    ) -> Iterator[tuple[list[str], int, list[bytes], np.ndarray, np.ndarray]]:
        """Languages, phrases, counts and hashes of each length, where ``words`` and ``pairs`` say that they may be frequent."""
        own = np.bincount(self.lang[self.word], minlength=len(self.langs))
        yield self.langs, 0, [b""] * len(self.langs), own.astype(np.int64), self.lang_hashes()
        size, values = len(self.values), self.values
        spelled = self.hashes()[0]
        at = np.flatnonzero(words)
        group = np.full(len(self.ids), -1, np.int64)
        key = self.lang[at] * size + self.ids[at]
        hashes = spelled.copy()
        for n in range(1, most + 1):
            _, first, where, found = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            group[:] = -1
            group[at] = where
            begins = at[first]
            texts = [b" ".join([values[i] for i in own]) for own in self.ids[begins[:, None] + np.arange(n)].tolist()]
            yield [self.langs[k] for k in self.lang[begins].tolist()], n, texts, found.astype(np.int64), mixed(hashes[begins], 7 + n)
            # One word more: behind a phrase counted here there must stand a frequent word in a frequent pair.
            at = at[at + n < len(self.ids)]
            at = at[pairs[at + n - 1] & words[at + n]]
            key = group[at] * size + self.ids[at + n]
            hashes[at] = mixed(hashes[at] + spelled[at + n], 31)


# -- joining -----------------------------------------------------------------


def with_parts(kept: DataFrame, words: int = WORDS) -> DataFrame:
    """Candidates ``lang, phrase, n, a`` with the counts of their first 1, 2, ... words (``firsts``),
    of what is left behind these (``rests``), and of the most frequent phrase with one word more (``beyond``)."""
    head, tail = F.expr("substring_index(phrase, ' ', n - 1)"), F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    stream = kept.filter("n > 0").select("lang", "n", "phrase", "f", head.alias("head"), tail.alias("tail"))
    none = F.array().cast("array<bigint>")
    # Prefix order: each phrase beside its first words.
    level = stream.filter("n = 1").select("lang", "phrase", "f", none.alias("firsts"), none.alias("rests"))
    firsts = {1: level}
    for n in range(2, words + 1):
        shorter = firsts[n - 1].select("lang", F.col("phrase").alias("head"), F.concat("firsts", F.array("f")).alias("firsts"))
        own = stream.filter(F.col("n") == n).join(shorter.hint("merge"), ["lang", "head"])
        firsts[n] = materialize(own.select("lang", "phrase", "f", "tail", "firsts"), f"prefix-order-{n}")
    # Suffix order: each phrase beside its last words.
    rests = {1: level}
    for n in range(2, words + 1):
        shorter = rests[n - 1].select("lang", F.col("phrase").alias("tail"), F.concat(F.array("f"), "rests").alias("rests"))
        own = firsts[n].join(shorter.hint("merge"), ["lang", "tail"])
        rests[n] = materialize(own.select("lang", "phrase", "f", "firsts", "rests"), f"suffix-order-{n}")
    longer = stream.filter("n > 2")
    longer = longer.select("lang", F.col("head").alias("phrase"), "f").unionByName(longer.select("lang", F.col("tail").alias("phrase"), "f"))
    beyond = longer.groupBy("lang", "phrase").agg(F.max("f").alias("beyond"))
    levels = [rests[n].withColumn("n", F.lit(n)) for n in range(2, words + 1)]
    candidates = reduce(DataFrame.unionByName, levels).withColumnRenamed("f", "a")
    return candidates.join(beyond.hint("merge"), ["lang", "phrase"], "left")


def scored(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of candidates that no longer one stands for.

    Products are formed as decimals of 38 digits and divided as whole numbers.
    """

    def cut(left: Column, k: Column) -> Column:
        right = F.get("rests", k)
        both = left.cast("decimal(19,0)") + right.cast("decimal(19,0)")
        product = F.lit(SCALE).cast("decimal(7,0)") * F.col("a").cast("decimal(19,0)")
        score = F.call_function("div", product, both)
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    wide = "decimal(19,0)"
    taken = F.lit(100).cast("decimal(3,0)") * F.col("beyond").cast(wide) >= F.lit(share).cast("decimal(10,0)") * F.col("a").cast(wide)
    own = candidates.filter(~F.coalesce(taken, F.lit(False)))
    least = F.array_min(F.transform("firsts", cut)).alias("least")
    return own.select("lang", "phrase", "a", least).select("lang", "phrase", "a", "least.l", "least.r", "least.score")
