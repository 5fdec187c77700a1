"""Document statistics, and selection by a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of cells and counted over the
raw corpus and over its trusted part; the mean over a text of the cells' log ratio
of the two smoothed multinomials tells how much likelier the text is as a trusted
one. Counts cover all documents; the model is as large as the number of cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import binary, hash_words, lowered, materialize, mixed, prepare, small, space_words

CELLS = 1 << 17
SMOOTHING = 0.5  # added to the count of each cell
TRUSTED_KEPT = 0.995  # part of the trusted documents that the threshold must leave
FOLDS = 5  # parts of the trusted documents; each is scored without its own counts to set the threshold
STEPS = 1000  # thresholds looked at between two whole log ratios
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated three-word windows

# What counts as a symbol.
SYMBOLS = b"#*$%&|<>"


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, trusted_kept: float = TRUSTED_KEPT) -> DataFrame:
    """Statistics, failed base rules, score and verdict for every document.

    ``trusted`` has the ids (``id_col``) of the trusted part. One row per input
    row: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``score`` (mean log ratio; 0 without
    words) and ``kept``. A trusted document's own words raise its score, so the
    threshold is set on scores that leave out the trusted counts of the document's
    fold (by a hash of the id): it is the highest thousandth which ``trusted_kept``
    of the trusted documents that pass the base rules reach so, and the same for
    every run; with none, the base rules alone decide. Null and
    empty texts have no words and fail the base rules; a null id is in no trusted
    part; repeated rows count as often as they occur. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    known = trusted.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct().withColumn("trusted", F.lit(True))
    # Ids are measured; beyond the bound the texts are shuffled by id.
    known = F.broadcast(known) if small(known, 40) else known
    fold = F.when(F.col("trusted"), F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int")).alias("fold")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id", "left").select("id", fold, "text")
    own_names = [f"own{k}" for k in range(FOLDS)]
    counts = texts.select("fold", "text").mapInArrow(_count(cells), ", ".join(["cell int, raw bigint", *[f"{c} bigint" for c in own_names]]))
    # One row per cell, whatever the corpus.
    table = counts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("raw", *own_names)]).toArrow()
    raw, folds = np.zeros(cells), np.zeros((FOLDS, cells))
    raw[table["cell"].to_numpy()] = table["raw"].to_numpy()
    for k, c in enumerate(own_names):
        folds[k, table["cell"].to_numpy()] = table[c].to_numpy()
    own = folds.sum(axis=0)
    # The last row is of all trusted documents, each other row without one fold.
    ratios = np.stack([_ratio(raw, own - f) for f in folds] + [_ratio(raw, own)])
    model = spark.sparkContext.broadcast(ratios if own.any() else np.zeros((FOLDS + 1, cells)))
    columns = f"id {id_type}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, score double, held_out double"
    scored = materialize(texts.mapInArrow(_score(cells, model), columns), "quality-scores")
    scored = scored.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    least = _threshold(scored, trusted_kept)
    return scored.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score",
        (~F.col("base_failed") & (F.col("score") >= least)).alias("kept"),
    )


def _ratio(raw: np.ndarray, own: np.ndarray) -> np.ndarray:
    cells = len(raw)
    return np.log((own + SMOOTHING) / (own.sum() + SMOOTHING * cells)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * cells))


def _threshold(scored: DataFrame, trusted_kept: float) -> float:
    # Mean log ratios are within a few tens, so the steps are few whatever the corpus.
    step = F.floor(F.col("held_out") * STEPS).cast("int")
    steps = sorted(scored.filter("held_out IS NOT NULL AND NOT base_failed").groupBy(step.alias("step")).count().collect(), reverse=True)
    total, reached = sum(n for _, n in steps), 0
    for at, n in steps:
        reached += n
        if reached >= trusted_kept * total:
            return at / STEPS
    return float("-inf")


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    """Cells of all words and pairs of neighbours."""
    pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:], 5)
    return (np.concatenate([hashes, pairs]) % np.uint64(cells)).astype(np.int64)


def _count(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, own = np.zeros(cells, np.int64), np.zeros((FOLDS, cells), np.int64)
        for batch in batches:
            for fold, text in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                words = space_words(text and lowered(text))
                if words:
                    counts = np.bincount(_cells(hash_words(words), cells), minlength=0)
                    raw[: len(counts)] += counts
                    if fold is not None:
                        own[fold, : len(counts)] += counts
        found = np.flatnonzero(raw)
        columns = [found.astype(np.int32), raw[found], *own[:, found]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "raw", *[f"own{k}" for k in range(FOLDS)]])

    return run


def _score(cells: int, model):
    names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "held_out"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = model.value
        for batch in batches:
            rows = [statistics(t) for t in binary(batch.column(2))]
            found = [_cells(h, cells) if len(h) else None for *_, h in rows]
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            scores = [0.0 if c is None else float(ratios[FOLDS][c].mean()) for c in found]
            held = [None if f is None else 0.0 if c is None else float(ratios[f][c].mean()) for f, c in zip(batch.column(1).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(scores, pa.float64()), pa.array(held, pa.float64())], names)

    return run


def statistics(text: bytes | None) -> tuple[int, int, int, int, int, np.ndarray]:
    """Words, their code points, symbols, repeated lines, words in repeated windows; hashes of the lower-case words."""
    text = text or b""
    words = text.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(text.count(SYMBOLS[k : k + 1]) for k in range(len(SYMBOLS)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated(ids, len(number)), hash_words([lowered(w) for w in words])


def repeated(ids: np.ndarray, kinds: int) -> int:
    """Words in three-word windows that are found twice or more."""
    n = len(ids) - 2
    if n < 2 or kinds == len(ids):
        return 0
    _, pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
    _, where, counts = np.unique(pairs[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[where] > 1)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[twice + k] = True
    return int(covered.sum())
