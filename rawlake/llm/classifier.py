"""Quality grades by ordinal (cumulative link) regression on hashed text.

All grades share one weight per hashed feature; ordered thresholds cut the sum of
a text's weights into grades. That gives each text the probability of reaching any
grade and an expected grade.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import binary, hash_words, letter_words, materialize, prepare

GRADES = 3
SAMPLE = 20_000  # rated documents that are fitted on, at most
FEATURES = 1 << 20
LEAST_TEXTS = 5  # rated documents that must have a feature
TELLING = 16.0  # least chi-square of a feature over the grades; noise is left out
EPOCHS = 40
BATCH = 64
RATE = 0.3
DECAY = 1e-4
SEED = 7

# Letters, capitals, digits and all beyond ASCII by kind; marks as they are.
_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray  # ordered thresholds, one below each grade but the lowest

    def tails(self, margins: np.ndarray) -> np.ndarray:
        """Probability of each grade from the second on, or higher."""
        return 1 / (1 + np.exp(-np.clip(margins[:, None] - self.cuts, -40, 40)))


def features(text: bytes | None) -> np.ndarray:
    """Hashed features that a text has: its words, and how common word shapes and repetitions are."""
    tokens = text.split() if text else []
    if not tokens:
        return np.zeros(0, np.int32)
    own = set(letter_words(text))
    n = len(tokens)
    shapes = Counter([s[:1] + b" " + s[-2:] for s in text.translate(_SHAPE).split()])
    # Parts of the words are told apart by halving.
    own.update(b"\x01%b %d" % (s, (n // c).bit_length()) for s, c in shapes.items() if 64 * c >= n)
    same = sum(map(bytes.__eq__, tokens, tokens[1:]))
    own.add(b"\x02%d" % (10 * same // n))
    own.add(b"\x03%d" % (10 * len(set(tokens)) // n))
    own.add(b"\x04%d" % n.bit_length())
    return np.unique(hash_words(list(own)) & np.uint64(FEATURES - 1)).astype(np.int32)


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE) -> Model:
    """Fit on the ``sample`` rated documents whose ids hash lowest, or all if fewer.

    Grades are 0 to ``GRADES - 1``; null ids and grades are left out, and of
    several grades of one id the lowest holds. Rated ids without a document, and
    documents without words, add nothing; with no rating at all weights are 0.
    """
    prepare(docs.sparkSession)
    rated = ratings.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna()
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade")).withColumn("order", F.xxhash64("id"))
    rated = F.broadcast(rated.orderBy("order", F.col("id").cast("string")).limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(rated, "id").select("order", "grade", "text")
    # Written first: the one task of the fit must not read the whole corpus too.
    found = materialize(texts.mapInArrow(_extract, "order bigint, grade int, features binary"), "rated-features")
    row = found.coalesce(1).mapInArrow(_fit, "weights binary, cuts array<double>").first()
    return Model(np.frombuffer(row.weights, np.float32), np.array(row.cuts))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [features(t).tobytes() for t in binary(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary())], ["order", "grade", "features"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
    rows = sorted(r for r in rows if r[2])
    model = train([np.frombuffer(f, np.int32) for *_, f in rows], np.array([g for _, g, _ in rows], np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.cuts.tolist()], pa.list_(pa.float64()))], ["weights", "cuts"]
    )


def train(texts: list[np.ndarray], grades: np.ndarray) -> Model:
    """Minimise the negative log-likelihood by adaptive gradient steps."""
    weights = np.zeros(FEATURES, np.float64)
    shares = [(np.sum(grades >= j) + 1) / (len(grades) + 2) for j in range(1, GRADES)]
    cuts = np.array([np.log((1 - s) / s) for s in shares])
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(GRADES - 1))
    texts = _telling(texts, grades)
    speed, cut_speed, order = np.full(FEATURES, 1e-2), np.full(GRADES - 1, 1.0), np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        places = order.permutation(len(texts))
        for at in range(0, len(places), BATCH):
            rows = places[at : at + BATCH]
            lengths = [len(texts[k]) for k in rows]
            flat, owner = np.concatenate([texts[k] for k in rows]), np.repeat(np.arange(len(rows)), lengths)
            y = grades[rows]
            margins = np.bincount(owner, weights[flat], len(rows))
            slope, cut_slope = _gradient(margins, y, cuts)
            used, where = np.unique(flat, return_inverse=True)
            step = np.bincount(where, slope[owner], len(used)) / len(rows) + DECAY * weights[used]
            speed[used] += step * step
            weights[used] -= RATE * step / np.sqrt(speed[used])
            cut_speed += cut_slope * cut_slope
            cuts = np.maximum.accumulate(cuts - 0.1 * cut_slope / np.sqrt(cut_speed) + 0)
            cuts[1:] = np.maximum(cuts[1:], cuts[:-1] + 1e-3)
    return Model(weights.astype(np.float32), cuts)


def _telling(texts: list[np.ndarray], grades: np.ndarray) -> list[np.ndarray]:
    """Of each text the features that are not rare and are dealt unevenly over the grades."""
    common = np.zeros((GRADES, FEATURES), np.float32)
    for t, g in zip(texts, grades):
        common[g, t] += 1
    total = common.sum(axis=0)
    uneven = np.zeros(FEATURES, np.float32)
    for g in range(GRADES):
        expected = total * np.mean(grades == g) if len(grades) else total
        uneven += (common[g] - expected) ** 2 / np.maximum(expected, 1e-9)
    used = (total >= LEAST_TEXTS) & (uneven >= TELLING)
    return [t[used[t]] for t in texts]


def _gradient(margins: np.ndarray, y: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the loss by margin, for each text, and by threshold, on average."""
    n = len(y)
    tails = 1 / (1 + np.exp(-np.clip(margins[:, None] - cuts, -40, 40)))
    upper = np.concatenate([np.ones((n, 1)), tails, np.zeros((n, 1))], axis=1)
    here, above = upper[np.arange(n), y], upper[np.arange(n), y + 1]
    slope = here + above - 1
    gap = np.maximum(here - above, 1e-9)
    by_cut = np.zeros((n, len(cuts) + 2))
    by_cut[np.arange(n), y] += here * (1 - here) / gap
    by_cut[np.arange(n), y + 1] -= above * (1 - above) / gap
    return slope, by_cut[:, 1:-1].mean(axis=0)


def grade(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``_grade``: ``expected`` grade, and ``tail``, the probability of the highest.

    Every text is scored whole. Null, empty and blank texts get grade 0 and tail
    0, as there is nothing to keep. All columns stay as they are, whatever their
    names; one already called ``_grade`` is replaced.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast((model.weights, model.cuts))

    @F.arrow_udf("struct<expected:double,tail:double>")
    def scored(texts: pa.Array) -> pa.Array:
        own = Model(*shared.value)
        found = [features(t) for t in binary(texts)]
        tails = own.tails(np.array([own.weights[f].sum(dtype=np.float64) for f in found]))
        tails[[not len(f) for f in found]] = 0
        return pa.StructArray.from_arrays([pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], ["expected", "tail"])

    return docs.withColumn("_grade", scored(F.col(text_col)))
