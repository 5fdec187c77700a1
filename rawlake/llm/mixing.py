"""Mixing sources to target weights by balanced sampling (the cube method)."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawlake.llm.common import join_counted, materialize, prepare

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # total target, as a part of all sizes
CAP = 2  # most that a source's target may be, in sizes of the source
BLOCK = 2048  # documents that one flight balances
SEED = 20240229

# What is not white space.
WORD = r"[^\x20\x09-\x0D]+"


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, seed: int = SEED, keep_key: bool = False,
) -> DataFrame:
    """How many whole copies of each document a mix by source weights takes.

    Sources in code point order, null last as a source of its own, get
    ``weights`` in turn. Targets are in proportion to them and add up to
    ``share`` of all words, except that none exceeds ``cap`` times its source;
    the excess goes to the others by weight. Every document gets the whole
    copies in its source's rate, and the fractional rest is an inclusion
    probability that the cube method turns into 0 or 1: a flight moves three
    probabilities at a time within the null space of the constraints (words and
    documents) until at most two per block are fractional, those of all blocks
    fly on together, and the last two of a source land on the roundings nearest
    to its words. Blocks and steps depend on ids and texts alone, so reruns agree.

    One row per input row: the id, ``size`` (words; null or empty text: 0),
    ``source_size``, ``target``, ``copies`` and ``taken`` (``copies * size``).
    Rows equal in id, text and source are separate documents, any of which may
    be taken more often. A source without words has target and copies 0. ``keep_key``
    adds the source and ``_thash``, the hash of the text. No other columns are read.
    """
    prepare(docs.sparkSession)
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    source = F.col(source_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("key"), size.alias("size"),
        F.xxhash64(text_col).alias("_thash"), source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("source"),
    )
    rows = materialize(rows, "mix-sizes")
    targets = materialize(_targets(rows, weights, share, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    level = join_counted(rows, targets, ["no_source", "source"], "n").select(
        "id", "key", "_thash", "no_source", "source", "size", "source_size", "target", "rank", F.floor(rate).cast("bigint").alias("whole"), (rate - F.floor(rate)).alias("part"), "n"
    )
    done = None
    for number in itertools.count():
        blocks = F.ceil(F.col("n") / block)
        dealt = level.withColumn("last", blocks <= 1).withColumn("block", F.pmod(F.xxhash64("key", F.lit(number)), blocks))
        flown = materialize(dealt.groupBy("rank", "block").applyInArrow(_flight(seed, number), dealt.schema), f"mix-flight-{number}")
        settled = flown.filter("part = 0 OR part = 1")
        done = settled if done is None else done.unionByName(settled)
        open_rows = flown.filter("part > 0 AND part < 1").drop("n", "last", "block")
        counts = materialize(open_rows.groupBy("rank").agg(F.count(F.lit(1)).alias("n")), f"mix-open-{number}")
        if counts.isEmpty():
            break
        level = join_counted(open_rows, counts, ["rank"], "n")
    copies = (F.col("whole") + F.col("part")).cast("bigint")
    return done.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        *[F.col("_thash"), F.when(~F.col("no_source"), F.col("source")).alias(source_col)] * keep_key,
    )


def _targets(rows: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """One row per source: its size, rows, place in the order and target."""
    keys = ["no_source", "source"]
    totals = rows.groupBy(*keys).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranks without one task for all: places within ranges, then the ranges' counts.
    ranged = materialize(totals.repartitionByRange(parts, *keys).withColumn("range", F.spark_partition_id()), "mix-totals")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("here")).withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*keys))
    ranked = ranged.withColumn("place", place).join(F.broadcast(counts), "range").withColumn("rank", F.col("before") + F.col("place") - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.select(*keys, "source_size", "n", "rank", weight.alias("weight")), "mix-ranked")

    # Only sums come here. A target at its cap stays there, so this ends.
    level, capped = 0.0, None
    while True:
        full = F.col("weight") * F.lit(level) >= cap * F.col("source_size") if capped is not None else F.lit(False)
        now, fixed, free, total = ranked.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight"))), F.sum("source_size")
        ).first()
        if now == capped or not free:
            break
        level, capped = (share * total - cap * (fixed or 0)) / free, now
    target = F.least(cap * F.col("source_size").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select(*keys, "source_size", "n", "rank", target.alias("target"))


def _flight(seed: int, number: int):
    def fly(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["size"].to_numpy(), table["key"].to_numpy()))
        table = table.take(pa.array(order))
        sizes, parts = table["size"].to_numpy().astype(float), table["part"].to_numpy().copy()
        steps = np.random.default_rng([seed, number, table["rank"][0].as_py(), table["block"][0].as_py()])
        left = balance(sizes, parts, steps)
        if table["last"][0].as_py():
            land(sizes, parts, left)
        return table.set_column(table.schema.get_field_index("part"), table.schema.field("part"), pa.array(parts))

    return fly


def balance(sizes: np.ndarray, parts: np.ndarray, steps: np.random.Generator) -> list[int]:
    """Move ``parts`` to 0 or 1, keeping their sum and their sum of sizes.

    Changes ``parts``; returns the places, two at most, left in between.
    """
    parts[parts < 1e-12] = 0
    parts[parts > 1 - 1e-12] = 1
    waiting = iter(np.flatnonzero((parts > 0) & (parts < 1)).tolist())
    moving = list(itertools.islice(waiting, 3))
    while len(moving) >= 2:
        s = [sizes[k] for k in moving]
        if len(moving) == 3 and not s[0] == s[1] == s[2]:
            way = [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
        elif s[0] == s[1]:
            way = [1.0, -1.0, 0.0]
        else:
            break
        pairs = [(parts[k], w) for k, w in zip(moving, way) if w]
        up = min((1 - p) / w if w > 0 else -p / w for p, w in pairs)
        down = min(p / w if w > 0 else (p - 1) / w for p, w in pairs)
        step = up if steps.random() * (up + down) < down else -down
        for k, w in zip(moving, way):
            value = parts[k] + step * w
            parts[k] = 0.0 if value < 1e-9 else 1.0 if value > 1 - 1e-9 else value
        moving = [k for k in moving if 0 < parts[k] < 1]
        moving += itertools.islice(waiting, 3 - len(moving))
    return moving


def land(sizes: np.ndarray, parts: np.ndarray, left: list[int]) -> None:
    """Round the last places so that words, then documents, change least."""
    choices = itertools.product((0.0, 1.0), repeat=len(left))
    miss = lambda way: (abs(sum((w - parts[k]) * sizes[k] for w, k in zip(way, left))), abs(sum(w - parts[k] for w, k in zip(way, left))), way)
    parts[left] = min(choices, key=miss)
