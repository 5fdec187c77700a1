"""Near-duplicates by SimHash, pairs pruned by distances to reference fingerprints.

Fingerprints that differ in three bits or fewer agree in two of five groups of
bits, so candidates meet under ten masks; a bucket with too many members is dealt
out again under finer masks, by the same argument, until it is small. Within a
bucket, distances of all members to fixed reference fingerprints form a table:
the distance of two members is at least the largest difference of their rows, so
pairs beyond it are discarded unseen, and only the others are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import binary, document_key, hash_words, join_counted, lowered, materialize, mixed, prepare, rolling
from rawlake.llm.components import components

WORDS = 3  # in a shingle
BITS = 3  # that linked fingerprints may differ in
SEED = 42
GROUPS = BITS + 2
BUCKET = 1024  # members that one comparison takes on
PAIRS = 1 << 22  # pairs that are looked at together
# Any values do; these tell fingerprints apart better the more there are.
REFERENCES = mixed(np.arange(1, 17, dtype=np.uint64), 11)


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, keep_key: bool = False) -> DataFrame:
    """Fingerprint and group of every document.

    One row per input row: the id, ``fingerprint`` (64 bits as a bigint) and
    ``component_id``, the smallest id that links of at most three differing bits
    reach, its own included, and ``group``, which is never null. Words are white-space separated, A-Z in lower case;
    a text of fewer words than a shingle is one shingle; null, empty and blank
    texts have fingerprint 0 and are linked like any other. Null ids are carried;
    a group without any other id has a null ``component_id``. Repeated rows are
    in one group. ``keep_key`` adds ``_thash``, the hash of the text. No other
    columns of ``docs`` are read.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(*document_key("id", "text"), "text")
    prints = materialize(texts.mapInArrow(_fingerprints(words), f"id {id_type}, _thash bigint, fp bigint"), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    found = materialize(components(_links(classes.select("fp"))), "components")
    known = found.join(classes.select(F.col("fp").alias("node"), "least"), "node")
    roots = materialize(known.groupBy("root").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("members")), "groups")
    joined = join_counted(found, roots, ["root"], "members").select(F.col("node").alias("fp"), "first", "root")
    # Ids of a group without links of other texts are its own least.
    component = F.when(F.col("root").isNotNull(), F.col("first")).otherwise(F.col("least")).alias("component")
    whole = classes.join(joined, "fp", "left").select("fp", "n", component, F.coalesce("root", "fp").alias("group"))
    return join_counted(prints, materialize(whole, "class-groups"), ["fp"], "n").select(
        F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), F.col("component").alias("component_id"), "group", *["_thash"] * keep_key
    )


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((simhash(t, words) for t in binary(batch.column(2))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["id", "_thash", "fp"])

    return run


def simhash(text: bytes | None, words: int = WORDS) -> int:
    own = lowered(text).split() if text else []
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in own))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[words - 1 :])], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.uint32) > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks() -> list[int]:
    parts = [sum(1 << int(k) for k in ks) for ks in np.array_split(np.arange(64), GROUPS)]
    return [a | b for a, b in combinations(parts, GROUPS - BITS)]


def finer(mask: int) -> list[int]:
    """``mask`` with each quarter of its free bits: one holds for any pair under ``mask``."""
    free = [k for k in range(64) if not mask >> k & 1]
    return [mask | sum(1 << int(k) for k in ks) for ks in np.array_split(free, BITS + 1)]


def _links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all distinct fingerprints within reach of each other."""
    spark, masks, found = prints.sparkSession, _masks(), None
    level = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        level = level.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        counts = level.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts.filter("n > 1"), "bucket-sizes")
        met = join_counted(level, counts, ["mask", "key"], "n")
        fits = F.col("n") <= BUCKET
        buckets = met.filter(fits).groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
        linked = materialize(buckets.select("members").mapInArrow(_compare, "a bigint, b bigint").distinct(), "close-pairs")
        found = linked if found is None else found.unionByName(linked)
        if counts.filter(~fits).isEmpty():
            return found
        # Different masks have finer masks in common: a fingerprint is counted once
        # under each, so all fit with ten free bits or fewer, and the rounds end.
        pairs = [(_signed(m), _signed(f)) for m in masks for f in finer(m)]
        steps = F.broadcast(spark.createDataFrame(pairs, "mask bigint, next bigint"))
        masks = sorted({f for m in masks for f in finer(m)})
        level = materialize(met.filter(~fits).join(steps, "mask").select("fp", F.col("next").alias("mask")).distinct(), "large-buckets")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(0)
        sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
        ends = np.cumsum(sizes)
        values = column.flatten().to_numpy().view(np.uint64)
        rounds = np.cumsum(sizes * sizes) // PAIRS
        cuts = [0, *(np.flatnonzero(np.diff(rounds)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                begin, end = int(ends[a] - sizes[a]), int(ends[b - 1])
                left, right = connect(values[begin:end], np.repeat(np.arange(b - a), sizes[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])


def connect(values: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each value to the first of those reachable within its buckets."""
    table = np.bitwise_count(values[:, None] ^ REFERENCES).astype(np.int8)
    order = np.lexsort((table[:, 0], bucket))
    values, bucket, table = values[order], bucket[order], table[order]
    ones, others = [], []
    at = np.arange(len(values))
    for k in range(1, len(values)):
        # Sorted by the first distance: what is too far apart stays so.
        at = at[at + k < len(values)]
        at = at[(bucket[at] == bucket[at + k]) & (table[at + k, 0] - table[at, 0] <= BITS)]
        if not len(at):
            break
        close = at[(np.abs(table[at] - table[at + k]) <= BITS).all(axis=1)]
        close = close[np.bitwise_count(values[close] ^ values[close + k]) <= BITS]
        ones.append(close)
        others.append(close + k)
    if not ones:
        return values[:0], values[:0]
    i, j = np.concatenate(ones), np.concatenate(others)
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


SHINGLE = 5  # words in a shingle of ``similar``
BANDS, ROWS = 32, 5  # least hashes: at similarity 0.8 a pair shares none of the bands once in 300,000
STARS = 2  # rounds in which members of a band meet one of them only
GATHER = 1024  # members of the largest group, and of all others, that are compared together
WIDE = 4  # 64-bit words of a wide fingerprint
# A bit of it differs with a probability of at most 0.19 at similarity 0.8; this is six deviations above.
APART = 86
DEEPEST = 3  # rounds in which buckets are dealt out by more least hashes
_FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64), 23) | np.uint64(1)
_MIX = mixed(np.arange(1, ROWS + 1, dtype=np.uint64), 29) | np.uint64(1)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group of every document by links of Jaccard similarity 0.8 or more.

    One row per input row: the id, ``_thash``, the hash of the text, and ``group``,
    which is never null. Compared are the sets of five-word shingles, words as in
    ``group``; a text of fewer words is one shingle, and null, empty and blank
    texts are one group. Rows with a null id or of equal id and text are grouped
    by their text like any other. No other columns of ``docs`` are read.

    Members of a bucket share a band of least hashes. At first each meets one of
    them only, then one for each band, which joins most groups; those still apart meet
    in buckets of bounded size, where wide SimHash fingerprints and their distances to reference
    fingerprints discard pairs. Every link is verified on the whole sets, and only
    links that join groups leave a bucket. Equal sets are one, told by 128 bits.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(*document_key("id", "text"), "text")
    sketches = materialize(texts.mapInArrow(_sketch, f"id {id_type}, _thash bigint, key binary, fp binary, bands array<bigint>"), "sketches")
    # Equal sets are one from here on.
    first = F.min(F.struct("id", "_thash")).alias("first")
    classes = sketches.groupBy("key").agg(F.first("bands").alias("bands"), F.first("fp").alias("fp"), first, F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "set-classes")
    level = classes.select("key", F.explode("bands").alias("band"))
    counts = materialize(level.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "band-sizes")
    members = materialize(join_counted(level, counts, ["band"], "n").select("band", "key"), "band-members")
    needed = classes.join(members.select("key").distinct(), "key", "left_semi").select("key", "fp", F.col("first.id").alias("_id"), F.col("first._thash").alias("_hash"))
    whole = texts.join(needed, texts["id"].eqNullSafe(needed["_id"]) & texts["_thash"].eqNullSafe(needed["_hash"])).select("key", "fp", "text")
    sets = materialize(whole.dropDuplicates(["key"]).mapInArrow(_sets, "key binary, fp binary, own binary, bands array<bigint>"), "candidate-sets")
    found, labels = None, None
    for k in range(STARS + 1):
        now = members.withColumn("root", F.col("key"))
        if labels is not None:
            now = members.join(labels.withColumnRenamed("node", "key"), "key", "left").select("band", "key", F.coalesce("root", "key").alias("root"))
            now = materialize(now, "labelled-members")
        # Only bands in which groups are still apart have anything to compare.
        number = F.xxhash64("key", *(["band"] if k else []))
        centre = F.min(F.struct(number, F.struct("key", "root").alias("at")))["at"].alias("centre")
        open_bands = now.groupBy("band").agg(centre, F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        open_bands = materialize(open_bands.filter("low < high").select("band", "n", "centre"), "open-bands")
        met = join_counted(now, open_bands, ["band"], "n").select("band", "key", "root", "centre")
        if k == STARS:
            linked = _gathered(met.select(F.col("band").alias("bucket"), "key", "root"), sets)
        else:
            pairs = met.filter(F.col("root") != F.col("centre.root")).select("key", F.col("centre.key").alias("other"))
            pairs = materialize(pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct(), "candidates")
            both = pairs.join(sets.select(F.col("key").alias("a"), F.col("fp").alias("fp_a"), F.col("own").alias("own_a")), "a")
            both = both.join(sets.select(F.col("key").alias("b"), F.col("fp").alias("fp_b"), F.col("own").alias("own_b")), "b")
            both = both.select("a", "b", "fp_a", "fp_b", "own_a", "own_b")
            linked = materialize(both.mapInArrow(_verify, "a binary, b binary"), "similar-pairs")
        found = linked if found is None else found.unionByName(linked)
        labels = materialize(components(found), "similar-groups")
    grouped = classes.select("key", "copies").join(labels.withColumnRenamed("node", "key"), "key", "left")
    grouped = materialize(grouped.select("key", "copies", F.coalesce("root", "key").alias("group")), "class-labels")
    return join_counted(sketches, grouped, ["key"], "copies").select(F.col("id").alias(id_col), "_thash", "group")


def _gathered(level: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the groups that meet in the buckets of ``level`` (bucket, key, root).

    No pair within a group is looked at again, and others in the first bucket they
    share only: buckets that are closed hold one group each. If few members are not of a bucket's
    largest group, they meet that group in shares of bounded size. If they are many,
    they are mutually unlike for the most part, and are dealt out by more least hashes,
    as many as two sets of similarity 0.8 share in one of the tables all but surely
    (once in 160,000 they do not). What is left after ``DEEPEST`` rounds of that meets
    share by share.
    """
    found, depth = None, 0
    while True:
        sizes = level.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("own"))
        sizes = sizes.groupBy("bucket").agg(F.sum("own").alias("n"), F.max(F.struct("own", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
        sizes = materialize(sizes.filter("roots > 1").select("bucket", "n", F.col("most.root").alias("main"), F.col("most.own").alias("m")), "bucket-sizes")
        rows = join_counted(level, sizes, ["bucket"], "n")
        few = F.col("n") - F.col("m") <= GATHER
        shares = F.ceil(F.col("m") / GATHER).cast("int")
        number = F.xxhash64("key", F.lit(1000 + depth))
        dealt = F.when(F.col("root") == F.col("main"), F.array(F.pmod(number, shares).cast("int"))).otherwise(F.sequence(F.lit(0), shares - 1))
        aside = F.when(F.col("root") != F.col("main"), F.lit(1)).otherwise(F.lit(0)).alias("aside")
        close = rows.filter(few).select("bucket", "key", "root", aside, F.explode(dealt).alias("share"), F.lit(0).alias("other"))
        many = rows.filter(~few)
        if depth == DEEPEST:
            blocks = F.ceil(F.col("n") / GATHER).cast("int")
            block = F.pmod(number, blocks).cast("int")
            facing = F.explode(F.sequence(F.lit(0), blocks - 1))
            apart = many.select("bucket", "key", "root", block.alias("block"), facing.alias("facing"))
            share, other = F.least("block", "facing").alias("share"), F.greatest("block", "facing").alias("other")
            close = close.unionByName(apart.select("bucket", "key", "root", F.lit(0).alias("aside"), share, other))
        met = close.join(sets, "key").select("bucket", "share", "other", "key", "root", "aside", "fp", "own", "bands")
        linked = met.groupBy("bucket", "share", "other").applyInPandas(_join_groups(depth == 0), "a binary, b binary")
        linked = materialize(linked.distinct(), "gathered-links")
        found = linked if found is None else found.unionByName(linked)
        if depth == DEEPEST or sizes.filter(~few).isEmpty():
            return found
        dealt_out = many.select("bucket", "key", "root").join(sets.select("key", "own"), "key").select("bucket", "key", "root", "own")
        level = materialize(dealt_out.mapInArrow(_finer_bands(depth), "bucket bigint, key binary, root binary"), "dealt-members")
        depth += 1


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles."""
    own = lowered(text).split() if text else []
    hashes = hash_words(own)
    if 0 < len(own) < SHINGLE:
        return hash_words([b" ".join(own)])
    return np.unique(rolling(hashes, SHINGLE))


def least_hashes(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 1024):
        np.minimum(least, (own[at : at + 1024, None] * factors).min(axis=0), out=least)
    return least


def bands(own: np.ndarray) -> np.ndarray:
    least = least_hashes(own, _FACTORS)
    return mixed((least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64), 31)


def wide_fingerprint(own: np.ndarray) -> np.ndarray:
    """SimHash of a set of hashes: a bit is set if it is in more than half of them."""
    sums = np.zeros(64 * WIDE, np.int64)
    for at in range(0, len(own), 1024):
        words = np.stack([mixed(own[at : at + 1024], 41 + k) for k in range(WIDE)], axis=1)
        sums += np.unpackbits(words.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * sums > len(own)).view(np.uint64)


def _finer_bands(depth: int):
    """Tables of so many least hashes, and so many tables, that similar sets share one."""
    width = 8 + 4 * depth
    count = int(np.ceil(12 / 0.8**width))
    factors = mixed(np.arange(1, count * width + 1, dtype=np.uint64), 47 + depth) | np.uint64(1)
    weights = mixed(np.arange(1, width + 1, dtype=np.uint64), 53 + depth) | np.uint64(1)
    names = np.arange(count, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parents = batch.column(0).to_numpy().view(np.uint64)
            out = []
            for parent, own in zip(parents, batch.column(3).to_pylist()):
                least = least_hashes(np.frombuffer(own, np.uint64), factors).reshape(count, width)
                out.append(mixed((least * weights).sum(axis=1, dtype=np.uint64) + names + mixed(parent[None], 59), 61))
            buckets = np.concatenate(out) if out else np.zeros(0, np.uint64)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), count))
            columns = [pa.array(buckets.view(np.int64)), batch.column(1).take(rows), batch.column(2).take(rows)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "key", "root"])

    return run


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owns = [shingles(t) for t in binary(batch.column(2))]
        keys = pa.array([xxhash.xxh3_128_digest(o.tobytes()) for o in owns], pa.binary())
        prints = pa.array([wide_fingerprint(o).tobytes() for o in owns], pa.binary())
        found = pa.array([bands(o).view(np.int64) if len(o) else [] for o in owns], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys, prints, found], ["id", "_thash", "key", "fp", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owns = [shingles(t) for t in binary(batch.column(2))]
        found = pa.array([bands(o).view(np.int64) if len(o) else [] for o in owns], pa.list_(pa.int64()))
        columns = [batch.column(0), batch.column(1), pa.array([o.tobytes() for o in owns], pa.binary()), found]
        yield pa.RecordBatch.from_arrays(columns, ["key", "fp", "own", "bands"])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have four fifths of their union in common."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 5 * len(small) < 4 * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0
    return 5 * both >= 4 * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(-1, WIDE) for k in (2, 3)]
        close = np.bitwise_count(prints[0] ^ prints[1]).sum(axis=1) <= APART
        pairs = zip(close.tolist(), batch.column(4).to_pylist(), batch.column(5).to_pylist())
        linked = [near and alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for near, a, b in pairs]
        yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def _join_groups(by_band: bool):
    """Verified links that join the groups of a bucket's members as far as they can be joined.

    ``by_band``: buckets are bands, so pairs that share an earlier one are left to that.
    Members ``aside`` of the largest group meet each other in the first share only.
    """

    def run(members: pd.DataFrame) -> pd.DataFrame:
        keys, owns = members["key"].tolist(), [np.frombuffer(o, np.uint64) for o in members["own"]]
        prints = np.frombuffer(b"".join(members["fp"]), np.uint64).reshape(-1, WIDE)
        label = pd.factorize(members["root"].map(bytes))[0]
        aside = members["aside"].to_numpy() * int(members["share"].iloc[0] > 0)
        own_bands = np.stack(members["bands"].tolist()) if by_band else None
        here = members["bucket"].iloc[0]
        # Distances to some of the members: two of them differ in no more bits than their rows do.
        references = prints[np.unique(np.linspace(0, len(prints) - 1, 16).astype(int))]
        table = np.stack([np.bitwise_count(prints ^ r).sum(axis=1) for r in references], axis=1).astype(np.int16)
        links = []
        for i in range(len(keys) - 1):
            rest = i + 1 + np.flatnonzero((label[i + 1 :] != label[i]) & ~(aside[i + 1 :] & aside[i]).astype(bool))
            rest = rest[(np.abs(table[rest] - table[i]) <= APART).all(axis=1)]
            distance = np.bitwise_count(prints[rest] ^ prints[i]).sum(axis=1)
            rest = rest[np.argsort(distance, kind="stable")[: int((distance <= APART).sum())]]
            if by_band and len(rest):
                same = own_bands[rest] == own_bands[i]
                rest = rest[own_bands[i][same.argmax(axis=1)] == here]
            for j in rest.tolist():
                if label[i] != label[j] and alike(owns[i], owns[j]):
                    links.append((keys[i], keys[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(links, columns=["a", "b"])

    return run
