"""Benchmark passages in documents by winnowing, in DataFrame functions only.

Of every window of ten words the least hash of its five-word runs is kept. Equal
windows keep equal hashes, so a shared window always shows; the distinct kept
hashes of a text are far fewer than its windows. Windows of documents whose hash
the benchmark has are then extended to all ten words and compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import document_key, materialize, prepare, small

WINDOW = 10  # words
GRAM = 5  # words hashed together; shared runs of WINDOW words are guaranteed to show

# What separates words, with A-Z in lower case and as they are.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CASED_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def find(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, gram: int = GRAM, keep_key: bool = False,
) -> DataFrame:
    """Which words of each document lie in a window of some benchmark item.

    Windows are all runs of ``window`` words of an item; an item of fewer words
    is one window of its own length, which is hashed whole. Words are runs of
    ASCII letters, digits and all other characters beyond ASCII, A-Z in lower case.
    One row per input row: the id, ``n_words``, ``n_hit``, ``spans`` (start and
    number of words of each occurrence, in order), ``items`` (ids as strings,
    sorted) and ``contaminated``. Null and empty texts have no words; items
    without words or id are never listed (a null id still marks words). Rows equal
    in id and text are one document and get the same result; repeated items count
    once. An empty benchmark marks nothing. ``keep_key``
    adds ``_thash``, the hash of the text. Other columns are not read.
    """
    prepare(docs.sparkSession)
    key = document_key("id", "text")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = _words(texts.filter("text IS NOT NULL"), *key)
    items = _words(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")), "item")
    items = materialize(items.filter(F.size("words") > 0), "benchmark-words")
    # At most window - 1 lengths below the usual one.
    short = sorted(r[0] for r in items.select(F.size("words").alias("n")).filter(F.col("n") < window).distinct().collect())
    kinds = [(window, gram), *((n, n) for n in short)]

    own = items.filter(F.size("words") >= window)
    parts = [_windows(own if n == window else items.filter(F.size("words") == n), ["item"], n, k, None) for n, k in kinds]
    windows = parts[0]
    for part in parts[1:]:
        windows = windows.unionByName(part)
    windows = materialize(windows.select("item", "mark", "window").distinct(), "benchmark-windows")
    marks, window_texts = windows.select("mark").distinct(), windows.select("window").distinct()
    if small(windows, 400):
        marks, window_texts = F.broadcast(marks), F.broadcast(window_texts)

    kept = [_marked(rows, n, k) for n, k in kinds]
    seen = kept[0]
    for part in kept[1:]:
        seen = seen.unionByName(part)
    hits = seen.join(marks, "mark", "left_semi").groupBy("id", "_thash").agg(F.collect_set("mark").alias("hits"))
    hits = materialize(hits.withColumnsRenamed({"id": "h_id", "_thash": "h_thash"}), "mark-hits")

    same = F.col("id").eqNullSafe(F.col("h_id")) & (F.col("_thash") == F.col("h_thash"))
    met = _words(texts.filter("text IS NOT NULL").select(*key, "text").join(hits, same), "id", "_thash", "hits")
    parts = [_windows(met, ["id", "_thash"], n, k, "hits") for n, k in kinds]
    extended = parts[0]
    for part in parts[1:]:
        extended = extended.unionByName(part)
    found = materialize(extended.join(window_texts, "window", "left_semi"), "benchmark-hits").distinct()
    spans = found.groupBy("id", "_thash").agg(F.sort_array(F.collect_set(F.struct(F.col("pos").alias("start"), F.col("n").alias("words")))).alias("spans"))
    listed = found.select("id", "_thash", "window").distinct().join(windows.select("window", "item").distinct(), "window")
    listed = listed.groupBy("id", "_thash").agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = spans.join(listed.withColumnsRenamed({"id": "l_id", "_thash": "l_thash"}), F.col("id").eqNullSafe(F.col("l_id")) & (F.col("_thash") == F.col("l_thash")), "left")
    both = both.select(F.col("id").alias("h_id"), F.col("_thash").alias("h_thash"), "spans", "items")
    # Splitting costs less than counting matches, each of which is taken out as a text.
    n_words = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.array_remove(F.split("text", _CASED_BREAK), "")))
    counted = texts.select(*key, n_words.cast("bigint").alias("n_words"))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["words"] - 1))))
    return counted.join(both, same, "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(F.col("spans").isNotNull(), F.size(covered)).otherwise(0).cast("bigint").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,words:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("spans").isNotNull().alias("contaminated"),
        *["_thash"] * keep_key,
    )


def _words(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns and the words of ``text``."""
    text = F.col("text")
    # Full lower-casing is the same on ASCII alone, and faster.
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
    return df.select(*columns, F.array_remove(F.split(lower, _BREAK), "").alias("words"))


def _grams(df: DataFrame, n: int, k: int) -> DataFrame:
    """``grams``: the hash of every ``k`` words, for texts that have ``n``; longer runs are salted by their length."""
    size = F.size("words")
    hashed = F.transform(F.sequence(F.lit(1), size - (k - 1)), lambda i: F.xxhash64(F.lit(n), F.slice("words", i, k)))
    return df.filter(size >= n).withColumn("grams", hashed)


def _least(i: Column, n: int, k: int) -> Column:
    return F.array_min(F.slice("grams", i, n - k + 1)) if n > k else F.element_at("grams", i)


def _marked(df: DataFrame, n: int, k: int) -> DataFrame:
    """Distinct kept hashes of each text."""
    least = F.transform(F.sequence(F.lit(1), F.size("grams") - (n - k)), lambda i: _least(i, n, k))
    return _grams(df, n, k).select("id", "_thash", F.explode(F.array_distinct(least)).alias("mark"))


def _windows(df: DataFrame, columns: list[str], n: int, k: int, among: str | None) -> DataFrame:
    """All windows of ``n`` words as text, by position, or those whose kept hash is in ``among``."""
    starts = F.sequence(F.lit(1), F.size("grams") - (n - k))
    if among:
        starts = F.filter(starts, lambda i: F.array_contains(among, _least(i, n, k)))
    places = F.transform(starts, lambda i: F.struct((i - 1).alias("pos"), _least(i, n, k).alias("mark"), F.array_join(F.slice("words", i, n), " ").alias("window")))
    return _grams(df, n, k).select(*columns, F.explode(places).alias("w")).select(*columns, "w.*", F.lit(n).alias("n"))
