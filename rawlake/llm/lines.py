"""Removal of repeated runs of lines, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import document_key, join_counted, materialize, packed, prepare, unpacked

SIZE = 3  # lines in a window


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Remove lines that a window of ``size`` lines covers which occurred before.

    All runs of ``size`` consecutive lines overlap; of each sequence of lines
    found more than once in the corpus, the first place by id (nulls first),
    text hash and position stays, and the lines under all later places go.
    Windows of white space alone don't count, and texts of fewer lines have no
    window. One row per input row: the id, ``n_lines``, ``n_removed`` and
    ``text`` with the kept lines. A null text has no lines and stays null; an
    empty one has one empty line. Rows equal in id and text are one document:
    none of them is a later place of another, and all get the same result.
    Other columns of ``docs`` are not read.
    """
    later = _later(docs, id_col, text_col, size)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = _marked(rows, later, "id", "text", size)
    kept, n_lines, n_removed = _kept()
    return marked.select(F.col("id").alias(id_col), n_lines.alias("n_lines"), n_removed.alias("n_removed"), kept.alias("text"))


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", size: int = SIZE) -> DataFrame:
    """``docs`` with all its columns, repeated lines removed from the texts.

    As ``deduplicate``; a document that loses all its lines goes, one that was
    empty or null before stays. The characters of a changed text are counted anew
    in ``length_col``, if there is such a column.
    """
    rows = packed(docs, id_col, text_col)
    marked = _marked(rows, _later(docs, id_col, text_col, size), id_col, text_col, size)
    kept, n_lines, n_removed = _kept()
    some = n_removed > 0
    out = marked.filter((n_removed == 0) | (n_removed < n_lines)).withColumn("_kept", F.when(some, kept).otherwise(F.col(text_col)))
    changed = {text_col: F.col("_kept")}
    if length_col in docs.columns:
        length = F.char_length("_kept").cast(docs.schema[length_col].dataType)
        changed[length_col] = F.when(some, length).otherwise(F.col("_row").getField(length_col))
    return unpacked(out, docs.columns, **changed)


def _lines(text: str) -> Column:
    return F.split(text, "\n", -1)


def _later(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Starts of the windows of each document that occurred before."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(*document_key("id", "text"), _lines("text").alias("lines"))
    count = F.size("lines")
    starts = F.when(count >= size, F.sequence(F.lit(1), count - (size - 1))).otherwise(F.array().cast("array<int>"))
    places = F.transform(
        F.filter(starts, lambda i: F.array_join(F.slice("lines", i, size), "").rlike(r"\S")),
        lambda i: F.struct(
            i.alias("pos"), F.xxhash64(F.slice("lines", i, size)).alias("h1"), F.xxhash64(F.lit("w"), F.slice("lines", i, size)).alias("h2")
        ),
    )
    windows = rows.select("id", "_thash", F.explode(places).alias("w")).select("id", "_thash", "w.*")
    firsts = windows.groupBy("h1", "h2").agg(F.min(F.struct("id", "_thash", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialize(firsts.filter("n > 1"), "repeated-lines")
    later = join_counted(windows, firsts, ["h1", "h2"], "n").filter(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("_thash") == F.col("first._thash")) & (F.col("pos") == F.col("first.pos")))
    )
    return later.groupBy(F.col("id").alias("_r_id"), F.col("_thash").alias("_r_thash")).agg(F.collect_set("pos").alias("_starts"))


def _marked(docs: DataFrame, later: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``docs`` with its lines and the numbers, from 1, of those that later windows cover."""
    same = docs[id_col].eqNullSafe(later["_r_id"]) & (F.xxhash64(docs[text_col]) == later["_r_thash"])
    gone = F.array_distinct(F.flatten(F.transform("_starts", lambda p: F.sequence(p, p + (size - 1)))))
    joined = docs.join(later, same, "left")
    return joined.withColumns({"_lines": _lines(text_col), "_gone": F.coalesce(gone, F.array().cast("array<int>"))})


def _kept() -> tuple[Column, Column, Column]:
    """Kept text, lines before, lines removed."""
    numbers = F.array_except(F.sequence(F.lit(1), F.size("_lines")), "_gone")
    left = F.transform(numbers, lambda i: F.element_at("_lines", i))
    text = F.array_join(F.when(F.size("_gone") == 0, F.col("_lines")).otherwise(left), "\n")
    n_lines = F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("bigint")
    return text, n_lines, F.size("_gone").cast("bigint")
