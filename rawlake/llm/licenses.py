"""License notices in documents, found by voting on offset diagonals.

All three-word runs of all documents are joined with those of the notices; a run
at word p that a notice has at word t votes for the offset p - t. Votes are summed
by offset, neighbouring offsets (words left out or put in) are merged, and a span
counts if the words it shares cover enough of the notice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawlake.llm.common import binary, document_key, hash_words, letter_words, materialize, prepare, rolling

GRAM = 3  # words in a run
SLACK = 3  # words that neighbouring offsets may be apart
LEAST = 0.75  # part of a notice's words that a span must cover

# Phrases whose places are always reported, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Wording of common notices, and their labels.
NOTICES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES
) -> DataFrame:
    """Phrases, notices and labels of every document.

    One row per input row: the id, ``n_words``, ``n_base`` (places of phrases),
    ``first_word`` and ``last_word`` (their smallest and largest start, null if
    none), ``base_labels``, ``labels`` (those of phrases and accepted spans;
    distinct, sorted), ``spans`` (label, start, end, cover; in words, end
    exclusive) and ``score``: 1 with a phrase, else the best cover, else 0. Words
    are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower
    case. Null and empty texts have no words; notices shorter than a run
    never match. Rows equal in id and text are one document and get the same result.
    No other columns are read.
    """
    spark = prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(*document_key("id", "text"), "text")
    columns = f"id {id_type}, _thash bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>"
    base = texts.mapInArrow(_base([(p.encode(), label) for p, label in phrases]), columns)

    grams = texts.mapInArrow(_grams, f"id {id_type}, _thash bigint, grams array<bigint>")
    runs = grams.select("id", "_thash", F.posexplode("grams").alias("pos", "gram"))
    own = [letter_words(text.encode()) for _, text in notices]
    known = [(int(g), k, t) for k, w in enumerate(own) for t, g in enumerate(rolling(hash_words(w), GRAM).view(np.int64))]
    # As many rows as the notices have words.
    votes = runs.join(F.broadcast(spark.createDataFrame(known, "gram bigint, notice int, at int")), "gram")
    diagonal = votes.groupBy("id", "_thash", "notice", (F.col("pos") - F.col("at")).alias("offset")).agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("start"), F.max("pos").alias("last")
    )
    diagonal = materialize(diagonal, "license-votes")
    line = Window.partitionBy("id", "_thash", "notice").orderBy("offset")
    new = (F.col("offset") - F.lag("offset").over(line) > SLACK).cast("int")
    bands = diagonal.withColumn("new", F.coalesce(new, F.lit(0))).withColumn("band", F.sum("new").over(line))
    spans = bands.groupBy("id", "_thash", "notice", "band").agg(
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.min("start").alias("start"), (F.max("last") + GRAM).alias("end")
    )
    facts = spark.createDataFrame([(k, label, len(w)) for k, ((label, _), w) in enumerate(zip(notices, own))], "notice int, label string, length int")
    words = F.array_distinct(F.flatten(F.transform("ats", lambda t: F.sequence(t, t + (GRAM - 1)))))
    spans = spans.join(F.broadcast(facts), "notice").withColumn("cover", F.size(words) / F.col("length"))
    spans = spans.filter((F.col("cover") >= LEAST) & (F.col("end") - F.col("start") <= 2 * F.col("length")))
    found = spans.groupBy(F.col("id").alias("s_id"), F.col("_thash").alias("s_thash")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "cover"))).alias("spans"), F.max("cover").alias("best")
    )
    joined = base.join(found, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("_thash") == F.col("s_thash")), "left")
    none = F.array().cast("array<struct<start:int,end:int,label:string,cover:double>>")
    more = F.coalesce(F.transform("spans", lambda s: s["label"]), F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.sort_array(F.array_union("base_labels", more)).alias("labels"), F.coalesce("spans", none).alias("spans"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _base(phrases: list[tuple[bytes, str]]):
    names = ["id", "_thash", "n_words", "n_base", "first_word", "last_word", "base_labels"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [places(letter_words(t), phrases) for t in binary(batch.column(2))]
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            labels = pa.array([r[4] for r in rows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, labels], names)

    return run


def places(words: list[bytes], phrases: list[tuple[bytes, str]]) -> tuple[int, int, int | None, int | None, list[str]]:
    """Words, places of all phrases, smallest and largest start, labels."""
    line, starts, labels = b" " + b" ".join(words) + b" ", [], set()
    for phrase, label in phrases:
        at = line.find(b" " + phrase + b" ")
        passed = counted = 0
        while at >= 0:
            counted, passed = counted + line.count(b" ", passed, at), at
            starts.append(counted)
            labels.add(label)
            at = line.find(b" " + phrase + b" ", at + 1)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [rolling(hash_words(letter_words(t)), GRAM).view(np.int64) for t in binary(batch.column(2))]
        ends = np.concatenate([[0], np.cumsum([len(g) for g in own])]).astype(np.int32)
        grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own) if own else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), grams], ["id", "_thash", "grams"])
