"""Reverse lineage: from output paths back to the raw files behind them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlake.sources.templates import DIGITS, derive_parts, regex_groups

# What the other placeholders of a path may hold.
NAME_PATTERNS = {"table": "[A-Za-z0-9_]+", "seq_num": "[0-9]+", "file_name": "[^/]+"}


def template_groups(template: str) -> tuple[str, list[str]]:
    """Regex with one group per placeholder occurrence, and their names."""
    out, names = [], []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            out.append(re.escape(piece))
            continue
        digits = DIGITS.get(piece, "")
        if piece in DIGITS:
            pattern = "[0-9]{%d}" % digits if digits else "[0-9]+"
        else:
            pattern = NAME_PATTERNS.get(piece, "[^/]+")
        out.append(f"({pattern})")
        names.append(piece)
    return "".join(out), names


def parse_path(df: DataFrame, path: Column, template: str, strict: bool = True) -> tuple[DataFrame, dict[str, Column]]:
    """Variables and date parts of a path made from ``template``.

    A placeholder that occurs twice must have one value. With ``strict`` a path
    that does not fit raises, else its values are null. The columns refer to
    the returned frame, where the path was matched once.
    """
    pattern, names = template_groups(template)
    cells = regex_groups(path, pattern, len(names))
    if strict:
        bad = F.raise_error(F.concat(F.lit("Path does not fit the template: "), path)).cast("array<string>")
        cells = F.coalesce(cells, bad)
    df = df.withColumn("_cells", cells)
    found: dict[str, Column] = {}
    for name in dict.fromkeys(names):
        values = [F.get("_cells", F.lit(i)) for i, n in enumerate(names) if n == name]
        value = values[0]
        for other in values[1:]:
            message = F.concat(F.lit(f"Placeholder {{{name}}} has two values in "), path)
            value = F.when(value == other, value).when(value.isNull(), None).otherwise(F.raise_error(message))
        found[name] = value
    dates = derive_parts({k: v for k, v in found.items() if k in DIGITS}, keep_first=True)
    return df, {**found, **dates}


def relative(path: Column, basedir: str) -> Column:
    prefix = basedir.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, F.lit(len(prefix) + 1), F.length(path))).otherwise(path)


def parse_outputs(outputs: DataFrame, template: str, basedir: str = "", table: str | None = None) -> DataFrame:
    """Add ``vars`` (a map) and the key columns to output paths (``output``)."""
    path = relative(F.col("output"), basedir) if basedir else F.col("output")
    outputs, values = parse_path(outputs, path, template)
    if table is not None:
        values["table"] = F.lit(table)
    return _with_vars(outputs, values)


def parse_raw(raw: DataFrame, templates: list[str]) -> DataFrame:
    """Add ``vars`` and ``template_ord`` to raw paths (``path``); a path may
    belong to several templates, and to none."""
    frames = []
    for i, template in enumerate(templates):
        parsed, values = parse_path(raw, F.col("path"), template, strict=False)
        fits = parsed.where(F.col("_cells").isNotNull()).withColumn("template_ord", F.lit(i))
        frames.append(_with_vars(fits, values))
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _with_vars(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    pairs = [x for name, value in values.items() for x in (F.lit(name), value)]
    return df.withColumn("vars", F.create_map(*pairs)).drop("_cells").withColumn("d", F.try_element_at("vars", F.lit("YYYYMMDD")))


def trace(outputs: DataFrame, raw: DataFrame, how: str = "left", by: tuple[str, ...] = (), key: str = "YYYYMMDD") -> DataFrame:
    """Raw files of every output, as one equi-join on date and variables.

    ``outputs`` and ``raw`` come from the parse functions; ``by`` names the
    variables both sides know. A left join keeps outputs without raw files.
    """

    def keyed(df: DataFrame, prefix: str) -> DataFrame:
        names = [key, *by]
        return df.withColumns({f"_{prefix}_{n}": F.try_element_at("vars", F.lit(n)) for n in names}).drop("vars", "d")

    left, right = keyed(outputs, "o"), keyed(raw, "r")
    missing = F.raise_error(F.concat(F.lit("No date in output path: "), F.col("output"))).cast("string")
    left = left.withColumn(f"_o_{key}", F.coalesce(F.col(f"_o_{key}"), missing))
    on = F.lit(True)
    for name in [key, *by]:
        on = on & (F.col(f"_o_{name}") == F.col(f"_r_{name}"))
    joined = left.join(right, on, how)
    out = joined.withColumn("d", F.coalesce(F.col(f"_o_{key}"), F.col(f"_r_{key}")))
    return out.drop(*[f"_{p}_{n}" for p in "or" for n in [key, *by]])


def report(traced: DataFrame) -> DataFrame:
    """JSON report per output, with the raw files in path order.

    The files of one output are few; the report is per output, not per run.
    """
    entry = F.when(F.col("path").isNotNull(), F.struct("path", "d"))
    grouped = traced.groupBy("output").agg(
        F.count("path").alias("raw_files_count"), F.sort_array(F.collect_list(entry)).alias("raw_files")
    )
    return grouped.select("output", F.to_json(F.struct("output", "raw_files_count", "raw_files")).alias("report"))
