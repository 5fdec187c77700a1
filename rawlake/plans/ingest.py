"""Raw files of a table to clean rows, and on to Parquet."""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rawlake.functions import ordered
from rawlake.operators import ordinal, sink
from rawlake.operators.columns import apply_filters, condition
from rawlake.operators.lineage import add_lineage, path_columns
from rawlake.operators.schema import Problem, conform, native_columns, tried_columns, typed_columns
from rawlake.session import configure, materialize
from rawlake.sources import scan as scans
from rawlake.sources.inventory import base_name, discover, list_files, one_glob, range_globs
from rawlake.sources.scan import NUMBERS, Scan, TextFormat
from rawlake.sources.templates import PathTemplate
from rawlake.types import lineage_schema, load_manifest, output_schema, unify

BAD = "_bad"


def text_format(spec: dict[str, Any]) -> TextFormat:
    direct = {k: spec[k] for k in ("encoding", "skipfooter") if spec.get(k) is not None}
    kind = spec.get("format", "csv")
    if kind == "sectioned":
        return TextFormat.sections(**direct)
    makers = {"csv": TextFormat.from_options, "pipe": TextFormat.pipe_preset}
    if kind not in makers:
        raise ValueError(f"Unknown input format '{kind}'")
    return makers[kind](spec.get("options"), **direct)


@dataclass
class Found:
    """Files of a template; ``glob`` names exactly these, if one does."""

    files: DataFrame
    glob: str | None = None


class Job:
    """A table to ingest.

    ``config`` is a plain dict (as loaded from YAML or JSON) with ``input``,
    ``output``, ``manifest``, ``tables`` and ``extract_vars``:

    * ``input``: ``format`` (csv, pipe, sectioned, parquet), ``file_type``,
      ``encoding``, ``options``, ``skipfooter``, ``filters``, ``extra``;
    * ``output``: ``basedir``, ``file_template``, ``metadata``, ``writer_kwargs``;
    * ``manifest``: ``file_template`` or the ``schema`` itself;
    * ``tables.<name>``: ``raw_files``, ``aggregate``, ``output_file_template``.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: dict[str, Any],
        table: str,
        search_params: dict[str, str] | None = None,
        basedir: str | None = None,
        creation_time: dt.datetime | None = None,
        transforms: list[Callable[[DataFrame], DataFrame]] | None = None,
    ) -> None:
        if table not in config["tables"]:
            raise KeyError(f"Table '{table}' is not one of {sorted(config['tables'])}")
        self.spark = configure(spark)
        self.table = table
        self.spec = config["tables"][table]
        self.input = config.get("input", {})
        self.output = config.get("output", {})
        self.metadata = self.output.get("metadata") or {}
        self.aggregate = self.spec.get("aggregate", False)
        self.basedir = basedir or self.output.get("basedir", "")
        self.output_template = self.spec.get("output_file_template") or self.output.get("file_template", "")
        if basedir:
            self.output_template = "{table}_{YYYYMMDD}.parq"
        self.creation_time = creation_time or dt.datetime.now(dt.timezone.utc)
        self.transforms = transforms or []
        file_type = self.input.get("file_type", "date")
        self.templates = [
            PathTemplate(t, search_params, config.get("extract_vars"), file_type) for t in self.spec["raw_files"]
        ]
        manifest = config["manifest"]
        if "schema" not in manifest:
            template = os.path.join(self.output.get("basedir", ""), manifest["file_template"])
            manifest = template.replace("{table}", table)
        self.schema = load_manifest(spark, manifest)
        self.format = text_format(self.input) if self.input.get("format") != "parquet" else None

    # -- reading ---------------------------------------------------------------

    def inventory(self, start: str | None = None, end: str | None = None, allow_empty: bool = False) -> list[Found]:
        """Inventory per template, for an inclusive key range or everything."""
        end = start if end is None else end
        found = []
        for template in self.templates:
            globs = [template.glob()] if start is None else range_globs(template, start, end)
            files = discover(self.spark, template, start, end, creation_time=self.creation_time)
            files = materialize(files.where("matched"), "inventory")
            # If the globs name exactly these files, scans take the globs and
            # no list of paths has to pass through the driver.
            exact = not template.is_zip and list_files(self.spark, globs).count() == files.count()
            found.append(Found(files, one_glob(globs) if exact else None))
        if not allow_empty and all(f.files.isEmpty() for f in found):
            raise FileNotFoundError(f"No raw files for table '{self.table}' in {start}..{end}")
        return found

    def rows(
        self,
        start: str | None = None,
        end: str | None = None,
        allow_empty: bool = False,
        inventories: list[Found] | None = None,
        keyed: bool = False,
    ) -> DataFrame:
        """Typed rows with lineage columns, in manifest order; ``keyed`` adds
        the place of the output each row belongs to."""
        if inventories is None:
            inventories = self.inventory(start, end, allow_empty)
        pieces = self._pieces(inventories, keyed)
        return self._finished([self._typed(scan, decorate) for scan, decorate in pieces], [sink.OUT_KEY] * keyed)

    def tried_rows(self, inventories: list[Found], refused: list[DataFrame], detail: bool = False) -> DataFrame:
        """As keyed ``rows``, but nothing in the files raises.

        Rows with something wrong have ``_bad`` set and nulls where it is. Files that
        cannot be read at all go to ``refused`` as a table of ``path``, ``message`` and
        ``target`` for each template. With ``detail``, only the rows with something wrong, as
        ``path``, ``row`` (its number in the file, from 0), ``column`` and ``message``.
        """
        pieces = self._pieces(inventories, True, refused, detail)
        if not detail:
            return self._finished([self._typed(scan, decorate, True) for scan, decorate in pieces], [sink.OUT_KEY, BAD])
        found = [self._problems(scan, decorate) for scan, decorate in pieces]
        return scans.union_scans(found) if found else self.spark.createDataFrame([], "path string, row bigint, column string, message string")

    def _pieces(
        self, inventories: list[Found], keyed: bool, refused: list[DataFrame] | None = None, numbered: bool = False
    ) -> list[tuple[Scan, ordinal.Decorate]]:
        pieces: list[tuple[Scan, ordinal.Decorate]] = []
        for i, (found, template) in enumerate(zip(inventories, self.templates)):
            if found.files.isEmpty():
                continue
            key = sink.place(self.output_path(F.col("_path"), template)) if keyed else None
            decorate = path_columns(template, self.metadata, found.files, self.input.get("encoding") or "utf-8", key)
            out = None if refused is None else []
            pieces += [(scan, decorate) for scan in self._scan(found, i, decorate, out)]
            if refused is not None:
                refused += [t.withColumn("target", self.output_path(F.col("path"), template)) for t in out]
        if not pieces:
            return []
        if numbered or self._numbered():
            pieces = [(scan.number(with_path(decorate, scan)), decorate) for scan, decorate in pieces]
            if self.aggregate and len(pieces) > 1:
                counts = scans.union_scans([scan.counts for scan, _ in pieces])
                pieces = [(replace(s, df=ordinal.number_across(s.df, counts)), d) for s, d in pieces]
        return pieces

    def _finished(self, typed: list[DataFrame], more: list[str]) -> DataFrame:
        """Columns of the output, and ``more`` behind them if there is any piece."""
        target = unify(output_schema(self.schema), lineage_schema(self.metadata))
        if not typed:
            return self.spark.createDataFrame([], target)
        df = scans.union_scans(typed)
        data = [f.name for f in target]
        extras = [c for c in df.columns if c not in data and not c.startswith("_")] if self.transforms else []
        lost = [c for c in more if c not in df.columns]
        if lost:
            raise ValueError(f"A custom stage dropped {lost}; columns that begin with '_' must stay")
        if more or extras:
            return df.select(*[F.col(f"`{c}`") for c in data + extras + more])
        return conform(df, target)

    def _numbered(self) -> bool:
        """Whether rows need their number: for the output or a function."""
        functions = [f.get("func") for f in (self.metadata.get("additional_metadata") or {}).values()]
        return self.metadata.get("standard_metadata", True) or any(ordered.known(f) for f in functions if f)

    def _scan(self, found: Found, i: int, decorate: ordinal.Decorate, refused: list[DataFrame] | None = None) -> list[Scan]:
        files, glob, extra = found.files, found.glob, self.input.get("extra", "raise")
        if self.format is None:
            return scans.scan_parquet(files, [glob] if glob else None, self.schema, i, extra, refused)
        return scans.scan_text(files, self.format, self.schema, i, extra, decorate, glob, refused)

    def _tried(self, scan: Scan, df: DataFrame) -> tuple[list[Column], list[Problem]]:
        convert = self.format.convert if self.format else None
        values, problems = tried_columns(scan.columns, self.schema, convert, scan.sparse, df.schema if self.format is None else None)
        if scans.CORRUPT in df.columns:
            # Where cells are missing or too many, none of them is known to be what it seems.
            broken = F.col(scans.CORRUPT).isNotNull()
            problems = [(name, ~broken & wrong, what) for name, wrong, what in problems]
            problems.append(("", broken, F.concat(F.lit("not as many cells as the header: "), F.col(scans.CORRUPT))))
        return values, problems

    def _problems(self, scan: Scan, decorate: ordinal.Decorate) -> DataFrame:
        df = scan.df if scan.decorated else with_path(decorate, scan)(scan.df)
        _, problems = self._tried(scan, df)
        told = [F.when(wrong, F.struct(F.lit(name).alias("column"), what.alias("message"))) for name, wrong, what in problems]
        each = F.explode(F.filter(F.array(*told), lambda p: p.isNotNull())) if told else F.explode(F.array().cast("array<struct<column:string,message:string>>"))
        return df.select(F.col("_path").alias("path"), F.col("_findex").alias("row"), each.alias("_p")).select("path", "row", "_p.column", "_p.message")

    def _typed(self, scan: Scan, decorate: ordinal.Decorate, lenient: bool = False) -> DataFrame:
        df = scan.df if scan.decorated else with_path(decorate, scan)(scan.df)
        carried = [F.col(c) for c in df.columns if c.startswith("_") and c not in scan.columns]
        if lenient:
            values, problems = self._tried(scan, df)
            carried.append(reduce(or_, [wrong for _, wrong, _ in problems], F.lit(False)).alias(BAD))
        elif self.format is None:
            values = native_columns(scan.columns, self.schema, df.schema)
        else:
            values = typed_columns(scan.columns, self.schema, self.format.convert, scan.sparse)
        df = df.select(*values, *carried)
        if self._numbered():
            df = df.withColumn("_index", F.col("_gindex" if self.aggregate else "_findex")).drop(*NUMBERS)
        filters = self.input.get("filters") or []
        # What is wrong with a row stays known whether or not a filter would drop it.
        df = df.where(F.col(BAD) | condition(filters)) if lenient and filters else apply_filters(df, filters)
        for transform in self.transforms:
            df = df.transform(transform)
        return add_lineage(df, self.metadata, self.creation_time)

    # -- writing ---------------------------------------------------------------

    def output_path(self, path: Column, template: PathTemplate) -> Column:
        """Output path below the base directory, from the path of a raw file."""
        name = F.substring_index(base_name(path), "|", -1)
        stem = F.regexp_replace(F.replace(name, F.lit(".gz"), F.lit("")), r"(?<=.)\.[^.]*$", "")
        known = {
            **template.parts(path),
            **{k: v.cast("string") for k, v in template.variables(path).items()},
            "table": F.lit(self.table),
            "file_name": stem,
        }
        return fill_template(self.output_template, known)

    def write(
        self, start: str | None = None, end: str | None = None, allow_empty: bool = False, on_error: str = "raise"
    ) -> sink.Written:
        """Ingest a key range: one output per raw file or, in aggregate mode,
        one per distinct output path. A file without rows gives an empty output
        (Spark lists no files of no bytes, so those give none), and every output
        a text of checksums in it; two files with one output path raise, unless in aggregate mode.

        Tells ``outputs`` (paths written), ``files``, ``rows``. With ``on_error="skip"`` what is
        wrong in a file costs its own output only: that one stays as it was before, all others are
        written; ``failed`` has the paths left out and ``errors`` a table of ``target``,
        ``path``, ``row``, ``column`` and ``message`` (no row or column if a file cannot be read at all)."""
        if on_error not in ("raise", "skip"):
            raise ValueError(f"on_error is 'raise' or 'skip', not '{on_error}'")
        files = self.inventory(start, end, allow_empty)
        expected = self._outputs(files)
        options = {k: str(v) for k, v in (self.output.get("writer_kwargs") or {}).items()}
        refused: list[DataFrame] | None = [] if on_error == "skip" else None
        df = self.rows(start, end, allow_empty, files, keyed=True) if refused is None else self.tried_rows(files, refused)
        if sink.OUT_KEY not in df.columns:  # no file has as much as a header
            df = df.withColumn(sink.OUT_KEY, F.lit("none"))
        bad = F.col(BAD) if BAD in df.columns else None
        watch = Observation()
        df = df.observe(watch, F.count(F.lit(1)).alias("rows"), F.count_if(F.lit(False) if bad is None else bad).alias("bad"))
        out = materialize(scans.union_scans(refused), "refused") if refused else None
        done = sink.write_outputs(df, self.basedir, expected.select("target"), bad, out, **options)
        done.update(files=sum(f.files.count() for f in files), rows=watch.get["rows"])
        if refused is not None:
            done["errors"] = self._errors(files, done, out, watch.get["bad"])
        return done

    def _errors(self, files: list[Found], done: sink.Written, refused: DataFrame | None, bad: int) -> DataFrame:
        """What is wrong in the files of outputs left out; only these are read again."""
        named = "target string, path string, row bigint, column string, message string"
        unread = self.spark.createDataFrame([], named)
        if refused is not None:
            unread = refused.select("target", "path", F.lit(None).cast("bigint").alias("row"), F.lit(None).cast("string").alias("column"), "message")
        if not bad:
            return unread
        failed = done.table.where("state = 'bad'").select("target")
        again, targets = [], []
        for found, template in zip(files, self.templates):
            keyed = found.files.withColumn("target", self.output_path(F.col("path"), template))
            keyed = keyed.join(failed, "target", "left_semi")
            if refused is not None:
                keyed = keyed.join(refused, "path", "left_anti")
            keyed = materialize(keyed, "failed-files")
            targets.append(keyed.select("path", "target"))
            again.append(Found(keyed.drop("target")))
        rows = self.tried_rows(again, [], detail=True).join(scans.union_scans(targets).distinct(), "path")
        return unread.unionByName(rows.select("target", "path", "row", F.nullif("column", F.lit("")).alias("column"), "message"))

    def _outputs(self, found: list[Found]) -> DataFrame:
        """Output paths of all files, as a written table of ``target``."""
        pieces = [f.files.select("path", self.output_path(F.col("path"), t).alias("target")) for f, t in zip(found, self.templates)]
        targets = materialize(scans.union_scans(pieces), "targets")
        if not self.aggregate:
            paths = targets.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("a"), F.max("path").alias("b"))
            shared = paths.where("n > 1").orderBy("target").first()
            if shared is not None:
                raise ValueError(f"Files '{shared['a']}' and '{shared['b']}' have the same output '{shared['target']}'")
        return materialize(targets.select("target").distinct(), "outputs")


def with_path(decorate: ordinal.Decorate, scan: Scan) -> ordinal.Decorate:
    """``decorate`` for frames of a scan, which know the path as scanned."""
    return lambda df: decorate(scans.with_path(df, encoded=scan.order is None))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Template text with columns for placeholders; an unknown part raises."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            pieces.append(F.lit(piece))
            continue
        if piece not in values:
            raise KeyError(f"Output template needs '{piece}', which the raw path does not give")
        missing = F.raise_error(F.lit(f"Output template needs '{piece}', which a raw path does not give"))
        pieces.append(F.coalesce(values[piece], missing.cast("string")))
    return F.concat(*pieces)


def ingest(spark: SparkSession, config: dict, table: str, start: str | None = None, end: str | None = None, **kwargs: Any) -> DataFrame:
    """Typed rows of a table for a key range (both ends included)."""
    return Job(spark, config, table, **kwargs).rows(start, end)


__all__ = ["Found", "Job", "fill_template", "ingest", "text_format"]
