"""Writing results: staging, publishing, checksums, run statistics."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.session import materialize
from rawlake.sources import remote
from rawlake.sources.inventory import base_name, plain_path

OUT_KEY = "_out_key"
BAD = "bad-"  # before the place of rows that must not be published
COMMITS = "_commits"

CHECKSUMS = "_MD5SUMS"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Move a finished dataset to its place, replacing what is there.

    The old version is set aside first and dropped last, so a failure in
    between never leaves a half-written one under the target name.
    """
    fs, source = _fs(spark, staged)
    goal = _fs(spark, target)[1]
    fs.mkdirs(goal.getParent())
    aside = None
    if fs.exists(goal):
        aside = _fs(spark, f"{goal.getParent()}/_old-{uuid.uuid4().hex}")[1]
        fs.rename(goal, aside)
    if not fs.rename(source, goal):
        if aside is not None:
            fs.rename(aside, goal)
        raise OSError(f"Cannot publish {staged} as {target}")
    if aside is not None:
        fs.delete(aside, True)


def write_parquet(df: DataFrame, target: str, **options: str) -> None:
    """Parquet dataset at ``target``, visible only once complete."""
    spark = df.sparkSession
    parent, _, name = target.rstrip("/").rpartition("/")
    staged = f"{parent}/_staging/{uuid.uuid4().hex}/{name}"
    df.write.options(**options).parquet(staged)
    publish(spark, staged, target)
    _fs(spark, staged)[0].delete(_fs(spark, staged.rpartition("/")[0])[1], True)


def place(path: Column) -> Column:
    """Name under which rows of the output ``path`` are staged; any path makes a plain one."""
    return F.md5(path)


class Written(dict):
    """Facts of a run. ``table`` tells ``target``, ``place`` and ``state`` (``ready`` or
    ``bad``) of every output; lists of paths are only made when asked for."""

    def __init__(self, table: DataFrame, basedir: str, **facts: object) -> None:
        super().__init__(**facts)
        self.table, self.basedir = table, basedir.rstrip("/")

    def __missing__(self, key: str) -> list[str]:
        states = {"outputs": "ready", "failed": "bad"}
        if key not in states:
            raise KeyError(key)
        rows = self.table.where(F.col("state") == states[key]).orderBy("target").collect()
        self[key] = [f"{self.basedir}/{r['target']}" for r in rows]
        return self[key]


def write_outputs(
    df: DataFrame, basedir: str, targets: DataFrame, bad: Column | None = None, refused: DataFrame | None = None, **options: str
) -> Written:
    """One dataset for each path below ``basedir`` that ``targets`` (``target``) lists.

    ``df`` names the ``place`` of each row in ``_out_key``. Outputs without rows are
    empty datasets. An output with a row that is ``bad``, or one that ``refused``
    (``target``) lists, is left as it was and reported as ``bad``.

    One job stages all rows; tasks complete the outputs and write their checksums
    there. Renaming the whole stage commits the run. Only then do tasks put the
    outputs in their places; a run that ends before this is done is finished by the
    next one (``recover``), a run that ends before the commit has changed nothing. The
    driver's calls are as many for any number of outputs.
    """
    spark, base = df.sparkSession, basedir.rstrip("/")
    recover(spark, base)
    run = uuid.uuid4().hex
    staged = f"{base}/_staging/{run}"
    # Writing by output needs tasks sorted by it anyway; rows keep their order.
    order = [OUT_KEY, *(["_index"] if "_index" in df.columns else [])]
    try:
        if bad is not None:
            key = F.when(bad, F.concat(F.lit(BAD), OUT_KEY)).otherwise(F.col(OUT_KEY))
            df = df.withColumn(OUT_KEY, key)
        # Nobody sees the stage, so tasks may rename their own files into it.
        options = {"mapreduce.fileoutputcommitter.algorithm.version": "2", **options}
        df.sortWithinPartitions(*order).write.options(**options).partitionBy(OUT_KEY).parquet(f"{staged}/rows")
        plain = spark.createDataFrame([], df.drop(OUT_KEY).schema)
        plain.coalesce(1).write.options(**options).parquet(f"{staged}/empty")
        states = materialize(_complete(targets, staged, refused), "output-states")
        states.write.parquet(f"{staged}/outputs")
        fs, source = _fs(spark, staged)
        goal = _fs(spark, f"{base}/{COMMITS}/{run}")[1]
        fs.mkdirs(goal.getParent())
        if not fs.rename(source, goal):
            raise OSError(f"Cannot commit {staged}")
    finally:
        _drop(spark, staged)
    _put_in_place(spark, base, run)
    return Written(states, base)


def recover(spark: SparkSession, basedir: str) -> int:
    """Finish committed runs whose outputs are not all in their places; how many there were."""
    base = basedir.rstrip("/")
    fs, folder = _fs(spark, f"{base}/{COMMITS}")
    runs = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    for run in runs:
        _put_in_place(spark, base, run)
    return len(runs)


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of a run, and the one above if that is empty then."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)
    above = jpath.getParent()
    if fs.exists(above) and not fs.listStatus(above):
        fs.delete(above, False)


def _complete(targets: DataFrame, staged: str, refused: DataFrame | None) -> DataFrame:
    """``target``, ``place`` and ``state`` of every output; ready ones have all their files then."""
    spark = targets.sparkSession
    outputs = targets.select("target", place(F.col("target")).alias("place"))
    if refused is None:
        outputs = outputs.withColumn("refused", F.lit(False))
    else:
        outputs = outputs.join(refused.select("target", F.lit(True).alias("refused")).distinct(), "target", "left")
    (part,) = [f for f in remote.files(f"{staged}/empty") if f.endswith(".parquet")]
    with remote.open_input(part) as raw:
        empty = raw.read()

    def complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            states = [one(f"{staged}/rows/{OUT_KEY}=", own) if not gone else "bad" for own, gone in zip(batch["place"], batch["refused"] == True)]  # noqa: E712
            yield batch[["target", "place"]].assign(state=states)

    def one(rows: str, own: str) -> str:
        if remote.files(f"{rows}{BAD}{own}"):
            return "bad"
        folder = f"{rows}{own}"
        parts = [f for f in remote.files(folder) if f.endswith(".parquet")]
        if not parts:
            parts = [f"{folder}/part-00000-empty.parquet"]
            with remote.open_output(parts[0]) as out:
                out.write(empty)
        lines = [f"{remote.md5(p)}  {p.rsplit('/', 1)[1]}\n" for p in sorted(parts)]
        with remote.open_output(f"{folder}/{CHECKSUMS}") as out:
            out.write("".join(lines).encode())
        return "ready"

    spread = outputs.repartition(_width(spark), "place")
    return spread.mapInPandas(complete, "target string, place string, state string")


def _width(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _put_in_place(spark: SparkSession, base: str, run: str) -> None:
    """Move the outputs of a committed run to their places; doing so again does no harm."""
    done = f"{base}/{COMMITS}/{run}"

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for target, own in zip(batch["target"], batch["place"]):
                source, old, goal = f"{done}/rows/{OUT_KEY}={own}", f"{done}/old/{own}", f"{base}/{target}"
                if remote.exists(source):
                    if remote.exists(goal):
                        # What was set aside before is the old version; what stands here now is a part of the new one.
                        remote.delete(goal) if remote.exists(old) else remote.move(goal, old)
                    remote.move(source, goal)
                remote.delete(old)
            yield batch[["target"]]

    ready = spark.read.schema("target string, place string, state string").parquet(f"{done}/outputs").where("state = 'ready'")
    ready.repartition(_width(spark), "place").mapInPandas(move, "target string").count()
    _drop(spark, done)


def checksums(spark: SparkSession, paths: list[str], pattern: str = r"\.parquet$") -> DataFrame:
    """Size and MD5 of every file below the paths (or globs) whose name matches.

    Tasks stream the files piece by piece; Spark only lists them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    named = files.select(plain_path(F.col("path")).alias("path"), F.col("length").alias("size"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(md5=[remote.md5(path) for path in batch["path"]])

    return named.where(base_name(F.col("path")).rlike(pattern)).mapInPandas(digest, "path string, size bigint, md5 string")


def write_checksums(spark: SparkSession, outputs: list[str]) -> None:
    """In each output a text ``CHECKSUMS``: digest and name of each part file,
    as ``md5sum -c`` reads it there. Spark takes such names for no data."""
    if not outputs:
        return
    found = checksums(spark, outputs)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    line = F.concat("md5", F.lit("  "), base_name(F.col("path")))
    texts = found.groupBy(folder.alias("output")).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("text"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with remote.open_output(f"{row.output}/{CHECKSUMS}") as out:
                    out.write(f"{row.text}\n".encode())
            yield batch[["output"]]

    texts.mapInPandas(write, "output string").count()


def read_checksums(outputs: DataFrame) -> DataFrame:
    """``output, name, md5`` as told by each ``output``, with nulls if it tells nothing."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for output in batch["output"]:
                try:
                    with remote.open_input(f"{output}/{CHECKSUMS}") as raw:
                        rows = [line.split("  ", 1) for line in raw.read().decode().splitlines()]
                except FileNotFoundError:
                    rows = [[None, None]]
                yield pd.DataFrame({"output": output, "name": [r[1] for r in rows], "md5": [r[0] for r in rows]})

    return outputs.select("output").mapInPandas(read, "output string, name string, md5 string")


def run_stats(df: DataFrame, file_column: str = "_source_file") -> DataFrame:
    """Rows per source file."""
    return df.groupBy(file_column).agg(F.count(F.lit(1)).alias("rows"))
