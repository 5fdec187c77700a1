"""Types, templates, inference, sinks, reverse lineage, streaming."""

import datetime as dt
import json
import math

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake import types as rt
from rawlake.fixtures.staging import csv_line, stage_lines
from rawlake.functions.timeformat import to_spark_pattern
from rawlake.operators import columns, infer, sink, trace
from rawlake.operators.schema import conform
from rawlake.plans.ingest import Job
from rawlake.queries.staged import config
from rawlake.sources import inventory
from rawlake.sources.templates import PathTemplate
from rawlake.streaming import incremental


@pytest.mark.parametrize(
    "text,want",
    [
        ("string", T.StringType()), ("decimal", T.DoubleType()), ("int", T.LongType()), ("date", T.DateType()),
        ("timestamp", T.TimestampNTZType()), ("timestamp[ms, tz=UTC]", T.TimestampType()), ("bool not null", T.BooleanType()),
        ("list<double not null>", T.ArrayType(T.DoubleType(), False)), ("list<list<int>>", T.ArrayType(T.ArrayType(T.LongType()))),
        ("list<timestamp[us, tz=UTC]>", T.ArrayType(T.TimestampType())),
    ],
)
def test_types(text, want):
    assert rt.spark_type(text) == want


@pytest.mark.parametrize("text", ["boolean", "map<string>", "timestamp[ns]", "list<int"])
def test_unknown_types(text):
    with pytest.raises(ValueError):
        rt.spark_type(text)


def test_unify_and_conform(spark):
    a = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType(), False)])
    with pytest.raises(ValueError, match="conflicting types"):
        rt.unify(a, T.StructType([T.StructField("k", T.IntegerType())]))
    df = spark.createDataFrame([(1, "x", 2)], "k bigint, s string, extra int")
    assert conform(df, a).columns == ["k", "s"]
    with pytest.raises(ValueError, match="Output lacks"):
        conform(df.drop("s"), a)


def test_manifest_order_and_operations(spark):
    manifest = {"schema": {"10": {"name": "b", "type": "int"}, "2": {"name": "a", "type": "string", "column_operation": "output_ignored"}}}
    schema = rt.load_manifest(spark, json.dumps(manifest))
    assert schema.names == ["a", "b"] and rt.output_schema(schema).names == ["b"]


@pytest.mark.parametrize("value", [0.0, -0.0, 1.0, 1.5, 1e10, 9999999999.0, 1e-6, 1e-7, 1.234e-5, 12345678901.5, 1e22, 5e-10, math.inf, math.nan])
def test_number_text(spark, value):
    got = spark.createDataFrame([(value,)], "x double").select(columns.number_text(F.col("x"))).first()[0]
    assert got == pc.cast(pa.array([value]), pa.string())[0].as_py()


@pytest.mark.parametrize(
    "value,source,target",
    [(1.5, "double", "int64"), (2.0**63, "double", "int64"), ("1d", "string", "double"), ("y", "string", "bool"), (2**53 + 1, "int64", "double"), ("2024-1-2", "string", "date32")],
)
def test_unsafe_casts_raise(spark, value, source, target):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", rt.spark_type(source))]))
    with pytest.raises(Exception):
        columns.cast_column(df, "v", target).collect()


def test_templates(spark):
    t = PathTemplate("/r/{YYYY}/{MM}/x_{YYYYMMDD}_{hh}{mm}{ss}{us}_{delta}.csv")
    assert t.glob() == "/r/????/??/x_????????_????????????_*.csv"
    path = "/r/2024/01/x_20240203_101112000013_7.csvx"
    df = spark.createDataFrame([(path,), ("/r/none",)], "path string")
    rows = inventory.describe(df, t).collect()
    assert rows[0]["matched"] and not rows[1]["matched"]
    # A directory and a file name may disagree: written parts win over derived.
    assert (rows[0]["YYYY"], rows[0]["MM"], rows[0]["DD"], rows[0]["us"], rows[0]["delta"]) == ("2024", "02", "03", "000013", "7")
    assert rows[1]["YYYY"] is None and rows[1]["d"] is None
    with pytest.raises(ValueError, match="region"):
        PathTemplate("{region}.csv")
    assert PathTemplate("/{region}/({YYMM}).csv", {"region": "eu"}).glob({"YYMM": "2401"}) == "/eu/2401.csv"


def test_ranges(spark):
    days = [r["d"] for r in inventory.calendar(spark, "20240228", "20240301").collect()]
    assert days == ["20240228", "20240229", "20240301"]
    assert [r["d"] for r in inventory.calendar(spark, "202312", "202402", "month").collect()] == ["202312", "202401", "202402"]
    with pytest.raises(ValueError):
        inventory.calendar(spark, "20240102", "20240101")
    keys = spark.createDataFrame([("007",), ("8",), ("20",), (None,)], "d string")
    assert [r["d"] for r in inventory.in_range(keys, "7", "9", "delta").orderBy("d").collect()] == ["007", "8"]
    assert inventory.within(keys, "7", "20").count() == 2
    template = PathTemplate("/r/{YYYY}/x_{YYMMDD}.csv")
    assert inventory.one_glob(inventory.range_globs(template, "20231231", "20240101")) == "/r/{2023/x_231231.csv,2024/x_240101.csv}"


def test_time_formats():
    assert to_spark_pattern("%Y%m%d") == "yyyyMMdd"
    assert to_spark_pattern("%d-%b-%Y at %H") == "d-MMM-yyyy 'at' H"
    with pytest.raises(ValueError):
        to_spark_pattern("%U")


KINDS = ["bool", "int64", "double", "date32", "date64", "string", "timestamp[us]"]


def test_common_type_of_every_pair(spark):
    def want(a, b):
        if a == b:
            return a
        for family in (infer.NUMERIC, infer.DATES):
            if a in family and b in family:
                return max(a, b, key=infer.RANKS.get)
        return "string"

    pairs = [(f"{a}+{b}", k) for a in KINDS for b in KINDS for k in (a, b)]
    df = spark.createDataFrame(pairs, "pair string, type string")
    got = {r["pair"]: r["t"] for r in df.groupBy("pair").agg(infer.common_type().alias("t")).collect()}
    assert got == {f"{a}+{b}": want(a, b) for a in KINDS for b in KINDS}


def test_logical_types(spark):
    names = {"uint8": "int64", "float": "double", "decimal128(5, 2)": "double", "date32[day]": "date32", "time32[s]": "string", "null": "string"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["t"] for r in df.select("n", infer.logical_type(F.col("n")).alias("t")).collect()}
    assert got == names


def test_trace_errors(spark):
    df = spark.createDataFrame([("/l/2024/20240102.20240103.parq",)], "output string")
    with pytest.raises(Exception, match="two values"):
        trace.parse_outputs(df, "{YYYY}/{YYYYMMDD}.{YYYYMMDD}.parq", "/l").select("d").collect()
    with pytest.raises(Exception, match="does not fit"):
        trace.parse_outputs(df, "{YYYY}/{table}.parq", "/l").select("d").collect()
    named = trace.parse_outputs(df, "{YYYY}/{file_name}.parq", "/l")
    assert named.select(F.element_at("vars", F.lit("file_name"))).first()[0] == "20240102.20240103"


def test_publish_replaces(spark, tmp_path):
    target = f"{tmp_path}/out/x.parq"
    for n in (5, 3):
        sink.write_parquet(spark.range(n).toDF("k"), target)
    assert spark.read.parquet(target).count() == 3
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_staging", "x.parq"]
    sums = sink.checksums(spark, [target]).collect()
    assert sums and all(len(r["md5"]) == 32 for r in sums)


def _stage(spark, root, days, start=0):
    df = spark.range(start, start + 10 * len(days)).withColumn("day", F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % len(days) + 1).cast("int")))
    stage_lines(df, root, F.concat(F.lit("f_"), F.col("day"), F.lit(".csv")), csv_line(F.col("id"), F.col("day")), [F.col("id")], F.lit("k,day"))


def _job(spark, tmp_path, **kwargs):
    types = {"k": "int64", "day": "string"}
    settings = config(
        [f"{tmp_path}/raw/f_{{YYYYMMDD}}.csv"], types, metadata={}, basedir=f"{tmp_path}/lake", file_template="{YYYY}/{YYYYMMDD}.{table}.parq", **kwargs
    )
    return Job(spark, settings, "t", creation_time=dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))


def test_write_per_file_and_stats(spark, tmp_path):
    _stage(spark, f"{tmp_path}/raw", ["20240101", "20240102", "20240103"])
    for _ in range(2):
        result = _job(spark, tmp_path).write("20240101", "20240102")
        assert result["files"] == 2 and result["rows"] == 20
        assert result["outputs"] == [f"{tmp_path}/lake/2024/{d}.t.parq" for d in ("20240101", "20240102")]
    back = spark.read.parquet(result["outputs"][0])
    assert back.columns == ["k", "day", "_source_file", "_source_file_mtime", "_creation_time", "_knowledge_time", "_knowledge_date", "_index"]
    assert back.schema["_knowledge_time"].dataType == T.TimestampType()


def test_incremental_takes_only_new_files(spark, tmp_path):
    target, state = f"{tmp_path}/target", f"{tmp_path}/state"
    job = _job(spark, tmp_path, aggregate=True)
    _stage(spark, f"{tmp_path}/raw", ["20240101", "20240102"])
    incremental.start(job, target, state).awaitTermination()
    _stage(spark, f"{tmp_path}/raw", ["20240103"], start=100)
    incremental.start(job, target, state).awaitTermination()
    incremental.start(job, target, state).awaitTermination()
    got = incremental.read_target(job, target)
    assert sorted(r["_index"] for r in got.collect()) == list(range(30))
    assert {r["k"] for r in got.where("_index >= 20").collect()} == set(range(100, 110))


def test_filters(spark):
    df = spark.range(10).toDF("k")
    assert columns.apply_filters(df, [["k", ">", 3], ["k", "not in", [5, 6]]]).count() == 4
    assert columns.apply_filters(df, [[["k", "<", 2]], [["k", "==", 9]]]).count() == 3


def test_bootstrap_manifest(spark, tmp_path):
    from rawlake.plans.bootstrap import infer_table

    _stage(spark, f"{tmp_path}/raw", ["20240101", "20240102", "20240103"])
    settings = config([f"{tmp_path}/raw/f_{{YYYYMMDD}}.csv"], {})
    manifest = infer_table(spark, settings, "t", sample=2, path=f"{tmp_path}/m/t.json")
    assert [(c["name"], c["type"]) for c in manifest["schema"].values()] == [("k", "int64"), ("day", "int64")]
    settings["manifest"] = {"file_template": f"{tmp_path}/m/{{table}}.json"}
    assert Job(spark, settings, "t").rows().count() == 30
    spark.range(3).selectExpr("id k", "cast(id as float) x", "array(id) l").write.parquet(f"{tmp_path}/p_20240101.parquet")
    settings = config([f"{tmp_path}/p_{{YYYYMMDD}}.parquet/*.parquet"], {}, {"format": "parquet"})
    assert [c["type"] for c in infer_table(spark, settings, "t")["schema"].values()] == ["int64", "double", "list<int64>"]


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "f_20240101.csv").write_bytes(b"\xef\xbb\xbfk,day\n1,x\n")
    assert [(r["k"], r["day"]) for r in _job(spark, tmp_path).rows().collect()] == [(1, "x")]
