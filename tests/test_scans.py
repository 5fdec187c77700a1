"""Scans end to end on small files: layouts, checks, row numbers."""

import bz2
import datetime as dt
import gzip
import lzma
import zipfile

import pytest

from rawlake import session
from rawlake.operators import ordinal
from rawlake.plans.ingest import Job
from rawlake.queries.staged import config
from rawlake.sources import scan

TYPES = {"k": "int64", "s": "string", "x": "double"}


def write(path, text, opener=open):
    path.parent.mkdir(parents=True, exist_ok=True)
    if opener is open:
        path.write_text(text)
    else:
        with opener(path, "wt") as f:
            f.write(text)


def job(spark, tmp_path, name="f_{YYYYMMDD}.csv", types=TYPES, metadata=None, **kwargs):
    spec = kwargs.pop("input", {})
    names = name if isinstance(name, list) else [name]
    return Job(spark, config([f"{tmp_path}/{n}" for n in names], types, spec, metadata, **kwargs), "t")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def body(n, start=0):
    return "".join(f"{i},name {i},{i / 4}\n" for i in range(start, start + n))


@pytest.fixture
def tiny_splits(spark):
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("aggregate", [True, False])
def test_row_numbers_survive_splits(spark, tmp_path, tiny_splits, monkeypatch, broadcast, aggregate):
    if not broadcast:
        monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 0)
    sizes = {"20240101": 200, "20240102": 3, "20240103": 150}
    for d, n in sizes.items():
        write(tmp_path / f"f_{d}.csv", "k,s,x\n" + body(n))
    df = job(spark, tmp_path, metadata={}, aggregate=aggregate).rows()
    base, want = 0, []
    for d, n in sizes.items():
        want += [(f"f_{d}.csv", i, (base if aggregate else 0) + i) for i in range(n)]
        base += n
    assert rows(df, "_source_file", "k", "_index") == sorted(want)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("blanks", [True, False])
def test_line_lane_numbers(spark, tmp_path, tiny_splits, monkeypatch, broadcast, blanks):
    if not broadcast:
        monkeypatch.setattr(session, "MAX_BROADCAST_BYTES", 0)
    gap = "\n" if blanks else ""
    for d, n in {"20240101": 120, "20240102": 2}.items():
        text = "# one\n# two\nk|s|x\n" + body(n).replace(",", "|").replace("|name 1|", f"|name 1|") + gap + "7|last|1.5\nEND\n"
        write(tmp_path / f"f_{d}.csv", text)
    df = job(spark, tmp_path, metadata={}, input={"format": "pipe"}).rows()
    got = rows(df, "_source_file", "_index", "k")
    want = [("f_20240101.csv", i, i) for i in range(120)] + [("f_20240101.csv", 120, 7)]
    want += [("f_20240102.csv", i, i) for i in range(2)] + [("f_20240102.csv", 2, 7)]
    assert got == sorted(want)


def test_sections(spark, tmp_path, tiny_splits):
    head = "START-OF-FILE\nSTART-OF-FIELDS\n# c\nA\n\nA\nA\nEND-OF-FIELDS\nSTART-OF-DATA\n"
    data = "".join(f"s{i}|0|3|{i}|N.A.|{i / 2}|\n" for i in range(90))
    write(tmp_path / "f_20240101.csv", head + data + "END-OF-DATA\nnoise\nSTART-OF-DATA\nlast|0|3|1|2|3|\nEND-OF-DATA\n")
    types = {"sec_desc": "string", "rcode": "int64", "nfields": "int64", "A": "double", "A_1": "string", "A_2": "double"}
    df = job(spark, tmp_path, types=types, metadata={}, input={"format": "sectioned"}).rows()
    got = rows(df, "_index", "sec_desc", "A", "A_1", "A_2")
    assert got[:2] == [(0, "s0", 0.0, None, 0.0), (1, "s1", 1.0, None, 0.5)]
    assert len(got) == 91 and got[-1] == (90, "last", 1.0, "2", 3.0)
    write(tmp_path / "f_20240101.csv", head + data)
    with pytest.raises(Exception, match="END-OF-DATA is missing"):
        job(spark, tmp_path, types=types, metadata={}, input={"format": "sectioned"}).rows().collect()


@pytest.mark.parametrize("limit", [64, 1])
def test_columns_by_name(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(scan, "MAX_HEADERS", limit)
    write(tmp_path / "f_20240101.csv", 'k,s,x\n1,"a, b",0.5\n')
    write(tmp_path / "f_20240102.csv", 'x,k,s\n1.5,2,"say ""hi"""\n')
    write(tmp_path / "f_20240103.csv", "s,k\nonly,3\n")
    df = job(spark, tmp_path, operations={"x": "source_optional"}).rows()
    assert rows(df, "k", "s", "x")[:2] == [(1, "a, b", 0.5), (2, 'say "hi"', 1.5)]
    assert rows(df, "k", "s") == [(1, "a, b"), (2, 'say "hi"'), (3, "only")]


def test_codecs_and_archives(spark, tmp_path):
    text = "k,s,x\n" + body(30)
    write(tmp_path / "a_20240101.csv.gz", text, gzip.open)
    write(tmp_path / "a_20240102.csv.bz2", text, bz2.open)
    write(tmp_path / "a_20240103.csv.xz", text, lzma.open)
    write(tmp_path / "a_20240104.csv", text, gzip.open)
    write(tmp_path / "a_20240105.csv", text)
    with zipfile.ZipFile(tmp_path / "b_20240106.zip", "w") as z:
        z.writestr("in_1.csv", text)
        z.writestr("in_x.csv", "no")
        z.writestr("in_2.csv", text)
    names = ["a_{YYYYMMDD}.csv*", "b_{YYYYMMDD}.zip|in_([0-9]).csv"]
    df = job(spark, tmp_path, name=names, metadata={}).rows()
    assert df.count() == 7 * 30
    numbers = df.groupBy("_source_file").agg({"_index": "max", "k": "count"}).collect()
    assert {r["_source_file"]: r["max(_index)"] for r in numbers}["b_20240106.zip|in_2.csv"] == 29
    assert all(r["max(_index)"] == 29 and r["count(k)"] == 30 for r in numbers)


def test_odd_paths_and_extract_vars(spark, tmp_path):
    write(tmp_path / "a b+c%20d" / "f_20240101_EU.csv", "k,s,x\n1,a,1\n")
    metadata = {
        "standard_metadata": False,
        "additional_metadata": {
            "region": {"source": "extract_vars.region", "dtype": "string"},
            "path": {"source": "metadata.file_path", "dtype": "string"},
        },
    }
    df = job(
        spark, tmp_path, name="a b?c%20d/f_{YYYYMMDD}_([A-Z]*).csv", metadata=metadata, extract_vars={"region": {"regex_group": 1}}
    ).rows()
    assert rows(df, "region", "path") == [("EU", f"{tmp_path}/a b+c%20d/f_20240101_EU.csv")]


def test_quoted_line_breaks_with_preamble(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", 'made by\nk,s,x\n1,"two\nlines",1\n2,"a ""b""",2\n')
    options = {"read_options": {"skip_rows": 1}, "parse_options": {"newlines_in_values": True}}
    df = job(spark, tmp_path, input={"options": options}, metadata={}).rows()
    assert rows(df, "k", "s", "_index") == [(1, "two\nlines", 0), (2, 'a "b"', 1)]


def test_header_only_and_nothing(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", "k,s,x\n")
    assert job(spark, tmp_path, metadata={}).rows().count() == 0
    with pytest.raises(FileNotFoundError):
        job(spark, tmp_path, metadata={}).rows("20230101", "20230102")
    assert job(spark, tmp_path, metadata={}).rows("20230101", allow_empty=True).count() == 0


BAD = [
    ("k,s,x\n+1,a,1\n", {}, "invalid value for bigint"),
    ("k,s,x\n1.0,a,1\n", {}, "invalid value for bigint"),
    ("k,s,x\n1,a,1d\n", {}, "invalid value for double"),
    ("k,s,x\n1,a\n", {}, "MALFORMED|malformed|Malformed"),
    ("k,s,x\n1,a,1,9\n", {}, "MALFORMED|malformed|Malformed"),
    ("k,s\n1,a\n", {}, r"Required columns missing.*\['x'\]"),
    ("k,s,x,y\n1,a,1,2\n", {}, r"not in the manifest: \['y'\]"),
    ("k,s,x\n,a,1\n", {"not_null": ("k",)}, "declared not null"),
    ("k,s,x\n1,a,2\n", {"types": {"k": "int64", "s": "bool", "x": "double"}}, "invalid value for boolean"),
    ("k,s,x\n1,2024-1-2,2\n", {"types": {"k": "int64", "s": "date32", "x": "double"}}, "invalid value for date"),
    ("k,s,x\n1,20240102x,2\n", {"types": {"k": "int64", "s": "timestamp", "x": "double"}}, "invalid value for timestamp_ntz"),
    ("k,s,x\n1,20240102,2\n", {"types": {"k": "int64", "s": "timestamp[us, tz=UTC]", "x": "double"}}, "invalid value for timestamp"),
]


@pytest.mark.parametrize("text,kwargs,message", BAD)
def test_bad_input_raises(spark, tmp_path, text, kwargs, message):
    write(tmp_path / "f_20240101.csv", text)
    with pytest.raises(Exception, match=f"(?s){message}"):
        df = job(spark, tmp_path, **kwargs).rows()
        (df.select("k") if "MALFORMED" in message else df).collect()


def test_allowed_variants(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", "k,s,x,y\n 0x1F ,NA, .5,zz\n01,,1e5,\n-0,a,inf,\n")
    df = job(spark, tmp_path, input={"extra": "drop"}).rows()
    assert rows(df) == [(0, "a", float("inf")), (1, "", 1e5), (31, "NA", 0.5)]
    types = {"k": "int64", "s": "timestamp[us, tz=UTC]", "x": "double"}
    write(tmp_path / "g_20240101.csv", "k,s,x\n1,20240102,2\n")
    options = {"convert_options": {"timezone": "America/New_York"}}
    df = job(spark, tmp_path, name="g_{YYYYMMDD}.csv", types=types, input={"options": options}).rows()
    assert rows(df.selectExpr("cast(s as timestamp_ntz) s"), "s") == [(dt.datetime(2024, 1, 2, 5),)]


def test_optional_is_filled_in_place(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", "k,x\n1,2.5\n")
    df = job(spark, tmp_path, operations={"s": "source_optional"}).rows()
    assert df.columns == ["k", "s", "x"] and rows(df) == [(1, None, 2.5)]


def test_templates_in_order_across_files(spark, tmp_path):
    for name in ("b_20240101.csv", "a_20240101.csv", "a_20240102.csv"):
        write(tmp_path / name, "k,s,x\n" + body(3))
    df = job(spark, tmp_path, name=["b_{YYYYMMDD}.csv", "a_{YYYYMMDD}.csv"], metadata={}, aggregate=True).rows()
    assert rows(df, "_index", "_source_file")[::3] == [(0, "b_20240101.csv"), (3, "a_20240101.csv"), (6, "a_20240102.csv")]


def test_header_time(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", '"MADE:","02-Jan-2024 17:00:00"\nk,s,x\n1,a,1\n')
    knowledge = {"from": "csv_header", "tz": "America/New_York", "header_pattern": '"MADE:","([^"]+)"'}
    spec = {"options": {"read_options": {"skip_rows": 1}}}
    df = job(spark, tmp_path, metadata={"knowledge_time": knowledge}, input=spec).rows()
    assert df.selectExpr("cast(_knowledge_time as timestamp_ntz)").first()[0] == dt.datetime(2024, 1, 2, 22)
    for bad in ({"header_pattern": "NONE:(.*)"}, {"header_line": 9}):
        with pytest.raises(Exception):
            job(spark, tmp_path, metadata={"knowledge_time": {**knowledge, **bad}}, input=spec).rows().collect()
    with pytest.raises(ValueError, match="knowledge_time source"):
        job(spark, tmp_path, metadata={"knowledge_time": {"from": "moon"}}, input=spec).rows()


def test_plan_has_no_row_shuffle(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", "k,s,x\n" + body(5))
    plan = job(spark, tmp_path, metadata={}).rows()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_parquet_checks(spark, tmp_path):
    spark.createDataFrame([(1, "a", [1.0, None])], "k bigint, s string, l array<double>").write.parquet(f"{tmp_path}/p_20240101.parquet")
    types = {"k": "int64", "s": "string", "l": "list<double>"}
    df = job(spark, tmp_path, name="p_{YYYYMMDD}.parquet/*.parquet", types=types, input={"format": "parquet"}, metadata={}).rows()
    assert rows(df.select("k", "s", "_index")) == [(1, "a", 0)]
    with pytest.raises(ValueError, match="is string, not bigint"):
        job(spark, tmp_path, name="p_{YYYYMMDD}.parquet/*.parquet", types={"s": "int64"}, input={"format": "parquet"}).rows()


def test_changed_file_is_noticed(spark, tmp_path):
    write(tmp_path / "f_20240101.csv", "k,s,x\n" + body(5))
    df = job(spark, tmp_path, metadata={}).rows()
    write(tmp_path / "f_20240101.csv", "k,s,x\n" + body(2) + "9,a,1\n" * 40)
    with pytest.raises(Exception):
        df.collect()
    assert ordinal.SPLIT == ["_tord", "_fp", "_bs"]
