"""Publishing many outputs at once, and keeping the good ones when some are bad."""

import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rawlake.operators import sink
from rawlake.operators.backfill import backfill, pending
from rawlake.plans.ingest import Job
from rawlake.queries.staged import config

TYPES = {"k": "int64", "v": "double", "s": "string"}


def rows_for(spark, n, value):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(value).alias("v"), sink.place(F.format_string("d%d/out %d.parq", F.col("id") % 7, "id")).alias(sink.OUT_KEY))


def targets_for(spark, n):
    return spark.range(n).select(F.format_string("d%d/out %d.parq", F.col("id") % 7, "id").alias("target"))


class Calls:
    """Counts what the driver asks a file system for."""

    def __init__(self, monkeypatch):
        self.n = 0
        own = sink._fs

        def counted(spark, path):
            self.n += 1
            return own(spark, path)

        monkeypatch.setattr(sink, "_fs", counted)


def left_over(base):
    return sorted(n for n in os.listdir(base) if n.startswith("_"))


def test_driver_calls_do_not_grow_with_outputs(spark, tmp_path, monkeypatch):
    calls = Calls(monkeypatch)
    seen = []
    for n in (20, 20_000):
        calls.n = 0
        base = str(tmp_path / str(n))
        done = sink.write_outputs(rows_for(spark, n, 1.5), base, targets_for(spark, n + 5))
        seen.append(calls.n)
        assert left_over(base) == []
        assert done.table.where("state = 'ready'").count() == n + 5
        # The five outputs without rows are there as well, and empty.
        assert sum(len(os.listdir(f"{base}/d{i}")) for i in range(7)) == n + 5
        assert spark.read.parquet(f"{base}/d*/*.parq").count() == n
        assert spark.read.parquet(f"{base}/d{n % 7}/out {n}.parq").count() == 0
    assert seen[0] == seen[1] < 20


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    sink.write_outputs(rows_for(spark, 30, 1.0), base, targets_for(spark, 30))

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sink, "_complete", dies)
        with pytest.raises(RuntimeError):
            sink.write_outputs(rows_for(spark, 30, 2.0), base, targets_for(spark, 30))
    assert left_over(base) == []
    assert [tuple(r) for r in spark.read.parquet(f"{base}/d*/*.parq").groupBy("v").count().collect()] == [(1.0, 30)]


@pytest.mark.parametrize("moved", [0, 11])
def test_a_run_that_dies_after_its_commit_is_finished_by_the_next(spark, tmp_path, monkeypatch, moved):
    base = str(tmp_path)
    sink.write_outputs(rows_for(spark, 30, 1.0), base, targets_for(spark, 30))

    def dies(spark, base, run):
        done = f"{base}/_commits/{run}"
        places = sorted(os.listdir(f"{done}/rows"))
        table = {r["place"]: r["target"] for r in spark.read.parquet(f"{done}/outputs").collect()}
        for name in [p for p in places if "=" in p][:moved]:
            own = name.split("=")[1]
            os.makedirs(f"{done}/old", exist_ok=True)
            os.rename(f"{base}/{table[own]}", f"{done}/old/{own}")
            if own != sorted(table)[0]:  # one is caught with its old version set aside only
                os.rename(f"{done}/rows/{name}", f"{base}/{table[own]}")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sink, "_put_in_place", dies)
        with pytest.raises(RuntimeError):
            sink.write_outputs(rows_for(spark, 30, 2.0), base, targets_for(spark, 30))
    assert left_over(base) == ["_commits"]
    assert sink.recover(spark, base) == 1 and sink.recover(spark, base) == 0
    assert left_over(base) == []
    assert [tuple(r) for r in spark.read.parquet(f"{base}/d*/*.parq").groupBy("v").count().collect()] == [(2.0, 30)]


def test_bad_and_refused_outputs_stay_as_they_were(spark, tmp_path):
    base = str(tmp_path)
    sink.write_outputs(rows_for(spark, 10, 1.0), base, targets_for(spark, 10))
    refused = spark.createDataFrame([("d3/out 3.parq",)], "target string")
    done = sink.write_outputs(rows_for(spark, 10, 2.0), base, targets_for(spark, 10), F.col("k") == 5, refused)
    assert done["failed"] == [f"{base}/d3/out 3.parq", f"{base}/d5/out 5.parq"] and len(done["outputs"]) == 8
    got = {r["k"]: r["v"] for r in spark.read.parquet(f"{base}/d*/*.parq").collect()}
    assert got == {k: 1.0 if k in (3, 5) else 2.0 for k in range(10)}
    told = sink.read_checksums(spark.createDataFrame([(p,) for p in done["outputs"]], "output string")).collect()
    assert all(r["md5"] == sink.remote.md5(f"{r['output']}/{r['name']}") for r in told) and len(told) >= 8


def days(root, files):
    os.makedirs(root, exist_ok=True)
    for day, content in files.items():
        with open(f"{root}/x_{day}.csv{'.gz' if isinstance(content, bytes) else ''}", "wb") as out:
            out.write(content if isinstance(content, bytes) else content.encode())


GOOD = "k,v,s\n" + "".join(f"{i},{i}.5,t\n" for i in range(50))


def job_for(spark, tmp_path, name="x_{YYYYMMDD}.csv", types=TYPES, not_null=(), **more):
    settings = config([f"{tmp_path}/raw/{name}"], types, basedir=f"{tmp_path}/lake", file_template="{YYYYMMDD}", metadata=more.pop("metadata", {}), not_null=not_null, **more)
    return Job(spark, settings, "t")


def published(tmp_path):
    return sorted(n for n in os.listdir(tmp_path / "lake") if not n.startswith("_"))


@pytest.mark.parametrize("more", [{}, {"input": {"options": {"read_options": {"skip_rows": 1}}}}, {"metadata": {"standard_metadata": False}}])
def test_what_is_wrong_in_a_file_costs_its_own_output_only(spark, tmp_path, more):
    top = "note\n" if "input" in more else ""
    days(
        tmp_path / "raw",
        {
            "20240101": top + GOOD,
            "20240102": top + GOOD.replace("7,7.5", "7,x7") + "99999999999999999999,1.5,t\n",
            "20240103": top + GOOD + "1,2\n1,2,3,4\n",
            "20240104": top + "k,s\n1,a\n",
            "20240105": top + "k,v,s,more\n1,2,a,b\n",
            "20240106": top + "k,v,v,s\n1,2,3,a\n",
            "20240107": top + "k,v,s\n",
            "20240108": top + GOOD + ",1.5,\n",
        },
    )
    job = job_for(spark, tmp_path, not_null=("k",), **more)
    done = job.write("20240101", "20240109", on_error="skip")
    assert published(tmp_path) == ["20240101", "20240107"] and left_over(tmp_path / "lake") == []
    assert len(done["failed"]) == 6 and len(done["outputs"]) == 2
    got = sorted(tuple("" if c is None else c for c in (r["target"], r["row"], r["column"])) for r in done["errors"].collect())
    assert got == [
        ("20240102", 7, "v"), ("20240102", 50, "k"), ("20240103", 50, ""), ("20240103", 51, ""), ("20240104", "", ""),
        ("20240105", "", ""), ("20240106", "", ""), ("20240108", 50, "k"),
    ]
    messages = {(r["target"], r["row"]): r["message"] for r in done["errors"].collect()}
    assert messages["20240102", 7] == "invalid value for double: 'x7'" and "missing: v" in messages["20240104", None]
    # Strictly, the first of them raises and nothing changes.
    with pytest.raises((PySparkException, ValueError)):
        job.write("20240101", "20240109")
    assert published(tmp_path) == ["20240101", "20240107"] and left_over(tmp_path / "lake") == []


def test_filters_do_not_hide_what_is_wrong(spark, tmp_path):
    days(tmp_path / "raw", {"20240101": GOOD, "20240102": GOOD + "0,oops,t\n"})
    job = job_for(spark, tmp_path, input={"filters": [("k", ">", 10)]})
    done = job.write("20240101", "20240102", on_error="skip")
    assert published(tmp_path) == ["20240101"]
    assert spark.read.parquet(done["outputs"][0]).count() == 39


def test_files_that_break_off_are_found_by_halving(spark, tmp_path):
    whole = gzip.compress(("k,v,s\n" + "".join(f"{i},{i * 7919 % 1000}.5,t{i * 31}\n" for i in range(60000))).encode())
    files = {f"202401{d:02d}": gzip.compress(GOOD.encode()) for d in range(1, 11)}
    files["20240104"], files["20240109"] = whole[: len(whole) // 2], b"\x1f\x8bno archive at all"
    files["20240106"] = gzip.compress((GOOD + "x,1,t\n").encode())
    days(tmp_path / "raw", files)
    job = job_for(spark, tmp_path, "x_{YYYYMMDD}.csv.gz")
    done = backfill(job, "20240101", "20240112")
    assert published(tmp_path) == [d for d in sorted(files) if d not in ("20240104", "20240106", "20240109")]
    assert [d for d, _ in done["unreadable"]] == ["20240104"]
    assert sorted(r["target"] for r in done["errors"].collect()) == ["20240106", "20240109"]
    assert left_over(tmp_path / "lake") == []
    there = spark.createDataFrame([(d,) for d in published(tmp_path)], "d string")
    assert sorted(r["d"] for r in pending(spark, "20240101", "20240110", there).collect()) == ["20240104", "20240106", "20240109"]
    with pytest.raises((PySparkException, ValueError)):
        backfill(job, "20240101", "20240112", on_error="raise")


def test_parquet_files_of_another_type_are_left_out(spark, tmp_path):
    os.makedirs(tmp_path / "raw")
    good = pa.table({"k": pa.array([1, 2], pa.int64()), "v": [0.5, None], "s": ["a", "b"]})
    for d, t in (("01", good), ("02", good.set_column(1, "v", pa.array(["x", "y"]))), ("03", good.drop_columns(["k"])), ("05", good)):
        pq.write_table(t, tmp_path / "raw" / f"x_202401{d}.parquet")
    (tmp_path / "raw" / "x_20240104.parquet").write_bytes(b"PAR1 nothing PAR1")
    job = job_for(spark, tmp_path, "x_{YYYYMMDD}.parquet", input={"format": "parquet"}, not_null=("v",))
    done = job.write("20240101", "20240105", on_error="skip")
    assert published(tmp_path) == [] and sorted(r["target"] for r in done["errors"].where("row IS NULL").collect()) == ["20240102", "20240103", "20240104"]
    assert sorted((r["target"], r["row"], r["column"]) for r in done["errors"].where("row IS NOT NULL").collect()) == [("20240101", 1, "v"), ("20240105", 1, "v")]
    job = job_for(spark, tmp_path, "x_{YYYYMMDD}.parquet", input={"format": "parquet"})
    job.write("20240101", "20240105", on_error="skip")
    assert published(tmp_path) == ["20240101", "20240105"]


def test_an_aggregate_is_all_or_nothing(spark, tmp_path):
    days(tmp_path / "raw", {"20240101": GOOD, "20240102": GOOD + "x,1,t\n"})
    settings = config([f"{tmp_path}/raw/x_{{YYYYMMDD}}.csv"], TYPES, basedir=f"{tmp_path}/lake", file_template="all", metadata={}, aggregate=True)
    done = Job(spark, settings, "t").write("20240101", "20240102", on_error="skip")
    assert published(tmp_path) == [] and done["outputs"] == [] and [r["row"] for r in done["errors"].collect()] == [50]
