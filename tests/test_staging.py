"""Raw files of many rows are written by many tasks."""

import bz2
import gzip
import lzma
import zipfile

import pytest
from pyspark.sql import functions as F

from rawlake.fixtures import staging


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(staging, "PART_BYTES", 2000)


def _stage(spark, root, name, **options):
    rows = spark.range(1000).coalesce(1).withColumn("task", F.lit(0))
    line = F.concat_ws(",", "id", F.spark_partition_id())
    n = staging.stage_lines(rows, str(root), F.lit(name), line, [F.col("id")], F.lit("made by hand\nid,task"), F.lit("end"), **options)
    assert n == 1


def _check(text):
    lines = text.split("\n")
    assert lines[:2] == ["made by hand", "id,task"] and lines[-2:] == ["end", ""]
    cells = [x.split(",") for x in lines[2:-2]]
    assert [int(c[0]) for c in cells] == list(range(1000))
    tasks = [int(c[1]) for c in cells]
    assert tasks == sorted(tasks)
    assert max(tasks.count(t) for t in set(tasks)) < 200, "one task wrote most of the file"


@pytest.mark.parametrize("name, opener", [("a/f.csv", open), ("f.csv.gz", gzip.open), ("f.csv.bz2", bz2.open), ("f.csv.xz", lzma.open)])
def test_one_file_by_many_tasks(spark, tmp_path, small_parts, name, opener):
    for _ in range(2):
        _stage(spark, tmp_path / "raw", name)
        with opener(tmp_path / "raw" / name, "rt") as file:
            _check(file.read())
    assert [p.name for p in tmp_path.iterdir()] == ["raw"]


def test_parts_get_fuller_before_tasks_gather_what_they_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "PART_BYTES", 200)
    _stage(spark, tmp_path, "f.csv")  # of 64,000 bytes
    text = (tmp_path / "f.csv").read_text()
    _check(text)
    assert len({x.split(",")[1] for x in text.split("\n")[2:-2]}) <= 200


@pytest.mark.parametrize("parts, ranges", [(1, 8), (199, 199), (201, 200), (800, 200), (801, 201), (8000, 2000)])
def test_number_of_ranges(parts, ranges):
    assert staging._ranges(parts * staging.PART_BYTES, 8, 200) == ranges


def test_wide_encoding_and_hidden_codec(spark, tmp_path, small_parts):
    _stage(spark, tmp_path, "f.csv", encoding="utf-16-le")
    _check((tmp_path / "f.csv").read_bytes().decode("utf-16-le"))
    _stage(spark, tmp_path, "g.csv", codec="gzip")
    _check(gzip.decompress((tmp_path / "g.csv").read_bytes()).decode())


def test_archive_member_of_many_parts(spark, tmp_path, small_parts):
    rows = spark.range(300).withColumn("name", F.concat(F.lit("z"), F.col("id") % 2, F.lit(".zip|m"), F.col("id") % 3))
    assert staging.stage_lines(rows, str(tmp_path), F.col("name"), F.col("id").cast("string"), [F.col("id")], F.lit("id")) == 6
    for z in range(2):
        with zipfile.ZipFile(tmp_path / f"z{z}.zip") as archive:
            assert sorted(archive.namelist()) == ["m0", "m1", "m2"]
            for m in range(3):
                want = [i for i in range(300) if i % 2 == z and i % 3 == m]
                assert archive.read(f"m{m}").decode() == "".join(f"{x}\n" for x in ["id", *want])


def test_stores_without_places_take_streams(spark, tmp_path, small_parts, monkeypatch):
    monkeypatch.setattr(staging.remote, "writes_in_place", lambda path: False)
    _stage(spark, tmp_path, "f.csv")
    _check((tmp_path / "f.csv").read_text())


def test_blank_lines_and_shorter_files(spark, tmp_path, small_parts):
    old = tmp_path / "f.csv"
    old.write_text("x" * 100_000)
    rows = spark.range(500)
    staging.stage_lines(rows, str(tmp_path), F.lit("f.csv"), F.when(F.col("id") % 2 == 0, "").otherwise(F.col("id").cast("string")), [F.col("id")])
    assert old.read_text() == "".join(f"{'' if i % 2 == 0 else i}\n" for i in range(500))
    assert staging.stage_lines(rows.where("id < 0"), str(tmp_path), F.lit("none.csv"), F.lit("x"), [F.col("id")]) == 0


def test_cells_of_all_columns_are_looked_at_by_one_piece_of_code(spark):
    from rawlake.operators import infer
    from rawlake.sources.scan import Scan

    cells = {"n": ["1", "-2"], "r": ["123e-5", "1234"], "d": ["2024-01-31", ""], "t": ["2024-01-31 10", "2024-01-31T10:20:30"],
             "z": ["2024-01-31 10:20:30Z", None], "f": ["2024-01-31 10:20:30.5", "2024-01-31"], "b": ["true", "False"],
             "s": ["1-URGENT", "2"], "x": [None, ""], "big": ["9223372036854775808", "1"], "bad": ["2024-02-31", "2024-01-01"]}
    want = {"n": "int64", "r": "double", "d": "date32", "t": "timestamp[s]", "z": "timestamp[s, tz=UTC]", "f": "timestamp[us]", "b": "bool",
            "s": "string", "x": "null", "big": "double", "bad": "string"}
    df = spark.createDataFrame([("p", *row) for row in zip(*cells.values())], ", ".join(f"{n} string" for n in ("_fp", *cells)))
    options = {"timestamp_parsers": ["ISO8601"]}
    types = infer.file_types(Scan(df, list(cells)), options)
    assert {r["name"]: r["type"] for r in types.collect()} == want
    assert [r["name"] for r in types.orderBy("col_ord").collect()] == list(cells)

    def tests(columns):
        return infer.file_types(Scan(df, columns), options)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")

    assert tests(["n"]) == tests(list(cells))
