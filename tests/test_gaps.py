"""Files of one table that differ: headers behind preambles, zip archives, padded numbers, shared folders."""

import zipfile

import pytest
from pyspark.sql import types as T

from rawlake import session
from rawlake.plans.bootstrap import infer_table
from rawlake.plans.ingest import Job
from rawlake.queries.staged import config
from rawlake.sources import inventory, scan
from rawlake.sources.templates import PathTemplate
from rawlake.streaming import incremental
from rawlake.types import parse_type

TYPES = {"k": "int64", "note": "string", "value": "double"}


def manifest():
    ops = {"k": "source_required", "note": "source_optional", "value": "source_optional"}
    return {"schema": {str(i): {"name": n, "type": t, "nullable": True, "column_operation": ops[n]} for i, (n, t) in enumerate(TYPES.items(), 1)}}


def job(spark, raw, **more):
    settings = config([raw], TYPES, more, {"standard_metadata": False})
    settings["manifest"] = manifest()
    return settings


@pytest.mark.parametrize("headers", [64, 1])
def test_missing_optional_cells_are_null_behind_a_preamble(spark, tmp_path, monkeypatch, headers):
    monkeypatch.setattr(scan, "MAX_HEADERS", headers)
    (tmp_path / "t_20240101.csv").write_text("made by x\nk,note,value\n1,,1.5\n")
    (tmp_path / "t_20240102.csv").write_text("made by x\nk\n2\n")
    settings = job(spark, f"{tmp_path}/t_{{YYYYMMDD}}.csv", **{"options": {"read_options": {"skip_rows": 1}}})
    rows = Job(spark, settings, "t").rows()
    assert sorted(map(tuple, rows.select(*TYPES).collect())) == [(1, "", 1.5), (2, None, None)]


def test_manifest_of_two_headers_behind_a_preamble(spark, tmp_path):
    (tmp_path / "t_20240101.csv").write_text("made by x\nk,note\n1,a\n")
    (tmp_path / "t_20240102.csv").write_text("made by x\nk,other\n2,b\n")
    settings = config([f"{tmp_path}/t_{{YYYYMMDD}}.csv"], TYPES, {"options": {"read_options": {"skip_rows": 1}}}, {"standard_metadata": False})
    found = infer_table(spark, settings, "t")["schema"]
    assert {e["name"] for e in found.values()} == {"k", "note", "other"}


def test_zip_members_are_ingested_incrementally(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("n_20240101.csv", "k,note,value\n1,a,1\n")
        z.writestr("n_20240102.csv", "k,note,value\n2,b,2\n")
    settings = job(spark, f"{tmp_path}/*.zip|n_{{YYYYMMDD}}.csv")
    own = Job(spark, settings, "t")
    incremental.start(own, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sorted(r.k for r in incremental.read_target(own, f"{tmp_path}/out").collect()) == [1, 2]


def test_padded_numbers_are_found(spark, tmp_path):
    for name in ("007", "8", "0011"):
        (tmp_path / f"{name}.csv").write_text("k\n1\n")
    template = PathTemplate(f"{tmp_path}/{{delta}}.csv", None, None, "delta")
    found = inventory.discover(spark, template, "7", "10").where("matched")
    assert sorted(r.d for r in found.collect()) == ["007", "8"]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Session())


def test_decimals_are_not_read_as_doubles():
    assert not scan._widens(T.DecimalType(38, 10), T.DoubleType()) and scan._widens(T.FloatType(), T.DoubleType())


def rows_of(spark, settings):
    return sorted(map(tuple, Job(spark, settings, "t").rows().select(*TYPES).collect()), key=str)


def test_two_templates_share_an_incremental_target(spark, tmp_path):
    (tmp_path / "a_20240101.csv").write_text("k,note,value\n1,a,1\n")
    (tmp_path / "b_20240101.csv").write_text("k,note,value\n2,b,2\n3,b,2\n")
    settings = job(spark, f"{tmp_path}/a_{{YYYYMMDD}}.csv")
    settings["tables"]["t"] = {"raw_files": [f"{tmp_path}/{n}_{{YYYYMMDD}}.csv" for n in "ab"], "aggregate": True}
    settings["output"]["metadata"] = {}
    own = Job(spark, settings, "t")
    for i in range(2):
        incremental.start(own, f"{tmp_path}/out", f"{tmp_path}/ck{i}", i).awaitTermination()
    got = incremental.read_target(own, f"{tmp_path}/out")
    assert sorted((r.k, r["_index"]) for r in got.collect()) == [(1, 0), (2, 1), (3, 2)]
    assert incremental.rows_before(own, f"{tmp_path}/out", 0, 1) == 1
    assert incremental.rows_before(own, f"{tmp_path}/out", 1, 1) == 3


def written(spark, tmp_path, template="{table}_{YYYYMMDD}.parq", aggregate=False):
    settings = job(spark, f"{tmp_path}/t_{{YYYYMMDD}}*.csv")
    settings["output"] |= {"basedir": f"{tmp_path}/out", "file_template": template}
    settings["tables"]["t"]["aggregate"] = aggregate
    return Job(spark, settings, "t").write()


def test_files_without_rows_give_empty_outputs(spark, tmp_path):
    (tmp_path / "t_20240101.csv").write_text("k,note,value\n1,a,1\n")
    (tmp_path / "t_20240102.csv").write_text("k,note,value\n")
    (tmp_path / "t_20240103.csv").write_text("\n")
    done = written(spark, tmp_path)
    assert [o.rsplit("/", 1)[1] for o in done["outputs"]] == [f"t_2024010{i}.parq" for i in (1, 2, 3)] and done["rows"] == 1
    back = [spark.read.parquet(o) for o in done["outputs"]]
    assert [b.count() for b in back] == [1, 0, 0] and all(b.columns == list(TYPES) for b in back)


def test_only_empty_files_give_empty_outputs(spark, tmp_path):
    (tmp_path / "t_20240103.csv").write_text("\n")
    done = written(spark, tmp_path)
    assert done["rows"] == 0 and spark.read.parquet(done["outputs"][0]).columns == list(TYPES)


def test_files_with_one_output_raise_unless_aggregated(spark, tmp_path):
    (tmp_path / "t_20240101a.csv").write_text("k,note,value\n1,a,1\n")
    (tmp_path / "t_20240101b.csv").write_text("k,note,value\n2,a,1\n")
    with pytest.raises(ValueError, match="20240101a.csv.*20240101b.csv.*same output"):
        written(spark, tmp_path)
    assert written(spark, tmp_path, aggregate=True)["rows"] == 2


def parquet(spark, tmp_path, frames, **more):
    for i, frame in enumerate(frames, 1):
        frame.toPandas().to_parquet(f"{tmp_path}/p_2024010{i}.parquet", index=False)
    return job(spark, f"{tmp_path}/p_{{YYYYMMDD}}.parquet", format="parquet", **more)


def test_parquet_files_may_differ(spark, tmp_path):
    frames = [spark.sql("SELECT 1L k, 'a' note, CAST(1.5 AS FLOAT) value"), spark.sql("SELECT 2.5D value, 2 k")]
    assert rows_of(spark, parquet(spark, tmp_path, frames)) == [(1, "a", 1.5), (2, None, 2.5)]


@pytest.mark.parametrize("second, message", [("'b' note", "Required columns missing.*p_20240102"), ("2L k, 1 more", "p_20240102.*not in the manifest"), ("'x' k", "'k' of .*p_20240102.*not bigint")])
def test_every_parquet_file_is_checked(spark, tmp_path, second, message):
    settings = parquet(spark, tmp_path, [spark.sql("SELECT 1L k, 'a' note"), spark.sql(f"SELECT {second}")])
    with pytest.raises(ValueError, match=message):
        Job(spark, settings, "t").rows()


def test_extra_parquet_columns_can_be_dropped(spark, tmp_path):
    settings = parquet(spark, tmp_path, [spark.sql("SELECT 1L k, 1 more")], extra="drop")
    assert rows_of(spark, settings) == [(1, None, None)]


def test_escaped_quotes_and_line_breaks_behind_a_preamble(spark, tmp_path):
    (tmp_path / "t_20240101.csv").write_text('made by x\nk,note,value\n1,"a \\" b",1\n2,"c\nd \\"",2\n')
    options = {"read_options": {"skip_rows": 1}, "parse_options": {"escape_char": "\\", "double_quote": False, "newlines_in_values": True}}
    settings = job(spark, f"{tmp_path}/t_{{YYYYMMDD}}.csv", options=options)
    assert rows_of(spark, settings) == [(1, 'a " b', 1.0), (2, 'c\nd "', 2.0)]


def test_line_breaks_in_a_header(spark, tmp_path):
    (tmp_path / "t_20240101.csv").write_text('k,note,"val\nue"\n1,a,2\n')
    settings = config([f"{tmp_path}/t_{{YYYYMMDD}}.csv"], {"k": "int64", "note": "string", "val\nue": "double"}, {"options": {"parse_options": {"newlines_in_values": True}}})
    assert [tuple(r) for r in Job(spark, settings, "t").rows().collect()] == [(1, "a", 2.0)]


@pytest.mark.parametrize("encoding", ["utf-16", "UTF-16LE", "utf-32"])
def test_wide_encodings_behind_a_preamble(spark, tmp_path, encoding):
    (tmp_path / "t_20240101.csv").write_bytes("made by x\nk,note,value\n1,čĊ,1\n2,ż,2\n".encode(encoding))
    settings = job(spark, f"{tmp_path}/t_{{YYYYMMDD}}.csv", encoding=encoding, options={"read_options": {"skip_rows": 1}})
    assert rows_of(spark, settings) == [(1, "čĊ", 1.0), (2, "ż", 2.0)]


@pytest.mark.parametrize("text", ["timestamp[us, zone=UTC]", "timestamp[h]", "timestamp[us, tz=UTC, x]"])
def test_unknown_timestamp_arguments_raise(text):
    with pytest.raises(ValueError):
        parse_type(text)


def test_checksums_lie_in_the_output(spark, tmp_path):
    import hashlib

    from rawlake.operators import sink

    target = f"{tmp_path}/out.parq"
    spark.range(10).repartition(3).write.parquet(target)
    sink.write_checksums(spark, [target])
    told = {r["name"]: r["md5"] for r in sink.read_checksums(spark.createDataFrame([(target,)], "output string")).collect()}
    parts = {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in (tmp_path / "out.parq").glob("*.parquet")}
    assert told == parts
    assert len(parts) > 1
    assert spark.read.parquet(target).count() == 10


def test_schemes_of_object_stores():
    from pyarrow import fs

    from rawlake.sources import remote

    system, name = remote._locate("s3a://bucket/a/b.csv?region=eu-west-1")
    assert isinstance(system, fs.S3FileSystem)
    assert name == "bucket/a/b.csv"
