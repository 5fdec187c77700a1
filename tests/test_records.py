"""Quoted records cut by byte ranges of any size against one reading front to back."""

import io
import random

import pytest
from pyspark.sql import functions as F

from rawlake.plans.ingest import ingest
from rawlake.queries.staged import config
from rawlake.sources import archive, records, remote


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def cut_here(monkeypatch, content, width, escape=None, encoding="utf-8"):
    """What the tasks do, one after the other."""
    monkeypatch.setattr(remote, "open_input", lambda path: Memory(content))
    look = records._Look(width, encoding, '"', escape)
    within, number, out, seen = False, 0, [], 0
    for begin in range(0, max(len(content), 1), width):
        odd, outside, inside, ends, *_ = look._facts(Memory(content), begin)
        own = [r for held in look._records("x", begin, within, number) for r in held]
        assert len(own) == (inside if within else outside)
        out += own
        number += len(own)
        within ^= bool(odd)
        seen += ends
    return out, within, seen


def front_to_back(content, escape=None):
    text = io.TextIOWrapper(io.BytesIO(content), encoding="utf-8", newline=None)
    return [r.encode() for r in remote.records((line.removesuffix("\n") for line in text), '"', escape)]


@pytest.mark.parametrize("escape", [None, "\\", '"'])
def test_ranges_of_any_size_give_the_same_records(monkeypatch, escape):
    rng = random.Random(4)
    checked = 0
    for _ in range(400):
        parts = ['"', '""', "a", "é", "日", ",", "\n", "\r\n", "\r", "\\", "\\\\", '\\"', '"x\ny"', "\n\n"]
        content = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))).encode()
        try:
            want = front_to_back(content, escape)
        except ValueError as e:
            want = str(e)
        for chunk in (3, 1 << 20):
            monkeypatch.setattr(records, "CHUNK", chunk)
            for width in (1, 2, 3, 7, 1000):
                got, opened, _ = cut_here(monkeypatch, content, width, escape)
                assert opened == isinstance(want, str)
                if not opened:
                    assert got == want, (content, width)
                    checked += 1
    assert checked > 1000


def inventory(spark, path):
    size = len(open(path, "rb").read())
    facts = ", ".join(f"{n} {t}" for n, t in zip(records._FACTS, ("timestamp", "bigint", "string", "timestamp", "bigint", "bigint")))
    return spark.createDataFrame([(str(path), None, size, None, None, None, None)], f"path string, {facts}")


@pytest.mark.parametrize("width", [50, 997, 1 << 20])
def test_records_keep_number_and_text_and_ranges_are_tasks(spark, tmp_path, width):
    rng = random.Random(5)
    lines = [f'{k},"{"x" * rng.randint(0, 60)}\n""q"" {k}"' if k % 3 else f"{k},plain" for k in range(700)]
    path = tmp_path / "a.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode())
    got = records.cut(inventory(spark, path), archive.LINES_SCHEMA, 0, "utf-8", '"', width=width).collect()
    assert [r["value"] for r in sorted(got, key=lambda r: r["_mid"])] == lines
    assert sorted(r["_mid"] for r in got) == list(range(700))
    size = path.stat().st_size
    assert len({r["_bs"] for r in got}) >= min(size // width, 300) * 0.8


def test_an_open_quote_raises_with_file_and_line(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("k,v\n" + 'a,"1\n2"\n' * 100 + 'b,"never\nclosed\n' + "c,3\n" * 50)
    for width in (64, 1 << 20):
        with pytest.raises(ValueError, match="begins in line 202 of .*b.csv"):
            records.cut(inventory(spark, path), archive.LINES_SCHEMA, 0, "utf-8", '"', width=width)
    with pytest.raises(ValueError, match="line 202"):
        list(remote.records(iter(path.read_text().split("\n")), '"'))


def test_records_that_are_too_long_raise(monkeypatch):
    monkeypatch.setattr(records, "RECORD_BYTES", 1000)
    monkeypatch.setattr(records, "CHUNK", 100)
    content = b'a\n"' + b"x\n" * 2000 + b'"\n'
    with pytest.raises(ValueError, match="Record 1 of 'x' is longer"):
        cut_here(monkeypatch, content, 10_000)


@pytest.mark.parametrize("size", ["300b", "128m"])
def test_an_ingest_does_not_depend_on_the_size_of_ranges(spark, tmp_path, size):
    for d in ("01", "02"):
        rows = "".join(f'{k},"line {d}\n,""{k}"""\n' for k in range(200))
        (tmp_path / f"x_202401{d}.csv").write_text("k,v\n" + rows)
    settings = config([f"{tmp_path}/x_{{YYYYMMDD}}.csv"], {"k": "int64", "v": "string"}, {"options": {"parse_options": {"newlines_in_values": True}}}, metadata={})
    own = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted((r["_source_file"], r["_index"], r["k"], r["v"]) for r in ingest(spark, settings, "t").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)
    assert got == [(f"x_202401{d}.csv", k, k, f'line {d}\n,"{k}"') for d in ("01", "02") for k in range(200)]


def test_marks_that_ranges_cannot_find_are_known():
    assert records.single_bytes("utf-8", '"', "\\") and records.single_bytes("latin-1", '"', None) and records.single_bytes("cp1252", "'")
    assert not records.single_bytes("utf-16", '"') and not records.single_bytes("shift_jis", '"') and not records.single_bytes("utf-8", "«")


def test_ranges_are_cut_by_many_tasks(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("".join(f'{k},"a\nb"\n' for k in range(400)))
    got = records.cut(inventory(spark, path), archive.LINES_SCHEMA, 0, "utf-8", '"', width=400)
    assert got.count() == 400 and got.select(F.spark_partition_id()).distinct().count() > 3
