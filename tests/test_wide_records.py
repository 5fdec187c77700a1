"""Quoted records of encodings with units of two and four bytes, cut by byte ranges."""

import random

import pytest
from test_records import Memory, front_to_back

from rawlake.plans.ingest import ingest
from rawlake.queries.staged import config
from rawlake.sources import archive, records, remote

# Characters of which a byte, but no unit, is that of a line end, a quote or a backslash.
TRICKS = "਀ഊ\u000e∊∀尀≜ਢ😀\U0001f422"


@pytest.mark.parametrize("encoding", ["utf-16-le", "UTF-16BE", "utf-32-le"])
@pytest.mark.parametrize("escape", [None, "\\"])
def test_ranges_of_any_size_give_the_same_records(monkeypatch, encoding, escape):
    rng = random.Random(7)
    parts = ['"', '""', "a", ",", "\n", "\r\n", "\r", "\\", '\\"', '"x\ny"', *TRICKS]
    checked = 0
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        try:
            want = front_to_back(text.encode(), escape)
        except ValueError:
            want = None
        content = text.encode(encoding)
        monkeypatch.setattr(remote, "open_input", lambda path: Memory(content))
        for chunk in (5, 1 << 20):
            monkeypatch.setattr(records, "CHUNK", chunk)
            for width in (1, 4, 7, 13, 1000):
                look = records._Look(width, encoding, '"', escape)
                within, got = False, []
                for begin in range(0, max(len(content), 1), look.width):
                    odd, outside, inside, *_ = look._facts(Memory(content), begin)
                    own = [r for held in look._records("x", begin, within, 0) for r in held]
                    assert len(own) == (inside if within else outside)
                    got += own
                    within ^= bool(odd)
                assert within == (want is None)
                if not within:
                    assert got == want, (text, width)
                    checked += 1
    assert checked > 300


def test_half_a_unit_at_the_end_raises(monkeypatch):
    for content in (b"a\0\n\0b", b"a\0b\0\n", b"a\0b\0c"):
        monkeypatch.setattr(remote, "open_input", lambda path: Memory(content))
        for width in (2, 4, 1000):
            look = records._Look(width, "utf-16-le", '"', None)
            with pytest.raises(UnicodeDecodeError):
                for begin in range(0, len(content), look.width):
                    list(look._records("x", begin, False, 0))


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [f'{k},"line\n,""{k}"" {TRICKS}"' for k in range(400)]
    for encoding in ("utf-16-le", "utf-16-be"):
        path = tmp_path / f"x_{encoding}_20240101.csv"
        path.write_bytes("\n".join(["made by hand", "k,v", *rows, ""]).encode(encoding))
        found = inventory_of(spark, path)
        own = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1001b")
        try:
            lines = archive.unpack_lines(found, 0, encoding, '"').collect()
            options = {"read_options": {"skip_rows": 1}, "parse_options": {"newlines_in_values": True}}
            raw = [f"{tmp_path}/x_{encoding}_{{YYYYMMDD}}.csv"]
            got = ingest(spark, config(raw, {"k": "int64", "v": "string"}, {"options": options, "encoding": encoding}, metadata={}), "t").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", own)
        assert [r["value"] for r in sorted(lines, key=lambda r: r["_mid"])] == ["made by hand", "k,v", *rows]
        assert len({r["_bs"] for r in lines}) > 10, "the file was read as one stream"
        assert sorted((r["_index"], r["k"], r["v"]) for r in got) == [(k, k, f'line\n,"{k}" {TRICKS}') for k in range(400)]


def inventory_of(spark, path):
    facts = "path string, codec string, file_mtime timestamp, file_size bigint, zfile_name string, zfile_mtime timestamp, zfile_size bigint, zfile_compress_size bigint"
    return spark.createDataFrame([(str(path), None, None, path.stat().st_size, None, None, None, None)], facts)


def test_encodings_that_ranges_can_cut_are_known():
    assert records.cuttable("utf-8", '"') and records.cuttable("UTF-16LE", '"', "\\") and records.cuttable("utf_32_be", "'")
    # A byte order mark tells the order of units only at the beginning.
    assert not records.cuttable("utf-16", '"') and not records.cuttable("shift_jis", '"') and not records.cuttable("utf-16-le", "«")
