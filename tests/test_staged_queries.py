"""Queries give the rows of their SQL when each of their raw files is put together from parts by many tasks."""

import oracle
import pytest

import __spark_entry__ as entry
from rawlake.fixtures import staging
from rawlake.plans.ingest import Job
from rawlake.queries import staged


@pytest.mark.parametrize("name", ["convert_timestamps", "optional_columns_lines", "scan_encoding", "enforce_types", "scan_pipe_preset", "scan_sectioned"])
def test_files_in_parts(spark, sf, monkeypatch, name):
    seen, placed = [], staging._placed

    def spy(parts, root):
        seen.append((parts.count(), parts.select("path").distinct().count()))
        return placed(parts, root)

    monkeypatch.setattr(staging, "PART_BYTES", 20_000)
    monkeypatch.setattr(staging, "_placed", spy)
    monkeypatch.setattr(staged, "_DONE", {})
    assert oracle.compare(spark, oracle.duck(sf), sf, name, entry.queries()[name], entry.oracle_sql()[name]) is None
    assert seen and all(parts > files for parts, files in seen)


def test_raw_files_named_by_a_local_uri(spark, tmp_path):
    (tmp_path / "f_20240131.csv").write_text("k\n1\n2\n")
    settings = staged.config([f"file://{tmp_path}/f_{{YYYYMMDD}}.csv"], {"k": "int64"})
    assert sorted(r["k"] for r in Job(spark, settings, "t").rows().collect()) == [1, 2]
