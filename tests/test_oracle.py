"""A cross-section of the example queries against DuckDB."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

NAMES = [
    "scan_csv", "scan_csv_skip_rows", "convert_bools", "scan_zip", "column_ops", "standard_metadata", "index_global",
    "date_parts_derived", "range_filter", "lineage_join", "infer_types", "aggregate_mode", "safe_cast", "filter_pushdown", "fn_logic",
]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, name):
    assert compare(spark, duck(sf), sf, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["_knowledge_date", "orders", "total_price", "last_index"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
