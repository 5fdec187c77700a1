"""Schemas, column operators, row numbers and lineage columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.fixtures.staging import csv_line, stage_lines
from rawlake.functions.registry import apply_function, build
from rawlake.operators import columns as ops
from rawlake.operators import ordinal, schema
from rawlake.plans.ingest import Job, ingest
from rawlake.queries import query
from rawlake.queries.staged import (
    MONTHLY, ORDER_COLUMNS, ORDER_TYPES, config, manifest, month_path, monthly_orders, once, order_cells, table, text,
)
from rawlake.types import load_manifest, unify

RUN = dt.datetime(2026, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def _stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


# -- schemas ------------------------------------------------------------------------------

_ALL_TYPES = {
    "event_id": "int", "event_type": "string", "value": "number", "day": "date32", "day64": "date", "ts": "timestamp[us]",
    "ts_utc": "timestamp[us, tz=UTC]", "flag": "bool", "props": "string not null",
}


@query(
    "schema_types",
    """SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') AS day64,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_utc,
              event_id % 2 = 0 AS flag, props FROM events""",
)
def schema_types(spark: SparkSession, sf: str) -> DataFrame:
    def write(root: str) -> None:
        iso = "yyyy-MM-dd HH:mm:ss.SSSSSS"
        flag = F.when(F.col("event_id") % 2 == 0, "true").otherwise("false")
        line = csv_line(
            text("event_id"), F.col("event_type"), text("value"), F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM-dd"),
            F.date_format("ts", iso), F.concat(F.date_format("ts", iso), F.lit("Z")), flag, F.col("props"),
        )
        head = F.lit(",".join(_ALL_TYPES))
        stage_lines(table(spark, sf, "events"), root, month_path(at="ts"), line, [F.col("event_id")], head)

    root = once(spark, sf, "events-types", write)
    options = {"convert_options": {"timestamp_parsers": ["ISO8601"]}}
    rows = ingest(spark, config([f"{root}/{MONTHLY}"], _ALL_TYPES, {"options": options}), "t")
    days = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("day", "day64")]
    return rows.select("event_id", "event_type", "value", *days, _stamp("ts"), _stamp("ts_utc"), "flag", "props")


def _customers(spark: SparkSession, sf: str) -> str:
    """Customer files per nation; every other nation's lack the balance."""

    def write(root: str) -> None:
        customers = table(spark, sf, "customer")
        path = F.concat(F.lit("c_"), F.lpad(text("c_nationkey"), 2, "0"), F.lit(".csv"))
        even = F.col("c_nationkey") % 2 == 0
        full = ["c_custkey", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment"]
        for names, which in ((full, even), ([n for n in full if n != "c_acctbal"], ~even)):
            line = csv_line(*[text(n) for n in names])
            stage_lines(customers.where(which), root, path, line, [F.col("c_custkey")], F.lit(",".join(names)))

    return once(spark, sf, "customers-optional", write)


_CUSTOMER_TYPES = {"c_custkey": "int64", "c_acctbal": "double", "c_name": "string", "c_nationkey": "int64", "c_mktsegment": "string"}


@query(
    "column_ops",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal END AS c_acctbal, c_name, c_mktsegment,
              CAST(NULL AS VARCHAR) AS comment FROM customer""",
)
def column_ops(spark: SparkSession, sf: str) -> DataFrame:
    operations = {"c_acctbal": "source_optional", "c_nationkey": "output_ignored", "comment": "source_optional"}
    types = {**_CUSTOMER_TYPES, "comment": "string"}
    return ingest(spark, config([f"{_customers(spark, sf)}/c_{{DD}}.csv"], types, operations=operations), "t")


@query(
    "optional_columns",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal END AS c_acctbal FROM customer""",
)
def optional_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = ingest(
        spark, config([f"{_customers(spark, sf)}/c_{{DD}}.csv"], _CUSTOMER_TYPES, operations={"c_acctbal": "source_optional"}), "t"
    )
    return rows.select("c_custkey", "c_acctbal")


@query("ignored_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def ignored_columns(spark: SparkSession, sf: str) -> DataFrame:
    operations = {"c_acctbal": "output_ignored", "c_name": "output_ignored", "c_nationkey": "output_ignored"}
    return ingest(spark, config([f"{_customers(spark, sf)}/c_{{DD}}.csv"], _CUSTOMER_TYPES, operations=operations), "t")


@query(
    "required_columns",
    """SELECT DISTINCT 'c_' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '.csv' AS file_name, n.name
       FROM customer, (VALUES ('c_acctbal'), ('c_phone')) AS n(name)
       WHERE n.name = 'c_phone' OR c_nationkey % 2 = 1""",
)
def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    from rawlake.sources import heads
    from rawlake.sources.inventory import base_name, discover
    from rawlake.sources.templates import PathTemplate

    found = discover(spark, PathTemplate(f"{_customers(spark, sf)}/c_{{DD}}.csv"))
    headers = heads.peek(found).select("path", F.explode("names").alias("name"))
    wanted = load_manifest(spark, manifest({**_CUSTOMER_TYPES, "c_phone": "string"}))
    return schema.required_columns(headers, wanted).select(base_name(F.col("path")).alias("file_name"), "name")


@query(
    "schema_unify",
    """SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region, CAST(NULL AS VARCHAR) AS note FROM nation
       UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier""",
)
def schema_unify(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")
    )
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey").isNotNull(), "supplier").alias("note"))
    target = unify(nation.schema, supplier.schema)
    return schema.conform(nation.unionByName(supplier, allowMissingColumns=True), target)


@query("conform_output", "SELECT p_retailprice, p_partkey, p_name FROM part")
def conform_output(spark: SparkSession, sf: str) -> DataFrame:
    target = load_manifest(
        spark, manifest({"p_retailprice": "double", "p_partkey": "int64", "p_name": "string"}, not_null=("p_partkey",))
    )
    return schema.conform(table(spark, sf, "part"), target)


# -- columns ----------------------------------------------------------------------------------


@query("append_constants", "SELECT n_nationkey, 7 AS n, 'x' AS label, CAST(NULL AS DOUBLE) AS missing, CAST(3 AS DOUBLE) AS weight FROM nation")
def append_constants(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey")
    values = {"n": 7, "label": "x", "missing": None, "weight": 3}
    return ops.append_constants(nation, values, {"n": "int64", "missing": "double", "weight": "double"})


@query("append_column", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_totalprice AS price FROM orders")
def append_column(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders")
    df = ops.append_column(df, "customer", "o_custkey", "string")
    return ops.append_column(df, "price", "o_totalprice").select("o_orderkey", "customer", "price")


@query("replace_column", "SELECT o_orderkey, o_custkey + 1 AS o_custkey, upper(o_orderpriority) AS o_orderpriority FROM orders")
def replace_column(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    df = ops.replace_column(df, "o_custkey", F.col("o_custkey") + 1)
    return apply_function(df, "o_orderpriority", "utf8_upper")


@query(
    "safe_cast",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_linenumber AS DOUBLE) AS line,
              CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity_text, CAST(l_partkey AS VARCHAR) AS part_text,
              strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem""",
)
def safe_cast(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    types = {f.name: f.dataType for f in df.schema}

    def cast(name: str, target: str):
        return ops.safe_cast(F.col(name), types[name], target)

    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", cast("l_quantity", "int64").alias("quantity"), cast("l_linenumber", "double").alias("line"),
        cast("l_quantity", "string").alias("quantity_text"), cast("l_partkey", "string").alias("part_text"),
        F.date_format(cast("l_shipdate", "date32"), "yyyy-MM-dd").alias("shipped"),
    )


# -- row numbers ---------------------------------------------------------------------------------


@query(
    "line_ordinal",
    """SELECT file_name, CASE WHEN line = 0 THEN 'head' ELSE CAST(o_orderkey AS VARCHAR) END AS content, line FROM (
         SELECT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS file_name, o_orderkey,
                row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) AS line FROM orders
         UNION ALL SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv', -1, 0 FROM orders)""",
)
def line_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    lines = ordinal.tag_scan(spark.read.text(f"{root}/*/*/orders_*.csv"))
    numbered, _ = ordinal.number_scan(lines)
    first = F.substring_index("value", ",", 1)
    return numbered.select(
        F.element_at(F.split("_fp", "/"), -1).alias("file_name"),
        F.when(first == "o_orderkey", "head").otherwise(first).alias("content"),
        F.col("_findex").alias("line"),
    )


@query(
    "index_per_file",
    """SELECT o_orderkey, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) - 1 AS _index FROM orders""",
)
def index_per_file(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    return Job(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={}), "t").rows().select("o_orderkey", "_index")


@query(
    "index_global",
    """SELECT o_orderkey, row_number() OVER (ORDER BY strftime(o_orderdate, '%Y%m'), o_orderkey) - 1 AS _index FROM orders""",
)
def index_global(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    job = Job(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={}, aggregate=True), "t")
    return job.rows().select("o_orderkey", "_index")


# -- lineage -----------------------------------------------------------------------------------------


@query(
    "standard_metadata",
    """SELECT o_orderkey, 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS _source_file,
              '2026-01-02 03:04:05.000000' AS _creation_time, strftime(o_orderdate, '%Y-%m') || '-01 00:00:00.000000' AS _knowledge_time,
              strftime(o_orderdate, '%Y-%m') || '-01' AS _knowledge_date,
              row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) - 1 AS _index FROM orders""",
)
def standard_metadata(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    rows = Job(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={}), "t", creation_time=RUN).rows()
    return rows.select(
        "o_orderkey", "_source_file", _stamp("_creation_time"), _stamp("_knowledge_time"),
        F.date_format("_knowledge_date", "yyyy-MM-dd").alias("_knowledge_date"), "_index",
    )


def _timed_events(spark: SparkSession, sf: str) -> str:
    """Events per hour of day, the hour and fraction in the file name, and a
    creation line with the day's end before the header."""

    def write(root: str) -> None:
        path = F.concat(
            F.date_format("ts", "yyyy/MM/"), F.lit("x_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"),
            F.date_format("ts", "HH"), F.lit("3015250.csv"),
        )
        made = F.concat(F.lit('"CREATE_DATETIME:","'), F.date_format("ts", "dd-MMM-yyyy HH"), F.lit(':59:58"\nevent_id,event_type,value'))
        line = csv_line(text("event_id"), F.col("event_type"), text("value"))
        stage_lines(table(spark, sf, "events"), root, path, line, [F.col("event_id")], made)

    return once(spark, sf, "events-timed", write)


_EVENT_TYPES = {"event_id": "int64", "event_type": "string", "value": "double"}
_TIMED = "{YYYY}/{MM}/x_{YYYYMMDD}_{hh}{mm}{ss}{ms}.csv"
_SKIP = {"options": {"read_options": {"skip_rows": 1}}}


def _timed_job(spark: SparkSession, sf: str, metadata: dict) -> DataFrame:
    root = _timed_events(spark, sf)
    return Job(spark, config([f"{root}/{_TIMED}"], _EVENT_TYPES, _SKIP, metadata=metadata), "t", creation_time=RUN).rows()


@query(
    "knowledge_time_filename",
    """SELECT event_id, strftime(date_trunc('hour', ts) + INTERVAL 30 MINUTE + INTERVAL 15250 MILLISECOND
              - CASE WHEN ts < TIMESTAMP '2024-03-31 03:00:00' THEN INTERVAL 1 HOUR ELSE INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M:%S.%f') AS _knowledge_time
       FROM events""",
)
def knowledge_time_filename(spark: SparkSession, sf: str) -> DataFrame:
    rows = _timed_job(spark, sf, {"knowledge_time": {"from": "file_name", "tz": "Europe/Paris"}})
    return rows.select("event_id", _stamp("_knowledge_time"))


@query(
    "knowledge_date",
    """SELECT event_id, strftime(date_trunc('hour', ts) + INTERVAL 30 MINUTE - INTERVAL 9 HOUR, '%Y-%m-%d') AS _knowledge_date FROM events""",
)
def knowledge_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = _timed_job(spark, sf, {"knowledge_time": {"from": "file_name", "tz": "Asia/Tokyo"}})
    return rows.select("event_id", F.date_format("_knowledge_date", "yyyy-MM-dd").alias("_knowledge_date"))


@query(
    "knowledge_time_header",
    """SELECT event_id, strftime(date_trunc('hour', ts) + INTERVAL 3598 SECOND, '%Y-%m-%d %H:%M:%S.%f') AS _knowledge_time FROM events""",
)
def knowledge_time_header(spark: SparkSession, sf: str) -> DataFrame:
    knowledge = {
        "from": "csv_header", "tz": "UTC", "header_line": 1, "header_pattern": '"CREATE_DATETIME:","([^"]+)"',
        "format": "%d-%b-%Y %H:%M:%S",
    }
    return _timed_job(spark, sf, {"knowledge_time": knowledge}).select("event_id", _stamp("_knowledge_time"))


_QUIET = {"standard_metadata": False}


@query(
    "meta_extract_vars",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%m') AS BIGINT) AS file_month, 'orders' AS kind FROM orders""",
)
def meta_extract_vars(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    additional = {
        "file_month": {"source": "extract_vars.month", "dtype": "int64"},
        "kind": {"source": "extract_vars.kind", "dtype": "string"},
    }
    settings = config(
        [f"{root}/{{YYYY}}/([0-9][0-9])/([a-z]*)_{{YYYYMMDD}}.csv"], ORDER_TYPES, metadata={**_QUIET, "additional_metadata": additional},
        extract_vars={"month": {"dtype": "int", "regex_group": 1}, "kind": {"dtype": "string", "regex_group": 2}},
    )
    return Job(spark, settings, "t").rows().select("o_orderkey", "file_month", "kind")


@query(
    "meta_file_fields",
    """SELECT o_orderkey, 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS name,
              strftime(o_orderdate, '%Y/%m') || '/orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS tail,
              true AS sized, true AS dated, CAST(NULL AS VARCHAR) AS archive FROM orders""",
)
def meta_file_fields(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    fields = {"name": "file_name", "path": "file_path", "size": "file_size", "mtime": "file_mtime", "archive": "zfile_name"}
    kinds = {"size": "int64", "mtime": "timestamp[us, tz=UTC]"}
    additional = {k: {"source": f"metadata.{f}", "dtype": kinds.get(k, "string")} for k, f in fields.items()}
    rows = Job(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={**_QUIET, "additional_metadata": additional}), "t").rows()
    return rows.select(
        "o_orderkey", "name", F.replace("path", F.lit(root + "/"), F.lit("")).alias("tail"), (F.col("size") > 0).alias("sized"),
        F.col("mtime").isNotNull().alias("dated"), "archive",
    )


@query("meta_column_copy", "SELECT o_orderkey, o_orderstatus AS status_copy, o_totalprice AS price_copy FROM orders")
def meta_column_copy(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    additional = {
        "status_copy": {"source": "column.o_orderstatus", "dtype": "string"},
        "price_copy": {"source": "column.o_totalprice.usd", "dtype": "double"},
    }
    rows = Job(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={**_QUIET, "additional_metadata": additional}), "t").rows()
    return rows.select("o_orderkey", "status_copy", "price_copy")


@query(
    "meta_func_cast",
    """SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS dollars, lower(o_orderpriority) AS priority,
              strftime(o_orderdate, '%Y%m%d') AS day_text, upper(strftime(o_orderdate, '%Y')) AS file_year,
              CASE WHEN o_orderkey = last_key THEN NULL ELSE o_orderkey END AS _skip_last FROM (
              SELECT *, max(o_orderkey) OVER (PARTITION BY strftime(o_orderdate, '%Y%m')) AS last_key FROM orders)""",
)
def meta_func_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Scalar functions, and one that looks at the next row of the file."""
    root = monthly_orders(spark, sf)
    additional = {
        "dollars": {"source": "column.o_totalprice", "dtype": "int64", "func": "floor"},
        "priority": {"source": "column.o_orderpriority", "dtype": "string", "func": "utf8_lower"},
        "day_text": {"source": "column.o_orderdate", "dtype": "string", "func": "strftime", "func_kwargs": {"format": "%Y%m%d"}},
        "file_year": {"source": "extract_vars.year", "dtype": "string", "func": "utf8_upper"},
        "step": {"source": "column.o_orderkey", "dtype": "int64", "func": "pairwise_diff", "func_kwargs": {"period": -1}},
    }
    settings = config(
        [f"{root}/([0-9]*)/{{MM}}/orders_{{YYYYMMDD}}.csv"], ORDER_TYPES, metadata={"additional_metadata": additional},
        extract_vars={"year": {"dtype": "string", "regex_group": 1}},
    )
    rows = Job(spark, settings, "t").rows()
    last = F.when(F.col("step").isNotNull(), F.col("o_orderkey"))
    return rows.select("o_orderkey", "dollars", "priority", "day_text", "file_year", last.alias("_skip_last"))


__all__ = ["ORDER_COLUMNS", "RUN", "build", "order_cells"]


@query(
    "file_times",
    """SELECT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS _source_file, count(*) AS rows, true AS mtime_told, true AS knowledge_told
       FROM orders GROUP BY 1""",
)
def file_times(spark: SparkSession, sf: str) -> DataFrame:
    """Modification times as columns, and as knowledge times, against those of Spark's own listing of the files."""
    root = monthly_orders(spark, sf)
    settings = config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={"knowledge_time": {"from": "file_mtime"}})
    rows = ingest(spark, settings, "t")
    listed = spark.read.format("binaryFile").load(f"{root}/*/*/*.csv")
    listed = listed.select(F.substring_index("path", "/", -1).alias("_source_file"), "modificationTime")
    told = rows.join(listed, "_source_file", "left")
    same = [(F.col(c).isNotNull() & (F.col(c) == F.col("modificationTime"))) for c in ("_source_file_mtime", "_knowledge_time")]
    return told.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.coalesce(same[0], F.lit(False))).alias("mtime_told"),
        F.bool_and(F.coalesce(same[1], F.lit(False))).alias("knowledge_told"),
    )
