"""Schema inference over staged files and over type names."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.fixtures.staging import csv_line, stage_lines
from rawlake.operators import infer
from rawlake.plans.bootstrap import infer_table
from rawlake.plans.ingest import ingest
from rawlake.queries import query
from rawlake.queries.staged import config, month_path, once, table, text
from rawlake.sources import scan
from rawlake.sources.inventory import discover
from rawlake.sources.templates import PathTemplate
from pyspark.sql import types as T

NAMES = ["o_orderkey", "o_totalprice", "o_orderdate", "stamp", "flag", "mixed", "blank", "o_orderpriority", "compact"]
TEMPLATE = "{YYYY}/{MM}/orders_{YYYYMMDD}.csv"


def typed_orders(spark: SparkSession, sf: str) -> str:
    """Monthly orders; ``mixed`` is whole in even months and fractional in odd
    ones, ``compact`` is there in even months only."""

    def write(root: str) -> None:
        even = F.month("o_orderdate") % 2 == 0
        orders = table(spark, sf, "orders")
        mixed = F.when(even, text("o_custkey")).otherwise(F.concat(text("o_custkey"), F.lit(".5")))
        cells = [
            text("o_orderkey"), text("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("o_custkey") % 2 == 0, "true").otherwise("False"),
            mixed, F.lit(None).cast("string"), F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyyMMdd"),
        ]
        for which, n in ((even, len(NAMES)), (~even, len(NAMES) - 1)):
            head = F.lit(",".join(NAMES[:n]))
            stage_lines(orders.where(which), root, month_path(), csv_line(*cells[:n]), [F.col("o_orderkey")], head)

    return once(spark, sf, "orders-typed", write)


def _scans(spark: SparkSession, sf: str) -> list[scan.Scan]:
    found = discover(spark, PathTemplate(f"{typed_orders(spark, sf)}/{TEMPLATE}"))
    return scan.scan_text(found, scan.TextFormat(), T.StructType([]), extra="drop")


def _types(spark: SparkSession, sf: str, iso: bool = True) -> DataFrame:
    options = {"timestamp_parsers": ["ISO8601"]} if iso else {}
    frames = [infer.file_types(s, options) for s in _scans(spark, sf)]
    return scan.union_scans(frames)


_FILES = """SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS file_name,
                   month(o_orderdate) % 2 = 0 AS is_even FROM orders"""


@query(
    "infer_types",
    f"""WITH f AS ({_FILES}), n AS (SELECT * FROM (VALUES ('o_orderkey', 'int64'), ('o_totalprice', 'double'), ('o_orderdate', 'date32'),
             ('stamp', 'timestamp[s]'), ('flag', 'bool'), ('mixed', '?'), ('blank', 'string'), ('o_orderpriority', 'string'),
             ('compact', 'int64')) AS t(name, kind))
        SELECT file_name, name, CASE WHEN kind = '?' THEN CASE WHEN is_even THEN 'int64' ELSE 'double' END ELSE kind END AS type
        FROM f, n WHERE is_even OR name <> 'compact'""",
)
def infer_types(spark: SparkSession, sf: str) -> DataFrame:
    types = _types(spark, sf)
    return types.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "name", infer.logical_type(F.col("type")).alias("type")
    )


@query(
    "infer_missing_column",
    """SELECT name, type FROM (VALUES ('o_orderkey', 'int64'), ('o_totalprice', 'double'), ('o_orderdate', 'date32'),
         ('stamp', 'timestamp[s]'), ('flag', 'bool'), ('mixed', 'double'), ('blank', 'string'), ('o_orderpriority', 'string'),
         ('compact', 'string')) AS t(name, type) WHERE EXISTS (SELECT 1 FROM orders)""",
)
def infer_missing_column(spark: SparkSession, sf: str) -> DataFrame:
    return infer.fold_types(_types(spark, sf))


@query(
    "infer_column_order",
    """WITH k AS (SELECT min(o_orderdate) AS first_day FROM orders)
       SELECT name, 'orders_' || strftime(CASE WHEN name = 'compact' AND month(first_day) % 2 = 1
                THEN (SELECT min(o_orderdate) FROM orders WHERE month(o_orderdate) % 2 = 0) ELSE first_day END, '%Y%m') || '01.csv' AS first_file,
              ord AS first_ord
       FROM k, (VALUES ('o_orderkey', 0), ('o_totalprice', 1), ('o_orderdate', 2), ('stamp', 3), ('flag', 4), ('mixed', 5), ('blank', 6),
                       ('o_orderpriority', 7), ('compact', 8)) AS t(name, ord)""",
)
def infer_column_order(spark: SparkSession, sf: str) -> DataFrame:
    order = infer.column_order(_types(spark, sf))
    return order.select("name", F.element_at(F.split("first_path", "/"), -1).alias("first_file"), "first_ord")


@query(
    "infer_common_type",
    """WITH t AS (SELECT o_custkey % 200 AS name,
           CASE o_orderkey % 7 WHEN 0 THEN CASE WHEN o_custkey % 4 = 0 THEN 'bool' ELSE 'date32' END
                WHEN 1 THEN CASE WHEN o_custkey % 4 = 0 THEN 'int64' ELSE 'date64' END
                WHEN 2 THEN CASE WHEN o_custkey % 4 IN (0, 1) THEN 'double' ELSE 'date32' END
                ELSE CASE o_custkey % 4 WHEN 0 THEN 'int64' WHEN 1 THEN 'date64' WHEN 2 THEN 'date32' ELSE 'timestamp[us]' END END AS kind
         FROM orders),
       c AS (SELECT name, kind, CASE WHEN kind IN ('bool', 'int64', 'double') THEN 'number' WHEN kind LIKE 'date%' THEN 'date' ELSE kind END AS family,
                    CASE kind WHEN 'bool' THEN 10 WHEN 'int64' THEN 20 WHEN 'double' THEN 40 WHEN 'date32' THEN 50 WHEN 'date64' THEN 51 ELSE 200 END AS rank FROM t)
       SELECT name, CASE WHEN count(DISTINCT family) = 1 THEN max_by(kind, rank) ELSE 'string' END AS type FROM c GROUP BY name""",
)
def infer_common_type(spark: SparkSession, sf: str) -> DataFrame:
    """The fold itself, on type names that every group of customers mixes its
    own way."""
    kind, turn = F.col("o_custkey") % 4, F.col("o_orderkey") % 7
    name = (
        F.when(turn == 0, F.when(kind == 0, "bool").otherwise("date32"))
        .when(turn == 1, F.when(kind == 0, "int64").otherwise("date64"))
        .when(turn == 2, F.when(kind.isin(0, 1), "double").otherwise("date32"))
        .when(kind == 0, "int64").when(kind == 1, "date64").when(kind == 2, "date32").otherwise("timestamp[us]")
    )
    types = table(spark, sf, "orders").select((F.col("o_custkey") % 200).alias("name"), name.alias("type"))
    return types.groupBy("name").agg(infer.common_type().alias("type"))


@query(
    "infer_manifest",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
              o_custkey % 2 = 0 AS flag, o_custkey + CASE WHEN month(o_orderdate) % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS mixed, o_orderpriority
       FROM orders""",
)
def infer_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Infer a manifest, then ingest the same files under it."""
    settings = config([f"{typed_orders(spark, sf)}/{TEMPLATE}"], {})
    manifest = json.loads(json.dumps(infer.infer_manifest(_scans(spark, sf))))
    for spec in manifest["schema"].values():
        if spec["name"] == "compact":
            spec["column_operation"] = "source_optional"
    settings["manifest"] = manifest
    rows = ingest(spark, settings, "t")
    return rows.select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "stamp", "flag", "mixed", "o_orderpriority"
    )


@query(
    "infer_parquet_mixed",
    """SELECT name, type FROM (VALUES ('o_orderkey', 'int64'), ('amount', 'double'), ('day', 'date32'), ('note', 'string'), ('level', 'string'),
         ('flag', 'string')) AS t(name, type) WHERE EXISTS (SELECT 1 FROM orders)
       UNION ALL SELECT 'sum of amounts', CAST(CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 0.5 END) AS DECIMAL(30, 1)) AS VARCHAR) FROM orders""",
)
def infer_parquet_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet files of differing types: whole numbers and fractions give fractions, what some files
    lack gives text, as does what is of two kinds. The manifest then reads all of them."""

    def write(root: str) -> None:
        orders = table(spark, sf, "orders")
        even = F.col("o_orderkey") % 2 == 0
        same = ["o_orderkey", F.col("o_orderdate").cast("date").alias("day")]
        whole = orders.where(even).select(*same, F.col("o_custkey").cast("bigint").alias("amount"), F.lit("n").alias("note"), "o_orderpriority", F.lit(True).alias("flag"))
        parts = orders.where(~even).select(*same, (F.col("o_custkey") + F.lit(0.5)).cast("double").alias("amount"), "o_orderpriority", F.lit("x").alias("flag"))
        for d, part in (("01", whole), ("02", parts)):
            part.withColumnRenamed("o_orderpriority", "level").write.parquet(f"{root}/day=202401{d}")

    root = once(spark, sf, "orders-parquet-mixed", write)
    settings = config([f"{root}/day={{YYYYMMDD}}/part-(.*).parquet"], {}, {"format": "parquet", "extra": "drop"}, metadata={})
    settings["tables"]["t"]["raw_files"] = [f"{root}/day={{YYYYMMDD}}/part-*.parquet"]
    manifest = infer_table(spark, settings, "t")
    found = [(c["name"], c["type"]) for c in manifest["schema"].values()]
    kept = {k: c for k, c in manifest["schema"].items() if c["name"] in ("o_orderkey", "amount", "day", "level")}
    rows = ingest(spark, {**settings, "manifest": {"schema": kept}}, "t")
    total = rows.agg(F.lit("sum of amounts").alias("name"), F.sum(F.col("amount").cast("decimal(30,1)")).cast("string").alias("type"))
    return spark.createDataFrame(found, "name string, type string").unionByName(total)
