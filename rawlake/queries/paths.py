"""Path algebra: discovery, date parts, variables, ranges, reverse lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.operators import backfill, trace
from rawlake.queries import query
from rawlake.queries.staged import MONTHLY, monthly_orders, table
from rawlake.sources import inventory
from rawlake.sources.inventory import base_name
from rawlake.sources.templates import PathTemplate


def order_paths(spark: SparkSession, sf: str) -> DataFrame:
    """A path per order: ``/raw/1998/10/03/orders_19981003_5-LOW.csv``."""
    path = F.concat(
        F.lit("/raw/"), F.date_format("o_orderdate", "yyyy/MM/dd/"), F.lit("orders_"),
        F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.col("o_orderpriority"), F.lit(".csv"),
    )
    return table(spark, sf, "orders").select("o_orderkey", path.alias("path"))


TEMPLATE = "/raw/{YYYY}/{MM}/{DD}/orders_{YYYYMMDD}_([0-9])-([A-Z ]*).csv"


@query(
    "discover_glob",
    """SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS file_name,
              strftime(o_orderdate, '%Y%m') || '01' AS d, true AS matched FROM orders""",
)
def discover_glob(spark: SparkSession, sf: str) -> DataFrame:
    template = PathTemplate(f"{monthly_orders(spark, sf)}/{MONTHLY}")
    return inventory.discover(spark, template).select("file_name", "d", "matched")


@query(
    "discover_regex",
    """SELECT o_orderkey, regexp_matches(o_orderpriority, '^[1-3]-') AS matched,
              CASE WHEN regexp_matches(o_orderpriority, '^[1-3]-') THEN substr(o_orderpriority, 1, 1) END AS level
       FROM orders""",
)
def discover_regex(spark: SparkSession, sf: str) -> DataFrame:
    template = PathTemplate(
        "/raw/{YYYY}/*/{DD}/orders_{YYYYMMDD}_([1-3])-*.csv", extract_vars={"level": {"regex_group": 1}}
    )
    path = F.col("path")
    outer, _ = template.regexes()
    return order_paths(spark, sf).select(
        "o_orderkey", path.rlike(f"^(?:{outer})").alias("matched"), template.variables(path)["level"].alias("level")
    )


@query(
    "date_parts",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS p_year, strftime(o_orderdate, '%m') AS p_month,
              strftime(o_orderdate, '%d') AS p_day, strftime(o_orderdate, '%Y%m%d') AS p_date FROM orders""",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = PathTemplate(TEMPLATE).raw_parts(F.col("path"))
    names = {"YYYY": "p_year", "MM": "p_month", "DD": "p_day", "YYYYMMDD": "p_date"}
    return order_paths(spark, sf).select("o_orderkey", *[parts[p].alias(n) for p, n in names.items()])


@query(
    "date_parts_derived",
    """SELECT o_orderkey, y AS p_yyyy, m AS p_mm, d AS p_dd, y || m AS p_yyyymm, y || m || d AS p_yyyymmdd,
              substr(y, 3) AS p_yy, substr(y, 3) || m AS p_yymm, substr(y, 3) || m || d AS p_yymmdd
       FROM (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 100 >= 69 THEN 1900 ELSE 2000 END + o_orderkey % 100 AS VARCHAR) AS y,
                    strftime(o_orderdate, '%m') AS m, strftime(o_orderdate, '%d') AS d FROM orders)""",
)
def date_parts_derived(spark: SparkSession, sf: str) -> DataFrame:
    # Two-digit years over the whole range, so that the pivot matters.
    year = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    path = F.concat(F.lit("/raw/x_"), year, F.date_format("o_orderdate", "MMdd"), F.lit(".csv"))
    parts = PathTemplate("/raw/x_{YYMMDD}.csv").parts(F.col("path"))
    names = ["YYYY", "MM", "DD", "YYYYMM", "YYYYMMDD", "YY", "YYMM", "YYMMDD"]
    rows = table(spark, sf, "orders").select("o_orderkey", path.alias("path"))
    return rows.select("o_orderkey", *[parts[n].alias(f"p_{n.lower()}") for n in names])


@query(
    "file_metadata",
    """SELECT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS file_name, strftime(o_orderdate, '%Y/%m/') || 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS below,
              CAST(NULL AS VARCHAR) AS member_name, false AS is_zip, true AS dated,
              CAST(length('o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority') + 1
                   + sum(length(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority)) + 1) AS BIGINT) AS file_size
       FROM orders GROUP BY 1, 2""",
)
def file_metadata(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    found = inventory.discover(spark, PathTemplate(f"{root}/{MONTHLY}"))
    below = F.replace("path", F.lit(f"{root}/"), F.lit(""))
    # Written by this session, so since it was started.
    started = F.timestamp_millis(F.lit(spark.sparkContext.startTime - 2000))
    dated = (F.col("file_mtime") >= started) & (F.col("file_mtime") <= F.current_timestamp())
    return found.select("file_name", below.alias("below"), "member_name", "is_zip", dated.alias("dated"), "file_size")


@query(
    "extract_vars",
    """SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS level,
              split_part(o_orderpriority, '-', 2) AS label, CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS weight,
              CAST(NULL AS VARCHAR) AS beyond, 'emea' AS region FROM orders""",
)
def extract_vars(spark: SparkSession, sf: str) -> DataFrame:
    template = PathTemplate(
        TEMPLATE,
        search_params={"region": "emea"},
        extract_vars={
            "level": {"dtype": "int", "regex_group": 1},
            "label": {"dtype": "other", "regex_group": 2},
            "weight": {"dtype": "float", "regex_group": 1},
            "beyond": {"regex_group": 3},
        },
    )
    values = template.variables(F.col("path"))
    return order_paths(spark, sf).select("o_orderkey", *[v.alias(k) for k, v in values.items()])


@query(
    "partition_key",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS by_date, strftime(o_orderdate, '%Y%m') AS by_month,
              CAST(o_orderkey AS VARCHAR) AS by_delta, CAST(NULL AS VARCHAR) AS by_other FROM orders""",
)
def partition_key(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    delta = F.concat(F.lit("/raw/"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return order_paths(spark, sf).select(
        "o_orderkey",
        PathTemplate(TEMPLATE).key(path).alias("by_date"),
        PathTemplate(TEMPLATE, file_type="month").key(path).alias("by_month"),
        PathTemplate("/raw/{delta}.csv", file_type="delta").key(delta).alias("by_delta"),
        PathTemplate(TEMPLATE, file_type="other").key(path).alias("by_other"),
    )


@query(
    "range_filter",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d FROM orders
       WHERE o_orderdate > TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1998-07-15'""",
)
def range_filter(spark: SparkSession, sf: str) -> DataFrame:
    keyed = order_paths(spark, sf).select("o_orderkey", PathTemplate(TEMPLATE).key(F.col("path")).alias("d"))
    return inventory.within(keyed, after="19960301", before="19980715")


def _keyed(spark: SparkSession, sf: str, file_type: str) -> DataFrame:
    key = PathTemplate(TEMPLATE, file_type=file_type).key(F.col("path"))
    return order_paths(spark, sf).select("o_orderkey", key.alias("d"))


@query(
    "find_range_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate <= TIMESTAMP '1998-02-28'""",
)
def find_range_date(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.in_range(_keyed(spark, sf, "date"), "19970201", "19980228").select("o_orderkey", "d")


@query(
    "find_range_month",
    """SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS file_name,
              strftime(o_orderdate, '%Y%m') AS d FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-11-01' AND o_orderdate < TIMESTAMP '1998-03-01'""",
)
def find_range_month(spark: SparkSession, sf: str) -> DataFrame:
    # Real files; only the folders of the months asked for are listed.
    root = monthly_orders(spark, sf)
    template = PathTemplate(f"{root}/{{YYYY}}/{{MM}}/orders_{{YYYYMM}}01.csv", file_type="month")
    return inventory.discover(spark, template, "199611", "199802").select("file_name", "d")


@query("find_range_delta", "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS d FROM orders WHERE o_orderkey BETWEEN 100 AND 900")
def find_range_delta(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/raw/"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    keys = table(spark, sf, "orders").select(
        "o_orderkey", PathTemplate("/raw/{delta}.csv", file_type="delta").key(path).alias("d")
    )
    return inventory.in_range(keys, "100", "900", "delta").select("o_orderkey", "d")


@query(
    "multi_template",
    """SELECT o_orderkey, t.template_ord, CASE WHEN t.template_ord = 0 THEN substr(o_orderpriority, 1, 1) END AS level
       FROM orders CROSS JOIN (VALUES (0), (1)) AS t(template_ord)
       WHERE t.template_ord = 1 OR regexp_matches(o_orderpriority, '^[12]-')""",
)
def multi_template(spark: SparkSession, sf: str) -> DataFrame:
    templates = [
        PathTemplate("/raw/{YYYY}/{MM}/{DD}/orders_{YYYYMMDD}_([12])-*", extract_vars={"level": {"regex_group": 1}}),
        PathTemplate("/raw/{YYYY}/{MM}/{DD}/orders_{YYYYMMDD}_*"),
    ]
    frames = []
    for i, template in enumerate(templates):
        found = inventory.describe(order_paths(spark, sf), template)
        level = F.try_element_at("extract_vars", F.lit("level"))
        frames.append(found.where("matched").select("o_orderkey", F.lit(i).alias("template_ord"), level.alias("level")))
    return frames[0].unionByName(frames[1])


@query(
    "sample_files",
    """WITH f AS (SELECT count(DISTINCT strftime(o_orderdate, '%Y%m')) AS n FROM orders)
       SELECT CAST(size AS BIGINT) AS asked, least(size, n) AS drawn, least(size, n) AS of_the_files FROM f, (VALUES (1), (20), (100000)) AS s(size)""",
)
def sample_files(spark: SparkSession, sf: str) -> DataFrame:
    """Which files a draw gives is random; how many, and that they are files found, is not."""
    found = inventory.discover(spark, PathTemplate(f"{monthly_orders(spark, sf)}/{MONTHLY}"))
    names = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM"), F.lit("01.csv"))
    files = table(spark, sf, "orders").select(names.alias("file_name")).distinct().withColumn("known", F.lit(1))
    draws = []
    for size in (1, 20, 100000):
        drawn = inventory.sample_files(found, size, seed=7).select("file_name").distinct().join(files, "file_name", "left")
        draws.append(drawn.agg(F.lit(size).cast("bigint").alias("asked"), F.count("*").alias("drawn"), F.count("known").alias("of_the_files")))
    return draws[0].unionByName(draws[1]).unionByName(draws[2])


# -- reverse lineage -----------------------------------------------------------------

OUT_TEMPLATE = "1.0/enriched/{YYYY}/{YYYYMMDD}/{YYYYMMDD}.{seq_num}.{table}.parq"


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    """An output path per order: date, priority number and table."""
    date = F.date_format("o_orderdate", "yyyyMMdd")
    output = F.concat(
        F.lit("/lake/1.0/enriched/"), F.date_format("o_orderdate", "yyyy/"), date, F.lit("/"), date, F.lit("."),
        F.substring("o_orderpriority", 1, 1), F.lit(".orders.parq"),
    )
    return table(spark, sf, "orders").select("o_orderkey", output.alias("output"))


@query(
    "lineage_parse",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d, strftime(o_orderdate, '%y') AS yy,
              strftime(o_orderdate, '%m') AS month_part, strftime(o_orderdate, '%y%m') AS yymm,
              substr(o_orderpriority, 1, 1) AS seq_num, 'orders' AS table_name FROM orders""",
)
def lineage_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = trace.parse_outputs(_outputs(spark, sf), OUT_TEMPLATE, "/lake")

    def var(name: str) -> Column:
        return F.element_at("vars", F.lit(name))

    return parsed.select(
        "o_orderkey", "d", var("YY").alias("yy"), var("MM").alias("month_part"), var("YYMM").alias("yymm"),
        var("seq_num").alias("seq_num"), var("table").alias("table_name"),
    )


def _traced(spark: SparkSession, sf: str, how: str = "left") -> DataFrame:
    """Outputs of orders, and raw files by date and customer nation residue."""
    outputs = trace.parse_outputs(_outputs(spark, sf).select("output").distinct(), OUT_TEMPLATE, "/lake")
    raw_path = F.concat(
        F.lit("/raw/"), F.date_format("o_orderdate", "yyMMdd"), F.lit("_"), F.substring("o_orderpriority", 1, 1), F.lit("_"),
        (F.col("o_custkey") % 3).cast("string"), F.lit(".csv"),
    )
    raw = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(raw_path.alias("path")).distinct()
    return trace.trace(outputs, trace.parse_raw(raw, ["/raw/{YYMMDD}_{seq_num}_{part}.csv"]), how, by=("seq_num",))


_RAW_SQL = """WITH o AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS d, strftime(o_orderdate, '%Y') AS y, substr(o_orderpriority, 1, 1) AS p FROM orders),
     r AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS d, substr(o_orderpriority, 1, 1) AS p, '/raw/' || strftime(o_orderdate, '%y%m%d')
               || '_' || substr(o_orderpriority, 1, 1) || '_' || (o_custkey % 3) || '.csv' AS path FROM orders WHERE o_orderstatus <> 'P'),
     j AS (SELECT '/lake/1.0/enriched/' || o.y || '/' || o.d || '/' || o.d || '.' || o.p || '.orders.parq' AS output, r.path, o.d
           FROM o LEFT JOIN r ON o.d = r.d AND o.p = r.p)"""


@query("lineage_join", _RAW_SQL + " SELECT output, path, d FROM j")
def lineage_join(spark: SparkSession, sf: str) -> DataFrame:
    return _traced(spark, sf).select("output", "path", "d")


@query(
    "lineage_json",
    _RAW_SQL
    + """ SELECT output, '{"output":"' || output || '","raw_files_count":' || count(path) || ',"raw_files":['
          || coalesce(string_agg('{"path":"' || path || '","d":"' || d || '"}', ',' ORDER BY path), '') || ']}' AS report
          FROM j GROUP BY output""",
)
def lineage_json(spark: SparkSession, sf: str) -> DataFrame:
    return trace.report(_traced(spark, sf))


# -- backfill --------------------------------------------------------------------------


@query(
    "backfill_missing_dates",
    """SELECT strftime(c.d, '%Y%m%d') AS d
       FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d) c
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderdate = c.d AND o_orderstatus = 'F')""",
)
def backfill_missing_dates(spark: SparkSession, sf: str) -> DataFrame:
    published = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("d")
    )
    return backfill.pending(spark, "19950101", "20011231", published)


@query(
    "zip_members",
    """SELECT 'suppliers_' || (s_suppkey % 4) || '.zip' AS archive, 'nation_' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '.csv' AS member
       FROM supplier WHERE s_nationkey < 20 GROUP BY ALL""",
)
def zip_members(spark: SparkSession, sf: str) -> DataFrame:
    from rawlake.queries.reading import zipped_suppliers

    root = zipped_suppliers(spark, sf)
    template = PathTemplate(f"{root}/suppliers_{{part}}.zip|nation_([0-1][0-9]).csv", search_params={"part": "*"})
    found = inventory.discover(spark, template)
    return found.select(F.col("zfile_name").alias("archive"), F.col("member_name").alias("member"))


__all__ = ["base_name", "order_paths"]
