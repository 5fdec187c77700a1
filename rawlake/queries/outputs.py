"""Sinks, modes, backfill, incremental ingest and custom stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.fixtures.staging import csv_line, stage_lines
from rawlake.functions.registry import build
from rawlake.operators import sink
from rawlake.operators.backfill import backfill, pending
from rawlake.plans.ingest import Job
from rawlake.queries import query
from rawlake.queries.shaping import RUN
from rawlake.queries.staged import MONTHLY, ORDER_TYPES, config, month_path, monthly_orders, once, table, text
from rawlake.session import work_path
from rawlake.streaming import incremental

EVENT_TYPES = {"event_id": "int64", "user_id": "int64", "event_type": "string", "value": "double", "ts": "timestamp[us]"}
EVENTS_INPUT = {"options": {"convert_options": {"timestamp_parsers": ["ISO8601"]}}}
DAILY = "{YYYY}/{MM}/events_{YYYYMMDD}.csv"


def daily_events(spark: SparkSession, sf: str) -> str:
    def write(root: str) -> None:
        path = F.concat(F.date_format("ts", "yyyy/MM/"), F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv"))
        line = csv_line(
            text("event_id"), text("user_id"), F.col("event_type"), text("value"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        )
        head = F.lit(",".join(EVENT_TYPES))
        stage_lines(table(spark, sf, "events"), root, path, line, [F.col("event_id")], head)

    return once(spark, sf, "events-daily", write)


def _job(spark: SparkSession, sf: str, template: str, aggregate: bool = False, label: str = "lake", **kwargs) -> Job:
    settings = config(
        [f"{daily_events(spark, sf)}/{DAILY}"], EVENT_TYPES, EVENTS_INPUT, metadata={}, aggregate=aggregate,
        basedir=work_path(spark, label), file_template=template,
    )
    return Job(spark, settings, "t", creation_time=RUN, **kwargs)


_COLUMNS = ["event_id", "user_id", "event_type", "value", "_source_file", "_index"]
_EVENTS_SQL = """SELECT event_id, user_id, event_type, value, 'events_' || strftime(ts, '%Y%m%d') || '.csv' AS _source_file,
                        row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY event_id) - 1 AS _index{more} FROM events{where}"""


@query("write_parquet", _EVENTS_SQL.format(more=", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts", where=""))
def write_parquet(spark: SparkSession, sf: str) -> DataFrame:
    rows = _job(spark, sf, "{table}").rows()
    target = f"{work_path(spark, 'written')}/events.parq"
    sink.write_parquet(rows, target)
    sink.write_parquet(rows, target)  # a rerun replaces the result
    back = spark.read.parquet(target)
    return back.select(*_COLUMNS, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("per_file_mode", _EVENTS_SQL.format(more=", strftime(ts, '%Y/%Y%m%d') || '/events_' || strftime(ts, '%Y%m%d') || '.t.parq' AS output", where=""))
def per_file_mode(spark: SparkSession, sf: str) -> DataFrame:
    job = _job(spark, sf, "{YYYY}/{YYYYMMDD}/{file_name}.{table}.parq")
    job.write()
    return _read_outputs(spark, job.basedir, "/*/*/*.parq").select(*_COLUMNS, "output")


def _read_outputs(spark: SparkSession, basedir: str, pattern: str) -> DataFrame:
    back = spark.read.option("recursiveFileLookup", "true").parquet(basedir + pattern)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return back.withColumn("output", F.replace(folder, F.lit(basedir + "/"), F.lit("")))


@query(
    "aggregate_mode",
    """SELECT event_id, user_id, event_type, value, 'events_' || strftime(ts, '%Y%m%d') || '.csv' AS _source_file,
              row_number() OVER (ORDER BY strftime(ts, '%Y%m%d'), event_id) - 1 AS _index, 'all.t.parq' AS output FROM events""",
)
def aggregate_mode(spark: SparkSession, sf: str) -> DataFrame:
    job = _job(spark, sf, "all.{table}.parq", aggregate=True)
    job.write()
    return _read_outputs(spark, job.basedir, "/*.parq").select(*_COLUMNS, "output")


_LINE = "o_orderkey || ',' || o_custkey || ',' || o_orderpriority || chr(10)"


@query(
    "checksum",
    f"""SELECT strftime(o_orderdate, '%Y%m') || '.txt' AS name, CAST(sum(length({_LINE})) AS BIGINT) AS size, md5(string_agg({_LINE}, '' ORDER BY o_orderkey)) AS md5
        FROM orders GROUP BY name""",
)
def checksum(spark: SparkSession, sf: str) -> DataFrame:
    def write(root: str) -> None:
        path = F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit(".txt"))
        line = F.concat_ws(",", text("o_orderkey"), text("o_custkey"), "o_orderpriority")
        stage_lines(table(spark, sf, "orders"), root, path, line, [F.col("o_orderkey")])

    root = once(spark, sf, "orders-text", write)
    found = sink.checksums(spark, [root], r"\.txt$")
    return found.select(F.substring_index("path", "/", -1).alias("name"), "size", "md5")


@query("checksum_sidecar", "SELECT DISTINCT strftime(ts, '%Y%m%d') || '.t.parq' AS output, true AS sound FROM events")
def checksum_sidecar(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of checksums against digests of the part files as they lie there."""
    job = _job(spark, sf, "{YYYYMMDD}.{table}.parq")
    job.write()
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{job.basedir}/*.parq")
    path = F.regexp_replace("path", "^file:/+", "/")
    actual = parts.select(
        F.regexp_replace(path, "/[^/]*$", "").alias("output"), F.substring_index(path, "/", -1).alias("name"), F.md5("content").alias("md5")
    )
    told = sink.read_checksums(actual.select("output").distinct()).withColumn("told", F.lit(True))
    both = actual.join(told, ["output", "name", "md5"], "full").groupBy("output").agg(F.bool_and(F.coalesce("told", F.lit(False))).alias("sound"))
    return both.select(F.substring_index("output", "/", -1).alias("output"), "sound")


@query(
    "output_path",
    """SELECT o_orderkey, '1.0/enriched/' || strftime(o_orderdate, '%Y') || '/' || strftime(o_orderdate, '%Y%m') || '01.t.orders_'
              || strftime(o_orderdate, '%Y%m') || '01.orders.parq' AS output, 't_' || strftime(o_orderdate, '%Y%m') || '01.parq' AS overridden FROM orders""",
)
def output_path(spark: SparkSession, sf: str) -> DataFrame:
    template = "1.0/enriched/{YYYY}/{YYYYMMDD}.{table}.{file_name}.{kind}.parq"
    settings = config(
        ["/raw/{YYYY}/{MM}/([a-z]*)_{YYYYMMDD}.csv"], ORDER_TYPES, basedir="/lake", file_template=template,
        extract_vars={"kind": {"regex_group": 1}},
    )
    path = F.concat(F.lit("/raw/"), month_path())
    job, other = Job(spark, settings, "t"), Job(spark, settings, "t", basedir="/elsewhere")
    return table(spark, sf, "orders").select(
        "o_orderkey", job.output_path(path, job.templates[0]).alias("output"), other.output_path(path, other.templates[0]).alias("overridden")
    )


@query("run_stats", "SELECT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS _source_file, count(*) AS rows FROM orders GROUP BY 1")
def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    return sink.run_stats(Job(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, metadata={}), "t").rows())


@query(
    "backfill_range",
    _EVENTS_SQL.format(more=", strftime(ts, '%Y%m%d') AS output", where=" WHERE ts >= TIMESTAMP '2023-12-30' AND ts < TIMESTAMP '2024-01-21'"),
)
def backfill_range(spark: SparkSession, sf: str) -> DataFrame:
    """Days before the first file of the range are skipped, all others are
    done by one job."""
    job = _job(spark, sf, "{YYYYMMDD}")
    backfill(job, "20231230", "20240120")
    return _read_outputs(spark, job.basedir, "/[0-9]*").select(*_COLUMNS, "output")


@query(
    "backfill_bad_date",
    """WITH e AS (SELECT strftime(ts, '%Y%m%d') AS d, event_id, value FROM events),
             b AS (SELECT d, row_number() OVER (PARTITION BY d ORDER BY event_id) - 1 AS r, event_id FROM e),
             w AS (SELECT strftime(x, '%Y%m%d') AS d FROM range(DATE '2024-01-02', DATE '2024-01-22', INTERVAL 1 DAY) t(x)),
             p AS (SELECT d, count(*) AS rows, sum(event_id) AS ids FROM e WHERE d IN (SELECT d FROM w) AND d NOT IN ('20240105', '20240111', '20240117') GROUP BY d)
        SELECT d, 'published' AS state, CAST(NULL AS BIGINT) AS row, CAST(NULL AS VARCHAR) AS "column", rows, CAST(ids AS BIGINT) AS ids FROM p
        UNION ALL SELECT d, 'pending', NULL, NULL, NULL, NULL FROM w WHERE d NOT IN (SELECT d FROM p)
        UNION ALL SELECT '20240105', 'error', r, 'value', NULL, NULL FROM b WHERE d = '20240105' AND event_id % 7 = 0
        UNION ALL SELECT '20240111', 'error', r, NULL, NULL, NULL FROM b WHERE d = '20240111' AND event_id % 7 = 0
        UNION ALL SELECT '20240117', 'error', NULL, NULL, NULL, NULL WHERE EXISTS (SELECT 1 FROM b WHERE d = '20240117')""",
)
def backfill_bad_date(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed files among many: all others are published, those are named, with row and column, and stay pending."""

    def write(root: str) -> None:
        events, day = table(spark, sf, "events"), F.date_format("ts", "yyyyMMdd")
        odd = F.col("event_id") % 7 == 0
        value = F.when(odd & (day == "20240105"), "oops").otherwise(text("value"))
        cells = [text("event_id"), text("user_id"), F.col("event_type")]
        time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        short = F.when(odd & (day == "20240111"), csv_line(*cells)).otherwise(csv_line(*cells, value, time))
        line = F.when(day == "20240117", csv_line(*cells, time)).otherwise(short)
        names = list(EVENT_TYPES)
        head = F.when(day == "20240117", ",".join(n for n in names if n != "value")).otherwise(",".join(names))
        path = F.concat(F.date_format("ts", "yyyy/MM/"), F.lit("events_"), day, F.lit(".csv"))
        stage_lines(events, root, path, line, [F.col("event_id")], head)

    root = once(spark, sf, "events-malformed", write)
    settings = config(
        [f"{root}/{DAILY}"], EVENT_TYPES, EVENTS_INPUT, metadata={}, basedir=work_path(spark, "lake"), file_template="{YYYYMMDD}"
    )
    job = Job(spark, settings, "t", creation_time=RUN)
    done = backfill(job, "20240102", "20240121")
    outputs = _read_outputs(spark, job.basedir, "/[0-9]*").withColumnRenamed("output", "d")
    nothing = {c: F.lit(None).cast(t) for c, t in (("row", "bigint"), ("column", "string"), ("rows", "bigint"), ("ids", "bigint"))}
    order = ["d", "state", "row", "column", "rows", "ids"]
    published = outputs.groupBy("d").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).withColumn("state", F.lit("published"))
    left = pending(spark, "20240102", "20240121", outputs).withColumn("state", F.lit("pending"))
    errors = done["errors"].select(F.col("target").alias("d"), F.lit("error").alias("state"), "row", "column")
    parts = [df.withColumns({c: v for c, v in nothing.items() if c not in df.columns}).select(*order) for df in (published, left, errors)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("incremental_ingest", _EVENTS_SQL.format(more="", where=""))
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Files in several micro-batches; a second run finds nothing new."""
    job = _job(spark, sf, "{table}")
    target, state = work_path(spark, "stream-target"), work_path(spark, "stream-state")
    for _ in range(2):
        incremental.start(job, target, state, max_files=20).awaitTermination()
    return incremental.read_target(job, target).select(*_COLUMNS)


@query(
    "incremental_templates",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 'even_' ELSE 'odd_' END || strftime(o_orderdate, '%Y%m') || '01.csv' AS _source_file,
              row_number() OVER (PARTITION BY o_orderkey % 2, strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) - 1 AS _index FROM orders""",
)
def incremental_templates(spark: SparkSession, sf: str) -> DataFrame:
    """Two templates of a table, each with its own stream, into one target."""

    def write(root: str) -> None:
        name = F.when(F.col("o_orderkey") % 2 == 0, "even_").otherwise("odd_")
        path = F.concat(name, F.date_format("o_orderdate", "yyyyMM01"), F.lit(".csv"))
        line = csv_line(text("o_orderkey"), text("o_totalprice"))
        stage_lines(table(spark, sf, "orders"), root, path, line, [F.col("o_orderkey")], F.lit("o_orderkey,o_totalprice"))

    root = once(spark, sf, "orders-parity", write)
    types = {"o_orderkey": "int64", "o_totalprice": "double"}
    job = Job(spark, config([f"{root}/{n}_{{YYYYMMDD}}.csv" for n in ("even", "odd")], types, metadata={}), "t", creation_time=RUN)
    target = work_path(spark, "stream-target")
    for i in range(2):
        incremental.start(job, target, work_path(spark, "stream-state"), i).awaitTermination()
    return incremental.read_target(job, target).select(*types, "_source_file", "_index")


@query(
    "per_file_empty",
    """SELECT strftime(o_orderdate, '%Y%m') || '01.t.parq' AS output, count(*) FILTER (month(o_orderdate) % 4 <> 0) AS rows FROM orders GROUP BY 1""",
)
def per_file_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Every file has an output, also those with a header and blank lines only."""

    def write(root: str) -> None:
        line = F.when(F.month("o_orderdate") % 4 == 0, "").otherwise(csv_line(text("o_orderkey"), text("o_totalprice")))
        stage_lines(table(spark, sf, "orders"), root, month_path(), line, [F.col("o_orderkey")], F.lit("o_orderkey,o_totalprice"))

    root = once(spark, sf, "orders-gaps", write)
    types = {"o_orderkey": "int64", "o_totalprice": "double"}
    job = Job(spark, config([f"{root}/{MONTHLY}"], types, basedir=work_path(spark, "lake"), file_template="{YYYYMMDD}.{table}.parq"), "t")
    outputs = [(path.rsplit("/", 1)[1],) for path in job.write()["outputs"]]
    counts = _read_outputs(spark, job.basedir, "/*.parq").groupBy("output").agg(F.count(F.lit(1)).alias("rows"))
    return spark.createDataFrame(outputs, "output string").join(counts, "output", "left").select("output", F.coalesce("rows", F.lit(0)).alias("rows"))


@query(
    "custom_transform",
    """SELECT event_id, value * 2 AS value, upper(event_type) AS event_type, _index FROM (
         SELECT *, row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY event_id) - 1 AS _index FROM events)
       WHERE event_type <> 'error'""",
)
def custom_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Stages of one's own: any DataFrame function; rows keep their number."""

    def keep(df: DataFrame) -> DataFrame:
        return df.where(F.col("event_type") != "error")

    def double(df: DataFrame) -> DataFrame:
        return df.withColumns({"value": F.col("value") * 2, "event_type": build("utf8_upper", F.col("event_type"), df.schema["event_type"].dataType)})

    rows = _job(spark, sf, "{table}", transforms=[keep, double]).rows()
    return rows.select("event_id", "value", "event_type", "_index")
