"""Scans: CSV dialects, conversions, codecs, archives, sections, Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.fixtures.staging import csv_line, stage_lines
from rawlake.plans.ingest import Job, ingest
from rawlake.queries import query
from rawlake.queries.staged import MONTHLY, ORDER_COLUMNS, ORDER_TYPES, config, month_path, monthly_orders, once, order_cells, table, text

_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
                        o_orderpriority FROM orders"""


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("scan_csv", _ORDERS_SQL)
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    root = monthly_orders(spark, sf)
    return _dates_as_text(ingest(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES), "t"))


@query("scan_csv_headers", _ORDERS_SQL)
def scan_csv_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Column order differs by month; columns are found by name."""

    def write(root: str) -> None:
        orders = table(spark, sf, "orders").withColumn("turn", F.month("o_orderdate") % 3)
        for turn in range(3):
            names = ORDER_COLUMNS[turn * 2 :] + ORDER_COLUMNS[: turn * 2]
            part = orders.where(F.col("turn") == turn)
            stage_lines(part, root, month_path(), csv_line(*order_cells(names)), [F.col("o_orderkey")], F.lit(",".join(names)))

    root = once(spark, sf, "orders-turned", write)
    return _dates_as_text(ingest(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES), "t"))


@query("scan_csv_skip_rows", _ORDERS_SQL)
def scan_csv_skip_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two lines before the header, a units line after it, blank lines inside."""

    def write(root: str) -> None:
        head = "# made by a vendor\n# do not edit\n" + ",".join(ORDER_COLUMNS) + "\nkey,key,flag,usd,day,level"
        line = csv_line(*order_cells())
        spaced = F.when(F.col("o_orderkey") % 7 == 0, F.concat(line, F.lit("\n"))).otherwise(line)
        stage_lines(table(spark, sf, "orders"), root, month_path(), spaced, [F.col("o_orderkey")], F.lit(head))

    root = once(spark, sf, "orders-preamble", write)
    options = {"read_options": {"skip_rows": 2, "skip_rows_after_names": 1}}
    return _dates_as_text(ingest(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, {"options": options}), "t"))


@query(
    "scan_csv_named",
    """SELECT c_custkey AS id, c_name AS label, c_acctbal AS amount, c_mktsegment AS f3 FROM customer""",
)
def scan_csv_named(spark: SparkSession, sf: str) -> DataFrame:
    """No header: names are given, or made up (``f0``, ``f1``, ...)."""

    def write(root: str) -> None:
        cells = csv_line(text("c_custkey"), text("c_name"), text("c_acctbal"), text("c_mktsegment"))
        path = F.concat(F.lit("part_"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit(".csv"))
        stage_lines(table(spark, sf, "customer"), root, path, cells, [F.col("c_custkey")])

    root = once(spark, sf, "customers", write)
    types = {"id": "int64", "label": "string", "amount": "double", "segment": "string"}
    named = ingest(
        spark, config([f"{root}/part_{{MM}}.csv"], types, {"options": {"read_options": {"column_names": list(types)}}}), "t"
    )
    made_up = {"f0": "int64", "f1": "string", "f2": "double", "f3": "string"}
    options = {"read_options": {"autogenerate_column_names": True}}
    auto = ingest(spark, config([f"{root}/part_{{MM}}.csv"], made_up, {"options": options}), "t")
    return named.join(auto.select(F.col("f0").alias("id"), "f3"), "id").drop("segment")


@query(
    "scan_csv_delim",
    """SELECT p_partkey, p_name || ';' || p_brand || '"' || p_type AS label, p_size, p_retailprice FROM part""",
)
def scan_csv_delim(spark: SparkSession, sf: str) -> DataFrame:
    """Semicolons, single quotes, a backslash as escape character."""

    def write(root: str) -> None:
        label = F.concat(F.lit("'"), F.col("p_name"), F.lit(";"), F.col("p_brand"), F.lit('"'), F.col("p_type"), F.lit("'"))
        line = F.concat_ws(";", text("p_partkey"), label, text("p_size"), text("p_retailprice"))
        path = F.concat(F.lit("parts_"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0"), F.lit(".txt"))
        stage_lines(table(spark, sf, "part"), root, path, line, [F.col("p_partkey")], F.lit("p_partkey;label;p_size;p_retailprice"))

    root = once(spark, sf, "parts", write)
    parse = {"delimiter": ";", "quote_char": "'", "double_quote": False, "escape_char": "\\"}
    types = {"p_partkey": "int64", "label": "string", "p_size": "int", "p_retailprice": "number"}
    return ingest(spark, config([f"{root}/parts_{{MM}}.txt"], types, {"options": {"parse_options": parse}}), "t")


@query(
    "scan_csv_newlines",
    """SELECT doc_id, md5(text) AS digest, length(text) AS chars, lang, n_chars FROM documents""",
)
def scan_csv_newlines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as quoted cells, line breaks and quotes inside."""

    def write(root: str) -> None:
        line = csv_line(text("doc_id"), F.col("text"), F.col("lang"), text("n_chars"))
        path = F.concat(F.lit("docs_"), F.lpad((F.col("doc_id") % 8 + 1).cast("string"), 2, "0"), F.lit(".csv"))
        stage_lines(table(spark, sf, "documents"), root, path, line, [F.col("doc_id")], F.lit("doc_id,text,lang,n_chars"))

    root = once(spark, sf, "documents", write)
    types = {"doc_id": "int64", "text": "string", "lang": "string", "n_chars": "int64"}
    options = {"parse_options": {"newlines_in_values": True}}
    docs = ingest(spark, config([f"{root}/docs_{{MM}}.csv"], types, {"options": options}), "t")
    return docs.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("chars"), "lang", "n_chars")


def _documents_behind_preamble(spark: SparkSession, sf: str, label: str, cell: Column, encoding: str, parse: dict) -> DataFrame:
    """Whole documents as quoted cells behind one line of preamble."""

    def write(root: str) -> None:
        path = F.concat(F.lit("docs_"), F.lpad((F.col("doc_id") % 8 + 1).cast("string"), 2, "0"), F.lit(".csv"))
        line = F.concat_ws(",", text("doc_id"), F.concat(F.lit('"'), cell, F.lit('"')))
        stage_lines(table(spark, sf, "documents"), root, path, line, [F.col("doc_id")], F.lit("made by hand\ndoc_id,text"), encoding=encoding)

    root = once(spark, sf, label, write)
    options = {"read_options": {"skip_rows": 1}, "parse_options": {"newlines_in_values": True, **parse}}
    types = {"doc_id": "int64", "text": "string"}
    docs = ingest(spark, config([f"{root}/docs_{{MM}}.csv"], types, {"options": options, "encoding": encoding}), "t")
    return docs.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("chars"))


@query("scan_csv_escaped", "SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM documents")
def scan_csv_escaped(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes behind a backslash do not end a cell, nor join records."""
    cell = F.replace("text", F.lit('"'), F.lit('\\"'))
    return _documents_behind_preamble(spark, sf, "documents-escaped", cell, "utf-8", {"escape_char": "\\", "double_quote": False})


@query("scan_utf16_lines", "SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM documents")
def scan_utf16_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line ends of two bytes."""
    cell = F.replace("text", F.lit('"'), F.lit('""'))
    return _documents_behind_preamble(spark, sf, "documents-utf16", cell, "utf-16-le", {})


@query(
    "optional_columns_lines",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice FROM orders""",
)
def optional_columns_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Two headers behind a preamble, with a trailer: what a file lacks is null."""

    def write(root: str) -> None:
        even = F.col("o_orderkey") % 2 == 0
        path = F.when(even, "orders_01.csv").otherwise("orders_02.csv")
        line = F.when(even, csv_line(text("o_orderkey"), F.col("o_orderpriority"), text("o_totalprice"))).otherwise(text("o_orderkey"))
        head = F.concat(F.lit("made by hand\n"), F.when(even, "o_orderkey,o_orderpriority,o_totalprice").otherwise("o_orderkey"))
        stage_lines(table(spark, sf, "orders"), root, path, line, [F.col("o_orderkey")], head, F.lit("end"))

    root = once(spark, sf, "orders-two-headers", write)
    types = {"o_orderkey": "int64", "o_orderpriority": "string", "o_totalprice": "double"}
    operations = {n: "source_optional" for n in ("o_orderpriority", "o_totalprice")}
    lines = {"options": {"read_options": {"skip_rows": 1}}, "skipfooter": 1}
    return ingest(spark, config([f"{root}/orders_{{MM}}.csv"], types, lines, operations=operations), "t")


@query(
    "scan_parquet_mixed",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey FROM orders",
)
def scan_parquet_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Files with their columns in another order, and without an optional one."""

    def write(root: str) -> None:
        orders, even = table(spark, sf, "orders"), F.col("o_orderkey") % 2 == 0
        orders.where(even).select("o_orderkey", "o_custkey", "o_totalprice").write.parquet(f"{root}/orders_20240101.parquet")
        orders.where(~even).select("o_totalprice", "o_orderkey").write.parquet(f"{root}/orders_20240102.parquet")

    root = once(spark, sf, "orders-mixed", write)
    types = {"o_orderkey": "int64", "o_totalprice": "double", "o_custkey": "int64"}
    settings = config([f"{root}/orders_{{YYYYMMDD}}.parquet/*.parquet"], types, {"format": "parquet"}, operations={"o_custkey": "source_optional"})
    return ingest(spark, settings, "t")


# -- conversion -------------------------------------------------------------------------


@query(
    "convert_nulls",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS custkey,
              CASE WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE o_orderstatus END AS kept,
              CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS dropped FROM orders""",
)
def convert_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Default null tokens leave text alone; with strings_can_be_null they do not."""

    def write(root: str) -> None:
        third = F.col("o_orderkey") % 3 == 0
        status = F.when(third, "NA").otherwise(F.col("o_orderstatus"))
        line = csv_line(
            text("o_orderkey"),
            F.when(third, "#N/A").otherwise(text("o_totalprice")),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(text("o_custkey")),
            status,
        )
        stage_lines(table(spark, sf, "orders"), root, month_path(), line, [F.col("o_orderkey")], F.lit("o_orderkey,price,custkey,status"))

    root = once(spark, sf, "orders-nulls", write)
    types = {"o_orderkey": "int64", "price": "double", "custkey": "int64", "status": "string"}
    kept = ingest(spark, config([f"{root}/{MONTHLY}"], types), "t")
    options = {"convert_options": {"strings_can_be_null": True}}
    dropped = ingest(spark, config([f"{root}/{MONTHLY}"], types, {"options": options}), "t")
    return kept.withColumnRenamed("status", "kept").join(
        dropped.select("o_orderkey", F.col("status").alias("dropped")), "o_orderkey"
    )


@query(
    "convert_bools",
    "SELECT doc_id, quality = 1 AS good, toxic = 1 AS toxic, toxic = 1 AS toxic_flag FROM labels",
)
def convert_bools(spark: SparkSession, sf: str) -> DataFrame:
    def write(root: str) -> None:
        flag = F.when(F.col("toxic") == 1, F.lit("yes")).otherwise("no")
        word = F.when(F.col("toxic") == 1, F.lit("True")).otherwise("FALSE")
        line = csv_line(text("doc_id"), text("quality"), word, flag)
        path = F.concat(F.lit("labels_"), F.lpad((F.col("doc_id") % 5 + 1).cast("string"), 2, "0"), F.lit(".csv"))
        stage_lines(table(spark, sf, "labels"), root, path, line, [F.col("doc_id")], F.lit("doc_id,good,toxic,toxic_flag"))

    root = once(spark, sf, "labels", write)
    types = {"doc_id": "int64", "good": "bool", "toxic": "bool", "toxic_flag": "string"}
    plain = ingest(spark, config([f"{root}/labels_{{MM}}.csv"], types), "t").drop("toxic_flag")
    options = {"convert_options": {"true_values": ["yes", "True", "1"], "false_values": ["no", "FALSE", "0"]}}
    types = {"doc_id": "int64", "good": "bool", "toxic": "bool", "toxic_flag": "bool"}
    custom = ingest(spark, config([f"{root}/labels_{{MM}}.csv"], types, {"options": options}), "t")
    return plain.join(custom.select("doc_id", "toxic_flag"), "doc_id")


@query(
    "convert_timestamps",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS vendor, strftime(ts, '%Y-%m-%d') AS compact,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS iso FROM events""",
)
def convert_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor format, the default compact date, and ISO text in one file."""

    def write(root: str) -> None:
        line = csv_line(
            text("event_id"), F.date_format("ts", "dd-MMM-yyyy HH:mm:ss"), F.date_format("ts", "yyyyMMdd"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        )
        stage_lines(
            table(spark, sf, "events"), root, month_path("orders", at="ts"), line, [F.col("event_id")], F.lit("event_id,vendor,compact,iso")
        )

    root = once(spark, sf, "events-times", write)
    types = {"event_id": "int64", "vendor": "timestamp[us]", "compact": "timestamp", "iso": "timestamp[us]"}
    options = {"convert_options": {"timestamp_parsers": ["%d-%b-%Y %H:%M:%S", "%Y%m%d", "ISO8601"]}}
    rows = ingest(spark, config([f"{root}/{MONTHLY}"], types, {"options": options}), "t")
    return rows.select(
        "event_id", F.date_format("vendor", "yyyy-MM-dd HH:mm:ss").alias("vendor"),
        F.date_format("compact", "yyyy-MM-dd").alias("compact"), F.date_format("iso", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("iso"),
    )


@query(
    "enforce_types",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
              strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_returnflag FROM lineitem""",
)
def enforce_types(spark: SparkSession, sf: str) -> DataFrame:
    """All of lineitem through the strict cell conversions."""
    return _lineitem_rows(ingest(spark, config([f"{lineitem_csv(spark, sf)}/{MONTHLY}"], LINEITEM_TYPES), "t"))


LINEITEM_TYPES = {
    "l_orderkey": "int64", "l_partkey": "int", "l_linenumber": "int64", "l_quantity": "real", "l_extendedprice": "decimal",
    "l_discount": "float64", "l_tax": "numeric", "l_shipdate": "date", "l_returnflag": "string",
}


def _lineitem_cells() -> list:
    return [F.date_format(c, "yyyy-MM-dd") if c == "l_shipdate" else text(c) for c in LINEITEM_TYPES]


def _lineitem_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def lineitem_csv(spark: SparkSession, sf: str) -> str:
    def write(root: str) -> None:
        order = [F.col(c) for c in _LINE_ORDER]
        head = F.lit(",".join(LINEITEM_TYPES))
        stage_lines(table(spark, sf, "lineitem"), root, month_path(at="l_shipdate"), csv_line(*_lineitem_cells()), order, head)

    return once(spark, sf, "lineitem-csv", write)


_LINEITEM_SQL = """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                          strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_returnflag FROM lineitem"""


# -- line-wise -----------------------------------------------------------------------------


def lineitem_pipe(spark: SparkSession, sf: str) -> str:
    def write(root: str) -> None:
        order = [F.col(c) for c in _LINE_ORDER]
        head = F.lit("!Vendor model file\n!Unit: USD\n" + "|".join(LINEITEM_TYPES))
        stage_lines(
            table(spark, sf, "lineitem"), root, month_path(at="l_shipdate"), csv_line(*_lineitem_cells(), sep="|"), order, head,
            F.lit("[End of File]"),
        )

    return once(spark, sf, "lineitem-pipe", write)


@query("scan_pipe_preset", _LINEITEM_SQL)
def scan_pipe_preset(spark: SparkSession, sf: str) -> DataFrame:
    root = lineitem_pipe(spark, sf)
    return _lineitem_rows(ingest(spark, config([f"{root}/{MONTHLY}"], LINEITEM_TYPES, {"format": "pipe"}), "t"))


@query("scan_skipfooter", _ORDERS_SQL)
def scan_skipfooter(spark: SparkSession, sf: str) -> DataFrame:
    def write(root: str) -> None:
        head, tail = F.lit(",".join(ORDER_COLUMNS)), F.lit("TOTAL,0,0,0,0,0\n-- generated\n-- end")
        stage_lines(table(spark, sf, "orders"), root, month_path(), csv_line(*order_cells()), [F.col("o_orderkey")], head, tail)

    root = once(spark, sf, "orders-footer", write)
    return _dates_as_text(ingest(spark, config([f"{root}/{MONTHLY}"], ORDER_TYPES, {"skipfooter": 3}), "t"))


SECTION_TYPES = {
    "sec_desc": "string", "rcode": "int64", "nfields": "int64", "PRICE": "double", "QTY": "double", "FLAG": "string",
    "PRICE_1": "double", "PRICE_2": "double",
}


def sectioned_lineitem(spark: SparkSession, sf: str) -> str:
    def write(root: str) -> None:
        key = F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"))
        empty = F.col("l_linenumber") == 3
        price = F.when(empty, "N.A.").otherwise(text("l_extendedprice"))
        flag = F.when(empty, "N.A.").otherwise(F.col("l_returnflag"))
        line = F.concat_ws("|", key, text("l_linenumber"), F.lit("5"), price, text("l_quantity"), flag, text("l_tax"), text("l_discount"), F.lit(""))
        head = (
            "START-OF-FILE\nRUNDATE=1\nSTART-OF-FIELDS\n# prices\nPRICE\n\nQTY\nFLAG\nPRICE\nPRICE\nEND-OF-FIELDS\nTIMESTARTED=1\nSTART-OF-DATA"
        )
        tail = "END-OF-DATA\nTIMEFINISHED=2\nEND-OF-FILE"
        order = [F.col(c) for c in _LINE_ORDER]
        stage_lines(table(spark, sf, "lineitem"), root, month_path(at="l_shipdate"), line, order, F.lit(head), F.lit(tail))

    return once(spark, sf, "lineitem-sections", write)


@query(
    "scan_sectioned",
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sec_desc,
              CAST(l_linenumber AS BIGINT) AS rcode, CAST(5 AS BIGINT) AS nfields,
              CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS price, l_quantity AS qty,
              CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS flag, l_tax AS price_1, l_discount AS price_2 FROM lineitem""",
)
def scan_sectioned(spark: SparkSession, sf: str) -> DataFrame:
    root = sectioned_lineitem(spark, sf)
    rows = ingest(spark, config([f"{root}/{MONTHLY}"], SECTION_TYPES, {"format": "sectioned"}), "t")
    return rows.select(*[F.col(c).alias(c.lower()) for c in SECTION_TYPES])


# -- codecs and archives ------------------------------------------------------------------------

SUPPLIER_TYPES = {"s_suppkey": "int64", "s_name": "string", "s_nationkey": "int64", "s_acctbal": "double"}
_SUPPLIER_SQL = "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier"


def _suppliers(spark: SparkSession, sf: str, label: str, path, codec: str | None = "suffix") -> str:
    def write(root: str) -> None:
        line = csv_line(*[text(c) for c in SUPPLIER_TYPES])
        head = F.lit(",".join(SUPPLIER_TYPES))
        stage_lines(table(spark, sf, "supplier"), root, path, line, [F.col("s_suppkey")], head, codec=codec)

    return once(spark, sf, label, write)


def _nation(suffix: str):
    return F.concat(F.lit("nation_"), F.lpad(text("s_nationkey"), 2, "0"), F.lit(suffix))


@query("scan_gz", _SUPPLIER_SQL + " UNION ALL " + _SUPPLIER_SQL + " UNION ALL " + _SUPPLIER_SQL)
def scan_gz(spark: SparkSession, sf: str) -> DataFrame:
    """gzip and bzip2 by suffix, and gzip behind a plain suffix."""
    gz = _suppliers(spark, sf, "suppliers-gz", _nation(".csv.gz"))
    bz = _suppliers(spark, sf, "suppliers-bz2", _nation(".csv.bz2"))
    hidden = _suppliers(spark, sf, "suppliers-hidden", _nation(".csv"), codec="gzip")
    raw = [f"{gz}/nation_{{DD}}.csv.gz", f"{bz}/nation_{{DD}}.csv.bz2", f"{hidden}/nation_{{DD}}.csv"]
    return ingest(spark, config(raw, SUPPLIER_TYPES), "t")


@query("scan_xz", _SUPPLIER_SQL)
def scan_xz(spark: SparkSession, sf: str) -> DataFrame:
    root = _suppliers(spark, sf, "suppliers-xz", _nation(".csv.xz"))
    return ingest(spark, config([f"{root}/nation_{{DD}}.csv.xz"], SUPPLIER_TYPES), "t")


def zipped_suppliers(spark: SparkSession, sf: str) -> str:
    archive = F.concat(F.lit("suppliers_"), (F.col("s_suppkey") % 4).cast("string"), F.lit(".zip|nation_"), F.lpad(text("s_nationkey"), 2, "0"), F.lit(".csv"))
    return _suppliers(spark, sf, "suppliers-zip", archive)


@query(
    "scan_zip",
    """SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal,
              'suppliers_' || (s_suppkey % 4) || '.zip|nation_' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '.csv' AS _source_file,
              row_number() OVER (PARTITION BY s_suppkey % 4, s_nationkey ORDER BY s_suppkey) - 1 AS _index
       FROM supplier""",
)
def scan_zip(spark: SparkSession, sf: str) -> DataFrame:
    root = zipped_suppliers(spark, sf)
    raw = [f"{root}/suppliers_?.zip|nation_([0-9][0-9]).csv"]
    settings = config(raw, SUPPLIER_TYPES, metadata={"knowledge_time": {"from": "file_mtime"}})
    return Job(spark, settings, "t").rows().select(*SUPPLIER_TYPES, "_source_file", "_index")


@query("scan_encoding", "SELECT doc_id, lang, md5(word) AS digest FROM (SELECT doc_id, lang, regexp_replace(text, '[^\\x01-\\xFF]', '', 'g') AS word FROM documents)")
def scan_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts, but for characters that Latin-1 lacks, by the CSV source and behind a preamble."""
    letters = r"[^\x01-\xFF]"
    parse = {"newlines_in_values": True}

    def write(root: str) -> None:
        word = F.regexp_replace("text", letters, "")
        path = F.concat(F.lit("words_"), F.lpad((F.col("doc_id") % 6 + 1).cast("string"), 2, "0"), F.lit(".csv"))
        line = csv_line(text("doc_id"), F.col("lang"), word)
        stage_lines(table(spark, sf, "documents"), root, path, line, [F.col("doc_id")], F.lit("doc_id,lang,word"), encoding="latin-1")

    root = once(spark, sf, "documents-latin1", write)
    types = {"doc_id": "int64", "lang": "string", "word": "string"}
    native = config([f"{root}/words_0[1-3].csv"], types, {"encoding": "ISO-8859-1", "options": {"parse_options": parse}})
    options = {"read_options": {"skip_rows": 1, "column_names": list(types)}, "parse_options": parse}
    by_line = config([f"{root}/words_0[4-6].csv"], types, {"encoding": "ISO-8859-1", "options": options})
    rows = ingest(spark, native, "t").unionByName(ingest(spark, by_line, "t"))
    return rows.select("doc_id", "lang", F.md5("word").alias("digest"))


@query("scan_parquet", "SELECT vec_id, CAST(label AS BIGINT) AS label, len(embedding) AS size, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings")
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    types = {"vec_id": "int64", "embedding": "list<double>", "label": "int64"}
    rows = ingest(spark, config([f"{sf}/embeddings.parquet"], types, {"format": "parquet"}), "t")
    return rows.select("vec_id", "label", F.size("embedding").alias("size"), F.get("embedding", F.lit(0)).alias("first"))


@query(
    "filter_pushdown",
    """SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem
       WHERE (l_quantity >= 25 AND l_returnflag IN ('A', 'N')) OR (l_partkey < 50 AND l_returnflag <> 'N')""",
)
def filter_pushdown(spark: SparkSession, sf: str) -> DataFrame:
    types = {
        "l_orderkey": "int64", "l_partkey": "int64", "l_suppkey": "int64", "l_linenumber": "int64", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
        "l_linestatus": "string", "l_shipdate": "timestamp",
    }
    filters = [
        [["l_quantity", ">=", 25.0], ["l_returnflag", "in", ["A", "N"]]],
        [["l_partkey", "<", 50], ["l_returnflag", "!=", "N"]],
    ]
    settings = config([f"{sf}/lineitem.parquet"], types, {"format": "parquet", "filters": filters, "extra": "drop"})
    return ingest(spark, settings, "t").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")


@query(
    "filter_pushdown_numbered",
    """WITH l AS (SELECT *, row_number() OVER () - 1 AS r FROM (SELECT * FROM lineitem))
       SELECT l_orderkey, l_linenumber, r AS _index, true AS pushed FROM l
       WHERE l_quantity >= 45 AND l_returnflag IN ('A', 'R')""",
)
def filter_pushdown_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """Rows keep their number in the file although the reader itself leaves out what the filters do not want."""
    types = {"l_orderkey": "int64", "l_linenumber": "int64", "l_quantity": "double", "l_returnflag": "string"}
    filters = [["l_quantity", ">=", 45.0], ["l_returnflag", "in", ["A", "R"]]]
    settings = config([f"{sf}/lineitem.parquet"], types, {"format": "parquet", "filters": filters, "extra": "drop"}, metadata={"knowledge_time": {"from": "file_mtime"}})
    rows = ingest(spark, settings, "t")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = "GreaterThanOrEqual(l_quantity,45.0)" in plan and "In(l_returnflag, [A,R])" in plan
    return rows.select("l_orderkey", "l_linenumber", "_index", F.lit(pushed).alias("pushed"))
