"""The named column functions over whole tables, one family per query.

Transcendental results are rounded, as math libraries differ in the last bit.
"""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.functions import ordered
from rawlake.functions.registry import apply_function, apply_functions, build
from rawlake.plans.ingest import Job
from rawlake.queries import query
from rawlake.queries.outputs import DAILY, EVENT_TYPES, EVENTS_INPUT, daily_events
from rawlake.queries.staged import config, table


class Calls:
    """Collects function calls as output columns of one projection."""

    def __init__(self, df: DataFrame, *keys: str) -> None:
        self.df, self.columns = df, [F.col(k) for k in keys]

    def add(self, name: str, fn: str, column: str | Column, *args: Any, wrap=None, **kwargs: Any) -> Calls:
        value = F.col(column) if isinstance(column, str) else column
        dtype = self.df.select(value.alias("v")).schema["v"].dataType
        result = build(fn, value, dtype, *args, **kwargs)
        self.columns.append((wrap(result) if wrap else result).alias(name))
        return self

    def select(self) -> DataFrame:
        return self.df.select(*self.columns)


def rounded(value: Column) -> Column:
    return F.rint(value * 1e6) / 1e6


def bigint(value: Column) -> Column:
    return value.cast("bigint")


def joined(value: Column) -> Column:
    return F.array_join(value, "|")


def stamp(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")


_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 2.5 AS added, l_quantity - 30 AS less, l_extendedprice * 2 AS twice,
       l_extendedprice / 4 AS quarter, CAST(trunc((l_partkey - 100) / 7.0) AS BIGINT) AS whole, abs(l_partkey - 100) AS absolute, -l_quantity AS negated,
       CAST(sign(l_partkey - 100) AS BIGINT) AS signum, l_linenumber * l_linenumber * CAST(l_linenumber AS BIGINT) AS cubed, round(pow(l_quantity, 1.5), 6) AS powered,
       round(sqrt(l_extendedprice), 6) AS root, round(exp(l_discount), 6) AS ex, round(exp(l_tax) - 1, 6) AS exm, round(ln(l_quantity), 6) AS loge,
       round(log10(l_quantity), 6) AS log_ten, round(log2(l_quantity), 6) AS log_two, round(ln(1 + l_tax), 6) AS log_one, round(ln(l_quantity) / ln(3), 6) AS log_three,
       round(sin(l_quantity), 6) AS s, round(cos(l_quantity), 6) AS c, round(tan(l_quantity), 6) AS t, round(asin(l_discount), 6) AS arc_s, round(acos(l_discount), 6) AS arc_c,
       round(atan(l_quantity), 6) AS arc_t, round(atan2(l_quantity, 2), 6) AS arc_t2, round(sinh(l_tax), 6) AS hs, round(cosh(l_tax), 6) AS hc, round(tanh(l_tax), 6) AS ht,
       round(asinh(l_tax), 6) AS ahs, round(acosh(l_quantity), 6) AS ahc, round(atanh(l_discount), 6) AS aht,
       ceil(l_extendedprice) AS up, floor(l_extendedprice) AS down, trunc(l_quantity - 25.5) AS cut,
       round_even(l_extendedprice * 10, 0) / 10 AS one_digit, round_even(l_extendedprice / 100, 0) * 100 AS hundreds, floor(l_extendedprice * 10) / 10 AS one_down,
       round_even(l_extendedprice / 0.5, 0) * 0.5 AS halves,
       l_partkey & 12 AS b_and, l_partkey | 12 AS b_or, xor(l_partkey, 12) AS b_xor, ~l_partkey AS b_not, l_partkey << 3 AS shifted_l, l_partkey >> 2 AS shifted_r,
       greatest(l_quantity, 25.0) AS most, least(l_quantity, 25.0) AS least_of FROM lineitem""",
)
def fn_math(spark: SparkSession, sf: str) -> DataFrame:
    calls = Calls(table(spark, sf, "lineitem"), *_KEY)
    centered = F.col("l_partkey") - 100
    calls.add("added", "add", "l_quantity", 2.5).add("less", "subtract_checked", "l_quantity", 30)
    calls.add("twice", "multiply", "l_extendedprice", 2).add("quarter", "divide", "l_extendedprice", 4.0)
    calls.add("whole", "divide", centered, 7).add("absolute", "abs", centered).add("negated", "negate", "l_quantity")
    calls.add("signum", "sign", centered).add("cubed", "power", "l_linenumber", 3).add("powered", "power", "l_quantity", 1.5, wrap=rounded)
    for name, fn, column in [
        ("root", "sqrt", "l_extendedprice"), ("ex", "exp", "l_discount"), ("exm", "expm1", "l_tax"), ("loge", "ln", "l_quantity"),
        ("log_ten", "log10", "l_quantity"), ("log_two", "log2_checked", "l_quantity"), ("log_one", "log1p", "l_tax"),
        ("s", "sin", "l_quantity"), ("c", "cos", "l_quantity"), ("t", "tan", "l_quantity"), ("arc_s", "asin", "l_discount"),
        ("arc_c", "acos", "l_discount"), ("arc_t", "atan", "l_quantity"), ("hs", "sinh", "l_tax"), ("hc", "cosh", "l_tax"),
        ("ht", "tanh", "l_tax"), ("ahs", "asinh", "l_tax"), ("ahc", "acosh", "l_quantity"), ("aht", "atanh", "l_discount"),
    ]:
        calls.add(name, fn, column, wrap=rounded)
    calls.add("log_three", "logb", "l_quantity", 3.0, wrap=rounded).add("arc_t2", "atan2", "l_quantity", 2.0, wrap=rounded)
    calls.add("up", "ceil", "l_extendedprice").add("down", "floor", "l_extendedprice").add("cut", "trunc", F.col("l_quantity") - 25.5)
    calls.add("one_digit", "round", "l_extendedprice", ndigits=1).add("hundreds", "round", "l_extendedprice", ndigits=-2)
    calls.add("one_down", "round", "l_extendedprice", ndigits=1, round_mode="down")
    calls.add("halves", "round_to_multiple", "l_extendedprice", multiple=0.5)
    calls.add("b_and", "bit_wise_and", "l_partkey", 12).add("b_or", "bit_wise_or", "l_partkey", 12).add("b_xor", "bit_wise_xor", "l_partkey", 12)
    calls.add("b_not", "bit_wise_not", "l_partkey").add("shifted_l", "shift_left", "l_partkey", 3).add("shifted_r", "shift_right", "l_partkey", 2)
    return calls.add("most", "max_element_wise", "l_quantity", 25.0).add("least_of", "min_element_wise", "l_quantity", 25.0).select()


@query(
    "fn_logic",
    """SELECT o_orderkey, o_orderstatus = 'F' AS eq, o_orderstatus <> 'F' AS ne, o_totalprice < 1e5 AS lt, o_custkey <= 100 AS le, o_totalprice > 2e5 AS gt,
       o_custkey >= 50 AS ge, f AND NULL AS and_null, f OR NULL AS or_null, CASE WHEN f IS NULL THEN NULL ELSE f AND true END AS strict_and,
       CASE WHEN f IS NULL THEN NULL ELSE f OR true END AS strict_or, f AND NOT false AS kleene_not, f IS DISTINCT FROM true AND f IS NOT NULL AS exclusive,
       NOT f AS inverted, f IS NULL AS missing, f IS NOT NULL AS valid, CASE WHEN f IS NOT NULL THEN true END AS unless_null, coalesce(f, true) AS filled,
       CASE WHEN f THEN 'yes' WHEN NOT f THEN 'no' END AS chosen, CASE o_custkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 20 ELSE 30 END AS picked,
       false AS nan, true AS finite, false AS infinite, coalesce(o_orderstatus IN ('F', 'P'), false) AS member,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS place
       FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS f FROM orders)""".replace(
        "f IS DISTINCT FROM true AND f IS NOT NULL AS exclusive", "CASE WHEN f IS NOT NULL THEN NOT f END AS exclusive"
    ),
)
def fn_logic(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    df = table(spark, sf, "orders").withColumn("f", F.when(status == "F", True).when(status == "O", False))
    calls = Calls(df, "o_orderkey")
    calls.add("eq", "equal", "o_orderstatus", "F").add("ne", "not_equal", "o_orderstatus", "F").add("lt", "less", "o_totalprice", 1e5)
    calls.add("le", "less_equal", "o_custkey", 100).add("gt", "greater", "o_totalprice", 2e5).add("ge", "greater_equal", "o_custkey", 50)
    calls.add("and_null", "and_kleene", "f", None).add("or_null", "or_kleene", "f", None).add("strict_and", "and_", "f", True)
    calls.add("strict_or", "or_", "f", True).add("kleene_not", "and_not_kleene", "f", False).add("exclusive", "xor", "f", True)
    calls.add("inverted", "invert", "f").add("missing", "is_null", "f").add("valid", "is_valid", "f").add("unless_null", "true_unless_null", "f")
    calls.add("filled", "fill_null", "f", True).add("chosen", "if_else", "f", "yes", "no")
    calls.add("picked", "choose", F.col("o_custkey") % 3, 10, 20, 30)
    calls.add("nan", "is_nan", "o_totalprice").add("finite", "is_finite", "o_totalprice").add("infinite", "is_inf", "o_totalprice")
    return calls.add("member", "is_in", "o_orderstatus", ["F", "P"]).add("place", "index_in", "o_orderstatus", ["F", "P"]).select()


@query(
    "fn_string",
    """SELECT conv_id, turn, role, md5(upper(replace(text, 'ß', 'ẞ'))) AS upped, md5(lower(text)) AS lowered, md5(reverse(text)) AS reversed,
       upper(substr(role, 1, 1)) || lower(substr(role, 2)) AS capital, role || role AS doubled,
       CASE WHEN length(role) < 12 THEN lpad(role, 12, '*') ELSE role END AS padded, CASE WHEN length(role) < 12 THEN rpad(role, 12, '.') ELSE role END AS tail_padded,
       lpad(CAST(turn AS VARCHAR), CAST(greatest(4, length(CAST(turn AS VARCHAR))) AS INTEGER), '0') AS zeros, md5(trim(text, 'aeiou ')) AS trimmed, md5(ltrim(text, 'abcE')) AS left_trimmed,
       md5(rtrim(text, '.?! ')) AS right_trimmed, substr(text, 3, 8) AS sliced, right(text, 5) AS last_five, substr(text, 1, 2) || '##' || substr(text, 6) AS spliced,
       md5(replace(text, 'an', '<AN>')) AS replaced, md5(regexp_replace(text, '([a-e])([f-z])', '\\2\\1', 'g')) AS swapped,
       role || '-' || turn || '-x' AS joined, md5(regexp_replace(text, 'e', 'E')) AS first_only FROM conversations""",
)
def fn_string(spark: SparkSession, sf: str) -> DataFrame:
    calls = Calls(table(spark, sf, "conversations"), "conv_id", "turn", "role")
    calls.add("upped", "utf8_upper", "text", wrap=F.md5).add("lowered", "utf8_lower", "text", wrap=F.md5).add("reversed", "utf8_reverse", "text", wrap=F.md5)
    calls.add("capital", "utf8_capitalize", "role").add("doubled", "binary_repeat", "role", 2).add("padded", "utf8_lpad", "role", 12, "*")
    calls.add("tail_padded", "utf8_rpad", "role", 12, ".").add("zeros", "utf8_zero_fill", F.col("turn").cast("string"), 4)
    calls.add("trimmed", "utf8_trim", "text", "aeiou ", wrap=F.md5).add("left_trimmed", "utf8_ltrim", "text", "abcE", wrap=F.md5)
    calls.add("right_trimmed", "utf8_rtrim", "text", ".?! ", wrap=F.md5).add("sliced", "utf8_slice_codeunits", "text", 2, 10)
    calls.add("last_five", "utf8_slice_codeunits", "text", -5).add("spliced", "utf8_replace_slice", "text", 2, 5, "##")
    calls.add("replaced", "replace_substring", "text", "an", "<AN>", wrap=F.md5)
    calls.add("swapped", "replace_substring_regex", "text", "([a-e])([f-z])", r"\2\1", wrap=F.md5)
    turn = F.concat_ws("-", "role", F.col("turn").cast("string"))
    calls.add("joined", "binary_join_element_wise", turn, "x", "-")
    return calls.add("first_only", "replace_substring_regex", "text", "e", "E", max_replacements=1, wrap=F.md5).select()


@query(
    "fn_string_search",
    """SELECT conv_id, turn, role, length(text) AS chars, strlen(text) AS bytes, starts_with(text, 'E') AS starts, suffix(text, '.') AS ends, contains(text, 'an') AS has,
       contains(lower(text), 'an') AS has_any, regexp_matches(text, '[0-9]{2,}') AS digits, text LIKE '%e_t%' AS liked, text ILIKE 'E%' AS iliked,
       (length(text) - length(replace(text, 'en', ''))) // 2 AS counted, len(regexp_extract_all(text, '[aeiou]{2}')) AS vowels,
       CASE WHEN strpos(text, 'é') = 0 THEN -1 ELSE strlen(substr(text, 1, strpos(text, 'é') - 1)) END AS found,
       CASE WHEN regexp_matches(text, '[a-z]+ [a-z]+') THEN regexp_extract(text, '([a-z]+) ([a-z]+)', 1) END AS first_word,
       CASE WHEN regexp_matches(text, '[a-z]+ [a-z]+') THEN regexp_extract(text, '([a-z]+) ([a-z]+)', 2) END AS second_word,
       md5(array_to_string(string_split(text, ' '), '|')) AS words, len(string_split(text, 'e')) AS pieces,
       regexp_matches(role, '^[a-zA-Z0-9]+$') AS alnum, regexp_matches(role, '^[a-z]+$') AS low, regexp_matches(text, '^[\\x00-\\x7F]*$') AS plain FROM conversations""",
)
def fn_string_search(spark: SparkSession, sf: str) -> DataFrame:
    calls = Calls(table(spark, sf, "conversations"), "conv_id", "turn", "role")
    calls.add("chars", "utf8_length", "text", wrap=bigint).add("bytes", "binary_length", "text", wrap=bigint)
    calls.add("starts", "starts_with", "text", "E").add("ends", "ends_with", "text", ".").add("has", "match_substring", "text", "an")
    calls.add("has_any", "match_substring", "text", "AN", ignore_case=True).add("digits", "match_substring_regex", "text", "[0-9]{2,}")
    calls.add("liked", "match_like", "text", "%e_t%").add("iliked", "match_like", "text", "E%", ignore_case=True)
    calls.add("counted", "count_substring", "text", "en", wrap=bigint).add("vowels", "count_substring_regex", "text", "[aeiou]{2}", wrap=bigint)
    calls.add("found", "find_substring", "text", "é", wrap=bigint)
    pattern = "(?P<one>[a-z]+) (?P<two>[a-z]+)"
    calls.add("first_word", "extract_regex", "text", pattern, wrap=lambda s: s["one"])
    calls.add("second_word", "extract_regex", "text", pattern, wrap=lambda s: s["two"])
    calls.add("words", "split_pattern", "text", " ", wrap=lambda a: F.md5(joined(a)))
    calls.add("pieces", "split_pattern_regex", "text", "e", wrap=lambda a: bigint(F.size(a)))
    return calls.add("alnum", "utf8_is_alnum", "role").add("low", "ascii_is_lower", "role").add("plain", "string_is_ascii", "text").select()


@query(
    "fn_temporal",
    """SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS mo, day(ts) AS dy, hour(ts) AS h, minute(ts) AS mi, CAST(extract('second' FROM ts) AS BIGINT) AS se,
       (epoch_us(ts) // 1000) % 1000 AS ms, epoch_us(ts) % 1000 AS us, CAST(0 AS BIGINT) AS ns, round((epoch_us(ts) % 1000000) / 1e6, 6) AS frac,
       isodow(ts) - 1 AS dow, isodow(ts) % 7 + 1 AS dow_sunday, dayofyear(ts) AS doy, week(ts) AS iso_w, isoyear(ts) AS iso_y,
       (dayofyear(CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) + 3) - 1) // 7 + 1 AS us_w, year(CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) + 3) AS us_y,
       year(ts) % 4 = 0 AS leap, strftime(ts, '%d-%b-%Y %H:%M:%S.%f %j') AS formatted, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
       strftime(ts + CASE WHEN ts < TIMESTAMP '2024-03-10 02:00:00' THEN INTERVAL 5 HOUR ELSE INTERVAL 4 HOUR END, '%Y-%m-%d %H:%M:%S.%f') AS instant,
       ts >= TIMESTAMP '2024-03-10 07:00:00' AND ts < TIMESTAMP '2024-11-03 06:00:00' AS dst FROM events""".replace("CAST(extract('second' FROM ts) AS BIGINT)", "CAST(second(ts) AS BIGINT)"),
)
def fn_temporal(spark: SparkSession, sf: str) -> DataFrame:
    calls = Calls(table(spark, sf, "events"), "event_id")
    for name, fn in [
        ("y", "year"), ("q", "quarter"), ("mo", "month"), ("dy", "day"), ("h", "hour"), ("mi", "minute"), ("se", "second"), ("ms", "millisecond"),
        ("us", "microsecond"), ("ns", "nanosecond"), ("dow", "day_of_week"), ("doy", "day_of_year"), ("iso_w", "iso_week"),
        ("iso_y", "iso_year"), ("us_w", "us_week"), ("us_y", "us_year"), ("leap", "is_leap_year"),
    ]:
        calls.add(name, fn, "ts")
    calls.add("frac", "subsecond", "ts", wrap=rounded).add("dow_sunday", "day_of_week", "ts", count_from_zero=False, week_start=7)
    calls.add("formatted", "strftime", "ts", format="%d-%b-%Y %H:%M:%S %j")
    text = F.date_format("ts", "dd-MMM-yyyy HH:mm:ss")
    calls.add("parsed", "strptime", text, format="%d-%b-%Y %H:%M:%S", unit="s", wrap=lambda v: F.date_format(v, "yyyy-MM-dd HH:mm:ss"))
    calls.add("instant", "assume_timezone", "ts", "America/New_York", ambiguous="earliest", nonexistent="latest", wrap=stamp)
    return calls.add("dst", "is_dst", F.col("ts").cast("timestamp"), timezone="America/New_York").select()


@query(
    "fn_temporal_arith",
    """SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS hour_floor, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket,
       strftime(date_trunc('week', ts), '%Y-%m-%d %H:%M:%S.%f') AS week_floor, strftime(date_trunc('quarter', ts), '%Y-%m-%d %H:%M:%S.%f') AS quarter_floor,
       strftime(CASE WHEN ts = date_trunc('day', ts) THEN ts ELSE date_trunc('day', ts) + INTERVAL 1 DAY END, '%Y-%m-%d %H:%M:%S.%f') AS day_ceil,
       strftime(date_trunc('month', ts) + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S.%f') AS month_ceil,
       strftime(date_trunc('minute', ts + INTERVAL 30 SECOND), '%Y-%m-%d %H:%M:%S.%f') AS minute_round,
       date_diff('year', ts, o) AS years, date_diff('quarter', ts, o) AS quarters, CAST((CAST(date_trunc('week', o) AS DATE) - CAST(date_trunc('week', ts) AS DATE)) // 7 AS BIGINT) AS weeks, date_diff('day', ts, o) AS days, date_diff('hour', ts, o) AS hours,
       date_diff('minute', ts, o) AS minutes, date_diff('second', ts, o) AS seconds, date_diff('millisecond', ts, o) AS millis, date_diff('microsecond', ts, o) AS micros,
       date_diff('microsecond', ts, o) * 1000 AS nanos FROM (SELECT *, TIMESTAMP '2025-05-05 05:05:05.000005' AS o FROM events)""",
)
def fn_temporal_arith(spark: SparkSession, sf: str) -> DataFrame:
    calls = Calls(table(spark, sf, "events"), "event_id")
    calls.add("hour_floor", "floor_temporal", "ts", unit="hour", wrap=stamp).add("bucket", "floor_temporal", "ts", multiple=15, unit="minute", wrap=stamp)
    calls.add("week_floor", "floor_temporal", "ts", unit="week", wrap=stamp).add("quarter_floor", "floor_temporal", "ts", unit="quarter", wrap=stamp)
    calls.add("day_ceil", "ceil_temporal", "ts", unit="day", wrap=stamp).add("month_ceil", "ceil_temporal", "ts", unit="month", wrap=stamp)
    calls.add("minute_round", "round_temporal", "ts", unit="minute", wrap=stamp)
    other = dt.datetime(2025, 5, 5, 5, 5, 5, 5)
    for name, unit in [("millis", "milliseconds"), ("micros", "microseconds"), ("nanos", "nanoseconds")]:
        calls.add(name, f"{unit}_between", "ts", other)
    for unit in ["years", "quarters", "weeks", "days", "hours", "minutes", "seconds"]:
        calls.add(unit, f"{unit}_between", "ts", other)
    return calls.select()


@query(
    "fn_nested",
    """SELECT vec_id, CAST(len(embedding) AS BIGINT) AS size, CAST(embedding[3] AS DOUBLE) AS third, CAST(list_sum(embedding[2:5]) AS DOUBLE) IS NOT NULL AS sliced,
       CAST(embedding[2] AS DOUBLE) AS slice_first, CAST(len(embedding[2:5]) AS BIGINT) AS slice_size, label AS from_struct, label AS from_map FROM embeddings""",
)
def fn_nested(spark: SparkSession, sf: str) -> DataFrame:
    calls = Calls(table(spark, sf, "embeddings"), "vec_id")

    def double(value: Column) -> Column:
        return value.cast("double")

    calls.add("size", "list_value_length", "embedding", wrap=bigint).add("third", "list_element", "embedding", 2, wrap=double)
    calls.add("sliced", "list_slice", "embedding", 1, 5, wrap=lambda v: v.isNotNull())
    calls.add("slice_first", "list_slice", "embedding", 1, 5, wrap=lambda v: double(F.get(v, F.lit(0))))
    calls.add("slice_size", "list_slice", "embedding", 1, 5, wrap=lambda v: bigint(F.size(v)))
    made = build("make_struct", F.col("label"), calls.df.schema["label"].dataType, "x", field_names=["label", "tag"])
    calls.add("from_struct", "struct_field", made, "label")
    return calls.add("from_map", "map_lookup", F.create_map(F.lit("k"), F.col("label")), "k").select()


# -- order-dependent functions, per file in row order ---------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Daily event files with row numbers, and a column with gaps."""
    settings = config([f"{daily_events(spark, sf)}/{DAILY}"], EVENT_TYPES, EVENTS_INPUT, metadata={})
    rows = Job(spark, settings, "t").rows().select("event_id", "user_id", "event_type", "value", "_source_file", "_index")
    gaps = F.when(F.col("event_id") % 4 != 0, F.col("value"))
    return rows.withColumns({"gaps": gaps, "sign": F.when(F.col("user_id") % 2 == 0, 1).otherwise(-1).cast("bigint")})


_E = "SELECT *, strftime(ts, '%Y%m%d') AS day, CASE WHEN event_id % 4 <> 0 THEN value END AS gaps FROM events"
_W = "(PARTITION BY day ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(
    "fn_cumulative",
    f"""SELECT event_id, round(sum(value) OVER {_W}, 8) AS running, max(value) OVER {_W} AS high, min(value) OVER {_W} AS low,
        CASE WHEN gaps IS NOT NULL THEN round(sum(gaps) OVER {_W}, 8) END AS skipping, CASE WHEN gaps IS NOT NULL THEN round(avg(gaps) OVER {_W} / 7919, 10) END AS mean,
        CASE WHEN count(*) OVER {_W} = count(gaps) OVER {_W} THEN round(sum(gaps) OVER {_W}, 8) END AS until_null,
        CASE WHEN sum(user_id % 2) OVER {_W} % 2 = 0 THEN 1 ELSE -1 END AS product FROM ({_E})""",
)
def fn_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    calls = [
        ("running", "value", "cumulative_sum", {}), ("high", "value", "cumulative_max", {}), ("low", "value", "cumulative_min", {}),
        ("skipping", "gaps", "cumulative_sum", {"skip_nulls": True}), ("mean", "gaps", "cumulative_mean", {"skip_nulls": True}),
        ("until_null", "gaps", "cumulative_sum_checked", {}), ("product", "sign", "cumulative_prod", {}),
    ]
    df = apply_functions(_events(spark, sf), [(column, fn, into, (), kwargs) for into, column, fn, kwargs in calls])
    sums = [F.round(c, 8).alias(c) for c in ("running", "skipping", "until_null")]
    # Divided by a prime, the mean has no ties to round.
    return df.select("event_id", "high", "low", *sums, F.round(F.col("mean") / 7919, 10).alias("mean"), "product")


@query(
    "fn_fill_null",
    f"""SELECT event_id, last_value(gaps IGNORE NULLS) OVER {_W} AS forward, first_value(gaps IGNORE NULLS) OVER
        (PARTITION BY day ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward,
        round(value - lag(value, 2) OVER (PARTITION BY day ORDER BY event_id), 4) AS step FROM ({_E})""",
)
def fn_fill_null(spark: SparkSession, sf: str) -> DataFrame:
    fills = [("gaps", f"fill_null_{way}", way, (), {}) for way in ("forward", "backward")]
    df = apply_functions(_events(spark, sf), fills)
    df = apply_function(df, "value", "pairwise_diff", into="step", period=2)
    return df.select("event_id", "forward", "backward", F.round("step", 4).alias("step"))


_R = "(PARTITION BY day ORDER BY gaps NULLS LAST)"


@query(
    "fn_rank",
    f"""SELECT event_id, row_number() OVER (PARTITION BY day ORDER BY gaps NULLS LAST, event_id) AS by_first, rank() OVER {_R} AS by_min,
        rank() OVER {_R} + count(*) OVER (PARTITION BY day, gaps) - 1 AS by_max, dense_rank() OVER {_R} AS by_dense,
        round((rank() OVER {_R} - 1 + count(*) OVER (PARTITION BY day, gaps) / 2.0) / count(*) OVER (PARTITION BY day), 9) AS quantile FROM ({_E})""",
)
def fn_rank(spark: SparkSession, sf: str) -> DataFrame:
    calls = [("gaps", "rank", f"by_{tie}", (), {"tiebreaker": tie}) for tie in ("first", "min", "max", "dense")]
    df = apply_functions(_events(spark, sf), [*calls, ("gaps", "rank_quantile", "quantile", (), {})])
    return df.select("event_id", "by_first", "by_min", "by_max", "by_dense", F.round("quantile", 9).alias("quantile"))


def _ratio_sql(x: str, coefficients: tuple[list[float], list[float]]) -> str:
    powers = [[f"{c!r}::DOUBLE * pow({x}, {len(terms) - 1 - i})" for i, c in enumerate(terms)] for terms in coefficients]
    return f"(({' + '.join(powers[0])}) / ({' + '.join(powers[1])}))"


@query(
    "fn_rank_normal",
    f"""WITH e AS (SELECT event_id, (rank() OVER (PARTITION BY day ORDER BY value) - 1 + count(*) OVER (PARTITION BY day, value) / 2.0::DOUBLE)
                      / count(*) OVER (PARTITION BY day) AS p FROM ({_E})),
             s AS (SELECT event_id, p - 0.5::DOUBLE AS q, sqrt(-ln(least(p, 1 - p))) AS d FROM e)
        SELECT event_id, round(CASE WHEN abs(q) <= 0.425 THEN q * {_ratio_sql("(0.180625::DOUBLE - q * q)", ordered.NORMAL_MIDDLE)}
               WHEN d <= 5 THEN sign(q) * {_ratio_sql("(d - 1.6::DOUBLE)", ordered.NORMAL_TAIL)}
               ELSE sign(q) * {_ratio_sql("(d - 5)", ordered.NORMAL_FAR)} END, 6) AS score FROM s""",
)
def fn_rank_normal(spark: SparkSession, sf: str) -> DataFrame:
    scored = apply_function(_events(spark, sf), "value", "rank_normal", into="score")
    return scored.select("event_id", F.round("score", 6).alias("score"))


@query(
    "fn_sort_indices",
    f"""WITH e AS ({_E}), n AS (SELECT day, event_id, row_number() OVER (PARTITION BY day ORDER BY event_id) - 1 AS i,
             row_number() OVER (PARTITION BY day ORDER BY value DESC, event_id) - 1 AS p FROM e)
        SELECT a.event_id, b.i AS ordinal FROM n a JOIN n b ON a.day = b.day AND a.i = b.p""",
)
def fn_sort_indices(spark: SparkSession, sf: str) -> DataFrame:
    return apply_function(_events(spark, sf), "value", "array_sort_indices", into="ordinal", order="descending").select("event_id", "ordinal")


@query(
    "fn_winsorize",
    f"""WITH e AS ({_E}), n AS (SELECT day, value, row_number() OVER (PARTITION BY day ORDER BY value) - 1 AS p, count(*) OVER (PARTITION BY day) - 1 AS last FROM e),
        b AS (SELECT day, max(CASE WHEN p = CAST(round(0.05 * last) AS BIGINT) THEN value END) AS lo, max(CASE WHEN p = CAST(round(0.9 * last) AS BIGINT) THEN value END) AS hi FROM n GROUP BY day)
        SELECT event_id, least(greatest(value, lo), hi) AS clipped FROM e JOIN b USING (day)""",
)
def fn_winsorize(spark: SparkSession, sf: str) -> DataFrame:
    df = apply_function(_events(spark, sf), "value", "winsorize", 0.05, 0.9, into="clipped")
    return df.select("event_id", "clipped")
