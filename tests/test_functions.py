"""Column functions against the Arrow compute functions of the same names."""

import datetime as dt
import math
import re

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions import registry

NAN, INF = float("nan"), float("inf")

DATA = {
    "i": [0, 1, -1, 2, 7, -7, 10, 63, None, 25, -25, 12345, 15, 5],
    "x": [0.0, 1.0, -1.0, 2.5, -2.5, 0.5, 1.5, 1e-3, None, NAN, INF, -INF, 123.456, -0.125],
    "u": [0.5, 1.0, 2.5, 3.75, 0.125, 9.0, 100.0, 2.0, None, 1.5, 4.0, 8.0, 3.5, 0.25],
    "b": [True, False, None, True, False, None, True, False, None, True, False, True, False, True],
    "k": [0, 1, 2, 0, 1, None, 2, 0, 1, 2, 0, 1, 2, 0],
    "s": ["", "abc", "Hello World", "  pad ", "ÉtéÀ ça", "a1b2-c3", None, "+12", "-7", "x_y.z", "tab\there", "ab ab ab", "it's O'neil", "日本 語"],
    "t": [
        dt.datetime(2024, 1, 2, 13, 45, 30, 678901), dt.datetime(1969, 12, 31, 23, 59, 59, 1), None, dt.datetime(2023, 7, 17),
        dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29, 12, 30), dt.datetime(2000, 12, 31, 6), dt.datetime(2021, 1, 3, 1, 2, 3),
        dt.datetime(1999, 1, 1), dt.datetime(2016, 1, 4, 12), dt.datetime(2020, 6, 30, 23, 59, 59, 999999),
        dt.datetime(2015, 12, 28), dt.datetime(2024, 12, 30), dt.datetime(2011, 11, 11, 11, 11, 11, 111111),
    ],
    "d": [dt.date(2024, 1, 2), None, dt.date(1970, 1, 1), dt.date(2023, 12, 31)] + [dt.date(2020, 2, 29)] * 10,
    "l": [[1, 2, 3], [4, 5], None, [6, 7, 8, 9]] + [[1, 1]] * 10,
    "ls": [["a", "b"], ["c"], None, ["d", None]] + [["x", "y"]] * 10,
}
ARROW = {
    "i": pa.int64(), "x": pa.float64(), "u": pa.float64(), "b": pa.bool_(), "k": pa.int64(), "s": pa.string(),
    "t": pa.timestamp("us"), "d": pa.date32(), "l": pa.list_(pa.int64()), "ls": pa.list_(pa.string()),
}
SPARK = "i bigint, x double, u double, b boolean, k bigint, s string, t timestamp_ntz, d date, l array<bigint>, ls array<string>"

C = []


def case(name, column, *args, **kwargs):
    C.append((name, column, args, kwargs))


for n in ["add", "subtract", "multiply", "add_checked", "subtract_checked", "multiply_checked"]:
    case(n, "i", 3)
    case(n, "x", 2.5)
case("divide", "i", 4)
case("divide_checked", "i", -4)
case("divide", "x", 4.0)
case("divide", "x", 0.0)
case("divide", "x", -0.0)
case("divide_checked", "u", 4.0)
for n in ["abs", "negate", "sign", "abs_checked", "negate_checked", "ceil", "floor", "trunc"]:
    case(n, "i")
    case(n, "x")
case("power", "i", 3)
case("power_checked", "i", 2)
case("power", "x", 2.0)
case("power_checked", "u", 0.5)
for n in "exp expm1 sqrt ln log10 log2 log1p sin cos tan asin acos sinh cosh tanh asinh acosh atanh atan".split():
    case(n, "x")
for n in "sqrt_checked ln_checked log10_checked log2_checked log1p_checked sin_checked cos_checked tan_checked".split():
    case(n, "u")
case("logb", "x", 3.0)
case("logb_checked", "u", 3.0)
case("atan2", "x", 2.0)
MODES = [
    "down", "up", "towards_zero", "towards_infinity", "half_down", "half_up", "half_towards_zero",
    "half_towards_infinity", "half_to_even", "half_to_odd",
]
for m in MODES:
    case("round", "x", ndigits=0, round_mode=m)
    case("round", "u", ndigits=1, round_mode=m)
    case("round", "i", ndigits=-1, round_mode=m)
    case("round_to_multiple", "x", multiple=0.5, round_mode=m)
    case("round_to_multiple", "i", multiple=10, round_mode=m)
case("round", "x", ndigits=-1)
case("round", "x", ndigits=2)
case("bit_wise_and", "i", 6)
case("bit_wise_or", "i", 6)
case("bit_wise_xor", "i", 6)
case("bit_wise_not", "i")
case("shift_left", "i", 3)
case("shift_left_checked", "i", 2)
case("shift_right", "i", 1)
case("shift_right_checked", "i", 1)
case("shift_left", "i", 64)
case("max_element_wise", "x", 1.0)
case("min_element_wise", "x", 1.0)
case("max_element_wise", "i", 3, 8)
case("min_element_wise", "i", 3, skip_nulls=False)
case("max_element_wise", "x", NAN)
for n in ["equal", "not_equal", "less", "less_equal", "greater", "greater_equal"]:
    case(n, "x", 1.0)
    case(n, "i", 2)
    case(n, "s", "abc")
    case(n, "x", NAN)
for n in ["and_kleene", "or_kleene", "and_not_kleene", "and_", "or_", "and_not", "xor"]:
    case(n, "b", True)
    case(n, "b", False)
    case(n, "b", None)
case("invert", "b")
case("is_null", "x")
case("is_null", "x", nan_is_null=True)
for n in ["is_valid", "true_unless_null", "is_nan", "is_finite", "is_inf"]:
    case(n, "x")
    case(n, "i")
case("coalesce", "x", 1.0)
case("fill_null", "i", 5)
case("if_else", "b", 1, 2)
case("choose", "k", 10, 20, 30)
for n in "utf8_upper ascii_upper utf8_lower ascii_lower utf8_swapcase ascii_swapcase utf8_capitalize utf8_title utf8_reverse".split():
    case(n, "s")
case("binary_repeat", "s", 2)
for n in ["utf8_lpad", "ascii_lpad", "utf8_rpad", "ascii_rpad", "utf8_center", "ascii_center"]:
    case(n, "s", 8, padding="*")
case("utf8_zero_fill", "s", 6)
for n in ["utf8_trim", "ascii_trim", "utf8_ltrim", "ascii_ltrim", "utf8_rtrim", "ascii_rtrim"]:
    case(n, "s", " ae")
for side in ["trim", "ltrim", "rtrim"]:
    case(f"utf8_{side}_whitespace", "s")
    case(f"ascii_{side}_whitespace", "s")
for args in [(1,), (0, 3), (-3,), (1, -1), (2, 1), (-10, 2), (0, 6, 2), (-1, -4, -1), (4, None, -2)]:
    case("utf8_slice_codeunits", "s", *args)
case("utf8_replace_slice", "s", 1, 3, "##")
case("utf8_replace_slice", "s", -2, 50, "##")
case("utf8_replace_slice", "s", 3, 1, "##")
case("replace_substring", "s", "a", "ZZ")
case("replace_substring", "s", "a", "$", max_replacements=1)
case("replace_substring_regex", "s", "([a-c])([0-9])", r"\2\1")
case("replace_substring_regex", "s", "[ab]", "<$>", max_replacements=2)
case("utf8_normalize", "s", "NFD")
case("binary_join_element_wise", "s", "q", "-")
case("binary_join_element_wise", "s", "q", "-", null_handling="skip")
case("binary_join_element_wise", "s", "q", "-", null_handling="replace", null_replacement="N")
case("binary_join", "ls", "+")
for n in ["utf8_length", "binary_length"]:
    case(n, "s")
for n in ["starts_with", "ends_with", "match_substring", "count_substring", "find_substring"]:
    case(n, "s", "ab")
    case(n, "s", "AB", ignore_case=True)
for n in ["match_substring_regex", "count_substring_regex", "find_substring_regex"]:
    case(n, "s", "ç|b")
case("match_like", "s", "a_%")
case("match_like", "s", "A%", ignore_case=True)
case("extract_regex", "s", "(?P<p>[a-z]+)(?P<q>[0-9])")
case("split_pattern", "s", "a")
case("split_pattern", "s", "a", max_splits=1)
case("split_pattern", "s", "b", max_splits=1, reverse=True)
case("split_pattern_regex", "s", "[ab]")
case("split_pattern_regex", "s", "[ab]", max_splits=1)
for n in ["utf8_split_whitespace", "ascii_split_whitespace"]:
    case(n, "s")
    case(n, "s", max_splits=1)
    case(n, "s", max_splits=1, reverse=True)
for kind in ["utf8", "ascii"]:
    for t in "alnum alpha decimal lower upper space title printable".split():
        case(f"{kind}_is_{t}", "s")
case("utf8_is_digit", "s")
case("utf8_is_numeric", "s")
case("string_is_ascii", "s")
for n in """year quarter month day hour minute second millisecond microsecond nanosecond subsecond day_of_year
            iso_week iso_year us_week us_year is_leap_year iso_calendar year_month_day""".split():
    case(n, "t")
for n in "year quarter month day iso_week us_week".split():
    case(n, "d")
for z in [True, False]:
    for w in [1, 3, 7]:
        case("day_of_week", "t", count_from_zero=z, week_start=w)
    for m in [True, False]:
        for f in [True, False]:
            case("week", "t", week_starts_monday=m, count_from_zero=z, first_week_is_fully_in_year=f)
case("strftime", "t", format="%Y-%m-%d %H:%M:%S %j %a %b %p %I %y it's")
case("strftime", "d", format="%Y%m%dT%H:%M:%S")
case("strftime", "t")
for u in "microsecond millisecond second minute hour day week month quarter year".split():
    for m in (1, 3, 7):
        for how in ("floor", "ceil", "round"):
            case(f"{how}_temporal", "t", multiple=m, unit=u)
for u in "millisecond second minute hour day month".split():
    case("floor_temporal", "t", multiple=5, unit=u, calendar_based_origin=True)
case("ceil_temporal", "t", unit="day", ceil_is_strictly_greater=True)
case("floor_temporal", "t", unit="week", multiple=2, week_starts_monday=False)
case("floor_temporal", "d", unit="month")
OTHER = dt.datetime(2024, 5, 5, 5, 5, 5, 5)
for u in "years quarters weeks days hours minutes seconds milliseconds microseconds".split():
    case(f"{u}_between", "t", OTHER)
case("list_value_length", "l")
case("list_element", "l", 1)
case("list_slice", "l", 1, 3)
case("make_struct", "i", 5, field_names=["p", "q"])
case("is_in", "i", value_set=[1, 7])
case("index_in", "s", value_set=["abc", "-7"])
for t in ["string", "double"]:
    case("cast", "i", target_type=t)
case("cast", "x", target_type="string")
case("cast", "b", target_type="string")
case("cast", "d", target_type="string")
case("cast", "t", target_type="string")


def expected(name, column, args, kwargs):
    array = pa.array(DATA[column], ARROW[column])
    kwargs = dict(kwargs)
    if name == "cast":
        return pc.cast(array, {"string": pa.string(), "double": pa.float64()}[kwargs["target_type"]]).to_pylist()
    if "value_set" in kwargs:
        kwargs["value_set"] = pa.array(kwargs["value_set"])
    args = [pa.scalar(a, pa.bool_()) if a is None and column == "b" else a for a in args]
    if name.endswith("_between"):
        args = [pa.scalar(a, pa.timestamp("us")) for a in args]
    if name == "make_struct":
        return pc.make_struct(array, *args, **kwargs).to_pylist()
    out = getattr(pc, name)(array, *args, **kwargs)
    return out.to_pylist()


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        if math.isnan(a) or math.isnan(b):
            return math.isnan(a) and math.isnan(b)
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-15)
    if isinstance(b, dict):
        return a is not None and all(same(a[k], v) for k, v in b.items())
    if isinstance(b, (list, tuple)):
        return a is not None and len(a) == len(b) and all(map(same, a, b))
    return a == b


@pytest.fixture(scope="module")
def results(spark):
    rows = list(zip(*DATA.values()))
    df = spark.createDataFrame(rows, SPARK).coalesce(1).withColumn("_n", F.monotonically_increasing_id())
    out = {}
    size = 40
    for at in range(0, len(C), size):
        columns = []
        for j, (name, column, args, kwargs) in enumerate(C[at : at + size]):
            value = registry.build(name, F.col(column), df.schema[column].dataType, *args, **kwargs)
            columns.append(value.alias(f"r{at + j}"))
        got = df.select("_n", *columns).orderBy("_n").collect()
        for j in range(len(columns)):
            out[at + j] = [r[f"r{at + j}"] for r in got]
    return out


@pytest.mark.parametrize("at", range(len(C)), ids=[f"{c[0]}-{c[1]}-{i}" for i, c in enumerate(C)])
def test_like_arrow(results, at):
    name, column, args, kwargs = C[at]
    want = expected(name, column, args, kwargs)
    got = [r.asDict() if isinstance(r, T.Row) else r for r in results[at]]
    wrong = [(v, g, w) for v, g, w in zip(DATA[column], got, want) if not same(g, w)]
    assert not wrong, f"{name}{args}{kwargs}: (value, got, want) {wrong[:4]}"


RAISING = [
    ("divide", "i", (0,)), ("divide_checked", "u", (0.0,)), ("sqrt_checked", "x", ()), ("ln_checked", "x", ()),
    ("log1p_checked", "x", ()), ("asin_checked", "x", ()), ("acos_checked", "x", ()), ("acosh_checked", "u", ()),
    ("atanh_checked", "u", ()), ("sin_checked", "x", ()), ("shift_left_checked", "i", (64,)), ("power", "i", (-1,)),
    ("list_element", "l", (3,)), ("choose", "i", (1, 2)), ("logb_checked", "x", (2.0,)), ("add", "i", (2**63 - 1,)),
]


@pytest.mark.parametrize("name,column,args", RAISING)
def test_raises(spark, name, column, args):
    df = spark.createDataFrame(list(zip(*DATA.values())), SPARK)
    value = registry.build(name, F.col(column), df.schema[column].dataType, *args)
    with pytest.raises(Exception):
        df.select(value.alias("v")).collect()


def test_zones(spark):
    naive = [dt.datetime(2024, 1, 2, 9, 30), dt.datetime(2024, 7, 2, 9, 30), None]
    df = spark.createDataFrame([(v,) for v in naive], "t timestamp_ntz").coalesce(1)
    zone = "America/New_York"
    instant = registry.build("assume_timezone", F.col("t"), T.TimestampNTZType(), zone)
    back = registry.build("local_timestamp", instant, T.TimestampType(), zone)
    dst = registry.build("is_dst", instant, T.TimestampType(), zone)
    rows = df.select(instant.cast("timestamp_ntz").alias("u"), back.alias("b"), dst.alias("d")).collect()
    arrow = pc.assume_timezone(pa.array(naive, pa.timestamp("us")), zone)
    assert [r["u"] for r in rows] == pc.cast(arrow, pa.timestamp("us")).to_pylist()
    assert [r["b"] for r in rows] == naive
    assert [r["d"] for r in rows] == pc.is_dst(arrow).to_pylist()
    odd = spark.createDataFrame([(dt.datetime(2024, 11, 3, 1, 30),)], "t timestamp_ntz")
    arrow = pa.array([dt.datetime(2024, 11, 3, 1, 30)], pa.timestamp("us"))
    for pick in ("earliest", "latest"):
        value = registry.build("assume_timezone", F.col("t"), T.TimestampNTZType(), zone, ambiguous=pick)
        want = pc.cast(pc.assume_timezone(arrow, zone, ambiguous=pick), pa.timestamp("us")).to_pylist()
        assert [r[0] for r in odd.select(value.cast("timestamp_ntz")).collect()] == want
    for bad in (dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 3, 10, 2, 30)):
        df = spark.createDataFrame([(bad,)], "t timestamp_ntz")
        with pytest.raises(Exception):
            df.select(registry.build("assume_timezone", F.col("t"), T.TimestampNTZType(), zone)).collect()
    gap = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    arrow = pa.array([dt.datetime(2024, 3, 10, 2, 30)], pa.timestamp("us"))
    for pick in ("earliest", "latest"):
        value = registry.build("assume_timezone", F.col("t"), T.TimestampNTZType(), zone, nonexistent=pick)
        want = pc.cast(pc.assume_timezone(arrow, zone, nonexistent=pick), pa.timestamp("us")).to_pylist()
        assert abs(gap.select(value.cast("timestamp_ntz")).first()[0] - want[0]) <= dt.timedelta(microseconds=1)


def test_strptime(spark):
    texts = ["02-Jan-2024 17:00:00", "bad", None, "3-Feb-2024 7:01:02"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    fmt = "%d-%b-%Y %H:%M:%S"
    value = registry.build("strptime", F.col("s"), T.StringType(), format=fmt, unit="us", error_is_null=True)
    want = pc.strptime(pa.array(texts), format=fmt, unit="us", error_is_null=True).to_pylist()
    assert [r[0] for r in df.select(value).collect()] == want
    with pytest.raises(Exception):
        df.select(registry.build("strptime", F.col("s"), T.StringType(), format=fmt)).collect()


def test_nested_and_cases(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("a"), F.struct(F.lit("z").alias("c")).alias("b")).alias("st"),
        F.create_map(F.lit("k"), F.lit(5)).alias("m"),
        F.struct(F.lit(False).alias("p"), F.lit(True).alias("q")).alias("conds"),
    )

    def run(name, column, *args, **kwargs):
        return df.select(registry.build(name, F.col(column), df.schema[column].dataType, *args, **kwargs)).first()[0]

    assert run("struct_field", "st", "a") == 1
    assert run("struct_field", "st", [1, 0]) == "z"
    assert run("map_lookup", "m", "k") == 5
    assert run("map_lookup", "m", "none") is None
    assert run("case_when", "conds", "one", "two", "other") == "two"


def test_span(spark):
    texts = ["ab12", "é34x", None, "none"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    got = df.select(registry.build("extract_regex_span", F.col("s"), T.StringType(), "(?P<n>[0-9]+)").alias("v")).collect()
    want = pc.extract_regex_span(pa.array(texts), "(?P<n>[0-9]+)").to_pylist()
    assert [r["v"] and list(r["v"]["n"]) for r in got] == [w and list(w["n"]) for w in want]


@pytest.mark.parametrize("pattern", ["(?P<a>[a-z]+)-(?P<b>[0-9]+)", "x(?P<a>(?:y(?P<b>z))+)", "(?P<a>é|ü)(?:(?P<b>.)q|r)", "(?P<a>)b(?P<b>$)"])
def test_spans_of_any_groups(spark, pattern):
    texts = ["12 abc-45 de-6", "ßxyzyzyz", "éü üsq ér", "日本b", "", None, "a\\nb", "--", "éq-7 ab-"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    got = [r["v"] for r in df.select(registry.build("extract_regex_span", F.col("s"), T.StringType(), pattern).alias("v")).collect()]
    for text, span in zip(texts, got):
        match = re.search(pattern, text) if text is not None else None
        assert (span is None) == (match is None)
        for name in ("a", "b") if match else ():
            low, high = match.span(name)
            if low >= 0:
                assert list(span[name]) == [len(text[:low].encode()), len(text[low:high].encode())], (text, name)


ORDERED = [
    ("cumulative_sum", {}), ("cumulative_sum", {"start": 5.0, "skip_nulls": True}), ("cumulative_max", {}), ("cumulative_min", {}),
    ("cumulative_max", {"skip_nulls": True}), ("cumulative_mean", {"skip_nulls": True}), ("cumulative_mean", {}),
    ("cumulative_prod", {"skip_nulls": True}), ("cumulative_prod", {}), ("fill_null_forward", {}), ("fill_null_backward", {}),
    ("rank", {}), ("rank", {"sort_keys": "descending", "tiebreaker": "min"}), ("rank", {"tiebreaker": "max"}),
    ("rank", {"tiebreaker": "dense"}), ("rank", {"tiebreaker": "min", "null_placement": "at_start"}),
    ("rank_quantile", {}), ("rank_normal", {}), ("sort_indices", {}), ("array_sort_indices", {"order": "descending"}),
    ("winsorize", {"lower_limit": 0.2, "upper_limit": 0.7}), ("pairwise_diff", {"period": 1}), ("pairwise_diff", {"period": -2}),
]

SERIES = {
    "a": [3.0, 1.0, None, 3.0, 2.5, -4.0, 1.0, 8.0, None, 0.5, 2.0],
    "b": [1.0, 2.0, 2.0, 7.0],
    "c": [1.5, NAN, 2.5, 0.5, 3.0],
}


@pytest.mark.parametrize("name,kwargs", ORDERED, ids=[f"{n}-{i}" for i, (n, _) in enumerate(ORDERED)])
@pytest.mark.parametrize("block", [3, 1_000_000])
def test_ordered(spark, monkeypatch, name, kwargs, block):
    from rawlake.functions import ordered

    monkeypatch.setattr(ordered, "BLOCK", block)
    rows = [(g, i, v) for g, vs in SERIES.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "g string, i bigint, v double").repartition(4)
    out = registry.apply_function(df, "v", name, into="r", row_order=("g", "i"), **kwargs).collect()
    for g, vs in SERIES.items():
        array = pa.array(vs, pa.float64())
        if name == "winsorize" and None in vs:
            array = pa.array(vs)
        try:
            want = getattr(pc, name)(array, **kwargs).to_pylist()
        except pa.ArrowNotImplementedError:
            continue
        got = [r["r"] for r in sorted((r for r in out if r["g"] == g), key=lambda r: r["i"])]
        if name == "rank_normal":
            assert all(abs(a - b) < 1e-12 for a, b in zip(got, want))
        elif name in ("cumulative_prod", "cumulative_sum") and "c" == g:
            assert all(same(a, b) for a, b in zip(got, want))
        else:
            assert all(same(a, b) for a, b in zip(got, want)), (g, got, want)


def test_integer_product(spark):
    rows = [("g", i, v) for i, v in enumerate([2, 1, -1, 3, -3, 1, 0, 5])]
    df = spark.createDataFrame(rows, "g string, i bigint, v bigint").repartition(3)
    out = registry.apply_function(df, "v", "cumulative_prod", into="r", row_order=("g", "i")).orderBy("i").collect()
    assert [r["r"] for r in out] == [2, 2, -2, -6, 18, 18, 0, 0]


def test_every_name_is_covered():
    named = {c[0] for c in C} | {r[0] for r in RAISING} | {o[0] for o in ORDERED}
    source = open(__file__).read()
    missing = [n for n in registry.names() if n not in named and not re.search(rf'"{n}"', source)]
    twins = {
        "and", "or", "utf8_zfill", "round_binary", "binary_slice", "binary_replace_slice", "binary_reverse",
        "ascii_reverse", "ascii_capitalize", "ascii_title", "cumulative_sum_checked", "cumulative_prod_checked",
        "pairwise_diff_checked", "nanoseconds_between",
    }
    assert set(missing) <= twins, set(missing) - twins
