"""Order-dependent functions given together, and values that most rows share."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rawlake.functions import ordered, registry


@pytest.fixture
def split(spark):
    """Small sorts shall have many ranges, as large ones do."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.unset(key)


def _hot(spark):
    rows = [("a", i, 7.0 if i % 20 else (None if i % 40 else float(i % 11))) for i in range(3000)]
    rows += [("b", i, 1.0) for i in range(500)] + [("c", 0, None)]
    return spark.createDataFrame(rows, "g string, i bigint, v double"), rows


def _want(rows, tie):
    frame = pd.DataFrame(rows, columns=["g", "i", "v"]).astype({"v": float})
    # Nulls are one value behind all others.
    frame["v"] = frame["v"].fillna(1e9)
    return frame.assign(r=frame.groupby("g")["v"].rank(method=tie))


def test_ranks_of_a_value_most_rows_share(split):
    df, rows = _hot(split)
    ties = ["first", "min", "max", "dense"]
    calls = [("v", "rank", t, (), {"tiebreaker": t}) for t in ties] + [("v", "rank_quantile", "q", (), {})]
    placed = ordered.positions(df, "v", "g", "i")
    assert placed.where("g = 'a' AND _val = 7").select("_range").distinct().count() > 2
    got = registry.apply_functions(df, calls, ("g", "i")).toPandas().sort_values(["g", "i"])
    for tie in ties:
        assert got[tie].tolist() == _want(rows, tie).sort_values(["g", "i"])["r"].astype(int).tolist(), tie
    middle = _want(rows, "average")
    middle["q"] = (middle["r"] - 0.5) / middle.groupby("g")["r"].transform("size")
    assert got["q"].round(12).tolist() == middle.sort_values(["g", "i"])["q"].round(12).tolist()


def test_ranks_join_on_no_value_or_file(split):
    df, _ = _hot(split)
    out = registry.apply_functions(df, [("v", "rank", "r", (), {"tiebreaker": "dense"})], ("g", "i"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins
    assert all(" AND " in line and "_val" not in line and "_key" not in line for line in joins)


def test_functions_together_equal_functions_apart(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 50)
    monkeypatch.setattr(ordered, "LISTED", 7)
    rows = [(g, i, None if i % 9 == 4 else (-2 if i % 30 == 0 else 1), float(i % 13)) for g in "ab" for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i bigint, n bigint, x double")
    skip = {"skip_nulls": True}
    calls = [
        ("n", "cumulative_prod", "p", (), skip), ("n", "cumulative_sum", "s", (), skip), ("n", "fill_null_backward", "b", (), {}),
        ("x", "cumulative_max", "m", (), {}), ("n", "fill_null_forward", "n", (), {}), ("n", "cumulative_min", "low", (), {}),
        ("x", "rank", "k", (), {"tiebreaker": "min"}), ("x", "negate", "x", (), {}), ("x", "cumulative_sum", "t", (), {}),
        ("t", "pairwise_diff", "d", (), {}),
    ]
    together = registry.apply_functions(df, calls, ("g", "i"))
    apart = df
    for column, name, into, args, kwargs in calls:
        apart = registry.apply_function(apart, column, name, *args, into=into, row_order=("g", "i"), **kwargs)
    assert together.columns == apart.columns
    assert together.orderBy("g", "i").collect() == apart.orderBy("g", "i").collect()


def test_long_products(spark, monkeypatch):
    """Factors behind a zero or hidden by a null are never multiplied; others overflow."""
    monkeypatch.setattr(ordered, "BLOCK", 100)
    monkeypatch.setattr(ordered, "LISTED", 10)

    def last(cells):
        df = spark.createDataFrame([("g", i, v) for i, v in enumerate(cells)], "g string, i bigint, v bigint")
        out = registry.apply_function(df, "v", "cumulative_prod", into="r", row_order=("g", "i"))
        return out.orderBy("i").collect()[-1]["r"]

    assert last([0] + [3] * 350) == 0
    assert last([None] + [3] * 350) is None
    assert last([1, -1] * 150 + [2] * 62 + [-1, 1]) == -(2**62)
    assert last([-2] * 63) == -(2**63)
    with pytest.raises(Exception, match="(?i)overflow"):
        last([2] * 40 + [1] * 100 + [2] * 23)


def test_one_summary_for_many_functions(spark, monkeypatch):
    written = []
    keep = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, label: written.append(label) or keep(df, label))
    df = spark.range(100).select(F.lit("g").alias("g"), F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    calls = [("v", f"cumulative_{k}", k, (), {}) for k in ("sum", "max", "min", "mean", "prod")]
    registry.apply_functions(df, calls, ("g", "i")).collect()
    assert written == ["summaries"]


@pytest.mark.parametrize("band,sketch", [(1 << 20, 10_000), (3, 20)])
@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_winsorize_selects_the_same_values_without_a_sort(spark, monkeypatch, band, sketch, kind):
    import random

    monkeypatch.setattr(ordered, "BAND", band)
    monkeypatch.setattr(ordered, "SKETCH", sketch)
    rng = random.Random(8)
    big = 2**62
    draw = {
        "double": lambda: rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e6), 0.0, 1.0, float("inf"), float("-inf")]),
        "bigint": lambda: rng.choice([rng.randint(-big, big), big + rng.randint(0, 50), 7]),
    }[kind]
    groups = {"hot": [draw() for _ in range(2000)], "one": [draw()], "two": [draw(), draw()], "same": [draw()] * 50, "few": [draw() for _ in range(31)]}
    rows = [(g, i, v) for g, vs in groups.items() for i, v in enumerate(vs)] + [("few", 31, None), ("none", 0, None)]
    df = spark.createDataFrame(rows, f"g string, i bigint, v {kind}").repartition(5)
    for low, high in ((0.05, 0.9), (0.5, 0.5)):
        out = {(r["g"], r["i"]): r["r"] for r in ordered.winsorize(df, "v", "r", "g", "i", low, high).collect()}
        for g, vs in groups.items():
            own = sorted(vs)
            a, b = (own[int(x * (len(own) - 1) + 0.5)] for x in (low, high))
            assert [out[g, i] for i in range(len(vs))] == [min(max(v, a), b) for v in vs], (g, low, high)
        assert out["few", 31] is None and out["none", 0] is None and len(out) == len(rows)
