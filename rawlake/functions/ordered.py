"""Functions that look at other rows: running totals, fills, ranks.

They are defined per file in row order. A file may hold most of the data, so no
window covers a whole file: rows are cut into blocks of ``BLOCK`` consecutive
numbers, each block is folded by itself, and a carry per block is worked out on
the far smaller table of block summaries. Ranks use a range-partitioned sort
with row counts per range instead of one sort per file, with the row number as
tie-break so equal values spread as well; no join or grouping is on a value or
a file alone.

Calls given together share their work: running functions one summary and one
window, ranks of a column one sort.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import is_float, is_int
from rawlake.session import bounded_broadcast, materialize

BLOCK = 1_000_000

# Rows whose factors are listed together before the lists are cut to LONGEST.
LISTED = 1_000

# Integers other than 0, 1 and -1 whose product cannot but overflow.
LONGEST = 64

Fold = Callable[[Column], Column]


@dataclass(frozen=True)
class Call:
    name: str
    column: str
    into: str
    args: tuple = ()
    kwargs: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Running:
    """A function of the rows so far in a block and of what earlier blocks
    (later ones, if ``backward``) fold to.

    ``parts`` has per name the aggregate of rows and the fold of aggregates,
    which must not depend on order; ``lists`` names those that are arrays.
    ``scratch`` columns are there before ``value`` is worked out.
    """

    parts: dict[str, tuple[Column, Fold]]
    value: Callable[[Callable[[str], Column], WindowSpec], Column]
    backward: bool = False
    lists: tuple[str, ...] = ()
    scratch: dict[str, Callable[[WindowSpec], Column]] = field(default_factory=dict)


RUNNING: dict[str, Callable[..., Running]] = {}
RANKS: dict[str, Callable[..., "Rank"]] = {}
ALONE: dict[str, Callable[..., DataFrame]] = {}


def known(name: str) -> bool:
    return name in RUNNING or name in RANKS or name in ALONE


def names() -> set[str]:
    return {*RUNNING, *RANKS, *ALONE}


def apply(df: DataFrame, calls: list[Call], group: str, at: str) -> DataFrame:
    """Apply the calls in turn, as many at a time as do not need each other."""
    waiting: list[Call] = []
    for call in calls:
        made = {c.into for c in waiting}
        if call.column in made or call.into in made | {c.column for c in waiting} or call.name in ALONE:
            df, waiting = _together(df, waiting, group, at), []
        if call.name in ALONE:
            df = ALONE[call.name](df, call.column, call.into, group, at, *call.args, **call.kwargs)
        else:
            waiting.append(call)
    return _together(df, waiting, group, at)


def _together(df: DataFrame, calls: list[Call], group: str, at: str) -> DataFrame:
    order = list(dict.fromkeys([*df.columns, *[c.into for c in calls]]))
    running = [c for c in calls if c.name in RUNNING]
    ranks = [c for c in calls if c.name in RANKS]
    if ranks:
        df = _rank_all(df, ranks, group, at)
    if running:
        df = _run_all(df, running, group, at)
    return df.select(*[F.col(f"`{c}`") for c in order]) if calls else df


def _block(at: str) -> Column:
    return F.floor(F.col(at) / BLOCK)


def _join_side(df: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join summaries to rows. They are written out first: the plan then reads
    the rows once however many functions are stacked, and their size is known."""
    table, _ = bounded_broadcast(materialize(side, "summaries"))
    return df.join(table, keys, how)


def _put(df: DataFrame, into: str, value: Column) -> DataFrame:
    scratch = [c for c in df.columns if c.startswith("_c_") or c == "_blk"]
    return df.withColumn(into, value).drop(*scratch)


# -- running folds ---------------------------------------------------------------------


def _run_all(df: DataFrame, calls: list[Call], group: str, at: str) -> DataFrame:
    """One table of block summaries, one join and one pass per direction."""
    runs = {c.into: RUNNING[c.name](df, c.column, at, *c.args, **c.kwargs) for c in calls}
    place = {(into, part): f"_c_{i}_{part}" for i, (into, run) in enumerate(runs.items()) for part in [*run.parts, *run.scratch]}
    parts = {place[into, part]: spec for into, run in runs.items() for part, spec in run.parts.items()}
    df = df.withColumn("_blk", _block(at))
    keys, rows = [group, "_blk"], [row.alias(n) for n, (row, _) in parts.items()]
    if any(run.lists for run in runs.values()):
        small = df.groupBy(*keys, F.floor(F.col(at) / LISTED).alias("_sub")).agg(*rows)
        blocks = small.groupBy(*keys).agg(*[fold(F.col(n)).alias(n) for n, (_, fold) in parts.items()])
    else:
        blocks = df.groupBy(*keys).agg(*rows)

    # One row per million rows of a file.
    def beyond(backward: bool) -> WindowSpec:
        order = F.col("_blk").desc() if backward else F.col("_blk")
        return Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    for into, run in runs.items():
        for part in run.lists:
            name = place[into, part]
            longer = F.coalesce(F.sum(F.size(name)).over(beyond(run.backward)), F.lit(0)) >= LONGEST
            blocks = blocks.withColumn(name, F.when(~longer & (F.size(name) > 0), F.col(name)))
    carried = [
        fold(F.col(place[into, part])).over(beyond(run.backward)).alias(place[into, part])
        if part not in run.lists
        else F.flatten(F.collect_list(place[into, part]).over(beyond(run.backward))).alias(place[into, part])
        for into, run in runs.items() for part, (_, fold) in run.parts.items()
    ]
    df = _join_side(df, blocks.select(*keys, *carried), keys)

    def within(backward: bool) -> WindowSpec:
        order = F.col(at).desc() if backward else F.col(at)
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)

    scratch = {place[i, n]: make(within(r.backward)) for i, r in runs.items() for n, make in r.scratch.items()}
    df = df.withColumns(scratch) if scratch else df
    values = {
        into: run.value(lambda part, into=into: F.col(place[into, part]), within(run.backward))
        for into, run in runs.items()
    }
    return df.withColumns(values).drop("_blk", *place.values())


def _cumulative(kind: str):
    def run(df: DataFrame, column: str, at: str, start: Any = None, skip_nulls: bool = False) -> Running:
        dtype = df.schema[column].dataType
        value = F.col(f"`{column}`")
        number = value.cast("double") if kind == "mean" or is_float(dtype) else value.cast("bigint")
        if kind in ("max", "min") and not (is_float(dtype) or is_int(dtype)):
            number = value
        if kind in ("max", "min") and is_float(dtype):
            number = F.when(~F.isnan(value), value)  # NaN never wins
        aggregate = {"sum": F.sum, "mean": F.sum, "max": F.max, "min": F.min}[kind]
        zero = F.lit(0)

        def result(carry: Callable[[str], Column], w: WindowSpec) -> Column:
            local = aggregate(number).over(w)
            if kind in ("sum", "mean"):
                total = F.coalesce(local, zero.cast("bigint")) + F.coalesce(carry("v"), zero)
                if start is not None:
                    total = total + F.lit(start)
                so_far = F.count(number).over(w) + F.coalesce(carry("n"), zero)
                answer = total / so_far if kind == "mean" else total
            else:
                pick = F.greatest if kind == "max" else F.least
                answer = pick(local, carry("v"), *([F.lit(start)] if start is not None else []))
                if is_float(dtype):
                    answer = F.coalesce(answer, F.lit(float("nan")))
            nulls = F.count_if(value.isNull()).over(w) + F.coalesce(carry("null"), zero)
            hidden = value.isNull() if skip_nulls else nulls > 0
            return F.when(~hidden, answer)

        parts = {
            "v": (aggregate(number), aggregate), "n": (F.count(number), F.sum), "null": (F.count_if(value.isNull()), F.sum),
        }
        return Running(parts, result)

    return run


RUNNING["cumulative_sum"] = RUNNING["cumulative_sum_checked"] = _cumulative("sum")
RUNNING["cumulative_mean"] = _cumulative("mean")
RUNNING["cumulative_max"] = _cumulative("max")
RUNNING["cumulative_min"] = _cumulative("min")


def cumulative_prod(df: DataFrame, column: str, at: str, start: Any = None, skip_nulls: bool = False) -> Running:
    """Running product, with signs and zeros counted apart.

    Integers stay exact: only factors other than 0, 1 and -1 enter the product,
    and ``LONGEST`` of them overflow whatever they are, so the first so many of
    a file decide. No list is longer, but for the ``LISTED`` rows it starts from.
    """
    value = F.col(f"`{column}`")
    whole = is_int(df.schema[column].dataType)
    one = F.lit(1).cast("bigint") if whole else F.lit(1.0)
    number = value.cast("bigint" if whole else "double")
    factor = F.when(number.isNotNull() & ~number.isin(0, 1, -1), number)
    flags = {"null": value.isNull(), "zero": number == 0, "neg": number == -1}
    flags = {n: F.coalesce(c, F.lit(False)) for n, c in flags.items()}
    parts = {n: (F.count_if(c), F.sum) for n, c in flags.items()}
    scratch = {}
    if whole:
        placed = F.when(factor.isNotNull(), F.struct(F.col(at).alias("at"), factor.alias("f")))

        def first(lists: Column) -> Column:
            return F.slice(F.sort_array(lists), 1, LONGEST)

        parts["f"] = (first(F.collect_list(placed)), lambda c: first(F.flatten(F.collect_list(c))))
        scratch["count"] = lambda w: F.count(factor).over(w)
    else:
        parts["f"] = (F.product(factor), F.product)

    def result(carry: Callable[[str], Column], w: WindowSpec) -> Column:
        def so_far(name: str) -> Column:
            return F.count_if(flags[name]).over(w) + F.coalesce(carry(name), F.lit(0))

        if whole:
            local = F.collect_list(F.when(carry("count") <= LONGEST, factor)).over(w)
            cells = F.concat(F.transform(carry("f"), lambda s: s["f"]), local)
            product = F.aggregate(cells, one, lambda a, x: a * x)
        else:
            product = F.coalesce(carry("f"), one) * F.coalesce(F.product(factor).over(w), one)
        sign = F.when(so_far("neg") % 2 == 1, -one).otherwise(one)
        answer = F.when(so_far("zero") > 0, one * 0).otherwise(product * sign)
        if start is not None:
            answer = answer * F.lit(start)
        hidden = value.isNull() if skip_nulls else so_far("null") > 0
        return F.when(~hidden, answer)

    return Running(parts, result, lists=("f",) if whole else (), scratch=scratch)


RUNNING["cumulative_prod"] = RUNNING["cumulative_prod_checked"] = cumulative_prod


def _fill(backward: bool):
    edge = F.min_by if backward else F.max_by

    def run(df: DataFrame, column: str, at: str) -> Running:
        value = F.col(f"`{column}`")
        nearest = edge(F.struct(F.col(at).alias("at"), value.alias("v")), F.when(value.isNotNull(), F.col(at)))

        def result(carry: Callable[[str], Column], w: WindowSpec) -> Column:
            return F.coalesce(F.last(value, ignorenulls=True).over(w), carry("v")["v"])

        return Running({"v": (nearest, lambda c: edge(c, c["at"]))}, result, backward)

    return run


RUNNING["fill_null_forward"] = _fill(False)
RUNNING["fill_null_backward"] = _fill(True)


def pairwise_diff(df: DataFrame, column: str, into: str, group: str, at: str, period: int = 1) -> DataFrame:
    """Difference to the row ``period`` before (after, if negative).

    Each block also gets the few rows of its neighbour it has to look at.
    """
    if period == 0:
        raise ValueError("period must not be 0")
    reach = abs(period)
    value = F.col(f"`{column}`")
    own = df.withColumn("_blk", _block(at)).withColumn("_c_own", F.lit(True))
    spot = F.pmod(F.col(at), F.lit(BLOCK))
    if reach <= BLOCK:
        near = spot >= BLOCK - reach if period > 0 else spot < reach
        lent = own.where(near).withColumns(
            {"_blk": F.col("_blk") + (1 if period > 0 else -1), "_c_own": F.lit(False)}
        )
        w = Window.partitionBy(group, "_blk").orderBy(at)
        both = own.unionByName(materialize(lent, "block-edges"))
        moved = F.lag(value, reach).over(w) if period > 0 else F.lead(value, reach).over(w)
        return _put(both.withColumn("_c_d", value - moved).where("_c_own"), into, F.col("_c_d"))
    other = df.select(group, (F.col(at) + period).alias(at), value.alias("_c_o"))
    return _put(df.join(other, [group, at], "left"), into, value - F.col("_c_o"))


ALONE["pairwise_diff"] = ALONE["pairwise_diff_checked"] = pairwise_diff


# -- ranks -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rank:
    """A value out of the places of a sort; ``ties`` if more than ``_pos``."""

    value: Column
    descending: bool
    null_placement: str
    ties: bool = True


def _sort_class(value: Column, dtype: T.DataType, null_placement: str) -> Column:
    """Values, then NaN, then nulls; the last two move to the front together."""
    nan = F.isnan(value) if is_float(dtype) else F.lit(False)
    if null_placement == "at_start":
        return F.when(value.isNull(), 0).when(nan, 1).otherwise(2)
    return F.when(value.isNull(), 2).when(nan, 1).otherwise(0)


def positions(
    df: DataFrame, column: str, group: str, at: str, descending: bool = False, null_placement: str = "at_end"
) -> DataFrame:
    """Sorted rows as ``group``, ``at``, ``_val``, with ``_pos``, the 0-based
    place in the group by value, ``_size`` of the group and ``_range``.

    Ranges are sorted once and numbered as they are written; the start of each
    comes from one count per range and group.
    """
    value = F.col(f"`{column}`")
    narrow = df.select(group, at, value.alias("_val"), _sort_class(value, df.schema[column].dataType, null_placement).alias("_cls"))
    # Finding the ranges reads the rows once more: not from the raw files.
    narrow = materialize(narrow, "rank-keys")
    keys = [F.col(group), F.col("_cls"), F.col("_val").desc() if descending else F.col("_val").asc(), F.col(at)]
    # So many ranges that one task sorts no more than its share, however many rows there are.
    width = -(-narrow.count() // RANGE)
    many = [width] if width > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ranged = narrow.repartitionByRange(*many, *keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumns({"_range": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    ranged = materialize(ranged, "sorted-ranges")
    # At most one row per shuffle partition and group.
    counts = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_range", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(whole).alias("_size")
    )
    placed = _join_side(ranged, starts, [group, "_range"])
    return placed.withColumn("_pos", F.col("_start") + F.col("_mid") - F.col("_m0")).drop("_start", "_mid", "_m0")


def places(placed: DataFrame, group: str) -> DataFrame:
    """Add the ``_first`` and ``_last`` place of each row's value, and its
    ``_dense`` number among the values of the group.

    Equal rows stand together, so each range finds its runs of them by itself;
    a run that goes on over ranges is closed on one row per range and group.
    """
    keys = [group, "_range"]
    nothing = F.col("_val").isNull() | (F.col("_cls") == 1)
    placed = placed.withColumn("_key", F.struct(nothing.alias("none"), F.when(~nothing, F.col("_val")).alias("tie")))
    up, down = Window.partitionBy(*keys).orderBy("_pos"), Window.partitionBy(*keys).orderBy(F.col("_pos").desc())
    up_to = up.rowsBetween(Window.unboundedPreceding, 0)
    down_to = down.rowsBetween(Window.unboundedPreceding, 0)
    runs = placed.withColumns(
        {
            "_opens": ~F.lag("_key").over(up).eqNullSafe(F.col("_key")),
            "_closes": ~F.lead("_key").over(up).eqNullSafe(F.col("_key")),
        }
    ).withColumns(
        {
            "_first": F.max(F.when(F.col("_opens"), F.col("_pos"))).over(up_to),
            "_run": F.count_if("_opens").over(up_to),
            "_last": F.min(F.when(F.col("_closes"), F.col("_pos"))).over(down_to),
        }
    )
    runs = materialize(runs.drop("_opens", "_closes", "_cls"), "ranked")
    ranges = runs.groupBy(*keys).agg(
        F.min_by("_key", "_pos").alias("_head"), F.max_by("_key", "_pos").alias("_tail"), F.max("_run").alias("_runs"),
        F.max("_first").alias("_tail_first"), F.min("_last").alias("_head_last"),
    )
    order = Window.partitionBy(group).orderBy("_range")
    back = Window.partitionBy(group).orderBy(F.col("_range").desc())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns(
        {
            "_joins": F.lag("_tail").over(order).eqNullSafe(F.col("_head")),
            "_goes_on": F.lead("_head").over(order).eqNullSafe(F.col("_tail")),
        }
    )
    single = F.col("_runs") == 1
    opened = F.when(~(single & F.col("_joins")), F.col("_tail_first"))
    closed = F.when(~(single & F.col("_goes_on")), F.col("_head_last"))
    ranges = ranges.select(
        *keys, "_joins", "_goes_on", "_runs",
        F.last(opened, ignorenulls=True).over(earlier).alias("_opened"),
        F.last(closed, ignorenulls=True).over(later).alias("_closed"),
        F.coalesce(F.sum(F.col("_runs") - F.col("_joins").cast("int")).over(earlier), F.lit(0)).alias("_values"),
    )
    joined = _join_side(runs, ranges, keys)
    return joined.withColumns(
        {
            "_first": F.when(F.col("_joins") & (F.col("_run") == 1), F.col("_opened")).otherwise(F.col("_first")),
            "_last": F.when(F.col("_goes_on") & (F.col("_run") == F.col("_runs")), F.col("_closed")).otherwise(F.col("_last")),
            "_dense": F.col("_values") + F.col("_run") - F.col("_joins").cast("int"),
        }
    )


def _rank_all(df: DataFrame, calls: list[Call], group: str, at: str) -> DataFrame:
    """One sort per column and direction; all results come back by one join."""
    wanted: dict[tuple, dict[str, Rank]] = {}
    for call in calls:
        rank = RANKS[call.name](*call.args, **call.kwargs)
        wanted.setdefault((call.column, rank.descending, rank.null_placement), {})[call.into] = rank
    sides = []
    for (column, descending, null_placement), ranks in wanted.items():
        side = positions(df, column, group, at, descending, null_placement)
        if any(rank.ties for rank in ranks.values()):
            side = places(side, group)
        sides.append(side.select(group, at, *[rank.value.alias(into) for into, rank in ranks.items()]))
    df = df.drop(*[c.into for c in calls])
    for side in sides:
        df = df.join(side, [group, at])
    return df


def _direction(sort_keys: Any, order: str | None = None) -> bool:
    if isinstance(sort_keys, (list, tuple)):
        sort_keys = sort_keys[0][1]
    return (order or sort_keys) == "descending"


def rank(sort_keys: Any = "ascending", null_placement: str = "at_end", tiebreaker: str = "first") -> Rank:
    places_of = {"first": F.col("_pos") + 1, "min": F.col("_first") + 1, "max": F.col("_last") + 1, "dense": F.col("_dense")}
    if tiebreaker not in places_of:
        raise ValueError(f"Unknown tiebreaker '{tiebreaker}'")
    return Rank(places_of[tiebreaker], _direction(sort_keys), null_placement, tiebreaker != "first")


def rank_quantile(sort_keys: Any = "ascending", null_placement: str = "at_end") -> Rank:
    middle = (F.col("_first") + F.col("_last") + 1) / 2
    return Rank(middle / F.col("_size"), _direction(sort_keys), null_placement)


# Coefficients of Wichura's algorithm AS 241, highest power first,
# as (numerator, denominator) for the middle, the tails and the far tails.
NORMAL_MIDDLE = (
    [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080],
    [5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867,
     5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0],
)
NORMAL_TAIL = (
    [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
     3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734],
    [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0],
)
NORMAL_FAR = (
    [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720],
    [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0],
)


def _ratio(x: Column, coefficients: tuple[list[float], list[float]]) -> Column:
    def polynomial(terms: list[float]) -> Column:
        total = F.lit(terms[0])
        for term in terms[1:]:
            total = total * x + F.lit(term)
        return total

    return polynomial(coefficients[0]) / polynomial(coefficients[1])


def normal_ppf(p: Column) -> Column:
    """Inverse of the normal distribution for a probability between 0 and 1."""
    q = p - 0.5
    depth = F.sqrt(-F.ln(F.least(p, 1 - p)))
    tail = F.when(depth <= 5, _ratio(depth - 1.6, NORMAL_TAIL)).otherwise(_ratio(depth - 5, NORMAL_FAR))
    middle = q * _ratio(F.lit(0.180625) - q * q, NORMAL_MIDDLE)
    return F.when(F.abs(q) <= 0.425, middle).otherwise(F.signum(q) * tail)


def rank_normal(sort_keys: Any = "ascending", null_placement: str = "at_end") -> Rank:
    quantile = rank_quantile(sort_keys, null_placement)
    return Rank(normal_ppf(quantile.value), quantile.descending, null_placement)


RANKS.update({"rank": rank, "rank_quantile": rank_quantile, "rank_normal": rank_normal})


def sort_indices(
    df: DataFrame, column: str, into: str, group: str, at: str, sort_keys: Any = "ascending",
    null_placement: str = "at_end", order: str | None = None,
) -> DataFrame:
    """Row i gets the row number of the i-th row in sorted order."""
    placed = positions(df, column, group, at, _direction(sort_keys, order), null_placement)
    answer = placed.select(F.col(group), F.col("_pos").alias(at), F.col(at).alias("_c_i"))
    return _put(df.join(answer, [group, at]), into, F.col("_c_i"))


# Rows of one range of a sort.
RANGE = 5_000_000

# A sketch of quantiles is off by less than one row in so many, and a band that
# surely holds a wanted place has a few times that share of the rows.
SKETCH = 10_000
# Values of a group's band that one task puts in order; a larger band is sorted by ranges.
BAND = 1 << 20


def _at_places(values: DataFrame, group: str, places: dict[str, float]) -> DataFrame:
    """``group`` and, for each name in ``places``, the value ``_val`` that stands at that share of a group's order.

    Exact, without sorting: a sketch bounds each place from both sides, one pass
    counts what lies below and picks what lies between, and only that is put in order.
    """
    values = materialize(values, "values")
    integral = isinstance(values.schema["_val"].dataType, T.IntegralType)
    shares = [min(max(p + side, 0.0), 1.0) for p in places.values() for side in (-3 / SKETCH, 3 / SKETCH)]
    sketch = F.percentile_approx("_val", F.array(*[F.lit(s) for s in shares]), F.lit(SKETCH)).alias("_q")
    ends = [F.min("_val").alias("_min"), F.max("_val").alias("_max")]
    bounds = values.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), sketch, *ends)
    # Of a small group everything lies between: a few shares of it may be no whole row.
    few, edges = F.col("_n") <= SKETCH, {}
    for i, (name, share) in enumerate(places.items()):
        low, high = F.get("_q", F.lit(2 * i)), F.get("_q", F.lit(2 * i + 1))
        if integral:  # the sketch holds doubles
            low = F.coalesce(F.try_subtract(low.cast("bigint"), F.lit(1024)), F.lit(-(2**63)))
            high = F.coalesce(F.try_add(high.cast("bigint"), F.lit(1024)), F.lit(2**63 - 1))
        low, high = F.when(few, F.col("_min")).otherwise(low), F.when(few, F.col("_max")).otherwise(high)
        edges |= {f"_low_{name}": low, f"_high_{name}": high, f"_at_{name}": F.round(F.lit(share) * (F.col("_n") - 1)).cast("bigint")}
    bounds = materialize(bounds.withColumns(edges).drop("_q", "_n", "_min", "_max"), "bounds")
    known = _join_side(values, bounds, [group])
    below = [F.count_if(F.col("_val") < F.col(f"_low_{n}")).alias(f"_below_{n}") for n in places]
    counts = materialize(known.groupBy(group).agg(*below, *[F.first(f"_at_{n}").alias(f"_at_{n}") for n in places]), "below")
    found = None
    for name in places:
        band = known.where(F.col("_val").between(F.col(f"_low_{name}"), F.col(f"_high_{name}"))).select(group, "_val")
        band = materialize(band.groupBy(group, "_val").agg(F.count(F.lit(1)).alias("_times")), "band")
        most = band.groupBy(group).count().agg(F.max("count")).first()[0] or 0
        if most <= BAND:
            upto = F.sum("_times").over(Window.partitionBy(group).orderBy("_val"))
            placed = band.withColumns({"_upto": upto}).withColumn("_from", F.col("_upto") - F.col("_times"))
        else:
            number = band.withColumn("_at", F.monotonically_increasing_id())
            placed = running_sums(positions(number, "_val", group, "_at"), band, group)
        spot = F.col(f"_at_{name}") - F.col(f"_below_{name}")
        hit = _join_side(placed, counts, [group]).where((F.col("_from") <= spot) & (spot < F.col("_upto")))
        missed = F.raise_error(F.lit("A place lies outside of its bounds")).cast(values.schema["_val"].dataType)
        hit = _join_side(counts.select(group), hit.select(group, "_val"), [group], "left").select(group, F.coalesce("_val", missed).alias(name))
        found = hit if found is None else found.join(hit, group)
    return found


def running_sums(placed: DataFrame, times: DataFrame, group: str) -> DataFrame:
    """``_from`` and ``_upto`` of sorted distinct values (of ``positions``) that stand for ``_times`` rows each."""
    rows = placed.select(group, "_val", "_pos", "_range").join(times.select(group, "_val", "_times"), [group, "_val"])
    rows = materialize(rows, "sorted-band")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(group, "_range").agg(F.sum("_times").alias("_sum"))
    starts = totals.select(group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = F.sum("_times").over(Window.partitionBy(group, "_range").orderBy("_pos"))
    summed = _join_side(rows, starts, [group, "_range"]).withColumn("_upto", F.col("_base") + within)
    return summed.withColumn("_from", F.col("_upto") - F.col("_times"))


def winsorize(
    df: DataFrame, column: str, into: str, group: str, at: str, lower_limit: float, upper_limit: float
) -> DataFrame:
    """Values beyond two quantiles become those quantiles' values."""
    value = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    real = value.isNotNull() & (~F.isnan(value) if is_float(kind) else F.lit(True))
    if is_float(kind) or isinstance(kind, T.IntegralType):
        picked = _at_places(df.where(real).select(group, value.alias("_val")), group, {"_c_a": lower_limit, "_c_b": upper_limit})
        bounds = picked.select(group, F.least("_c_a", "_c_b").alias("_c_lo"), F.greatest("_c_a", "_c_b").alias("_c_hi"))
    else:
        placed = positions(df.where(real), column, group, at)
        spots = [F.round(F.lit(limit) * (F.col("_size") - 1)).cast("bigint") for limit in (lower_limit, upper_limit)]
        # Only the two rows at those places are left per group.
        picked = placed.where((F.col("_pos") == spots[0]) | (F.col("_pos") == spots[1]))
        bounds = picked.groupBy(group).agg(F.min("_val").alias("_c_lo"), F.max("_val").alias("_c_hi"))
    clipped = F.least(F.greatest(value, F.col("_c_lo")), F.col("_c_hi"))
    return _put(_join_side(df, bounds, [group], "left"), into, F.when(real, clipped).otherwise(value))


ALONE.update({"sort_indices": sort_indices, "array_sort_indices": sort_indices, "winsorize": winsorize})
