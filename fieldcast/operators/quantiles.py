"""Exact quantiles per group, with linear interpolation, for groups of any size.

The built-in exact percentile keeps all distinct values of a group in one buffer. Here ranks
are found by repeated narrowing: a pass splits the value range that holds a wanted rank into
``BINS`` bins, counts them (a number per bin and task reaches the shuffle), and goes on with
the bin that holds the rank. Bins never mix up the order of values and each bin's own least and
largest value are kept, so counts are exact and a range always shrinks. Once a range holds
``MOST`` rows at most, or one value only, its values are looked at. One rule for groups of all
sizes: a small group simply needs no pass.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F, Window

from fieldcast.operators.joins import spread_join
from fieldcast.operators.staging import stage

BINS = 1024
MOST = 10_000


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str | Column, probs: list[float],
    small_domain: bool = False, most: int = MOST, spread_on: list[str] | None = None,
) -> DataFrame:
    """Rows ``(keys, prob, n, quantile)`` for each group with a value.

    NULL and NaN values and rows with a NULL key are left out. ``small_domain`` states
    that the keys come from a closed list, so that the ranges may be broadcast. Otherwise
    large groups are split by the columns ``spread_on``, which should tell rows of a group
    apart; without them, equal values are counted first and groups are split by value.
    Every narrowing pass is a job of its own over the rows, which are staged for that.
    """
    probs = sorted(float(p) for p in probs)
    amount = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(
        *keys, amount.alias("_v"), F.lit(1).cast("long").alias("_w"),
        F.xxhash64(*[F.col(c) for c in spread_on] if spread_on else [amount]).alias("_spread"),
    ).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    groups = stage(rows.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "quantile-groups")
    if groups.where(is_open(most, "_n")).isEmpty():
        held = rows.groupBy(*keys, "_v").agg(F.sum("_w").alias("_w"))
        return _quantiles(_looked_up(held, keys, None, groups, probs), keys, probs)
    if not small_domain and not spread_on:
        rows = rows.groupBy(*keys, "_v", "_spread").agg(F.sum("_w").alias("_w"))
    rows = stage(rows, "quantile-rows")
    ranges = narrowed(rows, groups, keys, probs, small_domain, most)
    inside = _inside(rows, ranges, keys, small_domain).groupBy(*keys, "_lo", "_hi", "_v").agg(F.sum("_w").alias("_w"))
    single = ranges.where("_lo = _hi").select(*keys, "_n", "_rank", F.col("_lo").alias("_x"))
    seen = _looked_up(inside, keys, ranges.where("_lo < _hi"), groups, probs)
    return _quantiles(seen.unionByName(single), keys, probs)


def is_open(most: int, n: str = "_inside") -> Column:
    """Whether a range is still too large to look at."""
    return (F.col(n) > most) & (F.col("_lo") < F.col("_hi"))


def _ranks(probs: list[float]) -> Column:
    """The ranks (from 0) on both sides of each wanted place among ``_n`` values."""
    place = [F.lit(p) * (F.col("_n") - 1) for p in probs]
    return F.array_distinct(F.array(*[f(x) for x in place for f in (F.floor, F.ceil)]))


def narrowed(
    rows: DataFrame, groups: DataFrame, keys: list[str], probs: list[float], small_domain: bool, most: int,
) -> DataFrame:
    """``(keys, _n, _rank, _lo, _hi, _before, _inside)``: for every wanted rank a range of ``_inside``
    rows that holds it and the ``_before`` rows below, with at most ``most`` rows or one value."""
    state = groups.select(
        *keys, "_n", F.explode(_ranks(probs)).alias("_rank"), "_lo", "_hi",
        F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_inside"))
    while True:
        wide = state.where(is_open(most))
        if wide.isEmpty():
            return state
        state = stage(state.where(~is_open(most)).unionByName(
            _pass(rows, wide, keys, small_domain)), "quantile-ranges")


def _inside(rows: DataFrame, ranges: DataFrame, keys: list[str], small_domain: bool) -> DataFrame:
    """Rows that lie in a range of their group, with the ends of the range. Ranges of one group do
    not overlap, and it has few: two for each wanted quantile at most."""
    each = ranges.where("_lo < _hi").groupBy(*keys).agg(F.collect_set(F.struct("_lo", "_hi")).alias("_ranges"))
    joined = (
        rows.join(F.broadcast(each), keys) if small_domain
        else spread_join(rows, each, keys, ["_spread"], how="inner"))
    return joined.select(*keys, "_v", "_w", F.inline(F.filter(
        "_ranges", lambda r: F.col("_v").between(r["_lo"], r["_hi"]))))


def _scaled(v: Column) -> Column:
    """Sign and logarithm, rising with v over all doubles."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.least(F.log2(F.abs(v)), F.lit(1030.0)) + 1100.0))


def _bin(v: Column, low: Column, high: Column) -> Column:
    """The bin of v among ``BINS`` bins from low to high: of equal width, or on the logarithmic
    scale where the ends are far apart, so that few passes reach any value."""
    far = (_scaled(high) - _scaled(low) > 8) | (F.abs(low) == float("inf")) | (F.abs(high) == float("inf"))
    x, a, b = (F.when(far, _scaled(c)).otherwise(c) for c in (v, low, high))
    return F.least(F.floor((x - a) / (b - a) * BINS), F.lit(BINS - 1))


def _pass(rows: DataFrame, wide: DataFrame, keys: list[str], small_domain: bool) -> DataFrame:
    """For each rank in ``wide`` the bin of its range that holds it."""
    of_range = [*keys, "_lo", "_hi"]
    bins = (
        _inside(rows, wide, keys, small_domain)
        .withColumn("_bin", _bin(F.col("_v"), F.col("_lo"), F.col("_hi")))
        .groupBy(*of_range, "_bin")
        .agg(F.sum("_w").alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    )
    upto = Window.partitionBy(*of_range).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = bins.withColumn("_upto", F.sum("_c").over(upto))  # BINS rows in a window at most
    hit = (F.col("_before") + F.col("_upto") > F.col("_rank")) & (
        F.col("_before") + F.col("_upto") - F.col("_c") <= F.col("_rank"))
    return wide.join(counted, of_range).where(hit).select(
        *keys, "_n", "_rank", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
        (F.col("_before") + F.col("_upto") - F.col("_c")).alias("_before"), F.col("_c").alias("_inside"))


def _looked_up(held: DataFrame, keys: list[str], ranges: DataFrame | None, groups: DataFrame, probs: list[float]) -> DataFrame:
    """``(keys, _n, _rank, _x)`` from the counted values of each range, or of whole groups."""
    of_range = [*keys, "_lo", "_hi"] if ranges is not None else keys
    upto = Window.partitionBy(*of_range).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = held.withColumn("_upto", F.sum("_w").over(upto))
    if ranges is None:
        every = Window.partitionBy(*keys)
        ranked = summed.withColumn("_n", F.sum("_w").over(every)).withColumn("_before", F.lit(0))
        wanted = ranked.withColumn("_rank", F.explode(F.filter(
            _ranks(probs), lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_w")))))
    else:
        wanted = summed.join(ranges, of_range).where(
            (F.col("_before") + F.col("_upto") > F.col("_rank"))
            & (F.col("_before") + F.col("_upto") - F.col("_w") <= F.col("_rank")))
    return wanted.select(*keys, "_n", "_rank", F.col("_v").alias("_x"))


def _quantiles(found: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Interpolated between the values at the two ranks of each wanted place."""
    by_rank = found.groupBy(*keys).agg(
        F.max("_n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))

    def quantile(p: float) -> Column:
        place = F.lit(p) * (F.col("n") - 1)
        low, high = (F.element_at("_at", f(place)) for f in (F.floor, F.ceil))
        return F.when((low == high) | (low == float("-inf")), low).otherwise(low + (high - low) * (place - F.floor(place)))

    return by_rank.select(*keys, "n", F.explode(F.array(*[
        F.struct(F.lit(p).alias("prob"), quantile(p).alias("quantile")) for p in probs])).alias("_q"),
    ).select(*keys, "_q.prob", "n", "_q.quantile")


def quantile_table(
    df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]],
    small_domain: bool = False, most: int = MOST,
) -> DataFrame:
    """One row per group; column ``name`` is the ``prob`` quantile of ``column`` for each
    ``name: (column, prob)``. All columns share the passes."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    long = df.select(
        *keys,
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
            for c in columns
        ])).alias("_m"),
    ).select(*keys, F.col("_m.measure").alias("measure"), F.col("_m.value").alias("value"))
    found = exact_quantiles(long, [*keys, "measure"], "value", probs, small_domain, most)
    return found.groupBy(*keys).agg(*[
        F.max(F.when((F.col("measure") == c) & (F.col("prob") == p), F.col("quantile"))).alias(name)
        for name, (c, p) in wanted.items()
    ])
