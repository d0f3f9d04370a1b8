"""Numeric expressions and window-shaped statistics."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def clip(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def percentile_rank(value: Column, *by: str) -> Column:
    """Mean place of a value's ties, scaled to [0, 1]; a lone value is 0.5. Not percent_rank(), which takes the first place of ties."""
    everything = Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(everything)
    place = F.rank().over(everything.orderBy(value)) - 1
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
    return F.when(n == 1, F.lit(0.5)).otherwise((place + (ties - 1) / F.lit(2.0)) / F.greatest(n - 1, F.lit(1)))


def share_at_or_below(value: Column, by: str) -> Column:
    """Share of the group's values up to this one; 0.5 for all where the group has one value only."""
    group = Window.partitionBy(by)
    flat = F.min(value).over(group) == F.max(value).over(group)
    return F.when(flat, F.lit(0.5)).otherwise(F.cume_dist().over(group.orderBy(value)))


def squash(growth: Column) -> Column:
    return F.when(growth <= 0, F.lit(0.0)).otherwise(growth / (growth + 1))


def cagr(series: Column, min_slices: int = 4) -> Column:
    """Growth a slice between the means of the first and last two."""
    n = F.size(series)
    total = F.aggregate(series, F.lit(0.0), lambda a, x: a + x)
    head = (F.get(series, F.lit(0)) + F.get(series, F.lit(1))) / 2.0
    tail = (F.element_at(series, -1) + F.element_at(series, -2)) / 2.0
    rate = F.pow(tail / F.greatest(head, F.lit(0.5)), F.lit(1.0) / (n - 1)) - 1
    return F.when((n < min_slices) | (total <= 0), F.lit(0.0)).when(tail <= 0, F.lit(-1.0)).otherwise(rate)


def horizon(maturity: Column, h1: float = 0.75, h2: float = 0.35) -> Column:
    return F.when(maturity >= h1, F.lit("H1")).when(maturity >= h2, F.lit("H2")).otherwise(F.lit("H3"))


def signal_class(proportion: Column, growth: Column, proportion_cut: Column, growth_cut: Column) -> Column:
    large, fast = proportion >= proportion_cut, growth >= growth_cut
    return F.when(large & fast, F.lit("strong")).when(~large & fast, F.lit("weak")).when(large & ~fast, F.lit("latent")).otherwise(F.lit("noise"))


def quadrant(x: Column, y: Column, x_cut: Column, y_cut: Column, labels: list[str]) -> Column:
    at = (x >= x_cut).cast("int") + 2 * (y >= y_cut).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in labels]), at + 1)


def burst_score(states: Column, max_weight: Column, recency_bias: float = 0.5) -> Column:
    intensity = max_weight / (max_weight + 10.0)
    last = F.size(states) - F.array_position(F.reverse(states), 1)
    recency = (last + 1) / F.size(states)
    return F.when(~F.array_contains(states, 1) | (max_weight <= 0), F.lit(0.0)).otherwise((1 - recency_bias) * intensity + recency_bias * intensity * recency)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def tone_share(mean_tone: Column) -> Column:
    """Mean tone on [0, 1]; half where there was none."""
    return F.coalesce(clip((mean_tone + 10.0) / 20.0), F.lit(0.5))


def research_growth(cagr: Column, share: Column) -> Column:
    """Growth, where there is any, as far as research carries it."""
    return F.greatest(cagr, F.lit(0.0)) * share


def bar(count: Column, peak: Column, width: int = 20) -> Column:
    """The length of a count's bar where the peak has `width` marks."""
    return F.when(peak > 0, F.round(width * count / peak)).otherwise(0).cast("int")
