"""Numbers: scales, scores, rounding. Moments are always measured against a given day, never against now."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_scale(x: Column, scale: float) -> Column:
    """0 to 100: log10(x + 1) times ``scale``; 0 for null and up to 0."""
    return F.when(x > 0, F.least(F.lit(100.0), F.log10(x + 1) * scale)).otherwise(F.lit(0.0))


def saturating_weight(n: Column, full: int = 300) -> Column:
    """0 to 1 by the logarithm of a count, 1 from ``full`` on; four places."""
    return F.round(F.least(F.lit(1.0), F.log1p(n) / F.log1p(F.lit(float(full)))), 4)


def repeated_confidence(n: Column, first: float = 0.5, more: float = 0.05, most: float = 0.95) -> Column:
    """Confidence that grows with every further sighting."""
    return F.least(F.lit(most), F.lit(first) + (n - 1) * more)


def clamped(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), x))


def strict_greatest(*columns: Column) -> Column:
    """The greatest; null if any is null."""
    return F.when(_all_known(columns), F.greatest(*columns))


def strict_least(*columns: Column) -> Column:
    """The least; null if any is null."""
    return F.when(_all_known(columns), F.least(*columns))


def _all_known(columns: tuple[Column, ...]) -> Column:
    known = columns[0].isNotNull()
    for c in columns[1:]:
        known = known & c.isNotNull()
    return known


def years_between(day: Column, as_of: Column, length: float = 365.25) -> Column:
    return F.datediff(as_of, day) / F.lit(length)


def hyperbolic_freshness(day: Column, as_of: Column, penalty: Column | None = None, pace: float = 2.0) -> Column:
    """1 for today, a half after ``pace`` years (of 365 days), times ``penalty``; null for a null day."""
    fresh = 1.0 / (1.0 + years_between(day, as_of, 365.0) / pace)
    return fresh if penalty is None else fresh * penalty


def half_life_freshness(day: Column, as_of: Column, half_life: float = 2.5, missing_years: float = 99.0) -> Column:
    """100 for today, halved every ``half_life`` years; a null day counts as ``missing_years`` ago."""
    years = F.greatest(F.lit(0.0), F.coalesce(years_between(day, as_of), F.lit(missing_years)))
    return 100.0 * F.pow(F.lit(0.5), years / half_life)


def stepped(value: Column, steps: list[tuple[float, float]], beyond: float, missing: float) -> Column:
    """The score of the first (limit, score) with value <= limit; ``beyond`` above all, ``missing`` for null."""
    out = F.when(value.isNull(), F.lit(missing))
    for limit, score in steps:
        out = out.when(value <= limit, F.lit(score))
    return out.otherwise(F.lit(beyond))


def half_even(x: Column, places: int) -> Column:
    return F.bround(x, places)


def life_span(birth: Column, death: Column) -> Column:
    """"428 BCE-348 BCE"; unknown years as "?"; null if both are unknown."""

    def year(y: Column) -> Column:
        return F.when(y.isNull(), "?").when(y < 0, F.concat((-y).cast("string"), F.lit(" BCE"))).otherwise(y.cast("string"))

    return F.when(F.coalesce(birth, death).isNotNull(), F.concat(year(birth), F.lit("-"), year(death)))


def weighted_total(scores: Column, weights: Column, full: float = 5.0) -> Column:
    """Sum of score times weight over ``full``, of two arrays of equal length."""
    return F.aggregate(F.zip_with(scores, weights, lambda s, w: s * w / full), F.lit(0.0), lambda a, x: a + x)
