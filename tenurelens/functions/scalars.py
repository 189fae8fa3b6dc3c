"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: str | Column) -> Column:
    """An ISO literal or a date/timestamp column as a date."""
    return (F.lit(value) if isinstance(value, str) else value).cast("date")


def days_since(as_of: str, d: Column) -> Column:
    return F.datediff(day(as_of), d)


def warranty_expiry(first_purchase: Column, months: Column) -> Column:
    """A warranty month counts as 30 days."""
    return F.date_add(first_purchase, months * 30)


def steps(value: Column, marks: list, at_most: bool) -> Column:
    """Score 5, 4, 3, 2 for the first mark met, 1 otherwise (also for null)."""
    score = None
    for points, mark in zip((5, 4, 3, 2), marks):
        met = value <= F.lit(mark) if at_most else value >= F.lit(mark)
        score = F.when(met, points) if score is None else score.when(met, points)
    return score.otherwise(1)


# Score marks.
RECENCY_MARKS = [30, 90, 180, 270]
FREQUENCY_MARKS = [10, 6, 4, 2]
MONETARY_MARKS = [200_000, 100_000, 60_000, 30_000]


def recency_score(days: Column) -> Column:
    return steps(days, RECENCY_MARKS, at_most=True)


def frequency_score(count: Column) -> Column:
    return steps(count, FREQUENCY_MARKS, at_most=False)


def monetary_score(spend: Column) -> Column:
    return steps(spend, MONETARY_MARKS, at_most=False)


def clip01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def engagement(weekly_sessions: Column, satisfaction: Column, recency_days: Column) -> Column:
    """Half web activity (5 sessions a week = full), 30 % satisfaction, 20 % recency."""
    freshness = 1.0 - F.least(F.lit(1.0), F.coalesce(recency_days, F.lit(365)) / 365.0)
    return clip01(
        0.5 * F.coalesce(weekly_sessions, F.lit(0.0)) / 5.0
        + 0.3 * F.coalesce(satisfaction, F.lit(0.5))
        + 0.2 * freshness
    )


def finite_or_zero(value: Column) -> Column:
    """Nulls, NaN and infinities become 0."""
    v = value.cast("double")
    # v - v is NaN for an infinite v and 0 for any other number
    return F.coalesce(F.nanvl(v - v + v, F.lit(0.0)), F.lit(0.0))


def zscore(value: Column, mean: float, std: float) -> Column:
    return (finite_or_zero(value) - F.lit(float(mean))) / F.lit(float(std))


def level_flag(value: Column, level: str) -> Column:
    """1.0 on the given level, 0.0 on any other, also on an unseen or missing one."""
    return F.coalesce((value.cast("string") == F.lit(level)).cast("double"), F.lit(0.0))


def risk_segment(s: Column, high: float = 0.30, medium: float = 0.60) -> Column:
    return F.when(s < high, "High").when(s < medium, "Medium").when(s.isNotNull(), "Low")


def drift_band(psi: Column) -> Column:
    return F.when(psi < 0.10, "none").when(psi <= 0.20, "moderate").when(psi.isNotNull(), "significant")


def psi_term(reference: Column, current: Column, floor: float = 1e-6) -> Column:
    r, c = F.greatest(reference, F.lit(floor)), F.greatest(current, F.lit(floor))
    return (c - r) * F.ln(c / r)


def kl_term(reference: Column, current: Column, floor: float = 1e-6) -> Column:
    """Divergence of the current from the reference share."""
    r, c = F.greatest(reference, F.lit(floor)), F.greatest(current, F.lit(floor))
    return c * F.ln(c / r)


def weighted_sum(terms: list[tuple[Column, float]]) -> Column:
    total = F.lit(0.0)
    for column, weight in terms:
        total = total + column * F.lit(float(weight))
    return total


# Rational approximation of the normal tail (Hart 1968, form of West 2005).
HART_TOP = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
HART_BOTTOM = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
HART_LIMIT = 7.07106781186547


def horner(x, coefficients):
    total = coefficients[0]
    for c in coefficients[1:]:
        total = total * x + c
    return total


def tail_ratio_far(x):
    """Mills ratio by continued fraction, for x beyond the rational form's range."""
    return 1.0 / (x + 1.0 / (x + 2.0 / (x + 3.0 / (x + 4.0 / (x + 0.65)))))


def normal_upper_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, as a JVM expression."""
    a = F.abs(z)
    near = horner(a, [F.lit(c) for c in HART_TOP]) / horner(a, [F.lit(c) for c in HART_BOTTOM])
    far = tail_ratio_far(a) / 2.506628274631
    tail = F.exp(-a * a / 2.0) * F.when(a < HART_LIMIT, near).otherwise(far)
    return F.when(z > 0, tail).otherwise(1.0 - tail)


def double_array(values) -> Column:
    """A constant array, parsed in one go."""
    if len(values) == 0:
        return F.expr("cast(array() as array<double>)")
    return F.expr("array(" + ",".join(f"{float(v)!r}D" for v in values) + ")")


def count_below(value: Column, marks) -> Column:
    """How many of the ascending `marks` are smaller than the value (binary search)."""
    if len(marks) == 0:
        return F.lit(0)
    return count_below_in(value, double_array(marks), len(marks))


def count_below_in(value: Column, array: Column, at_most: int) -> Column:
    """The same for an ascending array column of at most `at_most` elements."""
    powers = [1 << k for k in reversed(range(at_most.bit_length()))]

    def descend(pos: Column, step: Column) -> Column:
        # past the end F.get gives null, which does not compare
        return F.when(F.get(array, pos + step - 1) < value, pos + step).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(p) for p in powers]), F.lit(0), descend)
