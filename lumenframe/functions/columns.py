"""Scalar column expressions. All stay in the JVM inside whole-stage codegen."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def ratio(numerator: str, denominator: str) -> Column:
    """Quotient; NULL where the denominator is 0."""
    return F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))


def threshold_label(column: str, threshold: float) -> Column:
    return (F.col(column) >= threshold).cast("int")


def cyclic(part: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a cyclic calendar part."""
    angle = part * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def calendar_features(ts: str) -> dict[str, Column]:
    """Time features of a timestamp; weeks start on Monday = 0."""
    hour_sin, hour_cos = cyclic(F.hour(ts), 24)
    month_sin, month_cos = cyclic(F.month(ts), 12)
    return {
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
        "day_of_week": F.weekday(ts),
        "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
        "quarter": F.quarter(ts),
    }


def timestamp_from_parts(year: str, month: str, day: str, hour: str) -> Column:
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.col(year), F.col(month), F.col(day), F.col(hour), zero, zero)


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Full 24-hour days from ``earlier`` to ``later``, rounded down."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(MICROS_PER_DAY))


def clip(column: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    return F.when(column < low, F.lit(float(low))).when(column > high, F.lit(float(high))).otherwise(column)


def mapped(column: str, names: Mapping, default: Column | None = None) -> Column:
    """Code to name through a literal map; a code outside the map gives ``default`` or NULL."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), F.col(column))
    return found if default is None else F.coalesce(found, default)


def shortened(text: str, size: int = 200, mark: str = "…") -> Column:
    return F.concat(F.substring(F.col(text), 1, size), F.lit(mark))


def confidence(probability: str, prediction: str) -> Column:
    """Probability of the predicted class."""
    return F.when(F.col(prediction) == 1, F.col(probability)).otherwise(1 - F.col(probability))


def percent(value: Column, places: int = 1) -> Column:
    return F.concat(F.format_number(value * 100, places), F.lit("%"))


def half_even(column: Column, places: int) -> Column:
    return F.bround(column, places)


def residual(actual: str, predicted: str) -> Column:
    return F.col(actual) - F.col(predicted)


def not_prefixed(column: str, prefix: str) -> Column:
    """True unless the text form starts with ``prefix``; NULL counts as not prefixed."""
    return ~F.coalesce(F.col(column).cast("string").startswith(prefix), F.lit(False))


def matches(column: str, pattern: str) -> Column:
    """Case-insensitive regular-expression search; NULL gives False."""
    return F.coalesce(F.col(column).rlike("(?iu)" + pattern), F.lit(False))


def contains_text(column: str, needle: str) -> Column:
    """Case-insensitive literal search; NULL gives False."""
    return F.coalesce(F.contains(F.lower(F.col(column)), F.lit(needle.lower())), F.lit(False))


def back_transformed(error: Column, scale: float = 100_000.0) -> Column:
    """``expm1(error) * scale``: the size of a log-space error in target units."""
    return F.expm1(error) * F.lit(scale)


def one_hot(column: str, levels: list[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per level; NULL gives all zeros."""
    return {
        f"{prefix}_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0)) for level in levels
    }
