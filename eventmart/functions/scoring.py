"""Ratios, rounding, segments, flags, scores and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.functions.timecols import as_column

# From 2^52 on a double is a whole number.
_WHOLE_FROM = float(2**52)
_EXACT_LIMIT = 1e21


def round_half_up(value: Column | str, digits: int = 2) -> Column:
    """Round the stored binary value: 1.005 (really 1.00499...) gives 1.0, not 1.01.

    Halves go away from zero. What is scaled to 2^52 or more is whole as it is; what
    overflows when scaled is returned unchanged.
    """
    x = as_column(value).cast("double")
    scaled = F.abs(x) * float(10**digits)
    below = F.floor(scaled).cast("double")
    whole = F.when(scaled >= _WHOLE_FROM, scaled).otherwise(below + F.when(scaled - below >= 0.5, 1.0).otherwise(0.0))
    rounded = whole / F.lit(float(10**digits)) * F.signum(x)
    return F.when(scaled == float("inf"), x).otherwise(rounded)


def safe_ratio(num: Column | str, den: Column | str, scale: float = 1.0, digits: int = 2) -> Column:
    """num / den * scale, rounded; NULL when the denominator is zero."""
    ratio = as_column(num).cast("double") / F.nullif(as_column(den), F.lit(0))
    return round_half_up(ratio * F.lit(scale) if scale != 1.0 else ratio, digits)


def guarded_rate(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Percentage that is 0, not NULL, when there is nothing to divide by."""
    den = as_column(den)
    return F.when(den > 0, safe_ratio(num, den, 100.0, digits)).otherwise(F.lit(0.0))


def exact_sum(value: Column | str, scale: int = 6) -> Column:
    """Sum of doubles whose first `scale` decimals do not depend on the order rows arrive in.

    Each amount is cut into a decimal, added exactly, and what the decimal leaves over,
    added as a double: for amounts of `scale` decimals that is nothing. An amount no
    decimal can hold (huge, infinite or NaN) is left over whole.
    """
    x = as_column(value).cast("double")
    part = F.when(F.abs(x) < _EXACT_LIMIT, x.try_cast(f"decimal(28,{scale})"))
    exact = F.sum(part).cast("double")
    rest = F.sum(x - F.coalesce(part.cast("double"), F.lit(0.0)))
    return F.coalesce(exact + rest, exact, rest)


def exact_avg(value: Column | str, scale: int = 6) -> Column:
    count = F.count(as_column(value))
    return exact_sum(value, scale) / F.nullif(count, F.lit(0))


def customer_segment(purchases: Column | str) -> Column:
    """Purchase count to segment name; NULL means the user never bought."""
    n = as_column(purchases)
    return (
        F.when(n.isNull(), "Non-Purchaser")
        .when(n == 1, "One-Time Buyer")
        .when(n.between(2, 5), "Repeat Buyer")
        .when(n > 5, "Loyal Customer")
    )


def conversion_flag(left_key: Column, right_key: Column) -> Column:
    return left_key.isNotNull() & right_key.isNotNull()


def weighted_score(weights: dict[str, float]) -> Column:
    """Sum of column * weight, added in the order given."""
    terms = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def bucketize_labels(value: Column | str, steps: list[tuple[float, str]], other: str) -> Column:
    """Label of the first threshold reached, from the highest down; NULL and NaN take `other`."""
    x = as_column(value)
    x = F.when(F.isnan(x.cast("double")), None).otherwise(x)
    chain = None
    for threshold, label in sorted(steps, reverse=True):
        chain = (
            F.when(x >= threshold, label) if chain is None else chain.when(x >= threshold, label)
        )
    return chain.otherwise(other)
