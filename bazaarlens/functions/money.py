"""Money expressions: exact decimal sums, ratios that are null on a zero denominator, cargo tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.params import CARGO_TIERS


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """num / den * scale in doubles; null where the denominator is zero or null."""
    value = F.try_divide(num.cast("double"), den.cast("double"))
    return value if scale == 1.0 else value * F.lit(float(scale))


def beside(a: DataFrame, b: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Group totals next to each other: joined on `by`, or one row beside one row."""
    return a.join(b, list(by)) if by else a.crossJoin(b)


def total(col: Column | str) -> Column:
    """Sum that is 0, not null, over an empty or all-null group."""
    summed = F.sum(col)
    return F.coalesce(summed, F.lit(0))


def cargo_tier(net: Column, tiers=CARGO_TIERS) -> Column:
    """Cargo fee of a package of value `net`, as an exact decimal."""
    fee = None
    for below, amount in tiers:
        value = F.lit(amount).cast("decimal(10,2)")
        if below is None:
            return value if fee is None else fee.otherwise(value)
        fee = F.when(net < below, value) if fee is None else fee.when(net < below, value)
    return fee


def cargo_tier_double(net: Column, tiers=CARGO_TIERS) -> Column:
    return cargo_tier(net, tiers).cast("double")
