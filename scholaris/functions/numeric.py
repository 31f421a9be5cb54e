"""Ratios, ranges and z-scores that hold up on nulls, NaN and empty input."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator, denominator) -> Column:
    """numerator / denominator as a double, null where the denominator is zero."""
    n, d = _col(numerator), _col(denominator)
    return n.cast("double") / F.nullif(d.cast("double"), F.lit(0.0))


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def without_nan(df: DataFrame) -> DataFrame:
    """Every NaN becomes null: comparisons treat NaN as the largest value otherwise."""
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: nan_to_null(name) for name in fractional}) if fractional else df


def clip(c, low, high) -> Column:
    """The nearest value in the range; null for null and NaN."""
    c = nan_to_null(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def z_score(value, mean, deviation) -> Column:
    """0 where the deviation is 0."""
    v, m, s = _col(value), _col(mean), _col(deviation)
    return F.when(s == 0, F.lit(0.0)).otherwise((v - m) / F.nullif(s, F.lit(0.0)))


def is_outlier(value, mean, deviation, limit: float = 3.0) -> Column:
    """Whether the z-score lies beyond the limit on either side; false for null and NaN."""
    z = z_score(value, mean, deviation)
    return F.coalesce((F.abs(z) > limit) & ~F.isnan(z), F.lit(False))


def within(c, low, high) -> Column:
    """True inside the closed range; false outside, for null and for NaN."""
    c = _col(c)
    return F.coalesce(c.between(low, high), F.lit(False))


def positive(c) -> Column:
    """True above zero; false for null and for NaN."""
    c = _col(c)
    return F.coalesce((c > 0) & ~F.isnan(c.cast("double")), F.lit(False))


def in_order(first, last) -> Column:
    """True where first <= last; false where either is null."""
    return F.coalesce(_col(first) <= _col(last), F.lit(False))


def map_total(c) -> Column:
    """Sum of a map's values; 0 for an empty map and for null values, null for a null map."""
    zero = F.lit(0).cast("long")
    return F.aggregate(F.map_values(_col(c)), zero, lambda total, x: total + F.coalesce(x.cast("long"), zero))


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)
