"""Value maps, fills, casts and the numeric profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions.numeric import clipped, finite_or_null, rnd
from furlong.operators.ordering import exact_medians


def recoded(df: DataFrame, maps: dict[str, dict]) -> DataFrame:
    """Replace values by one map per column; unlisted values stay."""
    for column, mapping in maps.items():
        df = df.replace(mapping, subset=[column])
    return df


def filled(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def filled_with_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with column means; all means come from one aggregate, fitted first."""
    if not columns:
        return df
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return _filled_double(df, {c: means[c] for c in columns})


def filled_with_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with exact medians (one row per column reaches the driver)."""
    fitted = {r["feature"]: r["median"] for r in exact_medians(df, columns).collect()}
    return _filled_double(df, {c: fitted.get(c) for c in columns})


def _filled_double(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    def fill(column: str, value: float | None) -> Column:
        as_double = F.col(column).cast("double")
        return as_double if value is None else F.coalesce(as_double, F.lit(float(value)))
    return df.withColumns({c: fill(c, v) for c, v in values.items()})


def finite(df: DataFrame, columns: Sequence[str], default: float | None = 0.0) -> DataFrame:
    """Infinite and NaN → null → ``default`` (None keeps the null)."""
    def clean(column: str) -> Column:
        value = finite_or_null(F.col(column).cast("double"))
        return value if default is None else F.coalesce(value, F.lit(default))
    return df.withColumns({c: clean(c) for c in columns})


def clip(df: DataFrame, columns: Sequence[str], low: float = -5.0, high: float = 5.0) -> DataFrame:
    return df.withColumns({c: clipped(F.col(c).cast("double"), low, high) for c in columns})


def casted(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that cannot be cast becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def rounded(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({c: rnd(F.col(c).cast("double"), digits) for c in columns})


_INTEGRAL = ((T.ByteType(), 7), (T.ShortType(), 15), (T.IntegerType(), 31), (T.LongType(), 63))
_FLOAT_MAX = 3.4028234663852886e38


def profile_numeric(df: DataFrame) -> DataFrame:
    """``(column, min, max, type)``: the narrowest type whose range strictly holds each numeric column.

    All minima and maxima come from one aggregate; only that one row reaches the driver. Half precision
    is not offered, so fractional columns become float or double.
    """
    numeric = [f for f in df.schema if isinstance(f.dataType, T.NumericType)]
    ends = df.agg(*[F.min(f.name).alias(f"min_{f.name}") for f in numeric],
                  *[F.max(f.name).alias(f"max_{f.name}") for f in numeric]).first()
    rows = []
    for f in numeric:
        low, high = ends[f"min_{f.name}"], ends[f"max_{f.name}"]
        rows.append((f.name, None if low is None else float(low), None if high is None else float(high),
                     _narrowest(f.dataType, low, high)))
    return df.sparkSession.createDataFrame(rows, "column string, min double, max double, type string")


def _narrowest(current: T.DataType, low, high) -> str:
    if low is None:
        return current.simpleString()
    if isinstance(current, T.IntegralType):
        for t, bits in _INTEGRAL:
            if -(1 << bits) < low and high < (1 << bits) - 1:
                return t.simpleString()
        return current.simpleString()
    return "float" if -_FLOAT_MAX < low and high < _FLOAT_MAX else "double"


def narrowed(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Cast the profiled columns to their profiled types."""
    return df.withColumns({r["column"]: F.col(r["column"]).cast(r["type"]) for r in profile.collect()})
