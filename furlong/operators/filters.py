"""Row filters. All are narrow and reach the scan as pushed predicates where the source allows it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong import config as C
from furlong.functions.numeric import moment


def in_closed_set(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is listed; null is not."""
    return df.filter(F.col(column).isin(*values))


def not_excluded(df: DataFrame, column: str = "result", value: int = C.RESULT_EXCLUDED) -> DataFrame:
    """Rows whose value differs from the exclusion mark; null is kept."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def complete_in(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without null or NaN in the columns.

    One condition per column: from a single one over many columns Catalyst derives a further one for every set of
    columns that a later projection renames or casts, which takes its driver all memory when rows are filtered again.
    """
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    every = F.lit(True)
    for c in columns:
        known = F.col(f"`{c}`").isNotNull()
        every = every & (known & ~F.isnan(f"`{c}`") if c in floating else known)
    return df.filter(every)


def complete(df: DataFrame) -> DataFrame:
    return complete_in(df, df.columns)


def before(df: DataFrame, column: str, cut: datetime) -> DataFrame:
    return df.filter(F.col(column) < moment(cut))


def since(df: DataFrame, column: str, cut: datetime) -> DataFrame:
    return df.filter(F.col(column) >= moment(cut))


def to_predict(df: DataFrame) -> DataFrame:
    return df.filter(F.col("result") == C.RESULT_TO_PREDICT)


def to_train(df: DataFrame) -> DataFrame:
    """Rows with any other result; null counts as other."""
    return df.filter(~F.col("result").eqNullSafe(F.lit(C.RESULT_TO_PREDICT)))
