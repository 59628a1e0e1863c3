"""Selecting, renaming and reshaping columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names that are not present are ignored."""
    return df.drop(*columns)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by map; names that are not present are ignored."""
    return df.withColumnsRenamed(names)


def renamed_by_lists(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    return renamed(df, dict(zip(old, new, strict=True)))


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Put a prefix before every column name but those in ``keep``."""
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def column_range(df: DataFrame, first: str | int | None = None, last: str | int | None = None) -> DataFrame:
    """Columns from ``first`` to ``last``, both included, each given by name or position."""
    def position(mark: str | int | None, default: int) -> int:
        if mark is None:
            return default
        return df.columns.index(mark) if isinstance(mark, str) else mark
    return df.select(*df.columns[position(first, 0):position(last, len(df.columns) - 1) + 1])


def feature_group(df: DataFrame, group: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The keys and those columns of a named group that are present."""
    return df.select(*keys, *[c for c in group if c in df.columns and c not in keys])


def to_rows(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide record → one row per value column; values become double."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return wide.unpivot(list(ids), list(values), name, value)


def clean_leading_marks(df: DataFrame) -> DataFrame:
    """Strip blanks, ``*`` and ``&`` from the start of every text cell."""
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.regexp_replace(c, r"^[\s*&]+", "") for c in text})
