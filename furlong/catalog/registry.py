"""Name → query and name → SQL check."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from furlong.catalog.sql import six_digits, with_tables
from furlong.operators.values import rounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _six_digits(df: DataFrame) -> DataFrame:
    return rounded(df, [f.name for f in df.schema if f.dataType.simpleString() == "double"], 6)


def register(name: str, query: Query, sql: str | None = None, tables: str | tuple[str, ...] = (),
             doubles: Sequence[str] = ()) -> None:
    """Register a query and, if it has one, its check.

    ``tables`` are the building blocks the check's SQL reads, ``doubles`` its columns that are rounded to
    six digits, as all double columns of the query's result are.
    """
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: _six_digits(query(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = with_tables(tables, six_digits(sql, doubles))
