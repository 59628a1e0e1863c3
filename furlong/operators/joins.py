"""Equi-joins of entry rows with derived tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from furlong.session import materialize


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows with an aggregated table whose size is not known beforehand.

    The table is written first. Its size is then known to Catalyst: below the broadcast threshold the
    rows are not shuffled at all, above it both sides are, and AQE splits the skewed partitions.
    """
    return rows.join(materialize(table, "lookup"), list(keys), how)


def same_entries(rows: DataFrame, *tables: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left joins of per-entry tables; all share one partitioning by the entry key."""
    for table in tables:
        rows = rows.join(table, list(keys), "left")
    return rows
