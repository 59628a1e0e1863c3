"""Grouped aggregates. Groups with a null key are dropped; all partial sums combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions.numeric import rnd_mean

MAX_CATEGORIES = 10_000


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(keys))


def base_times(df: DataFrame) -> DataFrame:
    """Mean time of placed runs per place, distance and turf, one digit."""
    keys = ["place", "distance", "turf"]
    return keyed(df.filter(F.col("result") <= 3), keys).groupBy(*keys).agg(
        rnd_mean(F.avg("time"), 1).alias("basetime"))


def categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list]:
    """Sorted distinct values of each column, found in one pass; too many values are an error."""
    sets = df.groupingSets([[c] for c in columns], *columns).agg(F.grouping_id().alias("__set"))
    rows = sets.limit(limit * len(columns) + 1).collect()
    found: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        own = max(columns, key=lambda c: not (r["__set"] >> (len(columns) - 1 - columns.index(c))) & 1)
        if r[own] is not None:
            found[own].append(r[own])
    if any(len(v) > limit for v in found.values()) or len(rows) > limit * len(columns):
        raise ValueError(f"more than {limit} categories in one of {list(columns)}")
    return {c: sorted(v) for c, v in found.items()}


def entity_rates(df: DataFrame, entity: str, values: dict[str, list], label: str = "result",
                 means: Sequence[str] = (), digits: int = 3, prefix: str | None = None) -> DataFrame:
    """Mean label per entity and category value, all categories in one aggregation.

    One column per value, ``{prefix}_{value}``, 0 where the entity has no such row; then one per extra
    mean, ``{prefix}_{column}``. A value that occurs in two categories is told apart by the category name.
    """
    prefix = prefix or entity
    seen: dict[str, int] = {}
    for listed in values.values():
        for v in listed:
            seen[str(v)] = seen.get(str(v), 0) + 1
    aggs = []
    for category, listed in values.items():
        for v in listed:
            name = f"{prefix}_{v}" if seen[str(v)] == 1 else f"{prefix}_{category}_{v}"
            rate = F.avg(F.when(F.col(category) == F.lit(v), F.col(label)))
            aggs.append(F.coalesce(rnd_mean(rate, digits), F.lit(0.0)).alias(name))
    aggs += [rnd_mean(F.avg(c), digits).alias(f"{prefix}_{c}") for c in means]
    return keyed(df, [entity]).groupBy(entity).agg(*aggs)


def pivoted_rates(df: DataFrame, entity: str, category: str, values: Sequence, label: str = "result",
                  digits: int = 4, prefix: str | None = None) -> DataFrame:
    """Mean label per entity and value of one category, as columns; empty cells are 0."""
    table = keyed(df, [entity]).groupBy(entity).pivot(category, list(values)).agg(F.avg(label))
    cells = [c for c in table.columns if c != entity]
    return table.select(entity, *[
        F.coalesce(rnd_mean(F.col(f"`{c}`"), digits), F.lit(0.0)).alias(f"{prefix or entity}_{c}") for c in cells])


def entity_means(df: DataFrame, entity: str, columns: Sequence[str], digits: int = 3) -> DataFrame:
    return keyed(df, [entity]).groupBy(entity).agg(
        *[rnd_mean(F.avg(c), digits).alias(f"mean_{c}") for c in columns])


def mean_of_all(df: DataFrame, entity: str, digits: int = 3) -> DataFrame:
    """Mean of every numeric column by entity, under the column's own name."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != entity]
    return keyed(df, [entity]).groupBy(entity).agg(*[rnd_mean(F.avg(c), digits).alias(c) for c in numeric])


def label_counts(df: DataFrame, label: str = "flag") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def distinct_entities(df: DataFrame, entity: str) -> DataFrame:
    return df.select(entity).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest in the given order of columns, all other columns breaking ties.

    An aggregate rather than a ranking: copies collapse before the shuffle, so a key with very many
    copies costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*[c for c in order if c not in keys], *rest)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*df.columns)
