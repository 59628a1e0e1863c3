"""Indices, labels and bands of the racing domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions.numeric import ratio


def chain(default: Column, overwrites: list[tuple[Column, Column]]) -> Column:
    """Successive conditional overwrites of ``default``; the last one that holds wins."""
    out = None
    for condition, value in reversed(overwrites):
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return default if out is None else out.otherwise(default)


def condition_index(turf: str = "turf", condition: str = "condition") -> Column:
    return chain(F.lit(0), [
        ((F.col(turf) == t) & (F.col(condition) == c), F.lit(v)) for (t, c), v in C.CONDITION_INDEX.items()])


def class_index(name: str = "class") -> Column:
    return chain(F.lit(C.CLASS_INDEX_DEFAULT), [(F.col(name) == k, F.lit(v)) for k, v in C.CLASS_INDEX.items()])


def speed_index(base: Column, time: Column, condition: Column, weight: Column) -> Column:
    """Time difference to the base time in tenths, per 1000 of base, plus going, weight and 80."""
    tenths = base * 10
    return (tenths - time * 10) * (ratio(F.lit(1), tenths) * 1000) + condition + (weight - 55) * 2 + 80


def last_race_index(result: Column, pop: Column, field: Column, weight: Column) -> Column:
    """Finish and favourite rank on an 18-runner scale, weighted by class; null for an empty field."""
    scale = ratio(F.lit(18), field)
    return ((18 - result * scale) + (18 - ratio(pop, scale))) * weight


def placed(result: Column) -> Column:
    """1 for the first three places and anything below, else 0, also for null."""
    return F.coalesce((result <= 3).cast("int"), F.lit(0))


def top3(result: Column) -> Column:
    """1 exactly for results 1, 2 and 3, else 0, also for null."""
    return F.coalesce(result.isin(1, 2, 3).cast("int"), F.lit(0))


def binarized(result: Column) -> Column:
    """1..3 → 1, 4 and above → 0, anything else unchanged."""
    return F.when(result >= 4, 0).when(result.between(1, 3), 1).otherwise(result)


def distance_band(distance: Column) -> Column:
    """Band name of a listed distance; other values pass through as text."""
    out = None
    for name, values in C.DISTANCE_BANDS.items():
        out = F.when(distance.isin(*values), name) if out is None else out.when(distance.isin(*values), name)
    return out.otherwise(distance.cast("string"))


def divisible_by_400(distance: Column) -> Column:
    return F.coalesce((distance % 400 == 0).cast("int"), F.lit(0))
