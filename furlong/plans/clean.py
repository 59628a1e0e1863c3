"""From raw entries to entries with both indices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions import racing
from furlong.operators import aggregates, filters, joins, values


def clean_entries(df: DataFrame, config: C.RaceConfig = C.PRODUCTION) -> DataFrame:
    """Keep flat races and runners with odds, settle class, sire-line and style names. Narrow throughout."""
    df = filters.in_closed_set(df, "distance", config.distances)
    df = filters.not_excluded(df)
    df = values.recoded(df, {"class": C.CLASS_NAMES, "legtype": C.STYLE_NAMES})
    df = values.filled(df, {"fathertype": C.DEFAULT_SIRE_LINE, "legtype": C.DEFAULT_STYLE})
    return filters.complete_in(df, ["pop", "odds", "3ftime"])


def with_speed_index(df: DataFrame, base: DataFrame | None = None, impute: bool = False) -> DataFrame:
    """Add ``speedindex`` against the base times of the same rows, or of a given table."""
    base = aggregates.base_times(df) if base is None else base
    joined = joins.lookup(df, base, ["place", "turf", "distance"])
    if impute:
        joined = joined.withColumn("__weight", F.col("weight"))
        joined = values.filled_with_median(joined, ["basetime", "__weight"])
    weight = F.col("__weight" if impute else "weight")
    out = joined.withColumn("speedindex", racing.speed_index(
        F.col("basetime"), F.col("time"), racing.condition_index(), weight))
    return out.drop("basetime", "__weight")


def with_last_race_index(df: DataFrame) -> DataFrame:
    return df.withColumn("last_race_index", racing.last_race_index(
        F.col("result"), F.col("pop"), F.col("horsecount"), racing.class_index()))


def with_indices(df: DataFrame, config: C.RaceConfig = C.PRODUCTION) -> DataFrame:
    """Both indices computed on the row: the base-time join is the only one."""
    return with_last_race_index(with_speed_index(df, impute=config.impute_weight))
