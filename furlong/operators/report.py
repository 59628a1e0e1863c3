"""Blending two scores and marking the rows to predict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions.numeric import rnd
from furlong.functions.racing import chain
from furlong.operators import aggregates, filters, joins


def with_scores(df: DataFrame, *scores: DataFrame, key: str = "raceid") -> DataFrame:
    """Left-join score tables on the entry key."""
    return joins.same_entries(df, *scores, keys=[key])


def blend(gbm_weight: float = 0.45, tf_weight: float = 0.55) -> Column:
    return F.col("gbm_pred") * gbm_weight + F.col("tf_pred") * tf_weight


def blended(df: DataFrame, gbm_weight: float = 0.45, tf_weight: float = 0.55) -> DataFrame:
    return df.withColumn("probability", rnd(blend(gbm_weight, tf_weight), 2))


def marked(df: DataFrame, gbm_weight: float = 0.45, tf_weight: float = 0.55, threshold: float = 0.5) -> DataFrame:
    """Mark by the number of scores at or above the threshold; flag by the unrounded blend."""
    gbm, tf = F.col("gbm_pred") >= threshold, F.col("tf_pred") >= threshold
    mark = chain(F.lit(C.MARK_NONE), [(gbm | tf, F.lit(C.MARK_ONE)), (gbm & tf, F.lit(C.MARK_BOTH))])
    flag = F.coalesce((blend(gbm_weight, tf_weight) >= threshold).cast("int"), F.lit(0))
    return df.withColumns({"new_mark_flag": mark, "new_flag": flag})


def prediction_report(features: DataFrame, gbm: DataFrame, tf: DataFrame, gbm_weight: float = 0.45,
                      tf_weight: float = 0.55) -> DataFrame:
    """The rows to predict with both scores, their blend and marks, one row per entry.

    Of the copies of an entry one with both scores comes first, then the one with the larger scores.
    """
    rows = filters.to_predict(features).select(*C.REPORT_COLUMNS)
    scored = with_scores(rows, gbm, tf)
    scored = scored.withColumn("tf_pred", F.col("tf_pred").cast("double"))
    out = marked(blended(scored, gbm_weight, tf_weight), gbm_weight, tf_weight)
    unscored = F.col("gbm_pred").isNull().cast("int") + F.col("tf_pred").isNull().cast("int")
    # The first in order is the smallest: unscored copies last, then falling scores.
    ranked = out.withColumns({"__unscored": unscored, "__gbm": -F.col("gbm_pred"), "__tf": -F.col("tf_pred")})
    kept = aggregates.first_per_key(ranked, ["raceid", "horsename"], ["__unscored", "__gbm", "__tf"])
    return kept.select(*out.columns)
