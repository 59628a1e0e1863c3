"""Model input, both models and the final report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions.racing import distance_band
from furlong.operators import encode, filters, scoring
from furlong.operators.report import prediction_report
from furlong.plans.features import feature_table
from furlong.session import kept, materialize
from furlong.sources.files import input_fingerprint, numbered_predictions, read_predictions_csv, write_predictions_csv

KEYS = ("raceid", "result", "flag")


def prep_gbm(features: DataFrame) -> DataFrame:
    """Input of the tree model for all rows: categories coded over training and prediction rows together.

    The key, the result and the flag stay as columns; the split is by result.
    """
    coded = encode.label_encoded(features, [c for c in C.GBM_CATEGORICALS if c in features.columns])
    return filters.complete(coded).drop(*C.GBM_UNUSED)


def prep_mlp(features: DataFrame, levels: dict[str, list] | None = None) -> DataFrame:
    """Input of the network for all rows: distance bands, then one column per category level."""
    banded = features.withColumns({c: distance_band(F.col(c)) for c in ("distance", "pre_distance")})
    wide = encode.one_hot(banded, C.MLP_CATEGORICALS, levels)
    return filters.complete(wide.drop(*C.MLP_UNUSED))


def model_columns(df: DataFrame, exclude: Sequence[str] = KEYS) -> list[str]:
    return scoring.numeric_columns(df, exclude)


def gbm_scores(features: DataFrame, config: C.RaceConfig = C.PRODUCTION) -> DataFrame:
    data = materialize(prep_gbm(features), "gbm")
    train, used = filters.to_train(data), model_columns(data)
    found = {}
    if config.gbm_search:
        table = scoring.tune_gbt(train, used, C.GBM_CATEGORICALS, counted=C.GBM_COUNTED)[1]
        # Scores after more rounds come first: only the best settings get there.
        judged = [F.desc(c) for c in ("rounds", "score") if c in table.columns]
        best = table.orderBy(*judged, "depth", "rate").first()
        found = {"depth": best["depth"], "rate": best["rate"]}
    return scoring.score_gbt(train, filters.to_predict(data), used, C.GBM_CATEGORICALS, rounds=config.gbm_rounds,
                             counted=C.GBM_COUNTED, **found)


def network_scores(features: DataFrame, config: C.RaceConfig = C.PRODUCTION, linear: bool | None = None) -> DataFrame:
    data = materialize(prep_mlp(features), "mlp", compiled=True)
    return scoring.score_network(filters.to_train(data), filters.to_predict(data), model_columns(data),
                                 layers=config.network_layers, iterations=config.network_iterations, linear=linear)


def predict_end_to_end(spark: SparkSession, raw: DataFrame, config: C.RaceConfig = C.PRODUCTION,
                       root: str | None = None, source: str = "", resume: bool = False,
                       output: str | None = None) -> DataFrame:
    """Raw entries to the prediction report; with ``output`` it is also written there as a numbered CSV file.

    ``resume`` reads the finished feature table of the same configuration, source and input files.
    """
    def report() -> DataFrame:
        inputs = input_fingerprint(raw)
        features = materialize(feature_table(spark, raw, config, root, source, resume, inputs), "finished", compiled=True)
        return prediction_report(features, gbm_scores(features, config), network_scores(features, config),
                                 config.gbm_weight, config.tf_weight)

    # Tables and vectors of the run go with it; the report alone is kept.
    done = kept(spark, report, "report")
    if output is None:
        return done
    numbered = numbered_predictions(done)
    write_predictions_csv(numbered, output)
    return read_predictions_csv(spark, output, numbered.schema)
