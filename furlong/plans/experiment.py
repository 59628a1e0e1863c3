"""The experiment run: both models on a part of the labelled rows, their metrics on the rest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong import config as C
from furlong.operators import evaluation, filters, scoring
from furlong.plans.predict import model_columns, prep_gbm, prep_mlp
from furlong.session import kept, materialize


def held_out_trees(features: DataFrame, config: C.RaceConfig = C.EXPERIMENT, label: str = "flag") -> DataFrame:
    """``(label, score)`` of the 30 % that the trees did not learn from."""
    data = materialize(prep_gbm(features), "gbm")
    train = filters.to_train(data)
    model, split, used, _ = scoring.trained_gbt(train, model_columns(data), C.GBM_CATEGORICALS, label,
                                                rounds=config.gbm_rounds, counted=C.GBM_COUNTED)
    return scoring.scores(model, split.filter("is_test"), used, "score", label)


def held_out_network(features: DataFrame, config: C.RaceConfig = C.EXPERIMENT, label: str = "flag") -> DataFrame:
    """``(label, score)`` of the rows that served neither for training nor for choosing the network."""
    data = materialize(prep_mlp(features), "mlp", compiled=True)
    used = model_columns(data)
    parts = scoring.network_parts(filters.to_train(data), used, label)
    model = scoring.chosen_network(parts, used, label, layers=config.network_layers, iterations=config.network_iterations)
    return scoring.scores(model, parts.filter("part = 'test'"), used, "score", label)


def experiment_metrics(features: DataFrame, config: C.RaceConfig = C.EXPERIMENT, label: str = "flag") -> DataFrame:
    """One row per model: accuracy, precision, recall, F1, the confusion cells and both areas on held-out rows."""
    rows = []
    for name, scored in (("trees", held_out_trees), ("network", held_out_network)):
        held = kept(features.sparkSession, lambda scored=scored: scored(features, config, label), "held")
        cells = evaluation.area_metrics(held, label, "score")
        binary = evaluation.binary_metrics(held, label, "score")
        extra = {c: binary.select(c).scalar() for c in binary.columns}
        rows.append(cells.select(F.lit(name).alias("model"), "*", *[v.alias(c) for c, v in extra.items()]))
    return reduce(DataFrame.unionByName, rows)
