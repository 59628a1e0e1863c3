"""Training and scoring of the two classifiers with Spark MLlib."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import NamedTuple

from pyspark import SparkContext
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.operators.sampling import balanced_by_copies, smote, split_random, split_stratified, with_class_weight
from furlong.operators.values import clip
from furlong.session import materialize


def numeric_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Names of the numeric columns, without the excluded ones."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def code_sizes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of codes of each code column; the learner gets as many bins as the largest has."""
    if not columns:
        return {}
    top = df.agg(*[F.max(c).alias(c) for c in columns]).first()
    return {c: int(top[c]) + 1 for c in columns if top[c] is not None}


def with_frequencies(df: DataFrame, columns: Sequence[str], counted: DataFrame) -> DataFrame:
    """Replace codes by their number of rows in ``counted``, 0 if there are none; the column order is kept."""
    for c in columns:
        table = counted.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("__code")).agg(F.count("*").alias("__n"))
        joined = df.join(materialize(table, "frequencies"), F.col(c) == F.col("__code"), "left")
        df = joined.select(*[F.coalesce(F.col("__n"), F.lit(0)).cast("double").alias(c) if x == c else F.col(f"`{x}`")
                             for x in df.columns])
    return df


def with_nominal(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Mark code columns as categories."""
    def marked(c: str, n: int):
        meta = {"ml_attr": {"type": "nominal", "num_vals": n, "name": c}}
        return F.col(c).cast("double").alias(c, metadata=meta)
    return df.withColumns({c: marked(c, n) for c, n in sizes.items()})


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The kept columns and one vector of all features."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df).select(*keep, "features")


def scores(model, df: DataFrame, features: Sequence[str], name: str, key: str = "raceid") -> DataFrame:
    """``(key, probability of class 1)``."""
    return model.transform(assembled(df, features, [key])).select(key, vector_to_array("probability")[1].alias(name))


def gbt_training_set(train: DataFrame, features: Sequence[str], categorical: Sequence[str], label: str = "flag",
                     key: str = "raceid", seed: int = 0) -> DataFrame:
    """Stratified 70/30 split; the 70 are balanced with synthetic rows, the 30 marked ``is_test``.

    The narrowed split is written, since it is read several times.
    """
    split = materialize(split_stratified(train.select(key, label, *features), label, key, 0.3, seed), "split", compiled=True)
    numeric = [c for c in features if c not in categorical]
    grown = smote(split.filter(~F.col("is_test")), label, key, numeric, categorical, seed=seed)
    kept = split.filter("is_test").select(*[F.col(c).cast(grown.schema[c].dataType).alias(c)
                                            for c in grown.columns if c != "synthetic"])
    return grown.drop("synthetic").withColumn("is_test", F.lit(False)).unionByName(
        kept.withColumn("is_test", F.lit(True)))


def _gbt(label: str, rounds: int, bins: int, seed: int, depth: int, rate: float) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate,
                         maxBins=max(32, bins), seed=seed)


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(index of the lowest loss before ``patience`` rounds brought no lower one, whether they did not)."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def first_trees(model: GBTClassificationModel, number: int) -> GBTClassificationModel:
    """The model after its first rounds."""
    if number >= model.getNumTrees:
        return model
    context = SparkContext._active_spark_context
    old, gateway, jvm = model._java_obj, context._gateway, context._jvm
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, number)
    weights = gateway.new_array(jvm.double, number)
    for i in range(number):
        trees[i], weights[i] = old.trees()[i], float(old.treeWeights()[i])
    new = jvm.org.apache.spark.ml.classification.GBTClassificationModel(old.uid(), trees, weights, old.numFeatures(), 2)
    for name in ("featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
        new.set(new.getParam(name), old.getOrDefault(old.getParam(name)))
    return GBTClassificationModel(new)


def with_patience(fit: Callable[[int], GBTClassificationModel], valid: DataFrame, rounds: int, patience: int,
                  cut: Callable = first_trees) -> GBTClassificationModel:
    """The model of the best round on the valid rows; boosting ends ``patience`` rounds after it.

    The learner can't go on with a model, but repeats the same first trees: twice ``patience`` rounds are tried first,
    then all. Without valid rows all rounds count.
    """
    if valid.isEmpty():
        return fit(rounds)
    for tried in sorted({min(rounds, 2 * patience), rounds}):
        model = fit(tried)
        best, ended = best_round(model.evaluateEachIteration(valid), patience)
        if ended:
            break
    return cut(model, best + 1)


def fit_gbt(train: DataFrame, features: Sequence[str], sizes: dict[str, int] | None = None, label: str = "flag",
            rounds: int = 100, seed: int = 0, depth: int = 5, rate: float = 0.1, patience: int = 10) -> GBTClassificationModel:
    """Boosted trees, cut at the round with the lowest loss on the ``is_test`` rows.

    The learner reads its input several times, so the assembled vectors are written first. ``sizes`` are
    the code columns to be treated as categories, with their numbers of codes.
    """
    sizes = sizes or {}
    data = materialize(assembled(with_nominal(train, sizes), features, [label, "is_test"]), "vectors")
    learn, bins = data.filter(~F.col("is_test")), max(sizes.values(), default=0)
    return with_patience(lambda n: _gbt(label, n, bins, seed, depth, rate).fit(learn), data.filter("is_test"), rounds, patience)


def score_gbt(train: DataFrame, pred: DataFrame, features: Sequence[str], categorical: Sequence[str] = (),
              label: str = "flag", key: str = "raceid", rounds: int = 100, seed: int = 0, depth: int = 5,
              rate: float = 0.1, counted: Sequence[str] = ()) -> DataFrame:
    """Train on labelled rows and return ``(key, gbm_pred)`` for the others.

    ``categorical`` are code columns with few values, which are split by category; ``counted`` code columns of
    many values, which enter as their number of training rows. Which is which does not depend on the data.
    """
    model, _, used, counts = trained_gbt(train, features, categorical, label, key, rounds, seed, depth, rate, counted)
    return scores(model, with_frequencies(pred, counts, train), used, "gbm_pred", key)


def _balanced(train: DataFrame, features: Sequence[str], categorical: Sequence[str], label: str, key: str, seed: int,
              counted: Sequence[str]) -> tuple[DataFrame, dict[str, int], list[str]]:
    """(balanced rows with the held-out ones marked ``is_test``, sizes of the code columns, the counted ones)."""
    counted = [c for c in counted if c in features]
    categorical = [c for c in categorical if c in features and c not in counted]
    own = with_frequencies(train, counted, train)
    return materialize(gbt_training_set(own, features, categorical, label, key, seed), "balanced"), code_sizes(
        own, categorical), counted


def trained_gbt(train: DataFrame, features: Sequence[str], categorical: Sequence[str] = (), label: str = "flag",
                key: str = "raceid", rounds: int = 100, seed: int = 0, depth: int = 5, rate: float = 0.1,
                counted: Sequence[str] = ()) -> tuple[GBTClassificationModel, DataFrame, list[str], list[str]]:
    """(trees, the balanced rows with the held-out ones marked ``is_test``, the features, the counted ones)."""
    data, sizes, counted = _balanced(train, features, categorical, label, key, seed, counted)
    return fit_gbt(data, features, sizes, label, rounds, seed, depth, rate), data, list(features), counted


class Searched(NamedTuple):
    """What a search found: the trees of the best setting, and that setting."""
    bestModel: GBTClassificationModel
    depth: int
    rate: float


def tune_gbt(train: DataFrame, features: Sequence[str], categorical: Sequence[str] = (), label: str = "flag",
             rounds: int = 27, depths: Sequence[int] = (3, 4, 5, 6), rates: Sequence[float] = (0.05, 0.1, 0.2, 0.3),
             seed: int = 0, parallelism: int = 4, counted: Sequence[str] = (), key: str = "raceid") -> tuple[Searched, DataFrame]:
    """Search depth and step size by successive halving on the rows the final fit uses.

    All settings are fitted to the balanced rows with a few rounds and judged by the area under ROC on the held-out
    rows; the best third goes on with three times the rounds, until those left have all ``rounds``. Also returns
    ``(depth, rate, rounds, score)`` of every setting, as last judged.
    """
    data, sizes, _ = _balanced(train, features, categorical, label, key, seed, counted)
    data = materialize(assembled(with_nominal(data, sizes), features, [label, "is_test"]), "vectors")
    learn, valid = data.filter(~F.col("is_test")), data.filter("is_test")
    judge, bins = BinaryClassificationEvaluator(labelCol=label), max(sizes.values(), default=0)
    alive, judged, best = list(product(depths, rates)), {}, None
    budget, few = [rounds], len(alive)
    while few > 3 and budget[0] > 3:
        budget, few = [-(-budget[0] // 3), *budget], -(-few // 3)

    def one(setting: tuple[int, float], n: int) -> tuple[float, GBTClassificationModel]:
        model = _gbt(label, n, bins, seed, *setting).fit(learn)
        return judge.evaluate(model.transform(valid)), model
    for n in budget:
        with ThreadPoolExecutor(parallelism) as pool:
            got = list(pool.map(lambda s, n=n: one(s, n), alive))
        order = sorted(range(len(alive)), key=lambda i: (-got[i][0], i))
        judged |= {s: (n, score) for s, (score, _) in zip(alive, got, strict=True)}
        best = Searched(got[order[0]][1], *alive[order[0]])
        alive = [alive[i] for i in order[:-(-len(alive) // 3)]]
    rows = [(int(d), float(r), int(n), float(score)) for (d, r), (n, score) in judged.items()]
    return best, train.sparkSession.createDataFrame(rows, "depth int, rate double, rounds int, score double")


def fit_network(train: DataFrame, features: Sequence[str], label: str = "flag", key: str = "raceid",
                layers: Sequence[int] = (32, 16), iterations: int = 100, seed: int = 0,
                linear: bool = False, valid: DataFrame | None = None, chunk: int = 20, patience: int = 3):
    """A dense network on class-balanced rows, or a class-weighted logistic regression.

    The network learner takes no weights, so the smaller class is repeated instead. With ``valid`` rows (assembled)
    the network is trained in chunks of iterations, each from the weights of the last one. Training ends when
    ``patience`` chunks have not enlarged the precision-recall area on these rows, and the best weights count.
    """
    if linear:
        weighted = assembled(with_class_weight(train, label, "class_weight"), features, [label, "class_weight"])
        learner = LogisticRegression(labelCol=label, featuresCol="features", weightCol="class_weight", maxIter=iterations)
        return learner.fit(materialize(weighted, "vectors"))
    balanced = materialize(balanced_by_copies(assembled(train, features, [key, label]), label, key), "vectors")
    learner = MultilayerPerceptronClassifier(labelCol=label, featuresCol="features", seed=seed,
                                             layers=[len(features), *layers, 2], blockSize=256)
    if valid is None or valid.isEmpty():
        return learner.setMaxIter(iterations).fit(balanced)
    judge, left, idle = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR"), iterations, 0
    best, reached = None, float("-inf")
    while left > 0 and idle < patience:
        model = learner.setMaxIter(min(chunk, left)).fit(balanced)
        learner.setInitialWeights(model.weights)
        left -= chunk
        area = judge.evaluate(model.transform(valid))
        idle = 0 if area > reached else idle + 1
        best, reached = (model, area) if area > reached else (best, reached)
    return best


def network_parts(train: DataFrame, features: Sequence[str], label: str = "flag", key: str = "raceid",
                  seed: int = 0) -> DataFrame:
    """Labelled rows with features limited to [-5, 5] and their part: 20 % test, 16 % valid, the rest train."""
    narrow = split_random(train, key, seed=seed).select(key, label, "part", *features)
    return materialize(clip(narrow, features), "parts")


def chosen_network(parts: DataFrame, features: Sequence[str], label: str = "flag", key: str = "raceid",
                   layers: Sequence[int] = (32, 16), iterations: int = 100, seed: int = 0):
    """The network or the linear model, whichever has the larger precision-recall area on the valid rows."""
    train, valid = parts.filter("part = 'train'"), assembled(parts.filter("part = 'valid'"), features, [label])
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    fitted = [fit_network(train, features, label, key, layers, iterations, seed, linear, valid) for linear in (False, True)]
    return max(fitted, key=lambda m: judge.evaluate(m.transform(valid)))


def score_network(train: DataFrame, pred: DataFrame, features: Sequence[str], label: str = "flag",
                  key: str = "raceid", layers: Sequence[int] = (32, 16), iterations: int = 100, seed: int = 0,
                  linear: bool | None = None) -> DataFrame:
    """Train on 64 % of the labelled rows; returns ``(key, tf_pred)``.

    ``linear`` fixes the kind of model; by default the valid rows choose it.
    """
    parts = network_parts(train, features, label, key, seed)
    if linear is None:
        model = chosen_network(parts, features, label, key, layers, iterations, seed)
    else:
        valid = assembled(parts.filter("part = 'valid'"), features, [label])
        model = fit_network(parts.filter("part = 'train'"), features, label, key, layers, iterations, seed, linear, valid)
    return scores(model, clip(pred, features), features, "tf_pred", key)
