"""Feature reports: variance, mutual information and wrapper searches with random forests."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations
from statistics import mean, stdev

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.numeric import digamma, finite_or_null, keyed_hash
from furlong.operators.encode import stratified_folds
from furlong.operators.joins import lookup
from furlong.operators.ordering import HOT_ROWS, exact_quantiles, preceding_windows, running_sums
from furlong.operators.scoring import assembled
from furlong.session import compiled_methods, materialize

REPORT = "feature string, kept boolean, score double"
MAX_SUBSETS = 1024
TIE_BITS = 16

#: 99 % points of Student's distribution for 2 to 9 degrees of freedom (3 to 10 folds).
STUDENT = {3: 6.965, 4: 4.541, 5: 3.747, 6: 3.365, 7: 3.143, 8: 2.998, 9: 2.896, 10: 2.821}


def variance_report(df: DataFrame, features: Sequence[str], low: float = 0.001) -> DataFrame:
    """``(feature, kept, variance, low)``: population variance; constant features are not kept.

    The one row of all statistics is written.
    """
    wide = df.agg(*[F.var_pop(c).alias(f"v_{c}") for c in features],
                  *[F.min(c).cast("double").alias(f"a_{c}") for c in features],
                  *[F.max(c).cast("double").alias(f"b_{c}") for c in features])
    wide = materialize(wide, "statistics", compiled=True)
    records = F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), (F.col(f"b_{c}") > F.col(f"a_{c}")).alias("kept"),
        F.col(f"v_{c}").alias("variance")) for c in features]))
    rows = wide.select(records.alias("r")).select("r.*")
    return rows.withColumn("low", F.col("variance") < low)


def binned(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """``(feature, bin, label)``: each value's bin between the feature's exact quantiles.

    The quantiles (at most ``bins - 1`` per feature) are fitted first and become literals.
    """
    shares = [i / bins for i in range(1, bins)]
    edges: dict[str, set[float]] = {c: set() for c in features}
    for r in exact_quantiles(df, features, shares).collect():
        edges[r["feature"]].add(r["value"])

    def bin_of(c: str) -> Column:
        out = F.lit(0)
        for e in sorted(edges[c]):
            out = out + (F.col(c) > F.lit(e)).cast("int")
        return out
    wide = df.select(F.col(label).alias("label"), *[bin_of(c).alias(c) for c in features])
    return wide.unpivot(["label"], list(features), "feature", "bin").filter(F.col("bin").isNotNull())


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10, k: int = 2) -> DataFrame:
    """``(feature, kept, score)``: information in nats between quantile bins and label; the k best are kept.

    The label itself is not a candidate. Ties are broken by name.
    """
    with compiled_methods(df.sparkSession):
        cells = binned(df, [c for c in features if c != label], label, bins).groupBy("feature", "bin", "label").agg(
            F.count("*").alias("n"))
        # From here on the table has at most features x bins x labels rows.
        cells = materialize(cells, "cells")
    whole, by_bin, by_label = (Window.partitionBy("feature"), Window.partitionBy("feature", "bin"),
                               Window.partitionBy("feature", "label"))
    parts = cells.select("feature", "n", F.sum("n").over(whole).alias("all"), F.sum("n").over(by_bin).alias("nb"),
                         F.sum("n").over(by_label).alias("nl"))
    term = F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("nb") * F.col("nl")))
    scored = parts.groupBy("feature").agg(F.sum(term).alias("score"))
    rank = F.row_number().over(Window.orderBy(F.desc(F.round("score", 9)), "feature"))    # one row per feature
    return scored.select("feature", (rank <= k).alias("kept"), "score")


def neighbour_information(df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 2, neighbours: int = 3,
                          digits: int = 6, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(feature, kept, score)``: nearest-neighbour information in nats between numbers and a class label.

    A row's radius is the distance to its third nearest row of the same label. If ``m`` rows of any label lie within
    it, the estimate is ``psi(n) + mean(psi(3)) - mean(psi(rows of the label)) - mean(psi(m))``, not below 0. Values
    are taken with ``digits`` decimals; rows with equal values are set apart by less than that, by a hash of the
    unique ``key``, so that distances are whole numbers and the result does not depend on the order of rows. Their size
    is bounded by 1.4e14 / 10**digits, beyond which the cast fails. Null, infinite and NaN values take no part, nor does
    a label's only row. The label itself is not a candidate; the k best are kept, ties broken by name.

    Neighbours come from windows over sorted pieces. Counts within a radius are differences of running counts at
    its two ends, which are sorted among the rows.
    """
    names = [c for c in features if c != label]
    tie = F.conv(F.substring(keyed_hash(key, 0), 1, TIE_BITS // 4), 16, 10).cast("long")

    def place(c: str) -> Column:
        return F.rint(finite_or_null(F.col(c).cast("double")) * 10.0 ** digits).cast("long") * (1 << TIE_BITS) + tie
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), *[place(c).alias(c) for c in names])
    rows = rows.unpivot(["key", "label"], names, "feature", "z").filter("z IS NOT NULL AND label IS NOT NULL")
    rows = materialize(rows, "points", compiled=True)
    sizes = rows.groupBy("feature", "label").agg(F.count("*").alias("nl")).filter("nl > 1")
    sized = lookup(rows, sizes, ["feature", "label"], "inner")

    def radius(w) -> dict[str, Column]:
        apart = [F.col("z") - F.lag("z", i).over(w) for i in range(1, neighbours + 1)]
        apart += [F.lead("z", i).over(w) - F.col("z") for i in range(1, neighbours + 1)]
        return {"near": F.array_sort(F.array_compact(F.array(*apart)))}
    wide = preceding_windows(sized, ["feature", "label"], ["z", "key"], radius, neighbours, hot_rows, keys_from=rows,
                             ahead=neighbours)
    used = F.least(F.lit(neighbours), F.col("nl") - 1)
    # Rows closer than the last neighbour count, or those at the same place if that neighbour is there too.
    reach = F.greatest(F.element_at("near", used.cast("int")) - 1, F.lit(0))
    points = materialize(wide.select("feature", "key", "z", "nl", used.alias("used"), reach.alias("reach")), "radii")
    marks = points.select("feature", "key", F.explode(F.array(
        F.struct((F.col("z") - F.col("reach")).alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("n")),
        F.struct(F.col("z").alias("at"), F.lit(1).alias("kind"), F.lit(1).alias("n")),
        F.struct((F.col("z") + F.col("reach")).alias("at"), F.lit(2).alias("kind"), F.lit(0).alias("n")))).alias("e")).select(
        "feature", "key", "e.*")
    upto = running_sums(marks, ["feature", "at", "kind", "key"], {"upto": "n"}).filter("kind <> 1")
    within = upto.groupBy("feature", "key").agg(F.sum(F.col("upto") * (F.col("kind") - 1)).alias("m"))
    counted = within.groupBy("feature").agg(F.avg(digamma(F.col("m"))).alias("psi_m"))
    means = points.groupBy("feature").agg(
        F.count("*").alias("n"), F.avg(digamma(F.col("used"))).alias("psi_k"), F.avg(digamma(F.col("nl"))).alias("psi_l"))
    found = means.join(counted, "feature").select("feature", F.greatest(
        digamma(F.col("n")) + F.col("psi_k") - F.col("psi_l") - F.col("psi_m"), F.lit(0.0)).alias("score"))
    rank = F.row_number().over(Window.orderBy(F.desc(F.round("score", 9)), "feature"))    # one row per feature
    return found.select("feature", (rank <= k).alias("kept"), "score")


def top_features(report: DataFrame, k: int, score: str = "score") -> DataFrame:
    return report.orderBy(F.desc(score), "feature").limit(k)


def sorted_report(report: DataFrame, score: str = "score", ascending: bool = True) -> DataFrame:
    return report.orderBy(F.asc(score) if ascending else F.desc(score), "feature")


class ForestScorer:
    """Cross-validated accuracy of a random forest on feature subsets of one written table.

    The table holds the fold of every row, so that all subsets are compared on the same folds. Fits are
    Spark jobs; up to ``parallelism`` of them are submitted at once.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, key: str, folds: int = 5, trees: int = 20,
                 depth: int = 5, seed: int = 0, parallelism: int = 4):
        narrow = df.select(key, F.col(label).cast("double").alias(label), *[
            F.col(c).cast("double").alias(c) for c in features]).dropna("any")
        narrow = materialize(narrow, "candidates")
        self.data = materialize(stratified_folds(narrow, label, key, folds, seed), "folds")
        self.label, self.folds, self.parallelism = label, folds, parallelism
        sizes = dict(self.data.groupBy("fold").count().collect())
        self.sizes = [sizes.get(f, 0) for f in range(folds)]
        self.forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth,
                                             seed=seed)
        self.evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")

    def fit(self, features: Sequence[str], without_fold: int | None = None):
        rows = self.data if without_fold is None else self.data.filter(F.col("fold") != without_fold)
        return self.forest.fit(assembled(rows, features, [self.label]))

    def evaluate(self, model, features: Sequence[str], fold: int) -> float:
        rows = self.data.filter(F.col("fold") == fold)
        return self.evaluator.evaluate(model.transform(assembled(rows, features, [self.label])))

    def fold_score(self, features: Sequence[str], fold: int) -> float:
        return self.evaluate(self.fit(features, fold), features, fold)

    def run(self, function, items: Sequence) -> list:
        with ThreadPoolExecutor(self.parallelism) as pool:
            return list(pool.map(function, items))

    def subsets(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        """Mean accuracy over the folds for each subset."""
        jobs = [(s, f) for s in subsets for f in range(self.folds)]
        got = self.run(lambda job: self.fold_score(*job), jobs)
        return [sum(got[i * self.folds:(i + 1) * self.folds]) / self.folds for i in range(len(subsets))]

    def race(self, subsets: Sequence[Sequence[str]], slack: float = 2.0) -> list[float | None]:
        """Mean accuracy over the folds of each subset that may be the best, None for those that left on the way.

        All start on the first fold. After each fold those leave whose gap to the leader is clear: above ``slack``
        standard errors of a difference of two shares of the rows tested so far, or, from the third fold on,
        above the 99 % bound of the paired differences. Subsets that stay are tested on all folds.
        """
        seen: list[list[float]] = [[] for _ in subsets]
        left = list(range(len(subsets)))
        for fold in range(self.folds):
            for i, score in zip(left, self.run(lambda i: self.fold_score(subsets[i], fold), left)):
                seen[i].append(score)
            lead = max(left, key=lambda i: (mean(seen[i]), -i))
            left = [i for i in left if not self._behind(seen[i], seen[lead], slack)]
        return [mean(s) if i in left else None for i, s in enumerate(seen)]

    def _behind(self, own: list[float], lead: list[float], slack: float) -> bool:
        gaps = [a - b for a, b in zip(lead, own)]
        share, tested = mean(lead), max(1, sum(self.sizes[:len(own)]))
        bound = slack * math.sqrt(2 * share * (1 - share) / tested)
        if len(gaps) >= 3:
            bound = min(bound, STUDENT.get(len(gaps), STUDENT[10]) * stdev(gaps) / math.sqrt(len(gaps)))
        return mean(gaps) > bound

    def best(self, subsets: Sequence[Sequence[str]], racing: bool, last: bool = False) -> tuple[int, float]:
        """The subset with the highest score and that score; the first of equal ones, or the last."""
        got = self.race(subsets) if racing else self.subsets(subsets)
        at = max((i for i, v in enumerate(got) if v is not None), key=lambda i: (got[i], i if last else -i))
        return at, got[at]


def importances(model, features: Sequence[str]) -> dict[str, float]:
    return dict(zip(features, model.featureImportances.toArray().tolist()))


def forward_selection(scorer: ForestScorer, features: Sequence[str], select: int, racing: bool = True) -> DataFrame:
    """Add the feature that scores best with those chosen so far, until ``select`` are chosen.

    With ``racing``, candidates that are clearly worse leave a step before they were tested on all folds.
    """
    chosen: list[str] = []
    reached: dict[str, float] = {}
    while len(chosen) < min(select, len(features)):
        left = [c for c in features if c not in chosen]
        at, reached[left[at]] = scorer.best([[*chosen, c] for c in left], racing)
        chosen.append(left[at])
    return _report(scorer, [(c, c in chosen, reached.get(c)) for c in features])


def backward_selection(scorer: ForestScorer, features: Sequence[str], select: int, racing: bool = True) -> DataFrame:
    """Remove the feature whose absence scores best, until ``select`` are left; ``racing`` as in the forward search."""
    left = list(features)
    reached: dict[str, float] = {}
    while len(left) > max(select, 1):
        at, score = scorer.best([[c for c in left if c != out] for out in left], racing, last=True)
        reached[left.pop(at)] = score
    return _report(scorer, [(c, c in left, reached.get(c)) for c in features])


def _eliminate(features: Sequence[str], fit, stop: int, share: float, single: int, visit=None) -> list[list[str]]:
    """Drop the least important features again and again; returns the steps' dropped ones, first dropped first.

    A step drops ``share`` of the features left, but one by one from ``single`` features on.
    """
    left, steps = list(features), []
    while True:
        model = fit(left)
        if visit:
            visit(left, model)
        if len(left) <= stop:
            return steps
        n = 1 if len(left) <= single else max(1, min(int(share * len(left)), len(left) - single))
        weight = importances(model, left)
        steps.append(sorted(left, key=lambda c: (weight[c], -left.index(c)))[:min(n, len(left) - stop)])
        left = [c for c in left if c not in steps[-1]]


def recursive_elimination(scorer: ForestScorer, features: Sequence[str], least: int = 1, share: float = 0.0,
                          single: int = 10) -> DataFrame:
    """``(feature, kept, ranking)``: eliminate by importance; the number kept is the one that scores best.

    Each step is one fit per fold and drops ``share`` of the features left; the last ``single`` go one by one.
    Ranking is 1 for kept features and grows by one with every step a feature was dropped earlier.
    """
    def one_fold(fold: int) -> dict[int, float]:
        found: dict[int, float] = {}

        def visit(left, model):
            found[len(left)] = scorer.evaluate(model, left, fold)
        _eliminate(features, lambda left: scorer.fit(left, fold), least, share, single, visit)
        return found
    per_fold = scorer.run(one_fold, range(scorer.folds))
    reached = {n: mean(f[n] for f in per_fold) for n in per_fold[0]}
    best = max(sorted(reached), key=lambda n: reached[n])
    steps = _eliminate(features, scorer.fit, best, share, single)
    rank = {c: len(steps) - i + 1 for i, step in enumerate(steps) for c in step}
    rows = [(c, c not in rank, rank.get(c, 1)) for c in features]
    return scorer.data.sparkSession.createDataFrame(rows, "feature string, kept boolean, ranking int")


def subset_search(scorer: ForestScorer, features: Sequence[str], least: int, most: int) -> DataFrame:
    """``(features, size, score)`` of every subset of ``least`` to ``most`` features, best first.

    The number of subsets grows exponentially; more than 1,024 of them are refused.
    """
    subsets = [s for n in range(least, most + 1) for s in combinations(features, n)]
    if len(subsets) > MAX_SUBSETS:
        raise ValueError(f"{len(subsets)} subsets; narrow the candidates first")
    rows = [(",".join(s), len(s), float(v)) for s, v in zip(subsets, scorer.subsets(subsets))]
    spark = scorer.data.sparkSession
    return spark.createDataFrame(rows, "features string, size int, score double").orderBy(F.desc("score"), "features")


def _report(scorer: ForestScorer, rows: list) -> DataFrame:
    return scorer.data.sparkSession.createDataFrame(rows, REPORT)
