"""Encodings, components, sampling, models and searches on planted data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from furlong.operators import encode, neighbours, sampling, scoring, selection


def test_folds_are_balanced_and_encoding_is_by_hand(spark):
    rows = [(i, "ab"[i % 2], i % 4 // 2) for i in range(20)]
    df = encode.stratified_folds(spark.createDataFrame(rows, "id int, e string, y int"), "y", "id", 3)
    data = df.collect()
    for label in (0, 1):
        sizes = [sum(r.y == label and r.fold == f for r in data) for f in range(3)]
        assert sum(sizes) == 10 and max(sizes) - min(sizes) <= 1
    got = {r.id: r.enc for r in encode.out_of_fold(df, "e", "y", "enc").collect()}
    for r in data:
        others = [o.y for o in data if o.e == r.e and o.fold != r.fold]
        assert got[r.id] == pytest.approx(sum(others) / (len(others) + 1))
        assert 0 <= got[r.id] <= 1
    mean = {r.e: r.m for r in encode.entity_encoding(df, "e", "y", "m").collect()}
    for e in "ab":
        own = [got[r.id] for r in data if r.e == e]
        assert mean[e] == pytest.approx(sum(own) / len(own), abs=5.1e-4)


@pytest.mark.parametrize("scale", [False, True])
def test_components_agree_with_a_singular_value_decomposition(spark, scale):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 2)) @ rng.normal(size=(2, 5)) * 3 + rng.normal(size=5) * 10
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "e int, a double, b double, c double, d double, f double")
    got = np.array([list(r)[1:] for r in encode.principal_components(df, "e", ["p1", "p2"], None, scale).orderBy("e").collect()])
    centred = x - x.mean(axis=0)
    if scale:
        centred = centred / x.std(axis=0, ddof=1)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    vt = vt[:2] * np.sign(vt[:2][np.arange(2), np.abs(vt[:2]).argmax(axis=1)])[:, None]
    assert np.allclose(got, centred @ vt.T, atol=1e-8)


def test_label_codes_are_in_text_order_and_split_hot_columns(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), (None, 100), ("b", 9)], "x string, y int")
    got = encode.label_encoded(df, ["x", "y"]).collect()
    assert [tuple(r) for r in got] == [(1, 0), (0, 2), (None, 1), (1, 2)]
    wide = spark.range(40).select(F.concat(F.lit("v"), F.lpad("id", 3, "0")).alias("x"))
    codes = {r.value: r.code for r in encode.label_codes(wide, ["x"], hot_rows=10).collect()}
    assert codes == {f"v{i:03}": i for i in range(40)}


def test_one_hot_of_null_is_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, c string")
    assert [tuple(r) for r in encode.one_hot(df, ["c"]).orderBy("id").collect()] == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]


def test_splits_cover_and_do_not_overlap(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    parts = {r.part: r.n for r in sampling.split_random(df, "id").groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sum(parts.values()) == 1000 and abs(parts["test"] - 200) < 60 and abs(parts["valid"] - 160) < 60
    tests = sampling.split_stratified(df, "y", "id").filter("is_test").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in tests} == {0: 240, 1: 60}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert {r.y: r.weight for r in sampling.class_weights(df, "y").collect()} == {0: pytest.approx(4 / 6), 1: 2.0}
    copies = sampling.balanced_by_copies(df.withColumn("id", F.monotonically_increasing_id()), "y", "id")
    assert {r.y: r["count"] for r in copies.groupBy("y").count().collect()} == {0: 6, 1: 6}


@pytest.mark.parametrize("reach", [40, 3])
def test_synthetic_rows_balance_and_stay_on_the_line(spark, reach):
    rows = [(i, 0, float(i), 0.0, 7) for i in range(120)] + [(1000 + i, 1, float(i), 2.0 * i, i % 3) for i in range(35)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c int")
    out = sampling.smote(df, "y", "id", ["a", "b"], ["c"], reach=reach)
    data = out.collect()
    assert sum(r.y == 0 for r in data) == sum(r.y == 1 for r in data) == 120
    made = [r for r in data if r.synthetic]
    assert len(made) == 85 and all(r.id is None and r.y == 1 and r.c in (0, 1, 2) for r in made)
    assert all(r.b == pytest.approx(2 * r.a) and 0 <= r.a <= 34 for r in made)
    assert sorted(tuple(r)[:5] for r in data if not r.synthetic) == sorted(rows)
    again = sampling.smote(df.repartition(7), "y", "id", ["a", "b"], ["c"], reach=reach)
    assert sorted(r.a for r in again.filter("synthetic = 1").collect()) == sorted(r.a for r in made)


def test_synthetic_neighbours_are_among_the_nearest(spark):
    rows = [(i, 0, 0.0) for i in range(60)] + [(100 + i, 1, float(2 ** i)) for i in range(10)]
    out = sampling.smote(spark.createDataFrame(rows, "id long, y int, a double"), "y", "id", ["a"], neighbours=1)
    points = [2.0 ** i for i in range(10)]
    nearest = [min((q for q in points if q != p), key=lambda q: abs(p - q)) for p in points]
    spans = [tuple(sorted(s)) for s in zip(points, nearest)]
    for r in out.filter("synthetic = 1").collect():
        assert any(lo <= r.a <= hi for lo, hi in spans)


def test_rare_class_spreads_over_all_tasks(spark):
    rows = spark.range(2000).select(F.col("id"), (F.col("id") < 4).cast("int").alias("y"), F.col("id").cast("double").alias("a"))
    few = rows.filter("y = 1").select("id", F.lit(1000).alias("n"))
    out = sampling.repeated(few, F.col("n"), 1000, "copy", chunk=10)
    assert out.count() == 4000 and out.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    made = sampling.smote(rows, "y", "id", ["a"])
    assert made.filter("synthetic = 1").count() == 1992 and made.filter("synthetic = 1 AND a BETWEEN 0 AND 3").count() == 1992


def test_two_labels_are_needed(spark):
    with pytest.raises(ValueError, match="two values"):
        sampling.smote(spark.createDataFrame([(1, 0, 1.0)], "id long, y int, a double"), "y", "id", ["a"])
    single = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (3, 1, 5.0)], "id long, y int, a double")
    assert [r.a for r in sampling.smote(single, "y", "id", ["a"]).filter("synthetic = 1").collect()] == [5.0]


def test_neighbours_are_found_at_any_size(spark):
    """Recall of exact neighbours with pieces and reach far below the number of rows."""
    points = np.random.default_rng(2).normal(size=(600, 3)).round(4)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, a double, b double, c double").repartition(4)
    near = {r.id: r.near for r in sampling.nearest_rows(df, "id", ["a", "b", "c"], 5, reach=25, directions=6, piece_rows=100).collect()}
    z = points / points.std(0)
    apart = ((z[:, None] - z[None]) ** 2).sum(2)
    np.fill_diagonal(apart, np.inf)
    hits = sum(len(set(near[i]) & set(np.argsort(apart[i])[:5].tolist())) for i in range(600))
    assert len(near) == 600 and hits / 3000 >= 0.9


@pytest.fixture(scope="module")
def planted(spark):
    """``good`` decides the label, ``half`` helps, the rest is noise."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        good, half, n1, n2 = (float(v) for v in rng.normal(size=4))
        rows.append((i, int(good + 0.3 * half > 0.4), good, half, n1, n2))
    return spark.createDataFrame(rows, "raceid long, flag int, good double, half double, n1 double, n2 double").cache()


FEATURES = ["good", "half", "n1", "n2"]


@pytest.mark.parametrize("score,name", [
    (lambda t: scoring.score_gbt(t, t, FEATURES, rounds=5), "gbm_pred"),
    (lambda t: scoring.score_network(t, t, FEATURES, layers=(6,), iterations=40), "tf_pred"),
    (lambda t: scoring.score_network(t, t, FEATURES, iterations=20, linear=True), "tf_pred")])
def test_models_find_the_planted_signal(planted, score, name):
    got = score(planted).join(planted, "raceid")
    area = BinaryClassificationEvaluator(rawPredictionCol=name, labelCol="flag").evaluate(got)
    assert got.count() == 600 and area > 0.93


def test_tuning_reports_every_setting(planted):
    model, table = scoring.tune_gbt(planted, FEATURES, rounds=2, depths=(1, 3), rates=(0.1,))
    assert sorted((r.depth, r.rate) for r in table.collect()) == [(1, 0.1), (3, 0.1)]
    assert model.bestModel is not None


def test_variance_and_information_reports(planted):
    df = planted.withColumn("same", F.lit(2.0))
    rows = {r.feature: r for r in selection.variance_report(df, [*FEATURES, "same"]).collect()}
    assert not rows["same"].kept and rows["same"].low and rows["good"].kept
    assert rows["good"].variance == pytest.approx(df.agg(F.var_pop("good")).first()[0])
    info = selection.mutual_information(df, [*FEATURES, "flag"], "flag").collect()
    assert {r.feature for r in info if r.kept} == {"good", "half"} and "flag" not in {r.feature for r in info}
    assert [r.feature for r in selection.top_features(selection.mutual_information(df, FEATURES, "flag"), 1).collect()] == ["good"]


def test_searches_keep_the_planted_feature(planted):
    scorer = selection.ForestScorer(planted, FEATURES[:3], "flag", "raceid", folds=2, trees=4, depth=3)
    for search in (selection.forward_selection, selection.backward_selection):
        kept = [r.feature for r in search(scorer, FEATURES[:3], 1).collect() if r.kept]
        assert kept == ["good"]
    rank = {r.feature: (r.kept, r.ranking) for r in selection.recursive_elimination(scorer, FEATURES[:3], 1).collect()}
    assert rank["good"] == (True, 1) and rank["n1"][1] >= rank["half"][1]
    best = selection.subset_search(scorer, FEATURES[:3], 1, 2).first()
    assert "good" in best.features
    with pytest.raises(ValueError):
        selection.subset_search(scorer, [str(i) for i in range(12)], 1, 12)


@pytest.mark.parametrize("rows,columns", [(200, 2), (6_000, 2), (6_000, 6)])
def test_neighbours_are_exact_with_default_parameters(spark, rows, columns):
    """Two sizes 30 times apart; a tenth of the rows lies on one spot."""
    points = np.random.default_rng(3).normal(size=(rows, columns)).round(4)
    points[: rows // 10] = points[0]
    names = [f"c{i}" for i in range(columns)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], f"id long, {', '.join(f'{c} double' for c in names)}")
    near = {r.id: r.near for r in sampling.nearest_rows(df.repartition(4), "id", names).collect()}
    assert len(near) == rows
    z = points / points.std(0).round(6)
    for i in range(0, rows, max(1, rows // 400)):
        apart = np.rint(((z[i] - z) ** 2).sum(1) * 1e7)
        apart[i] = np.inf
        want = np.sort(apart)[:5]
        assert i not in near[i] and len(set(near[i])) == 5 and np.abs(apart[near[i]] - want).max() <= 1
    assert near[3] == [0, 1, 2, 4, 5]


@pytest.mark.parametrize("rows", [2_000, 60_000])
def test_neighbours_in_sixty_columns(spark, rows):
    """Two sizes 30 times apart, with the default parameters; 60 columns that vary in ten directions, with noise."""
    rng = np.random.default_rng(1)
    points = (rng.normal(size=(rows, 10)) @ rng.normal(size=(10, 60)) + 0.3 * rng.normal(size=(rows, 60))).round(4)
    names = [f"c{i}" for i in range(60)]
    df = spark.createDataFrame(pd.DataFrame(points, columns=names).assign(id=np.arange(rows))).repartition(6)
    near = {r.id: r.near for r in neighbours.near_rows(df, "id", names).collect()}
    z, hits, asked = points / points.std(0), 0, range(0, rows, max(1, rows // 400))
    for i in asked:
        apart = ((z[i] - z) ** 2).sum(1)
        apart[i] = np.inf
        assert i not in near[i] and len(set(near[i])) == 5
        hits += len(set(near[i]) & set(np.argpartition(apart, 5)[:5].tolist()))
    assert len(near) == rows and hits / 5 / len(asked) >= 0.95


def test_neighbours_of_copies_ties_and_few_rows(spark):
    rows = [(i, 1.0, 2.0) for i in range(40)] + [(100, 1.5, 2.0), (101, 0.5, 2.0), (102, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double").withColumn("spot", F.lit(1)).repartition(3)
    near = {r.id: r.near for r in neighbours.near_rows(df, "id", ["a", "b"]).collect()}
    assert len(near) == 43 and near[3] == [0, 1, 2, 4, 5] and near[100] == [0, 1, 2, 3, 4]
    few = {r.id: r.near for r in neighbours.near_rows(df.filter("id >= 100"), "id", ["a", "b"]).collect()}
    assert few == {100: [101, 102], 101: [100, 102], 102: [100, 101]}
    one = neighbours.near_rows(df.filter("id = 102"), "id", ["a", "b"]).collect()
    assert [(r.id, r.near) for r in one] == [(102, [])]


def test_synthetic_rows_in_many_columns_stay_on_the_line(spark):
    rng = np.random.default_rng(8)
    names = [f"c{i}" for i in range(12)]
    few = rng.normal(size=(60, 1)) @ rng.normal(size=(1, 12))
    points = pd.DataFrame(np.vstack([few, rng.normal(size=(140, 12))]), columns=names).assign(id=np.arange(200), y=[1] * 60 + [0] * 140)
    made = sampling.smote(spark.createDataFrame(points), "y", "id", names).filter("synthetic = 1").toPandas()
    assert len(made) == 80 and np.linalg.matrix_rank(made[names].to_numpy(), tol=1e-6) == 1


class Rounds:
    def __init__(self, losses):
        self.losses = losses

    def evaluateEachIteration(self, valid):  # noqa: N802
        return self.losses


def test_boosting_goes_on_after_a_bad_round_and_ends_with_the_best(spark):
    losses = [9.0, 8.0, 8.5, 8.4, 8.3, 8.2, 8.1, 7.0, *[7.5] * 40, 1.0]
    assert scoring.best_round(losses, 10) == (7, True) and scoring.best_round(losses, 4) == (1, True)
    tried = []

    def fit(n):
        tried.append(n)
        return Rounds(losses[:n])
    best = scoring.with_patience(fit, spark.range(1), 49, 6, cut=lambda model, n: n)
    assert best == 8 and tried == [12, 49]
    assert scoring.with_patience(fit, spark.range(0), 5, 6, cut=lambda model, n: n).losses == losses[:5]


def test_trees_are_cut_at_a_round(planted):
    vectors = scoring.assembled(planted, FEATURES, ["raceid", "flag"])
    long, short = (scoring._gbt("flag", n, 0, 0, 3, 0.3).fit(vectors) for n in (8, 3))
    cut = scoring.first_trees(long, 3)
    assert cut.getNumTrees == 3 and long.evaluateEachIteration(vectors)[:3] == short.evaluateEachIteration(vectors)
    one, other = ({r.raceid: r.probability[1] for r in m.transform(vectors).collect()} for m in (cut, short))
    assert one == pytest.approx(other)


def test_the_network_stops_before_it_learns_the_rows_by_heart(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.random() < (0.8 if x[0] > 0 else 0.2)), *map(float, x)) for i, x in enumerate(rng.normal(size=(400, 8)))]
    names = [f"x{i}" for i in range(8)]
    df = spark.createDataFrame(rows, f"raceid long, flag int, {', '.join(f'{c} double' for c in names)}")
    learn, held = df.filter("raceid < 120"), scoring.assembled(df.filter("raceid >= 120"), names, ["flag"])
    kept = scoring.fit_network(learn, names, layers=(24,), iterations=400, valid=held, chunk=10, patience=2)
    judge = BinaryClassificationEvaluator(labelCol="flag", metricName="areaUnderPR")
    by_heart = scoring.fit_network(learn, names, layers=(24,), iterations=400)
    assert judge.evaluate(kept.transform(held)) >= judge.evaluate(by_heart.transform(held))


def test_halving_finds_the_planted_setting(spark):
    """The label is whether two signs agree, which trees of depth 1 can't tell."""
    rng = np.random.default_rng(7)
    rows = [(i, int(x[0] * x[1] > 0), *map(float, x)) for i, x in enumerate(rng.choice([-1.0, 1.0], (900, 4)) + rng.normal(size=(900, 4)) * 0.05)]
    df = spark.createDataFrame(rows, "raceid long, flag int, a double, b double, c double, d double")
    found, table = scoring.tune_gbt(df, ["a", "b", "c", "d"], rounds=9, depths=(1, 5), rates=(0.05, 0.1, 0.3))
    table = table.collect()
    assert len(table) == 6 and found.depth == 5
    assert max(r.rounds for r in table) == 9 and found.bestModel.getNumTrees == 9 and min(r.rounds for r in table) < 9


def test_racing_and_shares_choose_what_the_exact_searches_choose(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 9))
    flag = (x[:, 4] + 0.8 * x[:, 7] > 0).astype(int)
    names = [f"f{i}" for i in range(9)]
    rows = [(i, int(flag[i]), *map(float, x[i])) for i in range(900)]
    df = spark.createDataFrame(rows, "raceid long, flag int, " + ", ".join(f"{n} double" for n in names))
    scorer = selection.ForestScorer(df, names, "flag", "raceid", folds=3, trees=5, depth=4, parallelism=8)
    left = scorer.race([[n] for n in names])
    assert left[4] is not None and sum(v is None for v in left) >= 6
    kept = [[r.feature for r in selection.forward_selection(scorer, names, 2, racing).collect() if r.kept] for racing in (True, False)]
    assert kept[0] == kept[1] == ["f4", "f7"]
    few = [*names[3:6], "f7"]
    kept = [[r.feature for r in selection.backward_selection(scorer, few, 2, racing).collect() if r.kept] for racing in (True, False)]
    assert kept[0] == kept[1] == ["f4", "f7"]
    rank = {r.feature: r.ranking for r in selection.recursive_elimination(scorer, names, 1, 0.4, 4).collect()}
    assert rank["f4"] == rank["f7"] == 1
    assert sorted(rank.values()).count(max(rank.values())) == 3     # the first step drops three of nine features at once


def test_shares_go_down_to_the_single_phase_and_stop():
    class Flat:
        def __init__(self, n):
            self.featureImportances = type("V", (), {"toArray": lambda _: np.arange(n, dtype=float)})()
    sizes = []
    steps = selection._eliminate([str(i) for i in range(20)], lambda left: Flat(len(left)), 3, 0.3, 6,
                                 lambda left, _: sizes.append(len(left)))
    assert sizes == [20, 14, 10, 7, 6, 5, 4, 3] and [len(s) for s in steps] == [6, 4, 3, 1, 1, 1, 1]


def _information_by_brute_force(rows, neighbours=3):
    """The estimate over all pairs, with the operator's whole-numbered places."""
    import hashlib

    def psi(n):
        return sum(1 / i for i in range(1, n)) - 0.5772156649015329
    points = [(int(np.rint(v * 1e6)) * 65536 + int(hashlib.md5(f"0:{k}".encode()).hexdigest()[:4], 16), y)
              for k, y, v in rows if v is not None and np.isfinite(v) and y is not None]
    sizes = {y: sum(q == y for _, q in points) for _, y in points}
    points = [p for p in points if sizes[p[1]] > 1]
    total = 0.0
    for i, (z, y) in enumerate(points):
        near = sorted(abs(z - w) for j, (w, q) in enumerate(points) if q == y and j != i)
        k = min(neighbours, len(near))
        reach = max(near[k - 1] - 1, 0)
        total += psi(k) - psi(sizes[y]) - psi(sum(abs(z - w) <= reach for w, _ in points))
    return max(psi(len(points)) + total / len(points), 0.0)


@pytest.mark.parametrize("hot_rows", [10**6, 40])
def test_neighbour_information_agrees_with_all_pairs(spark, hot_rows):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        y = int(rng.integers(3))
        tied = float(rng.integers(4) + y)
        rows.append((i, y, float(rng.normal() + 2 * y), tied, float(rng.normal()),
                     None if i % 5 == 0 else float("nan") if i % 7 == 0 else 1.0))
    rows += [(300, 9, 0.5, 1.0, 0.1, 1.0), (301, None, 0.5, 1.0, 0.1, 1.0)]    # a label's only row, and one without a label
    df = spark.createDataFrame(rows, "id long, y int, apart double, tied double, noise double, same double")
    got = selection.neighbour_information(df, ["apart", "tied", "noise", "same", "y"], "y", "id", hot_rows=hot_rows)
    found = {r.feature: r for r in got.collect()}
    assert set(found) == {"apart", "tied", "noise", "same"} and {f for f, r in found.items() if r.kept} == {"apart", "tied"}
    for place, name in enumerate(("apart", "tied", "noise", "same"), 2):
        assert found[name].score == pytest.approx(_information_by_brute_force([(r[0], r[1], r[place]) for r in rows]), abs=1e-9)
    assert selection.neighbour_information(df.limit(0), ["apart"], "y", "id").collect() == []


def test_component_invariants_of_a_planted_matrix(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "e int, a double, b double, c double, d double")
    got = {r.invariant: r.value for r in encode.component_invariants(df, "e").collect()}
    c = np.cov(x.T)
    assert got["entities"] == 50 and got["mean"] < 1e-9 and got["cross"] < 1e-9
    for name, power in (("trace", 1), ("squares", 2), ("cubes", 3)):
        assert got[name] == pytest.approx(np.trace(np.linalg.matrix_power(c, power)))
