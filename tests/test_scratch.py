"""Scratch goes with its scope: folders, bucketed tables, nested, and also after a failure."""

import os

import pytest
from pyspark.sql import functions as F

from furlong import session as S


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr(S, "shared_dir", lambda spark: str(tmp_path))
    return str(tmp_path)


def files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names]


def test_a_scope_deletes_its_folders_and_tables(spark, shared):
    with S.scratch_scope(spark):
        outer = S.materialize(spark.range(10), "outer")
        with S.scratch_scope(spark):
            inner = S.materialize(outer.withColumn("x", F.col("id") * 2), "inner")
            assert inner.count() == 10
            spark.range(5).write.bucketBy(2, "id").option("path", S.scratch_path(spark, "table")).saveAsTable("scoped")
            S.own_table(spark, "scoped")
        assert not spark.catalog.tableExists("scoped")
        assert outer.count() == 10 and files(shared)
    assert not files(shared)


def test_a_failure_leaves_nothing_behind(spark, shared):
    with pytest.raises(ZeroDivisionError):
        with S.scratch_scope(spark), S.scratch_scope(spark):
            S.materialize(spark.range(10), "table")
            raise ZeroDivisionError
    assert not files(shared)
    assert S._open_scopes(spark) == []


def test_what_is_kept_outlives_its_scope_alone(spark, shared):
    made = []

    def build():
        made.append(S.materialize(spark.range(100), "inner"))
        return made[0].filter("id % 2 = 0")
    with S.scratch_scope(spark):
        result = S.kept(spark, build, "result")
        assert result.count() == 50
        assert all("/result-" in f for f in files(shared))
    assert not files(shared)


def test_an_end_to_end_run_keeps_its_feature_table_and_report_alone(spark, shared, monkeypatch):
    from furlong.plans import predict
    monkeypatch.setattr(predict, "feature_table", lambda *a: S.materialize(spark.range(6).selectExpr("id AS raceid"), "features"))
    monkeypatch.setattr(predict, "gbm_scores", lambda f, c: S.materialize(f.selectExpr("raceid", "0.5D AS gbm_pred"), "gbm"))
    monkeypatch.setattr(predict, "network_scores", lambda f, c: S.materialize(f.selectExpr("raceid", "0.5D AS tf_pred"), "mlp"))
    monkeypatch.setattr(predict, "prediction_report", lambda f, g, t, *w: f.join(g, "raceid").join(t, "raceid"))
    report = predict.predict_end_to_end(spark, spark.range(2))
    assert report.count() == 6
    assert all("/report-" in f for f in files(shared))


def test_a_killed_write_and_a_changed_input_are_refused(spark, tmp_path):
    from furlong.sources import files as T
    path = T.checkpoint_path(str(tmp_path), "settings")
    with pytest.raises(T.NotFinished, match="no finished table"):
        T.load_table(spark, path)
    broken = spark.range(20).select(F.when(F.col("id") == 13, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        T.saved_or_built(spark, path, lambda: broken, resume=False)
    with pytest.raises(T.NotFinished, match="no finished table"):
        T.saved_or_built(spark, path, lambda: broken, resume=True)
    spark.range(5).write.parquet(f"{tmp_path}/in")
    before = T.input_fingerprint(spark.read.parquet(f"{tmp_path}/in"))
    assert before == T.input_fingerprint(spark.read.parquet(f"{tmp_path}/in").filter("id > 2"))
    assert T.saved_or_built(spark, path, lambda: spark.range(5), False, before).count() == 5
    with pytest.raises(Exception, match="killed"):
        T.saved_or_built(spark, path, lambda: broken, resume=False, inputs=before)
    assert T.saved_or_built(spark, path, lambda: broken, True, before).count() == 5     # the earlier one is still there
    spark.range(6).write.mode("append").parquet(f"{tmp_path}/in")
    with pytest.raises(T.NotFinished, match="another input"):
        T.saved_or_built(spark, path, lambda: broken, True, T.input_fingerprint(spark.read.parquet(f"{tmp_path}/in")))
    assert T.saved_or_built(spark, path, lambda: spark.range(7), False, before).count() == 7
    assert len([n for n in os.listdir(path) if n.startswith("data-")]) == 1
    os.rename(path, T.checkpoint_path(str(tmp_path), "others"))
    with pytest.raises(T.NotFinished, match="other settings"):
        T.load_table(spark, T.checkpoint_path(str(tmp_path), "others"))
    one, other = (spark.createDataFrame([(i,)], "x long") for i in (1, 2))
    assert T.input_fingerprint(one) != T.input_fingerprint(other)
