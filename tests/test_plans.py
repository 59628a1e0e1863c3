"""The two variants of the feature plan on hand-made entries."""

import contextlib
import io
import re
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong import config as C
from furlong.catalog import queries
from furlong.operators import evaluation, scoring
from furlong.plans import features as feature_plan
from furlong.plans.features import build_features, feature_table, finish_features
from furlong.session import materialize
from furlong.sources import files
from furlong.sources.entries import race_entries

PLACES = ("東京", "中山", "阪神")


@pytest.fixture(scope="module")
def raw(spark):
    """Six horses with one to seven races each, one race to predict, one race twice on a day."""
    rows, race = [], 0
    for h in range(6):
        for n in range(h + 2 if h else 1):
            race += 1
            ahead = h == 5 and n == 6
            rows.append((race, race, datetime(2020, 1, 1) + timedelta(days=7 * (n - (n == 3))), f"h{h}", f"j{h % 2}", "t",
                         f"f{h % 3}", f"g{h % 2}", None, "m", PLACES[race % 3], 1600 if race % 2 else 1200, "芝", "良", "晴",
                         "1勝", "牡", None, 8, 1, 1 + race % 5, 2.0 + race % 7, 55.0 + h, 999 if ahead else 1 + race % 5,
                         999.0 if ahead else 90.0 + race % 4, 999.0 if ahead else 34.0 + race % 3, 999 if ahead else 2,
                         999 if ahead else 3))
    schema = ", ".join(f"`{c}` {t}" for c, t in files.ENTRY_TYPES.items())
    return spark.createDataFrame(rows, schema)


def test_production_rows_and_leaks(raw):
    built = materialize(build_features(raw, C.PRODUCTION))
    # One row per entry, without each horse's first one; the first horse has no other.
    assert built.count() == raw.count() - 6
    assert built.select("raceid").distinct().count() == built.count()
    done = finish_features(built)
    assert not {"odds", "pop", "rentai", "count", "time", "3ftime", "rank3", "rank4"} & set(done.columns)
    ahead = done.filter("result = 999").first()
    assert ahead.flag == 0 and ahead["3ftimemax"] < 100 and ahead.speedmin > -1000 and ahead.resultmean < 10


def test_current_race_in_the_frame_leaks_on_request(raw):
    built = build_features(raw, replace(C.PRODUCTION, include_current=True))
    assert built.filter("result = 999").first()["3ftimemax"] == 999.0


def test_experiment_keeps_rows_and_adds_means(raw):
    config = replace(C.EXPERIMENT, history_before=datetime(2020, 2, 1))
    done = finish_features(materialize(build_features(raw, config)), config)
    assert done.count() == raw.count() - 6 and done.dropna("any").count() == done.count()


def test_profiles_use_only_rows_before_the_cut(spark, raw):
    config = replace(C.PRODUCTION, history_before=datetime(2020, 1, 20))
    shifted = raw.withColumn("result", F.when((F.col("days") >= F.lit(datetime(2020, 1, 20))) & (F.col("result") != 999), 1)
                             .otherwise(F.col("result")))
    names = ["raceid", *[p.encoding for p in config.profiles]]
    a, b = (sorted(map(tuple, build_features(df, config, components=False).select(*names).collect())) for df in (raw, shifted))
    assert a == b


def test_resume_reads_the_feature_table_of_the_same_settings(spark, raw, tmp_path):
    config = replace(C.PRODUCTION, history_before=datetime(2020, 2, 1))
    first = feature_table(spark, raw, config, str(tmp_path), "a")
    again = feature_table(spark, raw.limit(0), config, str(tmp_path), "a", resume=True)
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    with pytest.raises(Exception):
        feature_table(spark, raw, config, str(tmp_path), "b", resume=True)


def test_search_settings_reach_the_final_fit(monkeypatch, spark):
    from furlong.plans import predict
    seen = {}
    table = spark.createDataFrame([(3, 0.1, 0.6), (5, 0.3, 0.7)], "depth int, rate double, score double")
    monkeypatch.setattr(predict, "prep_gbm", lambda f: f)
    monkeypatch.setattr(predict.scoring, "tune_gbt", lambda *a, **k: (None, table))
    monkeypatch.setattr(predict.scoring, "score_gbt", lambda *a, **k: seen.update(k))
    rows = spark.createDataFrame([(1, 999, 0, 1.0), (2, 1, 1, 2.0)], "raceid long, result int, flag int, x double")
    predict.gbm_scores(rows, replace(C.PRODUCTION, gbm_search=True))
    assert (seen["depth"], seen["rate"], seen["rounds"]) == (5, 0.3, 100)


def explained(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_areas_join_nothing(spark, no_broadcast):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, s double")
    plan = explained(evaluation.area_metrics(df, "y", "s"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entries_are_dealt_by_race_once(spark, no_broadcast):
    plan = explained(race_entries(spark, "/root/testdata/sf0.001"))
    # One exchange of the rows and one of the orders; the numbering uses the partitioning of their join.
    assert len(re.findall(r"Exchange hashpartitioning\(race#\d+L?, \d", plan)) == 2


def test_every_feature_of_a_group_is_produced(spark):
    built = feature_plan.build_features(race_entries(spark, "/root/testdata/sf0.001"), queries.CONFIG)
    assert set(C.FEATURE_GROUPS["numeric"]) <= set(feature_plan.finish_features(built, queries.CONFIG).columns)


def test_trees_take_codes_alike_at_any_cardinality(spark):
    for n in (200, 300):
        rows = spark.range(600).select(F.col("id").alias("raceid"), (F.col("id") % n).cast("int").alias("trainer"),
                                       (F.col("id") % 2).cast("int").alias("place"))
        counted = scoring.with_frequencies(rows, ["trainer"], rows)
        assert counted.columns == rows.columns and dict(counted.dtypes)["trainer"] == "double"
        assert counted.agg(F.sum("trainer")).first()[0] == sum(c * c for c in np.bincount(np.arange(600) % n))
        assert scoring.code_sizes(rows, ["place", "trainer"]) == {"place": 2, "trainer": n}
