"""Hand-made frames with known answers for nulls, zeros, sentinels, ties and copies."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions import racing
from furlong.functions.numeric import clipped, ratio, rnd
from furlong.operators import aggregates, columns, evaluation, filters, report, values
from furlong.plans.clean import clean_entries, with_last_race_index, with_speed_index
from furlong.plans.features import derived, labelled
from furlong.session import materialize
from furlong.sources import files
from furlong.sources.entries import entry_key


def col(df, name):
    return [r[name] for r in df.collect()]


def test_complete_rows_are_filtered_again_without_a_condition_for_every_set_of_columns(spark):
    names = [f"c{i}" for i in range(12)]
    rows = [(i, *[None if i == j else float(i) for j in range(12)]) for i in range(14)]
    df = materialize(spark.createDataFrame(rows, ", ".join(["id int", *[f"{c} double" for c in names]])), "rows")
    done = filters.complete(values.filled_with_mean(df, names)).filter("id >= 2")
    again = done.select("id", *[F.col(c).cast("double").alias(c) for c in names]).filter("id < 13")
    assert again._jdf.queryExecution().optimizedPlan().validConstraints().size() < 500
    assert sorted(col(again, "id")) == list(range(2, 13))


def test_complete_rows_hold_neither_null_nor_nan(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, 2.0, None), (4, None, "c"), (None, 3.0, "d")],
                               "id int, `x.y` double, t string")
    assert col(filters.complete(df), "id") == [1]
    assert col(filters.complete_in(df, ["t"]), "id") == [1, 2, 4, None]


def test_filters_keep_or_drop_null(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 999), (4, 2)], "id int, result int")
    assert col(filters.not_excluded(df), "id") == [2, 3, 4]
    assert col(filters.in_closed_set(df, "result", [0, 2]), "id") == [1, 4]
    assert col(filters.to_predict(df), "id") == [3]
    assert col(filters.to_train(df), "id") == [1, 2, 4]
    assert col(filters.complete(df), "id") == [1, 3, 4]


def test_labels_and_sentinel(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 3, 4, 999)], "result int")
    assert col(labelled(df), "flag") == [0, 0, 1, 1, 0, 0]
    assert col(df.select(racing.binarized(F.col("result")).alias("r")), "r") == [None, 0, 1, 1, 0, 0]
    assert col(df.select(racing.placed(F.col("result")).alias("r")), "r") == [0, 1, 1, 1, 0, 0]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "v double")
    assert col(df.select(rnd(F.col("v"), 0).alias("v")), "v") == [0.0, 2.0, 2.0, 0.0, None]


def test_division_by_zero_and_clip(spark):
    df = spark.createDataFrame([(1, 0), (6, 4), (None, 2)], "a int, b int")
    assert col(df.select(ratio(F.col("a"), F.col("b")).alias("r")), "r") == [None, 1.5, None]
    assert col(df.select(clipped(F.col("a").cast("double"), -5.0, 5.0).alias("r")), "r") == [1.0, 5.0, None]


def test_finite(spark):
    df = spark.createDataFrame([(float("inf"),), (-math.inf,), (math.nan,), (None,), (2.0,)], "v double")
    assert col(values.finite(df, ["v"]), "v") == [0.0, 0.0, 0.0, 0.0, 2.0]
    assert col(values.finite(df, ["v"], None), "v") == [None, None, None, None, 2.0]


def test_distance_bands_and_unlisted_values(spark):
    df = spark.createDataFrame([(d,) for d in (*C.FLAT_DISTANCES, 1150, None)], "distance int")
    got = col(df.select(racing.distance_band(F.col("distance")).alias("b")), "b")
    assert got == ["sprint"] * 4 + ["mile"] * 3 + ["middle"] * 4 + ["stayer"] * 6 + ["1150", None]


def test_condition_and_class_index(spark):
    df = spark.createDataFrame([("芝", "良"), ("芝", "重"), ("ダ", "稍"), ("ダ", "重"), (None, "良")], "turf string, condition string")
    assert col(df.select(racing.condition_index().alias("i")), "i") == [-25, -5, -10, 0, 0]
    df = spark.createDataFrame([("新馬",), ("1600万",), ("オープン",), (None,)], "`class` string")
    assert col(df.select(racing.class_index().alias("i")), "i") == [0.8, 1.1, 1.2, 1.2]


def test_later_overwrite_wins(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "v int")
    out = racing.chain(F.lit("a"), [(F.col("v") > 3, F.lit("b")), (F.col("v") > 7, F.lit("c"))])
    assert col(df.select(out.alias("x")), "x") == ["a", "b", "c"]


ENTRY = {"raceid": 1, "racenum": 1, "days": datetime(2020, 1, 1), "horsename": "h", "jocky": "j", "trainer": "t",
         "father": "f", "fathermon": "g", "fathertype": None, "mother": "m", "place": "東京", "distance": 1600,
         "turf": "芝", "condition": "良", "weather": "晴", "class": "1勝", "sex": "牡", "legtype": None,
         "horsecount": 9, "horsenum": 1, "pop": 2, "odds": 4.0, "weight": 57.0, "result": 1, "time": 96.0,
         "3ftime": 34.0, "rank3": 1, "rank4": 1}


def entries(spark, *changes):
    schema = ", ".join(f"`{c}` {t}" for c, t in files.ENTRY_TYPES.items())
    rows = [tuple((ENTRY | {"raceid": i} | change).values()) for i, change in enumerate(changes, 1)]
    return spark.createDataFrame(rows, schema)


def test_cleaning(spark):
    df = entries(spark, {}, {"distance": 3570}, {"result": 0}, {"pop": None}, {"odds": None}, {"3ftime": None},
                 {"result": None, "class": "オープン", "legtype": "後方", "fathertype": "x"}, {"legtype": "中団"})
    got = {r.raceid: (r["class"], r.legtype, r.fathertype) for r in clean_entries(df).collect()}
    assert got == {1: ("500万", "自在", C.DEFAULT_SIRE_LINE), 7: ("オープン", "追込", "x"),
                   8: ("500万", "差し", C.DEFAULT_SIRE_LINE)}
    assert clean_entries(entries(spark, {"distance": 1150}), C.EXPERIMENT).count() == 1


def test_indices_by_hand(spark):
    df = clean_entries(entries(spark, {}, {"result": 2, "time": 98.0, "weight": None}, {"place": "札幌", "result": 5}))
    got = {r.raceid: r.speedindex for r in with_speed_index(df).collect()}
    # Base time of the two placed runs at the first course: 97.0.
    assert got == {1: pytest.approx(10 * (1 / 970 * 1000) - 25 + 4 + 80), 2: None, 3: None}
    filled = {r.raceid: r.speedindex for r in with_speed_index(df, impute=True).collect()}
    assert filled[2] == pytest.approx(-10 * (1 / 970 * 1000) - 25 + 4 + 80)
    got = {r.raceid: r.last_race_index for r in with_last_race_index(df).collect()}
    assert got[1] == pytest.approx(((18 - 2) + (18 - 1)) * 0.9)
    assert col(with_last_race_index(entries(spark, {"horsecount": 0})), "last_race_index") == [None]


def test_derived_zero_and_null(spark):
    names = ["distance", "pre_distance", "odds", "pop", "pre_odds", "pre_pop", "pre_rank3", "pre_rank4", "pre_result",
             "popmax", "popmin", "oddsmax", "oddsmin", "rentai5sum", "count5sum"]
    df = spark.createDataFrame([(1600, 1000, 6.0, 3, 8.0, 0, 0, 2, 4, 5, 1, 9.0, 2.5, 1, 3),
                                (1500, None, 6.0, 0, None, 2, 2, 3, 1, None, 1, 9.0, None, 0, 0)],
                               ", ".join(f"{n} {'double' if 'odds' in n else 'int'}" for n in names))
    a, b = derived(df).orderBy(F.desc("distance")).collect()
    assert (a.flag_konkan, a.flag_pre_konkan, a.odds_hi, a.re_odds_hi, a.re_3_to_4time_hi_sq) == (1, 0, 2.0, 0.0, 0.0)
    assert (a.odds_hi_sq, a.re_3_to_4time, a.re_pop_now_pop, a.re_result_to_pop, a.rentai_ritu) == (4.0, 2.0, -3.0, 4.0, 0.333)
    assert (b.flag_pre_konkan, b.odds_hi, b.re_odds_hi, b.re_odds_now_odds, b.popmax_popmin) == (0, 0.0, 0.0, 0.0, 0.0)
    assert (b.re_3_to_4time_hi_sq, b.oddsmax_oddsmin, b.rentai_ritu) == (2.25, 0.0, 0.0)


def test_group_keys_drop_null_and_empty_cells_are_zero(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 0), ("a", "y", 1), ("b", "y", 0), (None, "x", 1)], "e string, c string, result int")
    got = {r.e: (r.p_x, r.p_y) for r in aggregates.pivoted_rates(df, "e", "c", ["x", "y"], prefix="p").collect()}
    assert got == {"a": (0.5, 1.0), "b": (0.0, 0.0)}
    wide = aggregates.entity_rates(df, "e", aggregates.categories(df, ["c"]), prefix="p")
    assert {r.e: (r.p_x, r.p_y) for r in wide.collect()} == got


def test_categories_limit_is_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"), (F.col("id") % 3).alias("d"))
    assert aggregates.categories(df, ["d", "c"], 50)["d"] == [0, 1, 2]
    with pytest.raises(ValueError):
        aggregates.categories(df, ["c", "d"], 49)


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "h", 0.4), (1, "h", 0.3), (2, "k", None), (1, "h", 0.3)], "raceid int, horsename string, s double")
    got = aggregates.first_per_key(df, ["raceid", "horsename"], ["s"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, "h", 0.3), (2, "k", None)]


def test_marks_and_blend(spark):
    df = spark.createDataFrame([(0.49, 0.49), (0.5, 0.49), (0.5, 0.5), (0.4, 0.6), (None, 0.6)], "gbm_pred double, tf_pred double")
    got = report.marked(report.blended(df)).collect()
    assert [r.new_mark_flag for r in got] == ["×", "〇", "◎", "〇", "〇"]
    assert [r.new_flag for r in got] == [0, 0, 1, 1, 0]
    assert [r.probability for r in got] == [0.49, 0.49, 0.5, 0.51, None]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, "* a", "&b", 2.0)], "id int, x string, y string, z double")
    assert tuple(columns.clean_leading_marks(df).first()) == (1, "a", "b", 2.0)
    assert columns.column_range(df, "x").columns == ["x", "y", "z"]
    assert columns.column_range(df, None, 1).columns == ["id", "x"]
    assert columns.prefixed(df, "p_", ["id"]).columns == ["id", "p_x", "p_y", "p_z"]
    assert columns.renamed_by_lists(df, ["x", "none"], ["u", "v"]).columns == ["id", "u", "y", "z"]
    assert len(C.pivot_latin_names()) == 50


def test_profile_narrows_strictly_inside_the_range(spark):
    df = spark.createDataFrame([(126, 127, 40_000, 1.5), (0, 0, -5, 1e300)], "a int, b int, c long, d double")
    profile = values.profile_numeric(df)
    assert {r.column: r.type for r in profile.collect()} == {"a": "tinyint", "b": "smallint", "c": "int", "d": "double"}
    assert [f.dataType.simpleString() for f in values.narrowed(df, profile).schema] == ["tinyint", "smallint", "int", "double"]


def test_mean_and_median_fill(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (4, None), (None, 8.0)], "a int, b double")
    assert col(values.filled_with_mean(df, ["a", "b"]), "b") == [6.0, 4.0, 6.0, 8.0]
    assert col(values.filled_with_median(df, ["a", "b"]), "a") == [1.0, 2.0, 4.0, 2.0]


def test_csv_round_trip_and_dates(spark, tmp_path):
    df = entries(spark, {}, {"legtype": "ﾏｸﾘ", "odds": None})
    files.write_entries_csv(df, str(tmp_path / "e"))
    assert sorted(map(tuple, files.read_entries_csv(spark, str(tmp_path / "e")).collect())) == sorted(map(tuple, df.collect()))
    text = spark.createDataFrame([("2021-11-20",), ("20th",), (None,)], "t string")
    assert col(text.select(files.parsed_days("t").alias("d")), "d") == [datetime(2021, 11, 20), None, None]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    head = list(reversed(files.ENTRY_TYPES))
    values = {"raceid": "7", "odds": "9.5", "pop": "3.0", "days": "2021/11/5", "weight": "NaN", "time": "x", "place": "中京"}
    lines = [",".join([*head, "remark"]), ",".join([*(values.get(c, "1") for c in head), "note"])]
    (tmp_path / "e.csv").write_bytes(("\r\n".join(lines) + "\r\n").encode("cp932"))
    r = files.read_entries_csv(spark, str(tmp_path / "e.csv")).first()
    assert list(r.asDict()) == list(files.ENTRY_TYPES)
    assert (r.raceid, r.odds, r["pop"], r.days, r.weight, r.time, r.place) == (7, 9.5, 3, datetime(2021, 11, 5), None, None, "中京")


def test_csv_without_a_column_or_with_two_headers_is_refused(spark, tmp_path):
    types = {"a": "int", "b": "double"}
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "1.csv").write_text("b,a\n1.5,2\n")
    assert files.read_entries_csv(spark, str(tmp_path / "x"), types).collect() == [(2, 1.5)]
    with pytest.raises(ValueError, match="missing"):
        files.read_entries_csv(spark, str(tmp_path / "x"), types | {"c": "int"})
    (tmp_path / "x" / "2.csv").write_text("a,b\n3,4.5\n")
    with pytest.raises(Exception):
        files.read_entries_csv(spark, str(tmp_path / "x"), types).collect()


def test_date_forms_and_texts_without_one(spark):
    text = ["2021-11-05", "2021/11/5", "20211105", "2021年11月5日", "2021-11-05 00:00:00", "2021/13/40", "soon", None]
    df = spark.createDataFrame([(t,) for t in text], "days string")
    assert col(df.select(files.parsed_days("days", *files.DATE_PATTERNS).alias("d")), "d") == [datetime(2021, 11, 5)] * 5 + [None] * 3
    assert sorted(map(tuple, files.unparsed_days(df).collect())) == [("2021/13/40", 1), ("soon", 1)]


def test_entry_keys_of_large_tables_differ(spark):
    df = spark.createDataFrame([(1, 1_000_005), (2, 5), (250_000_000, 999_999_999)], "race long, hid long")
    keys = col(df.select(entry_key(F.col("race"), F.col("hid")).alias("k")), "k")
    assert len(set(keys)) == 3
    with pytest.raises(Exception, match="runner keys"):
        spark.createDataFrame([(1, 10**9)], "race long, hid long").select(entry_key(F.col("race"), F.col("hid"))).collect()


def test_report_keeps_the_scored_copy(spark):
    rows = [(1, "H", 0.2, None), (1, "H", 0.1, 0.9), (1, "H", 0.8, 0.9), (2, "I", None, None)]
    df = spark.createDataFrame(rows, "raceid long, horsename string, gbm_pred double, tf_pred double")
    features = df.select("raceid", "horsename", F.lit(999).alias("result"), *[
        F.lit("x").alias(c) for c in C.REPORT_COLUMNS if c not in ("raceid", "horsename")]).distinct()
    out = report.prediction_report(features, df.select("raceid", "gbm_pred"), df.select("raceid", "tf_pred"))
    assert sorted((r.raceid, r.gbm_pred, r.tf_pred) for r in out.collect()) == [(1, 0.8, 0.9), (2, None, None)]


def test_resume_reads_the_saved_table(spark, tmp_path):
    path = files.checkpoint_path(str(tmp_path), C.PRODUCTION, "a")
    assert path != files.checkpoint_path(str(tmp_path), C.EXPERIMENT, "a")
    assert files.saved_or_built(spark, path, lambda: spark.range(3), resume=False).count() == 3
    assert files.saved_or_built(spark, path, lambda: spark.range(9), resume=True).count() == 3


def test_metrics_by_hand(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.3), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    m = evaluation.binary_metrics(df, "y", "s").first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (pytest.approx(4 / 6), pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3))
    a = evaluation.area_metrics(df, "y", "s").first()
    pairs = [(p > n) + 0.5 * (p == n) for yp, p in rows if yp for yn, n in rows if not yn]
    assert (a.tp, a.fp, a.tn, a.fn) == (2, 1, 2, 1)
    assert a.roc_auc == pytest.approx(sum(pairs) / len(pairs))


def test_predictions_and_reports_are_written(spark, tmp_path):
    df = spark.createDataFrame([(30, 0.1), (10, 0.2), (20, 0.3)], "raceid long, gbm_pred double").repartition(3)
    numbered = files.numbered_predictions(df)
    files.write_predictions_csv(numbered, str(tmp_path / "p"))
    back = spark.read.option("header", True).csv(str(tmp_path / "p"))
    assert sorted((int(r.row), int(r.raceid)) for r in back.collect()) == [(0, 10), (1, 20), (2, 30)]
    files.write_report(spark.createDataFrame([("a", True, 0.5)], "feature string, kept boolean, score double"), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 1


def test_date_cuts_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1, datetime(2020, 12, 31, 23)), (2, datetime(2021, 1, 1))], "id int, days timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert col(filters.before(df, "days", datetime(2021, 1, 1)), "id") == [1]
        assert col(filters.since(df, "days", datetime(2021, 1, 1)), "id") == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
