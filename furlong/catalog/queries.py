"""All registered queries. Each reads the whole tables of the folder it is given."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong import config as C
from furlong.catalog import sql as S
from furlong.catalog.registry import register
from furlong.functions import racing
from furlong.functions.numeric import ratio, ratio_or_zero, rnd
from furlong.operators import (
    aggregates, columns, encode, evaluation, filters, history, joins, report, sampling, scoring, selection, values)
from furlong.plans import clean as clean_plan
from furlong.plans import experiment as experiment_plan
from furlong.plans import features as feature_plan
from furlong.plans import predict as predict_plan
from furlong.session import materialize, scratch_path
from furlong.sources import files
from furlong.sources.entries import entry_key, race_entries, table

CONFIG = replace(C.PRODUCTION, history_before=datetime(2001, 1, 1), recent_from=datetime(2001, 3, 1))
CURRENT = replace(CONFIG, include_current=True)
EXPERIMENT = replace(C.EXPERIMENT, history_before=CONFIG.history_before, recent_from=CONFIG.recent_from)
COMPONENTS = tuple(c for p in CONFIG.profiles for c in p.component_names())


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_plan.clean_entries(race_entries(spark, sf), CONFIG)


def indices(spark: SparkSession, sf: str) -> DataFrame:
    return clean_plan.with_indices(materialize(clean(spark, sf), "entries"), CONFIG)


def past(spark: SparkSession, sf: str) -> DataFrame:
    df = filters.before(clean(spark, sf), "days", CONFIG.history_before)
    return df.withColumn("result", racing.binarized(F.col("result")))


def before_cut(spark: SparkSession, sf: str) -> DataFrame:
    df = filters.before(clean(spark, sf), "days", CONFIG.history_before)
    used = dict.fromkeys(c for p in CONFIG.profiles for c in (p.entity, *p.categories, *p.means))
    return materialize(df.select("raceid", *used, "result"), "entries")


def ranked(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(encode.profile_base(before_cut(spark, sf), CONFIG.profiles, CONFIG.seed), "profile")


def profiled(spark: SparkSession, sf: str, p: C.Profile) -> DataFrame:
    rows = before_cut(spark, sf)
    base = materialize(encode.profile_base(rows, [p], CONFIG.seed), "profile")
    return encode.entity_profile(base, p, encode.profile_rows(rows, [p]))


def folded(spark: SparkSession, sf: str, p: C.Profile) -> DataFrame:
    return ranked(spark, sf).withColumn("fold", ((F.col("rank") - 1) % p.folds).cast("int"))


def features(spark: SparkSession, sf: str, config: C.RaceConfig = CONFIG) -> DataFrame:
    return materialize(feature_plan.build_features(race_entries(spark, sf), config), "features")


def finished(spark: SparkSession, sf: str, config: C.RaceConfig = CONFIG) -> DataFrame:
    """The finished feature table, built anew for each query."""
    return materialize(feature_plan.finish_features(features(spark, sf, config), config), "finished", compiled=True)


def recent(spark: SparkSession, sf: str) -> DataFrame:
    """The finished table's recent rows with a result; read once, so only they are finished, and not written here."""
    rows = feature_plan.finish_features(features(spark, sf), CONFIG)
    return filters.to_train(filters.since(rows, "days", CONFIG.recent_from))


def given_scores(df: DataFrame) -> DataFrame:
    """Scores both engines compute alike, in place of model output."""
    return df.withColumns({"gbm_pred": F.col("raceid") % 101 / F.lit(100.0),
                           "tf_pred": F.col("raceid") % 97 / F.lit(96.0)})


GIVEN = "(raceid % 101) / 100.0::DOUBLE AS gbm_pred, (raceid % 97) / 96.0::DOUBLE AS tf_pred"
KEYS = ("raceid", "days", "horsename")
ENTRY_DOUBLES = ("odds", "weight", "time", "3ftime")
ROLLED_DOUBLES = tuple(s.name for s in history.rolled_stats(C.ROLLED) if not s.name.startswith("pop") or s.how == "avg")
LAGGED_DOUBLES = ("pre_odds", "pre_3ftime", "pre_speedindex", "pre_last_race_index")
FINISHED_DOUBLES = (
    "weight", "speedindex", "last_race_index", "pre_odds", "pre_3ftime", *ROLLED_DOUBLES, "resultmean",
    *[p.encoding for p in S.PROFILES], "odds_hi", "re_odds_hi", "odds_hi_sq", "re_odds_hi_sq", "re_3_to_4time",
    "re_3_to_4time_hi_sq", "re_pop_now_pop", "re_odds_now_odds", "re_result_to_pop", "popmax_popmin",
    "oddsmax_oddsmin", "rentai_ritu")


# ---- Sources and sinks ------------------------------------------------------------------------------

def _csv_round_trip(spark, sf):
    """Columns stand in another order than the reader's, one is unknown to it, and dates have several forms."""
    path = scratch_path(spark, "entries-csv")
    rows = race_entries(spark, sf).select(F.lit("x").alias("remark"), *reversed(files.ENTRY_TYPES))
    forms = ("yyyy-MM-dd", "yyyy/M/d", "yyyyMMdd", "yyyy'年'M'月'd'日'")
    text = F.date_format("days", "yyyy-MM-dd HH:mm:ss")
    for i, form in enumerate(forms):
        text = F.when(F.col("racenum") % 5 == i, F.date_format("days", form)).otherwise(text)
    files.write_entries_csv(rows.withColumn("days", text), path)
    return files.read_entries_csv(spark, path)


def _table_round_trip(spark, sf):
    path = files.checkpoint_path(scratch_path(spark, "resume"), CONFIG, sf)
    files.saved_or_built(spark, path, lambda: clean(spark, sf), resume=False)
    return files.saved_or_built(spark, path, lambda: clean(spark, sf), resume=True)


def _parse_days(spark, sf):
    raw = table(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_orderkey") % 11 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("text"))
    return raw.select("o_orderkey", files.parsed_days("text").alias("days"))


def _marks_in_text(df: DataFrame) -> DataFrame:
    return df.select("raceid", F.concat(F.when(F.col("raceid") % 3 == 0, " *").when(F.col("raceid") % 3 == 1, "&")
                                        .otherwise(""), "horsename").alias("horsename"),
                     F.concat(F.lit("* "), "jocky").alias("jocky"), "place")


register("src_csv_sjis", _csv_round_trip, "SELECT * FROM race_entries", "race_entries", ENTRY_DOUBLES)
register("ckpt_roundtrip", _table_round_trip, "SELECT * FROM clean", "clean", ENTRY_DOUBLES)
register("parse_days", _parse_days, """
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN date_trunc('day', o_orderdate)::TIMESTAMP END AS days
    FROM orders""")
def _prediction_file(spark, sf):
    rows = files.numbered_predictions(given_scores(filters.to_predict(clean(spark, sf))).select(
        "raceid", "horsename", "gbm_pred", "tf_pred"))
    path = scratch_path(spark, "predictions")
    files.write_predictions_csv(rows, path)
    return files.read_predictions_csv(spark, path, rows.schema)


register("sink_predictions", _prediction_file,
         f"""SELECT row_number() OVER (ORDER BY raceid) - 1 AS "row", raceid, horsename, {GIVEN}
             FROM clean WHERE result = 999""", "clean", ("gbm_pred", "tf_pred"))
register("clean_leading_marks",
         lambda spark, sf: columns.clean_leading_marks(_marks_in_text(race_entries(spark, sf))),
         "SELECT raceid, horsename, jocky, place FROM race_entries", "race_entries")


# ---- Filters ----------------------------------------------------------------------------------------

def _entry_filter(name, build, where, cols=("raceid", "distance", "result", "pop", "odds")):
    register(name, lambda spark, sf: build(race_entries(spark, sf)).select(*cols),
             f"SELECT {', '.join(cols)} FROM race_entries WHERE {where}", "race_entries",
             [c for c in cols if c in ENTRY_DOUBLES])


_entry_filter("filter_distance", lambda df: filters.in_closed_set(df, "distance", C.FLAT_DISTANCES),
              f"distance IN ({S.values(C.FLAT_DISTANCES)})")
_entry_filter("filter_not_excluded", filters.not_excluded, "result IS DISTINCT FROM 0")
_entry_filter("dropna_subset", lambda df: filters.complete_in(df, ["pop", "odds", "3ftime"]),
              'pop IS NOT NULL AND odds IS NOT NULL AND "3ftime" IS NOT NULL')
_entry_filter("dropna_any", filters.complete, "COLUMNS(*) IS NOT NULL")
_entry_filter("history_cut", lambda df: filters.before(df, "days", CONFIG.history_before), f"days < {S.CUT}",
              ("raceid", "days"))
_entry_filter("recent_cut", lambda df: filters.since(df, "days", CONFIG.recent_from), f"days >= {S.RECENT}",
              ("raceid", "days"))
_entry_filter("split_predict", filters.to_predict, "result = 999", ("raceid", "result"))
_entry_filter("split_train", filters.to_train, "result IS DISTINCT FROM 999", ("raceid", "result"))


# ---- Columns ----------------------------------------------------------------------------------------

register("project_entry_keys", lambda spark, sf: columns.project(race_entries(spark, sf), KEYS),
         f"SELECT {', '.join(KEYS)} FROM race_entries", "race_entries")
register("drop_postrace_cols", lambda spark, sf: columns.without(race_entries(spark, sf), C.POST_RACE_COLUMNS),
         'SELECT * EXCLUDE (rank3, rank4, "3ftime", time) FROM race_entries', "race_entries", ("odds", "weight"))
register("rename_columns",
         lambda spark, sf: columns.renamed(race_entries(spark, sf).select("raceid", *[
             c for c in C.LAGGED if c not in ("speedindex", "last_race_index")]), C.LAGGED),
         "SELECT raceid, " + ", ".join(f'"{k}" AS {v}' for k, v in C.LAGGED.items()
                                       if k not in ("speedindex", "last_race_index")) + " FROM race_entries",
         "race_entries", ("pre_odds", "pre_3ftime"))
register("prefix_columns",
         lambda spark, sf: columns.prefixed(race_entries(spark, sf).select("raceid", "place", "odds"), "jockey_", ["raceid"]),
         "SELECT raceid, place AS jockey_place, odds AS jockey_odds FROM race_entries", "race_entries", ("jockey_odds",))


def _jockey_pivot(spark, sf, category="place", p=C.JOCKEY):
    rows = past(spark, sf).select(p.entity, category, "result")
    rows = materialize(rows, "past")
    return aggregates.pivoted_rates(rows, p.entity, category, aggregates.categories(rows, [category])[category],
                                    digits=p.digits, prefix=p.prefix)


KNOWN = {"place": sorted(C.PLACE_LATIN), "distance": (1000, 1200, 1600, 1800, 2000, 2500), "turf": ("ダ", "芝"),
         "condition": ("不", "稍", "良", "重")}


def _rate_sql(p: C.Profile, categories, latin=None) -> str:
    names = latin or {}
    cells = []
    for category in categories:
        for v in KNOWN[category]:
            name = f"{p.prefix}_{v}"
            test = f"'{v}'" if isinstance(v, str) else v
            cells.append(f"""coalesce({S.rnd_mean(f'avg(CASE WHEN "{category}" = {test} THEN result END)', p.digits)}, 0.0)
                AS "{names.get(name, name)}" """)
    return f"SELECT {p.entity}, {', '.join(cells)} FROM past WHERE {p.entity} IS NOT NULL GROUP BY {p.entity}"


register("pivot_jockey_place", _jockey_pivot, _rate_sql(C.JOCKEY, ["place"]), "past")
register("rename_pivot_columns", lambda spark, sf: columns.renamed(_jockey_pivot(spark, sf), C.pivot_latin_names()),
         _rate_sql(C.JOCKEY, ["place"], C.pivot_latin_names()), "past")
for _p in (C.FATHER, C.FATHERMON):
    for _c in _p.categories:
        register(f"pivot_{_p.prefix}_{_c}", lambda spark, sf, c=_c, p=_p: _jockey_pivot(spark, sf, c, p),
                 _rate_sql(_p, [_c]), "past")


def _history(spark, sf) -> DataFrame:
    return history.race_history(indices(spark, sf))


register("column_range",
         lambda spark, sf: columns.column_range(_history(spark, sf), "popmean", "speedmin"),
         "SELECT " + ", ".join(f'"{s.name}"' for s in history.rolled_stats(C.ROLLED)) + " FROM history", "history",
         ROLLED_DOUBLES)
GROUP = ("horsecount", "horsenum", "weight", *C.FEATURE_GROUPS["previous_race"], *C.FEATURE_GROUPS["rolling"])
register("feature_group",
         lambda spark, sf: columns.feature_group(_history(spark, sf), C.FEATURE_GROUPS["numeric"], ["raceid"]),
         "SELECT raceid, " + ", ".join(f'"{c}"' for c in GROUP) + " FROM history", "history",
         [c for c in GROUP if c in (*ROLLED_DOUBLES, *LAGGED_DOUBLES, "speedindex", "last_race_index", "resultmean", "weight")])
register("unpivot_report",
         lambda spark, sf: columns.to_rows(clean(spark, sf).groupBy("place").agg(
             *[F.avg(c).alias(c) for c in ("pop", "odds", "weight")]), ["place"], ["pop", "odds", "weight"], "measure", "mean"),
         " UNION ALL ".join(f"SELECT place, '{c}' AS measure, avg({c})::DOUBLE AS mean FROM clean GROUP BY place"
                            for c in ("pop", "odds", "weight")), "clean", ("mean",))


# ---- Values -----------------------------------------------------------------------------------------

register("recode_class_style",
         lambda spark, sf: values.recoded(race_entries(spark, sf).select("raceid", "class", "legtype"),
                                          {"class": C.CLASS_NAMES, "legtype": C.STYLE_NAMES}),
         f"SELECT raceid, {S.case_map('class', C.CLASS_NAMES, 'class')} AS class, "
         f"{S.case_map('legtype', C.STYLE_NAMES, 'legtype')} AS legtype FROM race_entries", "race_entries")
BAND_SQL = "CASE " + " ".join(f"WHEN {{0}} IN ({S.values(v)}) THEN '{k}'" for k, v in C.DISTANCE_BANDS.items()) \
    + " ELSE CAST({0} AS VARCHAR) END"
register("distance_band",
         lambda spark, sf: race_entries(spark, sf).select("raceid", racing.distance_band(F.col("distance")).alias("distance")),
         f"SELECT raceid, {BAND_SQL.format('distance')} AS distance FROM race_entries", "race_entries")
register("fill_literal",
         lambda spark, sf: values.filled(race_entries(spark, sf).select("raceid", "fathertype", "legtype"),
                                         {"fathertype": C.DEFAULT_SIRE_LINE, "legtype": C.DEFAULT_STYLE}),
         f"SELECT raceid, coalesce(fathertype, '{C.DEFAULT_SIRE_LINE}') AS fathertype, "
         f"coalesce(legtype, '{C.DEFAULT_STYLE}') AS legtype FROM race_entries", "race_entries")
register("condition_index",
         lambda spark, sf: race_entries(spark, sf).select("raceid", racing.condition_index().alias("conditionindex")),
         f"SELECT raceid, {S.CONDITION_INDEX} AS conditionindex FROM race_entries", "race_entries")
register("class_index", lambda spark, sf: clean(spark, sf).select("raceid", racing.class_index().alias("class_index")),
         f"SELECT raceid, {S.CLASS_INDEX} AS class_index FROM clean", "clean", ("class_index",))
register("binarize_result",
         lambda spark, sf: race_entries(spark, sf).select("raceid", racing.binarized(F.col("result")).alias("result")),
         f"SELECT raceid, {S.BINARY} AS result FROM race_entries", "race_entries")
register("impute_mean",
         lambda spark, sf: values.filled_with_mean(
             materialize(race_entries(spark, sf).select("raceid", "pop", "odds", "weight"), "entries"), ["pop", "odds", "weight"]),
         "SELECT raceid, " + ", ".join(f"coalesce({c}::DOUBLE, (SELECT avg({c}) FROM race_entries)) AS {c}"
                                       for c in ("pop", "odds", "weight")) + " FROM race_entries",
         "race_entries", ("pop", "odds", "weight"))
register("impute_median",
         lambda spark, sf: values.filled_with_median(
             materialize(race_entries(spark, sf).select("raceid", "odds", "weight"), "entries"), ["odds", "weight"]),
         "SELECT raceid, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM race_entries)) AS {c}"
                                       for c in ("odds", "weight")) + " FROM race_entries",
         "race_entries", ("odds", "weight"))
register("nullify_inf",
         lambda spark, sf: values.finite(race_entries(spark, sf).select("raceid", F.when(
             F.col("pop") == 1, F.lit(float("inf"))).otherwise(ratio(F.col("odds"), F.col("pop") - 1)).alias("share")), ["share"]),
         "SELECT raceid, CASE WHEN pop = 1 THEN 0.0 ELSE coalesce(odds / nullif(pop - 1, 0), 0.0) END AS share FROM race_entries",
         "race_entries", ("share",))
register("clip_features",
         lambda spark, sf: values.clip(race_entries(spark, sf).select("raceid", "pop", "odds", (
             F.col("weight") - 55).alias("weight")), ["pop", "odds", "weight"]),
         "SELECT raceid, " + ", ".join(
             f"CASE WHEN {e} IS NOT NULL THEN greatest(least({e}::DOUBLE, 5.0::DOUBLE), (-5.0)::DOUBLE) END AS {c}" for c, e in
             (("pop", "pop"), ("odds", "odds"), ("weight", "(weight - 55)"))) + " FROM race_entries",
         "race_entries", ("pop", "odds", "weight"))
register("cast_columns",
         lambda spark, sf: values.casted(race_entries(spark, sf).select("raceid", "distance", "odds", "result"),
                                         {"distance": "string", "odds": "int", "result": "double"}),
         "SELECT raceid, distance::VARCHAR AS distance, trunc(odds)::INTEGER AS odds, result::DOUBLE AS result FROM race_entries",
         "race_entries", ("result",))
register("round_columns",
         lambda spark, sf: values.rounded(race_entries(spark, sf).select(
             "raceid", (F.col("odds") / 8).alias("odds"), (F.col("weight") / 7).alias("weight")), ["odds", "weight"], 2),
         f"SELECT raceid, {S.rnd('odds / 8', 2)} AS odds, {S.rnd('weight / 7', 2)} AS weight FROM race_entries",
         "race_entries", ("odds", "weight"))


def _profile_sql() -> str:
    parts = []
    for c, t in files.ENTRY_TYPES.items():
        if t in ("bigint", "int"):
            steps = (("tinyint", 7), ("smallint", 15), ("int", 31))
            kind = "CASE " + " ".join(f"WHEN lo > {-(1 << b)} AND hi < {(1 << b) - 1} THEN '{n}'" for n, b in steps) \
                + " ELSE 'bigint' END"
        elif t == "double":
            kind = "'float'"
        else:
            continue
        parts.append(f"""SELECT '{c}' AS "column", lo::DOUBLE AS "min", hi::DOUBLE AS "max", {kind} AS type
            FROM (SELECT min("{c}") AS lo, max("{c}") AS hi FROM race_entries)""")
    return " UNION ALL ".join(parts)


register("profile_downcast", lambda spark, sf: values.profile_numeric(race_entries(spark, sf)), _profile_sql(),
         "race_entries", ("min", "max"))


# ---- Scalar features --------------------------------------------------------------------------------

register("speed_index",
         lambda spark, sf: clean_plan.with_speed_index(materialize(clean(spark, sf), "entries")).select("raceid", "speedindex"),
         "SELECT raceid, speedindex FROM indices", "indices", ("speedindex",))
register("last_race_index",
         lambda spark, sf: clean_plan.with_last_race_index(clean(spark, sf)).select("raceid", "last_race_index"),
         f"SELECT raceid, {S.LAST_RACE} AS last_race_index FROM clean", "clean", ("last_race_index",))
DERIVED = ("odds_hi", "re_odds_hi", "odds_hi_sq", "re_odds_hi_sq", "re_3_to_4time", "re_3_to_4time_hi_sq",
           "re_pop_now_pop", "re_odds_now_odds", "re_result_to_pop", "popmax_popmin", "oddsmax_oddsmin", "rentai_ritu")
register("derived_features",
         lambda spark, sf: feature_plan.derived(_history(spark, sf)).select(
             "raceid", "flag_konkan", "flag_pre_konkan", *DERIVED),
         f"SELECT raceid, {S.DERIVED} FROM history", "history", DERIVED)
register("placed_rate",
         lambda spark, sf: _history(spark, sf).select("raceid", rnd(
             ratio_or_zero(F.col("rentai5sum"), F.col("count5sum")), 3).alias("rentai_ritu")),
         f"SELECT raceid, {S.rnd('coalesce(rentai5sum / nullif(count5sum, 0), 0.0)', 3)} AS rentai_ritu FROM history",
         "history", ("rentai_ritu",))
register("label_top3", lambda spark, sf: feature_plan.labelled(race_entries(spark, sf)).select("raceid", "flag"),
         f"SELECT raceid, {S.LABEL} AS flag FROM race_entries", "race_entries")


# ---- Joins ------------------------------------------------------------------------------------------

def _join_base(spark, sf):
    entries = materialize(clean(spark, sf).select("raceid", "place", "turf", "distance", "time", "result"), "entries")
    return joins.lookup(entries, aggregates.base_times(entries), ["place", "turf", "distance"]).select(
        "raceid", "place", "turf", "distance", "basetime")


def _join_indices(spark, sf):
    entries = materialize(clean(spark, sf), "entries")
    speed = clean_plan.with_speed_index(entries).select(*KEYS, "speedindex")
    last = clean_plan.with_last_race_index(entries).select(*KEYS, "last_race_index")
    return joins.same_entries(entries, speed, last, keys=KEYS)


def _join_history(spark, sf):
    rows = materialize(indices(spark, sf), "indices")
    out = history.with_history_table(rows, history.history_table(rows))
    return out.select("raceid", "horsename", *C.LAGGED.values(), "popmean", "oddsmean", "resultmean")


def _join_profiles(spark, sf):
    entries = materialize(clean(spark, sf), "entries")
    tables = feature_plan.profile_tables(entries, CONFIG, components=False)
    return feature_plan.with_profiles(entries.select("raceid", "jocky", "father", "fathermon"), tables, CONFIG.profiles)


def _rates(spark, sf, p=C.FATHER):
    rows = materialize(past(spark, sf).select(p.entity, *p.categories, *p.means, "result"), "past")
    return aggregates.entity_rates(rows, p.entity, aggregates.categories(rows, p.categories), means=p.means,
                                   digits=p.digits, prefix=p.prefix)


def _join_components(spark, sf):
    """How many components each entry's entities brought along."""
    entries = materialize(clean(spark, sf), "entries")
    out = feature_plan.with_profiles(entries.select("raceid", "jocky", "father", "fathermon"),
                                     feature_plan.profile_tables(entries, CONFIG), CONFIG.profiles)
    return out.select("raceid", *[
        sum((F.col(c).isNotNull().cast("int") for c in p.component_names()), F.lit(0)).alias(f"{p.prefix}_components")
        for p in CONFIG.profiles])


ENCODINGS = tuple(p.encoding for p in S.PROFILES)
register("join_basetime", _join_base,
         "SELECT raceid, place, turf, distance, basetime FROM clean LEFT JOIN base USING (place, distance, turf)",
         "base", ("basetime",))
register("join_entry_indices", _join_indices, "SELECT * FROM indices", "indices",
         (*ENTRY_DOUBLES, "speedindex", "last_race_index"))
register("join_history", _join_history,
         "SELECT raceid, horsename, " + ", ".join(C.LAGGED.values()) + ", popmean, oddsmean, resultmean FROM history",
         "history", (*LAGGED_DOUBLES, "popmean", "oddsmean", "resultmean"))
register("join_entity_profiles", _join_profiles,
         f"SELECT raceid, jocky, father, fathermon, {', '.join(ENCODINGS)} FROM clean "
         + " ".join(f"LEFT JOIN {S.encoding(p)} USING ({p.entity})" for p in S.PROFILES), ("clean", "ranked"), ENCODINGS)
register("join_entity_components", _join_components,
         "SELECT raceid, " + ", ".join(
             f"CASE WHEN {p.entity} IN (SELECT {p.entity} FROM past WHERE result IS NOT NULL AND {p.entity} IS NOT NULL) "
             f"THEN {len(p.component_names())} ELSE 0 END AS {p.prefix}_components" for p in S.PROFILES)
         + " FROM clean", ("clean", "past"))
register("entity_profile_wide", _rates, _rate_sql(C.FATHER, C.FATHER.categories).replace(
    "SELECT father,", f"SELECT father, {S.rnd_mean('avg(' + chr(34) + '3ftime' + chr(34) + ')', 3)} AS father_3ftime,"), "past")
register("join_predictions",
         lambda spark, sf: (lambda rows: report.with_scores(
             rows.select("raceid", "horsename"), given_scores(rows).select("raceid", "gbm_pred"),
             given_scores(rows.filter(F.col("raceid") % 2 == 0)).select("raceid", "tf_pred")))(
             filters.to_predict(clean(spark, sf))),
         "SELECT raceid, horsename, (raceid % 101) / 100.0::DOUBLE AS gbm_pred, "
         "CASE WHEN raceid % 2 = 0 THEN (raceid % 97) / 96.0::DOUBLE END AS tf_pred FROM clean WHERE result = 999",
         "clean", ("gbm_pred", "tf_pred"))


# ---- Aggregates -------------------------------------------------------------------------------------

register("agg_basetime", lambda spark, sf: aggregates.base_times(clean(spark, sf)), "SELECT * FROM base", "base",
         ("basetime",))
register("agg_entity_means",
         lambda spark, sf: aggregates.entity_means(past(spark, sf), "father", ["3ftime", "result"]),
         f"""SELECT father, {S.rnd_mean('avg("3ftime")', 3)} AS mean_3ftime, {S.rnd_mean('avg(result)', 3)} AS mean_result
             FROM past WHERE father IS NOT NULL GROUP BY father""", "past", ("mean_3ftime", "mean_result"))
NUMERIC = [c for c, t in files.ENTRY_TYPES.items() if t in ("bigint", "int", "double") and c not in ("raceid", "racenum")]
register("agg_mean_all",
         lambda spark, sf: aggregates.mean_of_all(clean(spark, sf).select("jocky", *NUMERIC), "jocky"),
         "SELECT jocky, " + ", ".join(f"""{S.rnd_mean(f'avg("{c}")', 3)} AS "{c}" """ for c in NUMERIC)
         + " FROM clean GROUP BY jocky", "clean", NUMERIC)
register("label_counts", lambda spark, sf: aggregates.label_counts(feature_plan.labelled(clean(spark, sf))),
         f"SELECT {S.LABEL} AS flag, count(*) AS n FROM clean GROUP BY 1", "clean")
register("distinct_entities", lambda spark, sf: aggregates.distinct_entities(clean(spark, sf), "horsename"),
         "SELECT DISTINCT horsename FROM clean", "clean")


# ---- Windows ----------------------------------------------------------------------------------------

def _lagged(df: DataFrame) -> DataFrame:
    return history.with_history(df, "horsename", ["days", "raceid"], C.LAGGED).select(
        "raceid", "horsename", *C.LAGGED.values())


def _rolling(spark, sf, include_current):
    rolling = history.rolled_stats(C.ROLLED)
    rows = indices(spark, sf)
    if not include_current:
        rows = rows.withColumns({"count": F.lit(1), "rentai": racing.placed(F.col("result"))})
        rolling = [*rolling, history.Rolling("resultmean", "result", "avg"), history.Rolling("count5sum", "count", "sum"),
                   history.Rolling("rentai5sum", "rentai", "sum")]
    return history.with_history(rows, "horsename", ["days", "raceid"], {}, rolling, include_current=include_current).select(
        "raceid", "horsename", *[r.name for r in rolling])


register("lag_prev_race", lambda spark, sf: _lagged(indices(spark, sf)),
         f"SELECT raceid, horsename, {S.LAGS} FROM indices {S.WINDOW}", "indices", LAGGED_DOUBLES)
register("rolling_incl5", lambda spark, sf: _rolling(spark, sf, True),
         f"SELECT raceid, horsename, {S.rolled('p', 2, False)} FROM indices {S.INCL5}", "indices", ROLLED_DOUBLES)
register("rolling_prev5", lambda spark, sf: _rolling(spark, sf, False),
         f"SELECT raceid, horsename, {S.rolled('p', 1, True)} FROM indices {S.PREV5}", "indices",
         (*ROLLED_DOUBLES, "resultmean"))
register("horse_history", lambda spark, sf: _history(spark, sf), "SELECT * FROM history", "history",
         (*ENTRY_DOUBLES, *LAGGED_DOUBLES, *ROLLED_DOUBLES, "resultmean", "speedindex", "last_race_index"))


# ---- Sorting and copies -----------------------------------------------------------------------------

VARIANCES = ("pop", "odds", "weight", "horsecount", "distance")


def _variance_sql(source: str, features) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, max("{c}") > min("{c}") AS kept, var_pop("{c}")::DOUBLE AS variance,
            var_pop("{c}") < 0.001 AS low FROM {source}""" for c in features)


register("sort_report",
         lambda spark, sf: selection.sorted_report(selection.variance_report(clean(spark, sf), VARIANCES), "variance").withColumn(
             "place", F.monotonically_increasing_id()),
         f"""SELECT *, row_number() OVER (ORDER BY variance, feature) - 1 AS place
             FROM ({_variance_sql('clean', VARIANCES)})""", "clean", ("variance",))


def _lines(spark, sf) -> DataFrame:
    """Order lines before repeated parts are merged: the copies of an entry differ in supplier or price."""
    return table(spark, sf, "lineitem").select(
        entry_key(F.col("l_orderkey"), F.col("l_partkey")).alias("raceid"),
        F.concat(F.lit("H"), F.col("l_partkey").cast("string")).alias("horsename"),
        F.col("l_suppkey").alias("sid"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"))


register("dedupe_entries",
         lambda spark, sf: aggregates.first_per_key(_lines(spark, sf), ["raceid", "horsename"], ["sid", "qty", "price"]),
         """SELECT l_orderkey * 1000000000 + l_partkey AS raceid, 'H' || l_partkey AS horsename, l_suppkey AS sid,
              l_quantity AS qty, l_extendedprice AS price FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_suppkey, l_quantity, l_extendedprice) = 1""",
         (), ("qty", "price"))


def _union_histories(spark, sf):
    """The histories of every value's rows, and of the rows without one, put together."""
    rows = materialize(indices(spark, sf), "indices")
    found = aggregates.categories(rows, ["sex"])["sex"]
    parts = [_lagged(rows.filter(F.col("sex") == s)) for s in found] + [_lagged(rows.filter(F.col("sex").isNull()))]
    return reduce(DataFrame.unionByName, parts)


register("union_histories", _union_histories, f"SELECT raceid, horsename, {S.LAGS} FROM indices {S.WINDOW}", "indices",
         LAGGED_DOUBLES)


# ---- Encoding and sampling --------------------------------------------------------------------------

register("stratified_folds",
         lambda spark, sf: encode.stratified_folds(
             materialize(past(spark, sf).select("raceid", "result"), "past"), "result", "raceid", 5),
         "SELECT raceid, result, CAST((rank - 1) % 5 AS INTEGER) AS fold FROM ranked", "ranked")
for _p in S.PROFILES:
    register(f"oof_{_p.prefix}",
             lambda spark, sf, p=_p: encode.out_of_fold(folded(spark, sf, p), p.entity, "result", p.encoding).select(
                 "raceid", p.entity, "fold", p.encoding),
             f"""SELECT raceid, {_p.entity}, fold, encoding AS {_p.encoding}
                 FROM (SELECT *, CAST((rank - 1) % {_p.folds} AS INTEGER) AS fold FROM ranked)
                 JOIN {S.folded(_p)} AS t USING ({_p.entity}, fold)""", "ranked", (_p.encoding,))
    register(f"pca_{_p.prefix}",
             lambda spark, sf, p=_p: encode.principal_components(
                 encode.profile_matrix(encode.profile_rows(before_cut(spark, sf), [p]), p), p.entity, p.component_names()))
    register(f"entity_profile_{_p.prefix}", lambda spark, sf, p=_p: profiled(spark, sf, p))
    register(f"profile_encoding_{_p.prefix}",
             lambda spark, sf, p=_p: profiled(spark, sf, p).select(p.entity, p.encoding),
             f"SELECT * FROM {S.encoding(_p)}", "ranked", (_p.encoding,))


def _invariant_sql(p: C.Profile) -> str:
    """The same sums from the covariance table of the matrix itself."""
    means = "".join(f""", {S.rnd_mean(f'avg("{c}")', p.digits)} AS "{p.prefix}_{c}" """ for c in p.means)
    rates = _rate_sql(p, p.categories).replace(" FROM past", f"{means} FROM past")
    cells = f"SELECT {p.entity} AS e, c, v FROM (UNPIVOT (SELECT {p.entity}, COLUMNS(* EXCLUDE {p.entity})::DOUBLE FROM ({rates})) ON * EXCLUDE {p.entity} INTO NAME c VALUE v)"
    return f"""WITH cells AS ({cells}),
        cov AS (SELECT x.c AS a, y.c AS b, covar_samp(x.v, y.v) AS s FROM cells AS x JOIN cells AS y ON x.e = y.e GROUP BY x.c, y.c)
        SELECT 'entities' AS invariant, count(DISTINCT e)::DOUBLE AS value FROM cells
        UNION ALL SELECT 'mean', 0.0::DOUBLE UNION ALL SELECT 'cross', 0.0::DOUBLE
        UNION ALL SELECT 'trace', sum(s) FROM cov WHERE a = b
        UNION ALL SELECT 'squares', sum(s * s) FROM cov
        UNION ALL SELECT 'cubes', sum(x.s * y.s * z.s) FROM cov AS x JOIN cov AS y ON x.b = y.a JOIN cov AS z ON y.b = z.a AND z.b = x.a"""


for _p in S.PROFILES:
    register(f"pca_invariants_{_p.prefix}",
             lambda spark, sf, p=_p: encode.component_invariants(
                 encode.profile_matrix(encode.profile_rows(before_cut(spark, sf), [p]), p), p.entity),
             _invariant_sql(_p), "past", ("value",))
register("oof_entity_mean",
         lambda spark, sf: encode.entity_encoding(folded(spark, sf, C.FATHER), "father", "result", C.FATHER.encoding),
         f"SELECT * FROM {S.encoding(C.FATHER)}", "ranked", (C.FATHER.encoding,))

CODED = ("place", "turf", "distance", "weather", "condition", "sex", "horsename", "trainer")


def _codes_sql(columns_) -> str:
    return ", ".join(f"CAST(dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS INTEGER) AS {c}" for c in columns_)


register("label_encode",
         lambda spark, sf: encode.label_encoded(materialize(clean(spark, sf).select("raceid", *CODED), "entries"), CODED),
         f"SELECT raceid, {_codes_sql(CODED)} FROM clean", "clean")
LEVELS = {"place": sorted(C.PLACE_LATIN), "turf": ("ダ", "芝"), "sex": ("牡", "牝", "セ"),
          "weather": ("晴", "曇", "雨", "小雨", "雪"), "condition": ("良", "稍", "重", "不"),
          "class": ("新馬", "未勝利", "500万", "1000万", "オープン")}


def _one_hot_sql(levels) -> str:
    return ", ".join(f"""CAST(coalesce({c} = '{v}', false) AS INTEGER) AS "{c}_{v}" """ for c, vs in levels.items() for v in vs)


register("one_hot",
         lambda spark, sf: encode.one_hot(materialize(race_entries(spark, sf).select(
             "raceid", "place", "turf", "sex", "weather", "condition", "legtype"), "entries"),
             ["place", "turf", "sex", "weather", "condition", "legtype"]),
         "SELECT raceid, " + _one_hot_sql({c: LEVELS[c] for c in ("place", "turf", "sex", "weather", "condition")}
                                          | {"legtype": ("ﾏｸﾘ", "中団")}) + " FROM race_entries", "race_entries")


def _train(spark, sf) -> DataFrame:
    return feature_plan.labelled(filters.to_train(clean(spark, sf))).select("raceid", "flag", "horsecount", "pop", "odds")


TRAIN = f"(SELECT raceid, {S.LABEL} AS flag, horsecount, pop, odds FROM clean WHERE result IS DISTINCT FROM 999)"
register("split_stratified",
         lambda spark, sf: sampling.split_stratified(
             materialize(_train(spark, sf), "train"), "flag", "raceid").select("raceid", "flag", "is_test"),
         f"""SELECT raceid, flag, row_number() OVER (PARTITION BY flag ORDER BY md5('0:' || raceid), raceid)
             <= floor(count(*) OVER (PARTITION BY flag) * 0.3::DOUBLE) AS is_test FROM {TRAIN}""", "clean")
register("split_random3",
         lambda spark, sf: sampling.split_random(_train(spark, sf), "raceid").select("raceid", "part"),
         f"""SELECT raceid, CASE WHEN draw < 0.2 THEN 'test' WHEN draw < 0.36 THEN 'valid' ELSE 'train' END AS part FROM (
             SELECT raceid, CAST('0x' || substr(md5('0:' || raceid), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS draw
             FROM {TRAIN})""", "clean")


def _smote(spark, sf):
    rows = materialize(_train(spark, sf), "train")
    return sampling.smote(rows, "flag", "raceid", ["pop", "odds"], ["horsecount"])


register("smote_balance", _smote)
register("smote_counts", lambda spark, sf: _smote(spark, sf).groupBy("flag").agg(F.count("*").alias("n")),
         f"""SELECT flag, max(n) OVER () AS n FROM (SELECT flag, count(*) AS n FROM {TRAIN} WHERE flag IS NOT NULL GROUP BY flag)""",
         "clean")
register("class_weights", lambda spark, sf: sampling.class_weights(_train(spark, sf), "flag"),
         f"SELECT flag, (1 / n) * (sum(n) OVER () / 2) AS weight FROM (SELECT flag, count(*) AS n FROM {TRAIN} GROUP BY flag)",
         "clean", ("weight",))
register("split_by_class", lambda spark, sf: sampling.of_class(_train(spark, sf), "flag", 1),
         f"SELECT * FROM {TRAIN} WHERE flag = 1", "clean", ("odds",))


# ---- Models, evaluation, blend ----------------------------------------------------------------------

def _gbm_input(spark, sf):
    data = materialize(predict_plan.prep_gbm(finished(spark, sf)), "gbm")
    return filters.to_train(data), filters.to_predict(data), predict_plan.model_columns(data)


def _score_gbt(spark, sf):
    train, pred, used = _gbm_input(spark, sf)
    return scoring.score_gbt(train, pred, used, C.GBM_CATEGORICALS, rounds=CONFIG.gbm_rounds, counted=C.GBM_COUNTED)


def _tune_gbt(spark, sf):
    train, _, used = _gbm_input(spark, sf)
    return scoring.tune_gbt(train, used, C.GBM_CATEGORICALS, counted=C.GBM_COUNTED)[1]


register("score_gbt", _score_gbt)
register("tune_gbt", _tune_gbt)
register("score_mlp", lambda spark, sf: predict_plan.network_scores(finished(spark, sf), CONFIG))

SCORED = f"(SELECT raceid, {S.LABEL} AS flag, {GIVEN} FROM clean WHERE result IS DISTINCT FROM 999)"
CELLS = ", ".join(f"count(*) FILTER (WHERE {a} AND {b}) AS {n}" for n, a, b in (
    ("tp", "gbm_pred >= 0.5", "flag = 1"), ("fp", "gbm_pred >= 0.5", "flag = 0"),
    ("tn", "gbm_pred < 0.5", "flag = 0"), ("fn", "gbm_pred < 0.5", "flag = 1")))
register("metrics_binary",
         lambda spark, sf: evaluation.binary_metrics(given_scores(_train(spark, sf)), "flag", "gbm_pred"),
         f"""SELECT (tp + tn) / (tp + fp + tn + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
             coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1
             FROM (SELECT {CELLS} FROM {SCORED})""", "clean", ("accuracy", "precision", "recall", "f1"))
register("metrics_auc",
         lambda spark, sf: evaluation.area_metrics(
             materialize(given_scores(_train(spark, sf)).select("flag", "gbm_pred"), "scored"), "flag", "gbm_pred"),
         f"""SELECT tp, fp, tn, fn, roc_auc, pr_auc FROM (SELECT {CELLS} FROM {SCORED}),
             (SELECT (sum(CASE WHEN flag = 1 THEN mid END) - p * (p + 1) / 2) / (p * n) AS roc_auc FROM (
               SELECT flag, rank() OVER (ORDER BY gbm_pred) + (count(*) OVER (PARTITION BY gbm_pred) - 1) / 2 AS mid,
                 count(*) FILTER (WHERE flag = 1) OVER () AS p, count(*) FILTER (WHERE flag = 0) OVER () AS n
               FROM {SCORED}) GROUP BY p, n),
             (SELECT sum((recall - before) * (precision + earlier) / 2) AS pr_auc FROM (
               SELECT recall, precision, lag(recall, 1, 0.0) OVER s AS before, lag(precision, 1, precision) OVER s AS earlier
               FROM (SELECT gbm_pred, sum(sum(flag)) OVER d / sum(sum(flag)) OVER () AS recall,
                       sum(sum(flag)) OVER d / sum(count(*)) OVER d AS precision
                     FROM {SCORED} GROUP BY gbm_pred WINDOW d AS (ORDER BY gbm_pred DESC))
               WINDOW s AS (ORDER BY gbm_pred DESC)))""", "clean", ("roc_auc", "pr_auc"))

BLEND = "(gbm_pred * 0.45::DOUBLE + tf_pred * 0.55::DOUBLE)"
MARK = """CASE WHEN gbm_pred >= 0.5 AND tf_pred >= 0.5 THEN '◎' WHEN gbm_pred >= 0.5 OR tf_pred >= 0.5 THEN '〇' ELSE '×' END"""
register("blend_scores",
         lambda spark, sf: report.blended(given_scores(clean(spark, sf))).select("raceid", "gbm_pred", "tf_pred", "probability"),
         f"SELECT raceid, gbm_pred, tf_pred, {S.rnd(BLEND, 2)} AS probability FROM (SELECT raceid, {GIVEN} FROM clean)",
         "clean", ("gbm_pred", "tf_pred", "probability"))
register("prediction_marks",
         lambda spark, sf: report.marked(given_scores(clean(spark, sf))).select("raceid", "new_mark_flag", "new_flag"),
         f"SELECT raceid, {MARK} AS new_mark_flag, CASE WHEN {BLEND} >= 0.5 THEN 1 ELSE 0 END AS new_flag "
         f"FROM (SELECT raceid, {GIVEN} FROM clean)", "clean")


def _report(spark, sf):
    rows = materialize(filters.to_predict(_history(spark, sf)).select("result", *C.REPORT_COLUMNS), "history")
    given = given_scores(rows)
    return report.prediction_report(rows, given.select("raceid", "gbm_pred"), given.select("raceid", "tf_pred"))


register("prediction_report", _report,
         f"""SELECT {', '.join(C.REPORT_COLUMNS)}, gbm_pred, tf_pred, {S.rnd(BLEND, 2)} AS probability, {MARK} AS new_mark_flag,
             CASE WHEN {BLEND} >= 0.5 THEN 1 ELSE 0 END AS new_flag
             FROM (SELECT *, {GIVEN} FROM history WHERE result = 999)""", "history",
         ("speedindex", "last_race_index", "gbm_pred", "tf_pred", "probability"))


# ---- Feature selection ------------------------------------------------------------------------------

CANDIDATES = tuple(c for c in C.FEATURE_GROUPS["numeric"] if c not in COMPONENTS)
CHOSEN = 10


def _candidates(spark, sf) -> DataFrame:
    """The finished table's recent rows with all numeric features, rounded so that equal values are equal anywhere."""
    rows = recent(spark, sf)
    return values.rounded(rows.select("raceid", "flag", *[F.col(c).cast("double").alias(c) for c in CANDIDATES]), CANDIDATES, 6)


def _mutual_information(spark, sf) -> DataFrame:
    rows = materialize(_candidates(spark, sf), "candidates", compiled=True)
    return selection.mutual_information(rows, CANDIDATES, "flag", k=CHOSEN)


def _report_file(spark, sf) -> DataFrame:
    """The best features, written as a report and read back."""
    report_ = selection.top_features(_mutual_information(spark, sf), CHOSEN)
    path = scratch_path(spark, "report")
    files.write_report(report_, path)
    return files.read_predictions_csv(spark, path, report_.schema)


def _scorer(spark, sf, folds: int = 5, most: int | None = None) -> tuple[selection.ForestScorer, list[str]]:
    """Wrapper searches take all numeric features that vary, components too; ``most`` keeps the most informative ones."""
    names = C.FEATURE_GROUPS["numeric"]
    rows = recent(spark, sf).select("raceid", "flag", *[F.col(c).cast("double").alias(c) for c in names])
    rows = materialize(rows, "candidates", compiled=True)
    varying = [r["feature"] for r in selection.variance_report(rows, names).filter("kept AND NOT low").collect()]
    if most:
        best = selection.top_features(selection.mutual_information(rows, sorted(varying), "flag"), most).collect()
        varying = [r["feature"] for r in best]
    return selection.ForestScorer(rows, varying, "flag", "raceid", folds=folds, trees=10, depth=4, parallelism=8), varying


CANDIDATE_SQL = f"""(SELECT raceid, flag, {', '.join(f'{S.rnd(f"{chr(34)}{c}{chr(34)}::DOUBLE", 6)} AS "{c}"' for c in CANDIDATES)}
    FROM finished WHERE result IS DISTINCT FROM 999 AND days >= {S.RECENT})"""
_mi_bins = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, "{c}" AS v, flag FROM candidates""" for c in CANDIDATES)
MI_SQL = f"""
    WITH candidates AS {CANDIDATE_SQL}, long AS ({_mi_bins}),
    cum AS (SELECT feature, v, count(*) AS c, sum(count(*)) OVER (PARTITION BY feature ORDER BY v) AS upto,
              sum(count(*)) OVER (PARTITION BY feature) AS size FROM long GROUP BY feature, v),
    edges AS (SELECT DISTINCT feature, v AS edge FROM cum, range(1, 10) AS s(i)
              WHERE ceil(round(i / 10 * size, 6)) <= upto AND ceil(round(i / 10 * size, 6)) > upto - c),
    binned AS (SELECT cum.feature, cum.v, count(edge) AS bin FROM cum LEFT JOIN edges
               ON cum.feature = edges.feature AND cum.v > edge GROUP BY cum.feature, cum.v),
    cells AS (SELECT feature, bin, flag, count(*) AS n FROM long JOIN binned USING (feature, v) GROUP BY ALL),
    parts AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY feature, bin) AS nb,
                sum(n) OVER (PARTITION BY feature, flag) AS nl FROM cells),
    scored AS (SELECT feature, sum(n / total * ln(n * total / (nb * nl))) AS score FROM parts GROUP BY feature)
    SELECT feature, row_number() OVER (ORDER BY round(score, 9) DESC, feature) <= {CHOSEN} AS kept, score FROM scored"""
register("fs_variance", lambda spark, sf: selection.variance_report(_candidates(spark, sf), CANDIDATES),
         f"WITH candidates AS {CANDIDATE_SQL} {_variance_sql('candidates', CANDIDATES)}", "finished", ("variance",))
register("fs_mutual_info", _mutual_information, MI_SQL, "finished", ("score",))


def _neighbour_information(spark, sf) -> DataFrame:
    rows = materialize(_candidates(spark, sf), "candidates", compiled=True)
    return selection.neighbour_information(rows, CANDIDATES, "flag", "raceid", CHOSEN)


def _digamma_sql(n: str) -> str:
    x = f"({n} + 6.0::DOUBLE)"
    return (f"(ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} ** 2) + 1 / (120 * {x} ** 4) - 1 / (252 * {x} ** 6) + 1 / (240 * {x} ** 8) - "
            + " - ".join(f"1.0::DOUBLE / ({n} + {i})" for i in range(6)) + ")")


_apart = ", ".join([f"z - lag(z, {i}) OVER w" for i in (1, 2, 3)] + [f"lead(z, {i}) OVER w - z" for i in (1, 2, 3)])
NEAR_SQL = f"""
    WITH candidates AS {CANDIDATE_SQL}, long AS ({_mi_bins.replace("SELECT ", "SELECT raceid, ")}),
    points AS (SELECT raceid, feature, flag, CAST(round(v * 1000000) AS BIGINT) * 65536
                 + CAST('0x' || substr(md5('0:' || raceid), 1, 4) AS BIGINT) AS z, count(*) OVER (PARTITION BY feature, flag) AS nl
               FROM long WHERE v IS NOT NULL AND flag IS NOT NULL QUALIFY nl > 1),
    near AS (SELECT *, least(3, nl - 1) AS used, list_sort(list_filter([{_apart}], lambda d: d IS NOT NULL)) AS d
             FROM points WINDOW w AS (PARTITION BY feature, flag ORDER BY z, raceid)),
    reach AS (SELECT *, greatest(d[used] - 1, 0) AS reach FROM near),
    counted AS (SELECT *, count(*) OVER (PARTITION BY feature) AS n,
                  count(*) OVER (PARTITION BY feature ORDER BY z RANGE BETWEEN reach PRECEDING AND reach FOLLOWING) AS m FROM reach),
    scored AS (SELECT feature, greatest({_digamma_sql("any_value(n)")} + avg({_digamma_sql("used")}) - avg({_digamma_sql("nl")})
                 - avg({_digamma_sql("m")}), 0.0) AS score FROM counted GROUP BY feature)
    SELECT feature, row_number() OVER (ORDER BY round(score, 9) DESC, feature) <= {CHOSEN} AS kept, score FROM scored"""
register("fs_neighbour_info", _neighbour_information, NEAR_SQL, "finished", ("score",))
register("fs_top_k", _report_file, f"SELECT * FROM ({MI_SQL}) ORDER BY round(score, 9) DESC, feature LIMIT {CHOSEN}",
         "finished", ("score",))


def _wrapped(search, *settings, folds: int = 5, most: int | None = None):
    def run(spark, sf):
        scorer, names = _scorer(spark, sf, folds, most)
        return search(scorer, names, *settings)
    return run


register("fs_forward", _wrapped(selection.forward_selection, 2))
register("fs_backward", _wrapped(lambda scorer, names: selection.backward_selection(scorer, names, len(names) - 2)))
register("fs_rfe", _wrapped(lambda scorer, names: selection.recursive_elimination(scorer, names, 2, share=0.2), folds=10))
register("fs_subsets", _wrapped(selection.subset_search, 3, 4, most=5))     # the number of subsets is exponential


# ---- Composite jobs ---------------------------------------------------------------------------------

register("clean_entries", clean, "SELECT * FROM clean", "clean", ENTRY_DOUBLES)
register("speed_index_full",
         lambda spark, sf: clean_plan.with_speed_index(materialize(clean(spark, sf), "entries")).select(*KEYS, "speedindex"),
         f"SELECT {', '.join(KEYS)}, speedindex FROM indices", "indices", ("speedindex",))
register("last_race_index_full",
         lambda spark, sf: clean_plan.with_last_race_index(clean(spark, sf)).select(*KEYS, "last_race_index"),
         f"SELECT {', '.join(KEYS)}, last_race_index FROM indices", "indices", ("last_race_index",))
register("build_features", lambda spark, sf: features(spark, sf).drop(*COMPONENTS), "SELECT * FROM features", "features",
         ("odds", "weight", "speedindex", "last_race_index", "pre_odds", "pre_3ftime", *ROLLED_DOUBLES, "resultmean", *ENCODINGS))
register("finish_features", lambda spark, sf: finished(spark, sf).drop(*COMPONENTS), "SELECT * FROM finished", "finished",
         FINISHED_DOUBLES)
register("finish_features_current", lambda spark, sf: finished(spark, sf, CURRENT).drop(*COMPONENTS),
         "SELECT * FROM finished_current", "finished_current",
         [c for c in FINISHED_DOUBLES if c not in ("resultmean", "rentai_ritu")])
register("finish_features_experiment", lambda spark, sf: finished(spark, sf, EXPERIMENT).drop(*COMPONENTS),
         "SELECT * FROM finished_experiment", "finished_experiment", (*FINISHED_DOUBLES, "popmax", "popmin"))
register("experiment_metrics", lambda spark, sf: experiment_plan.experiment_metrics(finished(spark, sf, EXPERIMENT), EXPERIMENT))
GBM_LEFT = [c for c in FINISHED_DOUBLES if c != "weight"]
register("prep_gbm", lambda spark, sf: predict_plan.prep_gbm(finished(spark, sf)).drop(*COMPONENTS),
         f"SELECT * EXCLUDE ({', '.join(C.GBM_UNUSED)}) REPLACE ({_codes_sql(C.GBM_CATEGORICALS)}) FROM finished",
         "finished", GBM_LEFT)
MLP_LEVELS = {c: LEVELS[c] for c in ("place", "class", "turf", "weather", "condition", "sex")}
MLP_LEVELS |= {"pre_place": LEVELS["place"], "pre_turf": LEVELS["turf"]}
_band_flags = ", ".join(f"""CAST(({BAND_SQL.format(c)}) = '{b}' AS INTEGER) AS "{c}_{b}" """
                        for c in ("distance", "pre_distance") for b in C.DISTANCE_BANDS)


def _network_input(spark, sf) -> DataFrame:
    """Written here, since a caller's session may run methods that the JVM never compiles."""
    return materialize(predict_plan.prep_mlp(finished(spark, sf)), "mlp", compiled=True)


register("prep_mlp", lambda spark, sf: _network_input(spark, sf).drop(*COMPONENTS),
         f"""SELECT * EXCLUDE ({', '.join(dict.fromkeys((*C.MLP_CATEGORICALS, *C.MLP_UNUSED)))}),
             {_one_hot_sql(MLP_LEVELS)}, {_band_flags} FROM finished""", "finished", FINISHED_DOUBLES)
register("predict_end_to_end",
         lambda spark, sf: predict_plan.predict_end_to_end(spark, race_entries(spark, sf), CONFIG,
                                                           root=scratch_path(spark, "run"), source=sf,
                                                           output=scratch_path(spark, "predictions")))


def _narrowed(spark, sf):
    rows = materialize(clean(spark, sf).select("raceid", "racenum", "horsecount", "horsenum", "pop", "result", "distance"), "entries")
    return values.narrowed(rows, values.profile_numeric(rows))


register("narrow_numeric", _narrowed, "SELECT raceid, racenum, horsecount, horsenum, pop, result, distance FROM clean", "clean")


# ---- The second configuration: user events ----------------------------------------------------------

EV = C.EVENTS
EVENT_WINDOW = f"PARTITION BY {EV.entity} ORDER BY {EV.when}, {EV.key}"


def _events_rolling(spark, sf):
    rolling = [history.Rolling("valuemean", EV.value, "avg"), history.Rolling("valuemax", EV.value, "max"),
               history.Rolling("valuemin", EV.value, "min")]
    return history.with_history(table(spark, sf, "events").select(EV.entity, EV.when, EV.key, EV.value), EV.entity,
                                [EV.when, EV.key], {}, rolling).select(EV.key, "valuemean", "valuemax", "valuemin")


def _events_pivot(spark, sf):
    rows = table(spark, sf, "events").select(EV.entity, EV.category, EV.value)
    kinds = aggregates.categories(rows, [EV.category])[EV.category]
    return aggregates.pivoted_rates(rows, EV.entity, EV.category, kinds, label=EV.value, prefix="user")


def _events_oof(spark, sf):
    rows = table(spark, sf, "events").select(EV.key, EV.entity, (F.col(EV.category) == "purchase").cast("int").alias("label"))
    rows = materialize(encode.stratified_folds(rows, "label", EV.key, 5), "folds")
    return encode.out_of_fold(rows, EV.entity, "label", "holdout_ts_user").select(EV.key, EV.entity, "fold", "holdout_ts_user")


register("events_lag_prev",
         lambda spark, sf: history.with_history(
             table(spark, sf, "events").select(EV.entity, EV.when, EV.key, EV.value, EV.category), EV.entity,
             [EV.when, EV.key], {EV.value: "pre_value", EV.category: "pre_type"}).select(EV.key, "pre_value", "pre_type"),
         f"""SELECT {EV.key}, lag({EV.value}) OVER ({EVENT_WINDOW}) AS pre_value,
             lag({EV.category}) OVER ({EVENT_WINDOW}) AS pre_type FROM events WHERE {EV.entity} IS NOT NULL""", (), ("pre_value",))
register("events_rolling_prev5", _events_rolling,
         f"SELECT {EV.key}, " + ", ".join(f"{f}({EV.value}) OVER p AS value{n}" for f, n in (
             ("avg", "mean"), ("max", "max"), ("min", "min")))
         + f""" FROM events WHERE {EV.entity} IS NOT NULL
             WINDOW p AS ({EVENT_WINDOW} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""", (),
         ("valuemean", "valuemax", "valuemin"))
KINDS = ("click", "error", "purchase", "signup", "view")
register("events_pivot_mean", _events_pivot,
         f"SELECT {EV.entity}, " + ", ".join(
             f"""coalesce({S.rnd_mean(f"avg(CASE WHEN {EV.category} = '{k}' THEN {EV.value} END)", 4)}, 0.0) AS user_{k}"""
             for k in KINDS) + f" FROM events WHERE {EV.entity} IS NOT NULL GROUP BY {EV.entity}")
register("events_oof_user", _events_oof,
         f"""WITH lab AS (SELECT {EV.key}, {EV.entity}, CASE WHEN {EV.category} = 'purchase' THEN 1 ELSE 0 END AS label FROM events),
             fol AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || {EV.key}), {EV.key}) - 1) % 5
                     AS INTEGER) AS fold FROM lab),
             agg AS (SELECT {EV.entity}, fold, sum(label) AS s, count(label) AS n FROM fol GROUP BY ALL)
             SELECT {EV.key}, fol.{EV.entity}, fol.fold, e AS holdout_ts_user FROM fol JOIN (
               SELECT {EV.entity}, fold, (sum(s) OVER w - s) / (sum(n) OVER w - n + 1) AS e FROM agg
               WINDOW w AS (PARTITION BY {EV.entity})) AS t ON fol.{EV.entity} = t.{EV.entity} AND fol.fold = t.fold""",
         (), ("holdout_ts_user",))
