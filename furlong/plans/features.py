"""The feature table: indices, history, profiles, then imputation and derived columns."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions import racing
from furlong.functions.numeric import ratio_or_zero, rnd, square
from furlong.operators import aggregates, encode, filters, history, values
from furlong.plans.clean import clean_entries, with_indices
from furlong.session import materialize, shared_dir
from furlong.sources.files import checkpoint_path, saved_or_built


def labelled(df: DataFrame, name: str = "flag") -> DataFrame:
    return df.withColumn(name, racing.top3(F.col("result")))


def profile_tables(entries: DataFrame, config: C.RaceConfig = C.PRODUCTION, components: bool = True) -> list[DataFrame]:
    """One profile table per configured entity, all from rows before the cut date, numbered once.

    Pass written entries: rates read them directly, only the encodings need the numbered rows.
    The profiles do not depend on each other, so their jobs are submitted together.
    """
    past = filters.before(entries, "days", config.history_before)
    base = materialize(encode.profile_base(past, config.profiles, config.seed), "profile")
    rows = encode.profile_rows(past, config.profiles) if components else None
    used = list(dict.fromkeys(c for p in config.profiles for c in p.categories))
    values = aggregates.categories(rows, used) if components else None
    with ThreadPoolExecutor(len(config.profiles)) as pool:
        return list(pool.map(lambda p: materialize(encode.entity_profile(base, p, rows, values), "lookup"),
                             config.profiles))


def with_profiles(df: DataFrame, tables: Sequence[DataFrame], profiles: Sequence[C.Profile]) -> DataFrame:
    """Left-join written profile tables; each is broadcast only if its files are small enough."""
    for table, p in zip(tables, profiles, strict=True):
        df = df.join(table, p.entity, "left")
    return df


def build_features(raw: DataFrame, config: C.RaceConfig = C.PRODUCTION, components: bool = True) -> DataFrame:
    """Raw entries to the feature table that is saved: one row per entry that has a previous race.

    The cleaned entries are written once; base times, history and profiles all read that table.
    """
    entries = materialize(clean_entries(raw, config), "entries")
    rows = history.race_history(with_indices(entries, config), config.include_current, keys_from=entries)
    rows = labelled(rows).drop(*C.POST_RACE_COLUMNS, "pre_speedindex", "pre_last_race_index")
    return with_profiles(rows, profile_tables(entries, config, components), config.profiles)


def encoding_columns(df: DataFrame, config: C.RaceConfig) -> list[str]:
    wanted = {c for p in config.profiles for c in (p.encoding, *p.component_names())}
    return [c for c in df.columns if c in wanted]


def derived(df: DataFrame) -> DataFrame:
    """Columns derived from the current and the previous race; quotients by 0 and nulls become 0."""
    c = F.col

    def zero(value):
        return F.coalesce(value.cast("double"), F.lit(0.0))

    odds_hi, re_odds_hi = ratio_or_zero(c("odds"), c("pop")), ratio_or_zero(c("pre_odds"), c("pre_pop"))
    out = df.withColumns({
        "flag_konkan": racing.divisible_by_400(c("distance")),
        "flag_pre_konkan": racing.divisible_by_400(c("pre_distance")),
        "odds_hi": odds_hi,
        "re_odds_hi": re_odds_hi,
        "odds_hi_sq": square(odds_hi),
        "re_odds_hi_sq": square(re_odds_hi),
        "re_3_to_4time": zero(c("pre_rank4") - c("pre_rank3")),
        "re_3_to_4time_hi_sq": square(ratio_or_zero(c("pre_rank4"), c("pre_rank3"))),
        "re_pop_now_pop": zero(c("pre_pop") - c("pop")),
        "re_odds_now_odds": zero(c("pre_odds") - c("odds")),
        "re_result_to_pop": zero(c("pre_result") - c("pre_pop")),
        "popmax_popmin": zero(c("popmax") - c("popmin")),
        "oddsmax_oddsmin": zero(c("oddsmax") - c("oddsmin")),
    })
    if "count5sum" in df.columns:
        out = out.withColumn("rentai_ritu", rnd(ratio_or_zero(c("rentai5sum"), c("count5sum")), 3))
    return out


def finish_features(features: DataFrame, config: C.RaceConfig = C.PRODUCTION) -> DataFrame:
    """Saved feature table to model input: impute encodings, drop incomplete rows, derive, drop inputs."""
    df = values.filled_with_mean(features, encoding_columns(features, config))
    if not config.drop_nulls_after:
        df = derived(filters.complete(df))
    else:
        df = derived(df)
        df = values.filled_with_mean(df, [s.name for s in history.rolled_stats(C.ROLLED)])
        df = filters.complete(df)
    return df.drop("odds", "pop", "rentai5sum", "count5sum", "count", "rentai")


def feature_table(spark: SparkSession, raw: DataFrame, config: C.RaceConfig = C.PRODUCTION, root: str | None = None,
                  source: str = "", resume: bool = False, inputs: str | None = None) -> DataFrame:
    """Build, or resume from, the saved feature table and finish it.

    The path depends on the configuration and on ``source``, a name for the input, so that runs with
    different settings never read each other's table. A table with another fingerprint than ``inputs`` is refused.
    """
    path = checkpoint_path(root or shared_dir(spark), config, source)
    saved = saved_or_built(spark, path, lambda: build_features(raw, config), resume, inputs)
    return finish_features(saved, config)
