"""Column names, value maps and constants of the racing configuration, and a second configuration.

Operators take column names as arguments; only the composite plans read these dataclasses.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

# --- Fixed values: they must be equal to the source data's own labels for results to agree. ---------

FLAT_DISTANCES = (1000, 1200, 1400, 1500, 1600, 1700, 1800, 2000, 2200, 2300, 2400, 2500, 2600, 3000, 3200, 3400, 3600)
FLAT_DISTANCES_WITH_1150 = (1000, 1150, *FLAT_DISTANCES[1:])

CLASS_NAMES = {"1勝": "500万", "2勝": "1000万", "3勝": "1600万"}
STYLE_NAMES = {"ﾏｸﾘ": "追込", "後方": "追込", "中団": "差し"}
DEFAULT_SIRE_LINE = "その他のエクリプス系"
DEFAULT_STYLE = "自在"

CONDITION_INDEX = {
    ("芝", "良"): -25,
    ("芝", "稍"): -15,
    ("芝", "重"): -5,
    ("ダ", "良"): -20,
    ("ダ", "稍"): -10,
}
CLASS_INDEX = {"新馬": 0.8, "未勝利": 0.8, "500万": 0.9, "1000万": 1.0, "1600万": 1.1}
CLASS_INDEX_DEFAULT = 1.2

DISTANCE_BANDS = {
    "sprint": (1000, 1200, 1400, 1500),
    "mile": (1600, 1700, 1800),
    "middle": (2000, 2200, 2300, 2400),
    "stayer": (2500, 2600, 3000, 3200, 3400, 3600),
}

RESULT_TO_PREDICT = 999
RESULT_EXCLUDED = 0
MARK_NONE, MARK_ONE, MARK_BOTH = "×", "〇", "◎"

# Latin names of the category values that appear in pivot column names.
PLACE_LATIN = {
    "中京": "tyukyou", "中山": "nakayama", "京都": "kyoto", "函館": "hakodate", "小倉": "kokura",
    "新潟": "niigata", "札幌": "sapporo", "東京": "tokyo", "福島": "fukushima", "阪神": "hannshin",
}
BAND_LATIN = {"マイル": "mile", "中距離": "tyukyori", "短距離": "tankyori", "長距離": "tyoukyori"}
SURFACE_LATIN = {"ダ": "d", "芝": "t", "不": "cf", "稍": "cy", "良": "cg", "重": "co"}

# Columns and the names of what is derived from them.
LAGGED = {
    "place": "pre_place", "turf": "pre_turf", "distance": "pre_distance", "pop": "pre_pop", "odds": "pre_odds",
    "rank3": "pre_rank3", "rank4": "pre_rank4", "3ftime": "pre_3ftime", "result": "pre_result",
    "speedindex": "pre_speedindex", "last_race_index": "pre_last_race_index",
}
ROLLED = {"pop": "pop", "odds": "odds", "3ftime": "3ftime", "speedindex": "speed"}

POST_RACE_COLUMNS = ("rank3", "rank4", "3ftime", "time")
GBM_CATEGORICALS = ("place", "turf", "distance", "weather", "condition", "sex", "horsename", "trainer",
                    "pre_place", "pre_turf", "pre_distance")
GBM_UNUSED = ("days", "racenum", "class", "jocky", "horsecount", "weight", "father", "mother",
              "fathertype", "legtype", "fathermon")
MLP_CATEGORICALS = ("place", "class", "turf", "weather", "distance", "condition", "sex",
                    "pre_place", "pre_turf", "pre_distance")
MLP_UNUSED = ("father", "mother", "fathermon", "fathertype", "legtype", "jocky", "trainer", "days", "horsename")
REPORT_COLUMNS = ("raceid", "place", "class", "distance", "horsename", "jocky", "racenum", "horsecount",
                  "speedindex", "last_race_index")

# --- End of fixed values. ---------------------------------------------------------------------------


def pivot_latin_names() -> dict[str, str]:
    """Pivot column names → their Latin form: places for all three entities, the rest for the sires."""
    names = {f"jockey_{k}": f"jockey_{v}" for k, v in PLACE_LATIN.items()}
    for entity in ("father", "fathertype"):
        values = PLACE_LATIN | BAND_LATIN | SURFACE_LATIN
        names |= {f"{entity}_{k}": f"{entity}_{v}" for k, v in values.items()}
    return names


# Codes of many values: trees get their frequency instead of splitting them by value.
GBM_COUNTED = ("horsename", "trainer")

@dataclass(frozen=True)
class Profile:
    """How one entity is profiled: pivoted categories, extra means, components, folds."""

    entity: str
    prefix: str
    categories: tuple[str, ...]
    means: tuple[str, ...] = ()
    components: int = 6
    folds: int = 5
    digits: int = 3

    @property
    def encoding(self) -> str:
        return f"holdout_ts_{self.prefix}"

    def component_names(self) -> list[str]:
        return [f"{self.prefix}_pca{i + 1}" for i in range(self.components)]


JOCKEY = Profile("jocky", "jockey", ("place",), components=6, folds=3, digits=4)
FATHER = Profile("father", "father", ("place", "distance", "turf", "condition"), ("3ftime",), components=9)
FATHERMON = Profile("fathermon", "fathermon", ("place", "distance", "turf", "condition"), ("3ftime",), components=13)


@dataclass(frozen=True)
class RaceConfig:
    """Settings of one run. ``variant`` presets are in :data:`PRODUCTION` and :data:`EXPERIMENT`."""

    distances: tuple[int, ...] = FLAT_DISTANCES
    history_before: datetime = datetime(2021, 1, 1)
    recent_from: datetime = datetime(2021, 11, 20)
    profiles: tuple[Profile, ...] = (JOCKEY, FATHER, FATHERMON)
    seed: int = 42
    include_current: bool = False       # rolling frame: True = the leaking 5-row frame with the current race
    impute_weight: bool = False         # median fill of base time and weight before the speed index
    drop_nulls_after: bool = False      # True = derive first, mean-fill rolling columns, then drop nulls
    gbm_weight: float = 0.45
    tf_weight: float = 0.55
    gbm_rounds: int = 100
    gbm_search: bool = False            # search depth and step size before the final fit
    network_layers: tuple[int, ...] = (32, 16)
    network_iterations: int = 100
    id_cols: tuple[str, ...] = field(default=("raceid", "days", "horsename"))


PRODUCTION = RaceConfig()
# The experimental variant also profiles entities by their mean label.
EXPERIMENT_PROFILES = tuple(replace(p, means=(*p.means, "result")) for p in (JOCKEY, FATHER, FATHERMON))
EXPERIMENT = RaceConfig(profiles=EXPERIMENT_PROFILES, distances=FLAT_DISTANCES_WITH_1150, drop_nulls_after=True, gbm_weight=0.55,
                        tf_weight=0.45, gbm_rounds=50)


DERIVED = ("flag_konkan", "flag_pre_konkan", "odds_hi", "re_odds_hi", "odds_hi_sq", "re_odds_hi_sq", "re_3_to_4time",
           "re_3_to_4time_hi_sq", "re_pop_now_pop", "re_odds_now_odds", "re_result_to_pop", "popmax_popmin",
           "oddsmax_oddsmin", "rentai_ritu")

# Named groups of numeric features, all of them columns of the finished feature table. A group is used by
# selecting those of its columns that are present.
_TEXT_LAGS = ("pre_place", "pre_turf", "pre_speedindex", "pre_last_race_index")
FEATURE_GROUPS: dict[str, tuple[str, ...]] = {
    "previous_race": (*(c for c in LAGGED.values() if c not in _TEXT_LAGS), "speedindex", "last_race_index"),
    "rolling": (*(f"{short}{stat}" for short in ROLLED.values() for stat in ("mean", "max", "min")), "resultmean"),
    "profiles": tuple(c for p in PRODUCTION.profiles for c in (p.encoding, *p.component_names())),
    "derived": DERIVED,
}
FEATURE_GROUPS["numeric"] = ("horsecount", "horsenum", "weight", *(c for group in FEATURE_GROUPS.values() for c in group))


@dataclass(frozen=True)
class EventConfig:
    """The same operators over a table of user events."""

    entity: str = "user_id"
    when: str = "ts"
    key: str = "event_id"
    value: str = "value"
    category: str = "event_type"


EVENTS = EventConfig()
