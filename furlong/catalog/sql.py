"""SQL building blocks of the checks: the entry view and the derived tables as common table expressions."""

from __future__ import annotations

from furlong import config as C
from furlong.operators.history import rolled_stats

CUT = "TIMESTAMP '2001-01-01 00:00:00'"
RECENT = "TIMESTAMP '2001-03-01 00:00:00'"


def rnd(expression: str, digits: int) -> str:
    return f"(round_even(({expression}) * 1e{digits}, 0) / 1e{digits})"


def rnd_mean(expression: str, digits: int) -> str:
    return rnd(rnd(expression, 9), digits)


def values(items) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in items)


def case_map(column: str, mapping: dict, default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {default} END"


ENTRIES = """
race_entries AS (
  WITH e AS (
    SELECT l_orderkey AS race, l_partkey AS hid, min(l_suppkey) AS sid, max(l_quantity) AS qty,
           max(l_extendedprice) AS price, max(l_discount) AS disc, max(l_returnflag) AS rf
    FROM lineitem GROUP BY l_orderkey, l_partkey),
  r AS (
    SELECT e.*, o_orderdate AS days, o_custkey AS cid, o_orderpriority AS pri, p_brand, p_type, p_size,
           CAST(row_number() OVER (PARTITION BY race ORDER BY price DESC, hid) AS INTEGER) AS pos,
           CAST(row_number() OVER (PARTITION BY race ORDER BY qty DESC, hid) AS INTEGER) AS fav,
           count(*) OVER (PARTITION BY race) AS horsecount
    FROM e JOIN orders ON race = o_orderkey JOIN part ON hid = p_partkey)
  SELECT race * 1000000000 + hid AS raceid, race AS racenum, days,
    'H' || hid AS horsename, 'J' || sid AS jocky, 'T' || (sid % 20) AS trainer, p_brand AS father, p_type AS fathermon,
    CASE WHEN p_size % 5 <> 0 THEN 'FT' || (p_size % 5) END AS fathertype, 'M' || (hid % 50) AS mother,
    CASE cid % 10 WHEN 0 THEN '中京' WHEN 1 THEN '中山' WHEN 2 THEN '京都' WHEN 3 THEN '函館' WHEN 4 THEN '小倉'
      WHEN 5 THEN '新潟' WHEN 6 THEN '札幌' WHEN 7 THEN '東京' WHEN 8 THEN '福島' ELSE '阪神' END AS place,
    CASE race % 7 WHEN 0 THEN 1000 WHEN 1 THEN 1200 WHEN 2 THEN 1600 WHEN 3 THEN 1800 WHEN 4 THEN 2000
      WHEN 5 THEN 2500 ELSE 3570 END AS distance,
    CASE WHEN race % 3 = 0 THEN 'ダ' ELSE '芝' END AS turf,
    CASE race % 4 WHEN 0 THEN '良' WHEN 1 THEN '稍' WHEN 2 THEN '重' ELSE '不' END AS condition,
    CASE race % 5 WHEN 0 THEN '晴' WHEN 1 THEN '曇' WHEN 2 THEN '雨' WHEN 3 THEN '小雨' ELSE '雪' END AS weather,
    CASE substr(pri, 1, 1) WHEN '1' THEN '新馬' WHEN '2' THEN '未勝利' WHEN '3' THEN '1勝' WHEN '4' THEN '2勝'
      ELSE 'オープン' END AS class,
    CASE hid % 3 WHEN 0 THEN '牡' WHEN 1 THEN '牝' ELSE 'セ' END AS sex,
    CASE rf WHEN 'A' THEN 'ﾏｸﾘ' WHEN 'N' THEN '中団' END AS legtype,
    horsecount, fav AS horsenum,
    CASE WHEN hid % 41 <> 0 THEN fav END AS pop,
    CASE WHEN hid % 43 <> 0 THEN CAST(1.0 + qty * 2 AS DOUBLE) END AS odds,
    CASE WHEN hid % 37 <> 0 THEN CAST(50 + p_size % 10 AS DOUBLE) END AS weight,
    CASE WHEN days >= TIMESTAMP '2001-07-01 00:00:00' THEN 999 WHEN hid % 47 = 0 THEN 0 ELSE pos END AS result,
    CAST(CASE WHEN days >= TIMESTAMP '2001-07-01 00:00:00' THEN 999 ELSE 60.0 + pos * 0.5 + qty END AS DOUBLE) AS time,
    CAST(CASE WHEN days >= TIMESTAMP '2001-07-01 00:00:00' THEN 999 ELSE 33.0 + disc * 40 END AS DOUBLE) AS "3ftime",
    CASE WHEN days >= TIMESTAMP '2001-07-01 00:00:00' THEN 999 ELSE fav END AS rank3,
    CASE WHEN days >= TIMESTAMP '2001-07-01 00:00:00' THEN 999 ELSE pos END AS rank4
  FROM r)"""

RECODE = f"""
    {case_map('class', C.CLASS_NAMES, 'class')} AS class,
    coalesce({case_map('legtype', C.STYLE_NAMES, 'legtype')}, '{C.DEFAULT_STYLE}') AS legtype,
    coalesce(fathertype, '{C.DEFAULT_SIRE_LINE}') AS fathertype"""

CLEAN = f"""
clean AS (
  SELECT * REPLACE ({RECODE})
  FROM race_entries
  WHERE distance IN ({values(C.FLAT_DISTANCES)}) AND result IS DISTINCT FROM 0
    AND pop IS NOT NULL AND odds IS NOT NULL AND "3ftime" IS NOT NULL)"""

BASE = f"""
base AS (
  SELECT place, distance, turf, {rnd_mean('avg(time)', 1)} AS basetime
  FROM clean WHERE result <= 3 GROUP BY place, distance, turf)"""

CONDITION_INDEX = "CASE " + " ".join(
    f"WHEN turf = '{t}' AND condition = '{c}' THEN {v}" for (t, c), v in C.CONDITION_INDEX.items()) + " ELSE 0 END"
CLASS_INDEX = "CAST(CASE class " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in C.CLASS_INDEX.items()) + f" ELSE {C.CLASS_INDEX_DEFAULT} END AS DOUBLE)"
SPEED = f"""(basetime * 10 - time * 10) * ((1 / nullif(basetime * 10, 0)) * 1000)
    + ({CONDITION_INDEX}) + (weight - 55) * 2 + 80"""
LAST_RACE = f"""((18 - result * (18 / nullif(horsecount, 0))) + (18 - pop / nullif(18 / nullif(horsecount, 0), 0)))
    * ({CLASS_INDEX})"""

INDICES = f"""
indices AS (
  SELECT clean.*, {SPEED} AS speedindex, {LAST_RACE} AS last_race_index
  FROM clean LEFT JOIN base USING (place, distance, turf))"""

LAGS = ", ".join(f'lag("{old}") OVER w AS {new}' for old, new in C.LAGGED.items())


def rolled(frame: str, least: int, extra: bool) -> str:
    out = [f'CASE WHEN count("{s.column}") OVER {frame} >= {least} THEN {s.how}("{s.column}") OVER {frame} END AS "{s.name}"'
           for s in rolled_stats(C.ROLLED)]
    if extra:
        out += [f"avg(result) OVER {frame} AS resultmean",
                f"CAST(sum(1) OVER {frame} AS BIGINT) AS count5sum",
                f"CAST(sum(CASE WHEN result <= 3 THEN 1 ELSE 0 END) OVER {frame} AS BIGINT) AS rentai5sum"]
    return ", ".join(out)


WINDOW = "WINDOW w AS (PARTITION BY horsename ORDER BY days, raceid)"
PREV5 = WINDOW + ", p AS (PARTITION BY horsename ORDER BY days, raceid ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
INCL5 = WINDOW + ", p AS (PARTITION BY horsename ORDER BY days, raceid ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"

HISTORY = f"""
history AS (
  SELECT * EXCLUDE (speedindex, last_race_index), 1 AS "count", CASE WHEN result <= 3 THEN 1 ELSE 0 END AS rentai,
    pre_speedindex AS speedindex, pre_last_race_index AS last_race_index
  FROM (SELECT *, {LAGS}, {rolled('p', 1, True)} FROM indices {PREV5})
  WHERE pre_speedindex IS NOT NULL)"""

BINARY = "CASE WHEN result >= 4 THEN 0 WHEN result BETWEEN 1 AND 3 THEN 1 ELSE result END"
PAST = f"""
past AS (SELECT * REPLACE ({BINARY} AS result) FROM clean WHERE days < {CUT})"""
RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY result ORDER BY md5('42:' || raceid), raceid) AS rank
  FROM past WHERE result IS NOT NULL)"""


def folded(p: C.Profile) -> str:
    """``(entity, fold, n, encoding)``."""
    return f"""(SELECT {p.entity}, fold, n,
        (sum(s) OVER f - s) / (sum(n) OVER f - n + 1) AS encoding
      FROM (SELECT {p.entity}, CAST((rank - 1) % {p.folds} AS INTEGER) AS fold, sum(result) AS s, count(result) AS n
            FROM ranked GROUP BY ALL) WINDOW f AS (PARTITION BY {p.entity}))"""


def encoding(p: C.Profile) -> str:
    return f"""(SELECT {p.entity}, {rnd_mean('sum(n * encoding) / sum(n)', 3)} AS {p.encoding}
      FROM {folded(p)} GROUP BY {p.entity})"""


PROFILES = (C.JOCKEY, C.FATHER, C.FATHERMON)
LABEL = "CASE WHEN result IN (1, 2, 3) THEN 1 ELSE 0 END"

FEATURES = f"""
features AS (
  SELECT history.* EXCLUDE (rank3, rank4, "3ftime", time, pre_speedindex, pre_last_race_index), {LABEL} AS flag,
    {", ".join(p.encoding for p in PROFILES)}
  FROM history {" ".join(f"LEFT JOIN {encoding(p)} USING ({p.entity})" for p in PROFILES)})"""

RATIOS = {"odds_hi": "odds / nullif(pop, 0)", "re_odds_hi": "pre_odds / nullif(pre_pop, 0)",
          "r34": "pre_rank4 / nullif(pre_rank3, 0)"}
DERIVED = ", ".join([
    "CASE WHEN distance % 400 = 0 THEN 1 ELSE 0 END AS flag_konkan",
    "CASE WHEN pre_distance % 400 = 0 THEN 1 ELSE 0 END AS flag_pre_konkan",
    f"coalesce({RATIOS['odds_hi']}, 0.0) AS odds_hi",
    f"coalesce({RATIOS['re_odds_hi']}, 0.0) AS re_odds_hi",
    f"coalesce(({RATIOS['odds_hi']}) * ({RATIOS['odds_hi']}), 0.0) AS odds_hi_sq",
    f"coalesce(({RATIOS['re_odds_hi']}) * ({RATIOS['re_odds_hi']}), 0.0) AS re_odds_hi_sq",
    "coalesce(CAST(pre_rank4 - pre_rank3 AS DOUBLE), 0.0) AS re_3_to_4time",
    f"coalesce(({RATIOS['r34']}) * ({RATIOS['r34']}), 0.0) AS re_3_to_4time_hi_sq",
    "coalesce(CAST(pre_pop - pop AS DOUBLE), 0.0) AS re_pop_now_pop",
    "coalesce(pre_odds - odds, 0.0) AS re_odds_now_odds",
    "coalesce(CAST(pre_result - pre_pop AS DOUBLE), 0.0) AS re_result_to_pop",
    "coalesce(CAST(popmax - popmin AS DOUBLE), 0.0) AS popmax_popmin",
    "coalesce(oddsmax - oddsmin, 0.0) AS oddsmax_oddsmin",
    f"{rnd('coalesce(rentai5sum / nullif(count5sum, 0), 0.0)', 3)} AS rentai_ritu",
])

FINISHED = f"""
filled AS (
  SELECT * REPLACE ({", ".join(f"coalesce({p.encoding}, (SELECT avg({p.encoding}) FROM features)) AS {p.encoding}" for p in PROFILES)})
  FROM features),
finished AS (
  SELECT * EXCLUDE (odds, pop, rentai5sum, count5sum, "count", rentai), {DERIVED}
  FROM filled WHERE COLUMNS(*) IS NOT NULL)"""

# The variant whose rolling frame holds the current race.
HISTORY_CURRENT = HISTORY.replace("history AS", "history_current AS").replace(
    rolled("p", 1, True), rolled("p", 2, False)).replace(PREV5, INCL5)
FEATURES_CURRENT = FEATURES.replace("features AS", "features_current AS").replace(
    "SELECT history.*", "SELECT history_current.*").replace("FROM history ", "FROM history_current ")
FINISHED_CURRENT = FINISHED.replace("filled", "filled_current").replace("FROM features", "FROM features_current").replace(
    "finished AS", "finished_current AS").replace("rentai5sum, count5sum, ", "").replace(
    DERIVED, DERIVED[:DERIVED.rindex("coalesce(oddsmax - oddsmin, 0.0) AS oddsmax_oddsmin")]
    + "coalesce(oddsmax - oddsmin, 0.0) AS oddsmax_oddsmin")
# The experimental variant: derive first, fill rolling columns with their means, then drop incomplete rows.
_ROLLED_FILL = ", ".join(f'coalesce("{s.name}", (SELECT avg("{s.name}") FROM wide)) AS "{s.name}"' for s in rolled_stats(C.ROLLED))
FINISHED_EXPERIMENT = FINISHED[:FINISHED.index("finished AS")] + f"""wide AS (SELECT *, {DERIVED} FROM filled),
finished_experiment AS (
  SELECT * EXCLUDE (odds, pop, rentai5sum, count5sum, "count", rentai)
  FROM (SELECT * REPLACE ({_ROLLED_FILL}) FROM wide) WHERE COLUMNS(*) IS NOT NULL)"""

STEPS = {"history_current": HISTORY_CURRENT, "features_current": FEATURES_CURRENT, "finished_current": FINISHED_CURRENT,
         "finished_experiment": FINISHED_EXPERIMENT, "race_entries": ENTRIES, "clean": CLEAN, "base": BASE, "indices": INDICES, "history": HISTORY, "past": PAST,
         "ranked": RANKED, "features": FEATURES, "finished": FINISHED}
NEEDS = {"race_entries": (), "clean": ("race_entries",), "base": ("clean",), "indices": ("base",),
         "history": ("indices",), "past": ("clean",), "ranked": ("past",), "features": ("history", "ranked"),
         "finished": ("features",), "history_current": ("indices",), "features_current": ("history_current", "ranked"),
         "finished_current": ("features_current",), "finished_experiment": ("features",)}


def with_tables(last: tuple[str, ...] | str, body: str) -> str:
    """``body`` preceded by the tables it names and everything they need."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for n in NEEDS[name]:
            visit(n)
        if name not in wanted:
            wanted.append(name)
    for name in (last,) if isinstance(last, str) else last:
        visit(name)
    return f"WITH {','.join(STEPS[n] for n in wanted)}\n{body}" if wanted else body


def six_digits(sql: str, doubles) -> str:
    """Round the named double columns of a query's result to six digits."""
    replaced = ", ".join(f'{rnd(chr(34) + c + chr(34), 6)} AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})" if doubles else sql
