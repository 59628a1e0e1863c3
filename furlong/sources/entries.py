"""The entry table over the bundled star schema: an order is a race, its parts are the runners."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.functions.numeric import moment
from furlong.operators.ordering import TASK_ROWS, dealt, grouped_numbers, hot_keys

PREDICT_FROM = datetime(2001, 7, 1)
PLACES = ("中京", "中山", "京都", "函館", "小倉", "新潟", "札幌", "東京", "福島", "阪神")
DISTANCES = (1000, 1200, 1600, 1800, 2000, 2500, 3570)
CONDITIONS = ("良", "稍", "重", "不")
WEATHERS = ("晴", "曇", "雨", "小雨", "雪")
CLASSES = ("新馬", "未勝利", "1勝", "2勝", "オープン")
SEXES = ("牡", "牝", "セ")

#: Entry keys are ``race * RUNNERS + runner``; runner keys must be smaller.
RUNNERS = 10**9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry_key(race: Column, runner: Column) -> Column:
    """A key that no other pair of race and runner has; a runner key out of range is an error."""
    fits = (runner >= 0) & (runner < RUNNERS)
    return F.when(fits, race * RUNNERS + runner).otherwise(
        F.raise_error(F.lit(f"runner keys must be from 0 to {RUNNERS - 1}")).cast("bigint"))


def _pick(position: Column, values: tuple) -> Column:
    """The value at a 0-based position; the last one for any larger position."""
    out = F.when(position == 0, values[0])
    for i, v in enumerate(values[1:-1], 1):
        out = out.when(position == i, v)
    return out.otherwise(values[-1])


def race_entries(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row per runner and race. Repeated lines of a part in an order are merged before anything else.

    Large tables are dealt by part for the merge and the join with parts, then by race for the join with orders and
    the numbering, over tasks of about ``task_rows`` lines.
    """
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("race"), F.col("l_partkey").alias("hid"), "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag")
    rows = raw.count()
    hot_races, hot_parts = (hot_keys(raw.select(k), [k]) for k in ("race", "hid"))
    # A hot part leaves the join with parts to AQE; its lines still spread over the races.
    lines = dealt(raw, ["hid"] if hot_parts is None else ["race", "hid"], rows, task_rows).groupBy("race", "hid").agg(
        F.min("l_suppkey").alias("sid"), F.max("l_quantity").alias("qty"),
        F.max("l_extendedprice").alias("price"), F.max("l_discount").alias("disc"),
        # The flag is one letter; its code keeps the aggregate in the hash operator.
        F.max(F.ascii("l_returnflag")).alias("rf"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("race"), F.col("o_orderdate").alias("days"),
        F.col("o_custkey").alias("cid"), F.col("o_orderpriority").alias("pri"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("hid"), "p_brand", "p_type", "p_size")
    # Part first: the rows are then dealt by race once, for the join with orders and for the numbering.
    known = lines.join(part, "hid")
    joined = (dealt(known, ["race"], rows, task_rows) if hot_races is None else known).join(orders, "race")
    r = grouped_numbers(joined, ["race"], {"pos": [F.desc("price"), F.col("hid")],
                                           "fav": [F.desc("qty"), F.col("hid")]},
                        count="horsecount", hot=lambda: hot_races)
    race, hid, pos, fav = F.col("race"), F.col("hid"), F.col("pos").cast("int"), F.col("fav").cast("int")
    ahead = F.col("days") >= moment(PREDICT_FROM)

    def label(letter: str, number: Column) -> Column:
        return F.concat(F.lit(letter), number.cast("string"))

    def settled(value: Column, unknown: object) -> Column:
        return F.when(ahead, F.lit(unknown)).otherwise(value)

    return r.select(
        entry_key(race, hid).alias("raceid"), race.alias("racenum"), "days",
        label("H", hid).alias("horsename"), label("J", F.col("sid")).alias("jocky"),
        label("T", F.col("sid") % 20).alias("trainer"),
        F.col("p_brand").alias("father"), F.col("p_type").alias("fathermon"),
        F.when(F.col("p_size") % 5 != 0, label("FT", F.col("p_size") % 5)).alias("fathertype"),
        label("M", hid % 50).alias("mother"),
        _pick(F.col("cid") % 10, PLACES).alias("place"),
        _pick(race % 7, DISTANCES).alias("distance"),
        F.when(race % 3 == 0, "ダ").otherwise("芝").alias("turf"),
        _pick(race % 4, CONDITIONS).alias("condition"),
        _pick(race % 5, WEATHERS).alias("weather"),
        F.when(F.substring("pri", 1, 1) == "1", CLASSES[0]).when(F.substring("pri", 1, 1) == "2", CLASSES[1])
        .when(F.substring("pri", 1, 1) == "3", CLASSES[2]).when(F.substring("pri", 1, 1) == "4", CLASSES[3])
        .otherwise(CLASSES[4]).alias("class"),
        _pick(hid % 3, SEXES).alias("sex"),
        F.when(F.col("rf") == ord("A"), "ﾏｸﾘ").when(F.col("rf") == ord("N"), "中団").alias("legtype"),
        "horsecount", fav.alias("horsenum"),
        F.when(hid % 41 != 0, fav).alias("pop"),
        F.when(hid % 43 != 0, F.lit(1.0) + F.col("qty") * 2).alias("odds"),
        F.when(hid % 37 != 0, F.lit(50.0) + F.col("p_size") % 10).alias("weight"),
        settled(F.when(hid % 47 == 0, 0).otherwise(pos), 999).alias("result"),
        settled(F.lit(60.0) + pos * 0.5 + F.col("qty"), 999.0).alias("time"),
        settled(F.lit(33.0) + F.col("disc") * 40, 999.0).alias("3ftime"),
        settled(fav, 999).alias("rank3"), settled(pos, 999).alias("rank4"))
