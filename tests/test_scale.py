"""Work that follows the size of the tables: tasks by rows, keys counted in buckets."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from furlong import session as S
from furlong.catalog import queries
from furlong.catalog.registry import QUERIES
from furlong.operators import ordering, scoring, selection
from furlong.operators.ordering import dealt, hot_keys
from furlong.plans import experiment, predict
from furlong.sources.entries import race_entries


def _star(folder, orders: int = 30, parts: int = 7) -> str:
    """Tables of the entry view with repeated lines, an order key twice, null keys and lines without a part."""
    day = datetime(2001, 1, 1)
    lines = [(o, p, p, 1.0 + o % 3, 10.0 * p, 0.0, "A") for o in range(orders) for p in range(parts + 1) for _ in range(2)]
    lines += [(None, 1, 1, 1.0, 1.0, 0.0, "N"), (1, None, 1, 1.0, 1.0, 0.0, "N")]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                            "l_discount double, l_returnflag string"),
        "orders": ([(o, day, o, "1-URGENT") for o in [*range(orders), 3]],
                   "o_orderkey long, o_orderdate timestamp, o_custkey long, o_orderpriority string"),
        "part": ([(p, f"B{p}", "T", p) for p in range(parts)], "p_partkey long, p_brand string, p_type string, p_size int")}
    for name, (rows, ddl) in tables.items():
        os.makedirs(folder, exist_ok=True)
        SparkSession.active().createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_tasks_of_the_entry_view_follow_the_rows(spark, tmp_path):
    folder = _star(tmp_path / "star")
    whole, dealt_out = race_entries(spark, folder), race_entries(spark, folder, task_rows=20)
    assert sorted(map(str, whole.collect())) == sorted(map(str, dealt_out.collect()))
    assert dealt_out.rdd.getNumPartitions() == -(-482 // 20)


def test_rows_are_dealt_by_key_only_when_they_are_many(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 10)
    fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(rows, ["k"], 100, 10).rdd.getNumPartitions() == 10
    assert dealt(rows, ["k"], 10 * fixed, 10).rdd.getNumPartitions() == rows.rdd.getNumPartitions()


def test_rows_are_dealt_also_if_the_session_has_more_partitions_than_cores(spark):
    """AQE would merge the many partitions into few tasks, which grow with the table."""
    rows, cores = spark.range(100).withColumn("k", F.col("id") % 7), spark.sparkContext.defaultParallelism
    fixed = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(20 * cores))
    try:
        assert dealt(rows, ["k"], 10 * cores + 1, 10).rdd.getNumPartitions() == cores + 1
        assert dealt(rows, ["k"], 10 * cores, 10).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", fixed)


def test_hot_keys_are_counted_only_in_full_buckets(spark, monkeypatch):
    rows = spark.createDataFrame([(k,) for k in [None] * 9 + [1] * 9 + [2] * 3], "k long")
    for listed in (0, 1000):
        monkeypatch.setattr(ordering, "LISTED_BUCKETS", listed)
        for buckets in (1, 1 << 16):
            monkeypatch.setattr(ordering, "KEY_BUCKETS", buckets)
            assert {r[0] for r in hot_keys(rows, ["k"], 5).collect()} == {None, 1}
            assert hot_keys(rows, ["k"], 9) is None


@pytest.fixture
def limits(spark, monkeypatch):
    """The session's method limit, first 65535 as by default, at each write."""
    own, write, seen = spark.conf.get(S.METHOD_LIMIT), DataFrameWriter.parquet, []

    def noted(writer, *args, **kwargs):
        seen.append(spark.conf.get(S.METHOD_LIMIT))
        return write(writer, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    spark.conf.set(S.METHOD_LIMIT, "65535")
    yield seen
    spark.conf.set(S.METHOD_LIMIT, own)


def test_tables_are_written_by_compiled_methods_on_request(spark, limits):
    wide = spark.range(5).select("id", *[(F.col("id") + i).alias(f"c{i}") for i in range(40)])
    assert [r["c3"] for r in S.materialize(wide, compiled=True).orderBy("id").collect()] == [3, 4, 5, 6, 7]
    S.materialize(wide)
    assert limits == ["8000", "65535"] and spark.conf.get(S.METHOD_LIMIT) == "65535"


def test_method_limit_comes_back_with_the_last_open_block_and_lower_ones_stay(spark, limits):
    with pytest.raises(KeyError), S.compiled_methods(spark):
        with S.compiled_methods(spark):
            pass
        assert spark.conf.get(S.METHOD_LIMIT) == "8000"
        raise KeyError
    assert spark.conf.get(S.METHOD_LIMIT) == "65535"
    spark.conf.set(S.METHOD_LIMIT, "4000")
    with S.compiled_methods(spark):
        assert spark.conf.get(S.METHOD_LIMIT) == "4000"
    assert spark.conf.get(S.METHOD_LIMIT) == "4000"


def test_information_and_variance_are_worked_out_once(spark, limits):
    rows = spark.range(40).selectExpr("cast(id AS double) AS a", "cast(id % 3 AS double) AS b", "cast(id >= 20 AS int) AS flag")
    found = selection.mutual_information(rows, ["a", "b"], "flag", bins=4)
    spread = selection.variance_report(rows, ["a", "b"])
    assert limits == ["8000", "8000"]
    assert {r["feature"]: round(r["score"], 6) for r in found.collect()}["a"] == 0.693147
    assert {r["feature"]: round(r["variance"], 2) for r in spread.collect()} == {"a": 133.25, "b": 0.67}


def test_candidates_are_read_without_writing_the_finished_table(spark, monkeypatch):
    given = spark.sql("""SELECT * FROM VALUES (1L, 1, TIMESTAMP_NTZ '2001-02-28 00:00:00'), (2L, 3, TIMESTAMP_NTZ '2001-03-01 00:00:00'),
                         (3L, 999, TIMESTAMP_NTZ '2001-07-02 00:00:00'), (4L, null, TIMESTAMP_NTZ '2001-04-01 00:00:00'),
                         (5L, 4, null) AS t(raceid, result, days)""")
    tags = []
    monkeypatch.setattr(queries, "features", lambda *a: given)
    monkeypatch.setattr(queries.feature_plan, "finish_features", lambda df, config: df.withColumns(
        {"flag": F.lit(1), **{c: F.col("raceid") / 3 for c in queries.CANDIDATES}}))
    monkeypatch.setattr(queries, "materialize", lambda df, tag="table", **kwargs: tags.append(tag) or df)
    found = queries._candidates(spark, "").orderBy("raceid").collect()
    assert [r["raceid"] for r in found] == [2, 4] and not tags
    assert found[0][queries.CANDIDATES[0]] == 0.666667


def test_model_inputs_are_written_by_compiled_methods(spark, monkeypatch):
    """The network's input (query, both plans) and the split of the trees' rows are wide and hold no join."""
    rows = spark.createDataFrame([(i, i % 2, float(i), 1) for i in range(20)], "raceid long, flag int, a double, result int")
    written = []

    def noted(df, tag="table", compiled=False):
        written.append((tag, compiled))
        return df
    for module in (queries, predict, experiment, scoring):
        monkeypatch.setattr(module, "materialize", noted)
    for module in (predict, experiment):
        monkeypatch.setattr(module, "prep_mlp", lambda df: df)
    for name in ("score_network", "chosen_network", "scores"):
        monkeypatch.setattr(scoring, name, lambda df, *a, **k: df)
    monkeypatch.setattr(scoring, "smote", lambda df, *a, **k: df.withColumn("synthetic", F.lit(0)))
    monkeypatch.setattr(queries, "finished", lambda *a: rows)
    assert QUERIES["prep_mlp"](spark, "").count() == 20
    monkeypatch.setattr(scoring, "network_parts", lambda df, *a, **k: df.withColumn("part", F.lit("test")))
    predict.network_scores(rows)
    experiment.held_out_network(rows)
    scoring.gbt_training_set(rows, ["a"], [])
    assert written == [("mlp", True)] * 3 + [("split", True)]
