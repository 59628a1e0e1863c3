"""Balanced row numbers, windows and quantiles agree with plain Python on skewed keys."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from furlong.operators import ordering
from furlong.operators.history import Rolling, with_history


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows; another is null."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.randrange(6), i, float(rng.randrange(50))) for i in range(900)]
    rows = [(k, d, i, None if i % 17 == 0 else v) for k, d, i, v in rows]
    return rows, spark.createDataFrame(rows, "k string, day int, id long, v double").repartition(5)


def test_hot_keys_lists_only_large_groups(skewed):
    _, df = skewed
    assert ordering.hot_keys(df, ["k"], 10_000) is None
    assert [r.k for r in ordering.hot_keys(df, ["k"], 300).collect()] == ["hot"]


def test_number_rows_is_a_global_row_number(skewed):
    rows, df = skewed
    got = ordering.number_rows(df, [F.desc("day"), F.col("id")], "n").select("id", "n").collect()
    want = {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])), 1)}
    assert {r.id: r.n for r in got} == want


@pytest.mark.parametrize("hot_rows", [10_000, 300, 1])
def test_grouped_numbers_with_and_without_hot_keys(skewed, hot_rows):
    rows, df = skewed
    got = ordering.grouped_numbers(df, ["k"], {"n": [F.desc("day"), F.col("id")]}, count="size", hot_rows=hot_rows)
    groups = {}
    for r in sorted(rows, key=lambda r: (-r[1], r[2])):
        groups.setdefault(r[0], []).append(r[2])
    want = {i: (n, len(ids)) for ids in groups.values() for n, i in enumerate(ids, 1)}
    assert {r.id: (r.n, r.size) for r in got.collect()} == want


@pytest.mark.parametrize("hot_rows,piece_rows", [(10_000, 500), (300, 7), (300, 64), (1, 5)])
def test_history_is_the_same_for_hot_keys_in_pieces(skewed, hot_rows, piece_rows):
    rows, df = skewed
    rolling = [Rolling("m", "v", "avg"), Rolling("top", "v", "max"), Rolling("n", "one", "sum")]
    got = with_history(df.withColumn("one", F.lit(1)), "k", ["day", "id"], {"v": "pre_v"}, rolling,
                       hot_rows=hot_rows, piece_rows=piece_rows).collect()
    want, seen = {}, {}
    for k, d, i, v in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1], r[2])):
        past = seen.setdefault(k, [])
        known = [x for x in past[-5:] if x is not None]
        want[i] = (past[-1] if past else None, sum(known) / len(known) if known else None,
                   max(known, default=None), len(past[-5:]) or None)
        past.append(v)
    assert len(got) == len(want)
    for r in got:
        pre, mean, top, n = want[r.id]
        assert (r.pre_v, r.top, r.n) == (pre, top, n)
        assert r.m == (None if mean is None else pytest.approx(mean))


def test_current_row_frame_needs_two_values(spark):
    df = spark.createDataFrame([("h", i, v) for i, v in enumerate([4.0, None, 6.0, 1.0, 2.0, 3.0, 9.0])], "k string, d int, v double")
    got = with_history(df, "k", ["d"], {}, [Rolling("m", "v", "avg")], include_current=True).orderBy("d").collect()
    assert [r.m for r in got] == [None, None, 5.0, pytest.approx(11 / 3), 3.25, 3.0, 4.2]


def test_previous_frame_ignores_the_current_row(spark):
    rows = [("h", i, float(i)) for i in range(8)]
    other = [("h", i, v if i != 7 else 999.0) for _, i, v in rows]
    def last(data):
        df = spark.createDataFrame(data, "k string, d int, v double")
        return with_history(df, "k", ["d"], {}, [Rolling("m", "v", "avg")]).filter("d = 7").first().m
    assert last(rows) == last(other) == 4.0


def test_hash_ranks_follow_the_hash_order(skewed):
    rows, df = skewed
    got = ordering.hash_ranks(df, "k", "id", 3, "n", hex_digits=1).collect()
    groups = {}
    for r in rows:
        if r[0] is not None:
            groups.setdefault(r[0], []).append((hashlib.md5(f"3:{r[2]}".encode()).hexdigest(), r[2]))
    want = {i: n for ids in groups.values() for n, (_, i) in enumerate(sorted(ids), 1)}
    assert {r.id: r.n for r in got} == want


@pytest.mark.parametrize("share", [0.0, 0.001, 0.3, 1.0])
def test_mark_first_share_agrees_with_ranks(skewed, share):
    _, df = skewed
    ranked = ordering.hash_ranks(df, "k", "id", 3, "n")
    sizes = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    want = {r.id: r.n <= int(sizes[r.k] * share) for r in ranked.collect()}
    assert {r.id: r.m for r in ordering.mark_first_share(df, "k", "id", share, 3, "m").collect()} == want


def test_running_sums_are_global(skewed):
    rows, df = skewed
    got = ordering.running_sums(df, ["day", "id"], {"s": "id"}).collect()
    total, want = 0, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        total += r[2]
        want[r[2]] = total
    assert {r.id: r.s for r in got} == want


def test_exact_quantiles_and_medians(skewed):
    rows, df = skewed
    values = sorted(r[3] for r in rows if r[3] is not None)
    medians = {r.feature: r.median for r in ordering.exact_medians(df, ["v", "day"]).collect()}
    assert medians == {"v": statistics.median(values), "day": statistics.median(r[1] for r in rows)}
    got = {r["rank"]: r["value"] for r in ordering.exact_quantiles(df, ["v"], [0.1, 0.5, 0.9]).collect()}
    n = len(values)
    want = {repr(s): min(v for v in values if sum(x <= v for x in values) >= s * n) for s in (0.1, 0.5, 0.9)}
    assert got == want


@pytest.mark.parametrize("hot_rows,piece_rows", [(10**6, 500_000), (10, 7), (10, 2)])
def test_windows_look_ahead_across_pieces(spark, hot_rows, piece_rows):
    df = spark.range(100).select((F.col("id") % 20 == 0).cast("int").alias("k"), "id")

    def build(w):
        return {"before": F.lag("id", 2).over(w), "after": F.lead("id", 2).over(w)}
    out = ordering.preceding_windows(df, ["k"], ["id"], build, 2, hot_rows, piece_rows, ahead=2).collect()
    assert len(out) == 100
    for k in (0, 1):
        ids = sorted(r.id for r in out if r.k == k)
        for r in out:
            if r.k == k:
                at = ids.index(r.id)
                assert r.before == (ids[at - 2] if at >= 2 else None) and r.after == (ids[at + 2] if at + 2 < len(ids) else None)


def test_values_at_ranks_with_ties_gaps_and_special_values(spark):
    rng = random.Random(8)
    rows = [(i, rng.gauss(0, 1), float(rng.randrange(3)), rng.choice([None, 5.0]), rng.expovariate(1) ** 9,
             rng.choice([None, float("nan"), float("inf"), rng.random()]), None) for i in range(5000)]
    names = ["id", "even", "tied", "half", "far", "odd", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'id' else 'double'}" for n in names))
    shares = [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]
    got = {(r.feature, r["rank"]): r.value for r in ordering.exact_quantiles(df, names, shares).collect()}
    for place, name in enumerate(names):
        column = [r[place] for r in rows if r[place] is not None]
        column = sorted(v for v in column if v == v) + [v for v in column if v != v]
        for share in shares:
            want = column[max(math.ceil(round(share * len(column), 6)), 1) - 1] if column else None
            assert repr(got.get((name, repr(share)))) == repr(want if want is None else float(want)), (name, share)
    assert ordering.exact_medians(df.limit(0), ["even"]).collect() == []
