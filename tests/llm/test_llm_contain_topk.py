"""Search and containment against brute force, with nulls, ties, repeats, empty tables and extra columns."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.llm import contain, topk


def brute_topk(rows, every, k):
    out = []
    for q, (qid, qv) in enumerate(rows):
        if qid is None or qv is None or qid % every:
            continue
        scored = [(-sum(a * b for a, b in zip(qv, v)), i) for c, (i, v) in enumerate(rows)
                  if i is not None and v is not None and c != q and len(v) == len(qv)]
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [8_192, 40])
def test_topk_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-500, 500, 24).tolist()) for i in range(300)]
    rows += [(i, [7] * 24) for i in range(300, 340)]  # ties
    rows += [(400, None), (None, [1] * 24), (404, [1, 2]), (405, [3, 4]), (410, []), (420, []), (20, [1] * 24), (30, rows[30][1])]
    df = spark.createDataFrame(rows, "id long, vector array<long>").withColumn("extra", F.lit(1)).repartition(5)
    got = topk.exact_topk(df.filter("id % 10 = 0"), df, k=5, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == brute_topk(rows, 10, 5)


@pytest.mark.parametrize("block_rows", [8_192, 20])
def test_topk_of_negative_and_large_vectors(spark, block_rows):
    b, rng = 2 ** 18, np.random.default_rng(4)
    rows = [(0, [b, b, 1, 1]), (1, [-b, -b, -2, -2]), (2, [-b, -b, -1, -1])]
    got = topk.exact_topk(spark.createDataFrame(rows[:1], "id long, vector array<long>"),
                          spark.createDataFrame(rows[1:], "id long, vector array<long>"), k=1).collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, -137438953474)]
    rows = [(i, (-rng.integers(1, 1 << int(rng.integers(1, 30)), 9)).tolist()) for i in range(120)]
    rows += [(i, rng.integers(1, 100_000, 9).tolist()) for i in range(120, 150)]
    rows += [(i, rng.integers(-9, 9, 9).tolist()) for i in (0, 0, 10, 151)]
    df = spark.createDataFrame(rows, "id long, vector array<long>").repartition(3)
    got = topk.exact_topk(df.filter("id % 10 = 0"), df, k=4, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == brute_topk(rows, 10, 4)


def test_topk_of_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, vector array<long>")
    one = spark.createDataFrame([(1, [1])], "id long, vector array<long>")
    assert topk.exact_topk(empty, one).count() == topk.exact_topk(one, empty).count() == 0


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 37)), rng.normal(size=(60, 37))
    last = None
    for s in (1, 2, 4, 8, 16):
        bound = topk._sketch(x, s) @ topk._sketch(y, s).T
        assert (bound >= x @ y.T - 1e-9).all()
        last = bound if last is None else last


def test_scaled_rejects_null_and_non_finite(spark):
    rows = [([1.0, -0.3],), ([1.0, None],), ([float("nan")],), ([float("inf")],), (None,), ([1e9, -1e12],), ([],)]
    got = [r[0] for r in spark.createDataFrame(rows, "v array<double>").select(topk.scaled("v")).collect()]
    assert got == [[1024, -308], None, None, None, None, [1024e9, -1024e12], []]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_containment_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    items = [(i, " ".join(word(int(rng.integers(5, 200))))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "a b c"), (3, items[3][1]), (93, "a b c d e")]
    docs = []
    for i in range(80):
        words = word(int(rng.integers(0, 3000)))
        for j in rng.integers(0, 30, 2):
            part = items[j][1].split()
            if rng.random() < 0.5 and len(part) > 60:
                part[len(part) // 2] = "changed"
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = part
        docs.append((i, " ".join(words).upper() if i % 7 == 0 else "\n".join(words)))
    docs += [(200, None), (201, ""), (202, "A b  C d\te f"), (5, docs[5][1]), (None, docs[6][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(-1)).repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("k", F.lit(0))
    want = []
    for i, t in docs:
        have = shingles(t)
        for j, s in items:
            w = shingles(s)
            if w and len(w & have) >= 0.8 * len(w):
                want.append((i, j, len(w & have), len(w)))
    for group in (2_000_000, 500):
        got = contain.contained_items(d, b, group_shingles=group).collect()
        assert sorted(map(str, [tuple(r)[:4] for r in got])) == sorted(map(str, want))
        kept = contain.without_items(d, b, group_shingles=group)
        assert kept.columns == d.columns
        hit = {(i) for i, *_ in want}
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in hit)


def test_containment_of_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert contain.contained_items(d, b).count() == 0
    assert contain.contained_items(b.withColumnRenamed("item_id", "doc_id"), b.limit(0)).count() == 0
