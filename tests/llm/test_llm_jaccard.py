"""The similarity join against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.llm import jaccard


def grams(text):
    import re
    w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [grams(t) for _, t in rows]
    link = [[j for j in range(len(rows)) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
            for i in range(len(rows))]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(link):
            low = min([label[i], *[label[j] for j in near]])
            if low != label[i]:
                label[i], changed = low, True
    names = {}
    for (k, _), c in zip(rows, label, strict=True):
        if k is not None:
            names[c] = min(names.get(c, k), k)
    return sorted(str((k, names.get(c), len(near))) for (k, _), c, near in zip(rows, label, link, strict=True))


def corpus():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(1, 250)))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(int(rng.integers(0, 4))):
            other = list(words)
            for _ in range(int(rng.integers(0, 3))):
                other[int(rng.integers(0, len(other)))] = "new"
            rows.append((len(rows), "\n".join(other)))
    base = [f"b{x}" for x in rng.integers(0, 999, 150)]
    for i in range(120):  # one large group of near copies
        other = list(base)
        other[i] = "changed"
        rows.append((len(rows), " ".join(other)))
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "a b"), (2004, "a b"), (2005, "a b c"), (None, rows[3][1]),
             (5, rows[5][1]), (None, None), (2006, "x " * 5000)]
    return rows


@pytest.mark.parametrize("small,block", [(128, 1024), (4, 16)])
def test_classes_and_links_equal_brute_force(spark, small, block):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set", F.lit("x")).repartition(6)
    got = jaccard.near_duplicates(df, small=small, block=block, recall=1 - 1e-7).collect()
    assert sorted(str((r["doc_id"], r["class_id"], r["n_links"])) for r in got) == brute(rows)


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["label"] for r in jaccard.components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 501: 500}
