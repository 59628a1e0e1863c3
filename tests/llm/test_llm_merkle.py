"""Manifest against trees built by hand, multiproofs against their definition."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def record(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def root_and_paths(leaves):
    """(root, per leaf its siblings (before, after) per level), straight from the definition."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for leaf, i in enumerate(at):
            run = runs[i // 3]
            paths[leaf].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        level, at = [h("".join(r)) for r in runs], [i // 3 for i in at]
    return level[0], paths


def expected(rows):
    """rows: (key, group, leaf) -> sorted [(key, group, leaf, subroot, root, path)]."""
    groups = {}
    for key, group, leaf in rows:
        groups.setdefault(group, []).append((key is not None, key or 0, leaf, key))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {}
    for g in names:
        order = sorted(groups[g])
        done[g] = (order, *root_and_paths([leaf for _, _, leaf, _ in order]))
    root, tops = root_and_paths([done[g][1] for g in names])
    return sorted([(key, g, leaf, done[g][1], root, path + tops[i]) for i, g in enumerate(names)
                   for (_, _, leaf, key), path in zip(done[g][0], done[g][2])], key=str)


def got(df):
    return sorted([(r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]])
                   for r in df.collect()], key=str)


@pytest.mark.parametrize("depth, sizes", [(7, [1]), (7, [3]), (7, [4, 1]), (1, [40, 9, 10, 1, 1, 28]), (1, [1] * 100),
                                          (2, [5] * 30 + [200]), (7, [5] * 30 + [200])])
def test_manifest_equals_trees_built_by_hand(spark, monkeypatch, depth, sizes):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    rng = np.random.default_rng(len(sizes))
    names = [None, "", "z", "é", "Z", *[f"s{i}" for i in range(200)]]
    rows = [(int(k), names[g], h(f"{g}:{k}")) for g, n in enumerate(sizes) for k in rng.permutation(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(4)
    assert got(merkle.manifest(df)) == expected(rows)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, "a", h("x")), (None, "a", h("y")), (3, None, h("z")), (3, "a", h("z")), (3, "a", h("z")), (-1, "a", h("m"))]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").selectExpr(
        "*", "1 AS root", "'p' AS proof", "2 AS idx", "3 AS part", "4 AS g")
    found = merkle.manifest(df, carry=["root", "proof"])
    assert found.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof", "carried"]
    assert got(found) == expected(rows)
    assert {tuple(r["carried"]) for r in found.collect()} == {(1, "p")}
    assert merkle.manifest(df.limit(0)).count() == 0


def test_a_set_of_leaves_asks_for_what_it_cannot_derive_only():
    size, rng = 1_000, np.random.default_rng(0)
    for at in ([0], [999], [0, 999], list(range(1_000)), rng.choice(1_000, 50, False), list(range(300, 700))):
        own, needed = {(0, int(i)) for i in at}, {(lv, int(i)) for lv, x in merkle.missing(np.array(at), size) for i in x}
        n, level, known = size, 0, set(own)
        while n > 1:
            here = {i for lv, i in known | needed if lv == level}
            for i in [i for lv, i in known if lv == level]:
                assert set(range(i // 3 * 3, min(i // 3 * 3 + 3, n))) <= here     # every proof is complete
                known.add((level + 1, i // 3))
            n, level = -(-n // 3), level + 1
        assert not needed & known                                               # and nothing is asked for in vain
    assert list(merkle.missing(np.arange(1_000), size)) == []


def test_tampered_records_do_not_lead_to_the_root(spark, tmp_path):
    from furlong.llm.queries import QUERIES
    long = "line\n" * 300_000
    docs = [(i, f"s{i % 3}" if i % 7 else None, "en", i, f"a\nb{i}" if i % 2 else f"c{i}") for i in range(300)]
    docs += [(300, "s1", None, None, None), (301, "s1", "x", 5, ""), (302, "s0", "de", 9, long), (303, "s0", "é", 1, "ä:\nß"), (303, "s0", "é", 1, "ä:\nß")]
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    df.withColumn("root", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op12_manifest"](spark, str(tmp_path)).collect()
    leaf = {i: record((i, s, lang, n, t)) for i, s, lang, n, t in docs}
    want = {w[0]: w for w in expected([(i, s, record((i, s, lang, n, t))) for i, s, lang, n, t in docs])}
    assert len(found) == len(docs)
    for r in found:
        i, text = r["doc_id"], next(d[4] for d in docs if d[0] == r["doc_id"])
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf[i], want[i][3], want[i][4])
        if i != 303:
            assert r["proof_sha256"] == h("".join(a + z for a, z in want[i][5]))
        changed = zlib.crc32(str(i).encode()) % 2 == 0 and text is not None and "\n" in text
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])
    assert {r["verified"] for r in found} == {True, False}
