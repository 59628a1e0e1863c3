"""Substring deduplication against brute force."""

import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furlong.llm import lpf, repeats, substring


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_words(rows, n):
    docs = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(d[i:i + n]) for d in docs for i in range(len(d) - n + 1))
    out = []
    for (k, _), d in zip(rows, docs, strict=True):
        gone = [False] * len(d)
        for i in range(len(d) - n + 1):
            if seen[tuple(d[i:i + n])] > 1:
                gone[i:i + n] = [True] * n
        kept = " ".join(w for w, g in zip(d, gone, strict=True) if not g)
        out.append(str((k, len(d), sum(gone), sha(kept.encode()))))
    return sorted(out)


def brute_bytes(rows, n):
    docs = [(t or "").encode() for _, t in rows]
    first = {}
    order = [k if k is not None else 2**63 - 1 for k, _ in rows]
    for k, d in zip(order, docs, strict=True):
        for i in range(len(d) - n + 1):
            first[d[i:i + n]] = min(first.get(d[i:i + n], k), k)
    out = []
    for (k, _), o, d in zip(rows, order, docs, strict=True):
        gone = [False] * len(d)
        for i in range(len(d) - n + 1):
            if first[d[i:i + n]] < o:
                gone[i:i + n] = [True] * n
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append(str((k, len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone, strict=True) if not g)))))
    return sorted(out)


def corpus():
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 700, n)]
    passages = [word(int(rng.integers(20, 90))) for _ in range(6)]
    rows = []
    for i in range(120):
        words = word(int(rng.integers(0, 200)))
        for j in rng.integers(0, 6, 2):
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = passages[j]
        rows.append((200 - i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(300 + i, rows[i][1] + " tail") for i in range(10)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "é " * 400), (504, "loop the loop " * 60), (None, rows[4][1]),
             (5, rows[7][1]), (5, rows[7][1]), (None, rows[4][1]), (505, "x" * 3000), (-3, "y" + "x" * 60), (506, "日本語テキスト" * 30)]
    return rows


@pytest.fixture(scope="module", params=[(3 << 20, 4096), (6000, 4096), (6000, 3)])
def setting(request):
    size, hot = request.param
    patch = pytest.MonkeyPatch()
    patch.setattr(substring, "BLOCK_BYTES", size)
    patch.setattr(lpf, "BLOCK_BYTES", size)
    patch.setattr(repeats, "HOT", hot)
    yield
    patch.undo()


def test_words_equal_brute_force(spark, setting):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(1)).repartition(3)
    got = substring.without_repeats(df, length=12, keep_text=True).collect()
    assert sorted(str(tuple(r)[:4]) for r in got) == brute_words(rows, 12)
    for r in got:
        assert sha(" ".join(re.findall(r"[^\x20\x09-\x0d]+", r["text"])).encode()) == r["kept_sha256"]


def test_bytes_equal_brute_force(spark, setting):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc", F.lit(1)).repartition(3)
    got = lpf.without_later_copies(df, length=50, keep_bytes=True).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == brute_bytes(rows, 50)
    assert all(sha(bytes(r["kept"])) == r["kept_sha256"] for r in got)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.without_repeats(df).count() == lpf.without_later_copies(df).count() == 0


def test_automaton_counts_like_a_counter():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 3, int(rng.integers(4, 30))).tolist() for _ in range(40)]
    a = substring.Automaton()
    for i, t in enumerate(texts):
        a.add(t, i % 3 + 1)
    a.finish()
    for n in (1, 2, 4):
        seen = Counter()
        for i, t in enumerate(texts):
            for j in range(len(t) - n + 1):
                seen[tuple(t[j:j + n])] += i % 3 + 1
        for t in texts:
            assert a.occurrences(t, n) == [seen[tuple(t[j:j + n])] for j in range(len(t) - n + 1)]


def block_of(sizes, letters=b"abcd"):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(letters), n).astype(np.uint8)).decode() for n in sizes]
    return pa.table({"doc": pa.array(range(len(texts)), pa.int64()), "t": pa.array(texts)})


def test_regions_are_found_in_stretches_of_bounded_size():
    table = block_of([5000] * 200)
    repeats.regions(table, lpf.rule())    # powers are kept from the first time on
    tracemalloc.start()
    parts = repeats.regions(table, lpf.rule())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Hash and prefix of each byte stay; whole arrays of grams, minima and positions took 50 bytes a byte.
    assert peak < 30 * len(parts.sent)


@pytest.mark.parametrize("length, gram", [(50, 16), (16, 16), (5, 2), (1, 1)])
def test_regions_do_not_depend_on_the_stretch(monkeypatch, length, gram):
    table, rule = block_of([0, 3, 200, 0, 49, 50, 51, 400, 1]), lpf.rule(length, gram)
    whole = repeats.regions(table, rule)
    sizes = np.diff(whole.offsets)
    assert sorted(np.concatenate([np.arange(s, s + n) for s, n in zip(whole.start, whole.count, strict=True)])) == [
        int(o) + i for o, n in zip(whole.offsets, sizes, strict=False) for i in range(n - length + 1)]
    monkeypatch.setattr(repeats, "STRETCH", 7)
    cut = repeats.regions(table, rule)
    for name in ("inside", "anchor", "start", "count"):
        assert getattr(cut, name).tolist() == getattr(whole, name).tolist()
    names = np.unique(whole.names(np.flatnonzero(whole.inside), np.int64(1), length) | repeats.ONE)
    windows, places = cut.singles(names, length)
    assert windows.tolist() == np.flatnonzero(whole.inside).tolist()
    assert (names[places] == whole.names(windows, np.int64(1), length) | repeats.ONE).all()


def test_covered_symbols():
    rng = np.random.default_rng(1)
    for length in (1, 3, 10):
        starts = np.flatnonzero(rng.random(91) < 0.1)
        want = np.zeros(100, bool)
        for s in starts:
            want[s:s + length] = True
        assert repeats.covered(starts, length, 100).tolist() == want.tolist()
    assert repeats.covered(np.zeros(0, np.int64), 5, 4).tolist() == [False] * 4
