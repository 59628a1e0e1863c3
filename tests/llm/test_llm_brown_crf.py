"""Language models against brute-force counts, normalisation and held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furlong.llm import brown, crf, words

LANGS = {"xx": "ka ke ki ko ku sa se si so su", "yy": "bra bre bri dro dru plo ple stra", "zz": "ünd ör äch lich keit ver"}


def corpus(n=400):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        lang = list(LANGS)[i % 3]
        parts = LANGS[lang].split()
        words = ["".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(1, 120)))]
        rows.append((i, " ".join(words).capitalize(), lang))
    rows += [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 ... 34", "yy"), (1003, " \n", None), (None, rows[3][1], "xx"), (5, rows[5][1], "zz")]
    return rows


def learns(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).withColumn(
        "learn", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 10 != 0).withColumn("block", F.lit("x"))
    return rows, brown.scored(df, "learn", head=60, n_classes=12, rounds=6).collect()


def test_counts_and_base_equal_brute_force(scored):
    rows, got = scored
    count = Counter(t for i, text, _ in rows if learns(i) for t in tokens(text))
    total, kinds = sum(count.values()), len(count)
    want = []
    for i, text, _ in rows:
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens(text))
        want.append((str(i), len(tokens(text)), sum(count[t] > 0 for t in tokens(text)), total, round(base, 6)))
    assert sorted(want) == sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert all(r["learn"] == learns(r["doc_id"]) for r in got)


def test_held_out_texts_gain_over_unigrams(scored):
    held = [r for r in scored[1] if not r["learn"]]
    assert len(held) > 20 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.05 * sum(r["n_tokens"] for r in held)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in scored[1])


def test_transitions_are_distributions():
    counts = np.random.default_rng(0).integers(0, 4, (6, 6, 6))
    counts[2, 3] = 0
    assert np.allclose((10 ** brown.transitions(counts)).sum(-1), 1)


def test_exchange_gain_is_the_change_of_likelihood():
    rng = np.random.default_rng(1)
    n, k = 15, 4
    pairs = rng.integers(0, 6, (n, n))
    classes = rng.integers(0, k, n)

    def grid(c):
        out = np.zeros((k, k))
        np.add.at(out, (c[:, None].repeat(n, 1), c[None, :].repeat(n, 0)), pairs)
        return out

    def value(g):
        return brown._xlogx(g).sum() - brown._xlogx(g.sum(0)).sum() - brown._xlogx(g.sum(1)).sum()

    for u in range(n):
        a, b = np.flatnonzero(pairs[u]), np.flatnonzero(pairs[:, u])
        row = (u, a.astype("<u4").tobytes(), pairs[u][a].astype("<i8").tobytes(), b.astype("<u4").tobytes(), pairs[b, u].astype("<i8").tobytes())
        (_, best, gain), = brown._best_classes([row], classes, k, grid(classes))
        values = []
        for c in range(k - 1):
            new = classes.copy()
            new[u] = c
            values.append(value(grid(new)))
        assert np.isclose(max(values) - value(grid(classes)), gain) and np.isclose(values[best], max(values))


def test_word_exchange_gain_is_the_change_of_likelihood():
    rng = np.random.default_rng(2)
    n, k = 40, 5
    pairs = rng.poisson(0.7, (n, n))
    classes = rng.integers(0, k, n)

    def value(c):
        out = np.zeros((k, k))
        np.add.at(out, (c[:, None].repeat(n, 1), c[None, :].repeat(n, 0)), pairs)
        return out, words.value(out)

    sizes, codes, counts = [], [], []
    for u in range(n):
        dense = np.zeros(2 * k + 1, np.int64)
        for v in range(n):
            if v == u:
                dense[2 * k] += pairs[u, u]
            else:
                dense[classes[v]] += pairs[u, v]
                dense[k + classes[v]] += pairs[v, u]
        at = np.flatnonzero(dense)
        sizes.append(len(at))
        codes += at.tolist()
        counts += dense[at].tolist()
    grid, now = value(classes)
    for chunk in (7, 20_000):
        words.CHUNK, before = chunk, words.CHUNK
        best, gain = words.best_classes(classes, np.array(sizes), np.array(codes), np.array(counts), grid)
        words.CHUNK = before
        for u in range(n):
            moved = [value(np.where(np.arange(n) == u, c, classes))[1] for c in range(k - 1)]
            assert np.isclose(max(moved) - now, gain[u]) and np.isclose(moved[best[u]], max(moved))


def test_scores_equal_brute_force_from_the_classes_of_words(spark, monkeypatch):
    rows = corpus(150)
    seen = {}
    plain = words.class_sums

    def watched(told, rare_distinct, n):
        for r in told.filter("block >= 0").collect():
            seen.update(zip(np.frombuffer(r["names"], "<u8").tolist(), np.frombuffer(r["classes"], "u1").tolist(), strict=True))
        return plain(told, rare_distinct, n)

    monkeypatch.setattr(words, "class_sums", watched)
    monkeypatch.setattr("furlong.llm.blocks.BLOCK_BYTES", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(
        "learn", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 10 != 0)
    k = 6
    got = brown.scored(df, "learn", head=20, n_classes=k, rounds=4, word_rounds=3).collect()

    def named(token):
        if token is None:
            return int(brown.END_WORD)
        name, ending, _ = (x[0] for x in brown.tokens_of(pa.table({"t": [token]})))
        return int(name) if count[token] >= 2 else int(words.ending_names(brown.ENDINGS)[ending])

    count = Counter(t for i, text, _ in rows if learns(i) for t in tokens(text))
    names = {t: named(t) for _, text, _ in rows for t in tokens(text)}
    cls = {t: seen[names[t]] for t in names}
    assert len(set(cls.values())) == k and cls[None] == k - 1
    # Nearly all words that occur twice are named by themselves and may differ from words of their ending.
    assert sum(count[t] >= 2 and t is not None for t in cls) > 20
    tri, bi, uni = Counter(), Counter(), Counter()
    for i, text, _ in rows:
        if learns(i):
            h = (k, k)
            for t in tokens(text):
                tri[(*h, cls[t])] += 1
                bi[(h[1], cls[t])] += 1
                uni[cls[t]] += 1
                h = (h[1], cls[t])
    total = sum(uni.values())

    def transition(h, c):
        p = (uni[c] + 0.1) / (total + 0.1 * k)
        for counts, past in ((bi, (h[1],)), (tri, h)):
            here = [counts[(*past, x)] for x in range(k)]
            kinds = sum(x > 0 for x in here)
            if sum(here):
                p = (counts[(*past, c)] + kinds * p) / (sum(here) + kinds)
        return p

    size = Counter(cls[t] for t in count)
    want = []
    for i, text, _ in rows:
        h, score = (k, k), 0.0
        for t in tokens(text):
            c = cls[t]
            score += math.log10(transition(h, c) * (count[t] + 0.1) / (uni[c] + 0.1 * (size[c] + 1)))
            h = (h[1], c)
        want.append((str(i), round(score, 6)))
    assert sorted(want) == sorted((str(r["doc_id"]), round(r["score"], 6)) for r in got)


def test_words_leave_the_class_of_their_ending(spark):
    """Two kinds of words with the same endings alternate; a few are units, the others have neighbours to go by."""
    rng = np.random.default_rng(4)
    a, b = [f"a{i}xyz" for i in range(40)], [f"b{i}xyz" for i in range(40)]
    text = [(i, " ".join(w for _ in range(30) for w in (rng.choice(a), rng.choice(b)))) for i in range(60)]
    df = spark.createDataFrame(text, "doc_id long, text string").withColumn("learn", F.col("doc_id") < 50)

    def gain(rounds):
        got = brown.scored(df, "learn", head=20, n_classes=5, rounds=6, word_rounds=rounds).filter(~F.col("learn"))
        return got.agg(F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).first()[0]

    assert gain(4) > gain(0) + 0.2


def test_nothing_to_learn_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").withColumn("learn", F.lit(False))
    got = {r["doc_id"]: r for r in brown.scored(df, "learn").collect()}
    assert got[1]["n_tokens"] == 3 and got[1]["n_known"] == 0 and got[2]["n_tokens"] == 1 and got[1]["train_tokens"] == 0
    assert brown.scored(df.limit(0), "learn").count() == 0


def brute_marginals(scores, move):
    n, k = scores.shape
    ahead, back = np.zeros((n, k)), np.zeros((n, k))
    ahead[0] = np.exp(scores[0])
    for t in range(1, n):
        ahead[t] = (ahead[t - 1] @ np.exp(move)) * np.exp(scores[t])
        ahead[t] /= ahead[t].sum()
    back[-1] = 1
    for t in range(n - 2, -1, -1):
        back[t] = np.exp(move) @ (np.exp(scores[t + 1]) * back[t + 1])
        back[t] /= back[t].sum()
    p = ahead * back
    return p / p.sum(1, keepdims=True)


def test_forward_backward_equals_the_plain_recursion():
    rng = np.random.default_rng(0)
    offsets = np.array([0, 0, 5, 5, 140, 141])
    scores, move = rng.normal(size=(141, 3)), rng.normal(size=(3, 3))
    got = crf.forward_backward(scores, offsets, move)
    for a, b in zip(offsets, offsets[1:], strict=False):
        if b > a:
            assert np.allclose(got[a:b], brute_marginals(scores[a:b], move))


@pytest.fixture(scope="module")
def model():
    return crf.fit([(t, lang) for i, t, lang in corpus() if i is not None and i < 250 and t])


def test_held_out_language(spark, model):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("extra", F.lit(1)).repartition(3)
    got = crf.with_language(df, model).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "lang", "extra", "lang_pred", "score"}
    held = [r for r in got if r["doc_id"] is not None and 250 <= r["doc_id"] < 1000]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    for r in got:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["text"] is None or not any(c.isalpha() for c in r["text"]))


def test_code_switched_words_get_their_own_language(model):
    text = "kakesu sesuko kisa kokeki brabre drostra pleplo bridru stradro ündlich verkeit örlich ächlich"
    p, _, _ = crf.label_words(model, pa.array([text]))
    assert [model.langs[i] for i in p.argmax(1)] == ["xx"] * 4 + ["yy"] * 5 + ["zz"] * 4


def test_no_labels_give_no_language(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    r = crf.with_language(df, crf.fit([])).first()
    assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert crf.with_language(df.limit(0), crf.fit([])).count() == 0
