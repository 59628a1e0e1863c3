"""Collocations against brute force, also with fingerprints so narrow that most of them collide."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.llm import phrases

SCHEMA = "text string, lang string"


def brute(rows, least, most, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, most + 1):
                found.update(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, every in counts.items():
        frequent = {p: f for p, f in every.items() if f >= least}
        kept, n = [], totals[lang]
        for p, a in frequent.items():
            words = p.split(" ")
            if len(words) < 2 or any(f" {p} " in f" {q} " and p != q and 100 * f >= 100 * a for q, f in frequent.items()):
                continue
            cuts = []
            for k in range(1, len(words)):
                le, r = frequent[" ".join(words[:k])], frequent[" ".join(words[k:])]
                cuts.append((1000 * a * n // (le * r), k, le, r))
            score, k, le, r = min(cuts)
            kept.append((-score, -a, p.encode(), (lang, p, a, le, r, n, score, k)))
        out += [(row[0], rank + 1, *row[1:]) for rank, (*_, row) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut").collect())


def corpus(seed, docs=120, vocabulary=40):
    rng = np.random.default_rng(seed)
    words = np.array([f"{'Ab' if i % 3 else 'é'}{i}" for i in range(vocabulary)])
    gaps = np.array([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"])
    weight = 1 / np.arange(1, vocabulary + 1)
    rows = []
    for i in range(docs):
        picked = words[rng.choice(vocabulary, int(rng.integers(0, 150)), p=weight / weight.sum())]
        text = "".join(w + g for w, g in zip(picked, gaps[rng.integers(0, len(gaps), len(picked))]))
        rows.append((text + (" to be or not to be" * 3 if i % 4 == 0 else ""), ["en", "de", None, "und", ""][i % 5]))
    return rows


@pytest.mark.parametrize("bits, block_bytes, top", [(32, 8 << 20, 2000), (32, 4_000, 7), (6, 4_000, 2000), (1, 30_000, 2000)])
def test_equals_brute_force_whatever_collides(spark, bits, block_bytes, top):
    rows = corpus(bits)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = phrases.collocations(df, 8, 5, top, block_bytes=block_bytes, bits=bits)
    want = brute(rows, 8, 5, top)
    assert got(found) == want and len(want) > 20


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    rows = [(None, None), ("", "en"), (None, "en"), (" . , ", "en"), ("one", "x"), ("A b\x00c\tA  b\x00c", "en")]
    rows += [("same words here again", "en")] * 30 + [("ha " * 50_000, "en"), ("x" * 300_000 + " y z", "en")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("f", "phrase", "words", "rid", "block")})
    assert got(phrases.collocations(df.repartition(3), 2, 4)) == brute(rows, 2, 4, 2000)
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df.filter("lang = 'x'")).count() == 0


def test_shorter_spans_and_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([(10 ** 12, 10 ** 15, 10 ** 12, 10 ** 13)], "a long, n long, l long, r long")
    a, n, le, r = (F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r"))
    row = counts.withColumns({"above": (a * n * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"),
                              "below": (le * r).cast("decimal(38,0)")}).selectExpr("above div below AS score").first()
    assert row["score"] == 1000 * 10 ** 27 // 10 ** 25
