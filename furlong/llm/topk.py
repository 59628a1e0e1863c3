"""Exact top-k search by inner product with multi-resolution segment statistics.

Every vector is cut into 1, 2, 4, … segments. With the mean ``m`` and deviation ``s`` of a segment of length
``l``, the squared distance of two vectors is at least ``sum l * ((m1 - m2)**2 + (s1 - s2)**2)``; written for
inner products, the score is at most ``sum l * (m1 * m2 + s1 * s2)``. Bounds are taken coarse to fine, a pair
leaves as soon as its bound is below the k-th score found so far, and survivors get their exact score.

Blocks of queries meet blocks of candidates as units of work that are dealt over all tasks. The first block of
candidates is searched before the others, and its k-th scores are where the others begin.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.blocks import written
from furlong.llm.vectors import (
    BLOCK_ROWS, FOUND, answered, asked, blocks_of, classes, first_of, longs, matrix, met)

LEVELS = (1, 2, 4, 8, 16)
#: Queries and candidates compared at once inside a block.
STRIPE, TILE = 512, 2048
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def scaled(vector: Column | str, factor: int = 1024) -> Column:
    """``floor(factor * x)`` of every component as a double without a fraction, or null.

    Null if the vector is null or has a null or non-finite component (also after scaling). For factors that are
    powers of two the result is exact at any size.
    """
    v = F.col(vector) if isinstance(vector, str) else vector
    v = F.transform(v, lambda x: x.cast("double") * factor)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    whole = F.transform(v, lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x))
    return F.when(finite, whole)


def _sketch(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound the inner products of the vectors."""
    parts = [p for p in np.array_split(np.arange(x.shape[1]), segments) if len(p)]
    out = []
    for p in parts:
        part = x[:, p]
        root = np.sqrt(len(p))
        out += [part.mean(1) * root, part.std(1) * root]
    return np.stack(out, 1) if out else np.zeros((len(x), 1))


class _Searcher:
    """The k best candidate classes seen so far for queries of one length; ``floors`` are scores known to be reached."""

    def __init__(self, vectors: np.ndarray, floors: np.ndarray, k: int, levels: Sequence[int]):
        self.vectors, self.floors, self.k = vectors, floors.astype(np.float64), k
        self.levels = [s for s in levels if s < vectors.shape[1]]
        self.sketches = [_sketch(vectors, s) for s in self.levels]
        # Slack for rounding, relative to the sizes that go into a bound.
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.best = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.int64)]    # query, class, least, score

    def add(self, names: np.ndarray, least: np.ndarray, x: np.ndarray) -> None:
        sketches = [_sketch(x, s) for s in self.levels]
        norms = np.sqrt((x * x).sum(1))
        size = max(x.shape[1], 1)
        tops, own_tops = (np.abs(m).max(1, initial=0.0) for m in (x, self.vectors))
        for at in range(0, len(self.vectors), STRIPE):
            rows = slice(at, at + STRIPE)
            mine = self.vectors[rows]
            q, c = np.divmod(np.arange(len(mine) * len(x)), len(x))
            for own, theirs in zip(self.sketches, sketches, strict=True):
                if len(q) * 4 > len(mine) * len(x):
                    bound = (own[rows] @ theirs.T)[q, c]
                else:
                    bound = np.einsum("ij,ij->i", own[rows][q], theirs[c])
                slack = 0.5 + self.norms[rows][q] * norms[c] * (size * 1e-15 + 1e-12)
                keep = bound + slack >= self.floors[rows][q]
                q, c = q[keep], c[keep]
            if not len(q):
                continue
            large = own_tops[rows][q] * tops[c] * size >= 2.0 ** 53
            value = (mine @ x.T)[q, c] if len(q) * 4 > len(mine) * len(x) else np.einsum("ij,ij->i", mine[q], x[c])
            score = np.where(large, 0.0, value).astype(np.int64)
            if large.any():
                score[large] = _exact(mine, x, q[large], c[large])
            keep = score >= np.floor(self.floors[rows][q] * (1 - np.sign(self.floors[rows][q]) * 1e-15))
            self._merge(q[keep] + at, names[c[keep]], least[c[keep]], score[keep])

    def _merge(self, q: np.ndarray, names: np.ndarray, least: np.ndarray, score: np.ndarray) -> None:
        q, names, least, score = (np.concatenate(p) for p in zip(self.best, (q, names, least, score), strict=True))
        # Scores are longs, whose negation may overflow; the complement turns their order as well.
        kept = first_of(q, np.lexsort((least, ~score, q)), self.k)
        self.best = [q[kept], names[kept], least[kept], score[kept]]
        full, last = np.unique(self.best[0][::-1], return_index=True)
        counts = np.bincount(self.best[0], minlength=len(self.vectors))[full]
        lowest = self.best[3][::-1][last].astype(np.float64)
        full, lowest = full[counts == self.k], lowest[counts == self.k]
        self.floors[full] = np.maximum(self.floors[full], lowest)


def _exact(a: np.ndarray, b: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers of any size, cut to the range of a long."""
    rows = {int(i): [int(v) for v in a[i]] for i in np.unique(q)}
    cols = {int(i): [int(v) for v in b[i]] for i in np.unique(c)}
    out = [sum(map(int.__mul__, rows[i], cols[j])) for i, j in zip(q.tolist(), c.tolist(), strict=True)]
    return np.array([min(max(v, LOWEST), HIGHEST) for v in out], np.int64)


def _search(k: int, levels: Sequence[int]):
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if queries.num_rows and candidates.num_rows:
            floors = np.array([-np.inf if f is None else f for f in queries.column("floor").to_pylist()])
            searcher = _Searcher(matrix(queries), floors, k, levels)
            x, names, least = matrix(candidates), longs(candidates, "class"), longs(candidates, "least")
            for cut in range(0, len(x), TILE):
                part = slice(cut, cut + TILE)
                searcher.add(names[part], least[part], x[part])
            out = [longs(queries, "class")[searcher.best[0]], *searcher.best[1:]]
        return pa.table(dict(zip(("query", "class", "least", "score"), out, strict=True)))
    return search


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS,
               levels: Sequence[int] = LEVELS) -> DataFrame:
    """The k candidates with the highest inner product for every query; ties go to the smaller id.

    Both tables have ``id`` (long) and ``vector`` (array of whole numbers of any size, as longs or doubles); rows
    with a null in either take no part. A query row is not its own candidate; another row
    with its id or vector is. Only vectors of the same length are compared. Repeated query rows are answered each
    for itself, repeated candidates count each. Fewer than k candidates give fewer rows; an empty table gives none.
    Scores are exact; one beyond a long is ranked and shown as the largest or smallest long.

    Returns ``query_id, rank, vec_id, score``.
    """
    queries, candidates = written(_usable(queries), "queries"), _usable(candidates)
    known = classes(candidates, k + 1)
    wanted = asked(queries, known)
    lengths = sorted(r[0] for r in known.select(F.size("vector")).distinct().collect())
    found, schema = None, FOUND.format(kind="long")
    for n in lengths:
        mine, theirs = (t.filter(F.size("vector") == n) for t in (wanted, known))
        groups, pieces = blocks_of(mine.count(), block_rows), blocks_of(theirs.count(), block_rows)
        theirs = theirs.select("class", "least", "vector")
        head = F.pmod(F.xxhash64("class", F.lit(1)), F.lit(pieces)) == 0
        start = written(met(mine.withColumn("floor", F.lit(None).cast("double")), theirs.filter(head),
                            _search(k + 1, levels), schema, groups, 1), "topk")
        floors = start.groupBy(F.col("query").alias("class")).agg(F.count("*").alias("n"), F.min("score").alias("low"))
        floors = floors.select("class", F.when(F.col("n") == k + 1, F.col("low")).cast("double").alias("floor"))
        rest = met(mine.join(floors, "class", "left"), theirs.filter(~head), _search(k + 1, levels), schema, groups, pieces)
        part = start.unionByName(rest) if pieces > 1 else start
        found = part if found is None else found.unionByName(part)
    if found is None:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return answered(queries, wanted, found, known, k)


def _usable(rows: DataFrame) -> DataFrame:
    full = F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    return rows.filter(full).select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
