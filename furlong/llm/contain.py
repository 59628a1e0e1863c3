"""Size-partitioned MinHash containment search for short test items inside long documents.

Items are partitioned by their number of shingles, with a power of two ``u`` as upper bound of a partition.
For a partition, a document is a chain of windows of ``2 * u`` consecutive shingles that advance by ``u``, so
that any run of ``u`` shingles lies whole in one window. The containment threshold becomes a Jaccard threshold
by the two size bounds, and that gives the number of hash functions for the wished recall. Minima are taken
over blocks once and merged upwards, so all partitions share one pass. Any equal minimum makes a candidate;
candidates are verified by exact containment of the item's shingles in the document.

Items are broadcast in groups of bounded size, documents are only streamed and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm import text as T
from furlong.session import materialize

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
LEAST_BLOCK = 8
GROUP_SHINGLES = 2_000_000
SEEDS = T.mixed(np.arange(1, 4097, dtype=T.U64) * T.STEP) | T.U64(1)


def shingled(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in order, offsets per text); ASCII letters are lower-cased."""
    raw, offsets = T.buffer_of(texts)
    raw = T.LOWER[raw]
    starts, ends, per_text = T.words_of(raw, offsets)
    at = T.inside(per_text, words)
    grams = T.gram_hashes(T.word_hashes(raw, starts, ends), words)
    return grams[at], np.searchsorted(at, per_text)


def functions_needed(smallest: int, upper: int, threshold: float, recall: float) -> int:
    """Hash functions with which an item of ``smallest`` shingles in a window of ``2 * upper`` is found."""
    shared = threshold * smallest
    jaccard = shared / (2 * upper + smallest - shared)
    return min(len(SEEDS), max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(jaccard, 0.999)))))


class Index:
    """Signatures of a group of items by size partition."""

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: float, recall: float):
        self.ids, self.sets, self.threshold = ids, sets, threshold
        classes: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            classes.setdefault(max(LEAST_BLOCK, 1 << (len(s) - 1).bit_length()), []).append(i)
        self.parts = []
        for upper, members in sorted(classes.items()):
            n = functions_needed(min(len(sets[i]) for i in members), upper, threshold, recall)
            with np.errstate(over="ignore"):
                signs = np.array([[(sets[i] * seed).min() for i in members] for seed in SEEDS[:n]], T.U64)
            order = np.argsort(signs, axis=1, kind="stable")
            self.parts.append((upper, np.take_along_axis(signs, order, 1), np.array(members)[order]))
        self.block = min(classes) if classes else LEAST_BLOCK
        self.functions = max([len(s) for _, s, _ in self.parts], default=0)

    def candidates(self, grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (document, item) that share a minimum in some window."""
        counts = np.diff(offsets)
        blocks = -(-counts // self.block)
        owner = np.repeat(np.arange(len(counts)), blocks)
        if not len(owner):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.cumsum(blocks) - blocks
        starts = offsets[:-1][owner] + (np.arange(len(owner)) - first[owner]) * self.block
        docs, items = [], []
        for f in range(self.functions):
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat(grams * SEEDS[f], starts)
            who, upper = owner, self.block
            for size, signs, members in self.parts:
                while upper < size:
                    place = np.arange(len(who)) - np.searchsorted(who, who)
                    heads = np.flatnonzero(place % 2 == 0)
                    least, who, upper = np.minimum.reduceat(least, heads), who[heads], upper * 2
                if f >= len(signs):
                    continue
                window = least.copy()
                same = who[1:] == who[:-1]
                window[:-1][same] = np.minimum(least[:-1], least[1:])[same]
                left = np.searchsorted(signs[f], window)
                hits = np.flatnonzero(signs[f][np.minimum(left, len(signs[f]) - 1)] == window)
                right = np.searchsorted(signs[f], window[hits], side="right")
                width = right - left[hits]
                step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                docs.append(np.repeat(who[hits], width))
                items.append(members[f][np.repeat(left[hits], width) + step])
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(docs), np.concatenate(items)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def matches(self, grams: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(document, item, shared shingles) of all verified pairs."""
        out = []
        docs, items = self.candidates(grams, offsets)
        have, of = np.zeros(0, T.U64), -1
        for d, i in zip(docs.tolist(), items.tolist(), strict=True):
            if d != of:
                have, of = np.unique(grams[offsets[d]:offsets[d + 1]]), d
            want = self.sets[i]
            at = np.minimum(np.searchsorted(have, want), len(have) - 1)
            shared = int((have[at] == want).sum())
            if shared >= self.threshold * len(want):
                out.append((d, i, shared))
        return out


def item_groups(items: DataFrame, key: str, text: str, words: int, group_shingles: int) -> Iterator[tuple[list, list]]:
    """Items' keys and shingle sets, a group of bounded size at a time. Items without a shingle are left out."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in T.pieces(whole.column("t")):
                grams, offsets = shingled(whole.column("t").slice(a, b - a), words)
                sets = [np.unique(grams[offsets[i]:offsets[i + 1]]) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [whole.column("k").slice(a, b - a), pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64())], ["k", "s", "n"])

    rows = items.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    table = materialize(rows.mapInArrow(cut, "k long, s binary, n long").filter("n > 0"), "items")
    total = table.agg(F.sum("n")).first()[0] or 0
    groups = -(-total // group_shingles)
    for g in range(groups):
        mine = table.filter(F.pmod(F.xxhash64("k", "s"), F.lit(groups)) == g).select("k", "s").collect()
        if mine:
            yield [r["k"] for r in mine], [np.frombuffer(r["s"], T.U64) for r in mine]


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, words: int = WORDS,
                    recall: float = RECALL, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                    item_text: str = "text", group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """Rows ``doc, item, n_shared, n_shingles, containment`` with containment of at least ``threshold``.

    Containment is the share of an item's distinct shingles of ``words`` words that the whole document has,
    for items that lie together in the document. ASCII case is ignored. A null or empty text, or one of fewer
    than ``words`` words, has no shingle and matches nothing. Repeated documents or items give a row each;
    null keys stay null; other columns are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    names = (key, item_key)
    ddl = f"`{key}` long, `{item_key}` long, n_shared long, n_shingles long, containment double"
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    found = []
    for keys, sets in item_groups(items, item_key, item_text, words, group_shingles):
        sent = spark.sparkContext.broadcast(Index(keys, sets, threshold, recall))

        def search(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for whole in batches:
                for a, b in T.pieces(whole.column("t")):
                    hits = index.matches(*shingled(whole.column("t").slice(a, b - a), words))
                    if not hits:
                        continue
                    d, i, n = (list(x) for x in zip(*hits, strict=True))
                    sizes = [len(index.sets[x]) for x in i]
                    yield pa.RecordBatch.from_arrays(
                        [whole.column("k").slice(a, b - a).take(pa.array(d)),
                         pa.array([index.ids[x] for x in i], pa.int64()), pa.array(n, pa.int64()),
                         pa.array(sizes, pa.int64()), pa.array([x / y for x, y in zip(n, sizes, strict=True)])],
                        [*names, "n_shared", "n_shingles", "containment"])

        found.append(rows.mapInArrow(search, ddl))
    out = found[0] if found else spark.createDataFrame([], ddl)
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def without_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, words: int = WORDS,
                  recall: float = RECALL, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                  group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """``docs`` without the documents that contain an item, all columns as they were.

    Documents without text or shingles stay. Nothing is shuffled.
    """
    spark = docs.sparkSession
    place = docs.columns.index(text)
    for keys, sets in item_groups(items, item_key, item_text, words, group_shingles):
        sent = spark.sparkContext.broadcast(Index(keys, sets, threshold, recall))

        def clean(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for a, b in T.pieces(whole.column(place)):
                    part = whole.slice(a, b - a)
                    keep = np.ones(b - a, bool)
                    for d, _, _ in sent.value.matches(*shingled(part.column(place), words)):
                        keep[d] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
