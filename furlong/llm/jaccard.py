"""Similarity join of documents by word n-gram Jaccard with a chosen-path search.

A set samples paths of shared tokens: with ``n`` shingles it chooses each of them with probability
``1 / (threshold * n)`` by a hash of the path so far, so a set has 1/threshold children per level, and two sets
above the threshold share one on average. The choice depends on the set and the path alone; every document
finds its paths by itself. Buckets are split level by level until they are small; small ones are compared by
brute force, and those that stay large at the last level are compared in blocks. The tree is run as often as
the target recall needs. Every compared pair is verified with its exact Jaccard similarity.

Documents with the same set of shingles are one class from the start, so copies cost nothing. Pairs are counted
and joined inside a bucket and never emitted: a bucket returns counts and one link to its first member per
connected part. A pair that shares several buckets is counted in the first of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm import text as T
from furlong.llm.blocks import written

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
DEPTH = 2
SMALL = 1024
BLOCK = 1024
CELLS = 4_000_000
OPEN = 1_000_000
#: Shingles of a block of a bucket, at most, unless a single set has more.
BLOCK_SHINGLES = 1_000_000
BINS = 64
LIKELY = 0.5


def runs_needed(threshold: float, recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met at the last level with the given probability."""
    met = 1.0
    for _ in range(depth):
        met = 1 - math.exp(-met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer words than a shingle has has one shingle, all its words; one without words has none.
    """
    raw, offsets = T.buffer_of(texts)
    starts, ends, per = T.words_of(raw, offsets)
    hashes = T.word_hashes(raw, starts, ends)
    grams, prefix = T.gram_hashes(hashes, words), T.rolled(hashes, T.STEP)
    for a, b in zip(per[:-1].tolist(), per[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(grams[a:b - words + 1])
        else:
            short = T.spanned(prefix, np.array([a]), np.array([b]), T.STEP_INVERSE) ^ T.U64(b - a)
            yield short[:b - a and 1]


def chosen_paths(tokens: np.ndarray, threshold: float, runs: int, depth: int) -> list[np.ndarray]:
    """Per level, an array with one row per path and its ids on all levels so far."""
    least = min(1.0, 1 / (threshold * len(tokens)))
    limit = T.U64(min(int(least * 2.0**64), 2**64 - 1))
    keys = T.mixed(np.arange(1, runs + 1, dtype=T.U64) * T.BASE)
    trail = np.zeros((runs, 0), T.U64)
    out = []
    for _ in range(depth):
        with np.errstate(over="ignore"):
            drawn = (tokens[None, :] ^ keys[:, None]) * T.STEP
            drawn ^= drawn >> T.U64(29)
            drawn *= T.BASE
        path, token = np.nonzero(drawn <= limit)
        with np.errstate(over="ignore"):
            keys = T.mixed(keys[path] * T.STEP + tokens[token])
        trail = np.concatenate([trail[path], keys[:, None]], 1)
        out.append(trail)
    return out


def sketch_of(tokens: np.ndarray) -> bytes:
    """One byte of the smallest token of each of ``BINS`` bins, 0 for an empty bin."""
    out = np.zeros(BINS, np.uint8)
    high = tokens[::-1]  # sorted: the smallest token of a bin is written last
    out[(high & T.U64(BINS - 1)).astype(np.int64)] = ((high >> T.U64(8)) % T.U64(255)).astype(np.uint8) + 1
    return out.tobytes()


def signed(docs: DataFrame, key: str, text: str, threshold: float, words: int, runs: int, depth: int) -> DataFrame:
    """``k, set, n, sketch, p1 ..``: the set's hash, size and sketch, and its path ids and parents per level."""
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = pa.list_(pa.struct([("id", pa.int64()), ("parent", pa.int64())]))
        for whole in batches:
            for a, b in T.pieces(whole.column("t")):
                ids, sizes, sketches, levels = [], [], [], [[] for _ in range(depth)]
                for tokens in shingle_sets(whole.column("t").slice(a, b - a), words):
                    sizes.append(len(tokens))
                    sketches.append(sketch_of(tokens))
                    if not len(tokens):
                        ids.append(None)
                        for column in levels:
                            column.append(np.zeros((0, 2), T.U64))
                        continue
                    with np.errstate(over="ignore"):
                        whole_set = T.mixed(np.array([T.mixed(tokens).sum() + T.U64(len(tokens))]))
                    ids.append(int(whole_set.view(np.int64)[0]))
                    for column, trail in zip(levels, chosen_paths(tokens, threshold, runs, depth), strict=True):
                        parents = trail[:, -2] if trail.shape[1] > 1 else trail[:, -1]
                        column.append(np.stack([trail[:, -1], parents], 1))
                arrays = []
                for column in levels:
                    flat = np.concatenate(column).view(np.int64) if column else np.zeros((0, 2), np.int64)
                    cuts = np.append(0, np.cumsum([len(x) for x in column])).astype(np.int32)
                    items = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["id", "parent"])
                    arrays.append(pa.ListArray.from_arrays(pa.array(cuts), items).cast(level))
                yield pa.RecordBatch.from_arrays(
                    [whole.column("k").slice(a, b - a), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(sketches, pa.binary()), *arrays],
                    ["k", "set", "n", "sketch", *[f"p{i + 1}" for i in range(depth)]])

    ddl = "k long, set long, n long, sketch binary, " + ", ".join(
        f"p{i + 1} array<struct<id: long, parent: long>>" for i in range(depth))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return written(rows.mapInArrow(sign, ddl), "signed")


def merged(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the corpus: sorted and merged at every size, skew is split."""
    return left.join(right.hint("merge"), on, how)


def buckets(table: DataFrame, small: int, depth: int) -> DataFrame:
    """``bucket, set, size`` of all buckets with at least two members; a crowded bucket gives way to its children."""
    parts, crowded = [], None
    for level in range(1, depth + 1):
        # Copies of a set have the same paths and fall together before the shuffle.
        rows = table.select("set", F.explode(f"p{level}").alias("p")).select(
            "set", F.col("p.id").alias("bucket"), F.col("p.parent").alias("parent")).distinct()
        if crowded is not None:
            rows = rows.join(crowded, "parent", "left_semi")  # few buckets are crowded
        rows = rows.drop("parent")
        sizes = written(rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        done = sizes if level == depth else sizes.filter(F.col("size") <= small)
        parts.append(merged(rows, done, "bucket"))
        if level < depth:
            crowded = sizes.filter(F.col("size") > small).select(F.col("bucket").alias("parent"))
            if crowded.isEmpty():
                break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def without_twins(members: DataFrame) -> DataFrame:
    """Of buckets with the same members the first alone, found by sums over two hashes of the members."""
    members = written(members, "members")
    prints = members.groupBy("bucket").agg(
        F.first("size").alias("size"), F.bit_xor("set").alias("x"), F.bit_xor(F.xxhash64("set")).alias("y"))
    first = prints.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    return written(merged(members, first, "bucket", "left_semi"), "members")


def _matched(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common elements of each pair from ``left`` and ``right`` (indices into ``sets``).

    The sorted sets are walked through in ranges of values, so that few of their elements are open at a time.
    """
    both = np.unique(np.concatenate([left, right]))
    li, ri = np.searchsorted(both, left), np.searchsorted(both, right)
    out = np.zeros((len(left), len(right)), np.float64)
    ranges = max(1, -(-sum(len(sets[i]) for i in both) // OPEN))
    edges = np.array([min(k * (2**64 // ranges), 2**64 - 1) for k in range(1, ranges)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(sets[i], edges), [len(sets[i])]]) for i in both]
    for k in range(ranges):
        parts = [sets[i][c[k]:c[k + 1]] for i, c in zip(both, cuts, strict=True)]
        rows = np.repeat(np.arange(len(both)), [len(x) for x in parts])
        _, column, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = np.flatnonzero(counts[column] > 1)
        rows, column = rows[shared], (np.cumsum(counts > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        rows, column = rows[order], column[order]
        width = max(1, CELLS // len(both))
        for start in range(0, int((counts > 1).sum()), width):
            a, b = np.searchsorted(column, [start, start + width])
            block = np.zeros((len(both), width), np.float32)
            block[rows[a:b], column[a:b] - start] = 1
            block = block[:, :int(column[b - 1]) + 1 - start]
            out += block[li] @ block[ri].T
    return out


def _compare(bucket: int, sets: list[np.ndarray], weights: np.ndarray, others: list[np.ndarray], ids: np.ndarray,
             left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links counted here per member, smallest member id of the member's connected part)."""
    sizes = np.array([len(s) for s in sets], np.float64)
    common = _matched(sets, left, right)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = (common >= threshold * union - 1e-9) & (left[:, None] != right[None, :])
    earlier = [x[x < bucket] for x in others]
    names, column = np.unique(np.concatenate(earlier), return_inverse=True) if earlier else (np.zeros(0), None)
    counted = linked.copy()
    if len(names):
        member = np.zeros((len(sets), len(names)), np.float32)
        member[np.repeat(np.arange(len(sets)), [len(x) for x in earlier]), column] = 1
        counted &= (member[left] @ member[right].T) == 0
    links = np.zeros(len(sets))
    np.add.at(links, left, counted @ weights[right])
    if left is not right:
        np.add.at(links, right, counted.T @ weights[left])
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    a, b = np.nonzero(linked)
    a, b = left[a], right[b]
    label = rank.copy()
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        if (new == label).all():
            break
        label = new
    by_rank = np.argsort(rank)
    return links, ids[by_rank[label]]


def in_buckets(members: DataFrame, attached: DataFrame, columns: Sequence[str], compare: Callable, schema: str) -> DataFrame:
    """``compare(bucket, column lists, left rows, right rows)`` for every bucket, or pair of blocks of a large one.

    ``attached`` gives ``columns`` per set. Members of a large bucket are dealt into as many ``blocks`` as their
    row says, and each pair of blocks is a unit of work of its own, so any bucket is spread over all tasks.
    """
    mine = F.pmod(F.xxhash64("set", "bucket"), F.col("blocks")).cast("int")
    dealt = members.withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("set", "bucket", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    rows = merged(dealt, attached.select("set", *columns), "set").repartition("bucket", "i", "j").sortWithinPartitions(
        "bucket", "i", "j")

    def done(held: list, at: tuple) -> Iterator[pa.RecordBatch]:
        bucket, i, j = at
        lists = list(zip(*held, strict=True))
        mine = np.array(lists[0])
        left = np.flatnonzero(mine == i)
        right = left if i == j else np.flatnonzero(mine == j)
        if len(left) and len(right):
            yield from compare(bucket, lists[1:], left, right)

    def grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for cut in range(0, batch.num_rows, 256):
                part = batch.slice(cut, 256)
                for row in zip(*[part.column(c).to_pylist() for c in ("bucket", "i", "j", "mine", "set", *columns)], strict=True):
                    if row[:3] != at:
                        if held:
                            yield from done(held, at)
                        held, at = [], row[:3]
                    held.append(row[3:])
        if held:
            yield from done(held, at)

    return rows.mapInArrow(grouped, schema)


def likely_members(members: DataFrame, sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """Members that have a partner in their bucket by size and by their sketches.

    Sketches of sets above the threshold of 0.8 agree in 0.8 of 64 bins with a deviation of 0.05; they are kept
    from 0.5 on, so what is lost is below one in a million. Sets that only share a passage stay behind here.
    """
    def compare(bucket: int, lists: list, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, sizes = np.array(lists[0], np.int64), np.array(lists[1], np.float64)
        marks = np.frombuffer(b"".join(lists[2]), np.uint8).reshape(len(ids), BINS)
        keep = np.zeros(len(ids), bool)
        least = min(LIKELY, threshold - 0.3)
        for at in range(0, len(left), 256):
            a = left[at:at + 256]
            x, y = marks[a][:, None, :], marks[right][None, :, :]
            alike = ((x == y) & (x > 0)).sum(2)
            used = BINS - ((x == 0) & (y == 0)).sum(2)
            small, large = np.minimum.outer(sizes[a], sizes[right]), np.maximum.outer(sizes[a], sizes[right])
            good = (alike >= least * used) & (small >= threshold * large - 1e-9) & (a[:, None] != right[None, :])
            keep[a] |= good.any(1)
            keep[right] |= good.any(0)
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(int(keep.sum()), bucket)), pa.array(ids[keep]), pa.array(sizes[keep].astype(np.int64))],
                ["bucket", "set", "n"])

    members = members.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    kept = in_buckets(members, sets, ["n", "sketch"], compare, "bucket long, set long, n long").distinct()
    kept = written(kept, "likely")
    blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = kept.groupBy("bucket").agg(F.count("*").alias("size"), blocks.alias("blocks"))
    return merged(kept.drop("n"), sizes, "bucket")


def verified(members: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Rows ``set, root, links``: per bucket the member's links counted there and its part's first member."""
    lists = members.groupBy("set").agg(F.array_sort(F.collect_set("bucket")).alias("buckets"))

    def compare(bucket: int, lists: list, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = np.array(lists[0], np.int64)
        links, root = _compare(bucket, [np.frombuffer(x, np.uint64) for x in lists[3]], np.array(lists[1], np.float64),
                               [np.array(x, np.int64) for x in lists[2]], ids, left, right, threshold)
        take = np.flatnonzero((links > 0) | (root != ids))
        if len(take):
            yield pa.RecordBatch.from_arrays([pa.array(ids[take]), pa.array(root[take]),
                                              pa.array(links[take].astype(np.int64))], ["set", "root", "links"])

    return in_buckets(members, merged(shingles, lists, "set"), ["copies", "buckets", "tokens"], compare,
                      "set long, root long, links long")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for all nodes of the undirected edges ``a, b``: the smallest node of the component.

    Labels spread along edges and then jump to their label's label, so long chains shorten quickly.
    """
    both = written(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(seen, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        spread = written(spread, "labels")
        far = spread.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = written(spread.join(far, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
                    depth: int = DEPTH, small: int = SMALL, block: int = BLOCK, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: ``key, class_id, n_links``.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word shingles is at least
    ``threshold``; ``class_id`` is the smallest key of the connected documents, ``n_links`` the number of other
    documents linked to this one, copies included. A text of fewer words has one shingle, all its words. A
    null text or one without words is alone, with its own key as class. Repeated rows and keys are documents of
    their own; a null key does not name a class unless all keys of it are null. Other columns are ignored; an
    empty table gives no rows.
    """
    runs = runs_needed(threshold, recall, depth)
    table = signed(docs, key, text, threshold, words, runs, depth)
    sets = written(table.filter("set IS NOT NULL").groupBy("set").agg(
        F.min("k").alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch")), "sets")
    found = written(buckets(table.filter("set IS NOT NULL"), small, depth), "members")
    members = without_twins(likely_members(found, sets, threshold, block))
    wanted = merged(sets.select("set", "first", "copies"), members.select("set").distinct(), "set")
    wanted = written(wanted, "wanted")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in T.pieces(whole.column("t")):
                part = whole.slice(a, b - a)
                ids, blobs = [], []
                for tokens in shingle_sets(part.column("t"), words):
                    with np.errstate(over="ignore"):
                        name = T.mixed(np.array([T.mixed(tokens).sum() + T.U64(len(tokens))]))
                    ids.append(int(name.view(np.int64)[0]))
                    blobs.append(tokens.tobytes())
                same = pa.array(np.array(ids, np.int64) == np.array(part.column("set")))
                out = pa.RecordBatch.from_arrays(
                    [part.column("set"), part.column("copies"), pa.array(blobs, pa.binary())], ["set", "copies", "tokens"])
                yield out.filter(same)

    texts = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    shingles = texts.join(wanted.hint("merge"), F.col("k").eqNullSafe(F.col("first"))).select("t", "set", "copies")
    shingles = shingles.mapInArrow(cut, "set long, copies long, tokens binary").dropDuplicates(["set"])
    found = written(verified(members, written(shingles, "shingles"), threshold), "found")
    links = found.groupBy("set").agg(F.sum("links").alias("links"))
    parts = components(found.filter("set <> root").select(F.col("set").alias("a"), F.col("root").alias("b")))
    named = merged(sets.select("set", "first", "copies"), parts.withColumnRenamed("node", "set"), "set", "left")
    named = merged(named, links, "set", "left").withColumn("label", F.coalesce("label", "set"))
    class_ids = named.groupBy("label").agg(F.min("first").alias("class_id"))
    named = merged(named, class_ids, "label").select(
        "set", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = merged(table.select("k", "set"), written(named, "named"), "set", "left")
    alone = F.col("set").isNull()
    return out.select(F.col("k").alias(key), F.when(alone, F.col("k")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"))
