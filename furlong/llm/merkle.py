"""Merkle manifest of a table: one tree per group, one tree over the groups' roots, proofs for every row.

Rows are numbered once in the order of group and key. Nodes have coordinates (tree, level, index); a run of ``ARITY``
consecutive nodes has one parent, and every level above the leaves is worked out in chunks of ``ARITY ** DEPTH``
consecutive nodes, so a group that holds most rows is many chunks.

Proofs are octopus multiproofs: a partition of leaves, which is a few thousand consecutive rows, works out the
smallest set of coordinates it can't derive from its own leaves, for all of its proofs together. The set is looked
up once; then the partition derives the shared interior nodes by itself and expands a proof for each row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.llm.blocks import released, written
from furlong.operators.ordering import number_rows

ARITY = 3
#: Levels a chunk spans; its ``ARITY ** DEPTH`` nodes are about what a task holds at once.
DEPTH = 7
#: The tree over the roots of all groups.
TOP = -1
NODES = "tree long, level int, idx long, digest string"


def field(column: Column | str) -> Column:
    """The bytes a value gives: ``-`` if null, else its number of UTF-8 bytes, a colon, the value as text."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*columns: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of texts put together."""
    return F.sha2(F.concat(*columns).cast("binary"), 256)


def hashed(texts: Sequence[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def missing(positions: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, indexes) of the nodes that the proofs of these leaves need and these leaves can't derive."""
    own, level = np.unique(positions), 0
    while size > 1:
        parents = np.unique(own // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        needed = np.setdiff1d(children[children < size], own, assume_unique=True)
        if len(needed):
            yield level, needed
        own, size, level = parents, -(-size // ARITY), level + 1


def derived(own: dict[int, str], fetched: dict[tuple[int, int], str], size: int) -> tuple[list[dict], str]:
    """(per level: own nodes' siblings before and after as two texts, the root).

    ``own`` are leaves by position; nodes that can't be derived are taken from ``fetched`` by (level, index).
    """
    levels, level = [], 0
    while size > 1:
        siblings, above = {}, {}
        for parent in dict.fromkeys(i // ARITY for i in own):
            run = range(parent * ARITY, min((parent + 1) * ARITY, size))
            texts = [own[i] if i in own else fetched[level, i] for i in run]
            for at, i in enumerate(run):
                if i in own:
                    siblings[i] = ("".join(texts[:at]), "".join(texts[at + 1:]))
            above[parent] = hashed(texts)
        levels.append(siblings)
        own, size, level = above, -(-size // ARITY), level + 1
    return levels, next(iter(own.values()))


def _bounds(*keys: np.ndarray) -> list[slice]:
    """Slices of equal keys in sorted columns."""
    if not len(keys[0]):
        return []
    change = np.zeros(len(keys[0]), bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    cuts = [0, *np.flatnonzero(change).tolist(), len(change)]
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _climbed(base: int, inner: bool):
    """Parents of chunks of nodes at level ``base``: all of them, or the highest of each chunk alone."""
    def climb(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tree", "ascending"), ("idx", "ascending")])
        tree, idx, size = (table.column(c).to_numpy() for c in ("tree", "idx", "size"))
        digests, out = table.column("digest").to_pylist(), []
        for part in _bounds(tree, idx // ARITY ** DEPTH):
            nodes, first, left = digests[part], int(idx[part][0]), int(size[part][0])
            for level in range(base + 1, base + DEPTH + 1):
                if left == 1:
                    break
                nodes = [hashed(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
                first, left = first // ARITY, -(-left // ARITY)
                if inner or left == 1 or level == base + DEPTH:
                    out += [(int(tree[part][0]), level, first + i, d) for i, d in enumerate(nodes)]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.table({"tree": pa.array(columns[0], pa.int64()), "level": pa.array(columns[1], pa.int32()),
                         "idx": pa.array(columns[2], pa.int64()), "digest": pa.array(columns[3], pa.string())})
    return climb


def _tree_nodes(leaves: DataFrame, largest: int) -> DataFrame:
    """``NODES`` above the leaves ``tree, size, idx, digest, part``, and the leaves of trees of one node.

    Of the lowest chunks only the highest nodes are kept: partitions of leaves hold whole chunks and derive the
    others. ``part`` deals the lowest chunks; later ones are dealt by hash.
    """
    nodes = written(leaves.groupBy("part").applyInArrow(_climbed(0, False), NODES), "nodes")
    single = leaves.filter("size = 1").select("tree", F.lit(0).alias("level"), "idx", "digest")
    every, base, sizes = nodes.unionByName(single), DEPTH, leaves.filter("idx = 0").select("tree", "size")
    while base < height(largest):
        size = F.col("size")
        for _ in range(base):
            size = F.ceil(size / ARITY)
        open_ = nodes.filter(F.col("level") == base).join(sizes, "tree").withColumn("size", size).filter("size > 1")
        chunks = max(1, -(-largest // ARITY ** base) // ARITY ** DEPTH)
        part = F.pmod(F.xxhash64("tree", F.floor(F.col("idx") / ARITY ** DEPTH)), F.lit(chunks * 4))
        nodes = written(open_.withColumn("part", part).groupBy("part").applyInArrow(_climbed(base, True), NODES), "nodes")
        every, base = every.unionByName(nodes), base + DEPTH
    return every


def _placed(rows: DataFrame, order: Sequence[str], group: str) -> DataFrame:
    """Rows numbered in order, with the first number and the size of their group."""
    numbered = number_rows(rows, order, "__rn")
    sizes = numbered.groupBy(F.col(group).alias("__group")).agg(F.min("__rn").alias("__first"), F.count("*").alias("size"))
    sizes = written(sizes, "sizes")
    return numbered.join(sizes, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def _partitioned(rows: DataFrame) -> DataFrame:
    """Add ``part``: consecutive whole chunks, so at most twice a chunk's rows."""
    start = F.col("__first") + F.floor(F.col("idx") / ARITY ** DEPTH) * ARITY ** DEPTH
    return rows.withColumn("part", F.floor(start / ARITY ** DEPTH))


def _asked(groups: int):
    """What a partition of leaves has to look up."""
    def ask(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tree", "ascending"), ("idx", "ascending")])
        tree, idx, size = (table.column(c).to_numpy() for c in ("tree", "idx", "size"))
        out = [(TOP, level, i) for level, at in missing(tree, groups) for i in at.tolist()]
        for part in _bounds(tree):
            out += [(int(tree[part][0]), level, i) for level, at in missing(idx[part], int(size[part][0]))
                    for i in at.tolist()]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({"part": pa.array([table.column("part")[0].as_py()] * len(out), pa.int64()),
                         "tree": pa.array(columns[0], pa.int64()), "level": pa.array(columns[1], pa.int32()),
                         "idx": pa.array(columns[2], pa.int64())})
    return ask


def _expanded(groups: int, root: str):
    """Proofs of a partition's leaves from the nodes it looked up."""
    def expand(table: pa.Table, looked_up: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("tree", "ascending"), ("idx", "ascending")])
        tree, idx, size = (table.column(c).to_numpy() for c in ("tree", "idx", "size"))
        fetched: dict[int, dict] = {}
        for t, level, i, d in zip(*(looked_up.column(c).to_pylist() for c in ("tree", "level", "idx", "digest")),
                                  strict=True):
            fetched.setdefault(t, {})[level, i] = d
        digests, before, after = table.column("digest").to_pylist(), [], []
        parts, roots, places = _bounds(tree), {}, []

        def place(levels: list[dict], positions: np.ndarray) -> np.ndarray:
            """Where the texts of these nodes' paths stand: a row per position, a column per level."""
            columns = []
            for siblings in levels:
                own = np.fromiter(siblings, np.int64, len(siblings))
                columns.append(np.searchsorted(own, positions) + len(before))
                before.extend(s[0] for s in siblings.values())
                after.extend(s[1] for s in siblings.values())
                positions = positions // ARITY
            return np.stack(columns, 1) if columns else np.zeros((len(positions), 0), np.int64)

        for part in parts:
            own = dict(zip(idx[part].tolist(), digests[part], strict=True))
            levels, roots[int(tree[part][0])] = derived(own, fetched.get(int(tree[part][0]), {}), int(size[part][0]))
            places.append(place(levels, idx[part]))
        levels, found = derived(dict(roots), fetched.get(TOP, {}), groups)
        if found != root:
            raise ValueError("the nodes looked up do not lead to the root")
        upper = place(levels, np.array(list(roots), np.int64))
        flat, counts = [], []
        for at, inner in enumerate(places):
            rows = np.concatenate([inner, np.broadcast_to(upper[at], (len(inner), upper.shape[1]))], 1)
            flat.append(rows.ravel())
            counts += [rows.shape[1]] * len(rows)
        take = pa.array(np.concatenate(flat), pa.int64())
        steps = pa.StructArray.from_arrays([pa.array(x, pa.string()).take(take) for x in (before, after)], ["before", "after"])
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        subroots = [roots[int(tree[p][0])] for p in parts for _ in range(p.stop - p.start)]
        return pa.table({"row": table.column("row"), "subroot": pa.array(subroots, pa.string()),
                         "root": pa.array([root] * table.num_rows, pa.string()),
                         "proof": pa.ListArray.from_arrays(offsets, steps)})
    return expand


def manifest(rows: DataFrame, leaf: str = "leaf", key: str = "doc_id", group: str = "source",
             carry: Sequence[str] = ()) -> DataFrame:
    """Every row with its group's root, the root of all and its proof: ``key, group, leaf, subroot, root, proof, carried``.

    ``leaf`` is a row's digest. Inside a group leaves ascend by key, null keys first, equal keys by digest; groups
    ascend by their UTF-8 bytes, null first. ``proof`` has one struct per level, from the leaf to the root, with the
    digests ``before`` and ``after`` the own node in its run put together as texts; a tree of one leaf has no
    levels. Repeated rows are leaves each. ``carry`` columns come back in the struct ``carried``; other columns are
    ignored, whatever their names. An empty table gives no rows and has no root.
    """
    spark = rows.sparkSession
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("string")
    named = rows.select(F.col(key).alias("k"), F.col(group).alias("g"), F.col(leaf).alias("digest"), carried.alias("c"))
    with released(spark):
        # The sort reads its input twice; digests are taken once.
        named = written(named, "digests")
        placed = _placed(named, ["g", "k", "digest"], "g")
        trees = placed.filter(F.col("__rn") == F.col("__first")).select("g", "size")
        trees = written(number_rows(trees, ["g"], "tree").select(
            F.col("g").alias("__g"), (F.col("tree") - 1).alias("tree")), "trees")
        located = placed.join(trees, F.col("g").eqNullSafe(F.col("__g"))).withColumn("idx", F.col("__rn") - F.col("__first"))
        leaves = written(_partitioned(located).select(
            "part", "tree", "size", "idx", "digest", F.struct("k", "g", "digest", "c").alias("row")), "leaves")
        out = T.StructType([leaves.schema["row"], *(T.StructField(c, T.StringType()) for c in ("subroot", "root")),
                            T.StructField("proof", T.ArrayType(T.StructType([
                                T.StructField(c, T.StringType()) for c in ("before", "after")])))])
        groups, largest = trees.count(), leaves.agg(F.max("size")).first()[0]
        if not groups:
            found = spark.createDataFrame([], out)
        else:
            slim = leaves.select("part", "tree", "size", "idx", "digest")
            nodes = _tree_nodes(slim, largest)
            roots = written(_roots(nodes, slim), "roots").withColumns({
                "size": F.lit(groups).cast("long"), "__first": F.lit(0).cast("long")})
            tops = _tree_nodes(_partitioned(roots), groups)
            # Leaves of the upper tree may be asked for as well as its inner nodes.
            store = nodes.unionByName(tops).unionByName(roots.filter(F.lit(groups > 1)).select(
                "tree", F.lit(0).alias("level"), "idx", "digest"))
            store = store.unionByName(_low_nodes(roots, groups))
            root = tops.filter(F.col("level") == height(groups)).first()["digest"]
            asked = slim.groupBy("part").applyInArrow(_asked(groups), "part long, tree long, level int, idx long")
            looked_up = written(asked.join(store, ["tree", "level", "idx"]).select(
                "part", "tree", "level", "idx", "digest"), "looked-up")
            found = leaves.groupBy("part").cogroup(looked_up.groupBy("part")).applyInArrow(_expanded(groups, root), out)
    return found.select(F.col("row.k").alias(key), F.col("row.g").alias(group), F.col("row.digest").alias(leaf),
                        "subroot", "root", "proof", F.col("row.c").alias("carried"))


def _roots(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """``tree, idx, digest``: the roots of all trees as leaves of the upper tree, whose order is that of the trees."""
    top = F.max_by("digest", "level")
    return nodes.groupBy(F.col("tree").alias("idx")).agg(top.alias("digest")).select(
        F.lit(TOP).cast("long").alias("tree"), "idx", "digest")


def _low_nodes(roots: DataFrame, groups: int) -> DataFrame:
    """Nodes of the upper tree between its leaves and the tops of its lowest chunks.

    A partition may start or end inside a chunk of groups, and then needs some of them.
    """
    def climb(table: pa.Table) -> pa.Table:
        every = _climbed(0, True)(table)
        return every.filter(pc.less(every.column("level"), DEPTH))
    return _partitioned(roots).groupBy("part").applyInArrow(climb, NODES).filter(F.col("level") < height(groups))


def proof_digest(proof: Column | str) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root."""
    proof = F.col(proof) if isinstance(proof, str) else proof
    return digest(F.concat_ws("", F.transform(proof, lambda s: F.concat(s["before"], s["after"]))))


def folded(leaf: Column | str, proof: Column | str) -> Column:
    """The root that a leaf and a proof lead to."""
    leaf, proof = (F.col(c) if isinstance(c, str) else c for c in (leaf, proof))
    return F.aggregate(proof, leaf, lambda node, s: digest(s["before"], node, s["after"]))
