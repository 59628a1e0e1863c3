"""Nearest rows in many columns by refining a neighbour graph; work and traffic grow in proportion to the rows.

Several trees of random directions cut all rows into cells of bounded size, and inside a cell every row is compared
with every other. The best of all trees start the lists. In each round the cells of another tree fetch the points that
the lists of their rows name, once per cell, and compare all rows of the cell with all of them, so a row meets the
neighbours of its neighbours. Rounds end when few lists change. Distances are worked out in blocks inside tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.operators.ordering import number_rows
from furlong.session import kept, materialize

TREES = 8
CELL_ROWS = 1024
FAN = 8
ROUNDS = 6
#: Share of lists that change in the last round, at most.
SETTLED = 0.01
LISTS = "spot long, near array<struct<d:double,other:long>>"


def _standard(df: DataFrame, columns: Sequence[str]) -> list:
    stats = df.agg(*[F.stddev_pop(F.col(c).cast("double")) for c in columns]).first()
    scale = [1.0 / round(s, 6) if s and round(s, 6) > 0 else 0.0 for s in stats]
    return [F.col(c).cast("double") * F.lit(k) for c, k in zip(columns, scale, strict=True)]


def _comparer(width: int):
    """``(own, points, ids, others' points, others' ids) -> lists``, in blocks; needs nothing of this package."""
    def lists(ids: np.ndarray, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> pa.Table:
        keep = min(width, len(there) - 1)
        if keep < 1:
            return pa.table({"spot": pa.array(ids, pa.int64()), "near": pa.array([[]] * len(ids), pa.list_(pa.struct(
                [("d", pa.float64()), ("other", pa.int64())])))})
        found, dist, lengths = [], [], (y * y).sum(1)
        for at in range(0, len(ids), 256):
            mine, own = x[at:at + 256], ids[at:at + 256]
            rough = lengths[None, :] - 2.0 * (mine @ y.T)
            rough[own[:, None] == there[None, :]] = np.inf
            best = np.argpartition(rough, keep - 1, axis=1)[:, :keep]
            exact = np.rint(((mine[:, None, :] - y[best]) ** 2).sum(2) * 1e9)
            exact[own[:, None] == there[best]] = np.inf
            order = np.lexsort((there[best], exact), axis=1)
            found.append(np.take_along_axis(there[best], order, 1))
            dist.append(np.take_along_axis(exact, order, 1))
        found, dist = np.concatenate(found), np.concatenate(dist)
        near = pa.StructArray.from_arrays([pa.array(dist.ravel()), pa.array(found.ravel(), pa.int64())], ["d", "other"])
        offsets = pa.array(np.arange(len(ids) + 1) * keep, pa.int32())
        return pa.table({"spot": pa.array(ids, pa.int64()), "near": pa.ListArray.from_arrays(offsets, near)})

    def points(table: pa.Table, name: str = "point") -> np.ndarray:
        values = [c.flatten() for c in table.column(name).chunks]
        flat = pa.concat_arrays(values).to_numpy() if values else np.zeros(0)
        return flat.reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 0))

    def inside(table: pa.Table) -> pa.Table:
        ids, x = table.column("spot").to_numpy(), points(table)
        return lists(ids, x, ids, x)

    def beside(table: pa.Table, fetched: pa.Table) -> pa.Table:
        ids, x = table.column("spot").to_numpy(), points(table)
        if not fetched.num_rows:
            return lists(ids, x, ids, x)
        return lists(ids, x, fetched.column("spot_named").to_numpy(), points(fetched, "point_named"))
    return inside, beside


def _cells(spots: DataFrame, n: int, width: int, trees: int, cell_rows: int, seed: int) -> DataFrame:
    """``spot, tree, cell``: every tree cuts all rows, level by level, into equal parts along random directions."""
    levels = 0
    while n > cell_rows * FAN ** levels:
        levels += 1
    turns = np.random.default_rng(seed).normal(size=(width, trees * max(levels, 1)))

    def project(batches):
        for batch in batches:
            values = batch.column("point").flatten().to_numpy().reshape(batch.num_rows, -1)
            along = pa.array((values @ turns).round(6).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1) * turns.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("spot"), pa.ListArray.from_arrays(offsets, along)], ["spot", "along"])

    if not levels:
        return spots.select("spot", F.lit(0).alias("tree"), F.lit(0).cast("long").alias("cell"))
    along = spots.select("spot", "point").mapInArrow(project, "spot long, along array<double>")
    at = along.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).select(
        "spot", "tree", F.lit(0).cast("long").alias("cell"), F.slice("along", F.col("tree") * levels + 1, levels).alias("along"))
    for level in range(levels):
        row = at.withColumn("value", F.col("along")[level])
        row = number_rows(row, ["tree", "cell", "value", "spot"], "rn")
        # Cells of a level differ by one row at most, so they are as many as the sizes say.
        sizes = materialize(row.groupBy("tree", "cell").agg(F.min("rn").alias("first"), F.count("*").alias("size")), "sizes")
        part = F.floor((F.col("rn") - F.col("first")) * FAN / F.col("size"))
        at = materialize(row.join(sizes, ["tree", "cell"]).select(
            "spot", "tree", (F.col("cell") * FAN + part).alias("cell"), "along"), "cells")
    return at.drop("along")


def _merged(lists: DataFrame, width: int) -> DataFrame:
    """The ``width`` best of all lists of a row."""
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))
    return lists.groupBy("spot").agg(F.slice(every, 1, width).alias("near"))


def near_rows(df: DataFrame, key: str, columns: Sequence[str], neighbours: int = 5, trees: int = TREES,
              cell_rows: int = CELL_ROWS, rounds: int = ROUNDS, settled: float = SETTLED, seed: int = 0) -> DataFrame:
    """``key, near``: keys of each row's nearest other rows in standardised columns, nearest first.

    Columns must be finite, keys unique. Ties are broken by key. Up to ``cell_rows`` distinct rows the result is
    exact. Beyond, most neighbours are found (0.95 and more in the tests), with work in proportion to the rows. Equal
    rows are one spot with its first keys, so a point that many rows share is compared once. The result does not
    depend on how the rows are partitioned.
    """
    spark = df.sparkSession
    rows = materialize(df.select(F.col(key).alias("k"), F.array(*_standard(df, columns)).alias("point")), "points")
    first = F.row_number().over(Window.partitionBy("point").orderBy("k"))
    spots = rows.withColumn("no", first).filter(F.col("no") <= neighbours + 1).groupBy("point").agg(
        F.array_sort(F.collect_list("k")).alias("keys"))
    # Numbers follow the first keys, so ties and draws are the same in every run.
    spots = number_rows(spots.withColumn("lead", F.col("keys")[0]), ["lead"], "spot").select("spot", "point", "keys")
    spots = materialize(spots, "spots")

    def refined() -> DataFrame:
        n, width = spots.count(), max(2 * neighbours, 10)
        inside, beside = _comparer(width)
        slim = spots.select("spot", "point")
        cells = materialize(_cells(slim, n, len(columns), trees, cell_rows, seed), "cells")
        start = cells.join(slim, "spot").groupBy("tree", "cell").applyInArrow(inside, LISTS)
        lists = materialize(_merged(start, width), "lists")
        for number in range(rounds if n > cell_rows else 0):
            home = cells.filter(F.col("tree") == number % trees).select("spot", "cell")
            # A row's list and the rows in whose lists it is, the nearest of them if there are many.
            links = lists.select("spot", F.explode("near").alias("m")).select("spot", "m.other", "m.d")
            back = F.row_number().over(Window.partitionBy("other").orderBy("d", "spot"))
            back = links.withColumn("no", back).filter(F.col("no") <= width).select(
                F.col("other").alias("spot"), F.col("spot").alias("other"))
            named = links.select("spot", "other").unionByName(back).join(home, "spot").select(
                "cell", F.col("other").alias("spot")).distinct()
            fetched = named.join(slim, "spot").select(*[F.col(c).alias(f"{c}_named") for c in ("cell", "spot", "point")])
            found = home.join(slim, "spot").groupBy("cell").cogroup(fetched.groupBy("cell_named")).applyInArrow(beside, LISTS)
            better = materialize(_merged(lists.unionByName(found), width), "lists")
            few = [F.slice(F.transform("near", lambda m: m["other"]), 1, neighbours).alias(c) for c in ("a", "b")]
            moved = lists.select("spot", few[0]).join(better.select("spot", few[1]), "spot").filter("a <> b").count()
            lists = better
            if moved <= settled * n:
                break
        return lists

    lists = kept(spark, refined, "nearest")
    # Lists of spots become lists of rows: the own spot's other keys first.
    near = lists.select("spot", F.posexplode("near").alias("at", "m")).select(
        "spot", F.col("m.d").alias("d"), F.col("m.other").alias("other"))
    near = near.join(spots.select(F.col("spot").alias("other"), "keys"), "other").select("spot", "d", F.explode("keys").alias("o"))
    own = spots.select("spot", F.lit(-1.0).alias("d"), F.explode("keys").alias("o"))
    order = F.row_number().over(Window.partitionBy("spot").orderBy("d", "o"))
    best = near.unionByName(own).withColumn("no", order).filter(F.col("no") <= neighbours + 1).groupBy("spot").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("no", "o"))), lambda m: m["o"]).alias("best"))
    found = materialize(best.join(spots.select("spot", "point"), "spot").select("point", "best"), "best")
    others = F.filter("best", lambda o: o != F.col("k"))
    return rows.join(found, "point").select(F.col("k").alias(key), F.slice(others, 1, neighbours).alias("near"))
