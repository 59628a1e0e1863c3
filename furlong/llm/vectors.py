"""What the vector searches share: classes of equal vectors, blocks of queries against blocks of candidates.

Rows with the same vector form a class, so a vector that a third of all rows repeat is searched for once and
compared once. A class keeps its ``k + 1`` smallest ids: no row beyond them can be among the k best of any query,
also after the query's own row is left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.blocks import written

#: Vectors in a block of queries or of candidates, about.
BLOCK_ROWS = 8192
FOUND = "query long, class long, least long, score {kind}"


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """``class, vector, ids, least``: distinct vectors with their ``keep`` smallest ids, written once.

    The rank is limited before the shuffle, so a hot vector sends ``keep`` rows a task.
    """
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("__no", first).filter(F.col("__no") <= keep).groupBy("vector").agg(
        F.array_sort(F.collect_list("id")).alias("ids"))
    return written(few.select(F.monotonically_increasing_id().alias("class"), "vector", "ids",
                              F.col("ids")[0].alias("least")), "classes")


def asked(queries: DataFrame, known: DataFrame) -> DataFrame:
    """``class, vector`` of all distinct query vectors, each with its candidates' class or one of its own below 0."""
    own = queries.select("vector").distinct().join(known.select("vector", "class"), "vector", "left")
    fresh = -1 - F.monotonically_increasing_id()
    return written(own.select(F.coalesce("class", fresh).alias("class"), "vector"), "asked")


def blocks_of(rows: int, size: int = BLOCK_ROWS) -> int:
    return max(1, -(-rows // size))


def met(queries: DataFrame, candidates: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table],
        schema: str, groups: int, pieces: int) -> DataFrame:
    """``search(queries, candidates)`` for every block of queries beside every block of candidates.

    Blocks are dealt as rows: each unit of work is a group of bounded size in one task. Not written yet.
    """
    q = queries.withColumn("__group", F.pmod(F.xxhash64("class"), F.lit(groups)).cast("int")).withColumn(
        "__piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    c = candidates.withColumn("__piece", F.pmod(F.xxhash64("class"), F.lit(pieces)).cast("int")).withColumn(
        "__group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return q.groupBy("__group", "__piece").cogroup(c.groupBy("__group", "__piece")).applyInArrow(search, schema)


def matrix(table: pa.Table, column: str = "vector") -> np.ndarray:
    """A list column of equal lengths as the rows of a matrix of doubles."""
    if not table.num_rows:
        return np.zeros((0, 0))
    values = pa.concat_arrays([c.flatten() for c in table.column(column).chunks])
    values = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(table.num_rows, len(values) // table.num_rows)


def longs(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64, copy=False)


def first_of(groups: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """The first k positions of every group, in the given order, which sorts by group."""
    ranked = groups[order]
    start = np.searchsorted(ranked, ranked, side="left")
    return order[np.arange(len(order)) - start < k]


def answered(queries: DataFrame, asked_for: DataFrame, found: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of every query row without the row itself.

    ``found`` holds (at least) the ``k + 1`` best classes of every asked vector.
    """
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "least"))
    top = found.withColumn("__no", best).filter(F.col("__no") <= k + 1).drop("__no")
    rows = top.join(known.select("class", "ids"), "class").select(
        "query", "score", F.explode("ids").alias("vec_id"), (F.col("class") == F.col("query")).alias("same"))
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = rows.withColumn("__no", order).filter(F.col("__no") <= k + 1).groupBy("query").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__no", "vec_id", "score", "same"))),
                    lambda m: F.struct(m["vec_id"], m["score"], m["same"])).alias("__best"))
    of = queries.join(asked_for, "vector").select("id", F.col("class").alias("query")).join(lists, "query")
    own = F.array_position(F.transform("__best", lambda m: m["same"] & (m["vec_id"] == F.col("id"))), F.lit(True))
    # The function sees its index as a column, the rows' own values through the array beside it.
    others = F.slice(F.filter("__best", lambda m, i: i + 1 != own), 1, k)
    out = of.select(F.col("id").alias("query_id"), F.posexplode(others).alias("__at", "m"))
    return out.select("query_id", (F.col("__at") + 1).cast("int").alias("rank"), F.col("m.vec_id").alias("vec_id"),
                      F.col("m.score").alias("score"))
