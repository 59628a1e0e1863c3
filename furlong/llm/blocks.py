"""Exchange between blocks of documents and shards of a key space, in packed messages.

Documents are dealt by a hash into blocks of bounded size, once, and written as a bucketed table: later steps
read a block beside the messages for it without moving a text again. Inside a task a block is worked on as
arrays; what blocks ask or tell about a key (a hash) goes to the key's shard in one row per block and shard
that holds binary arrays. A block adds up equal keys first, so a key that a third of all rows have costs a
shard no more than one entry per block.

Every step is written to the shared folder. Lost executors read it again, and the shuffle files of a step are
released when its table is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.session import own_table, scratch_path

BLOCK_BYTES = 3 << 20
#: Bytes of texts that one task reads, about.
BUCKET_BYTES = 64 << 20
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession):
    """Shuffle files go at the end of each execution inside."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before) if before is not None else spark.conf.unset(RELEASE)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Blocks:
    """Documents in blocks of about ``block_bytes``; ``columns`` are kept beside ``rid`` and ``t`` (the text)."""

    def __init__(self, docs: DataFrame, text: str, columns: Sequence[str] = (), block_bytes: int = BLOCK_BYTES):
        spark = docs.sparkSession
        rows = docs.select(*[F.col(c) for c in columns], F.col(text).cast("string").alias("t"))
        size = rows.agg(F.sum(F.octet_length("t") + 64), F.count("*")).first()
        self.spark = spark
        self.count = max(1, -(-max(size[0] or 0, (size[1] or 0) * 64) // block_bytes))
        few, many = int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size[0] or 0) // BUCKET_BYTES)
        buckets = min(max(few, many), 100_000)
        rows = rows.withColumn("rid", F.monotonically_increasing_id())
        rows = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(self.count)).cast("int"))
        name = f"blocks_{uuid.uuid4().hex}"
        with released(spark):
            rows.repartition(buckets, "block").write.bucketBy(buckets, "block").option(
                "path", scratch_path(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
        own_table(spark, name)
        self.table = spark.table(name)

    def each(self, make: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``make(block, rows)`` for every block; rows come in the same order each time. Not written yet."""
        def run(table: pa.Table) -> pa.Table:
            return make(*_ordered(table))
        return self.table.groupBy("block").applyInArrow(run, schema)

    def each_with(self, mail: DataFrame, make: Callable[[int, pa.Table, pa.Table], pa.Table],
                  schema: str) -> DataFrame:
        """``make(block, rows, messages)`` for every block; ``mail`` has a column ``block``. Not written yet."""
        def run(table: pa.Table, messages: pa.Table) -> pa.Table:
            return make(*_ordered(table), messages)
        return self.table.groupBy("block").cogroup(mail.groupBy("block")).applyInArrow(run, schema)


def _ordered(table: pa.Table) -> tuple[int, pa.Table]:
    table = table.combine_chunks()
    order = np.argsort(table.column("rid").to_numpy(), kind="stable")
    if (np.diff(order) != 1).any():
        table = table.take(pa.array(order))
    return int(table.column("block")[0].as_py()), table


def texts_of(table: pa.Table) -> pa.Array:
    """The text column as one large-string array."""
    return pa.concat_arrays([c.cast(pa.large_string()) for c in table.column("t").chunks] or [
        pa.array([], pa.large_string())])


def shards(mail: DataFrame, make: Callable[[int, pa.Table], pa.Table], schema: str, tag: str) -> DataFrame:
    """``make(shard, messages)`` for every shard that got messages."""
    def run(table: pa.Table) -> pa.Table:
        return make(int(table.column("shard")[0].as_py()), table)
    return written(mail.groupBy("shard").applyInArrow(run, schema), tag)


def split_by(shard: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """(order that sorts by shard, slices of it per shard)."""
    if not len(shard):
        return np.zeros(0, np.int64), []
    # Numbers of 16 bits are sorted by their digits.
    small = shard.min() >= 0 and shard.max() < 1 << 16
    order = np.argsort(shard.astype(np.uint16) if small else shard, kind="stable")
    sorted_ = shard[order]
    starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    ends = np.append(starts[1:], len(shard))
    return order, [(int(s), slice(int(a), int(b))) for s, a, b in zip(sorted_[starts], starts, ends, strict=True)]


def named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, position of each one's first occurrence, place of every key among them)."""
    names, place = np.unique(keys, return_inverse=True)
    first = np.empty(len(names), np.int64)
    first[place[::-1]] = np.arange(len(keys))[::-1]
    return names, first, place


def unpacked(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(b, kind) if b else np.zeros(0, kind) for b in column.to_pylist()]


def joined(parts: Sequence[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if len(parts) else np.zeros(0, kind)


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + length - 1`` of every range, one after another."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
