"""Row numbers, history windows and running sums that stay balanced when one key holds most rows.

Spark's window operator puts all rows of a partition key into one task. The functions here first count
rows per key. Keys below the limit take the ordinary window; the few above it are range-sorted over all
tasks and their windows run on pieces of a fixed number of rows. Both ways give the same result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from furlong.functions.numeric import keyed_hash, rnd
from furlong.session import materialize

HOT_ROWS = 1_000_000
BUCKET_ROWS = 100_000
GRID = 500
KEY_BUCKETS = 1 << 16
LISTED_BUCKETS = 1000
TASK_ROWS = 500_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """A written table of all keys with more than ``hot_rows`` rows, or None if there are none.

    Rows are counted in 65,536 hash buckets first, whose counts combine before the shuffle. Keys are counted only in
    buckets with more than ``hot_rows`` rows, so the many small keys are never shuffled. Pass a table that is cheap to read.
    """
    buckets = df.select(F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int").alias("__bucket"))
    full = [r["__bucket"] for r in buckets.groupBy("__bucket").agg(F.count("*").alias("__n")).filter(
        F.col("__n") > hot_rows).select("__bucket").collect()]
    if not full:
        return None
    if len(full) <= LISTED_BUCKETS:
        df = df.filter(F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).isin(full))
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_rows)
    found = materialize(counts.select(*keys), "hot")
    return None if found.isEmpty() else found


def dealt(df: DataFrame, keys: Sequence[str], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows shuffled by their keys into tasks of about ``task_rows`` if there are more than that for every core.

    AQE merges shuffle partitions up to a size in compressed bytes, which are some millions of rows, and the session's
    number of partitions is fixed, so without this tasks grow with the table. Joins, aggregates and windows on these keys
    need no shuffle afterwards. Keys must not be hot.
    """
    tasks, spark = -(-rows // task_rows), df.sparkSession
    left = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys) if tasks > left else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null; the left keys are kept. A written right side is broadcast if it is small."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    out = left.join(renamed, condition, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    return null_safe_join(df, hot, keys, "left_anti"), null_safe_join(df, hot, keys, "left_semi")


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-sort over all tasks and store each row's task number and place within it.

    The result is written out, because two runs of a sort may cut the ranges differently.
    """
    at = F.monotonically_increasing_id()
    placed = materialize(df.orderBy(*order).withColumn("__at", at), "sorted")
    return placed.withColumns({
        "__part": F.shiftright("__at", 33), "__pos": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__at")


def _starts(placed: DataFrame, total: Column) -> DataFrame:
    """One row per sort task: the total of all earlier tasks. Size: the number of tasks."""
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("__part").agg(total.alias("__total"))
    return sums.select("__part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start"))


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number all rows from 1 in the given total order, without a one-task sort."""
    placed = _placed(df, order)
    starts = _starts(placed, F.count("*"))
    return placed.join(F.broadcast(starts), "__part").withColumn(
        name, F.col("__start") + F.col("__pos") + 1).drop("__part", "__pos", "__start")


def running_sums(df: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add inclusive running sums ``{new name: column}`` over the whole table in a total order."""
    out = _placed(df, order)
    inside = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = out.groupBy("__part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    starts = totals.select("__part", *[
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__start_{n}") for n in sums])
    out = out.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    out = out.join(F.broadcast(starts), "__part")
    out = out.withColumns({n: F.col(n) + F.col(f"__start_{n}") for n in sums})
    return out.drop("__part", "__pos", *[f"__start_{n}" for n in sums])


def grouped_numbers(df: DataFrame, keys: Sequence[str], orders: dict[str, Sequence[Column | str]],
                    count: str | None = None, hot_rows: int = HOT_ROWS,
                    hot: Callable[[], DataFrame | None] | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by …)`` for each named order, and the group size.

    ``hot`` may supply the hot keys when they are already known.
    """
    found = hot() if hot else hot_keys(df, keys, hot_rows)

    def plain(part: DataFrame) -> DataFrame:
        new = {n: F.row_number().over(Window.partitionBy(*keys).orderBy(*o)).cast("long") for n, o in orders.items()}
        if count:
            new[count] = F.count("*").over(Window.partitionBy(*keys))
        return part.withColumns(new)

    if found is None:
        return plain(df)
    cold, warm = split_hot(df, keys, found)
    for name, order in orders.items():
        warm = number_rows(warm, [*keys, *order], name)
        first = warm.groupBy(*keys).agg(F.min(name).alias("__first"))
        warm = null_safe_join(warm, first, keys, "inner").withColumn(name, F.col(name) - F.col("__first") + 1)
        warm = warm.drop("__first")
    if count:
        sizes = warm.groupBy(*keys).agg(F.count("*").alias(count))
        warm = null_safe_join(warm, sizes, keys, "inner")
    return plain(cold).unionByName(warm)


def preceding_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      build: Callable[[WindowSpec], dict[str, Column]], reach: int,
                      hot_rows: int = HOT_ROWS, piece_rows: int = 500_000,
                      keys_from: DataFrame | None = None, ahead: int = 0) -> DataFrame:
    """Add window columns whose frames reach at most ``reach`` rows back and ``ahead`` on, in a total order per key.

    Rows of a hot key are numbered in order and cut into pieces; the last ``reach`` rows of a piece are
    also sent to the next one, and its first ``ahead`` to the one before, where they feed the frames and are then
    removed.
    """
    hot = hot_keys((df if keys_from is None else keys_from).select(*keys), keys, hot_rows)

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))

    if hot is None:
        return plain(df)
    piece_rows = max(piece_rows, reach, ahead)
    cold, warm = split_hot(df, keys, hot)
    home = F.floor((F.col("__rn") - 1) / piece_rows).cast("long")
    numbered = number_rows(warm, [*keys, *order], "__rn").withColumn("__home", home)
    at = (F.col("__rn") - 1) % piece_rows
    near = [F.when(at >= piece_rows - reach, F.col("__home") + 1)] + [F.when(at < ahead, F.col("__home") - 1)] * bool(ahead)
    pieces = numbered.withColumn("__piece", F.explode(F.array_compact(F.array("__home", *near))))
    spec = Window.partitionBy(*keys, "__piece").orderBy("__rn")
    done = pieces.withColumns(build(spec)).filter(F.col("__piece") == F.col("__home"))
    return plain(cold).unionByName(done.drop("__rn", "__home", "__piece"))


def bucket_digits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Hex digits of a hash that cut this many rows into buckets of about ``bucket_rows`` or fewer."""
    digits = 1
    while 16 ** digits * bucket_rows < rows:
        digits += 1
    return digits


def _bucketed(df: DataFrame, stratum: str, key: str, seed: int, hex_digits: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows with hash and bucket, and the number of rows in all earlier buckets of the stratum.

    A bucket holds the hashes with the same first hex digits. The hash of a unique key spreads evenly, so
    buckets are small whatever the strata are; their number follows the number of rows. The second table is
    written, so that it is broadcast only if it is small.
    """
    hex_digits = hex_digits or bucket_digits(df.count())
    hashed = df.filter(F.col(stratum).isNotNull()).withColumn("__hash", keyed_hash(key, seed))
    hashed = hashed.withColumn("__bucket", F.substring("__hash", 1, hex_digits))
    before = Window.partitionBy(stratum).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy(stratum, "__bucket").agg(F.count("*").alias("__n"))
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return hashed, materialize(starts, "buckets")


def hash_ranks(df: DataFrame, stratum: str, key: str, seed: int, name: str,
               hex_digits: int | None = None) -> DataFrame:
    """Number the rows of each stratum from 1 in a seeded random order; rows without stratum are dropped.

    Two levels replace one sort per stratum: rows are numbered inside hash buckets, and each bucket starts
    where the earlier ones end. The input is read twice: pass a written table.
    """
    hashed, starts = _bucketed(df, stratum, key, seed, hex_digits)
    inside = Window.partitionBy(stratum, "__bucket").orderBy("__hash", key)
    ranked = hashed.withColumn("__in", F.row_number().over(inside))
    return ranked.join(starts.drop("__n"), [stratum, "__bucket"]).withColumn(
        name, F.col("__start") + F.col("__in")).drop("__hash", "__bucket", "__in", "__start")


def mark_first_share(df: DataFrame, stratum: str, key: str, share: float, seed: int, name: str,
                     hex_digits: int | None = None) -> DataFrame:
    """Mark the first ``floor(share * n)`` rows of each stratum in the order of :func:`hash_ranks`.

    Rows are only compared with the last hash to be marked, so they are not shuffled. That hash lies in one
    bucket per stratum, and only this bucket is sorted; the hashes found are written, one row per stratum.
    The input is read three times: pass a written table.
    """
    hashed, starts = _bucketed(df, stratum, key, seed, hex_digits)
    sizes = Window.partitionBy(stratum)
    cut = starts.withColumn("__want", F.floor(F.sum("__n").over(sizes) * share) - F.col("__start"))
    cut = cut.filter((F.col("__want") > 0) & (F.col("__want") <= F.col("__n"))).select(stratum, "__bucket", "__want")
    at = hashed.select(stratum, "__bucket", "__hash", key).join(cut, [stratum, "__bucket"])
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("__hash", key))
    last = at.withColumn("__rank", rank).filter(F.col("__rank") == F.col("__want")).select(
        stratum, F.struct(F.col("__hash"), F.col(key)).alias("__last"))
    marked = hashed.join(materialize(last, "cut"), stratum, "left")
    here = F.struct(F.col("__hash"), F.col(key))
    return marked.withColumn(name, F.coalesce(here <= F.col("__last"), F.lit(False))).drop("__hash", "__bucket", "__last")


def values_at_ranks(df: DataFrame, columns: Sequence[str],
                    ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Values of many numeric columns at given ranks: rows ``(feature, rank, value)``.

    Each entry of ``ranks`` maps the column's non-null count to a 1-based rank. NaN is larger than any number.
    Approximate quantiles give two edges around each rank. The rows between and at the edges are counted, which tells
    exactly where each rank lies: at an edge, whose value is the answer, or between two of them, and only
    the values there are sorted. The input is read three times: pass a written table. What reaches the driver
    depends on the number of columns and ranks alone.
    """
    spark = df.sparkSession
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    numbers = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    grid = [i / GRID for i in range(GRID + 1)]
    seen = wide.agg(*[F.struct(F.count(c).alias("size"), F.count(numbers[c]).alias("numbers"), F.percentile_approx(
        numbers[c], grid, 10 * GRID).alias("grid")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    sizes = spark.createDataFrame([(c, seen[i]["size"]) for i, c in enumerate(columns)], "feature string, size long")
    places = [f(F.col("size")).cast("long").alias(f"r{i}") for i, f in enumerate(ranks.values())]
    asked = {r["feature"]: dict(zip(ranks, r[2:])) for r in sizes.select("feature", "size", *places).collect()}
    edges = []
    for i, c in enumerate(columns):
        around: set[float] = set()
        for at in asked[c].values() if seen[i]["numbers"] else ():
            share = GRID * at / seen[i]["numbers"]
            around |= {seen[i]["grid"][min(max(g, 0), GRID)] for g in (math.floor(share) - 1, math.ceil(share) + 1)}
        edges.append((c, sorted(around)))
    # One short array per column.
    table = F.broadcast(spark.createDataFrame(edges, "feature string, edges array<double>"))
    long = wide.unpivot([], list(columns), "feature", "value").filter(F.col("value").isNotNull()).join(table, "feature")
    below = F.size(F.filter("edges", lambda e: e < F.col("value")))
    long = long.select("feature", "value", (2 * below + F.array_contains("edges", F.col("value")).cast("int")).alias("slot"))
    counts: dict[str, list] = {c: [] for c in columns}
    for r in long.groupBy("feature", "slot").agg(F.count("*").alias("n")).orderBy("feature", "slot").collect():
        counts[r["feature"]].append((r["slot"], r["n"]))
    known, open_slots = [], []
    for c, own in edges:
        before = 0
        for slot, n in counts[c]:
            here = [(name, at - before) for name, at in asked[c].items() if before < at <= before + n]
            if here and slot % 2:
                known += [(c, name, own[slot // 2]) for name, _ in here]
            elif here:
                open_slots.append((c, slot, here))
            before += n
    found = spark.createDataFrame(known, "feature string, rank string, value double")
    if not open_slots:
        return found
    wanted = spark.createDataFrame(open_slots, "feature string, slot int, asks array<struct<rank: string, at: long>>")
    inside = long.join(F.broadcast(wanted.select("feature", "slot")), ["feature", "slot"])
    cum = running_sums(inside.groupBy("feature", "slot", "value").agg(F.count("*").alias("__n")),
                       ["feature", "slot", "value"], {"__cum": "__n"})
    totals = cum.groupBy("feature", "slot").agg((F.max("__cum") - F.sum("__n")).alias("__before"))
    placed = cum.join(F.broadcast(totals.join(F.broadcast(wanted), ["feature", "slot"])), ["feature", "slot"])
    hits = placed.select("feature", "value", "__n", (F.col("__cum") - F.col("__before")).alias("__upto"), F.explode("asks").alias("w"))
    hit = (F.col("w.at") <= F.col("__upto")) & (F.col("w.at") > F.col("__upto") - F.col("__n"))
    return found.unionByName(hits.filter(hit).select("feature", F.col("w.rank").alias("rank"), "value"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact lower quantiles: the smallest value with at least ``share * n`` values up to it."""
    def at(share: float) -> Callable[[Column], Column]:
        return lambda size: F.greatest(F.ceil(rnd(F.lit(float(share)) * size, 6)), F.lit(1))
    return values_at_ranks(df, columns, {repr(float(s)): at(s) for s in shares})


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians, the mean of the two middle values for an even count: rows ``(feature, median)``."""
    ends = {"low": lambda size: F.floor((size + 1) / 2), "high": lambda size: F.ceil((size + 1) / 2)}
    return values_at_ranks(df, columns, ends).groupBy("feature").agg(F.avg("value").alias("median"))
