"""Splits, class balance and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.numeric import keyed_hash
from furlong.operators.neighbours import near_rows
from furlong.operators.ordering import mark_first_share, number_rows
from furlong.session import materialize

CHUNK = 1_000
#: Rows in a cell of the neighbour search at most, and parts into which a level cuts a node.
CELL_ROWS = 256
FAN = 16
#: Columns up to which synthetic rows take exact neighbours; beyond, distance bounds reach most cells.
EXACT_COLUMNS = 6


def split_stratified(df: DataFrame, label: str, key: str, test_share: float = 0.3, seed: int = 0,
                     name: str = "is_test") -> DataFrame:
    """Mark the test rows: the given share of every label, rounded down; null labels are dropped."""
    return mark_first_share(df, label, key, test_share, seed, name)


def split_random(df: DataFrame, key: str, test_share: float = 0.2, valid_share: float = 0.2, seed: int = 0,
                 name: str = "part") -> DataFrame:
    """Mark rows ``test``, ``valid`` or ``train``: a share of all, then a share of the rest.

    Each row's part depends on its key and the seed alone, so nothing is shuffled.
    """
    draw = F.conv(F.substring(keyed_hash(key, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    valid_to = test_share + (1 - test_share) * valid_share
    return df.withColumn(name, F.when(draw < test_share, "test").when(draw < valid_to, "valid").otherwise("train"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, weight)`` with weight ``(1 / n) * (total / 2)``."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.select(label, ((1 / F.col("n")) * (total.scalar() / 2)).alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).withColumnRenamed("weight", name)
    return df.join(materialize(weights, "weights"), label)


def of_class(df: DataFrame, label: str, value: int) -> DataFrame:
    return df.filter(F.col(label) == value)


def _uniform(*parts: Column | str) -> Column:
    """A number from 0 to below 1 that depends on the given values only."""
    text = F.concat_ws(":", *[(F.lit(p) if isinstance(p, str) else p.cast("string")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def repeated(df: DataFrame, copies: Column, most: int, name: str, chunk: int = CHUNK) -> DataFrame:
    """Every row ``copies`` times, numbered from 0 in ``name``; rows without copies are dropped.

    Copies are made in chunks that are dealt over all tasks if a row has more than one of them; ``most`` is
    the largest number of copies.
    """
    out = df.withColumn("__copies", copies.cast("long")).filter(F.col("__copies") > 0)
    if most > chunk:
        out = out.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / chunk))))
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartition(parts, F.xxhash64(*df.columns), "__chunk")
    else:
        out = out.withColumn("__chunk", F.lit(0).cast("long"))
    first = F.col("__chunk") * chunk
    last = F.least(first + chunk, F.col("__copies")) - 1
    return out.withColumn(name, F.explode(F.sequence(first, last))).drop("__copies", "__chunk")


def balanced_by_copies(df: DataFrame, label: str, key: str) -> DataFrame:
    """Repeat rows of the smaller classes until all have the size of the largest, up to one copy per row."""
    sizes = materialize(df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("__label")).agg(
        F.count("*").alias("__n")), "sizes")
    ends = sizes.agg(F.max("__n"), F.min("__n")).first()
    largest, smallest = ends[0] or 0, ends[1] or 1
    share = F.lit(largest) / F.col("__n")
    draw = _uniform("copies", F.col(key))
    joined = df.join(sizes, F.col(label) == F.col("__label"), "left")
    whole = F.coalesce(F.floor(share) + (draw < share - F.floor(share)).cast("int"), F.lit(1))
    return repeated(joined.select(*df.columns, whole.alias("__whole")), F.col("__whole"), -(-largest // smallest),
                    "__copy").select(*df.columns)


def projections(df: DataFrame, columns: Sequence[str], number: int, seed: int) -> list[Column]:
    """Fixed random directions through the standardised columns; near points have near values.

    Means and deviations are rounded, so that values do not depend on the order of summation.
    """
    stats = df.agg(*[f(F.col(c).cast("double")) for c in columns for f in (F.avg, F.stddev_pop)]).first()
    out = []
    for p in range(number):
        weights = np.random.default_rng([seed, p]).normal(size=len(columns)).round(3)
        total = F.lit(0.0)
        for i, c in enumerate(columns):
            mean, spread = round(stats[2 * i] or 0.0, 6), round(stats[2 * i + 1] or 0.0, 6)
            if spread > 0:
                total = total + (F.col(c).cast("double") - F.lit(mean)) / F.lit(spread) * F.lit(float(weights[i]))
        out.append(F.round(total, 6))
    return out


def _apart(one: Column, other: Column, n: int) -> Column:
    """Squared distance of two arrays in steps of 1e-9, so that sums that differ by rounding alone are equal."""
    return F.rint(reduce(lambda t, i: t + (one[i] - other[i]) * (one[i] - other[i]), range(n), F.lit(0.0)) * 1e9)


def _distance_bounds(spots: DataFrame, alongs: Sequence[Column], n: int, neighbours: int, reach: int,
                     piece_rows: int) -> DataFrame:
    """``__spot, __bound``: at least ``neighbours`` other spots are within the bound; null if too few were met.

    Met are the ``reach`` spots before and after along each direction. Windows run on pieces of fixed size that
    overlap by ``reach`` rows.
    """
    piece = F.floor((F.col("__rn") - 1) / piece_rows)
    met = []
    for along in alongs:
        row = number_rows(spots.select("__spot", "__point", along.alias("__along")), ["__along", "__spot"], "__rn")
        low, high = (F.greatest(F.floor((F.col("__rn") - 1 + d) / piece_rows), F.lit(0)) for d in (-reach, reach))
        row = row.withColumn("__home", piece).withColumn("__piece", F.explode(F.sequence(low, high)))
        near = Window.partitionBy("__piece").orderBy("__rn").rowsBetween(-reach, reach)
        row = row.withColumn("__met", F.collect_list(F.struct("__spot", "__point")).over(near))
        met.append(row.filter(F.col("__piece") == F.col("__home")).select("__spot", "__point", "__met"))
    every = reduce(DataFrame.unionByName, met).groupBy("__spot").agg(
        F.first("__point").alias("__point"), F.array_distinct(F.flatten(F.collect_list("__met"))).alias("__met"))
    others = F.filter("__met", lambda m: m["__spot"] != F.col("__spot"))
    ranked = F.array_sort(F.transform(others, lambda m: _apart(F.col("__point"), m["__point"], n)))
    return every.select("__spot", F.try_element_at(ranked, F.lit(neighbours)).alias("__bound"))


def _cells(spots: DataFrame, n: int) -> tuple[DataFrame, list[DataFrame]]:
    """(spots with their ``__cell`` of at most ``CELL_ROWS`` rows, the boxes of the nodes above, top first).

    Each level cuts every node into ``FAN`` parts of equal size along the column in which it is widest.
    """
    at, size, boxes = spots.withColumn("__cell", F.lit(0).cast("long")), spots.count(), []
    ends = [(F.min(F.col("__point")[i]), F.max(F.col("__point")[i])) for i in range(n)]
    while True:
        box = materialize(at.groupBy("__cell").agg(
            F.array(*[low for low, _ in ends]).alias("__low"), F.array(*[high for _, high in ends]).alias("__high"),
            F.count("*").alias("__n")), "boxes")
        boxes.append(box)
        if size <= CELL_ROWS:
            return at, boxes
        wide = F.array(*[F.col("__high")[i] - F.col("__low")[i] for i in range(n)])
        widest = box.select("__cell", "__n", (F.array_position(wide, F.array_max(wide)) - 1).cast("int").alias("__wide"))
        row = at.join(widest, "__cell").withColumn("__value", F.element_at("__point", F.col("__wide") + 1))
        row = materialize(number_rows(row, ["__cell", "__value", "__spot"], "__rn"), "numbered")
        first = row.groupBy("__cell").agg(F.min("__rn").alias("__first"))
        part = F.floor((F.col("__rn") - F.col("__first")) * FAN / F.col("__n"))
        at = materialize(row.join(materialize(first, "firsts"), "__cell").withColumn(
            "__cell", F.col("__cell") * FAN + part).select(*spots.columns, "__cell"), "cells")
        size = -(-size // FAN)


def nearest_rows(df: DataFrame, key: str, columns: Sequence[str], neighbours: int = 5, reach: int = 10,
                 directions: int = 4, piece_rows: int = 10_000, seed: int = 0) -> DataFrame:
    """``key, near``: the keys of each row's nearest other rows, nearest first; exact at every size.

    Rows are ranked by their distance in standardised columns, ties by key; columns must be finite. Equal rows
    are one spot with its first keys. The ``reach`` spots before and after along each of several random
    directions bound the distance; ``reach`` and ``directions`` change the work, not the result. Every cell of
    bounded fill whose box the bound reaches is then searched. The work grows little faster than the rows in few
    columns; the more columns, the more cells are reached, up to all of them.
    """
    n = len(columns)
    stats = df.agg(*[F.stddev_pop(F.col(c).cast("double")) for c in columns]).first()
    scale = [1.0 / round(s, 6) if s and round(s, 6) > 0 else 0.0 for s in stats]
    rows = materialize(df.select(F.col(key).alias("__key"), *columns, F.array(*[
        F.col(c).cast("double") * F.lit(k) for c, k in zip(columns, scale)]).alias("__point")), "points")
    order = F.row_number().over(Window.partitionBy("__point").orderBy("__key"))
    firsts = rows.withColumn("__no", order).filter(F.col("__no") <= neighbours + 1).groupBy("__point").agg(
        F.array_sort(F.collect_list("__key")).alias("__keys"), *[F.min_by(c, "__key").alias(c) for c in columns])
    spots = materialize(firsts.withColumn("__spot", F.monotonically_increasing_id()), "spots")
    alongs = projections(df, columns, directions, seed)
    bounds = _distance_bounds(spots, alongs, n, neighbours, reach, piece_rows)
    cells, boxes = _cells(spots.select("__spot", "__point", "__keys"), n)
    asking = materialize(spots.select("__spot", "__point").join(bounds, "__spot").withColumn(
        "__bound", F.coalesce("__bound", F.lit(float("inf")))), "asking")
    x = F.col("__point")
    gaps = F.array(*[F.greatest(F.col("__low")[i] - x[i], x[i] - F.col("__high")[i], F.lit(0.0)) for i in range(n)])
    asked = asking.withColumn("__cell", F.lit(0).cast("long"))
    for box in boxes[1:]:
        child = box.select(F.col("__cell").alias("__child"), F.floor(F.col("__cell") / FAN).alias("__cell"), "__low", "__high")
        asked = asked.join(child, "__cell").withColumn("__gaps", gaps).filter(
            _apart(F.col("__gaps"), F.array(*[F.lit(0.0)] * n), n) <= F.col("__bound"))
        asked = asked.select("__spot", "__point", "__bound", F.col("__child").alias("__cell"))
    there = cells.select("__cell", F.col("__point").alias("__there"), "__keys")
    found = asked.join(there, "__cell").withColumn("__d", _apart(x, F.col("__there"), n)).filter("__d <= __bound")
    found = found.select("__spot", "__d", F.explode("__keys").alias("k"))
    best = F.row_number().over(Window.partitionBy("__spot").orderBy("__d", "k"))
    lists = found.withColumn("__no", best).filter(F.col("__no") <= neighbours + 1).groupBy("__spot").agg(
        F.array_sort(F.collect_list(F.struct("__d", "k"))).alias("__best"))
    lists = materialize(lists.join(spots.select("__spot", "__point"), "__spot").select("__point", "__best"), "nearest")
    others = F.filter(F.transform("__best", lambda m: m["k"]), lambda k: k != F.col("__key"))
    return rows.join(lists, "__point").select(F.col("__key").alias(key), F.slice(others, 1, neighbours).alias("near"))


def smote(df: DataFrame, label: str, key: str, numeric: Sequence[str], carried: Sequence[str] = (),
          neighbours: int = 5, seed: int = 0, reach: int = 10, directions: int = 4) -> DataFrame:
    """Add synthetic minority rows until both classes are equally large; there must be two classes.

    Each new row lies between a minority row and one of its nearest minority rows: the exact ones in up to
    ``EXACT_COLUMNS`` numeric columns (:func:`nearest_rows`), those of a refined neighbour graph in more
    (:func:`furlong.operators.neighbours.near_rows`).
    New rows are spread evenly over the minority; partner and distance follow hashes of key and copy.
    ``carried`` columns (codes of categories) take the neighbour's value; a minority of one row is copied.
    Numeric columns must not be null, keys must be unique. New rows have a null key and ``synthetic`` 1.
    Everything runs in the JVM, and the copies of a row are dealt over all tasks in chunks.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).orderBy("n", label).limit(3).collect()
    if len(counts) != 2:
        raise ValueError(f"two values of {label} are needed, there are {'more' if len(counts) > 2 else len(counts)}")
    columns = [label, *numeric, *carried]
    own = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in numeric], *carried, F.lit(0).alias("synthetic"))
    (minority, n), (_, most) = counts
    missing = most - n
    if not missing:
        return own
    few = materialize(df.filter(F.col(label) == minority).select(
        F.col(key).alias("__key"), *[F.col(c).cast("double").alias(c) for c in numeric], *carried), "minority")
    if len(numeric) <= EXACT_COLUMNS:
        near = nearest_rows(few, "__key", numeric, neighbours, reach, directions, seed=seed)
    else:
        near = near_rows(few, "__key", numeric, neighbours, seed=seed)
    # The i-th row in the order of a hash makes floor(i * missing / n) - floor((i - 1) * missing / n) new rows.
    order = few.select("__key", F.md5(F.concat(F.lit(f"{seed}:"), F.col("__key").cast("string"))).alias("__hash"))
    numbered = number_rows(order, ["__hash", "__key"], "__rn")
    upto = [F.floor(F.lit(missing).cast("decimal(19,0)") * i / n) for i in (F.col("__rn"), F.col("__rn") - 1)]
    wanted = numbered.select("__key", (upto[0] - upto[1]).cast("long").alias("__new"))
    makers = repeated(near.join(wanted, "__key").filter(F.col("__new") > 0), F.col("__new"), -(-missing // n), "__copy")
    choice = _uniform(f"p{seed}", F.col("__key"), F.col("__copy")) * F.size("near")
    makers = makers.select("__key", "__copy", F.coalesce(F.try_element_at("near", F.floor(choice).cast("int") + 1),
                                                         F.col("__key")).alias("__other"))
    partner = few.select(F.col("__key").alias("__other"), *[F.col(c).alias(f"__o_{c}") for c in (*numeric, *carried)])
    gap = _uniform(f"g{seed}", F.col("__key"), F.col("__copy"))
    made = makers.join(few.select("__key", *numeric), "__key").join(partner, "__other").select(
        F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(minority).cast(df.schema[label].dataType).alias(label),
        *[(F.col(c) + gap * (F.col(f"__o_{c}") - F.col(c))).alias(c) for c in numeric],
        *[F.col(f"__o_{c}").alias(c) for c in carried], F.lit(1).alias("synthetic"))
    return own.unionByName(made).select(key, *columns, "synthetic")
