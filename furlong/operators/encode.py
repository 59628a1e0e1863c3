"""Folds, out-of-fold encodings, principal components, label and one-hot encodings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.config import Profile
from furlong.functions.numeric import rnd, rnd_mean
from furlong.functions.racing import binarized
from furlong.operators.aggregates import categories, entity_rates, keyed
from furlong.operators.joins import lookup
from furlong.operators.ordering import HOT_ROWS, grouped_numbers, hash_ranks
from furlong.session import materialize

MAX_BROADCAST_CODES = 100_000


def stratified_folds(df: DataFrame, label: str, key: str, folds: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold 0..folds-1 per row, equal in size within each label up to one row; null labels are dropped."""
    ranked = hash_ranks(df, label, key, seed, "__rank")
    return ranked.withColumn(name, ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank")


def fold_table(df: DataFrame, entity: str, label: str, fold: str = "fold") -> DataFrame:
    """``(entity, fold, n, encoding)``: label sum over the count plus one, both without the fold's rows."""
    per_fold = keyed(df, [entity]).groupBy(entity, fold).agg(
        F.sum(label).alias("__s"), F.count(label).alias("n"))
    whole = Window.partitionBy(entity)     # at most one row per fold
    rest_sum = F.sum("__s").over(whole) - F.col("__s")
    rest_count = F.sum("n").over(whole) - F.col("n")
    return per_fold.select(entity, fold, "n", (rest_sum / (rest_count + 1)).alias("encoding"))


def out_of_fold(df: DataFrame, entity: str, label: str, name: str, fold: str = "fold") -> DataFrame:
    """Attach each row's encoding, taken from the other folds of its entity."""
    table = fold_table(df, entity, label, fold).select(entity, fold, F.col("encoding").alias(name))
    return lookup(df, table, [entity, fold])


def entity_encoding(df: DataFrame, entity: str, label: str, name: str, fold: str = "fold", digits: int = 3) -> DataFrame:
    """Mean of the rows' encodings per entity, from the fold table alone."""
    table = fold_table(df, entity, label, fold)
    mean = F.sum(F.col("n") * F.col("encoding")) / F.sum("n")
    return table.groupBy(entity).agg(rnd_mean(mean, digits).alias(name))


def principal_components(matrix: DataFrame, entity: str, names: Sequence[str], digits: int | None = 3,
                         scale: bool = False) -> DataFrame:
    """Scores of the leading components of a numeric matrix with one row per entity.

    Columns are centred, and scaled only on request. A component's sign is chosen so that its loading of
    largest size is positive. Nulls count as 0. The matrix is read several times: pass a written table.
    """
    columns = [c for c in matrix.columns if c != entity]
    k = min(len(names), len(columns))
    vectors = VectorAssembler(inputCols=columns, outputCol="__raw").transform(matrix.fillna(0.0, subset=columns))
    scaler = StandardScaler(inputCol="__raw", outputCol="__centred", withMean=True, withStd=scale).fit(vectors)
    centred = scaler.transform(vectors)
    model = PCA(k=k, inputCol="__centred", outputCol="__scores").fit(centred)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, j])), j] >= 0 else -1.0 for j in range(k)]
    scores = model.transform(centred).withColumn("__scores", vector_to_array("__scores"))
    out = {names[j]: F.col("__scores")[j] * signs[j] for j in range(k)}
    if digits is not None:
        out = {n: rnd(c, digits) for n, c in out.items()}
    return scores.select(entity, *[c.alias(n) for n, c in out.items()])


def covariance_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, covariance)``: sample covariance of every pair of columns, by position, ``a <= b``."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    first = df.select(F.posexplode(values).alias("a", "x"), values.alias("v"))
    pairs = first.select("a", "x", F.posexplode("v").alias("b", "y")).filter("a <= b")
    return pairs.groupBy("a", "b").agg(F.covar_samp("x", "y").alias("covariance"))


def component_invariants(matrix: DataFrame, entity: str) -> DataFrame:
    """``(invariant, value)`` of all principal components of a matrix, as far as they don't depend on signs and order.

    ``mean`` and ``cross`` are the largest mean and the largest covariance of two components, both 0 but for
    rounding. ``trace``, ``squares`` and ``cubes`` add up the first three powers of the components' variances: the traces
    of the powers of the matrix's covariance. ``entities`` counts rows.
    """
    names = [f"p{i}" for i in range(len(matrix.columns) - 1)]
    scores = materialize(principal_components(matrix, entity, names, digits=None), "scores")
    pairs = materialize(covariance_table(scores, names), "covariance")
    largest = scores.agg(F.count("*").cast("double").alias("entities"),
                         F.greatest(*[F.abs(F.avg(c)) for c in names], F.lit(0.0)).alias("mean"))
    own, value = F.col("a") == F.col("b"), F.col("covariance")
    sums = pairs.agg(F.coalesce(F.max(F.when(~own, F.abs(value))), F.lit(0.0)).alias("cross"), *[
        F.sum(F.when(own, value ** power)).alias(name) for power, name in ((1, "trace"), (2, "squares"), (3, "cubes"))])
    return largest.unpivot([], largest.columns, "invariant", "value").unionByName(
        sums.unpivot([], sums.columns, "invariant", "value"))


def profile_base(df: DataFrame, profiles: Sequence[Profile], seed: int) -> DataFrame:
    """Rows the encodings are computed from: binarised result and its seeded rank within each class.

    One numbering serves every fold count. Only the key and the entities are kept.
    """
    entities = dict.fromkeys(p.entity for p in profiles)
    return hash_ranks(df.select("raceid", *entities, binarized(F.col("result")).alias("result")), "result", "raceid", seed, "rank")


def profile_rows(df: DataFrame, profiles: Sequence[Profile]) -> DataFrame:
    """Rows the rates are computed from, with the binarised result; no numbering is needed for them."""
    needed = dict.fromkeys(c for p in profiles for c in (p.entity, *p.categories, *p.means))
    needed.pop("result", None)
    return df.select(*needed, binarized(F.col("result")).alias("result")).filter(F.col("result").isNotNull())


def profile_matrix(rows: DataFrame, profile: Profile, values: dict[str, list] | None = None) -> DataFrame:
    """Entity × category rates and means, written out, as the components' input."""
    values = {c: values[c] for c in profile.categories} if values else categories(rows, profile.categories)
    return materialize(entity_rates(rows, profile.entity, values, means=profile.means, digits=profile.digits,
                                    prefix=profile.prefix), "matrix")


def entity_profile(base: DataFrame, profile: Profile, rows: DataFrame | None = None,
                   values: dict[str, list] | None = None) -> DataFrame:
    """One row per entity: averaged out-of-fold encoding and, with ``rows``, component scores; three digits."""
    folded = base.withColumn("fold", ((F.col("rank") - 1) % profile.folds).cast("int"))
    encoding = entity_encoding(folded, profile.entity, "result", profile.encoding)
    if rows is None:
        return encoding
    scores = principal_components(profile_matrix(rows, profile, values), profile.entity, profile.component_names())
    return encoding.join(scores, profile.entity, "left")


def label_codes(df: DataFrame, columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(column, value, code)``: codes from 0 in text order for all columns, from one pass over the rows."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = text.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull()).distinct()
    pairs = materialize(pairs, "labels")
    numbered = grouped_numbers(pairs, ["column"], {"code": [F.col("value")]}, hot_rows=hot_rows)
    return numbered.select("column", "value", (F.col("code") - 1).cast("int").alias("code"))


def label_encoded(df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None) -> DataFrame:
    """Replace each column by its code; null stays null. The column order is kept.

    Columns with at most ``MAX_BROADCAST_CODES`` values are looked up in a broadcast table, the others by
    a shuffled join, whose skewed partitions AQE splits.
    """
    codes = materialize(label_codes(df, columns) if codes is None else codes, "codes")
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    out = df
    for c in columns:
        own = codes.filter(F.col("column") == c).select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
        if sizes.get(c, 0) <= MAX_BROADCAST_CODES:
            own = F.broadcast(own)
        out = out.join(own, F.col(c).cast("string") == F.col(f"__v_{c}"), "left")
    return out.select(*[F.col(f"__c_{c}").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def one_hot(df: DataFrame, columns: Sequence[str], levels: dict[str, list] | None = None) -> DataFrame:
    """One 0/1 column ``{column}_{value}`` per level instead of each column; null gives zeros only."""
    levels = categories(df, columns) if levels is None else levels
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    flags = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
             for c in columns for v in levels[c]]
    return df.select(*keep, *flags)
