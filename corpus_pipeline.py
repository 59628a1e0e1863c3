"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the
next one's ``docs``: documents without a language go, one document of each group of near copies stays, word
sequences that repeat are removed from the texts, documents with benchmark items go, the rest is packed.
All columns of the documents are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import contain, crf, jaccard, packing, substring
from furlong.llm.blocks import written
from furlong.llm.ship import ship_package
from furlong.session import delete_path, kept, scratch_path, scratch_scope

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Texts in which no language reaches this mean probability are rejected. A text that switches between two
#: languages has about one half.
LEAST_LANGUAGE_SCORE = 0.3

# Some stages can't be stated in SQL (a learned model, sampled paths, a tokenizer).
ORACLE_SQL = None


def with_row_number(docs: DataFrame) -> DataFrame:
    """Rows of a written table with a number of their own, so that repeated keys stay apart."""
    return docs.withColumn("__row", F.monotonically_increasing_id())


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts that are null or without a letter are rejected."""
    ship_package(spark)
    model = crf.fit(crf.training_sample(docs, F.lit(True)))
    found = crf.with_language(docs, model, pred="__lang", score="__score")
    if model.langs:
        found = found.filter((F.col("__lang") != crf.UNKNOWN) & (F.col("__score") >= LEAST_LANGUAGE_SCORE))
    return found.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that word 5-gram Jaccard similarities of 0.8 or more connect."""
    ship_package(spark)

    def first_ones() -> DataFrame:
        # The number depends on how the scan is cut, so all steps below read one written copy.
        numbered = written(with_row_number(docs), "numbered")
        classes = jaccard.near_duplicates(numbered, key="__row")
        first = classes.filter(F.col("__row") == F.col("class_id")).select("__row")
        return numbered.join(first, "__row", "left_semi").select(*docs.columns)

    return kept(spark, first_ones, "first-ones")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without word sequences that occur more than once; other texts stay as they are, also null."""
    ship_package(spark)

    def cleaned() -> DataFrame:
        found = substring.without_repeats(with_row_number(docs), key="__row", keep_text=True, carry=docs.columns)
        changed = F.col("n_removed") > 0
        new = {"text": F.when(changed, F.col("text")).otherwise(F.col("carried.text"))}
        if "n_chars" in docs.columns:
            kind = docs.schema["n_chars"].dataType
            new["n_chars"] = F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("carried.n_chars"))
        return found.select(*[new.get(c, F.col("carried")[c]).alias(c) for c in docs.columns])

    return kept(spark, cleaned, "cleaned")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship_package(spark)
    return contain.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens with the sources' shares in every stretch."""
    ship_package(spark)
    return packing.packed(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's scratch goes when its output is written, its input with it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
