"""Files: the entry CSV, the feature table, the prediction CSV and reports."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from furlong.operators.ordering import number_rows

ENTRY_TYPES = {
    "raceid": "bigint", "racenum": "bigint", "days": "timestamp_ntz", "horsename": "string", "jocky": "string",
    "trainer": "string", "father": "string", "fathermon": "string", "fathertype": "string", "mother": "string",
    "place": "string", "distance": "int", "turf": "string", "condition": "string", "weather": "string",
    "class": "string", "sex": "string", "legtype": "string", "horsecount": "bigint", "horsenum": "int", "pop": "int",
    "odds": "double", "weight": "double", "result": "int", "time": "double", "3ftime": "double", "rank3": "int",
    "rank4": "int",
}

SHIFT_JIS = "windows-31j"


def _allow_java_charsets(spark: SparkSession) -> None:
    """Shift-JIS is outside Spark 4's default list of charsets."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")


#: Forms of a date that are tried in turn; the first that fits the whole text counts.
DATE_PATTERNS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss[.SSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSS]", "yyyy/M/d", "yyyy/M/d H:mm:ss",
                 "yyyy.M.d", "yyyyMMdd", "yyyy'年'M'月'd'日'")


def read_text_csv(spark: SparkSession, path: str, encoding: str = SHIFT_JIS) -> DataFrame:
    """CSV with a header as text columns in file order. Files with different headers are an error."""
    _allow_java_charsets(spark)
    return spark.read.option("header", True).option("encoding", encoding).option("enforceSchema", False).csv(path)


def read_entries_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
                     encoding: str = SHIFT_JIS, date_patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Entries from CSV, found by the names in the header; further columns are ignored.

    A missing column is an error. Values that are no number of their column's type become null, as does NaN
    in a double column; a whole number may be written with a decimal point. Timestamps may have any of
    ``date_patterns``; see :func:`unparsed_days` for those that have none.
    """
    types = types or ENTRY_TYPES
    text = read_text_csv(spark, path, encoding)
    names = {c.strip().lstrip("\ufeff"): c for c in text.columns}
    missing = [c for c in types if c not in names]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")

    def typed(name: str, kind: str) -> Column:
        value = F.col(f"`{names[name]}`")
        if kind == "string":
            return value
        if kind.startswith("timestamp"):
            return parsed_days(names[name], *date_patterns)
        number = F.trim(value)
        if kind == "double":
            read = number.try_cast("double")
            return F.when(~F.isnan(read), read)
        return F.coalesce(number.try_cast(kind), number.try_cast("double").try_cast(kind))

    return text.select(*[typed(c, t).alias(c) for c, t in types.items()])


def unparsed_days(text: DataFrame, column: str = "days", date_patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """``(column, n)``: texts of dates that fit no pattern, with the number of their rows."""
    lost = F.col(column).isNotNull() & parsed_days(column, *date_patterns).isNull()
    return text.filter(lost).groupBy(column).agg(F.count("*").alias("n"))


def write_entries_csv(df: DataFrame, path: str, encoding: str = SHIFT_JIS) -> None:
    _allow_java_charsets(df.sparkSession)
    df.write.option("header", True).option("encoding", encoding).csv(path)


def parsed_days(column: str, *patterns: str) -> Column:
    """Text to timestamp without time zone; text that fits none of the patterns becomes null."""
    tried = [F.try_to_timestamp(F.trim(F.col(f"`{column}`")), F.lit(p)) for p in patterns or ("yyyy-MM-dd",)]
    return F.coalesce(*tried).cast("timestamp_ntz")


def checkpoint_path(root: str, *settings: object) -> str:
    """Path of a feature table whose name depends on all settings that shape it."""
    digest = hashlib.sha256(repr(settings).encode()).hexdigest()[:16]
    return f"{root.rstrip('/')}/features-{digest}"


MARK = "mark.json"


class NotFinished(ValueError):
    """There is no finished table, or it is not the one that was asked for."""


def input_fingerprint(df: DataFrame) -> str:
    """Names, sizes and times of all files that ``df`` reads; of a table without files its rows, in any order."""
    spark, found = df.sparkSession, hashlib.sha256()
    conf = spark._jsc.hadoopConfiguration()
    names = sorted(df.inputFiles())
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        found.update(f"{name}:{status.getLen()}:{status.getModificationTime()};".encode())
    if not names:
        rows = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
        found.update(repr((df.columns, *rows)).encode())
    return found.hexdigest()


def save_table(df: DataFrame, path: str, inputs: str | None = None) -> None:
    """Write a table aside, then publish it with a mark of its name, input fingerprint, folder and number of rows.

    The mark is replaced last, so a run that dies before leaves the earlier table, or none.
    """
    spark, folder = df.sparkSession, f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    mark = {"name": path.rsplit("/", 1)[-1], "inputs": inputs, "folder": folder,
            "rows": spark.read.schema(df.schema).parquet(f"{path}/{folder}").count()}
    names = [spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}") for n in (f"{MARK}-{folder}", MARK, folder)]
    system = names[0].getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(names[0], True)
    out.write(bytearray(json.dumps(mark).encode()))
    out.close()
    system.delete(names[1], False)
    if not system.rename(names[0], names[1]):
        raise NotFinished(f"{path} could not be published")
    for status in system.listStatus(names[1].getParent()):
        if status.getPath().getName() not in (folder, MARK):
            system.delete(status.getPath(), True)


def load_table(spark: SparkSession, path: str, inputs: str | None = None) -> DataFrame:
    """The published table; a missing or foreign mark, missing rows or another input are refused."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARK}")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        raise NotFinished(f"no finished table in {path}")
    told = json.loads(spark.read.text(f"{path}/{MARK}", wholetext=True).first()[0])
    if told["name"] != path.rsplit("/", 1)[-1]:
        raise NotFinished(f"{path} holds a table of other settings")
    if inputs is not None and told["inputs"] != inputs:
        raise NotFinished(f"the table in {path} was built from another input")
    table = spark.read.parquet(f"{path}/{told['folder']}")
    if table.count() != told["rows"]:
        raise NotFinished(f"the table in {path} has lost rows")
    return table


def saved_or_built(spark: SparkSession, path: str, build, resume: bool, inputs: str | None = None) -> DataFrame:
    """Read the finished table when resuming, else build it, publish it and read it back."""
    if not resume:
        save_table(build(), path, inputs)
    return load_table(spark, path, inputs)


def numbered_predictions(df: DataFrame, key: str = "raceid") -> DataFrame:
    """Predictions with a row number from 0 in key order, the first column of the prediction file."""
    numbered = number_rows(df, [key], "row").withColumn("row", F.col("row") - 1)
    return numbered.select("row", *df.columns)


def write_predictions_csv(df: DataFrame, path: str) -> None:
    """The prediction file: numbered predictions with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_predictions_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A prediction file with the columns of ``schema``, found by their names."""
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def write_report(df: DataFrame, path: str) -> None:
    """A feature report ``(feature, kept, score)``: one small file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
