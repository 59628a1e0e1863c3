"""Session settings and the shared folder in which intermediate tables are written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

#: Fixed value: the JVM never compiles a method with more bytes of code than this.
COMPILED_BYTES = 8000
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

_local_dirs: dict[str, str] = {}
_scopes: dict[str, list[Scratch]] = {}
_limited: dict[str, list] = {}
_limiting = Lock()


class Scratch:
    """A folder below the shared one with the tables that lie in it; both go when its scope ends."""

    def __init__(self, folder: str):
        self.folder = folder
        self.tables: list[str] = []

    def path(self, tag: str) -> str:
        return f"{self.folder}/{tag}-{uuid.uuid4().hex}"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(master)
        .appName("furlong")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # The JVM never compiles methods above 8,000 bytes of code. Very wide projections and aggregates
        # are then faster without whole-stage code than with one such method.
        .config(METHOD_LIMIT, str(COMPILED_BYTES))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local master may run without one; it then gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="furlong-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def _application(spark: SparkSession) -> Scratch:
    return Scratch(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def _open_scopes(spark: SparkSession) -> list[Scratch]:
    return _scopes.setdefault(spark.sparkContext.applicationId, [])


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path below the shared folder that nothing else uses; it belongs to the innermost open scope, if any."""
    scopes = _open_scopes(spark)
    return (scopes[-1] if scopes else _application(spark)).path(tag)


def own_table(spark: SparkSession, name: str) -> None:
    """Have a table dropped when the innermost scope ends; without one it stays."""
    if _open_scopes(spark):
        _open_scopes(spark)[-1].tables.append(name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, in whatever file system it lies."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Everything written to scratch inside is deleted at the end, also after a failure; scopes may be nested.

    Tables read from scratch must not be used after their scope. What is to outlive it is written elsewhere before,
    or returned through :func:`kept`.
    """
    scopes = _open_scopes(spark)
    own = (scopes[-1] if scopes else _application(spark)).path("scope")
    scope = Scratch(own)
    scopes.append(scope)
    try:
        yield scope
    finally:
        scopes.remove(scope)
        for name in scope.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(spark, scope.folder)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Queries run inside take whole-stage code only where the JVM compiles it.

    By default Spark also runs methods that are too large for that, which very wide projections and aggregates get; every
    row is then interpreted. The session's own limit, unless it is lower, is set aside until the last of the blocks
    that are open at once ends.
    """
    app = spark.sparkContext.applicationId
    with _limiting:
        state = _limited.setdefault(app, [0, spark, spark.conf.get(METHOD_LIMIT)])
        state[0] += 1
        if state[0] == 1 and int(state[2]) > COMPILED_BYTES:
            spark.conf.set(METHOD_LIMIT, str(COMPILED_BYTES))
    try:
        yield
    finally:
        with _limiting:
            state[0] -= 1
            if not state[0]:
                state[1].conf.set(METHOD_LIMIT, state[2])
                del _limited[app]


def kept(spark: SparkSession, build: Callable[[], DataFrame], tag: str, compression: str = "zstd") -> DataFrame:
    """``build()`` run in a scope of its own: the result is written to the scope around it, the rest is deleted."""
    path = scratch_path(spark, tag)
    with scratch_scope(spark):
        result = build()
        schema = result.schema
        result.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def materialize(df: DataFrame, tag: str = "table", compiled: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage (lost executors re-read files instead of recomputing), fixes the values of
    expressions that depend on partition numbers, and gives Catalyst the true size of the table, so
    that it picks a broadcast join only when the table is below the broadcast threshold. With ``compiled``, for wide
    projections without joins, it is written inside :func:`compiled_methods`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with compiled_methods(spark) if compiled else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
