"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Runtime options the plans are written for. The JVM does not compile methods of more than
# 8000 bytes; a wide projection above that runs faster as separate, compiled expressions.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "slotcast", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the options above; ``conf`` entries override or add to them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME, "spark.cleaner.referenceTracking.cleanCheckpoints": "true", **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """The runtime options on a session somebody else built, for as long as plans are made and stored."""
    before = {name: spark.conf.get(name, None) for name in RUNTIME}
    try:
        for name, value in RUNTIME.items():
            if before[name] != value:
                spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            elif value != RUNTIME[name]:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint directory.

    Only where the session names none and runs on this machine alone (unit tests) a local one
    is set; a cluster without one is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and spark.sparkContext.getCheckpointDir() is None and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="slotcast-"))
    return configured or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_collecting: list[list[str]] = []


@contextmanager
def stored_tables_dropped(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, the tables stored inside the block; nothing that reads them may be left."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield
    finally:
        _collecting.remove(paths)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def replaced(df: DataFrame) -> Iterator[None]:
    """Deletes the files of a frame that ``materialize`` returned, once the block has stored what takes its place."""
    yield
    path = getattr(df, "_stored_at", None)
    if path is not None:
        _delete(df.sparkSession, path)


def materialize(df: DataFrame, *by: str) -> DataFrame:
    """Compute once, store as a table in the shared folder and continue from the stored rows.

    ``by`` spreads the rows by these columns first, for tables whose few, wide rows are
    expensive to work on.

    Later plans start from the files: short lineage, column pruning and known sizes, and
    nothing to recompute when an executor is lost.
    """
    path = scratch_path(df.sparkSession, "table")
    for kept in _collecting:
        kept.append(path)
    if by:
        df = df.repartition(*by)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored
