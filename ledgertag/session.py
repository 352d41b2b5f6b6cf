"""Session settings, and where intermediate results may be kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A frame is sent to every executor only after its rows were counted and are no more than this.
BROADCAST_ROWS = 200_000


def build_session(app_name: str = "ledgertag", **settings: str) -> SparkSession:
    """A session with the settings the jobs are written for; existing ones are reused."""
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key also where that costs another shuffle afterwards.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent and all runs on one machine, as in tests, a temporary folder
    takes its place. On a cluster every executor would see another one, so that raises.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="ledgertag-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)
PREFIX = "ledgertag-"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, inside the current scope if there is one."""
    place = _scope.get() or f"{shared_folder(spark).rstrip('/')}/{PREFIX}{uuid.uuid4().hex}"
    return f"{place}/{uuid.uuid4().hex}/{name}" if _scope.get() else f"{place}/{name}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """Intermediate tables written inside belong to this scope and go when it ends.

    For jobs that write their output before the scope ends: a frame that is still to be computed
    would lose its source. If the job fails the tables stay and ``scratch_scopes`` lists them; the
    scope of a job inside another one is part of the outer one.
    """
    if outer := _scope.get():
        yield outer
        return
    place = f"{shared_folder(spark).rstrip('/')}/{PREFIX}{name}-{uuid.uuid4().hex}"
    token = _scope.set(place)
    try:
        yield place
    finally:
        _scope.reset(token)
    drop_scratch(spark, place)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch_scopes(spark: SparkSession) -> list[str]:
    """The folders of this library that are left below the shared folder."""
    system, place = _files(spark, shared_folder(spark))
    if not system.exists(place):
        return []
    found = [entry.getPath() for entry in system.listStatus(place)]
    return sorted(path.toString() for path in found if path.getName().startswith(PREFIX))


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one of the folders that ``scratch_scopes`` lists."""
    system, place = _files(spark, path)
    if not place.getName().startswith(PREFIX):
        raise ValueError(f"{path} is not a scratch folder of this library")
    system.delete(place, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame once and go on from a parquet table in the shared folder.

    Later steps read only the columns and row groups they need, and depend on no executor.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Materialize an aggregated frame and mark it for broadcast if it is small enough.

    Beyond the bound no hint is given: Spark then shuffles both sides, and splits hot keys
    at run time (adaptive skew join).
    """
    kept = materialize(df)
    return F.broadcast(kept) if kept.count() <= max_rows else kept
