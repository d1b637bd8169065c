"""Session settings and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Applied only when this module creates the session; a session handed in by the
# caller keeps its own settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Gold dimensions are read from Parquet, so Catalyst knows their size and
    # broadcasts only those below this bound; larger ones are shuffle-joined.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create_session(
    app_name: str = "fiscalake",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where that is unset it is set to a folder in the warehouse, which the driver and all
    executors share as well; never to a folder of one machine alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    chosen = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


#: Partitions that a task writes side by side. A task with more of them sorts its other rows.
OPEN_WRITERS = 64
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_lock, _entered, _found = threading.Lock(), {}, {}


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Within this, tasks keep a file open for each partition instead of sorting their rows.

    Sorting holds all rows of a task in memory, many times the size of the files they are read
    from. Several threads may be within it; the last one to leave puts the setting back.
    """
    with _lock:
        if not _entered.get(spark):
            _found[spark] = spark.conf.get(_WRITERS, None)
            spark.conf.set(_WRITERS, str(OPEN_WRITERS))
        _entered[spark] = _entered.get(spark, 0) + 1
    try:
        yield
    finally:
        with _lock:
            _entered[spark] -= 1
            if not _entered[spark]:
                del _entered[spark]
                before = _found.pop(spark)
                spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)
