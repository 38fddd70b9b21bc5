"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings the results or the plans depend on; everything else is left to the
# cluster (shuffle partitions in particular are sized by AQE at run time).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Keeps the state of streams on disk instead of in the executors' memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


# Folders this process made under the shared folder, and its own one where none is named.
_MADE: list[str] = []
_LOCAL: list[tempfile.TemporaryDirectory] = []


def working_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder the cluster names.

    Only a local session without that setting falls back to a folder of this
    machine, which goes when the process ends; on a cluster the executors would not
    see it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.TemporaryDirectory(prefix="tidemark-"))
        root = _LOCAL[0].name
    _MADE.append(f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}")
    return _MADE[-1]


def clean_up(spark: SparkSession) -> None:
    """Delete the working folders this process made; no result that reads them may be
    in use any more. For the end of a session."""
    from tidemark.sources import paths

    while _MADE:
        paths.remove(spark, _MADE.pop())


def together(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run independent jobs at the same time, so that none leaves executors idle."""
    with ThreadPoolExecutor() as pool:
        for job in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            job.result()
