"""Session construction and shared-folder helpers.

On a cluster the session is handed to us already configured; ``get_spark``
only fills in settings that are unset, so a cluster's own values (shuffle
partitions, checkpoint folder, memory) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings we rely on. Each is applied only when the session does not
# already carry a value for it.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Python workers are reused across tasks of one stage.
    "spark.python.worker.reuse": "true",
}


def get_spark(master: str | None = None, app: str = "barlens",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("BARLENS_MASTER", "local[8]"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("BARLENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``; only when that is unset (a local test
    session) do we create a private folder and register it; a cluster session
    without it is refused, as executors would each see a folder of their own.
    """
    global _LOCAL_DIR
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="barlens-ckpt-")
        path = _LOCAL_DIR
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCAL_DIR: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/barlens/{name}-{uuid.uuid4().hex[:12]}"


#: Stored bytes that one task takes where a step holds or sorts its whole partition. Sorted in memory, bars
#: take some thirty times what they take as Parquet.
TASK_BYTES = 4 << 20


def tasks_for(*stored: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Partitions for a step over ``stored`` tables, from the bytes of their files (no job runs), so that a
    task's memory stays the same at any size; the session's shuffle partitions at least."""
    size = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in stored)
    return max(int(stored[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // task_bytes))


def at_once(*jobs: Callable[[], object]) -> None:
    """Run Spark jobs that don't need each other side by side: while the last tasks of one run, the cores they leave
    idle take tasks of another. The first error is raised after all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(job)) for job in jobs]
    for job in running:
        job.result()


#: How bars are stored, raw or typed: they take less as Zstandard than as Snappy.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

#: Removes the shuffle files of a write as it ends. Otherwise they lie on disk until the driver happens to collect
#: garbage, and each table that a job writes adds its own.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def held(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` for what is written, started and listed inside; the session's own values come back after it."""
    previous = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``barlens`` usable in Python workers (grouped Arrow calls and
    the stateful stream processor run functions defined here).

    The package is zipped once per application and added with
    ``addPyFile``, which Spark distributes to every executor; nothing needs
    to be installed on the workers.
    """
    import shutil

    import barlens
    from pyspark import cloudpickle
    # Functions and classes of this package travel with their code, so a
    # Python process that never received the zip (the stateful stream's
    # driver-side runner) can still load them.
    cloudpickle.register_pickle_by_value(barlens)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = tempfile.mkdtemp(prefix="barlens-pkg-")
    archive = shutil.make_archive(os.path.join(out, "barlens"), "zip", pkg_root, "barlens")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
