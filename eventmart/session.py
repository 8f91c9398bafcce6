"""Session defaults and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Column calls need not record their Python call site; plans build in half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "eventmart", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings this package relies on, plus `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Event time is zone-free UTC; in another session zone parsing and spans would shift."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"set spark.sql.session.timeZone to UTC, it is {zone}")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` names it.

    Only a local master may fall back to a temporary folder: on a cluster that
    would sit on one machine and vanish with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="eventmart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/eventmart/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


_threads = threading.local()


def _staged() -> list[str]:
    """What this thread has staged; tables may be built side by side."""
    if not hasattr(_threads, "staged"):
        _threads.staged = []
    return _threads.staged


def stage(df: DataFrame) -> DataFrame:
    """Write rows once to the shared folder and read them back.

    What follows starts from stored columns: several passes do not recompute the
    input, each reads only the columns it needs, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = shared_path(spark, "stage")
    df.write.parquet(path)
    _staged().append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession):
    """Delete what `stage` writes inside the block when it ends.

    For jobs that store their result inside the block; a result still to be read
    needs its staged rows.
    """
    start = len(_staged())
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for name in _staged()[start:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        del _staged()[start:]
