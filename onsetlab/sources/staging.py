"""Intermediate results written once to the cluster's shared scratch folder.

A staged table survives the loss of executors, cuts lineage, and is read back
column-pruned, so each consumer pays only for the columns it uses.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from onsetlab.functions.sizes import table_bytes

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: For each core, so that every executor has a part in a trial.
TRIAL_TASKS = 2


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the session names, or a temporary one in local mode.

    A folder on one machine's disk is refused where executors run elsewhere,
    unless the setting itself names it with the scheme ``file:``, as for a disk
    that all machines mount, or a trial shows that the machines share it.
    """
    context = spark.sparkContext
    local = context.master.startswith("local")
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if configured:
        if not local and _without_scheme(spark, configured) and not _shared(spark, configured):
            raise RuntimeError(f"{configured} is on each machine's own disk; {CHECKPOINT_SETTING} names a shared folder")
        return configured.rstrip("/")
    if not local:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="onsetlab-"))
    return context.getCheckpointDir().rstrip("/")


def _without_scheme(spark: SparkSession, path: str) -> bool:
    """Whether a path names no file system and the default one is the local disk."""
    if urlparse(path).scheme:
        return False
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return default.startswith("file:")


def _shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds all that tasks write to a folder, tried once a session.

    What tasks write on a disk of their own is not there when the driver commits.
    """
    with contextlib.suppress(Exception):  # a folder that cannot be tried is not known to be shared
        tried = spark.sparkContext.applicationId, folder
        if tried not in _SHARED:
            _SHARED[tried] = _all_arrives(spark, folder)
        return _SHARED[tried]
    return False


def _all_arrives(spark: SparkSession, folder: str) -> bool:
    tasks = TRIAL_TASKS * spark.sparkContext.defaultParallelism
    path = f"{folder.rstrip('/')}/trial-{uuid.uuid4().hex}"
    numbers = spark.range(0, tasks, 1, tasks)
    try:
        numbers.write.parquet(path)
        return spark.read.schema(numbers.schema).parquet(path).count() == tasks
    finally:
        remove_folders(spark, [path])


class Stages:
    """Staged tables of one job, removed together when the job is over."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/job-{uuid.uuid4().hex}"
        self.others: list[str] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        remove_folders(self.spark, [self.root, *self.others])

    def also_remove(self, folder: str) -> None:
        """Remove a folder written by other means, too, when the job is over."""
        self.others.append(folder)

    def path(self, name: str) -> str:
        """A path of its own, whatever else has the name."""
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str, *more: Column) -> DataFrame:
        """Write ``df`` as Parquet under a path of its own and read it back.

        Its rows and bytes are counted on the way, and the aggregates ``more``,
        which need a name each; :func:`measured` tells them.
        """
        path = self.path(name)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), table_bytes(df).alias("bytes"), *more).write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        staged.measured_when_staged = seen.get
        return staged


def measured(df: DataFrame) -> dict | None:
    """``rows``, ``bytes`` and other aggregates of a frame that ``stage`` gave, itself and not a query on it."""
    return getattr(df, "measured_when_staged", None)


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders on whatever file system their paths name."""
    hadoop_conf = spark._jsc.hadoopConfiguration()
    for text in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(hadoop_conf).delete(path, True)


def session_stages(spark: SparkSession) -> Stages:
    """The one ``Stages`` of a session, for frames that are read after the call returns.

    What it holds goes when the session stops, or when the process ends.
    """
    key = spark.sparkContext.applicationId
    if key not in _OF_SESSION:
        stages = _OF_SESSION[key] = Stages(spark)
        stop = spark.stop

        def stop_clean() -> None:
            if _OF_SESSION.pop(key, None) is not None:
                stages.close()
            stop()

        spark.stop = stop_clean  # type: ignore[method-assign]
        atexit.register(_close_if_open, key)
    return _OF_SESSION[key]


def _close_if_open(key: str) -> None:
    stages = _OF_SESSION.pop(key, None)
    if stages is not None:
        with contextlib.suppress(Exception):  # the session may be gone
            stages.close()


_OF_SESSION: dict[str, Stages] = {}
_SHARED: dict[tuple[str, str], bool] = {}
