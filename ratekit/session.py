"""Session construction and lineage cutting.

The cluster names its shared checkpoint folder in ``spark.checkpoint.dir``;
we read it from the session and only fall back to a fresh local folder when
it is unset *and* the session runs in local mode (tests, laptops).
"""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark import SparkContext, StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "ratekit",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators are tuned for.

    * AQE on: partition coalescing, skew-join splitting and runtime
      broadcast conversion (the latter is itself a checked size bound,
      ``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    * ``shuffle_partitions`` should be sized for the cluster (a few
      thousand at 100 TB); AQE coalesces small ones at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    Taken from the running context or ``spark.checkpoint.dir``. Only a session
    whose driver is its only executor gets a fresh temporary folder when
    neither is set (tests, laptops); any cluster without a folder fails.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):  # local-cluster has separate executors
            raise RuntimeError(
                "spark.checkpoint.dir is unset; name a shared folder for this cluster"
            )
        d = tempfile.mkdtemp(prefix="ratekit-ckpt-")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used for expensive intermediates that are read more than once (the
    similarity table): losing an executor afterwards re-reads the
    checkpoint instead of re-running the quadratic self-join.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# The scratch folder of each running context.
_SCRATCH: weakref.WeakKeyDictionary[SparkContext, str] = weakref.WeakKeyDictionary()
_CACHED: weakref.WeakKeyDictionary[SparkSession, list[DataFrame]] = weakref.WeakKeyDictionary()


@dataclass
class Kept:
    """What one result keeps: cached frames and stored tables."""

    spark: SparkSession
    frames: list[DataFrame] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Drops them, and nothing that other results keep.

        Spark keeps one copy of equal plans: a frame stays until the last result that persisted it is released.
        """
        known = _CACHED.get(self.spark, [])
        for df in self.frames:
            at = next((k for k, x in enumerate(known) if x is df), None)
            if at is not None:
                del known[at]
            if not any(x is df or x.sameSemantics(df) for x in known):
                df.unpersist(blocking=False)
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.frames, self.tables = [], []


_KEEPER: ContextVar[Kept | None] = ContextVar("ratekit_keeper", default=None)


@contextmanager
def keeping(spark: SparkSession) -> Iterator[Kept]:
    """Everything that is persisted or stored within belongs to the yielded :class:`Kept`."""
    kept = Kept(spark)
    token = _KEEPER.set(kept)
    try:
        yield kept
    finally:
        _KEEPER.reset(token)


def persist_tracked(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """``persist`` that remembers the frame, so that its result's :class:`Kept` or
    :func:`release_cached` can drop it.

    MEMORY_AND_DISK: blocks lost with an executor are recomputed from lineage.
    """
    out = df.persist(level)
    _CACHED.setdefault(df.sparkSession, []).append(out)
    keeper = _KEEPER.get()
    if keeper is not None:
        keeper.frames.append(out)
    return out


def keep_table(spark: SparkSession, name: str) -> None:
    """The stored table ``name`` goes with the result that is being made."""
    keeper = _KEEPER.get()
    if keeper is not None:
        keeper.tables.append(name)


def release_cached(spark: SparkSession) -> int:
    """Unpersist every frame the operators persisted in this session, whatever result uses it."""
    frames = _CACHED.pop(spark, [])
    for df in frames:
        df.unpersist(blocking=False)
    return len(frames)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables.

    All of a session's tables lie under one folder, which the file system removes
    when the session's JVM ends.
    """
    top = _SCRATCH.get(spark.sparkContext)
    if top is None:
        top = f"{checkpoint_dir(spark)}/ratekit-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH[spark.sparkContext] = top
    return f"{top}/{name}-{uuid.uuid4().hex}"
