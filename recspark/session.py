"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: reused
intermediates are written (``materialize``) into the shared folder named by
``spark.checkpoint.dir`` (read from the session), which also cuts their lineage.
Only local runs (tests, the local bench) create one when it is missing; on a cluster
a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # small local inputs: keep several post-shuffle tasks for CPU-heavy stages
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recspark", driver_memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a local one only when unset
    (tests / local mode)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                           "distributed file system); a machine-local folder is not safe here")
    local = tempfile.mkdtemp(prefix="recspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


#: Whether the shuffle files of an action go when it ends (else when the driver's garbage collection finds its plan unused).
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing = threading.Lock()
_released: dict[int, list] = {}      # session -> [writes under way, its own setting]


@contextmanager
def release_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as each of them ends, not at the end of the session."""
    with _releasing:
        under_way = _released.setdefault(id(spark), [0, None])
        if under_way[0] == 0:
            under_way[1] = spark.conf.get(SHUFFLES_GO, None)
            spark.conf.set(SHUFFLES_GO, "true")
        under_way[0] += 1
    try:
        yield
    finally:
        with _releasing:
            under_way[0] -= 1
            if under_way[0] == 0:
                spark.conf.unset(SHUFFLES_GO) if under_way[1] is None else spark.conf.set(SHUFFLES_GO, under_way[1])


def write_lean(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a table on little disk: zstd files, and the shuffles of the write go with its end."""
    with release_shuffles(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)


_scopes = threading.local()


@contextmanager
def scratch() -> Iterator[None]:
    """What ``materialize`` writes inside (in this thread) is lean and goes when the block ends: for builds
    whose result is itself written there."""
    outer, _scopes.frames = getattr(_scopes, "frames", None), []
    try:
        yield
    finally:
        for df in _scopes.frames:
            discard(df)
        _scopes.frames = outer


def materialize(df: DataFrame, name: str = "tmp", lean: bool = False) -> DataFrame:
    """Write an intermediate that is read more than once as Parquet into the shared
    checkpoint folder and read it back.  It is computed once (Spark does not always
    reuse an exchange across different branches), later reads prune columns, and the
    lineage is cut, so a lost executor does not re-run the upstream plan.  ``lean`` as in
    :func:`write_lean`."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/recspark-{name}-{uuid.uuid4().hex}"
    inside = getattr(_scopes, "frames", None)
    if lean or inside is not None:
        write_lean(df, path)
    else:
        df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.written_to = path
    if inside is not None:
        inside.append(out)
    return out


def discard(df: DataFrame | None) -> None:
    """Remove the files of a frame that ``materialize`` returned, once nothing reads them any more."""
    path = None if df is None else df.__dict__.get("written_to")
    if path:
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
