"""SparkSession helpers.

On a cluster the session is built by the platform; ``get_session`` only
fills settings that are unset (local runs and tests).  Scratch and
checkpoint locations always come from ``spark.checkpoint.dir`` so that
lineage cuts land on the shared file system the cluster names.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings we rely on; applied only where the session leaves them unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # each micro-batch commits only its state changes, not a full snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "eventide",
                shuffle_partitions: int | None = None,
                checkpoint_dir: str | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active, checkpoint_dir)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return ``spark.checkpoint.dir``; set it from ``fallback`` only when unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        _set_context_checkpoint_dir(spark, current, only_if_unset=True)
        return current
    path = fallback or os.environ.get("EVENTIDE_CHECKPOINT_DIR")
    if not path:
        # A machine-local folder is acceptable only for a local master; a
        # cluster must name its shared folder.
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder on the cluster's shared "
                               "file system (checkpoints, stream state and scratch tables go there)")
        path = tempfile.mkdtemp(prefix="eventide-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    _set_context_checkpoint_dir(spark, path)
    return path


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.conf.get("spark.master", "") or ""
    except Exception:  # noqa: BLE001 - sessions that do not expose the master
        master = ""
    return master.startswith("local")


def _set_context_checkpoint_dir(spark: SparkSession, path: str, only_if_unset: bool = False) -> None:
    """RDD checkpoint dir for ``DataFrame.checkpoint`` (classic sessions only)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return
    if only_if_unset and sc.getCheckpointDir() is not None:
        return
    sc.setCheckpointDir(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: settings under which a large scratch table is made: small files, and the files of a write's
#: shuffles go when it ends, not when the driver happens to collect its garbage
_LEAN = {"spark.sql.parquet.compression.codec": "zstd", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def lean_scratch(spark: SparkSession):
    """Tables written inside take little disk, and leave no shuffle files behind."""
    before = {k: spark.conf.get(k, None) for k in _LEAN}
    for k, v in _LEAN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop_scratch(*frames: DataFrame) -> None:
    """Delete the folders of ``scratch_path`` that ``frames`` read and no later step does; other files are left alone."""
    for df in frames:
        spark = df.sparkSession
        base = re.escape(_path(ensure_checkpoint_dir(spark).rstrip("/")))
        folders = {m.group() for f in df.inputFiles() if (m := re.match(rf"{base}/[^/]+-[0-9a-f]{{12}}(?=/)", _path(f)))}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/" + folder.rsplit("/", 1)[1])
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _path(uri: str) -> str:
    """The path of a file without its store's name."""
    return re.sub(r"^[\w+.-]+:(//[^/]*)?(?=/)", "", uri)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
