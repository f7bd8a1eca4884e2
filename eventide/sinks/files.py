"""K-1 .. K-5: file-backed sinks.

* ``write_topic``      K-1: append a log partitioned by topic (Parquet, codec option).
* ``upsert``           K-2: keyed changes appended as Parquet deltas; the
                       table is their latest row per key.
* ``write_archive``    K-3: hourly UTC partitions, capped records per file.
* ``fan_out``          K-4: one evaluated frame written to several sinks.

All paths live under the shared ``spark.checkpoint.dir`` (or a path given
by the caller), never on a machine-local folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.operators.tables import compact_latest
from eventide.operators.transforms import archive_partition_columns

ARCHIVE_COLS = ["year", "month", "day", "hour"]


def write_topic(log: DataFrame, path: str, codec: str = "lz4", mode: str = "append") -> None:
    """K-1: file-backed topic sink (keyed rows with explicit partition ids, and their headers if they have any)."""
    codec = {"lz4": "lz4_raw"}.get(codec, codec)
    (log.select(*S.LOG_FIELDS, *[c for c in log.columns if c == "headers"]).write.mode(mode).option("compression", codec)
        .partitionBy("topic").parquet(path))


# K-2 -----------------------------------------------------------------------------
def upsert(batch: DataFrame, path: str, version: int) -> None:
    """K-2: append a batch of keyed rows, deletes among them, as one Parquet delta.

    A delta is a folder ``delta_no=N``; a replayed batch replaces its own.
    Nothing that is there is read or rewritten, whatever keys a batch has.
    """
    batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/delta_no={version}")


def read_upserted(spark: SparkSession, path: str, keys: list[str], order: list[str], tombstone: Column | None = None,
                  until: int | None = None) -> DataFrame:
    """The table that the deltas give: the latest row per key by ``order``, then by delta (A-4, combined on the mappers).

    Delete rows stay in their deltas, so an older row that comes after one does
    not bring its key back.  ``until``: the table as of that delta.
    """
    deltas = spark.read.parquet(path)
    if until is not None:
        deltas = deltas.filter(F.col("delta_no") <= until)  # prunes the folders
    return compact_latest(deltas, keys, [*order, "delta_no"], tombstone).drop("delta_no")


def merge_deltas(spark: SparkSession, path: str, merged: str, keys: list[str], order: list[str]) -> None:
    """Write the deltas of ``path`` as one, with the latest row of every key, deletes too.

    The new table takes further deltas under higher versions than those merged.
    """
    deltas = spark.read.parquet(path)
    last = max(int(f.rsplit("/delta_no=", 1)[1].split("/", 1)[0]) for f in deltas.inputFiles())
    upsert(compact_latest(deltas, keys, [*order, "delta_no"]).drop("delta_no"), merged, last)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path`` (a damaged table is there, and raises when read)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# Small per-version snapshots (bounded state: high-water marks)
def snapshot_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v={version:08d}"


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    df.write.mode("overwrite").parquet(snapshot_path(path, version))


def read_snapshot(spark: SparkSession, path: str, version: int) -> DataFrame | None:
    path = snapshot_path(path, version)
    return spark.read.parquet(path) if exists(spark, path) else None


# K-3 -----------------------------------------------------------------------------
def write_archive(df: DataFrame, path: str, ts: str, max_records_per_file: int | None = None,
                  codec: str = S.ARCHIVE_CODEC, mode: str = "append") -> None:
    """K-3: Parquet partitioned by year/month/day/hour of ``ts`` (UTC wall time).

    Rows are range-partitioned on (hour columns, ts) first: each task writes
    a contiguous time slice (few files per hour), and a hot hour is cut into
    several tasks by the sampled range bounds instead of landing on one.
    Files are as large as a task's slice of an hour;
    ``max_records_per_file`` (``schemas.ARCHIVE_FLUSH_RECORDS``) cuts them smaller.
    """
    parted = archive_partition_columns(df, ts).drop("archive_path")
    laid = parted.repartitionByRange(*ARCHIVE_COLS, ts)
    writer = laid.write.mode(mode).option("compression", codec)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(*ARCHIVE_COLS).parquet(path)


def read_archive(spark: SparkSession, path: str, day_from: str | None = None, day_to: str | None = None) -> DataFrame:
    """Read the archive; day bounds (``YYYY-MM-DD``, both included) prune partitions.
    Folder names are read as numbers, so days are compared as dates."""
    df = spark.read.option("basePath", path).parquet(path)
    day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    if day_from:
        df = df.filter(day >= F.lit(day_from).cast("date"))
    if day_to:
        df = df.filter(day <= F.lit(day_to).cast("date"))
    return df


def expire_archive(spark: SparkSession, path: str, before: dt.datetime) -> list[str]:
    """F-4 on files: delete the hours of an archive that end at or before ``before`` (UTC); the folders deleted.

    An hour's folder says when it is, so no data file is opened, neither of
    what goes nor of what stays.  The listing is one name per hour.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{c}=*" for c in ARCHIVE_COLS))) or []:
        folder = status.getPath()
        parts = dict(x.split("=", 1) for x in folder.toString().rsplit("/", len(ARCHIVE_COLS))[1:])
        if not all(v.isdigit() for v in parts.values()):
            continue  # rows without time have no age
        start = dt.datetime(*(int(parts[c]) for c in ARCHIVE_COLS))
        if start + dt.timedelta(hours=1) <= before:
            fs.delete(folder, True)
            gone.append(folder.toString())
    return gone


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether any hour of an archive is left."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{c}=*" for c in ARCHIVE_COLS) + "/*.parquet")))


# K-4 -----------------------------------------------------------------------------
def fan_out(df: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, int]:
    """K-4: evaluate ``df`` once (persisted) and hand it to every sink.
    A sink writes the frame and returns what it stored, read back; the result
    is the number of rows each one holds, so that a sink that loses rows shows."""
    cached, taken = df.persist(), {}
    try:
        for name, write in sinks.items():
            taken[name] = write(cached).count()
        return taken
    finally:
        cached.unpersist()


# K-5 -----------------------------------------------------------------------------
def codec_sizes(df: DataFrame, base: str, codecs: tuple[str, ...] = ("none", "lz4_raw", "snappy", "zstd")) -> DataFrame:
    """K-5: write ``df`` once per codec and report files and bytes per codec
    (sizes come from the file source's ``_metadata`` column, no driver listing)."""
    spark = df.sparkSession
    out = None
    for codec in codecs:
        path = f"{base.rstrip('/')}/codec={codec}"
        df.write.mode("overwrite").option("compression", codec).parquet(path)
        files = (spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
                 .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
                 .withColumn("codec", F.lit(codec)))
        out = files if out is None else out.unionByName(files)
    return out.select("codec", "files", "bytes")


def codec_roundtrip(df: DataFrame, base: str, codecs: tuple[str, ...] = ("none", "lz4_raw", "snappy", "zstd")) -> DataFrame:
    """K-5: rows and value characters read back from each codec's files."""
    out = None
    for codec in codecs:
        path = f"{base.rstrip('/')}/codec={codec}"
        df.write.mode("overwrite").option("compression", codec).parquet(path)
        own = df.sparkSession.read.schema(df.schema).parquet(path).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.length("value")).cast("long").alias("value_chars")).withColumn("codec", F.lit(codec))
        out = own if out is None else out.unionByName(own)
    return out.select("codec", "rows", "value_chars")


# K-6 -----------------------------------------------------------------------------
def console_tail(df: DataFrame, n: int = 20) -> None:
    """K-6: print the first rows (batch) - the console view of a topic."""
    df.show(n, truncate=False)


# K-1 on a real broker --------------------------------------------------------------
def write_kafka(log: DataFrame, servers: str, topic: str | None = None, stream: bool = False,
                checkpoint: str | None = None):
    """K-1 on Kafka (needs the Kafka package): key, value, partition and
    optional headers columns are taken as they are."""
    cols = [c for c in ["topic", "key", "value", "partition", "headers"] if c in log.columns]
    out = log.select(*cols)
    if stream:
        w = out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        if topic:
            w = w.option("topic", topic)
        return w.option("checkpointLocation", checkpoint).start()
    w = out.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        w = w.option("topic", topic)
    w.save()
    return None
