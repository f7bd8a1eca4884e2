"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path

#: the white space every contract names: blank, tab, line feed, vertical tab, form feed, carriage return
WHITE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage with a table that outlives any executor; ids made by
    ``monotonically_increasing_id`` before it are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so (case does not tell names apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a key of each row that is the same whenever and however the rows are read.

    The key is the row's file and its place in it, not a place in the scan,
    which depends on how many cores the cluster has at that moment.  A frame
    that is no scan of files is written first, and the copy is scanned.
    """
    key = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")).alias(name)
    try:
        return df.select("*", key)
    except AnalysisException:
        return stage_table(df, "rows").select("*", key)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of items whose sizes sum up to about ``most``; a larger item is a run of its own."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that names its store, as Spark itself would resolve it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def bind(value, body):
    """``body(value)`` with ``value`` evaluated once (a let for columns used inside a lambda)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on the cluster's machines."""
    import public_tokenizers
    return public_tokenizers.path(name)
