"""Helpers that the corpus operators share: the shared folder, written intermediate tables, null-safe text."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; bytes.split() without arguments splits on exactly these.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local session (as in tests) gets a new local one,
    which is set from then on; any other master is an error, as its executors would not share a local folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            path = found.get()
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            path = tempfile.mkdtemp(prefix="orrery-")
            spark.sparkContext.setCheckpointDir(path)
        else:
            raise ValueError("spark.checkpoint.dir names no shared folder")
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, and leaves later joins
    with plain exchanges that adaptive execution can split when a key is hot."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    df = df.withColumns({c: df[c].cast("string") for c, kind in df.dtypes if kind == "void"})
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_at = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables that materialise() returned, once nothing reads them any more."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Rows and bytes that a Python worker gets at a time.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on this session's Python workers get whole texts in batches of 1,000 rows (fewer, if it says so
    already) or 8 MiB at most. A batch lies in a worker as Arrow, as objects and as results, and its memory stays with the worker."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: A table of a few numbers a row is broadcast up to so many rows (some 40 bytes each).
MOST_BESIDE = 2_000_000


def beside(written: DataFrame, most: int = MOST_BESIDE) -> DataFrame:
    """A written narrow table as the smaller side of a join: broadcast if it has at most ``most`` rows, else merged."""
    return F.broadcast(written) if written.count() <= most else written.hint("merge")


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


#: Bytes of a text that are split into words at a time.
WINDOW = 1 << 22


def space_cuts(raw: bytes, window: int = WINDOW) -> Iterator[bytes]:
    """A text in pieces of about ``window`` bytes, cut at spaces: what a very long text holds in memory as words is bounded."""
    if len(raw) <= window:
        yield raw
        return
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + window)
        stop = len(raw) if stop < 0 else stop
        yield raw[start:stop]
        start = stop


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")
