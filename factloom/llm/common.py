"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of text in one Arrow batch: bound a Python worker's memory whatever the length of the texts. A longer text is a batch of its own.
TEXT_BATCH_ROWS, TEXT_BATCH_BYTES = 256, 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a local master, where all share one disk, may go without."""
    conf = spark.sparkContext.getConf()
    if folder := conf.get("spark.checkpoint.dir"):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{_local_folder()}"


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="spark-"))
    return _LOCAL[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: lineage ends there, and a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """df with a broadcast hint if a count shows at most most_rows rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= most_rows else df


def text_batches(spark: SparkSession) -> None:
    """Bounds the rows and bytes of an Arrow batch in this session, from before texts go to Python; a smaller setting of the user's stays."""
    for key, most in (("maxRecordsPerBatch", TEXT_BATCH_ROWS), ("maxBytesPerBatch", TEXT_BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the Python worker, which lives on, gives the memory back that its tables took."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
