"""Tables that a job writes for itself, where a plan reads them more than once or a loop would let its lineage grow."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local master, whose tasks all see this machine's disk, may go without."""
    if folder := spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="spark-"))
    return f"file://{_LOCAL[0]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: read again, never computed again, also when executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt_by(df: DataFrame, key: str) -> DataFrame:
    """df shuffled by the key into as many partitions as the session's shuffles have."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def written_by(df: DataFrame, name: str, key: str, lying: bool = False) -> DataFrame:
    """df as a table in the shared folder, its rows bucketed by the key: what is joined or grouped by that key, alone or among others, is not shuffled again. As many buckets as the session's shuffles have partitions. lying: whether df's rows lie by the key already, as those of such tables and of
    dealt_by do; they are then not shuffled either."""
    spark, table = df.sparkSession, f"{name}-{uuid.uuid4().hex}".replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df if lying else dealt_by(df, key)).write.bucketBy(n, key).option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)
