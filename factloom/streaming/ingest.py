"""Filings and mapping revisions that arrive as files, taken up batch by batch; a batch that comes twice changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.audits import catalog_filings, severity_gate
from factloom.operators.ledger import current_heads

FIELDS = ("cik", "form", "filing_date")


def replace_snapshot(rows: DataFrame, path: str, issues: DataFrame | None = None) -> None:
    """Writes the rows of whole filings in place of what is stored of them; other filings stay. A filing with a fatal issue is left out. Filings are dealt to a fixed number of
    folders by their accession's hash, and only folders that hold an arriving filing are written anew."""
    spark, rows = rows.sparkSession, rows if issues is None else severity_gate(rows, issues)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("accession"), F.lit(64)).cast("int"))
    try:
        stored = spark.read.parquet(path)
    except Exception as e:  # nothing stored yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows.write.partitionBy("bucket").parquet(path)
        return
    touched = rows.select("bucket").distinct()
    stay = stored.join(F.broadcast(touched), "bucket", "left_semi").join(rows.select("accession").distinct(), "accession", "left_anti")  # touched: 64 rows at most
    whole = stay.select(*rows.columns).unionByName(rows)
    fresh = f"{path.rstrip('/')}-next"
    whole.write.mode("overwrite").partitionBy("bucket").parquet(fresh)
    spark.read.parquet(fresh).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def stream_ingest(spark: SparkSession, source: str, schema: str, catalogue: str, snapshots: str, checkpoint: str) -> StreamingQuery:
    """Files of rows (accession, cik, form, filing_date and facts) become a catalogue of filings, to which only new ones are added, and their snapshots. A filing that conflicts with the
    catalogue in a field keeps its old rows."""

    def take(batch: DataFrame, number: int) -> None:
        filings = batch.groupBy("accession").agg(*[F.min(c).alias(c) for c in FIELDS])
        try:
            known = spark.read.parquet(catalogue)
        except Exception as e:  # no catalogue yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = filings.limit(0)
        outcome = catalog_filings(known, filings, list(FIELDS)).persist()
        fits = outcome.where("outcome <> 'conflict'").select("accession")
        replace_snapshot(batch.join(fits, "accession", "left_semi"), snapshots)
        filings.join(outcome.where("outcome = 'new'").select("accession"), "accession", "left_semi").write.mode("append").parquet(catalogue)
        outcome.unpersist()

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_ledger(spark: SparkSession, source: str, schema: str, log: str, heads: str, checkpoint: str) -> StreamingQuery:
    """Files of revisions are appended to a log, each id once, and the current heads are kept beside it."""

    def take(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(["id"])
        try:
            fresh = fresh.join(spark.read.parquet(log).select("id"), "id", "left_anti")
        except Exception as e:  # no log yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.select(*batch.columns).write.mode("append").parquet(log)
        current_heads(spark.read.parquet(log)).write.mode("overwrite").parquet(heads)

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
