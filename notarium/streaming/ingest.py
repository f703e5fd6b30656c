"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def stream(spark: SparkSession, path: str, files_per_trigger: int = 4) -> DataFrame:
    """A stream over a Parquet table: a folder of files, or one file."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(str(at.getParent()))
    return reader.parquet(path)


def drain(df: DataFrame, mode: str = "append", folder: str | None = None) -> DataFrame:
    """Run a stream over all there is now into a table. With the same ``folder`` a later call goes on where the last one ended; without one all is new."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    out, state = f"{folder}/rows", f"{folder}/state"
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", state).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def first_of(df: DataFrame, keys: list[str], time_col: str | None = None, within: str | None = None) -> DataFrame:
    """The first row of each key that the stream sees; later ones are duplicates.

    All keys are remembered; with a time column only those of the last ``within``, so the state is bounded.
    """
    return df.withWatermark(time_col, within).dropDuplicatesWithinWatermark(keys) if time_col else df.dropDuplicates(keys)


def windows(df: DataFrame, time_col: str, length: str, late: str, *keys: str) -> DataFrame:
    """Counts by tumbling window; rows later than ``late`` behind the newest are dropped."""
    return df.withWatermark(time_col, late).groupBy(F.window(time_col, length).alias("w"), *keys).agg(F.count("*").alias("n"))


def upsert_batches(df: DataFrame, key: str, order: str, target: str) -> None:
    """Keep the newest row of each key in a table, batch by batch; a batch that runs again gives the same table."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = f"{target}/v{number - 1}"
        rows = batch if number == 0 else batch.unionByName(spark.read.schema(batch.schema).parquet(old))
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.struct(F.col(order).isNotNull(), order)).alias("x")).select("x.*")
        newest.write.mode("overwrite").parquet(f"{target}/v{number}")

    df.writeStream.foreachBatch(merge).option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start().awaitTermination()
