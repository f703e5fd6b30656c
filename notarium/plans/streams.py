"""Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import ingest
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("stream_dedup", "select distinct delivery_id from intake")
def dedup(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries of the intake stream, those sent twice once."""
    rows = ingest.stream(spark, f"{d}/intake.parquet").select("delivery_id")
    return ingest.drain(ingest.first_of(rows, ["delivery_id"]))


@query("stream_hash_dedup", "select distinct lower(replace(sha256, 'sha256:', '')) as sha from manifest where sha256 is not null")
def hashes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct raw hashes of the manifest stream."""
    rows = ingest.stream(spark, f"{d}/manifest.parquet").where("sha256 is not null").select(F.lower(F.replace("sha256", F.lit("sha256:"), F.lit(""))).alias("sha"))
    return ingest.drain(ingest.first_of(rows, ["sha"]))


@query("stream_windows")
def windows(spark: SparkSession, d: str) -> DataFrame:
    """Events by hour and type, as far as the watermark has passed them."""
    rows = ingest.stream(spark, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = ingest.windows(rows, "ts", "1 hour", "2 hours", "event_type")
    return ingest.drain(out.select(F.col("w.start").alias("start"), "event_type", "n"))
