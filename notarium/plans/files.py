"""Sources and sinks over written tables: what a sink writes, its source reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, table
from ..sources import files as src
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("s3_json_lines", b.with_(b.M) + "select split_part(path, '/', 1) as folder, count(*) as docs, sum(word_count)::bigint as words, count(*) filter (where sha256 is null) as without_hash from m group by 1")
def s3(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as JSON lines, read back under its schema."""
    at = shared_folder(spark)
    src.write_json_lines(b.manifest(spark, d).select("doc_id", "path", "word_count", "sha256"), at)
    rows = src.json_lines(spark, at, "doc_id string, path string, word_count int, sha256 string").where("_corrupt is null")
    return rows.groupBy(b.folder().alias("folder")).agg(F.count("*").alias("docs"), F.sum("word_count").alias("words"), F.count_if(F.col("sha256").isNull()).alias("without_hash"))


@query("s4_json_array", "select source, target_share, max_repeats from mix_targets")
def s4(spark: SparkSession, d: str) -> DataFrame:
    """A dimension as one JSON array."""
    at = shared_folder(spark)
    t = table(spark, d, "mix_targets").select("source", "target_share", "max_repeats")
    t.agg(F.to_json(F.collect_list(F.struct(*t.columns))).alias("value")).coalesce(1).write.text(at)  # a dimension of fixed size
    return src.json_array(spark, at, "source string, target_share double, max_repeats int")


@query("s5_pruned_parquet", "select label, count(*) as vectors, min(vec_id)::bigint as first_id from embeddings group by label")
def s5(spark: SparkSession, d: str) -> DataFrame:
    """Vectors through the Parquet sink with 32-bit floats; the query reads two columns of what it wrote."""
    at = shared_folder(spark)
    src.write_vectors(table(spark, d, "embeddings"), at)
    return spark.read.parquet(at).groupBy("label").agg(F.count("*").alias("vectors"), F.min(F.col("vec_id").cast("bigint")).alias("first_id"))


@query("s9_pipe_table", "select source, max_repeats::varchar as max_repeats from mix_targets")
def s9(spark: SparkSession, d: str) -> DataFrame:
    """A dimension as a pipe table of a report, read back."""
    at = shared_folder(spark)
    row = F.concat(F.lit("| "), "source", F.lit(" | "), F.col("max_repeats").cast("string"), F.lit(" |"))
    head = spark.createDataFrame([("# Targets",), ("",), ("| source | max_repeats |",), ("|---|---|",)], "value string")
    head.unionByName(table(spark, d, "mix_targets").select(row.alias("value"))).coalesce(1).write.text(at)
    return src.pipe_table(spark, at, ["source", "max_repeats"])


@query("s12_decisions", "select 'mix' as sheet, source as item, 'keep' as decision, target_share::varchar as value from mix_targets where max_repeats > 1")
def s12(spark: SparkSession, d: str) -> DataFrame:
    """A review sheet with filled and empty decisions, parsed."""
    t = table(spark, d, "mix_targets").withColumn("k", F.xxhash64("source"))
    parts = [F.concat(F.lit("### "), "source"), F.lit(""), F.concat(F.lit("decision: "), F.when(F.col("max_repeats") > 1, "keep").otherwise("")), F.concat(F.lit("value: "), F.col("target_share").cast("string"))]
    sheet = t.select(F.col("k"), F.posexplode(F.array(*parts)).alias("i", "line"))
    return src.decisions(sheet.select(F.lit("mix").alias("sheet"), F.struct("k", "i").alias("line_no"), "line"))


@query("j20_delta", "with now as (select distinct doc_id from intake where batch_no >= 5 and doc_id is not null), before as (select distinct doc_id from intake where batch_no <= 9 and doc_id is not null), s as (select doc_id, max(word_count) as score from manifest group by doc_id) select coalesce(n.doc_id, o.doc_id) as doc_id, case when o.doc_id is null then 'added' else 'removed' end as change, coalesce(s.score, 0)::bigint as score from now n full join before o on n.doc_id = o.doc_id left join s on s.doc_id = coalesce(n.doc_id, o.doc_id) where n.doc_id is null or o.doc_id is null")
def j20(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots of scores as files, and what the later one added and removed."""
    at = shared_folder(spark)
    score = table(spark, d, "manifest").groupBy("doc_id").agg(F.max("word_count").alias("score"))
    rows = table(spark, d, "intake").where("doc_id is not null")
    for when, some in (("20250101_000000", "batch_no <= 9"), ("20250201_000000", "batch_no >= 5")):
        rows.where(some).select("doc_id").distinct().join(score, "doc_id", "left").write.json(f"{at}/{when}")
    both = src.snapshots(spark, f"{at}/*", "doc_id string, score bigint")
    last = F.lit(both.agg(F.max("snapshot_ts")).first()[0])
    seen = both.groupBy("doc_id").agg(F.bool_or(F.col("snapshot_ts") == last).alias("now"), F.bool_or(F.col("snapshot_ts") < last).alias("before"), F.max("score").alias("score"))
    return seen.where("now <> before").select("doc_id", F.when(F.col("now"), "added").otherwise("removed").alias("change"), F.coalesce("score", F.lit(0)).cast("bigint").alias("score"))


@query("k4_dead_letters", b.with_(b.M) + "select 'dead' as kind, count(*) as docs, count(distinct split_part(path, '/', 1)) as folders from m where word_count is null union all select 'kept', count(*), count(distinct split_part(path, '/', 1)) from m where word_count is not null")
def k4(spark: SparkSession, d: str) -> DataFrame:
    """Records without counts go to the dead letters, the rest goes on; both read back."""
    at = shared_folder(spark)
    kept = src.split_errors(b.manifest(spark, d).select("doc_id", "path", "word_count"), "word_count is null", at)
    dead = spark.read.schema("doc_id string, path string, word_count int").json(at)
    count = lambda df, k: df.agg(F.lit(k).alias("kind"), F.count("*").alias("docs"), F.count_distinct(b.folder()).alias("folders"))
    return count(dead, "dead").unionByName(count(kept, "kept"))


@query("k5_archive", b.with_(b.C, "a as (select doc_id, body from c where right(doc_id, 1) <> '7')", "z as (select doc_id, case when right(doc_id, 1) = '3' then coalesce(body, '') || '+' else body end as body from c where right(doc_id, 1) <> '5')") + "select case when z.doc_id is null then 'absent' when a.doc_id is null then 'new' when a.body is not distinct from z.body then 'same' else 'changed' end as state, count(*) as docs, sum(coalesce(length(case when a.doc_id is not null and z.doc_id is not null and a.body is distinct from z.body then a.body end), 0))::bigint as archived_chars from a full join z on a.doc_id = z.doc_id group by 1")
def k5(spark: SparkSession, d: str) -> DataFrame:
    """Two writes of a table of notes: what the second changed, and what the archive holds of the first."""
    at = shared_folder(spark)
    c = b.cleaned(spark, d).select("doc_id", "body")
    end = F.substring("doc_id", -1, 1)
    src.write_changed(c.where(end != "7"), at, "doc_id", "body")
    edited = c.where(end != "5").withColumn("body", F.when(end == "3", F.concat(F.coalesce("body", F.lit("")), F.lit("+"))).otherwise(F.col("body")))
    states = src.write_changed(edited, at, "doc_id", "body")
    old = spark.read.parquet(f"{at}/archive").select("doc_id", F.length("body").alias("n"))
    return states.join(old, "doc_id", "left").groupBy("state").agg(F.count("*").alias("docs"), F.sum(F.coalesce("n", F.lit(0)).cast("bigint")).alias("archived_chars"))
