"""Queries of review, chains, acronyms and smaller reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import chain, review as op
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql
_status = "json_extract_string(frontmatter, '$.status')"


@query("d7_apply_plan")
def d7(spark: SparkSession, d: str) -> DataFrame:
    """What the safe chain would change in each body."""
    return chain.plan(b.cleaned(spark, d).select("doc_id", "body"), "doc_id", "body", ["normalize", "repair", "links"])


@query("d22_review_items", b.with_(b.C, b.M, b.FI, "q as (select 'quality' as gate, m.doc_id, f.rule as current from f join m on m.path = f.relpath where f.severity = 'error' union select 'final', doc_id, coalesce(" + _status + ", '') from c where " + _status + " is null or " + _status + " = 'review' union select 'category', doc_id, '' from c where frontmatter is null)") + "select gate || '::' || doc_id || '::' || current as item, gate, doc_id, current from q")
def d22(spark: SparkSession, d: str) -> DataFrame:
    status = F.get_json_object("frontmatter", "$.status")
    c = b.cleaned(spark, d)
    m = b.manifest(spark, d).select("doc_id", F.col("path").alias("relpath"))
    quality = b.findings(spark, d).where("severity = 'error'").join(m, "relpath").select("doc_id", F.col("rule").alias("current"))
    final = c.where(status.isNull() | (status == "review")).select("doc_id", status.alias("current"))
    return op.items(("quality", quality), ("final", final), ("category", c.where("frontmatter is null").select("doc_id", F.lit("").alias("current"))))


@query("d28_enforce", b.with_(b.C, b.S, b.M) + f"select s.doc_id, nullif(trim(s.title), '') as title, 'draft' as status, 'ai_drafted' as review_status, coalesce(json_extract_string(c.frontmatter, '$.created'), strftime(m.modified_at, '%Y-%m-%d')) as created, strftime(m.modified_at, '%Y-%m-%d') as updated, case when nullif(trim(s.title), '') is null then 'low' when {_status} = 'stable' then 'high' else 'medium' end as confidence from s left join c on s.doc_id = c.doc_id left join m on s.doc_id = m.doc_id")
def d28(spark: SparkSession, d: str) -> DataFrame:
    c = b.cleaned(spark, d, False).select("doc_id", F.get_json_object("frontmatter", "$.created").alias("created"), F.get_json_object("frontmatter", "$.status").alias("st"))
    drafts = b.structured(spark, d).select("doc_id", F.nullif(F.trim("title"), F.lit("")).alias("title")).join(c, "doc_id", "left")
    drafts = drafts.withColumn("updated", F.lit(None).cast("string")).withColumn("confidence", F.when(F.col("st") == "stable", "high").otherwise("medium"))
    day = F.date_format("modified_at", "yyyy-MM-dd")
    return op.enforce(drafts, b.manifest(spark, d).select("doc_id", day.alias("created"), day.alias("updated")))


@query("f29_acronyms", b.with_(b.C, b.LINES, "x as (select doc_id, line_no, line, unnest(regexp_extract_all(line, '[A-ZÄÖÜ]{3,}')) as word from l)") + "select doc_id, word, min(line_no) as line_no from x where not contains(line, '(' || word || ')') group by doc_id, word")
def f29(spark: SparkSession, d: str) -> DataFrame:
    x = b.lines(spark, d).select("doc_id", "line_no", "line", F.explode(F.regexp_extract_all("line", F.lit("[A-ZÄÖÜ]{3,}"), F.lit(0))).alias("word"))
    return x.where(~F.contains("line", F.concat(F.lit("("), "word", F.lit(")")))).groupBy("doc_id", "word").agg(F.min("line_no").alias("line_no"))


@query("f38_confidence", b.with_(b.S) + "select doc_id, case when round(doc_type_guess.confidence, 2) >= 0.7 then 'high' when round(doc_type_guess.confidence, 2) >= 0.5 then 'medium' else 'low' end as confidence, doc_type_guess is null as fallback from s")
def f38(spark: SparkSession, d: str) -> DataFrame:
    c = F.round(F.col("doc_type_guess.confidence"), 2)
    x = b.structured(spark, d).withColumn("c", F.when(c >= 0.7, " HIGH").when(c >= 0.5, "Medium ").when(c.isNotNull(), "low"))
    return x.select("doc_id", op.confidence("c").alias("confidence"), F.col("doc_type_guess").isNull().alias("fallback"))


@query("f45_folder_names", b.with_(b.M, "x as (select distinct split_part(path, '/', 1) as folder from m)") + "select folder, trim(regexp_replace(replace(folder, '_', ' '), '^[0-9]+ ', '')) as display from x")
def f45(spark: SparkSession, d: str) -> DataFrame:
    x = b.manifest(spark, d).select(b.folder().alias("folder")).distinct()
    return x.select("folder", F.trim(F.regexp_replace(F.replace("folder", F.lit("_"), F.lit(" ")), "^[0-9]+ ", "")).alias("display"))


@query("f46_retention", b.with_(b.C, b.TAGS, b.S, "n as (select doc_id, count(*) as tags from t group by doc_id)") + "select s.doc_id, coalesce(n.tags, 0) > 2 as many_tags, length(coalesce(s.title, '')) < 12 as short_title, len(s.links) + len(s.images) > 0 as provenance from s left join n on s.doc_id = n.doc_id")
def f46(spark: SparkSession, d: str) -> DataFrame:
    n = b.tags(spark, d).groupBy("doc_id").agg(F.count("*").alias("tags"))
    return b.structured(spark, d).join(n, "doc_id", "left").select("doc_id", (F.coalesce("tags", F.lit(0)) > 2).alias("many_tags"), (F.length(F.coalesce("title", F.lit(""))) < 12).alias("short_title"), (F.size("links") + F.size("images") > 0).alias("provenance"))


@query("t7_edge_cap", b.with_(b.FI, "x as (select relpath, rule, line, row_number() over (partition by relpath order by rule, line nulls first, message, severity nulls first, fixable nulls first) as rn, count(*) over (partition by relpath) as n from f)") + "select relpath, count(*) filter (where rn <= 50) as shown, max(n) - count(*) filter (where rn <= 50) as more from x group by relpath")
def t7(spark: SparkSession, d: str) -> DataFrame:
    n = b.findings(spark, d).groupBy("relpath").agg(F.count("*").alias("n"))
    return n.select("relpath", F.least("n", F.lit(50)).cast("bigint").alias("shown"), F.greatest(F.col("n") - 50, F.lit(0)).cast("bigint").alias("more"))


@query("u2_new_stems", b.with_(b.M) + "select split_part(path, '/', 1) as folder, count(*) as new_docs from m where doc_id not in (select doc_id from intake where batch_no = 0 and doc_id is not null) group by 1")
def u2(spark: SparkSession, d: str) -> DataFrame:
    from ..session import table

    before = table(spark, d, "intake").where("batch_no = 0 and doc_id is not null").select("doc_id")
    m = b.manifest(spark, d)
    new = m.select("doc_id").subtract(before)
    return m.join(new, "doc_id", "left_semi").groupBy(b.folder().alias("folder")).agg(F.count("*").alias("new_docs"))


@query("u4_ordered_sources", b.with_(b.S, b.LINKS, "x as (select target, doc_id, min(modified_at) as seen from k left join manifest using (doc_id) group by 1, 2)") + "select target, doc_id, row_number() over (partition by target order by seen nulls last, doc_id) as place from x")
def u4(spark: SparkSession, d: str) -> DataFrame:
    """The documents that link to each target, each once, in the order in which they were first seen; one row each, so no list grows."""
    from ..operators.corpus import placed
    from ..session import table

    seen = table(spark, d, "manifest").groupBy("doc_id").agg(F.min("modified_at").alias("seen"))
    return placed(b.links(spark, d).join(seen, "doc_id", "left"), "target", [F.col("seen").asc_nulls_last(), F.col("doc_id")]).select("target", "doc_id", "place")


@query("d13_synthesis", b.with_(b.C, b.TAGS, "z as (select doc_id, string_agg(tag, ',' order by tag) as items from t group by doc_id)", "n as (select items, count(*) as n from z group by items)") + "select z.doc_id, round(40 * (n.n >= 3)::int + 30 * least(1.0, (n.n - 1) / 3.0), 4)::double as score from z join n on z.items = n.items")
def d13(spark: SparkSession, d: str) -> DataFrame:
    """Synthesis potential from notes with the same tags: membership of a group of three and overlap."""
    z = b.tags(spark, d).groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("tag")), ",").alias("items"))
    n = z.groupBy("items").agg(F.count("*").alias("n"))
    score = F.when(F.col("n") >= 3, 40.0).otherwise(0.0) + 30.0 * F.least(F.lit(1.0), (F.col("n") - 1) / 3.0)
    return z.join(n, "items").select("doc_id", F.round(score, 4).alias("score"))
