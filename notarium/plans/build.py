"""Queries around building, publishing and ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import build as op
from ..session import table
from . import base as b
from .registry import Registry
from .vocabulary import _H, _themes

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("k5_write_status", b.with_(b.C, b.M) + "select m.doc_id, case when c.doc_id is null or c.body is null then 'skipped' when c.normalized_sha256 is null then 'written' when lower(c.normalized_sha256) = sha256(c.body) then 'unchanged' else 'overwritten' end as status from m left join c on m.doc_id = c.doc_id")
def k5(spark: SparkSession, d: str) -> DataFrame:
    new = b.cleaned(spark, d).select("doc_id", F.sha2("body", 256).alias("new"), F.lower("normalized_sha256").alias("old"))
    return op.write_status(b.manifest(spark, d).select("doc_id").join(new, "doc_id", "left"), "old", "new").select("doc_id", "status")


@query("k6_index", b.with_(b.C, b.M, b.TAGS, "x as (select split_part(path, '/', 1) as folder, tag, count(*) as n from t join m on t.doc_id = m.doc_id group by 1, 2)", "y as (select folder, string_agg(tag || ':' || n, ', ' order by n desc, tag) as tags from x group by folder)", "z as (select split_part(path, '/', 1) as folder, count(*) as docs, max(modified_at) as updated from m group by 1)") + "select z.folder, docs, updated, coalesce(tags, '') as tags from z left join y on z.folder = y.folder")
def k6(spark: SparkSession, d: str) -> DataFrame:
    m = b.manifest(spark, d).select("doc_id", b.folder().alias("folder"), "modified_at")
    n = b.tags(spark, d).join(m, "doc_id").groupBy("folder", "tag").agg(F.count("*").alias("n"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "tag", "n")))  # one entry a tag of the vocabulary
    tags = n.groupBy("folder").agg(F.array_join(F.transform(order, lambda x: F.concat(x["tag"], F.lit(":"), x["n"])), ", ").alias("tags"))
    z = m.groupBy("folder").agg(F.count("*").alias("docs"), F.max("modified_at").alias("updated"))
    return z.join(tags, "folder", "left").select("folder", "docs", "updated", F.coalesce("tags", F.lit("")).alias("tags"))


@query("k10_publish", b.with_(b.M, "x as (select lower(filename) as name, count(*) as files, count(distinct size_bytes) as sizes from m group by 1)") + "select case when files = 1 then 'to_copy' when sizes = 1 then 'unchanged' else 'conflict' end as state, count(*) as names, sum(files)::bigint as files from x group by 1")
def k10(spark: SparkSession, d: str) -> DataFrame:
    x = b.manifest(spark, d).groupBy(F.lower("filename").alias("name")).agg(F.count("*").alias("files"), F.count_distinct("size_bytes").alias("sizes"))
    return x.groupBy(F.when(F.col("files") == 1, "to_copy").when(F.col("sizes") == 1, "unchanged").otherwise("conflict").alias("state")).agg(F.count("*").alias("names"), F.sum("files").alias("files"))


_SLUG = "regexp_replace(regexp_replace(lower(regexp_replace(filename, '[.][a-z]+$', '')), '[^a-z0-9]+', '-'{g}), '^-+|-+$', ''{g})"


@query("w16_suffix", b.with_(b.M, f"x as (select path, substr({_SLUG.format(g=', ' + chr(39) + 'g' + chr(39))}, 1, 12) as slug from m)") + "select path, case when rn = 1 then slug else slug || '_' || rn end as slug from (select *, row_number() over (partition by slug order by path) as rn from x)")
def w16(spark: SparkSession, d: str) -> DataFrame:
    x = b.manifest(spark, d).select("path", F.substring(F.expr(_SLUG.format(g="")), 1, 12).alias("slug"))
    return op.numbered(x, "slug", "path")


@query("j21_slug_collisions", b.with_(b.M, f"x as (select doc_id, {_SLUG.format(g=', ' + chr(39) + 'g' + chr(39))} as slug from m)", "y as (select slug, substr(slug, 1, 20) as core from x)") + "select core, count(*) as docs, count(distinct slug) as slugs from y group by core having count(distinct slug) > 1")
def j21(spark: SparkSession, d: str) -> DataFrame:
    y = b.manifest(spark, d).select(F.expr(_SLUG.format(g="")).alias("slug")).withColumn("core", F.substring("slug", 1, 20))
    return y.groupBy("core").agg(F.count("*").alias("docs"), F.count_distinct("slug").alias("slugs")).where("slugs > 1")


@query("j12_folder", b.with_(b.C, b.TAGS, _H, "n as (select t.doc_id, h.theme, count(*) as hits, min(h.i) as i from t join h on t.tag = h.tag group by 1, 2)", "p as (select doc_id, theme from (select *, row_number() over (partition by doc_id order by hits desc, i) as rn from n) where rn = 1)") + "select coalesce(v.folder, '99_Sonstiges') as folder, count(*) as docs from c left join p on c.doc_id = p.doc_id left join (values ('technik', '10_Technik'), ('arbeit', '20_Arbeit')) as v(theme, folder) on p.theme = v.theme group by 1")
def j12(spark: SparkSession, d: str) -> DataFrame:
    n = b.tags(spark, d).join(_themes(spark), "tag").groupBy("doc_id", "theme").agg(F.count("*").alias("hits"), F.min("i").alias("i"))
    best = n.groupBy("doc_id").agg(F.max_by("theme", F.struct("hits", (-F.col("i")).alias("i"))).alias("theme"))
    folders = F.broadcast(spark.createDataFrame([("technik", "10_Technik"), ("arbeit", "20_Arbeit")], "theme string, folder string"))
    x = b.cleaned(spark, d).select("doc_id").join(best, "doc_id", "left").join(folders, "theme", "left")
    return x.groupBy(F.coalesce("folder", F.lit("99_Sonstiges")).alias("folder")).agg(F.count("*").alias("docs"))


@query("j14_triage", b.with_(b.M, b.C, b.S) + "select state, count(*) as docs from (select case when m.doc_id is null then 'not in manifest' when c.doc_id is null then 'not cleaned' when s.doc_id is null then 'not structured' else 'complete' end as state from m full join c on m.doc_id = c.doc_id left join s on coalesce(m.doc_id, c.doc_id) = s.doc_id) group by state")
def j14(spark: SparkSession, d: str) -> DataFrame:
    flag = lambda df, n: df.select("doc_id", F.lit(True).alias(n))
    x = flag(b.manifest(spark, d), "m").join(flag(b.cleaned(spark, d), "c"), "doc_id", "full").join(flag(b.structured(spark, d), "s"), "doc_id", "left")
    state = F.when(F.col("m").isNull(), "not in manifest").when(F.col("c").isNull(), "not cleaned").when(F.col("s").isNull(), "not structured").otherwise("complete")
    return x.groupBy(state.alias("state")).agg(F.count("*").alias("docs"))


@query("pj14_draft_class", b.with_(b.C, b.S) + f"select c.doc_id, case when c.body is null or trim(c.body) = '' then 'empty' when {b.sql_words('c.body')} < 60 then 'stub' when s.doc_id is null then 'unparsed' when len(s.headings) = 0 then 'flat' when json_extract_string(frontmatter, '$.status') = 'stable' then 'ready' else 'draft' end as class from c left join s on c.doc_id = s.doc_id")
def p14(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).select("doc_id", F.size("headings").alias("h"))
    x = b.cleaned(spark, d).join(s, "doc_id", "left")
    kind = F.when(F.col("body").isNull() | (F.trim("body") == ""), "empty").when(b.words("body") < 60, "stub").when(F.col("h").isNull(), "unparsed").when(F.col("h") == 0, "flat").when(F.get_json_object("frontmatter", "$.status") == "stable", "ready").otherwise("draft")
    return x.select("doc_id", kind.alias("class"))


@query("d19_promotion", b.with_(b.C, b.S) + "select s.doc_id, coalesce(json_extract_string(c.frontmatter, '$.title'), s.title) as title, case when c.doc_id is null then 'create' when json_extract_string(c.frontmatter, '$.status') in ('review', 'stable') then 'replace' else 'suffix' end as action from s left join c on s.doc_id = c.doc_id")
def d19(spark: SparkSession, d: str) -> DataFrame:
    c = b.cleaned(spark, d, False).select("doc_id", F.get_json_object("frontmatter", "$.title").alias("own"), F.get_json_object("frontmatter", "$.status").alias("status"), F.lit(True).alias("there"))
    action = F.when(F.col("there").isNull(), "create").when(F.col("status").isin("review", "stable"), "replace").otherwise("suffix")
    return b.structured(spark, d).select("doc_id", "title").join(c, "doc_id", "left").select("doc_id", F.coalesce("own", "title").alias("title"), action.alias("action"))


@query("d29_chunks", b.with_(b.G, "x as (select doc_id, max(segment_index) + 1 as expected, count(distinct segment_index) as found from g group by doc_id)") + "select doc_id, expected::bigint as expected, found, case when found = 0 then 'dead-letter' when 2 * (expected - found) >= expected then 'low' else 'high' end as confidence from x")
def d29(spark: SparkSession, d: str) -> DataFrame:
    x = b.segments(spark, d).groupBy("doc_id").agg((F.max("segment_index") + 1).cast("bigint").alias("expected"), F.count_distinct("segment_index").alias("found"))
    return x.withColumn("confidence", F.when(F.col("found") == 0, "dead-letter").when(2 * (F.col("expected") - F.col("found")) >= F.col("expected"), "low").otherwise("high"))


@query("m5_ingest_report", "with i as (select distinct delivery_id, batch_no, doc_id from intake), k as (select distinct doc_id from manifest), x as (select i.*, row_number() over (partition by i.doc_id order by batch_no, delivery_id) as rn, k.doc_id is not null as known from i left join k on i.doc_id = k.doc_id) select batch_no, count(*) as deliveries, count(*) filter (where rn = 1) as first_seen, count(*) filter (where not known) as unknown from x group by batch_no")
def m5(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "intake").select("delivery_id", "batch_no", "doc_id").distinct()
    known = table(spark, d, "manifest").select("doc_id").distinct().withColumn("known", F.lit(True))
    first = i.groupBy("doc_id").agg(F.min(F.struct("batch_no", "delivery_id")).alias("f"))
    x = i.join(first, "doc_id").join(known, "doc_id", "left")
    return x.groupBy("batch_no").agg(F.count("*").alias("deliveries"), F.count_if((F.col("f.batch_no") == F.col("batch_no")) & (F.col("f.delivery_id") == F.col("delivery_id"))).alias("first_seen"), F.count_if(F.col("known").isNull()).alias("unknown"))


@query("m13_batches", b.with_(b.M, b.S, "x as (select split_part(m.path, '/', 1) as folder, m.doc_id from m left join s on m.doc_id = s.doc_id where s.doc_id is null or s.doc_type_guess is null)") + "select folder, doc_id, (row_number() over (partition by folder order by doc_id) - 1) // 10 as batch from x")
def m13(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).where("doc_type_guess is not null").select("doc_id")
    x = b.manifest(spark, d).select(b.folder().alias("folder"), "doc_id").join(s, "doc_id", "left_anti")
    return x.select("folder", "doc_id", F.floor((F.row_number().over(Window.partitionBy("folder").orderBy("doc_id")) - 1) / 10).alias("batch"))


@query("a27_majority", b.with_(b.M, b.S, "n as (select split_part(path, '/', 1) as folder, s.doc_type_guess.label as label, count(*) as n from m join s on m.doc_id = s.doc_id where s.doc_type_guess is not null group by 1, 2)") + "select folder, label, n from (select *, row_number() over (partition by folder order by n desc, label) as rn from n) where rn = 1")
def a27(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).where("doc_type_guess is not null").select("doc_id", F.col("doc_type_guess.label").alias("label"))
    n = b.manifest(spark, d).select("doc_id", b.folder().alias("folder")).join(s, "doc_id").groupBy("folder", "label").agg(F.count("*").alias("n"))
    return n.groupBy("folder").agg(F.min_by(F.struct("label", "n"), F.struct((-F.col("n")).alias("k"), "label")).alias("x")).select("folder", "x.label", "x.n")


@query("t8_titles", b.with_(b.M, b.S, "w as (select distinct split_part(m.path, '/', 1) as folder, m.doc_id, unnest(string_split(lower(s.title), ' ')) as w from m join s on m.doc_id = s.doc_id)", "n as (select folder, w, count(*) as docs from w where length(w) > 2 and not regexp_matches(w, '^[0-9]+$') group by 1, 2 having count(*) >= 2)") + "select folder, string_agg(w, ' ' order by docs desc, w) as title from (select *, row_number() over (partition by folder order by docs desc, w) as rn from n) where rn <= 3 group by folder")
def t8(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).select("doc_id", F.explode(F.split(F.lower("title"), " ")).alias("w"))
    w = b.manifest(spark, d).select("doc_id", b.folder().alias("folder")).join(s, "doc_id").distinct().where("length(w) > 2 and not w rlike '^[0-9]+$'")
    n = w.groupBy("folder", "w").agg(F.count("*").alias("docs")).where("docs >= 2")
    top = n.withColumn("rn", F.row_number().over(Window.partitionBy("folder").orderBy(F.desc("docs"), "w"))).where("rn <= 3")
    return top.groupBy("folder").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "w"))), lambda x: x["w"]), " ").alias("title"))


@query("j10_related_drop", b.with_(b.S, b.LINKS, "st as (select distinct split_part(title, ' ', 1) as stem from s where title is not null)") + "select doc_id, count(*) filter (where target in (select stem from st)) as kept, count(*) filter (where target not in (select stem from st)) as dropped from k group by doc_id")
def j10(spark: SparkSession, d: str) -> DataFrame:
    stems = b.structured(spark, d).where("title is not null").select(F.split("title", " ")[0].alias("target")).distinct().withColumn("known", F.lit(True))
    return b.links(spark, d).join(stems, "target", "left").groupBy("doc_id").agg(F.count("known").alias("kept"), F.count_if(F.col("known").isNull()).alias("dropped"))


@query("pj2_corpus_filter", b.with_(b.M, b.S) + "select reason, count(*) as docs from (select case when split_part(m.path, '/', 1) in ('inbox', '13_Archiv') then 'folder' when s.doc_type_guess.label = 'gedanke' then 'category' else 'kept' end as reason from m left join s on m.doc_id = s.doc_id) group by reason")
def p2(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).select("doc_id", F.col("doc_type_guess.label").alias("label"))
    reason = F.when(b.folder().isin("inbox", "13_Archiv"), "folder").when(F.col("label") == "gedanke", "category").otherwise("kept")
    return b.manifest(spark, d).join(s, "doc_id", "left").groupBy(reason.alias("reason")).agg(F.count("*").alias("docs"))


@query("pj6_semi", b.with_(b.M) + "select m.doc_id, m.path from m where m.doc_id in (select doc_id from intake where batch_no = 0)")
def p6(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "intake").where("batch_no = 0").select("doc_id").distinct()
    return b.manifest(spark, d).join(first, "doc_id", "left_semi").select("doc_id", "path")


@query("m14_exposure", b.with_(b.M) + "select doc_id, regexp_matches(filename, '[äöüÄÖÜß]') as umlaut, regexp_matches(filename, '[̀-ͯ]') as combining from m where regexp_matches(filename, '[^\\x00-\\x7f]')")
def m14(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).where(F.col("filename").rlike(r"[^\x00-\x7f]")).select("doc_id", F.col("filename").rlike("[äöüÄÖÜß]").alias("umlaut"), F.col("filename").rlike("[̀-ͯ]").alias("combining"))


@query("d20_rename", b.with_(b.C, b.TAGS) + "select doc_id, string_agg(distinct case when tag = 'ki' then 'index' else tag end, ',' order by case when tag = 'ki' then 'index' else tag end) as tags, bool_or(tag = 'ki') as changed from t group by doc_id")
def d20(spark: SparkSession, d: str) -> DataFrame:
    new = F.when(F.col("tag") == "ki", "index").otherwise(F.col("tag"))
    return b.tags(spark, d).groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set(new)), ",").alias("tags"), F.bool_or(F.col("tag") == "ki").alias("changed"))


@query("pj13_backfill", b.with_(b.C, b.TAGS, b.S, "x as (select s.doc_id, count(t.tag) as have, any_value(len(s.doc_type_guess.signals)) as found, count(*) filter (where list_contains(s.doc_type_guess.signals, t.tag)) as both_ from s left join t on s.doc_id = t.doc_id group by s.doc_id)") + "select doc_id, case when coalesce(found, 0) = 0 then 'skip-empty' when have = 0 then 'would-add' when both_ = found then 'unchanged' else 'would-change' end as class from x")
def p13(spark: SparkSession, d: str) -> DataFrame:
    tags = b.tags(spark, d).groupBy("doc_id").agg(F.collect_set("tag").alias("have"))
    x = b.structured(spark, d).select("doc_id", F.col("doc_type_guess.signals").alias("found")).join(tags, "doc_id", "left")
    none = F.coalesce(F.size("found"), F.lit(0)) <= 0
    kind = F.when(none, "skip-empty").when(F.col("have").isNull(), "would-add").when(F.size(F.array_intersect("found", "have")) == F.size("found"), "unchanged").otherwise("would-change")
    return x.select("doc_id", kind.alias("class"))
