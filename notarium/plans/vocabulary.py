"""Queries with tags, vocabularies, links and frontmatter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph, vocabulary as op
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql

KNOWN = ["planung", "workflow", "design", "backup", "schreiben", "datenbank", "markdown", "netzwerk", "lernen", "python", "kuenstliche-intelligenz", "kommandozeile"]
SYNONYMS = [("ki", "kuenstliche-intelligenz"), ("shell", "kommandozeile"), ("regex", "python"), ("notizen", None)]
THEMES = [("technik", "datenbank"), ("technik", "netzwerk"), ("technik", "python"), ("technik", "shell"), ("technik", "git"), ("technik", "regex"), ("arbeit", "planung"), ("arbeit", "workflow"), ("arbeit", "backup"), ("text", "schreiben"), ("text", "markdown"), ("text", "notizen")]
_V = "v as (select * from (values " + ", ".join(f"('{t}')" for t in KNOWN) + ") as x(tag))"
_Y = "y as (select * from (values " + ", ".join(f"('{a}', {repr(c) if c else 'null'})" for a, c in SYNONYMS) + ") as x(tag, canonical))"
_H = "h as (select * from (values " + ", ".join(f"({i}, '{a}', '{t}')" for i, (a, t) in enumerate(THEMES)) + ") as x(i, theme, tag))"
_R = "r as (select t.doc_id, t.tag, case when v.tag is not null then t.tag else y.canonical end as canonical, case when v.tag is not null then 'identity' when y.tag is not null and y.canonical is null then 'dropped' when y.tag is not null then 'synonym' else 'unknown' end as status from t left join v on t.tag = v.tag left join y on t.tag = y.tag)"


def _dims(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([(t,) for t in KNOWN], "tag string"), spark.createDataFrame(SYNONYMS, "tag string, canonical string")


def _themes(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(THEMES)], "i int, theme string, tag string"))


@query("j13_tag_resolve", b.with_(b.C, b.TAGS, _V, _Y, _R) + "select * from r")
def j13(spark: SparkSession, d: str) -> DataFrame:
    return op.resolve(b.tags(spark, d), *_dims(spark))


@query("d18_tag_check", b.with_(b.C, b.TAGS, _V, _Y, _R) + "select doc_id, count(distinct canonical) as tags, count(*) filter (where status = 'unknown') as unknown, case when count(*) filter (where status = 'unknown') > 0 then 'low' else 'high' end as confidence from r group by doc_id")
def d18(spark: SparkSession, d: str) -> DataFrame:
    r = op.resolve(b.tags(spark, d), *_dims(spark))
    unknown = F.count_if(F.col("status") == "unknown")
    return r.groupBy("doc_id").agg(F.count_distinct("canonical").alias("tags"), unknown.alias("unknown"), F.when(unknown > 0, "low").otherwise("high").alias("confidence"))


@query("m12_tag_map", b.with_(b.C, b.TAGS, _V, _Y, _R, "q as (select doc_id, string_agg(tag, ',' order by tag) as before, coalesce(string_agg(distinct coalesce(canonical, case when status = 'unknown' then tag end), ',' order by coalesce(canonical, case when status = 'unknown' then tag end)), '') as after from r group by doc_id)") + "select doc_id, before, after, before <> after as changed from q")
def m12(spark: SparkSession, d: str) -> DataFrame:
    r = op.resolve(b.tags(spark, d), *_dims(spark)).withColumn("new", F.coalesce("canonical", F.when(F.col("status") == "unknown", F.col("tag"))))
    q = r.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list("tag")), ",").alias("before"), F.array_join(F.sort_array(F.collect_set("new")), ",").alias("after"))
    return q.withColumn("changed", F.col("before") != F.col("after"))


@query("j22_tag_drift", b.with_(b.C, b.TAGS, _V) + "select tag, count(*) as docs from t where tag not in (select tag from v) group by tag")
def j22(spark: SparkSession, d: str) -> DataFrame:
    return b.tags(spark, d).join(op.small(_dims(spark)[0]), "tag", "left_anti").groupBy("tag").agg(F.count("*").alias("docs"))


@query("m4_drift_report", b.with_(b.C, b.TAGS, _V, "n as (select tag, count(*) as docs from t group by tag)") + "select coalesce(n.tag, v.tag) as tag, coalesce(docs, 0) as docs, case when v.tag is null then 'not in vocabulary' when n.tag is null then 'not used' else 'ok' end as state from n full join v on n.tag = v.tag")
def m4(spark: SparkSession, d: str) -> DataFrame:
    n = b.tags(spark, d).groupBy("tag").agg(F.count("*").alias("docs"))
    v = _dims(spark)[0].withColumn("known", F.lit(True))
    state = F.when(F.col("known").isNull(), "not in vocabulary").when(F.col("docs").isNull(), "not used").otherwise("ok")
    return n.join(v, "tag", "full").select("tag", F.coalesce("docs", F.lit(0)).alias("docs"), state.alias("state"))


@query("a4_tag_top30", b.with_(b.C, b.TAGS) + "select tag, count(*) as docs from t group by tag order by docs desc, tag limit 30")
def a4(spark: SparkSession, d: str) -> DataFrame:
    return b.tags(spark, d).groupBy("tag").agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "tag").limit(30)


@query("a5_tag_top5_folder", b.with_(b.C, b.M, b.TAGS, "n as (select split_part(path, '/', 1) as folder, tag, count(*) as n from t join m on t.doc_id = m.doc_id group by 1, 2)") + "select folder, tag, n from (select *, row_number() over (partition by folder order by n desc, tag) as rn from n) where rn <= 5")
def a5(spark: SparkSession, d: str) -> DataFrame:
    m = b.manifest(spark, d).select("doc_id", b.folder().alias("folder"))
    return op.top_in_group(b.tags(spark, d).join(m, "doc_id"), "folder", "tag", 5)


@query("a19_tag_inventory", b.with_(b.C, b.M, b.TAGS, "tok as (select 'A' as section, tag as token, doc_id from t union select 'B', w, doc_id from (select doc_id, unnest(string_split_regex(lower(filename), '[ _.-]+')) as w from m) union select 'C', w, doc_id from (select doc_id, unnest(string_split_regex(lower(json_extract_string(frontmatter, '$.title')), '[ _/|-]+')) as w from c))", "n as (select section, token, count(distinct doc_id) as files from tok where length(token) between 2 and 40 and not regexp_matches(token, '^[0-9]+$') group by 1, 2)", "a as (select * from n where section = 'A' and files >= 2)", "bb as (select * from n where section = 'B' and files >= 8 and token not in (select token from a))", "cc as (select * from n where section = 'C' and files >= 3 and token not in (select token from a) and token not in (select token from bb))") + "select * from a union all select * from bb union all select * from cc")
def a19(spark: SparkSession, d: str) -> DataFrame:
    c = b.cleaned(spark, d)
    tok = b.tags(spark, d).select(F.lit("A").alias("section"), F.col("tag").alias("token"), "doc_id")
    tok = tok.unionByName(b.manifest(spark, d).select(F.lit("B").alias("section"), F.explode(F.split(F.lower("filename"), "[ _.-]+")).alias("token"), "doc_id"))
    tok = tok.unionByName(c.select(F.lit("C").alias("section"), F.explode(F.split(F.lower(F.get_json_object("frontmatter", "$.title")), "[ _/|-]+")).alias("token"), "doc_id"))
    n = tok.where("length(token) between 2 and 40 and not token rlike '^[0-9]+$'").groupBy("section", "token").agg(F.count_distinct("doc_id").alias("files"))
    pick = lambda s, k: n.where((F.col("section") == s) & (F.col("files") >= k))
    first = pick("A", 2)
    second = pick("B", 8).join(first.select("token"), "token", "left_anti")
    third = pick("C", 3).join(first.select("token").unionByName(second.select("token")), "token", "left_anti")
    cols = ["section", "token", "files"]
    return first.select(cols).unionByName(second.select(cols)).unionByName(third.select(cols))


@query("a20_theme_clusters", b.with_(b.C, b.TAGS, _H, "x as (select distinct tag from t)", "q as (select x.tag, coalesce((select theme from h where h.tag = x.tag order by i limit 1), 'Sonstiges') as theme from x)") + "select theme, count(*) as tags, string_agg(tag, ',' order by tag) as members from q group by theme")
def a20(spark: SparkSession, d: str) -> DataFrame:
    x = b.tags(spark, d).select("tag").distinct()
    hint = _themes(spark).groupBy("tag").agg(F.min_by("theme", "i").alias("theme"))
    return x.join(F.broadcast(hint), "tag", "left").groupBy(F.coalesce("theme", F.lit("Sonstiges")).alias("theme")).agg(F.count("*").alias("tags"), F.array_join(F.sort_array(F.collect_set("tag")), ",").alias("members"))


@query("a25_domain", b.with_(b.C, b.TAGS, _H, "n as (select t.doc_id, h.theme, count(*) as hits, min(h.i) as i from t join h on t.tag = h.tag group by 1, 2)", "p as (select doc_id, theme from (select *, row_number() over (partition by doc_id order by hits desc, i) as rn from n) where rn = 1)") + "select c.doc_id, coalesce(p.theme, 'unklar') as domain from c left join p on c.doc_id = p.doc_id")
def a25(spark: SparkSession, d: str) -> DataFrame:
    n = b.tags(spark, d).join(_themes(spark), "tag").groupBy("doc_id", "theme").agg(F.count("*").alias("hits"), F.min("i").alias("i"))
    best = n.groupBy("doc_id").agg(F.max_by("theme", F.struct("hits", (-F.col("i")).alias("i"))).alias("theme"))
    return b.cleaned(spark, d).select("doc_id").join(best, "doc_id", "left").select("doc_id", F.coalesce("theme", F.lit("unklar")).alias("domain"))


_NT = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(lower(trim(x)), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[_ ]+', '-', 'g'), '[^a-z0-9-]+', '', 'g'), '-{2,}', '-', 'g'), '^-+|-+$', '', 'g')"


@query("f34_tag_transform", b.with_(b.C) + f"select doc_id, {_NT} as slug from (select doc_id, json_extract_string(frontmatter, '$.title') as x from c) where x is not null")
def f34(spark: SparkSession, d: str) -> DataFrame:
    x = b.cleaned(spark, d, False).select("doc_id", F.get_json_object("frontmatter", "$.title").alias("x")).where("x is not null")
    return x.select("doc_id", op.normal_tag("x").alias("slug"))


@query("j16_shared_tags", b.with_(b.C, b.TAGS, "z as (select doc_id, string_agg(tag, ',' order by tag) as items from t group by doc_id)", "k as (select items, count(*) as n from z group by items)", "o as (select items, n, unnest(string_split(items, ',')) as item from k)") + "select x.items as items_a, y.items as items_b, count(*) as shared, any_value(x.n) as rows_a, any_value(y.n) as rows_b from o x join o y on x.item = y.item and x.items < y.items group by 1, 2 having count(*) >= 2")
def j16(spark: SparkSession, d: str) -> DataFrame:
    return op.shared_items(b.tags(spark, d), "doc_id", "tag", 2)


@query("pj15_schema_issues", b.with_(b.C) + "select doc_id, unnest(list_filter([case when json_extract_string(frontmatter, '$.title') is null then 'missing:title' end, case when json_extract_string(frontmatter, '$.created') is null then 'missing:created' end, case when json_extract_string(frontmatter, '$.status') is null then 'missing:status' end, case when json_extract_string(frontmatter, '$.status') not in ('draft', 'review', 'stable', 'deprecated') then 'invalid:status' end, case when frontmatter is null then 'missing:frontmatter' end], lambda x: x is not null)) as issue from c")
def p15(spark: SparkSession, d: str) -> DataFrame:
    get = lambda k: F.get_json_object("frontmatter", f"$.{k}")
    issue = [F.when(get(k).isNull(), f"missing:{k}") for k in ("title", "created", "status")]
    issue += [F.when(~get("status").isin("draft", "review", "stable", "deprecated"), "invalid:status"), F.when(F.col("frontmatter").isNull(), "missing:frontmatter")]
    return b.cleaned(spark, d).select("doc_id", F.explode(F.array_compact(F.array(*issue))).alias("issue"))


_GAP = "i as (select doc_id, json_extract_string(frontmatter, '$.title') is null as no_title, json_extract_string(frontmatter, '$.status') is null as no_status, coalesce(len(from_json(json_extract(frontmatter, '$.tags'), '[\"VARCHAR\"]')), 0) = 0 as no_tags from c)"


@query("pj16_gap_class", b.with_(b.C, _GAP) + "select doc_id, case when no_status then 'owner' when no_tags then 'llm' when no_title then 'mechanical' else 'complete' end as recommendation from i")
def p16(spark: SparkSession, d: str) -> DataFrame:
    get = lambda k: F.get_json_object("frontmatter", f"$.{k}")
    no_tags = F.coalesce(F.size(F.from_json(get("tags"), "array<string>")), F.lit(0)) <= 0
    kind = F.when(get("status").isNull(), "owner").when(no_tags, "llm").when(get("title").isNull(), "mechanical").otherwise("complete")
    return b.cleaned(spark, d).select("doc_id", kind.alias("recommendation"))


@query("j15_fm_diff", b.with_(b.C, b.S) + "select coalesce(c.doc_id, s.doc_id) as doc_id, case when c.doc_id is null then 'only structured' when s.doc_id is null then 'only cleaned' when coalesce(nullif(trim(json_extract_string(frontmatter, '$.title')), ''), '~') = coalesce(nullif(trim(s.title), ''), '~') then 'same' else 'differs' end as state from c full join s on c.doc_id = s.doc_id")
def j15(spark: SparkSession, d: str) -> DataFrame:
    blank = lambda x: F.nullif(F.trim(x), F.lit(""))
    c = b.cleaned(spark, d, False).select("doc_id", blank(F.get_json_object("frontmatter", "$.title")).alias("a"), F.lit(True).alias("in_c"))
    s = b.structured(spark, d).select("doc_id", blank(F.col("title")).alias("t"), F.lit(True).alias("in_s"))
    state = F.when(F.col("in_c").isNull(), "only structured").when(F.col("in_s").isNull(), "only cleaned").when(F.col("a").eqNullSafe(F.col("t")), "same").otherwise("differs")
    return c.join(s, "doc_id", "full").select("doc_id", state.alias("state"))


@query("a15_alias_collision", b.with_(b.S, "x as (select distinct lower(trim(title)) as alias, doc_id from s where trim(title) <> '')") + "select alias, count(*) as docs, min(doc_id) as first_doc from x group by alias having count(*) > 1")
def a15(spark: SparkSession, d: str) -> DataFrame:
    x = b.structured(spark, d).where("trim(title) <> ''").select(F.lower(F.trim("title")).alias("alias"), "doc_id").distinct()
    return x.groupBy("alias").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc")).where("docs > 1")


_STEM = "st as (select distinct split_part(title, ' ', 1) as stem from s where title is not null)"


@query("j9_dangling", b.with_(b.S, b.LINKS, _STEM) + "select k.doc_id, k.target from k where k.target not in (select stem from st)")
def j9d(spark: SparkSession, d: str) -> DataFrame:
    stems = b.structured(spark, d).where("title is not null").select(F.split("title", " ")[0].alias("target")).distinct()
    return b.links(spark, d).join(stems, "target", "left_anti").select("doc_id", "target")


@query("j9_resolved", b.with_(b.S, b.LINKS, _STEM) + "select k.target, count(*) as links from k where k.target in (select stem from st) group by k.target")
def j9r(spark: SparkSession, d: str) -> DataFrame:
    stems = b.structured(spark, d).where("title is not null").select(F.split("title", " ")[0].alias("target")).distinct()
    return b.links(spark, d).join(stems, "target", "left_semi").groupBy("target").agg(F.count("*").alias("links"))


@query("d12_in_degree", b.with_(b.S, b.LINKS, "x as (select lower(split_part(s.title, ' ', 1)) as src, lower(k.target) as target from k join s on k.doc_id = s.doc_id)") + "select target, count(distinct src) as degree from x where src <> target group by target")
def d12(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).select("doc_id", F.lower(F.split("title", " ")[0]).alias("src"))
    return graph.in_degree(b.links(spark, d).join(s, "doc_id").select("src", "target"), "src", "target")


@query("j18_related", b.with_(b.S, b.LINKS, "x as (select distinct split_part(s.title, ' ', 1) as a, k.target as b from k join s on k.doc_id = s.doc_id where s.title is not null)") + "select a, b from x union select b, a from x")
def j18(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).where("title is not null").select("doc_id", F.split("title", " ")[0].alias("a"))
    return graph.symmetric(b.links(spark, d).join(s, "doc_id").select("a", F.col("target").alias("b")), "a", "b")


@query("a7_components", b.with_(b.S, b.LINKS).replace("with ", "with recursive ", 1) + ", x as (select distinct split_part(s.title, ' ', 1) as a, k.target as b from k join s on k.doc_id = s.doc_id where s.title is not null), e as (select a, b from x union select b, a from x), r as (select a as node, a as seen from e union select r.node, e.b from r join e on r.seen = e.a) select node, min(seen) as component from r group by node")
def a7(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).where("title is not null").select("doc_id", F.split("title", " ")[0].alias("src"))
    return graph.components(b.links(spark, d).join(s, "doc_id").select("src", F.col("target").alias("dst")).distinct())


@query("j11_assets", b.with_(b.S, "need as (select distinct e as name from (select unnest(embeds) as e from s))", "have as (select distinct regexp_replace(i, '^.*/', '') as name from (select unnest(images) as i from s))") + "select coalesce(need.name, have.name) as name, case when have.name is null then 'missing' when need.name is null then 'orphan' else 'ok' end as state from need full join have on need.name = have.name")
def j11(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d)
    need = s.select(F.explode("embeds").alias("name")).distinct().withColumn("n", F.lit(True))
    have = s.select(F.explode("images").alias("i")).select(F.regexp_replace("i", "^.*/", "").alias("name")).distinct().withColumn("h", F.lit(True))
    state = F.when(F.col("h").isNull(), "missing").when(F.col("n").isNull(), "orphan").otherwise("ok")
    return need.join(have, "name", "full").select("name", state.alias("state"))
