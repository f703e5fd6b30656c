"""Audit and quality queries over findings and structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import graph, quality as op
from ..session import table
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("a13_by_rule", b.with_(b.FI) + "select rule, count(*) as findings, count(*) filter (where fixable) as fixable, count(distinct relpath) as files from f group by rule")
def a13(spark: SparkSession, d: str) -> DataFrame:
    return b.findings(spark, d).groupBy("rule").agg(F.count("*").alias("findings"), F.count_if("fixable").alias("fixable"), F.count_distinct("relpath").alias("files"))


@query("a13_by_severity", b.with_(b.FI) + "select x.severity, count(f.rule) as findings from (values ('error'), ('warning'), ('info'), ('none')) as x(severity) left join f on coalesce(f.severity, 'none') = x.severity group by x.severity")
def a13s(spark: SparkSession, d: str) -> DataFrame:
    seed = spark.createDataFrame([(x,) for x in ("error", "warning", "info", "none")], "severity string")
    n = b.findings(spark, d).groupBy(F.coalesce("severity", F.lit("none")).alias("severity")).agg(F.count("*").alias("n"))
    return seed.join(n, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("findings"))


@query("a24_outcomes", b.with_(b.FI) + "select rule, coalesce(severity, 'none') as severity, case when fixable is null then 'unknown' when fixable then 'safe' else 'review' end as tier, count(*) as n from f group by 1, 2, 3")
def a24(spark: SparkSession, d: str) -> DataFrame:
    tier = F.when(F.col("fixable").isNull(), "unknown").when(F.col("fixable"), "safe").otherwise("review")
    return b.findings(spark, d).groupBy("rule", F.coalesce("severity", F.lit("none")).alias("severity"), tier.alias("tier")).agg(F.count("*").alias("n"))


@query("a14_reconcile", b.with_(b.M, b.FI, "x as (select split_part(relpath, '/', 1) as folder, count(distinct relpath) as files, count(*) as findings from f group by 1)", "y as (select split_part(path, '/', 1) as folder, count(*) as docs from m group by 1)") + "select coalesce(x.folder, y.folder) as folder, coalesce(docs, 0) as docs, coalesce(files, 0) as files, coalesce(findings, 0) as findings from y full join x on x.folder = y.folder")
def a14(spark: SparkSession, d: str) -> DataFrame:
    x = b.findings(spark, d).groupBy(b.folder("relpath").alias("folder")).agg(F.count_distinct("relpath").alias("files"), F.count("*").alias("findings"))
    y = b.manifest(spark, d).groupBy(b.folder().alias("folder")).agg(F.count("*").alias("docs"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return y.join(x, "folder", "full").select("folder", zero("docs"), zero("files"), zero("findings"))


@query("d15_worst_files", b.with_(b.FI) + "select relpath, n, errors from (select relpath, count(*) as n, count(*) filter (where severity = 'error') as errors from f group by relpath) order by n desc, relpath limit 50")
def d15(spark: SparkSession, d: str) -> DataFrame:
    return b.findings(spark, d).groupBy("relpath").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "error").alias("errors")).orderBy(F.desc("n"), "relpath").limit(50)


@query("m18_blocking", b.with_(b.M, b.FI) + "select m.doc_id, count(distinct f.rule) as rules, count(*) as findings from f join m on f.relpath = m.path where f.severity = 'error' group by m.doc_id")
def m18(spark: SparkSession, d: str) -> DataFrame:
    bad = b.findings(spark, d).where("severity = 'error'")
    m = b.manifest(spark, d).select("doc_id", F.col("path").alias("relpath"))
    return bad.join(m, "relpath").groupBy("doc_id").agg(F.count_distinct("rule").alias("rules"), F.count("*").alias("findings"))


@query("j17_without_findings", b.with_(b.M, b.FI) + "select split_part(path, '/', 1) as folder, count(*) as docs from m where path not in (select relpath from f) group by 1")
def j17(spark: SparkSession, d: str) -> DataFrame:
    named = b.findings(spark, d).select(F.col("relpath").alias("path")).distinct()
    return b.manifest(spark, d).join(named, "path", "left_anti").groupBy(b.folder().alias("folder")).agg(F.count("*").alias("docs"))


@query("f9_headings", b.with_(b.S, "h as (select doc_id, unnest(headings) as h from s)") + "select h.level as level, count(*) as headings, count(distinct doc_id) as docs, count(*) filter (where trim(h.text) = '') as empty from h group by 1")
def f9(spark: SparkSession, d: str) -> DataFrame:
    h = b.structured(spark, d).select("doc_id", F.explode("headings").alias("h")).select("doc_id", "h.*")
    return h.groupBy("level").agg(F.count("*").alias("headings"), F.count_distinct("doc_id").alias("docs"), F.count_if(F.trim("text") == "").alias("empty"))


_JUMPS = "j as (select doc_id, len(list_filter(range(2, len(headings) + 1), lambda i: headings[i].level - headings[i - 1].level > 1)) as jumps, len(headings) as sections from s)"


def _jumps(df: DataFrame) -> DataFrame:
    levels = F.transform("headings", lambda h: h["level"])
    pair = F.zip_with(F.slice(levels, 1, F.greatest(F.size(levels) - 1, F.lit(0))), F.slice(levels, 2, F.size(levels)), lambda a, c: c - a > 1)
    return df.select("doc_id", F.when(F.size(levels) > 1, F.size(F.filter(pair, lambda x: x))).otherwise(0).cast("bigint").alias("jumps"), F.size("headings").cast("bigint").alias("sections"))


@query("w7_jumps", b.with_(b.S, _JUMPS) + "select doc_id, jumps, sections from j")
def w7(spark: SparkSession, d: str) -> DataFrame:
    return _jumps(b.structured(spark, d))


@query("w5_heading_path", b.with_(b.S).replace("with ", "with recursive ", 1) + ", p as (select doc_id, 1 as i, [headings[1].text] as path, headings from s where len(headings) > 0 union all select doc_id, i + 1, list_concat(list_slice(path, 1, headings[i + 1].level - 1), [headings[i + 1].text]), headings from p where i < len(headings)) select doc_id, i as heading_no, array_to_string(path, ' > ') as path from p")
def w5(spark: SparkSession, d: str) -> DataFrame:
    empty = F.array().cast("array<string>")
    step = lambda acc, h: F.struct(F.concat(F.slice(acc["path"], F.lit(1), h["level"] - 1), F.array(h["text"])).alias("path"), F.concat(acc["out"], F.array(F.array_join(F.concat(F.slice(acc["path"], F.lit(1), h["level"] - 1), F.array(h["text"])), " > "))).alias("out"))
    paths = F.aggregate("headings", F.struct(empty.alias("path"), empty.alias("out")), step, lambda acc: acc["out"])
    return b.structured(spark, d).where("size(headings) > 0").select("doc_id", F.posexplode(paths).alias("i", "path")).select("doc_id", (F.col("i") + 1).alias("heading_no"), "path")


@query("pj4_route", b.with_(b.S) + "select doc_id, case when doc_type_guess.label = 'gedanke' then 'thought' when len(code_blocks) > 0 or tables_count >= 1 or len(headings) >= 3 or coalesce(len(embeds), 0) > 0 then 'passthrough' else 'stage3' end as route from s")
def p4(spark: SparkSession, d: str) -> DataFrame:
    rich = (F.size("code_blocks") > 0) | (F.col("tables_count") >= 1) | (F.size("headings") >= 3) | (F.coalesce(F.size("embeds"), F.lit(0)) > 0)
    return b.structured(spark, d).select("doc_id", F.when(F.col("doc_type_guess.label") == "gedanke", "thought").when(rich, "passthrough").otherwise("stage3").alias("route"))


@query("f8_code_languages", b.with_(b.S, "x as (select doc_id, unnest(code_blocks) as cb from s)") + "select coalesce(nullif(lower(trim(cb.lang)), ''), 'unknown') as lang, count(*) as blocks, count(distinct doc_id) as docs, sum(length(cb.content))::bigint as chars from x group by 1")
def f8(spark: SparkSession, d: str) -> DataFrame:
    x = b.structured(spark, d).select("doc_id", F.explode("code_blocks").alias("cb"))
    lang = F.coalesce(F.nullif(F.lower(F.trim("cb.lang")), F.lit("")), F.lit("unknown"))
    return x.groupBy(lang.alias("lang")).agg(F.count("*").alias("blocks"), F.count_distinct("doc_id").alias("docs"), F.sum(F.length("cb.content").cast("bigint")).alias("chars"))


_Q = ", ".join(
    [
        b.M,
        b.C,
        b.S,
        b.FI,
        b.LINKS,
        _JUMPS,
        "st as (select distinct split_part(title, ' ', 1) as stem from s where title is not null)",
        "w as (select relpath, sum(case severity when 'error' then 3.0 when 'warning' then 1.5 when 'info' then 0.5 else 1.0 end)::double as weighted from f group by relpath)",
        "o as (select doc_id, count(*) filter (where target in (select stem from st)) as out_links, count(*) filter (where target not in (select stem from st)) as dangling from k group by doc_id)",
        "e as (select lower(split_part(s.title, ' ', 1)) as src, lower(k.target) as target from k join s on k.doc_id = s.doc_id)",
        "n as (select target, count(distinct src) as degree from e where src <> target group by target)",
        "dup as (select lower(normalized_sha256) as sha, count(*) as copies from c where normalized_sha256 is not null group by 1)",
        "r as (select m.doc_id, m.path as relpath, greatest(0.0, least(100.0, 100.0 - 6.0 * coalesce(w.weighted, 0) / greatest(coalesce(m.char_count, 0) / 1000.0, 1.0)))::double as d1, greatest(0.0, least(100.0, 100.0 - 15.0 * j.jumps - case when j.sections < 2 then 8.0 * (2 - j.sections) when j.sections > greatest(8, round_even(m.word_count / 120.0, 0)::int) then least(40.0, 8.0 * (j.sections - greatest(8, round_even(m.word_count / 120.0, 0)::int))) else 0.0 end - case when m.word_count < 80 or m.word_count > 3000 then 12.0 else 0.0 end))::double as d2, greatest(0.0, least(100.0, 100.0 * (0.7 * ((json_extract_string(c.frontmatter, '$.title') is not null)::int + (json_extract_string(c.frontmatter, '$.created') is not null)::int) / 2.0 + 0.3 * ((json_extract_string(c.frontmatter, '$.status') is not null)::int) / 1.0) - 8.0 * (case when json_extract_string(c.frontmatter, '$.status') not in ('draft', 'review', 'stable', 'deprecated') then 1 else 0 end)))::double as d3, (case when c.normalized_sha256 is null then null when dup.copies > 1 then 0.0 else 100.0 end)::double as d4, greatest(0.0, least(100.0, 100.0 * (0.5 * least(1.0, coalesce(o.out_links, 0) / 3.0) + 0.5 * least(1.0, coalesce(n.degree, 0) / 2.0)) - 20.0 * coalesce(o.dangling, 0)))::double as d5 from m join c on m.doc_id = c.doc_id join j on m.doc_id = j.doc_id join s on m.doc_id = s.doc_id left join w on w.relpath = m.path left join o on o.doc_id = m.doc_id left join n on n.target = lower(split_part(s.title, ' ', 1)) left join dup on dup.sha = lower(c.normalized_sha256))",
        "q as (select doc_id, relpath, d1, d2, d3, d4, d5, round((coalesce(d1, 0) + coalesce(d2, 0) + coalesce(d3, 0) + coalesce(d4, 0)) / greatest(1, (d1 is not null)::int + (d2 is not null)::int + (d3 is not null)::int + (d4 is not null)::int), 2) as readiness, round(coalesce(d5, 0), 2) as integration from r)",
        "z as (select *, case when readiness >= 80 then 'produktiv' when readiness >= 60 then 'nutzbar' else 'nacharbeit' end as band, case when integration >= 50 then 'hub-kandidat' when integration < 20 then 'insel' else 'verknüpfbar' end as tier from q)",
    ]
)


def scores(spark: SparkSession, d: str) -> DataFrame:
    """The five scores of each record that has structure, the two axes, band and tier."""
    m = b.manifest(spark, d).select("doc_id", F.col("path").alias("relpath"), "word_count", "char_count")
    c = b.cleaned(spark, d, False).select("doc_id", "frontmatter", F.lower("normalized_sha256").alias("sha"))
    s = b.structured(spark, d)
    stem = s.select("doc_id", F.split("title", " ")[0].alias("stem"))
    weighted = b.findings(spark, d).groupBy("relpath").agg(F.sum(op.severity_weight("severity")).alias("weighted"))
    k = b.links(spark, d)
    known = stem.select(F.col("stem").alias("target")).where("target is not null").distinct().withColumn("known", F.lit(True))
    out = k.join(known, "target", "left").groupBy("doc_id").agg(F.count("known").alias("out_links"), F.count_if(F.col("known").isNull()).alias("dangling"))
    into = graph.in_degree(k.join(stem.withColumn("src", F.lower("stem")), "doc_id").select("src", "target"), "src", "target").withColumnRenamed("target", "low")
    dup = c.where("sha is not null").groupBy("sha").agg(F.count("*").alias("copies"))
    x = m.join(c, "doc_id").join(_jumps(s), "doc_id").join(stem.withColumn("low", F.lower("stem")), "doc_id")
    x = x.join(weighted, "relpath", "left").join(out, "doc_id", "left").join(into, "low", "left").join(dup, "sha", "left")
    get = lambda f: F.get_json_object("frontmatter", f"$.{f}")
    zero = lambda f: F.coalesce(F.col(f), F.lit(0))
    invalid = F.coalesce((~get("status").isin("draft", "review", "stable", "deprecated")).cast("int"), F.lit(0))
    r = x.select(
        "doc_id",
        "relpath",
        op.formal(zero("weighted"), zero("char_count")).alias("d1"),
        op.structure(F.col("jumps"), F.col("sections"), F.col("word_count")).alias("d2"),
        op.metadata([get("title").isNotNull(), get("created").isNotNull()], [get("status").isNotNull()], invalid).alias("d3"),
        F.when(F.col("sha").isNull(), None).when(F.col("copies") > 1, 0.0).otherwise(100.0).alias("d4"),
        op.linkability(zero("out_links"), zero("degree"), zero("dangling")).alias("d5"),
    )
    r = r.withColumn("readiness", op.weighted_mean([F.col(f"d{i}") for i in (1, 2, 3, 4)], [1.0] * 4)).withColumn("integration", op.weighted_mean([F.col("d5")], [1.0]))
    return r.withColumn("band", op.band("readiness")).withColumn("tier", op.tier("integration"))


@query("d14_scores", "with " + _Q + " select doc_id, round(d1, 4) as d1, round(d2, 4) as d2, round(d3, 4) as d3, round(d4, 4) as d4, round(d5, 4) as d5, readiness, integration, band, tier from z")
def d14(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).select("doc_id", *(F.round(f"d{i}", 4).alias(f"d{i}") for i in range(1, 6)), "readiness", "integration", "band", "tier")


@query("a16_distribution", "with " + _Q + ", u as (select unnest(['d1', 'd2', 'd3', 'd4', 'd5']) as dimension, unnest([d1, d2, d3, d4, d5]) as score from z) select dimension, min(score) as low, round(quantile_cont(score, 0.5), 4) as median, max(score) as high from u group by dimension")
def a16(spark: SparkSession, d: str) -> DataFrame:
    return op.distribution(scores(spark, d), ["d1", "d2", "d3", "d4", "d5"])


@query("a18_quadrant", "with " + _Q + " select band, count(*) filter (where tier = 'hub-kandidat') as hub, count(*) filter (where tier = 'verknüpfbar') as linkable, count(*) filter (where tier = 'insel') as island from z group by band")
def a18(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).groupBy("band").agg(F.count_if(F.col("tier") == "hub-kandidat").alias("hub"), F.count_if(F.col("tier") == "verknüpfbar").alias("linkable"), F.count_if(F.col("tier") == "insel").alias("island"))


_WEAK = "case least(d1, d2, d3, coalesce(d4, 1000)) when d1 then 'd1' when d2 then 'd2' when d3 then 'd3' else 'd4' end"


@query("t3_worst", "with " + _Q + f" select doc_id, readiness, {_WEAK} as weakest from z order by readiness, doc_id limit 15")
def t3(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).orderBy("readiness", "doc_id").limit(15).select("doc_id", "readiness", F.expr(_WEAK).alias("weakest"))


@query("t4_high_value", "with " + _Q + " select doc_id, integration, readiness from z where band in ('produktiv', 'nutzbar') and tier = 'hub-kandidat' order by integration desc, readiness desc, doc_id")
def t4(spark: SparkSession, d: str) -> DataFrame:
    """All hubs that are ready for use, best first; the rows are sorted across parts, so no task holds them all."""
    return scores(spark, d).where("band in ('produktiv', 'nutzbar') and tier = 'hub-kandidat'").select("doc_id", "integration", "readiness").orderBy(F.desc("integration"), F.desc("readiness"), "doc_id")


@query("t5_lever", "with " + _Q + ", u as (select unnest(['d1', 'd2', 'd3', 'd4']) as dimension, unnest([d1, d2, d3, d4]) as score from z), x as (select dimension, round(quantile_cont(score, 0.5), 4) as median from u group by dimension) select dimension, median from x order by median, dimension limit 1")
def t5(spark: SparkSession, d: str) -> DataFrame:
    return op.distribution(scores(spark, d), ["d1", "d2", "d3", "d4"]).select("dimension", "median").orderBy("median", "dimension").limit(1)


@query("a23_snapshot", "with " + _Q + " select split_part(relpath, '/', 1) as folder, count(*) as docs, count(*) filter (where band = 'produktiv') as productive, count(*) filter (where tier = 'insel') as islands, round(avg(readiness), 4) as mean_readiness from z group by 1")
def a23(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).groupBy(b.folder("relpath").alias("folder")).agg(F.count("*").alias("docs"), F.count_if(F.col("band") == "produktiv").alias("productive"), F.count_if(F.col("tier") == "insel").alias("islands"), F.round(F.avg("readiness"), 4).alias("mean_readiness"))


@query("d27_done_check", b.with_(b.M, b.C, b.S, b.G) + "select 'records' as item, count(*) as n, 'ok' as state from m union all select 'no body', count(*), case when count(*) = 0 then 'ok' else 'look' end from c where body is null or body = '' union all select 'no structure', count(*), case when count(*) = 0 then 'ok' else 'look' end from m where doc_id not in (select doc_id from s) union all select 'no segments', count(*), case when count(*) = 0 then 'ok' else 'look' end from m where doc_id not in (select doc_id from g) union all select 'same hash', count(*), case when count(*) = 0 then 'ok' else 'look' end from (select lower(replace(sha256, 'sha256:', '')) from m where sha256 is not null group by 1 having count(*) > 1)")
def d27(spark: SparkSession, d: str) -> DataFrame:
    m, c = b.manifest(spark, d), b.cleaned(spark, d)
    ids = m.select("doc_id")
    checks = {
        "no body": c.where("body is null or body = ''"),
        "no structure": ids.join(table(spark, d, "structured").select("doc_id"), "doc_id", "left_anti"),
        "no segments": ids.join(table(spark, d, "segments").select("doc_id"), "doc_id", "left_anti"),
        "same hash": m.where("sha256 is not null").groupBy(F.lower(F.replace("sha256", F.lit("sha256:"), F.lit(""))).alias("h")).count().where("count > 1"),
    }
    out = m.agg(F.count("*").alias("n")).select(F.lit("records").alias("item"), "n", F.lit("ok").alias("state"))
    for name, rows in checks.items():
        out = out.unionByName(rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("item"), "n", F.when(F.col("n") == 0, "ok").otherwise("look").alias("state")))
    return out
