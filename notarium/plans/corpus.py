"""Corpus queries: duplicates, sizes, languages, counts, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus as op
from ..session import table
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql

HASH = r"nullif(regexp_replace(lower(trim({0})), '^sha256:', ''), '')"


@query("a1_exact_dups", b.with_(b.C, f"h as (select doc_id, {HASH.format('normalized_sha256')} as sha from c where body is not null and body <> '')", "n as (select sha, count(*) as copies, min(doc_id) as first_doc from h where sha is not null group by sha having count(*) > 1)") + "select h.sha, h.doc_id, n.copies, h.doc_id = n.first_doc as is_first from h join n on h.sha = n.sha")
def a1(spark: SparkSession, d: str) -> DataFrame:
    rows = b.cleaned(spark, d).where("body <> ''").select("doc_id", op.plain_hash("normalized_sha256").alias("sha"))
    return op.copies(rows, "sha", "doc_id")


@query("a2_first_kept", b.with_(b.M, f"h as (select doc_id, path, {HASH.format('sha256')} as sha from m)", "n as (select sha, min(path) as first_path from h where sha is not null group by sha)") + "select h.doc_id, h.sha, case when n.first_path is null or h.path = n.first_path then 'kept' else 'duplicate' end as status, case when h.path <> n.first_path then n.first_path end as duplicate_of from h left join n on h.sha = n.sha")
def a2(spark: SparkSession, d: str) -> DataFrame:
    rows = b.manifest(spark, d).select("doc_id", "path", op.plain_hash("sha256").alias("sha"))
    return op.first_kept(rows, "sha", "path").select("doc_id", "sha", "status", "duplicate_of")


@query("a3_totals", b.with_(b.M) + "select count(*) as docs, sum(size_bytes)::bigint as bytes, sum(word_count)::bigint as words, sum(char_count)::bigint as chars, sum(line_count)::bigint as lines from m")
def a3(spark: SparkSession, d: str) -> DataFrame:
    m = b.manifest(spark, d)
    return m.agg(F.count("*").alias("docs"), F.sum("size_bytes").alias("bytes"), F.sum("word_count").alias("words"), F.sum("char_count").alias("chars"), F.sum("line_count").alias("lines"))


@query("pj1_text_stats", f"select doc_id, {b.sql_words('text')} as words, length(text) as chars, len(string_split(text, chr(10))) as lines from documents")
def p1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", b.words("text").alias("words"), F.length("text").cast("bigint").alias("chars"), F.size(F.split("text", "\n", -1)).cast("bigint").alias("lines"))


BIN = "case when word_count < 100 then '<100' when word_count < 500 then '<500' when word_count < 2000 then '<2000' when word_count <= 10000 then '<=10000' else '>10000' end"


@query("pj10_size_bins", b.with_(b.M) + f"select {BIN} as bin, count(*) as docs, sum(word_count)::bigint as words from m where word_count is not null group by 1")
def p10(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).where("word_count is not null").groupBy(F.expr(BIN).alias("bin")).agg(F.count("*").alias("docs"), F.sum("word_count").alias("words"))


@query("t1_longest", b.with_(b.M) + "select doc_id, word_count from m where word_count is not null order by word_count desc, doc_id limit 10")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).where("word_count is not null").select("doc_id", "word_count").orderBy(F.desc("word_count"), "doc_id").limit(10)


@query("t1_shortest", b.with_(b.M) + "select doc_id, word_count from m where word_count > 0 order by word_count, doc_id limit 10")
def t1s(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).where("word_count > 0").select("doc_id", "word_count").orderBy("word_count", "doc_id").limit(10)


#: Stop words of the two-language guess.
DE = "und der die das ist auch mit von zu für nicht sich nach noch oder aber wenn bei wie eine einen einem einer eines werden wird wurde"
EN = "the and is are of to for this that with from have has not can will they you your which been were their there"
_list = lambda ws: "(" + ", ".join(f"'{w}'" for w in ws.split()) + ")"
LANG = "case when de = 0 and en = 0 then 'unklar' when de >= 2 * en then 'de' when en >= 2 * de then 'en' else 'mixed' end"


def _guess(spark: SparkSession, d: str) -> DataFrame:
    w = F.regexp_extract_all(F.lower(F.substring("text", 1, 1000)), F.lit(r"[a-zäöüß]{2,}"), F.lit(0))
    hits = lambda ws: F.size(F.filter(w, lambda x: x.isin(ws.split())))
    return table(spark, d, "documents").select("doc_id", "lang", hits(DE).alias("de"), hits(EN).alias("en")).withColumn("guess", F.expr(LANG))


_GUESS = f"w as (select doc_id, lang, regexp_extract_all(lower(substr(text, 1, 1000)), '[a-zäöüß]{{2,}}') as ws from documents), x as (select doc_id, lang, len(list_filter(ws, lambda y: y in {_list(DE)})) as de, len(list_filter(ws, lambda y: y in {_list(EN)})) as en from w)"


@query("f14_language", b.with_(_GUESS) + f"select doc_id, {LANG} as guess, de::int as de, en::int as en from x")
def f14(spark: SparkSession, d: str) -> DataFrame:
    return _guess(spark, d).select("doc_id", "guess", "de", "en")


@query("a4_language_counts", b.with_(_GUESS) + f"select coalesce(lang, '') as label, {LANG} as guess, count(*) as docs from x group by 1, 2")
def a4l(spark: SparkSession, d: str) -> DataFrame:
    return _guess(spark, d).groupBy(F.coalesce("lang", F.lit("")).alias("label"), "guess").agg(F.count("*").alias("docs"))


@query("f16_tokens", "select doc_id, greatest(1, length(text) // 4) as tokens from documents")
def f16(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.expr("greatest(1L, cast(length(text) as bigint) div 4)").alias("tokens"))


@query("a22_percentile", "with x as (select source, n_chars, row_number() over (partition by source order by n_chars, doc_id) as k, count(*) over (partition by source) as n from documents where source is not null), p as (select unnest([0.1, 0.5, 0.9]::double[]) as p) select source, p, n_chars from x join p on k = least(n, cast(floor(n * p) as bigint) + 1)")
def a22(spark: SparkSession, d: str) -> DataFrame:
    return op.index_percentiles(table(spark, d, "documents").where("source is not null"), "source", "n_chars", "doc_id", [0.1, 0.5, 0.9])


@query("a4_folder_counts", b.with_(b.M) + "select split_part(path, '/', 1) as folder, count(*) as docs, max(modified_at) as newest from m group by 1")
def a4f(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).groupBy(b.folder().alias("folder")).agg(F.count("*").alias("docs"), F.max("modified_at").alias("newest"))


@query("a6_segment_counts", b.with_(b.G) + "select doc_id, count(*) as segments, sum(word_count)::bigint as words, max(segment_index) as last_index from g group by 1")
def a6(spark: SparkSession, d: str) -> DataFrame:
    return b.segments(spark, d).groupBy("doc_id").agg(F.count("*").alias("segments"), F.sum("word_count").alias("words"), F.max("segment_index").alias("last_index"))


@query("j1_segment_paths", b.with_(b.M, b.G) + "select segment_id, coalesce(source_path, m.path, '') as path, source_path is null as filled from g left join m on g.doc_id = m.doc_id")
def j1(spark: SparkSession, d: str) -> DataFrame:
    m = b.manifest(spark, d).select("doc_id", "path")
    return b.segments(spark, d).join(m, "doc_id", "left").select("segment_id", F.coalesce("source_path", "path", F.lit("")).alias("path"), F.col("source_path").isNull().alias("filled"))


@query("j5_type_counts", b.with_(b.M, b.S) + "select coalesce(s.doc_type_guess.label, 'unklar') as label, count(*) as docs, sum(m.word_count)::bigint as words from m left join s on m.doc_id = s.doc_id group by 1")
def j5(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).select("doc_id", F.col("doc_type_guess.label").alias("label"))
    return b.manifest(spark, d).join(s, "doc_id", "left").groupBy(F.coalesce("label", F.lit("unklar")).alias("label")).agg(F.count("*").alias("docs"), F.sum("word_count").alias("words"))


@query("j3_segments_of_heading", b.with_(b.G) + "select h, count(*) as segments, count(distinct doc_id) as docs from (select doc_id, unnest(heading_path) as h from g) group by h having count(*) > 1")
def j3(spark: SparkSession, d: str) -> DataFrame:
    return b.segments(spark, d).select("doc_id", F.explode("heading_path").alias("h")).groupBy("h").agg(F.count("*").alias("segments"), F.count_distinct("doc_id").alias("docs")).where("segments > 1")


@query("a9_label", b.with_(b.G, "x as (select doc_id, heading_path[1] as h, min(segment_index) as first_at, count(*) as n from g where len(heading_path) > 0 group by 1, 2)") + "select doc_id, trim(substr(h, 1, 80)) as label, n from (select *, row_number() over (partition by doc_id order by n desc, first_at, h) as rn from x) where rn = 1")
def a9(spark: SparkSession, d: str) -> DataFrame:
    x = b.segments(spark, d).where("size(heading_path) > 0").groupBy("doc_id", F.col("heading_path")[0].alias("h")).agg(F.min("segment_index").alias("first_at"), F.count("*").alias("n"))
    return op.mode_by(x, "doc_id", "n", "first_at", "h").select("doc_id", F.trim(F.substring("h", 1, 80)).alias("label"), "n")


@query("f44_verbatim", b.with_(b.G) + "select doc_id, sha256(string_agg(text, chr(10) || chr(10) order by segment_index, segment_id)) as text_sha256 from g where trim(text) <> '' group by doc_id")
def f44(spark: SparkSession, d: str) -> DataFrame:
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment_index", "segment_id", "text"))), lambda x: x["text"]), "\n\n")
    return b.segments(spark, d).where("trim(text) <> ''").groupBy("doc_id").agg(F.sha2(body, 256).alias("text_sha256"))


@query("s2_sample", b.with_(b.M) + "select doc_id, path from m order by path, doc_id limit 100")
def s2(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).select("doc_id", "path").orderBy("path", "doc_id").limit(100)


@query("m7_counts", b.with_(b.M) + "select count(*) filter (where split_part(path, '/', 1) = 'inbox') as unsorted, count(*) filter (where word_count is null) as uncounted, count(*) filter (where modified_at is null) as undated from m")
def m7(spark: SparkSession, d: str) -> DataFrame:
    return b.manifest(spark, d).agg(F.count_if(b.folder() == "inbox").alias("unsorted"), F.count_if(F.col("word_count").isNull()).alias("uncounted"), F.count_if(F.col("modified_at").isNull()).alias("undated"))


@query("a26_input_hash", b.with_(b.M, f"h as (select split_part(path, '/', 1) as folder, {HASH.format('sha256')} as sha from m)") + "select folder, count(*) as files, substr(sha256(concat_ws('|', count(*)::varchar, sum(('0x' || substr(sha, 1, 15))::bigint)::hugeint::varchar, sum(('0x' || substr(sha, 16, 15))::bigint)::hugeint::varchar, bit_xor(('0x' || substr(sha, 31, 15))::bigint)::varchar)), 1, 16) as mark from h where sha is not null group by folder")
def a26(spark: SparkSession, d: str) -> DataFrame:
    rows = b.manifest(spark, d).select(b.folder().alias("folder"), op.plain_hash("sha256").alias("sha")).where("sha is not null")
    return op.set_mark(rows, ["folder"], "sha").select("folder", "files", "mark")


@query("m8_status", b.with_(b.M, b.S) + "select count(*) as docs, count(s.doc_id) as ready, count(*) filter (where split_part(path, '/', 1) = 'inbox' and s.doc_id is null) as excluded, count(*) - count(s.doc_id) - count(*) filter (where split_part(path, '/', 1) = 'inbox' and s.doc_id is null) as hold from m left join s on m.doc_id = s.doc_id")
def m8(spark: SparkSession, d: str) -> DataFrame:
    s = b.structured(spark, d).select("doc_id", F.lit(True).alias("ready"))
    x = b.manifest(spark, d).join(s, "doc_id", "left").agg(F.count("*").alias("docs"), F.count("ready").alias("ready"), F.count_if((b.folder() == "inbox") & F.col("ready").isNull()).alias("excluded"))
    return x.select("docs", "ready", "excluded", F.expr("docs - ready - excluded").alias("hold"))


@query("a21_top_terms", b.with_(b.M, "x as (select distinct split_part(m.path, '/', 1) as folder, g.doc_id, term from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-zäöüß]{4,}')) as term from (select * from (select *, row_number() over (partition by segment_id order by source_path desc nulls last) as rn from segments) where rn = 1)) g join m on m.doc_id = g.doc_id)", "n as (select folder, term, count(*) as docs from x group by 1, 2)", "f as (select term, count(*) as folders, sum(docs) as all_docs from n group by 1)") + "select folder, term, docs from (select n.folder, n.term, n.docs, row_number() over (partition by n.folder order by round(n.docs * n.docs * 1.0 / f.all_docs, 9) desc, n.term) as rn from n join f on n.term = f.term where n.docs > 1) where rn <= 10")
def a21(spark: SparkSession, d: str) -> DataFrame:
    m = b.manifest(spark, d).select("doc_id", b.folder().alias("folder"))
    terms = b.segments(spark, d).select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-zäöüß]{4,}"), F.lit(0)))).alias("term"))
    return op.top_terms(terms.join(m, "doc_id").distinct(), "folder", "term", 10)

