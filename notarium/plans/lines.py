"""Line-level queries over the bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import lines as op
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql
L = b.with_(b.C, b.LINES)
LA = b.with_(b.C, b.AUDITED)
#: Blank lines in a row that stay, link lines that make a run, words of a fragment.
MOST_BLANKS, LINK_RUN, FRAGMENT_WORDS = 3, 3, 30
_q = lambda p: p.replace("'", "''")
_HEAD = r"regexp_matches(line, '^#{1,6}[ \t]+[^ \t]')"


@query("w3_blank_cap", b.with_(b.C, b.FENCED) + f", x as (select doc_id, line_no - row_number() over (partition by doc_id order by line_no) as g from l where not code and trim(line, ' ' || chr(9) || chr(13)) = ''), r as (select doc_id, count(*) as n from x group by doc_id, g) select doc_id, sum(greatest(n - {MOST_BLANKS}, 0))::bigint as dropped, max(n) as longest from r group by doc_id")
def w3(spark: SparkSession, d: str) -> DataFrame:
    """Blank lines outside code: those beyond the cap of a run, and the longest run of each record."""
    return op.capped_blanks(b.flagged(spark, d, False).where("not code"), MOST_BLANKS)


@query("w4_tables", L + r", x as (select doc_id, line_no, line, line_no - row_number() over (partition by doc_id order by line_no) as g from l where starts_with(trim(line), '|') and length(trim(line)) > 2), r as (select doc_id, g, count(*) as n, bool_or(regexp_matches(trim(line), '^[|: \t-]+$')) as sep from x group by 1, 2) select doc_id, count(*) filter (where sep) as tables, sum(n)::bigint as lines from r group by doc_id")
def w4(spark: SparkSession, d: str) -> DataFrame:
    rows = b.lines(spark, d).where(F.startswith(F.trim("line"), F.lit("|")) & (F.length(F.trim("line")) > 2))
    rows = rows.withColumn("g", F.col("line_no") - F.row_number().over(op.by_doc()))
    runs = rows.groupBy("doc_id", "g").agg(F.count("*").alias("n"), F.bool_or(F.trim("line").rlike(r"^[|: \t-]+$")).alias("sep"))
    return runs.groupBy("doc_id").agg(F.count_if("sep").alias("tables"), F.sum("n").alias("lines"))


@query("w6_section_lines", LA + rf", x as (select doc_id, line, last_value(case when not code and {_HEAD} then lower(trim(regexp_replace(line, '^#+[ \t]+', ''))) end ignore nulls) over (partition by doc_id order by line_no rows between unbounded preceding and current row) as section from l) select doc_id, coalesce(section, '') as section, count(*) as lines, count(*) filter (where trim(line) <> '') as filled from x group by 1, 2")
def w6(spark: SparkSession, d: str) -> DataFrame:
    x = op.section_of(b.flagged(spark, d, True))
    return x.groupBy("doc_id", F.coalesce("section", F.lit("")).alias("section")).agg(F.count("*").alias("lines"), F.count_if(~op.blank()).alias("filled"))


@query("w8_setext", LA + rf", x as (select *, lag(line) over (partition by doc_id order by line_no) as above, lag(code) over (partition by doc_id order by line_no) as above_code from l) select doc_id, line_no from x where not code and regexp_matches(line, '{op.SETEXT}') and not above_code and trim(above) <> '' and not regexp_matches(above, '^#{{1,6}}[ \t]+[^ \t]')")
def w8(spark: SparkSession, d: str) -> DataFrame:
    x = b.flagged(spark, d, True).withColumn("above", F.lag("line").over(op.by_doc())).withColumn("above_code", F.lag("code").over(op.by_doc()))
    plain = ~F.col("above_code") & (F.trim("above") != "") & ~F.col("above").rlike(op.HEADING)
    return x.where(~F.col("code") & F.col("line").rlike(op.SETEXT) & plain).select("doc_id", "line_no")


@query("w9_empty_sections", LA + f", x as (select doc_id, line_no, line, sum(case when not code and {_HEAD} then 1 else 0 end) over (partition by doc_id order by line_no rows between unbounded preceding and current row) as sec from l), r as (select doc_id, sec, min(line_no) as line_no, count(*) filter (where trim(line) <> '') as filled from x where sec > 0 group by 1, 2) select doc_id, line_no from r where filled = 1")
def w9(spark: SparkSession, d: str) -> DataFrame:
    """Headings with nothing up to the next one; code counts as content, and its lines are no headings."""
    upto = op.by_doc().rowsBetween(Window.unboundedPreceding, 0)
    x = b.flagged(spark, d, True).withColumn("sec", F.sum((~F.col("code") & F.col("line").rlike(op.HEADING)).cast("int")).over(upto)).where("sec > 0")
    r = x.groupBy("doc_id", "sec").agg(F.min("line_no").alias("line_no"), F.count_if(~op.blank()).alias("filled"))
    return r.where("filled = 1").select("doc_id", "line_no")


_RUNS = rf"o as (select *, row_number() over (partition by doc_id order by line_no) as k from l where not code), li as (select doc_id, line_no, k - row_number() over (partition by doc_id order by k) as g from o where regexp_matches(trim(line), '{op.LINK_ONLY}')), lr as (select doc_id, min(line_no) as first_line, count(*) as length from li group by doc_id, g)"


@query("w10_link_runs", LA + f", {_RUNS} select doc_id, first_line, length from lr where length >= {LINK_RUN}")
def w10(spark: SparkSession, d: str) -> DataFrame:
    """Runs of lines that hold nothing but a link; code is taken out before runs are formed."""
    return op.link_runs(b.flagged(spark, d, True)).where(F.col("length") >= LINK_RUN)


@query("w10_link_lines", LA + f", {_RUNS} select length, count(*) as runs from lr group by length")
def w10_lines(spark: SparkSession, d: str) -> DataFrame:
    """All runs of link lines by their length, also those too short to count."""
    return op.link_runs(b.flagged(spark, d, True)).groupBy("length").agg(F.count("*").alias("runs"))


@query("w11_repeat_lines", L + ", x as (select doc_id, line_no, trim(line) as t from l where length(trim(line)) >= 30), n as (select *, row_number() over (partition by doc_id, t order by line_no) as rn from x) select doc_id, min(line_no) as first_line, min(line_no) filter (where rn = 2) as second_line, count(*) as times from n group by doc_id, t having count(*) > 1")
def w11(spark: SparkSession, d: str) -> DataFrame:
    return op.repeated(b.lines(spark, d))


@query("f23_corruption", L + rf" select doc_id, line_no, rule, severity from (select doc_id, line_no, unnest(list_filter([case when regexp_matches(line, '{op.LEAK}') then 'token_leak' end, case when regexp_matches(line, '{op.MASH}') then 'url_mash' end, case when regexp_matches(line, '[\x{{e200}}-\x{{e201}}]') then 'private_use' end, case when regexp_matches(line, '[Ѐ-ӿ]') then 'cyrillic' end], lambda x: x is not null)) as rule from l) join (values ('token_leak', 'error'), ('private_use', 'error'), ('url_mash', 'warning'), ('cyrillic', 'warning')) as v(r, severity) on rule = r")
def f23(spark: SparkSession, d: str) -> DataFrame:
    hit = F.array_compact(F.array(F.when(F.col("line").rlike(op.LEAK), "token_leak"), F.when(F.col("line").rlike(op.MASH), "url_mash"), F.when(F.col("line").rlike("[\\x{e200}-\\x{e201}]"), "private_use"), F.when(F.col("line").rlike("[Ѐ-ӿ]"), "cyrillic")))
    rules = b.lines(spark, d).select("doc_id", "line_no", F.explode(hit).alias("rule"))
    return rules.withColumn("severity", F.when(F.col("rule").isin("token_leak", "private_use"), "error").otherwise("warning"))


@query("f24_gaps", LA + rf", x as (select doc_id, line_no, regexp_replace(line, '`+[^`\n]*`+', '', 'g') as line from l where not code) select doc_id, line_no, len(regexp_extract_all(line, '{op.GAP}')) as markers, regexp_matches(lower(line), '{op.TEXT_REFERENCE}') as reference from x where regexp_matches(line, '{op.GAP}') or regexp_matches(lower(line), '{op.TEXT_REFERENCE}')")
def f24(spark: SparkSession, d: str) -> DataFrame:
    """Gap markers and references without a target, outside code and inline code; one row a line."""
    x = b.flagged(spark, d, True).where("not code").withColumn("line", F.regexp_replace("line", "`+[^`\\n]*`+", ""))
    marker, reference = F.col("line").rlike(op.GAP), F.lower("line").rlike(op.TEXT_REFERENCE)
    return x.where(marker | reference).select("doc_id", "line_no", F.regexp_count("line", F.lit(op.GAP)).cast("bigint").alias("markers"), reference.alias("reference"))


#: The day that ages are counted to; queries over fixed tables need a fixed one.
NOW = "2025-01-01"
_DAY = "coalesce(try_cast(substr(json_extract_string(frontmatter, '$.updated'), 1, 10) as date), try_cast(substr(json_extract_string(frontmatter, '$.created'), 1, 10) as date))"


@query("f25_stale", LA + rf", y as (select doc_id, min(regexp_extract(lower(regexp_replace(line, '`+[^`\n]*`+', '', 'g')), '{op.STALE}', 2)::int) as year from l where not code and regexp_matches(lower(regexp_replace(line, '`+[^`\n]*`+', '', 'g')), '{op.STALE}') group by 1), a as (select c.doc_id, datediff('day', {_DAY}, date '{NOW}') as age, y.year from c left join y on c.doc_id = y.doc_id) select doc_id, age, year, coalesce(age > 365, false) as old, coalesce(year < {NOW[:4]} - 2, false) as old_mark from a where age is not null or year is not null")
def f25(spark: SparkSession, d: str) -> DataFrame:
    """Age by the last update, else by creation, and the earliest year that a mark such as 'as of 2019' names outside code."""
    get = lambda k: F.try_to_date(F.substring(F.get_json_object("frontmatter", f"$.{k}"), 1, 10), "yyyy-MM-dd")
    x = b.cleaned(spark, d, False).select("doc_id", F.datediff(F.lit(NOW).cast("date"), F.coalesce(get("updated"), get("created"))).cast("bigint").alias("age"))
    low = F.lower(F.regexp_replace("line", "`+[^`\\n]*`+", ""))
    y = b.flagged(spark, d, True).where(~F.col("code") & low.rlike(op.STALE)).groupBy("doc_id").agg(F.min(F.regexp_extract(low, op.STALE, 2).cast("int")).alias("year"))
    out = x.join(y, "doc_id", "left").where("age is not null or year is not null")
    no = lambda c: F.coalesce(c, F.lit(False))
    return out.select("doc_id", "age", "year", no(F.col("age") > 365).alias("old"), no(F.col("year") < int(NOW[:4]) - 2).alias("old_mark"))


#: Signs of a cookie notice and of calls to click.
CONSENT, CALL = "verwendet cookies|cookie-einstellung|nutzung von cookies", "click here|weiterlesen|mehr erfahren|hier klicken"
_NAV = "not starts_with(trim(line), '|') and len(string_split(line, '|')) > 2 and len(list_filter(string_split(line, '|'), lambda x: trim(x) <> '')) between 3 and 6 and len(list_filter(string_split(line, '|'), lambda x: length(trim(x)) > 20)) = 0"


@query("f26_boilerplate", LA + f", {_RUNS}, sg as (select doc_id, line_no, 'consent' as signal from l where not code and regexp_matches(lower(line), '{CONSENT}') union all select doc_id, line_no, 'cta' from l where not code and regexp_matches(lower(line), '{CALL}') union all select doc_id, line_no, 'nav' from l where not code and {_NAV} union all select doc_id, first_line, 'link-run' from lr where length >= {LINK_RUN}), ok as (select doc_id from sg group by 1 having count(*) filter (where signal = 'consent') > 0 or count(distinct signal) >= 2) select doc_id, line_no, signal from sg where doc_id in (select doc_id from ok)")
def f26(spark: SparkSession, d: str) -> DataFrame:
    """Signs of boilerplate, of records that have a cookie notice or two kinds of sign; a single weak sign is none."""
    x = b.flagged(spark, d, True)
    return op.boilerplate(x, CONSENT, CALL, LINK_RUN)


_META = lambda k: f"trim(coalesce(json_extract_string(frontmatter, '$.{k}'), '')) = ''"


@query("f28_fragments", LA + f", h as (select distinct doc_id from l where not code and {_HEAD}) select doc_id, {b.sql_words('body')} as words, case when {_META('title')} then 'title' else 'summary' end as lacks from c where body is not null and {b.sql_words('body')} < {FRAGMENT_WORDS} and doc_id not in (select doc_id from h) and coalesce(json_extract_string(frontmatter, '$.type'), '') <> 'gedanke' and ({_META('title')} or {_META('summary')})")
def f28(spark: SparkSession, d: str) -> DataFrame:
    """Records of few words without heading and without title or summary that are not marked as thoughts."""
    empty = lambda k: F.trim(F.coalesce(F.get_json_object("frontmatter", f"$.{k}"), F.lit(""))) == ""
    short = b.cleaned(spark, d).where("body is not null").withColumn("words", b.words("body")).where(F.col("words") < FRAGMENT_WORDS)
    short = short.where((F.coalesce(F.get_json_object("frontmatter", "$.type"), F.lit("")) != "gedanke") & (empty("title") | empty("summary")))
    heads = b.flagged(spark, d, True).where(~F.col("code") & F.col("line").rlike(op.HEADING)).select("doc_id").distinct()
    return short.join(heads, "doc_id", "left_anti").select("doc_id", "words", F.when(empty("title"), "title").otherwise("summary").alias("lacks"))


_N = r"len(regexp_extract_all(body, '{}'))"


@query("f18_metrics", b.with_(b.C) + f"select doc_id, {b.sql_words('body')} as words, length(body) as chars, {_N.format('(?m)^#{1,6}[ \t]')} as headings, {_N.format('(?m)^(```|~~~)')} // 2 as fences, {_N.format('(?m)^[|]')} as table_lines, {_N.format('[[][[][^]]+[]][]]')} as wikilinks, {_N.format('(?m)^> [[]!')} as callouts from c where body is not null")
def f18(spark: SparkSession, d: str) -> DataFrame:
    n = lambda p: F.regexp_count("body", F.lit(p)).cast("bigint")
    return b.cleaned(spark, d).where("body is not null").select("doc_id", b.words("body").alias("words"), F.length("body").cast("bigint").alias("chars"), n("(?m)^#{1,6}[ \t]").alias("headings"), F.floor(n("(?m)^(```|~~~)") / 2).alias("fences"), n("(?m)^[|]").alias("table_lines"), n(r"\[\[[^\]]+\]\]").alias("wikilinks"), n(r"(?m)^> \[!").alias("callouts"))


_LK = r"regexp_replace(body, '!\[[^\]]*\]\([^)]*\)|!\[\[[^\]]*\]\]', '', 'g')"


@query("f10_links", b.with_(b.C) + rf", x as (select doc_id, {_LK} as t from c where body is not null) select doc_id, len(regexp_extract_all(t, '\[[^\]]+\]\([^)]+\)')) as links, len(regexp_extract_all(t, '\[\[[^\]|]+(\|[^\]]*)?\]\]')) as wikilinks, coalesce(regexp_extract_all(t, '\[([^\]]+)\]\(([^)]+)\)', 2)[1], '') as first_target from x")
def f10(spark: SparkSession, d: str) -> DataFrame:
    x = b.cleaned(spark, d).where("body is not null").select("doc_id", F.regexp_replace("body", r"!\[[^\]]*\]\([^)]*\)|!\[\[[^\]]*\]\]", "").alias("t"))
    first = F.regexp_extract_all("t", F.lit(r"\[([^\]]+)\]\(([^)]+)\)"), F.lit(2))
    return x.select("doc_id", F.regexp_count("t", F.lit(r"\[[^\]]+\]\([^)]+\)")).cast("bigint").alias("links"), F.regexp_count("t", F.lit(r"\[\[[^\]|]+(\|[^\]]*)?\]\]")).cast("bigint").alias("wikilinks"), F.coalesce(F.get(first, F.lit(0)), F.lit("")).alias("first_target"))


@query("f11_embeds", b.with_(b.C) + r"select doc_id, unnest(regexp_extract_all(body, '!\[\[([^\]|]+)(\|[^\]]*)?\]\]', 1)) as target from c")
def f11(spark: SparkSession, d: str) -> DataFrame:
    return b.cleaned(spark, d).select("doc_id", F.explode(F.regexp_extract_all("body", F.lit(r"!\[\[([^\]|]+)(\|[^\]]*)?\]\]"), F.lit(1))).alias("target"))


@query("f22_inline_code", b.with_(b.C) + "select doc_id, length(body) - length(regexp_replace(body, '`+[^`\n]*`+', '', 'g')) as masked from c where body is not null")
def f22(spark: SparkSession, d: str) -> DataFrame:
    return b.cleaned(spark, d).where("body is not null").select("doc_id", (F.length("body") - F.length(F.regexp_replace("body", "`+[^`\n]*`+", ""))).cast("bigint").alias("masked"))


@query("f19_norm_paragraph", b.with_(b.C) + r", p as (select doc_id, unnest(string_split_regex(body, '\n[ \t]*\n+')) as p from c where body is not null), x as (select doc_id, lower(trim(regexp_replace(p, '[ \t\n]+', ' ', 'g'), E' \t.,;:!?''" + '"' + r"')) as t from p) select t, count(distinct doc_id) as docs, count(*) as times from x where length(t) >= 40 group by t having count(distinct doc_id) > 3")
def f19(spark: SparkSession, d: str) -> DataFrame:
    p = b.cleaned(spark, d).where("body is not null").select("doc_id", F.explode(F.split("body", r"\n[ \t]*\n+", -1)).alias("p"))
    t = F.lower(F.trim(F.regexp_replace("p", r"[ \t\n]+", " "), F.lit(" \t.,;:!?'\"")))
    return p.select("doc_id", t.alias("t")).where("length(t) >= 40").groupBy("t").agg(F.count_distinct("doc_id").alias("docs"), F.count("*").alias("times")).where("docs > 3")
