"""The audit of all bodies: one pass over a line table with fence flags, and every rule a branch of one union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import lines as op
from ..session import keep
from . import base as b
from . import lines as ln
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: Front matter that every record should have, and words of a paragraph that may repeat.
REQUIRED, LEAST_WORDS = ("title", "created"), 12
#: Sections whose links to missing notes are meant as such.
STUBS = "offene|stub|geplant|fehlend|todo"
_LINK = r"\[\[([^\]|#^]*)[^\]]*\]\]"
_BOLD = r"^#{1,6}[ \t]+.*\*\*"
_MISSING = " or ".join(f"json_extract_string(frontmatter, '$.{k}') is null" for k in REQUIRED)

_AUDIT = (
    ln.LA
    + f", {b.S}, {ln._RUNS}"
    + ", st as (select distinct split_part(title, ' ', 1) as stem from s where title is not null)"
    + rf", x as (select *, regexp_replace(line, '`+[^`\n]*`+', '', 'g') as shown, coalesce(last_value(case when not code and {ln._HEAD} then lower(trim(regexp_replace(line, '^#+[ \t]+', ''))) end ignore nulls) over w, '') as section, sum(case when not code and {ln._HEAD} then 1 else 0 end) over w as sec, lag(line) over w as above, lag(code) over w as above_code from l window w as (partition by doc_id order by line_no rows between unbounded preceding and current row))"
    + rf", tg as (select doc_id, line_no, section, trim(unnest(regexp_extract_all(shown, '{_LINK}', 1))) as target from x where not code)"
    + f", hd as (select distinct doc_id from l where not code and {ln._HEAD})"
    + f", sg as (select doc_id, line_no, 'consent' as signal from l where not code and regexp_matches(lower(line), '{ln.CONSENT}') union all select doc_id, line_no, 'cta' from l where not code and regexp_matches(lower(line), '{ln.CALL}') union all select doc_id, line_no, 'nav' from l where not code and {ln._NAV} union all select doc_id, first_line, 'link-run' from lr where length >= {ln.LINK_RUN}), ok as (select doc_id from sg group by 1 having count(*) filter (where signal = 'consent') > 0 or count(distinct signal) >= 2)"
    + r", pa as (select doc_id, lower(trim(regexp_replace(line, '[ \t]+', ' ', 'g'), ' .,;:!?''\"')) as t, line_no from l where not code), pr as (select *, row_number() over (partition by doc_id, t order by line_no) as k from pa where len(string_split(t, ' ')) > "
    + f"{LEAST_WORDS}), fd as (select doc_id, 1 as line, 'frontmatter' as rule, 'error' as severity from c where frontmatter is null or {_MISSING}"
    + f" union all select doc_id, line_no, case when regexp_matches(section, '{STUBS}') then 'wikilink-stub' else 'wikilink' end, case when regexp_matches(section, '{STUBS}') then 'info' else 'warning' end from tg where target <> '' and target not in (select stem from st)"
    + rf" union all select doc_id, line_no, 'heading-bold', 'warning' from l where not code and regexp_matches(line, '{_BOLD}')"
    + rf" union all select doc_id, line_no, 'heading-setext', 'warning' from x where not code and regexp_matches(line, '{op.SETEXT}') and not above_code and trim(above) <> '' and not regexp_matches(above, '^#{{1,6}}[ \t]+[^ \t]')"
    + " union all select doc_id, line_no, 'fence-untagged', 'warning' from l where opener and trim(ltrim(ltrim(line, '`'), '~')) = ''"
    + rf" union all select doc_id, line_no, 'token-leak', 'error' from l where regexp_matches(line, '{op.LEAK}') union all select doc_id, line_no, 'private-use', 'error' from l where regexp_matches(line, '[\x{{e200}}-\x{{e201}}]') union all select doc_id, line_no, 'url-mash', 'warning' from l where regexp_matches(line, '{op.MASH}') union all select doc_id, line_no, 'cyrillic', 'warning' from l where regexp_matches(line, '[Ѐ-ӿ]')"
    + rf" union all select doc_id, line_no, 'gap-marker', 'info' from x where not code and regexp_matches(shown, '{op.GAP}') union all select doc_id, line_no, 'gap-reference', 'info' from x where not code and regexp_matches(lower(shown), '{op.TEXT_REFERENCE}') union all select doc_id, min(line_no), 'empty-section', 'info' from x where sec > 0 group by doc_id, sec having count(*) filter (where trim(line) <> '') = 1"
    + " union all select doc_id, line_no, 'boilerplate-' || signal, 'info' from sg where doc_id in (select doc_id from ok)"
    + f" union all select doc_id, 1, 'fragment', 'info' from c where body is not null and {b.sql_words('body')} < {ln.FRAGMENT_WORDS} and doc_id not in (select doc_id from hd) and coalesce(json_extract_string(frontmatter, '$.type'), '') <> 'gedanke' and ({ln._META('title')} or {ln._META('summary')})"
    + " union all select doc_id, line_no, 'repeated-line', 'info' from pr where k = 2)"
)


def findings(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, line, rule, severity) of every rule over every body."""
    x = keep(b.flagged(spark, d, True))  # read once, used by all rules
    upto = op.by_doc().rowsBetween(Window.unboundedPreceding, 0)
    head = ~F.col("code") & F.col("line").rlike(op.HEADING)
    seen = op.section_of(x).withColumn("section", F.coalesce("section", F.lit(""))).withColumn("sec", F.sum(head.cast("int")).over(upto)).withColumn("above", F.lag("line").over(op.by_doc())).withColumn("above_code", F.lag("code").over(op.by_doc())).withColumn("shown", F.regexp_replace("line", "`+[^`\n]*`+", ""))
    text, line = ~F.col("code"), F.col("line")
    plain = ~F.col("above_code") & (F.trim("above") != "") & ~F.col("above").rlike(op.HEADING)
    untagged = F.trim(F.ltrim(F.ltrim(line, F.lit("`")), F.lit("~"))) == ""
    # rules of one line: an array of (rule, severity), exploded once
    rules = [
        (text & line.rlike(_BOLD), "heading-bold", "warning"),
        (text & line.rlike(op.SETEXT) & plain, "heading-setext", "warning"),
        (F.col("opener") & untagged, "fence-untagged", "warning"),
        (line.rlike(op.LEAK), "token-leak", "error"),
        (line.rlike("[\\x{e200}-\\x{e201}]"), "private-use", "error"),
        (line.rlike(op.MASH), "url-mash", "warning"),
        (line.rlike("[Ѐ-ӿ]"), "cyrillic", "warning"),
        (text & F.col("shown").rlike(op.GAP), "gap-marker", "info"),
        (text & F.lower("shown").rlike(op.TEXT_REFERENCE), "gap-reference", "info"),
    ]
    found = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"))) for c, r, s in rules)))
    out = seen.select("doc_id", F.col("line_no").alias("line"), F.explode(found).alias("f")).select("doc_id", "line", "f.rule", "f.severity")

    def add(rows: DataFrame, at: str, rule, severity) -> None:
        nonlocal out
        of = lambda v: v if not isinstance(v, str) else F.lit(v)
        out = out.unionByName(rows.select("doc_id", F.col(at).cast("bigint").alias("line"), of(rule).alias("rule"), of(severity).alias("severity")))

    c = b.cleaned(spark, d, False).withColumn("one", F.lit(1))
    lacks = F.col("frontmatter").isNull()
    for k in REQUIRED:
        lacks = lacks | F.get_json_object("frontmatter", f"$.{k}").isNull()
    add(c.where(lacks), "one", "frontmatter", "error")
    stems = b.structured(spark, d).where("title is not null").select(F.split("title", " ")[0].alias("target")).distinct()
    targets = seen.where(text).select("doc_id", "line_no", "section", F.explode(F.regexp_extract_all("shown", F.lit(_LINK), F.lit(1))).alias("target")).withColumn("target", F.trim("target")).where("target <> ''")
    stub = F.col("section").rlike(STUBS)
    add(targets.join(stems, "target", "left_anti"), "line_no", F.when(stub, "wikilink-stub").otherwise("wikilink"), F.when(stub, "info").otherwise("warning"))
    sections = seen.where("sec > 0").groupBy("doc_id", "sec").agg(F.min("line_no").alias("line_no"), F.count_if(~op.blank()).alias("filled")).where("filled = 1")
    add(sections, "line_no", "empty-section", "info")
    add(op.boilerplate(x, ln.CONSENT, ln.CALL, ln.LINK_RUN), "line_no", F.concat(F.lit("boilerplate-"), "signal"), "info")
    add(ln.f28(spark, d).withColumn("one", F.lit(1)), "one", "fragment", "info")
    norm = F.lower(F.trim(F.regexp_replace("line", r"[ \t]+", " "), F.lit(" .,;:!?'\"")))
    again = x.where("not code").select("doc_id", "line_no", norm.alias("t")).where(F.size(F.split("t", " ", -1)) > LEAST_WORDS)
    again = again.withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "t").orderBy("line_no"))).where("k = 2")
    add(again, "line_no", "repeated-line", "info")
    return out


@query("d15_audit", _AUDIT + " select doc_id, line, rule, severity from fd")
def d15(spark: SparkSession, d: str) -> DataFrame:
    """All findings of the audit."""
    return findings(spark, d)


@query("d15_audit_rules", _AUDIT + " select rule, severity, count(*) as findings, count(distinct doc_id) as docs from fd group by 1, 2")
def d15r(spark: SparkSession, d: str) -> DataFrame:
    return findings(spark, d).groupBy("rule", "severity").agg(F.count("*").alias("findings"), F.count_distinct("doc_id").alias("docs"))
