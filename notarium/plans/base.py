"""Tables as the queries see them: one current row a record, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table

#: The same tables in SQL, as common table expressions.
M = """m as (select * from (select *, row_number() over (partition by doc_id order by modified_at desc nulls last, path, word_count desc nulls last, sha256 desc nulls last) as rn from manifest) where rn = 1)"""
C = """c as (select * from (select *, row_number() over (partition by doc_id order by frontmatter desc nulls last, normalized_sha256 desc nulls last, md5(body) desc nulls last) as rn from cleaned) where rn = 1)"""
S = """s as (select * from (select *, row_number() over (partition by doc_id order by title desc nulls last, case when embeds is null then 1 else 0 end, case when doc_type_guess is null then 1 else 0 end) as rn from structured) where rn = 1)"""
G = """g as (select * from (select *, row_number() over (partition by segment_id order by source_path desc nulls last) as rn from segments) where rn = 1)"""
FI = """f as (select distinct rule, lower(trim(severity)) as severity, relpath, line, message, fixable from findings)"""
LINES = """l as (select doc_id, unnest(string_split(body, chr(10))) as line, unnest(range(1, len(string_split(body, chr(10))) + 1)) as line_no from c where body is not null)"""


def _first(df: DataFrame, key: str, *order: Column) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def down(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest scan of each record."""
    return _first(table(spark, sf_dir, "manifest"), "doc_id", down("modified_at"), F.col("path"), down("word_count"), down("sha256"))


def cleaned(spark: SparkSession, sf_dir: str, bodies: bool = True) -> DataFrame:
    """One row a record.  Without ``bodies`` no text is read: all rows of a record that go first have the same front matter and hash."""
    c = table(spark, sf_dir, "cleaned")
    if not bodies:
        return _first(c.select("doc_id", "frontmatter", "normalized_sha256"), "doc_id", down("frontmatter"), down("normalized_sha256"))
    return _first(c.withColumn("_m", F.md5("body")), "doc_id", down("frontmatter"), down("normalized_sha256"), down("_m")).drop("_m")


def structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = lambda c: F.when(F.col(c).isNull(), 1).otherwise(0)
    return _first(table(spark, sf_dir, "structured"), "doc_id", down("title"), empty("embeds"), empty("doc_type_guess"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first(table(spark, sf_dir, "segments"), "segment_id", down("source_path"))


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct findings with severities in one spelling."""
    f = table(spark, sf_dir, "findings")
    return f.select("rule", F.lower(F.trim("severity")).alias("severity"), "relpath", "line", "message", "fixable").distinct()


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no from 1, line) of every body."""
    body = cleaned(spark, sf_dir).where("body is not null")
    return body.select("doc_id", F.posexplode(F.split("body", "\n", -1)).alias("p", "line")).select("doc_id", (F.col("p") + 1).cast("bigint").alias("line_no"), "line")


def _flags(name: str, opens: str, closes: str) -> str:
    """SQL of (doc_id, line_no, line, code, opener): a digit for each line of a body, 0 text, 1 code, 2 opener; the state is the run that opened the fence."""
    line = f"{{'o': {opens}, 'f': x, 't': {closes}}}"
    step = "case when x.o = '' or x.t = '' and a.o <> '' then {'o': a.o, 'f': a.f || case when a.o <> '' then '1' else '0' end, 't': ''} when a.o = '' then {'o': x.o, 'f': a.f || '2', 't': ''} when starts_with(x.t, a.o) then {'o': '', 'f': a.f || '1', 't': ''} else {'o': a.o, 'f': a.f || '1', 't': ''} end"
    return f"{name}0 as (select doc_id, string_split(body, chr(10)) as ls from c where body is not null), {name}1 as (select doc_id, ls, list_reduce(list_transform(ls, lambda x: {line}), lambda a, x: {step}, {{'o': '', 'f': '', 't': ''}}).f as marks from {name}0), {name} as (select doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as line_no, unnest(string_split(marks, '')) <> '0' as code, unnest(string_split(marks, '')) = '2' as opener from {name}1)"


#: Lines with a flag for code by the audit's fence rule (opener at the line's start, closer begins with its run).
AUDITED = _flags("l", "regexp_extract(x, '^(`{3,}|~{3,})', 1)", "case when regexp_matches(x, '^(`{3,}|~{3,})') then x else '' end")
#: The same by the rule of the normal form (may be indented, closes at a line of nothing but its character).
FENCED = _flags("l", "substr(regexp_extract(trim(x, ' ' || chr(9) || chr(13)), '^(`{3,}|~{3,})', 1), 1, 1)", "regexp_extract(trim(x, ' ' || chr(9) || chr(13)), '^(`{3,}|~{3,})$', 1)")


def flagged(spark: SparkSession, sf_dir: str, audit: bool) -> DataFrame:
    """(doc_id, line_no from 1, line, code, opener) of every body, by the audit's fence rule (which tells openers) or that of the normal form."""
    from ..functions import documents as fn

    marks = fn.audit_fence_marks if audit else fn.fence_flags

    def rows(t: str) -> list[tuple]:
        ls = t.split("\n")
        return [(i, line, mark > 0, mark == 2) for i, (line, mark) in enumerate(zip(ls, marks(ls), strict=True), 1)]

    return fn.map_texts(cleaned(spark, sf_dir).select("doc_id", "body"), "doc_id", "body", rows, "line_no bigint, line string, code boolean, opener boolean").withColumnRenamed("id", "doc_id")


def words(c: str | Column) -> Column:
    """Runs of characters that are no white space."""
    c = F.col(c) if isinstance(c, str) else c
    return F.size(F.filter(F.split(c, r"[ \t\n\r\f]+"), lambda x: x != "")).cast("bigint")


def sql_words(c: str) -> str:
    return rf"len(list_filter(string_split_regex({c}, '[ \t\n\r\f]+'), lambda x: x <> ''))"


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, tag), distinct, from the front matter."""
    t = F.from_json(F.get_json_object("frontmatter", "$.tags"), "array<string>")
    return cleaned(spark, sf_dir, False).select("doc_id", F.explode(t).alias("tag")).where("tag is not null").distinct()


TAGS = """t as (select distinct doc_id, tag from (select doc_id, unnest(from_json(json_extract(frontmatter, '$.tags'), '["VARCHAR"]')) as tag from c) where tag is not null)"""


def folder(c: str = "path") -> Column:
    return F.substring_index(c, "/", 1)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, target), distinct, of the notes' links that are no addresses."""
    s = structured(spark, sf_dir).select("doc_id", F.explode("links").alias("target"))
    return s.where("target is not null and not startswith(target, 'http')").distinct()


LINKS = """k as (select distinct doc_id, target from (select doc_id, unnest(links) as target from s) where target is not null and not starts_with(target, 'http'))"""


def with_(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "
