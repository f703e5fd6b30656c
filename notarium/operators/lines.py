"""Operators over line tables (doc_id, line_no, line): islands, fill-forward, repeats, marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Patterns of audit rules.
HEADING = r"^#{1,6}[ \t]+[^ \t]"
LINK_ONLY = r"^[-*]?[ \t]*(!?\[\[[^\]]+\]\]|\[[^\]]+\]\([^)]+\)|https?://[^ ]+)[ \t]*$"
GAP = r"\b(TODO|TBD|FIXME)\b|\?\?\?|[<\[](\.\.\.|…)[>\]]"
TEXT_REFERENCE = r"\bsiehe[ \t]+(oben|unten|abschnitt[ \t]+[0-9]+|kapitel[ \t]+[0-9]+)\b"
STALE = r"\b(stand|as of)\b.{0,24}?([0-9]{4})"
LEAK = r"turn[0-9]+(view|search)[0-9]+"
MASH = r"<[^>]+>https?://"
SETEXT = r"^(={3,}|-{3,})[ \t]*$"


def by_doc() -> Window:
    return Window.partitionBy("doc_id").orderBy("line_no")


def blank(c: str = "line") -> Column:
    return F.trim(c) == ""


def islands(lines: DataFrame, inside: Column) -> DataFrame:
    """(doc_id, first_line, length) of each run of consecutive lines for which ``inside`` holds."""
    marked = lines.where(inside).withColumn("_g", F.col("line_no") - F.row_number().over(by_doc()))
    return marked.groupBy("doc_id", "_g").agg(F.min("line_no").alias("first_line"), F.count("*").alias("length")).drop("_g")


def section_of(lines: DataFrame) -> DataFrame:
    """Add ``section``: the text of the last heading above or at the line, in small letters; lines of code are none."""
    head = F.when(~F.col("code") & F.col("line").rlike(HEADING), F.lower(F.trim(F.regexp_replace("line", "^#+[ \t]+", ""))))
    return lines.withColumn("section", F.last(head, ignorenulls=True).over(by_doc().rowsBetween(Window.unboundedPreceding, 0)))


def capped_blanks(lines: DataFrame, most: int = 3) -> DataFrame:
    """(doc_id, dropped, longest): blank lines beyond ``most`` in a run, and the longest run."""
    runs = islands(lines, F.trim(F.translate("line", "\t\r", "  ")) == "")
    return runs.groupBy("doc_id").agg(F.sum(F.greatest(F.col("length") - most, F.lit(0))).alias("dropped"), F.max("length").alias("longest"))


def link_runs(lines: DataFrame) -> DataFrame:
    """(doc_id, first_line, length) of runs of link lines; what is code (``code``) is taken out before runs are formed."""
    shown = lines.where("not code").withColumn("_k", F.row_number().over(by_doc()))
    hit = shown.where(F.trim("line").rlike(LINK_ONLY)).withColumn("_g", F.col("_k") - F.row_number().over(Window.partitionBy("doc_id").orderBy("_k")))
    return hit.groupBy("doc_id", "_g").agg(F.min("line_no").alias("first_line"), F.count("*").alias("length")).drop("_g")


def nav_line(c: str = "line") -> Column:
    """A menu: two bars or more, no table row, three to six labels of up to 20 characters."""
    labels = F.filter(F.transform(F.split(c, r"\|", -1), lambda x: F.trim(x)), lambda x: x != "")
    return ~F.startswith(F.trim(c), F.lit("|")) & (F.size(F.split(c, r"\|", -1)) > 2) & F.size(labels).between(3, 6) & F.forall(labels, lambda x: F.length(x) <= 20)


def boilerplate(lines: DataFrame, consent: str, call: str, run: int) -> DataFrame:
    """(doc_id, line_no, signal) of documents with a consent sign or two kinds of sign."""
    shown, low = lines.where("not code"), F.lower("line")
    kinds = F.array_compact(F.array(F.when(low.rlike(consent), "consent"), F.when(low.rlike(call), "cta"), F.when(nav_line(), "nav")))
    signals = shown.select("doc_id", "line_no", F.explode(kinds).alias("signal")).unionByName(link_runs(lines).where(F.col("length") >= run).select("doc_id", F.col("first_line").alias("line_no"), F.lit("link-run").alias("signal")))
    enough = signals.groupBy("doc_id").agg(F.count_if(F.col("signal") == "consent").alias("c"), F.count_distinct("signal").alias("k")).where("c > 0 or k >= 2").select("doc_id")
    return signals.join(enough, "doc_id", "left_semi")


def repeated(lines: DataFrame, least: int = 30) -> DataFrame:
    """(doc_id, first_line, second_line, times) of long lines that a document repeats."""
    x = lines.where(F.length(F.trim("line")) >= least).select("doc_id", "line_no", F.trim("line").alias("_t"))
    w = Window.partitionBy("doc_id", "_t").orderBy("line_no")
    n = x.withColumn("_rn", F.row_number().over(w))
    return n.groupBy("doc_id", "_t").agg(F.min("line_no").alias("first_line"), F.min(F.when(F.col("_rn") == 2, F.col("line_no"))).alias("second_line"), F.count("*").alias("times")).where("times > 1").drop("_t")
