"""Review decisions and controlled changes of vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GATES = ["quality", "category", "tags", "final"]


def items(*gated: tuple[str, DataFrame]) -> DataFrame:
    """(item, gate, doc_id, current) of what waits at each gate; the item's id is gate::doc::current."""
    out = None
    for gate, df in gated:
        rows = df.select(F.lit(gate).alias("gate"), "doc_id", F.coalesce("current", F.lit("")).alias("current")).distinct()
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("item", F.concat_ws("::", "gate", "doc_id", "current"))


def apply(waiting: DataFrame, decided: DataFrame) -> DataFrame:
    """Add decision and value to waiting items; those without a decision stay open."""
    d = decided.where("decision is not null and decision <> ''").dropDuplicates(["item"])
    return waiting.join(d.select("item", "decision", "value"), "item", "left").withColumn("state", F.when(F.col("decision").isNull(), "open").otherwise("decided"))


def with_category(categories: DataFrame, name: str) -> DataFrame:
    """(number, name) with a new category under the next free number; a known name changes nothing."""
    new = categories.agg((F.coalesce(F.max("number"), F.lit(-1)) + 1).alias("number")).withColumn("name", F.lit(name))
    return categories.select("number", "name").unionByName(new.select("number", "name").join(categories.select("name"), "name", "left_anti").select("number", "name"))


def with_synonym(synonyms: DataFrame, tag: str, canonical: str | None) -> DataFrame:
    """(tag, canonical) with a mapping set; null drops the tag."""
    spark = synonyms.sparkSession
    return synonyms.where(F.col("tag") != tag).unionByName(spark.createDataFrame([(tag, canonical)], "tag string, canonical string"))


def enforce(drafts: DataFrame, concepts: DataFrame) -> DataFrame:
    """Draft fields as they must be: status and review status set, sources, created and updated from the concept where missing, confidence low where the title is missing."""
    c = concepts.select("doc_id", F.col("created").alias("_created"), F.col("updated").alias("_updated"))
    out = drafts.join(c, "doc_id", "left")
    return out.select("doc_id", "title", F.lit("draft").alias("status"), F.lit("ai_drafted").alias("review_status"), F.coalesce("created", "_created").alias("created"), F.coalesce("updated", "_updated").alias("updated"), F.when(F.col("title").isNull(), "low").otherwise(F.col("confidence")).alias("confidence"))


def confidence(c: str, fallback: str = "low") -> F.Column:
    """low, medium or high in one spelling; all else is the fallback."""
    x = F.lower(F.trim(F.col(c)))
    return F.when(x.isin("low", "medium", "high"), x).otherwise(fallback)
