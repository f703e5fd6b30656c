"""Operators with controlled vocabularies: resolution of tags, drift, frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A vocabulary is kept by hand; beyond so many rows it is no longer broadcast but joined by key.
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast a dimension that is proven small, else leave the join to the planner."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def normal_tag(c: str) -> F.Column:
    """A tag in small letters, umlauts spelled out, ``_`` and spaces as ``-``, other signs dropped."""
    x = F.lower(F.trim(F.col(c)))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        x = F.replace(x, F.lit(a), F.lit(b))
    x = F.regexp_replace(F.regexp_replace(x, "[_ ]+", "-"), "[^a-z0-9-]+", "")
    return F.regexp_replace(F.regexp_replace(x, "-{2,}", "-"), "^-+|-+$", "")


def resolve(tags: DataFrame, vocabulary: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(doc_id, tag) to (doc_id, tag, canonical, status).

    vocabulary (tag); synonyms (tag, canonical) where a null canonical drops the
    tag.  A tag of the vocabulary is itself; else a synonym's; else unknown.
    """
    v = small(vocabulary.select("tag", F.lit(True).alias("_known")))
    s = small(synonyms.select("tag", "canonical", F.lit(True).alias("_synonym")))
    out = tags.join(v, "tag", "left").join(s, "tag", "left")
    status = F.when(F.col("_known"), "identity").when(F.col("_synonym") & F.col("canonical").isNull(), "dropped").when(F.col("_synonym"), "synonym").otherwise("unknown")
    return out.select("doc_id", "tag", F.when(F.col("_known"), F.col("tag")).otherwise(F.col("canonical")).alias("canonical"), status.alias("status"))


def top_in_group(df: DataFrame, group: str, item: str, k: int) -> DataFrame:
    """The k most frequent items of each group with counts, ties by item."""
    n = df.groupBy(group, item).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), item)
    return n.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def shared_items(df: DataFrame, row_id: str, item: str, least: int) -> DataFrame:
    """Pairs of item sets that share so many items, with how many rows have each set.

    Rows with the same set are one class (set_id, rows); only classes meet, by
    item, so a common set costs one row.
    """
    sets = df.groupBy(row_id).agg(F.array_join(F.array_sort(F.collect_set(item)), ",").alias("items"))
    classes = sets.groupBy("items").agg(F.count("*").alias("rows"))
    one = classes.select("items", F.explode(F.split("items", ",")).alias("item"))
    pairs = one.alias("x").join(one.alias("y"), "item").where("x.items < y.items").groupBy(F.col("x.items").alias("items_a"), F.col("y.items").alias("items_b")).agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    n = classes
    return pairs.join(n.select(F.col("items").alias("items_a"), F.col("rows").alias("rows_a")), "items_a").join(n.select(F.col("items").alias("items_b"), F.col("rows").alias("rows_b")), "items_b").select("items_a", "items_b", "shared", "rows_a", "rows_b")
