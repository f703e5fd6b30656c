"""Redundancy of documents by three measures: equal texts, TF-IDF and vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep
from . import vectors


def plain(c: str) -> Column:
    """A text with its white space collapsed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def pairs(docs: DataFrame, vecs: Callable[[DataFrame], DataFrame], id_col: str, text_col: str, least_cosine: float, band: str, near_texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b, exact, tfidf, embedding, band) of every pair that one of the measures puts into a band, a < b.

    Each measure generates its own candidates; the measures are joined on the pair, and ``band`` (an
    expression over exact, tfidf and embedding) names the strongest.  Of equal texts the least id stands for
    all: it alone has edges of TF-IDF, and each other member has one exact pair with it, so a group of
    copies is never expanded.  Null and blank texts are left out.  ``vecs`` gives the vectors (doc_id, v) of the
    ids that are left (id), ``near_texts`` the edges (a, b, similarity) of distinct texts (id, text).
    """
    # by the text as it is, as a filter on the plain one would make that twice
    texts = docs.where(F.col(text_col).rlike(r"\S")).select(F.col(id_col).alias("id"), plain(text_col).alias("text"))
    # texts are shuffled once, by id as they come; only their hashes are shuffled by what is equal, and what is no first is joined back by id
    first = F.min("id").over(Window.partitionBy("_hash"))
    later = texts.select("id", F.sha2("text", 256).alias("_hash")).select("id", first.alias("first")).where("id <> first")
    texts = keep(texts.join(later, "id", "left").select("id", "text", F.coalesce("first", "id").alias("first")), "zstd")
    same = texts.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(True).alias("exact"))
    edges = keep(near_texts(texts.where("id = first").select("id", "text")).select("a", "b", F.round("similarity", 4).alias("tfidf")))
    near = vectors.all_pairs_by_key(vecs(texts.select("id")), least_cosine)
    keys = ["a", "b"]
    out = same.join(edges, keys, "full").join(near, keys, "full")
    out = out.select("a", "b", F.coalesce("exact", F.lit(False)).alias("exact"), F.coalesce("tfidf", F.when(F.col("exact"), 1.0)).alias("tfidf"), "embedding")
    return out.withColumn("band", F.expr(band)).where("band is not null")
