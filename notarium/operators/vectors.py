"""Vector operators: search in blocks, similarity by group, histograms, threshold sweeps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep, ship
from . import graph

#: Vectors of a query block, in bytes: a block is what each task holds besides a batch of the searched rows.
BLOCK_BYTES = 16 << 20
#: Rows of a block where all vectors meet all others.
PAIR_BLOCK = 1024


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)


def _score(block, theta: float, nearest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qi, qv = block.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ri, s = batch.column(0).to_numpy(), qv @ _matrix(batch).T
            s[qi[:, None] == ri[None, :]] = -2.0  # a vector is no neighbour of itself
            if nearest:  # the best of a batch for each query, ties by the least id
                near = np.round(s, 9)
                best = near.max(1)
                c = np.where(near == best[:, None], ri[None, :], np.iinfo(np.int64).max).argmin(1)
                a = np.flatnonzero(best >= theta - 1e-9)
                c = c[a]
            else:
                a, c = np.nonzero(s >= theta - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(qi[a]), pa.array(ri[c]), pa.array(s[a, c])], ["query_id", "vec_id", "cosine"])

    return run


def search(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, theta: float, nearest: bool = False) -> DataFrame:
    """(query_id, vec_id, cosine) of every vector within theta of a stated query set, exactly; with ``nearest`` the best of each batch only.

    The queries are broadcast in blocks of BLOCK_BYTES; for each block one scan over the searched rows
    multiplies batch by batch, so nothing is shuffled and no row is copied.  Vectors are unit length; null
    vectors are left out; a vector is no neighbour of itself.
    """
    spark = vectors.sparkSession
    ship(spark)
    plain = lambda df: df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    schema = "query_id bigint, vec_id bigint, cosine double"
    q, r = keep(plain(queries)), plain(vectors)
    n, width = q.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], schema)
    blocks = -(-n * width * 8 // BLOCK_BYTES)
    out = None
    for k in range(blocks):
        rows = q.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).toArrow()  # about BLOCK_BYTES
        ids, values = rows.column(0).to_numpy(), rows.column(1).combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        found = r.mapInArrow(_score(spark.sparkContext.broadcast((ids, values)), theta, nearest), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _score_blocks(theta: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vecs, first = [], [], []
        for b in batches:
            ids.append(b.column("id").to_numpy())
            vecs.append(b.column("v").flatten().to_numpy().reshape(b.num_rows, -1))
            first.append(b.column("first").to_numpy(zero_copy_only=False))
        i, v, left = np.concatenate(ids), np.concatenate(vecs), np.concatenate(first)
        right = ~left
        if not right.any():  # a block with itself
            right = left
        elif not left.any():
            return
        s = v[left] @ v[right].T
        x, y = np.nonzero(s >= theta - 1e-9)
        a, b = i[left][x], i[right][y]
        keep = a < b if right is left else a != b
        a, b, s = a[keep], b[keep], s[x, y][keep]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(s)], ["a", "b", "cosine"])

    return run


def all_pairs(vectors: DataFrame, id_col: str, vec_col: str, theta: float) -> DataFrame:
    """(a, b, cosine) of every two vectors within theta, a < b, exactly.

    All rows fall into blocks by a hash of the id; each two blocks meet once, as
    a matrix product.  Vectors are unit length; null vectors are left out.
    """
    ship(vectors.sparkSession)
    v = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    blocks = max(1, -(-v.count() // PAIR_BLOCK))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks))
    met = v.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    met = met.select(F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") <= F.col("other")).alias("first"), "id", "v")
    return met.groupBy("p", "q").applyInArrow(_score_blocks(theta), "a bigint, b bigint, cosine double")


def all_pairs_by_key(vecs: DataFrame, theta: float) -> DataFrame:
    """(a, b, embedding) of (doc_id, v): every two within theta, a < b, whatever the type of the key; vectors of any length."""
    from .corpus import numbered

    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    names = keep(numbered(vecs, "doc_id"))
    unit = vecs.where("v is not null").join(names, "doc_id").withColumn("_size", size).where("_size > 0").select("n", F.transform("v", lambda x: x.cast("double") / F.col("_size")).alias("v"))
    met = all_pairs(keep(unit), "n", "v", theta).where(F.col("cosine") >= theta)
    a, b = names.select(F.col("doc_id").alias("a"), F.col("n").alias("_a")), names.select(F.col("doc_id").alias("b"), F.col("n").alias("_b"))
    return met.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("cosine").alias("embedding")).join(a, "_a").join(b, "_b").select("a", "b", "embedding")


def classes(vectors: DataFrame, pairs: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(node, component): one row a vector, with the least vector it is connected with; one without pairs is its own."""
    nodes = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("node")).distinct()
    return nodes.join(graph.components(pairs, "a", "b"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def mean_similarity(df: DataFrame, group: str, vec_col: str) -> DataFrame:
    """(group, n, mean): the mean cosine of all pairs of a group, from the length of the sum of its vectors, made unit length; 0 for fewer than two."""
    size = F.sqrt(F.aggregate(vec_col, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = df.where(F.col(vec_col).isNotNull()).withColumn("_size", size).withColumn(vec_col, F.transform(vec_col, lambda x: x.cast("double") / F.col("_size")))
    parts = unit.select(group, F.posexplode(vec_col).alias("i", "x")).groupBy(group, "i").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count("*").alias("n"))
    length = parts.groupBy(group).agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.max("n").alias("n"))
    return length.select(group, "n", F.round(F.when(F.col("n") > 1, (F.col("ss") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).otherwise(0.0), 4).alias("mean"))


def histogram(pairs: DataFrame, c: str, bins: int = 10) -> DataFrame:
    """(bin, pairs) of [k / bins, (k + 1) / bins), the last closed; negative values are in none."""
    k = F.least(F.floor(F.col(c) * bins), F.lit(bins - 1))
    return pairs.where(F.col(c) >= 0).groupBy(k.cast("bigint").alias("bin")).agg(F.count("*").alias("pairs"))


def sweep(pairs: DataFrame, c: str, thresholds: list[float], node: str) -> DataFrame:
    """(theta, edges, nodes) at each threshold in one pass."""
    t = pairs.withColumn("theta", F.explode(F.filter(F.array(*map(F.lit, thresholds)), lambda x: F.col(c) >= x)))
    return t.groupBy("theta").agg(F.count("*").alias("edges"), F.count_distinct(node).alias("nodes"))


def simulate(vectors: DataFrame, pairs: DataFrame, id_col: str, vec_col: str, thresholds: list[float], least: int = 3) -> DataFrame:
    """(theta, clusters, top_size, mean_size, unsorted_pct): the components at each threshold, all in one pass.

    ``pairs`` has (a, b, cosine) of every two vectors within the least
    threshold. A cluster has ``least`` members or more, two at least; the share of vectors in
    none is in per cent. A node is a vector at a threshold.
    """
    steps = F.array(*map(F.lit, thresholds))
    at = lambda c: F.struct("theta", F.col(c).alias("id")).alias(c)
    links = pairs.withColumn("theta", F.explode(F.filter(steps, lambda x: F.col("cosine") >= x))).select(at("a"), at("b"))
    nodes = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id")).distinct()
    joined = graph.components(links, "a", "b").groupBy("component").agg(F.count("*").alias("size")).select("component.theta", "size")
    large = joined.where(F.col("size") >= least).groupBy("theta").agg(F.count("*").alias("clusters"), F.max("size").alias("top"), F.sum("size").alias("inside"))
    every = nodes.agg(F.count("*").alias("n")).withColumn("theta", F.explode(steps)).join(large, "theta", "left")
    inside = F.coalesce("inside", F.lit(0))
    return every.select(
        "theta",
        F.coalesce("clusters", F.lit(0)).alias("clusters"),
        F.coalesce("top", F.lit(0)).alias("top_size"),
        F.when(F.col("clusters") > 0, F.bround(F.col("inside") / F.col("clusters"), 1)).otherwise(0.0).alias("mean_size"),
        F.when(F.col("n") > 0, F.bround((F.col("n") - inside) / F.col("n") * 100, 1)).otherwise(0.0).alias("unsorted_pct"),
    )
