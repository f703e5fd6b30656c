"""Corpus operators over any DataFrame; column names are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plain_hash(c: str) -> Column:
    """A hash in one notation: small letters, no prefix; empty counts as null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(F.col(c))), "^sha256:", ""), F.lit(""))


def copies(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """One row for each member of a key that occurs more than once, with the size of its group and whether it is the first.

    The groups are never gathered: sizes come from a partial aggregate that is joined back.
    """
    n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies"), F.min(row_id).alias("_first")).where("copies > 1")
    return df.join(n, key).select(key, row_id, "copies", (F.col(row_id) == F.col("_first")).alias("is_first"))


def first_kept(df: DataFrame, key: str, order: str) -> DataFrame:
    """Add status and duplicate_of: the first row of a key by ``order`` is kept, as are rows without key."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"))
    out = df.join(first, key, "left")
    same = F.col("_first").isNull() | (F.col(order) == F.col("_first"))
    return out.withColumn("status", F.when(same, "kept").otherwise("duplicate")).withColumn("duplicate_of", F.when(F.col(order) != F.col("_first"), F.col("_first"))).drop("_first")


def mode_by(df: DataFrame, key: str, count: str, *ties: str) -> DataFrame:
    """The row of each key with the largest count, ties by the given columns."""
    w = Window.partitionBy(key).orderBy(F.desc(count), *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def index_percentiles(df: DataFrame, key: str, value: str, tie: str, points: list[float]) -> DataFrame:
    """values[min(n - 1, int(n * p))] of each key's sorted values.

    Values are counted first, so a key with many rows is a short list of
    (value, count) and the running count picks the element.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    run = Window.partitionBy(key).orderBy(value)
    total = counts.groupBy(key).agg(F.sum("_n").alias("_all"))
    upto = counts.withColumn("_upto", F.sum("_n").over(run)).join(total, key)
    wanted = upto.withColumn("p", F.explode(F.array(*map(F.lit, points)))).withColumn("_k", F.least(F.col("_all"), F.floor(F.col("_all") * F.col("p")) + 1))
    return wanted.where("_k > _upto - _n and _k <= _upto").select(key, "p", value)


def set_mark(df: DataFrame, keys: list[str], sha: str) -> DataFrame:
    """A mark of a multiset of files that does not depend on order: SHA-256 of the count, the sum and the exclusive or of their hashes' halves.

    Equal hashes do not cancel each other, as the sums and the count hold them; the parts come from partial aggregates.
    """
    half = lambda at: f"cast(conv(substr({sha}, {at}, 15), 16, 10) as decimal(38, 0))"
    parts = [F.sum(F.expr(half(1))).alias("_a"), F.sum(F.expr(half(16))).alias("_b"), F.expr(f"bit_xor(cast(conv(substr({sha}, 31, 15), 16, 10) as bigint))").alias("_c")]
    out = df.groupBy(*keys).agg(F.count("*").alias("files"), *parts)
    return out.withColumn("mark", F.substring(F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in ("files", "_a", "_b", "_c"))), 256), 1, 16)).drop("_a", "_b", "_c")


def numbered(df: DataFrame, key: str, slots: int = 64) -> DataFrame:
    """(key, n): distinct keys numbered from 0 in their order; parts of the order are numbered on their own, after what is before them."""
    ids = df.select(key).distinct().repartitionByRange(slots, key).select(key, F.spark_partition_id().alias("_p"))
    from ..session import keep

    ids = keep(ids)  # a part stays what it is
    sizes = ids.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a part
    w = Window.partitionBy("_p").orderBy(key)
    return ids.join(F.broadcast(before.select("_p", "_before")), "_p").select(key, (F.col("_before") + F.row_number().over(w) - 1).alias("n"))


def placed(df: DataFrame, key: str, order: list[Column], slots: int = 16) -> DataFrame:
    """Add ``place``, the number of each row within its key by an order without ties.

    All rows are sorted once into parts by key and order; a key that fills several parts is numbered in
    each of them, after what the parts before hold of it.  No key is a single task.
    """
    from ..session import keep

    rows = keep(df.repartitionByRange(slots, F.col(key), *order).withColumn("_p", F.spark_partition_id()))
    sizes = rows.groupBy(key, "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # ``slots`` rows a key at most
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(key, "_p").orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(inside)).join(sizes, [key, "_p"]).withColumn("place", F.col("_before") + F.col("_k")).drop("_p", "_k", "_before")


def top_terms(df: DataFrame, group: str, term: str, k: int) -> DataFrame:
    """The k terms of each group that are most its own: documents there squared over documents anywhere."""
    n = df.groupBy(group, term).agg(F.count("*").alias("docs"))
    every = n.groupBy(term).agg(F.sum("docs").alias("_all"))
    w = Window.partitionBy(group).orderBy(F.desc(F.round(F.col("docs") * F.col("docs") * F.lit(1.0) / F.col("_all"), 9)), term)
    return n.where("docs > 1").join(every, term).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).select(group, term, "docs")
