"""Problem 9: records of several sources mixed to target weights.

Temperature mixing.  The weight of a source is its target share to an exponent
times its own token share to the rest, made to sum to one: exponent 1 gives the
targets, 0 the sources as they are.  The exponent is bisected down from 1 until
no source repeats more often than it may at the wanted total.  Without a total,
targets come first: the total itself is bisected to the largest at which the
repetition limits hold at exponent 1.  (With an entropy as target,
``exponent_for_entropy`` bisects the exponent of the token shares.)

The weights are realised as budgeted block permutations: the records of a
source have an order by a hash of id and pass, cut into blocks.  Whole passes
take everything; the last pass takes whole blocks while they fit and of the
next one the records in order, the last of them if half of it fits or more, so a
source misses its budget by half a record at most.  Only block totals are summed up, so a
source with a third of all rows is no single task.

Source names are compared without case and padding and with ``_`` as ``-``.
Records with a null source, of a source without target, or without tokens are
not drawn; a source without documents leaves its share to the others in
proportion.  Ties of the hash go by id; repeated rows count as often as they
occur; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import keep, table
from .tokens import token_sizes

BLOCKS = 256
PLAN = "source string, target_share double, max_repeats int, source_tokens bigint, weight double, budget bigint, passes int, rest bigint"


def plain_source(c: str) -> Column:
    """A source's name in one spelling."""
    return F.regexp_replace(F.lower(F.trim(c)), "_", "-")


def entropy(shares: list[float]) -> float:
    return -sum(p * math.log(p) for p in shares if p > 0)


def tempered(shares: list[float], exponent: float, other: list[float] | None = None) -> list[float]:
    """Shares to an exponent (times others to the rest), made to sum to one."""
    raw = [p**exponent * (q ** (1 - exponent) if other else 1.0) if p > 0 else 0.0 for p, q in zip(shares, other or shares, strict=True)]
    total = sum(raw)
    return [x / total for x in raw] if total else raw


def bisect(ok, low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The largest exponent between low and high for which ok holds, given that it holds at low."""
    if ok(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if ok(mid) else (low, mid)
    return low


def exponent_for_entropy(shares: list[float], wanted: float) -> float:
    """The exponent at which the tempered shares have the wanted entropy; flatter shares need a smaller one."""
    return bisect(lambda a: entropy(tempered(shares, a)) >= wanted)


def plan(tokens: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> list[tuple]:
    """One row for each target: source, share, repeats, tokens there are, weight, budget, whole passes, rest."""
    have = [s for s in sorted(targets) if tokens.get(s, 0) > 0 and targets[s][0] > 0]
    if not have:
        return [(s, *targets[s], tokens.get(s, 0), 0.0, 0, 0, 0) for s in sorted(targets)]
    aim = tempered([targets[s][0] for s in have], 1.0)
    own = tempered([float(tokens[s]) for s in have], 1.0)
    limit = [tokens[s] * targets[s][1] for s in have]

    def fits(a: float, size: float) -> bool:
        """Whether no source repeats too often."""
        return all(size * w <= cap * (1 + 1e-12) for w, cap in zip(tempered(aim, a, own), limit, strict=True))

    if total is None:
        total = int(bisect(lambda size: fits(1.0, size), 0.0, float(sum(limit)), 80))
    exponent = bisect(lambda a: fits(a, total)) if fits(0.0, total) or fits(1.0, total) else 0.0
    weights = dict(zip(have, tempered(aim, exponent, own), strict=True))
    out = []
    for s in sorted(targets):
        w = weights.get(s, 0.0)
        budget = min(int(total * w + 0.5), tokens.get(s, 0) * targets[s][1])
        passes, rest = divmod(budget, tokens[s]) if w else (0, 0)
        out.append((s, float(targets[s][0]), int(targets[s][1]), tokens.get(s, 0), w, budget, passes, rest))
    return out


def draw(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens) and (source, target_share, max_repeats) to the drawn records and the plan."""
    spark = sizes.sparkSession
    rows = sizes.where("source is not null and tokens > 0")
    goal = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.where("source is not null and target_share is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats")).collect()}  # one row a target
    have = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("tokens").alias("n")).where(F.col("source").isin(list(goal))).collect()}  # one row a target at most
    planned = spark.createDataFrame(plan(have, goal, total), PLAN)
    wanted = rows.join(F.broadcast(planned.where("budget > 0").select("source", "passes", "rest")), "source")
    whole = wanted.where("passes > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("pass_no"), "tokens")
    last = wanted.where("rest > 0").withColumn("order", F.xxhash64("doc_id", F.col("passes") + 1)).withColumn("block", F.pmod(F.shiftrightunsigned("order", 40), F.lit(BLOCKS)).cast("int"))
    blocks = last.groupBy("source", "block").agg(F.sum("tokens").alias("n"))
    by_block = Window.partitionBy("source").orderBy("block")  # BLOCKS rows a source
    begun = F.broadcast(blocks.withColumn("before", F.sum("n").over(by_block) - F.col("n")).select("source", "block", "before", "n"))
    placed = last.join(begun, ["source", "block"])
    full = placed.where("before + n <= rest").select("doc_id", "source", (F.col("passes") + 1).alias("pass_no"), "tokens")
    inside = Window.partitionBy("source", "block").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.where("before < rest and before + n > rest").withColumn("upto", F.col("before") + F.sum("tokens").over(inside)).where("2 * upto - tokens <= 2 * rest").select("doc_id", "source", (F.col("passes") + 1).alias("pass_no"), "tokens")
    return whole.unionByName(full).unionByName(edge), planned


def _drawn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, sf_dir, "documents").select("doc_id", plain_source("source").alias("source"), "text")
    targets = table(spark, sf_dir, "mix_targets").select(plain_source("source").alias("source"), "target_share", "max_repeats")
    return draw(keep(token_sizes(documents, ["doc_id", "source"], "text")), targets)


def p9_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn records: doc_id, source, number of the pass, tokens."""
    return _drawn(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share, tokens drawn and most repeats of each source."""
    drawn, planned = _drawn(spark, sf_dir)
    by = drawn.groupBy("source").agg(F.sum("tokens").alias("drawn_tokens"), F.max("pass_no").alias("repeats"), F.count("*").alias("records"))
    whole = Window.partitionBy(F.lit(0))  # one row a target
    out = planned.join(by, "source", "left").withColumn("all_tokens", F.sum("drawn_tokens").over(whole))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("source", "target_share", "max_repeats", "source_tokens", none("drawn_tokens"), none("records"), none("repeats"), F.round(F.coalesce(F.col("drawn_tokens") / F.col("all_tokens"), F.lit(0.0)), 6).alias("actual_share"))


QUERIES = {"p9_drawn": p9_drawn, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
