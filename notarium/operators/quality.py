"""Quality operators: defect density, structure, metadata, redundancy, links, and the two axes made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of severities, penalties and thresholds of the scores.
SEVERITY = {"error": 3.0, "warning": 1.5, "info": 0.5}
DENSITY, JUMP, SECTION, SECTION_CAP, LENGTH, DANGLING, INVALID = 6.0, 15.0, 8.0, 40.0, 12.0, 20.0, 8.0
WORDS = (80, 3000)
PRODUCTIVE, USABLE, HUB, ISLAND = 80.0, 60.0, 50.0, 20.0


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), c))


def severity_weight(c: str) -> Column:
    return reduce(lambda acc, kv: acc.when(F.col(c) == kv[0], kv[1]), list(SEVERITY.items())[1:], F.when(F.col(c) == "error", SEVERITY["error"])).otherwise(1.0)


def formal(weighted: Column, chars: Column) -> Column:
    """100 less the weighted defects per 1,000 characters; a short file counts as 1,000."""
    return clamp(F.lit(100.0) - DENSITY * weighted / F.greatest(chars / 1000.0, F.lit(1.0)))


def structure(jumps: Column, sections: Column, words: Column, cap: int = 8) -> Column:
    """Penalties for jumps of heading levels, too few or too many sections, and length."""
    most = F.greatest(F.lit(cap), F.bround(words / 120.0, 0).cast("int"))
    few = F.when(sections < 2, SECTION * (F.lit(2) - sections)).when(sections > most, F.least(F.lit(SECTION_CAP), SECTION * (sections - most))).otherwise(0.0)
    length = F.when((words < WORDS[0]) | (words > WORDS[1]), LENGTH).otherwise(0.0)
    return clamp(F.lit(100.0) - JUMP * jumps - few - length)


def metadata(required: list[Column], optional: list[Column], invalid: Column) -> Column:
    """Share of required fields (0.7) and of optional ones (0.3), less invalid values."""
    share = lambda xs: reduce(lambda a, x: a + x.cast("double"), xs, F.lit(0.0)) / len(xs)
    return clamp(100.0 * (0.7 * share(required) + 0.3 * share(optional)) - INVALID * invalid)


def linkability(out: Column, into: Column, dangling: Column) -> Column:
    """Half from links out (3 suffice), half from links in (2 suffice), less dangling ones."""
    part = lambda x, n: F.least(F.lit(1.0), x / float(n))
    return clamp(100.0 * (0.5 * part(out, 3) + 0.5 * part(into, 2)) - DANGLING * dangling)


def weighted_mean(values: list[Column], weights: list[float]) -> Column:
    """Mean over the values that are not null with their weights; 0 where all are null; two digits."""
    top = reduce(lambda a, b: a + b, (F.coalesce(v * w, F.lit(0.0)) for v, w in zip(values, weights, strict=True)))
    low = reduce(lambda a, b: a + b, (F.when(v.isNotNull(), w).otherwise(0.0) for v, w in zip(values, weights, strict=True)))
    return F.round(F.when(low > 0, top / low).otherwise(0.0), 2)


def band(c: str) -> Column:
    return F.when(F.col(c) >= PRODUCTIVE, "produktiv").when(F.col(c) >= USABLE, "nutzbar").otherwise("nacharbeit")


def tier(c: str) -> Column:
    return F.when(F.col(c) >= HUB, "hub-kandidat").when(F.col(c) < ISLAND, "insel").otherwise("verknüpfbar")


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, low, median, high) of each column without its nulls; the median of an even number is the mean of two."""
    kinds = F.stack(F.lit(len(columns)), *(x for c in columns for x in (F.lit(c), F.col(c)))).alias("dimension", "score")
    return df.select(kinds).groupBy("dimension").agg(F.min("score").alias("low"), F.round(F.percentile("score", F.lit(0.5)), 4).alias("median"), F.max("score").alias("high"))
