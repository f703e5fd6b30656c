"""Problem 6: the share of a text that repeats within the text.

The share is that of a text's words in passages of six or more words that
occurred before in it (20 characters where it is mainly in a script without
spaces).  A decision list says which texts repeat, from other statistics: the
same share for three words (ten characters), the share of the most frequent
passage, repeated lines, the share of different words, and words in all.  It is
learned from a bounded sample that the share labels: rules are grown condition
by condition on two thirds of the sample, pruned on the rest, and what a rule
covers is set aside before the next is grown.  The list is applied as one
ordered conditional expression in Spark.  Its last rule is a bound: what
repeats in long passages repeats in short ones, so no case is beyond it.  An
exact check of the share follows, so a rule that reaches too far does no harm.
Thresholds lie at the edge of the rows a rule must exclude.

Null texts have null statistics and are no case; empty texts have a share of 0;
repeated rows count once; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import keep, ship, table
from .batches import slices
from .codepoints import fold_points, to_points
from .wordset import Words

PASSAGE_WORDS, PASSAGE_CHARS, SHORT_WORDS, SHORT_CHARS = 6, 20, 3, 10
LEAST_SHARE = 0.30
#: Rows of each label that the list is learned from at most.
SAMPLE_ROWS = 2000
#: What the list decides by; the share itself is not among it.
FEATURES = ["short_share", "top_share", "line_share", "variety", "words"]
STATS = "doc_id string, share double, short_share double, top_share double, line_share double, variety double, words double"


def _repeated(row: np.ndarray, begin: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which spans occurred before in their row, and how often each span's like occurs."""
    key = (row.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16))
    order = np.argsort(key, kind="stable")
    s = key[order]
    edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]])) if len(s) else np.zeros(1, np.int64)
    again = np.ones(len(s), bool)
    again[edge[:-1]] = False
    out, times = np.zeros(len(s), bool), np.zeros(len(s), np.int64)
    out[order] = again
    times[order] = np.repeat(np.diff(edge), np.diff(edge))
    return out, times


def _covered(begin: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of so many units lie in a span of the given size."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + size, -1)
    return np.cumsum(change[:-1]) > 0


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def _spans(unit_hash_at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and first unit of each span that lies in one row."""
    row = np.repeat(np.arange(len(unit_hash_at) - 1), np.diff(unit_hash_at))
    n = len(row) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(row[:n] == row[size - 1 :])
    return row[begin], begin


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        points, at = fold_points(*to_points(batch.column(1)))
        w = Words(points, at)
        n = len(at) - 1
        words = np.diff(w.word_at)
        shares = {}
        for name, size in (("share", PASSAGE_WORDS), ("short_share", SHORT_WORDS)):
            row, h = w.spans(size)
            _, begin = _spans(w.word_at, size)
            again, times = _repeated(row, begin, h)
            shares[name] = _per_row(_covered(begin[again], size, len(w.hash)), w.word_at) / np.maximum(words, 1)
            if name == "share":
                top = np.zeros(n, np.int64)
                np.maximum.at(top, row, times)
                shares["top_share"] = np.where(top > 1, np.minimum(1.0, top * size / np.maximum(words, 1)), 0.0)
        if w.dense.any():
            for name, size in (("share", PASSAGE_CHARS), ("short_share", SHORT_CHARS)):
                row, h = w.char_spans(size)
                all_row, begin = _spans(w.char_at, size)
                begin = begin[w.dense[all_row]]
                again, times = _repeated(row, begin, h)
                chars = np.diff(w.char_at)
                by_char = _per_row(_covered(begin[again], size, len(w.index)), w.char_at) / np.maximum(chars, 1)
                shares[name] = np.where(w.dense, by_char, shares[name])
                if name == "share":
                    top = np.zeros(n, np.int64)
                    np.maximum.at(top, row, times)
                    shares["top_share"] = np.where(w.dense, np.where(top > 1, np.minimum(1.0, top * size / np.maximum(chars, 1)), 0.0), shares["top_share"])
        # lines: the words of a line, in order
        line_break = np.flatnonzero(points == 10)
        if len(w.hash):
            line = np.searchsorted(line_break, w.index[w.start])
            row = np.repeat(np.arange(n), words)
            new = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])]))
            order = np.arange(len(w.hash)) - np.repeat(new, np.diff(np.append(new, len(w.hash))))
            with np.errstate(over="ignore"):
                h = np.add.reduceat(w.hash * (order.astype(np.uint64) * np.uint64(2) + np.uint64(1)), new)
            again, _ = _repeated(row[new], new, h)
            lines = np.bincount(row[new], minlength=n)
            shares["line_share"] = np.bincount(row[new], weights=again, minlength=n) / np.maximum(lines, 1)
        else:
            shares["line_share"] = np.zeros(n)
        # different words among all
        row = np.repeat(np.arange(n), words)
        key = np.sort((row.astype(np.uint64) << np.uint64(48)) | (w.hash >> np.uint64(16)))
        kinds = np.bincount((key[np.concatenate([[True], key[1:] != key[:-1]])] >> np.uint64(48)).astype(np.int64), minlength=n) if len(key) else np.zeros(n)
        shares["variety"], shares["words"] = kinds / np.maximum(words, 1), words
        names = ["share", *FEATURES]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), *(pa.array(np.asarray(shares[k], np.float64)) for k in names)], ["doc_id", *names])


def statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Repetition statistics of each text that is not null."""
    ship(df.sparkSession)
    return df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null").mapInArrow(_stats, STATS)


@dataclass
class Rule:
    """A conjunction of (feature, is at least, threshold)."""

    conditions: list[tuple[str, bool, float]]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, least, t in self.conditions:
            out &= x[name] > t if least else x[name] <= t
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, least, t in self.conditions:
            out = out & ((F.col(name) > t) if least else (F.col(name) <= t))
        return out


def _grow(x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    rule, inside = Rule([]), np.ones(len(y), bool)
    while (~y[inside]).any():
        p0, n0 = y[inside].sum(), (~y[inside]).sum()
        best = (0.0, None)
        for name in FEATURES:
            v = x[name][inside]
            order = np.argsort(v, kind="stable")
            sv, sy = v[order], y[inside][order]
            cut = np.flatnonzero(sv[1:] != sv[:-1])  # between cut and cut + 1
            if not len(cut):
                continue
            below_p = np.cumsum(sy)[cut]
            below_n = (cut + 1) - below_p
            for least, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-12:
                    # the value at the excluded side: nothing beyond it is shut out
                    best = (float(gain[k]), (name, least, float(sv[cut[k]])))
        if best[1] is None:
            break
        rule.conditions.append(best[1])
        inside = rule.holds(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = r.holds(x)
        p, n = (y & hit).sum(), (~y & hit).sum()
        return (p - n) / max(p + n, 1)

    best, kept = worth(rule), len(rule.conditions)
    for k in range(len(rule.conditions) - 1, 0, -1):
        v = worth(Rule(rule.conditions[:k]))
        if v >= best:
            best, kept = v, k
    return Rule(rule.conditions[:kept])


def learn(x: dict[str, np.ndarray], y: np.ndarray, most_rules: int = 8) -> list[Rule]:
    """A decision list for the positive label by sequential covering; ends when a pruned rule is wrong more often than right."""
    n = len(y)
    part = np.arange(n) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(n, bool)
    while len(rules) < most_rules and (y & left).any():
        grow, prune = left & ~part, left & part
        if not (y & grow).any():
            grow = left
        rule = _grow({k: v[grow] for k, v in x.items()}, y[grow])
        if (y & prune).any() and len(rule.conditions) > 1:
            rule = _prune(rule, {k: v[prune] for k, v in x.items()}, y[prune])
        hit = rule.holds(x) & left
        if not rule.conditions or (y & hit).sum() <= (~y & hit).sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def decision(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: the number of the rule that holds, 0 for none."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r.column(), i) if out is None else out.when(r.column(), i)
    return F.lit(0) if out is None else out.otherwise(0)


def fit(stats: DataFrame, least: float = LEAST_SHARE, sample: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list from at most ``sample`` rows of each label, chosen by a hash of the id."""
    by = F.xxhash64("doc_id")
    rows = []
    for label in (f"share >= {least}", f"share < {least}"):
        rows += stats.where(label).orderBy(by, "doc_id").limit(sample).collect()  # a bounded sample
    x = {k: np.array([r[k] for r in rows], float) for k in FEATURES}
    y = np.array([r["share"] >= least for r in rows], bool)
    rules = learn(x, y) if y.any() and (~y).any() else []
    return [*rules, Rule([("short_share", True, float(np.nextafter(least, 0)))])]  # a share of long passages is one of short ones


def labelled(df: DataFrame, id_col: str, text_col: str, least: float = LEAST_SHARE) -> DataFrame:
    """Statistics, the number of the rule that holds, and the exact answer."""
    stats = keep(statistics(df, id_col, text_col))
    return stats.withColumn("rule", decision(fit(stats, least))).withColumn("repetitive", (F.col("rule") > 0) & (F.col("share") >= least))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of bodies of whose words at least 0.30 repeat."""
    return labelled(table(spark, sf_dir, "cleaned"), "doc_id", "body").where("repetitive and doc_id is not null").select("doc_id").distinct()


def p6_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every body."""
    return labelled(table(spark, sf_dir, "cleaned"), "doc_id", "body").distinct()


QUERIES = {"p6_found": p6_found, "p6_shares": p6_shares}
SQL: dict[str, str] = {}
