"""Problem 8: texts of varying length into containers of fixed capacity.

Shortest-pack-first over the length histogram.  Lengths are placed longest
first; each goes to the kind of pack that leaves the most room, and only counts
of packing patterns change, so the work depends on the capacity and not on the
number of texts.  The patterns are then joined back: the texts of a length are
numbered, and a run of numbers belongs to a run of containers.

Only texts above the capacity are cut, into pieces of the capacity and a rest.
Texts without tokens (null, empty) are in no container; equal lengths go by id;
repeated rows are packed as often as they occur; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import keep, ship, table
from .tokens import token_sizes

CAPACITY = 2048
#: Texts of one length that are numbered in one task, about; a more common length has several parts.
PART_ROWS = 500_000


def patterns(histogram: dict[int, int], capacity: int = CAPACITY, most_texts: int = 0) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, containers) of each packing pattern.

    ``most_texts`` bounds the texts of a container (0: no bound).  Every length
    is placed whole: first where the pack's rest is filled exactly, then into
    the packs with the most room left, then into new packs.
    """
    by_room: dict[int, list[list]] = {}  # room -> [lengths, count]
    done: list[tuple[tuple[int, ...], int]] = []

    def put(lengths: tuple[int, ...], count: int) -> None:
        room = capacity - sum(lengths)
        if room == 0 or (most_texts and len(lengths) >= most_texts):
            done.append((lengths, count))
        else:
            by_room.setdefault(room, []).append([lengths, count])

    def take(room: int, count: int) -> tuple[tuple[int, ...], int]:
        lengths, have = by_room[room][-1]
        used = min(have, count)
        if used == have:
            by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
        else:
            by_room[room][-1][1] -= used
        return lengths, used

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = length if length in by_room else max(by_room, default=0)
            if room < length:
                per = capacity // length if not most_texts else min(capacity // length, most_texts)
                full, rest = divmod(left, per)
                if full:
                    put((length,) * per, full)
                if rest:
                    put((length,) * rest, 1)
                break
            lengths, used = take(room, left)
            more = min(room // length, max(1, left // used), most_texts - len(lengths) if most_texts else room)
            put((*lengths, *(length,) * more), used)
            left -= used * more
    for packs in by_room.values():
        done += [(lengths, count) for lengths, count in packs]
    return sorted(done, reverse=True)


def _slots(found: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the runs of numbers: (first number, per container, first container)."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 1
    for lengths, count in found:
        for length in set(lengths):
            per = lengths.count(length)
            slots.setdefault(length, []).append((used.get(length, 0), per, first))
            used[length] = used.get(length, 0) + per * count
        first += count
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            size, number = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            out = np.zeros(len(size), np.int64)
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                runs = slots[int(length)]
                k = np.searchsorted(runs[:, 0], number[at], side="right") - 1
                out[at] = runs[k, 2] + (number[at] - runs[k, 0]) // runs[k, 1]
            yield pa.RecordBatch.from_arrays([pa.array(out), batch.column(0), batch.column(1), batch.column(2)], ["container", "doc_id", "piece", "tokens"])

    return run


def pack(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, tokens) to (container, doc_id, piece, tokens); piece k holds the tokens from (k - 1) * capacity on."""
    spark = sizes.sparkSession
    ship(spark)
    pieces = sizes.where("tokens > 0").select("doc_id", F.posexplode(F.sequence(F.lit(0), ((F.col("tokens") - 1) / capacity).cast("int"))).alias("pos", "k"), "tokens")
    pieces = pieces.select("doc_id", (F.col("k") + 1).alias("piece"), F.least(F.lit(capacity), F.col("tokens") - F.col("k") * capacity).cast("bigint").alias("size"))
    histogram = {r["size"]: r["count"] for r in pieces.groupBy("size").count().collect()}  # capacity rows at most
    common = {size: -(-n // PART_ROWS) for size, n in histogram.items() if n > PART_ROWS}
    of = F.create_map(*(F.lit(x).cast("bigint") for kv in common.items() for x in kv)) if common else None
    parts = F.coalesce(F.try_element_at(of, "size"), F.lit(1)) if common else F.lit(1).cast("bigint")
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), parts).cast("int"))
    if common:
        counts = [(r["size"], r["part"], r["count"]) for r in pieces.where(F.col("size").isin(list(common))).groupBy("size", "part").count().collect()]  # one row for each PART_ROWS pieces
    else:
        counts = []
    counts += [(size, 0, n) for size, n in histogram.items() if size not in common]
    found = patterns(histogram, capacity)
    before: dict[int, int] = {}
    offsets = []
    for size, part, n in sorted(counts):
        offsets.append((size, part, before.get(size, 0)))
        before[size] = before.get(size, 0) + n
    shared = spark.sparkContext.broadcast(_slots(found))  # a few thousand runs: patterns follow the capacity
    if not offsets:
        return pieces.select(F.lit(0).cast("bigint").alias("container"), "doc_id", "piece", F.col("size").alias("tokens")).where("false")
    base = F.broadcast(spark.createDataFrame(offsets, "size bigint, part int, base bigint"))
    order = Window.partitionBy("size", "part").orderBy("doc_id", "piece")
    numbered = pieces.withColumn("n", F.row_number().over(order)).join(base, ["size", "part"]).select("doc_id", "piece", "size", (F.col("base") + F.col("n") - 1).alias("number"))
    kind = dict(pieces.dtypes)["doc_id"]
    return numbered.mapInArrow(_place(shared), f"container bigint, doc_id {kind}, piece int, tokens bigint")


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container, document and piece of every text of the documents."""
    sizes = keep(token_sizes(table(spark, sf_dir, "documents"), ["doc_id"], "text"))
    return pack(sizes)


def p8_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of space used."""
    packed = p8_packed(spark, sf_dir)
    return packed.agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens"), F.round(F.sum("tokens") / (F.count_distinct("container") * CAPACITY), 6).alias("used"))


QUERIES = {"p8_packed": p8_packed, "p8_filling": p8_filling}
SQL: dict[str, str] = {}
