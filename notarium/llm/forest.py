"""Problem 3: new batches against all that was accepted before.

Prefix-tree hash forest.  A class of equal shingle sets has one signature of
160 min-hashes of a byte.  Forty permutations of it, whose first four hashes
are disjoint, give forty keys of eight hashes; a run keeps the entries of each
permutation sorted by key in the shared folder, and several runs are merged
into one.  A batch finds its neighbours by range search: in each permutation
the entries that begin with the same hashes are a range of the sorted run.  The
shared prefix starts at the whole key and is widened, hash by hash, until the
chance to miss a pair at the threshold is below the recall target.  Candidates
of long prefixes are compared shingle by shingle first; only what is not
refused by then is compared with those of the wider ranges.

``History`` keeps what was accepted: sorted runs, shingle sets and record keys.
It can be opened again from its folder; screening a batch makes shingles and
signatures of that batch alone and appends what it accepted.

Acceptance goes by delivery order.  It is decided in rounds over keys (record,
raw hash, normalized hash, class, linked class): a delivery is refused once a
key of its own has an earlier accepted delivery, and accepted once it is the
first undecided one of all its keys.  Each round decides the first undecided
delivery at least, so the rounds end by themselves.  Only minima by key are
gathered, never the pairs within a group of copies.

A range of more than ``MOST_RANGE`` entries hands on the nearest entries of
each delivery first, and all of them, in blocks, for what these do not refuse.

Rows sent twice count once.  Deliveries with a null id or batch, of records
unknown to the manifest or with a null, empty or blank body are no cases and
stop none.  Null hashes match nothing; hashes are compared without a
``sha256:`` prefix and without case.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import keep, shared_folder, ship, table
from .batches import slices
from .near import ORDER_BYTES, TOKEN_BYTES, binary_points, text_sets, unpack, verified
from .wordset import mix

#: Permutations, hashes that no two of them begin with, and hashes of a key.
TREES, APART, LEVELS = 40, 4, 8
RECALL = 0.995
#: Prefixes of this many hashes or more are compared first.
FIRST_LEVEL = 6
#: Entries that a range may have before only the NEAREST on each side are handed on at first.
MOST_RANGE, NEAREST = 512, 8
#: Entries of a part, in bytes; a part never cuts a range, as it is made of whole slots of a permutation.
PART_BYTES = 8 << 20
SLOTS = 256
MOST_HELD = 2_000_000
ENTRY = np.dtype([("tree", "u1"), ("fresh", "u1"), ("key", "<u8"), ("id", "<i8")])


def depth_for(similarity: float, recall: float = RECALL, trees: int = TREES) -> int:
    """The longest shared prefix, widened from the whole key, that meets the recall target; 1 at least."""
    depth = LEVELS
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return min(depth, APART)


def permutations() -> np.ndarray:
    """The hashes of each key by their place in the signature: four of its own, then four of another permutation."""
    first = np.arange(TREES * APART).reshape(TREES, APART)
    return np.concatenate([first, np.roll(first, -7, axis=0)], axis=1)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, tokens) to (class, signature)."""
    seed = mix(np.arange(1, TREES * APART + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    times, plus = (seed | np.uint64(1)).astype(np.uint32), (seed >> np.uint64(32)).astype(np.uint32)
    for batch in slices(batches, "tokens", ORDER_BYTES // 4):
        data, ends = binary_points(batch.column(1))
        tokens, at = unpack(data), ends // TOKEN_BYTES
        base = (mix(tokens) >> np.uint64(20)).astype(np.uint32)
        out = np.zeros((batch.num_rows, TREES * APART), np.uint8)
        work = np.empty_like(base)
        for f in range(TREES * APART):
            np.multiply(base, times[f], out=work)
            np.add(work, plus[f], out=work)
            # the low bits of a minimum are even, its high bits are not
            out[:, f] = (mix(np.minimum.reduceat(work, at[:-1])) & np.uint64(0xFF)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in out], pa.binary())], ["class_id", "signature"])


def signatures(tokens: DataFrame) -> DataFrame:
    """(class_id, signature) of classes given (class_id, tokens)."""
    ship(tokens.sparkSession)
    return tokens.mapInArrow(_signatures, "class_id bigint, signature binary")


def _slot(entries: np.ndarray) -> np.ndarray:
    return entries["tree"].astype(np.int64) * SLOTS + (entries["key"] >> np.uint64(56)).astype(np.int64)


def _cut(entries: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted entries by part."""
    part = _slot(entries) * parts // (TREES * SLOTS)
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield int(part[a]), entries[a:b]


CHUNKS = "part int, first_slot int, last_slot int, entries binary"


def _chunk_rows(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    slots = [_slot(e[[0, -1]]) for _, e in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows], pa.int32()), pa.array([int(s[0]) for s in slots], pa.int32()), pa.array([int(s[1]) for s in slots], pa.int32()), pa.array([e.tobytes() for _, e in rows], pa.binary())],
        ["part", "first_slot", "last_slot", "entries"],
    )


def _entries(parts: int, fresh: bool):
    """(class, signature) to sorted entries of all permutations, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = permutations()
        for whole in batches:
            for begin in range(0, whole.num_rows, 8192):
                batch = whole.slice(begin, 8192)
                data, _ = binary_points(batch.column(1))
                keys = np.ascontiguousarray(data.reshape(-1, TREES * APART)[:, order]).view(">u8")[:, :, 0]
                out = np.zeros(keys.shape, ENTRY)
                out["tree"], out["fresh"] = np.arange(TREES, dtype=np.uint8)[None, :], fresh
                out["key"], out["id"] = keys, batch.column(0).to_numpy()[:, None]
                out = out.T.ravel()
                yield _chunk_rows(list(_cut(out[np.lexsort((out["key"], out["tree"]))], parts)))

    return run


def _joined(batches: Iterator[pa.RecordBatch], column: int) -> np.ndarray:
    got = [binary_points(b.column(column))[0] for b in batches]
    return np.concatenate(got).view(ENTRY) if got else np.zeros(0, ENTRY)


def _sorted_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of one part in order, in chunks; a class that came twice stays once."""
    got = _joined(batches, 3)
    if not len(got):
        return
    got = got[np.lexsort((got["id"], got["key"], got["tree"]))]
    same = np.concatenate([[False], (got["tree"][1:] == got["tree"][:-1]) & (got["key"][1:] == got["key"][:-1]) & (got["id"][1:] == got["id"][:-1])])
    got = got[~same]
    for begin in range(0, len(got), 1 << 16):
        yield _chunk_rows([(0, got[begin : begin + (1 << 16)])])


def _recut(parts: int):
    """Chunks of a run to those of other parts; sorted entries stay in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(3):
                entries = np.frombuffer(data.as_buffer(), ENTRY)
                yield _chunk_rows(list(_cut(entries, parts)))

    return run


CANDIDATES = "class_a bigint, class_b bigint, level int, known boolean, more boolean"


def _search(depth: int, all_of: bool):
    """Entries of one part to pairs: a fresh class and one whose key begins with the same ``depth`` hashes."""
    mask = np.uint64(((1 << (8 * depth)) - 1) << (64 - 8 * depth))

    def found(a, b, ka, kb, known, more) -> pa.RecordBatch:
        level = np.full(len(a), LEVELS, np.int32)
        differ = ka ^ kb
        for k in range(LEVELS):
            level = np.where((level == LEVELS) & ((differ >> np.uint64(56 - 8 * k)) & np.uint64(0xFF) > 0), k, level)
        order = np.lexsort((-level, b, a))
        a, b, level, more = a[order], b[order], level[order], more[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(level[first]), pa.array(np.full(len(first), known)), pa.array(np.logical_or.reduceat(more, first))], ["class_a", "class_b", "level", "known", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _joined(batches, 3)
        if not len(got):
            return
        got = got[np.lexsort((got["key"], got["tree"]))]
        held: dict[bool, list] = {True: [], False: []}
        count = 0
        for tree in np.unique(got["tree"]):
            here = got[got["tree"] == tree]
            ask = here[here["fresh"] == 1]
            if not len(ask):
                continue
            for known, run_ in ((True, here[here["fresh"] == 0]), (False, ask)):
                keys = np.ascontiguousarray(run_["key"])
                low = ask["key"] & mask
                begin = np.searchsorted(keys, low, "left") if known else np.arange(len(ask)) + 1
                end = np.searchsorted(keys, low | ~mask, "right")
                wide = end - begin > MOST_RANGE
                if not all_of and wide.any():  # the nearest by key, on both sides
                    at = np.searchsorted(keys, ask["key"]) if known else np.arange(len(ask)) + 1
                    begin = np.where(wide, np.maximum(begin, at - NEAREST), begin)
                    end = np.where(wide, np.minimum(end, at + NEAREST), end)
                n = np.maximum(end - begin, 0)
                upto = np.cumsum(n)
                block = 0
                while block < len(ask):  # blocks of bounded size
                    stop = max(block + 1, int(np.searchsorted(upto, (upto[block - 1] if block else 0) + MOST_HELD)))
                    part = slice(block, stop)
                    m = n[part]
                    total = int(m.sum())
                    if total:
                        of = np.repeat(np.arange(block, min(stop, len(ask))), m)
                        with_ = begin[of] + np.arange(total) - np.repeat(np.cumsum(m) - m, m)
                        ok = ask["id"][of] != run_["id"][with_]
                        of, with_ = of[ok], with_[ok]
                        held[known].append((ask["id"][of], run_["id"][with_], ask["key"][of], keys[with_], wide[of] & (not all_of)))
                        count += len(of)
                    if count > MOST_HELD:
                        for k, rows in held.items():
                            if rows:
                                yield found(*(np.concatenate(x) for x in list(zip(*rows, strict=True))[:4]), k, np.concatenate([r[4] for r in rows]))
                        held, count = {True: [], False: []}, 0
                    block = stop
        for k, rows in held.items():
            if rows and sum(len(r[0]) for r in rows):
                yield found(*(np.concatenate(x) for x in list(zip(*rows, strict=True))[:4]), k, np.concatenate([r[4] for r in rows]))

    return run


def _parts(spark: SparkSession, classes: int) -> int:
    return min(TREES * SLOTS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-classes * TREES * ENTRY.itemsize // PART_BYTES)))


def sorted_run(keys: DataFrame, classes: int) -> DataFrame:
    """The permutations of (class_id, signature), each sorted, in chunks."""
    parts = _parts(keys.sparkSession, classes)
    return keys.mapInArrow(_entries(parts, False), CHUNKS).repartitionById(parts, F.col("part")).mapInArrow(_sorted_chunks, CHUNKS)


def search(runs: DataFrame, history: int, keys: DataFrame, classes: int, depth: int, all_of: bool = False) -> DataFrame:
    """(class_a fresh, class_b, level, known, more) by range search of a batch's (class_id, signature) in sorted runs and in the batch itself.

    ``level`` is the longest shared prefix, ``known`` says that class_b is of the runs, ``more`` that the
    range has further entries.  Only runs' chunks that hold a slot of the batch are read.
    """
    parts = _parts(keys.sparkSession, history + classes)
    asked = keys.mapInArrow(_entries(parts, True), CHUNKS)
    both = runs.mapInArrow(_recut(parts), CHUNKS).unionByName(asked)
    rows = both.repartitionById(parts, F.col("part")).mapInArrow(_search(depth, all_of), CANDIDATES)
    # within the batch a pair came with either end first, by permutation
    a = F.when(F.col("known"), F.col("class_a")).otherwise(F.least("class_a", "class_b"))
    b = F.when(F.col("known"), F.col("class_b")).otherwise(F.greatest("class_a", "class_b"))
    return rows.groupBy(a.alias("class_a"), b.alias("class_b"), "known").agg(F.max("level").alias("level"), F.max("more").alias("more"))


def plain_hash(c: str) -> F.Column:
    """A hash in one notation; null stays null, empty becomes null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(F.col(c))), "^sha-?256[:=-]", ""), F.lit(""))


def record_keys(deliveries: DataFrame) -> DataFrame:
    """(at, key) for each record, class, raw and normalized hash of a delivery."""
    none = F.array().cast("array<string>")
    listed = F.concat(
        F.array(F.concat(F.lit("d"), F.col("doc_id")), _class_name("class_id")),
        F.transform(F.coalesce("raws", none), lambda x: F.concat(F.lit("r"), x)),
        F.transform(F.coalesce("norms", none), lambda x: F.concat(F.lit("n"), x)),
    )
    return deliveries.select("at", F.explode(listed).alias("key")).select("at", F.xxhash64("key").alias("key"))


def _class_name(c: str) -> F.Column:
    return F.concat(F.lit("c"), F.col(c).cast("string"))


def decide(keys: DataFrame, links: DataFrame, before: DataFrame) -> DataFrame:
    """(at, accepted) by delivery order.

    keys: (at, key), several a delivery; links: (key, other), both ways; before: (key, first_at)
    of what is accepted already.  ``at`` is unique and ordered.
    """
    own = keep(keys.distinct())
    undecided = keep(own.unionByName(own.join(links, "key").select("at", F.col("other").alias("key"))).distinct())
    accepted = keep(before.groupBy("key").agg(F.min("first_at").alias("first_at")))
    results: list[DataFrame] = []
    while True:
        waiting = undecided.select("at").distinct().join(own, "at").groupBy("key").agg(F.min("at").alias("waits"))
        seen = undecided.join(accepted, "key", "left").join(waiting, "key", "left")
        state = seen.groupBy("at").agg(F.max(F.coalesce(F.col("first_at") < F.col("at"), F.lit(False))).alias("refused"), F.max(F.coalesce(F.col("waits") < F.col("at"), F.lit(False))).alias("later"))
        state = keep(state.select("at", F.when(F.col("refused"), False).when(~F.col("later"), True).alias("accepted")))
        done = state.where("accepted is not null")
        results.append(done)
        if len(results) > 16:  # the plan stays short
            results = [keep(reduce(DataFrame.unionByName, results))]
        if state.where("accepted is null").isEmpty():
            return reduce(DataFrame.unionByName, results)
        undecided = keep(undecided.join(state.where("accepted is null").select("at"), "at", "left_semi"))
        fresh = done.where("accepted").join(own, "at").groupBy("key").agg(F.min("at").alias("first_at"))
        accepted = keep(accepted.unionByName(fresh).groupBy("key").agg(F.min("first_at").alias("first_at")))


class History:
    """What was accepted so far, in a shared folder; opened again by giving the same folder.

    A run is a folder ``run-<first>-<last>`` with ``entries`` (sorted permutations), ``tokens`` or the
    place of them, and ``keys``, which is written last.  A merged run spans those it replaces.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, most_runs: int = 4, up: int = 3, down: int = 5):
        ship(spark)
        self.spark, self.most_runs, self.up, self.down = spark, most_runs, up, down
        self.folder = (folder or shared_folder(spark)).rstrip("/")
        self.depth = depth_for(up / down)

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[str]:
        """The complete runs in order, without those that a merged one replaces."""
        p, fs = self._path("")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        spans = []
        for n in names:
            q, fs = self._path(f"{n}/keys/_SUCCESS")
            if n.startswith("run-") and fs.exists(q):
                _, a, b = n.split("-")
                spans.append((int(a), int(b), n))
        spans.sort(key=lambda s: (s[0], -s[1]))
        out, upto = [], -1
        for _, b, n in spans:
            if b > upto:
                out.append(n)
                upto = b
        return out

    def _read(self, what: str, schema: str) -> DataFrame:
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{r}/{what}" for r in runs))

    def entries(self) -> DataFrame:
        return self._read("entries", CHUNKS)

    def keys(self) -> DataFrame:
        return self._read("keys", "key bigint, first_at bigint")

    def classes(self) -> int:
        """Entries of the runs by their size; no entry is read for it."""
        total = self.entries().agg(F.sum(F.length("entries"))).first()[0] or 0
        return total // (TREES * ENTRY.itemsize)

    def tokens(self, besides: DataFrame) -> DataFrame:
        """(class_id, tokens) of all accepted classes and of those given."""
        out = besides
        here = {f.rsplit("/", 1)[0] for f in besides.inputFiles()}
        places = [r["place"] for r in self._read("places", "place string").distinct().collect()]  # one a run
        for p in sorted(set(places) - here):
            out = out.unionByName(self.spark.read.parquet(p).where("tokens is not null").select("class_id", "tokens"))
        return out

    def _append(self, name: str, entries: DataFrame, keys: DataFrame, places: list[str]) -> None:
        at = f"{self.folder}/{name}"
        # a run that was cut off half-way is written again
        entries.write.mode("overwrite").option("compression", "none").parquet(f"{at}/entries")
        self.spark.createDataFrame([(p,) for p in places], "place string").coalesce(1).write.mode("overwrite").parquet(f"{at}/places")
        keys.write.mode("overwrite").parquet(f"{at}/keys")

    def add(self, deliveries: DataFrame, tokens: DataFrame, keyed: DataFrame | None = None, place: str | None = None) -> None:
        """Accept deliveries (at, doc_id, class_id, raws, norms) as they stand; tokens: (class_id, tokens) of their classes.

        keyed: their (class_id, signature) where these exist; place: the folder of (class_id, tokens) where that is kept already.
        """
        runs = self.runs()
        number = int(runs[-1].split("-")[2]) + 1 if runs else 0
        classes = deliveries.select("class_id").distinct()
        name = f"run-{number}-{number}"
        if place is None:
            place = f"{self.folder}/tokens-{number}"
            tokens.join(classes, "class_id", "left_semi").dropDuplicates(["class_id"]).write.mode("overwrite").option("compression", "none").parquet(place)
        signed = keep((keyed if keyed is not None else signatures(tokens.dropDuplicates(["class_id"]))).join(classes, "class_id", "left_semi"), "none")
        self._append(name, sorted_run(signed, signed.count()), record_keys(deliveries).groupBy("key").agg(F.min("at").alias("first_at")), [place])
        if len(self.runs()) > self.most_runs:
            self.merge()

    def merge(self) -> None:
        """Put all runs into one; each permutation is merged part by part."""
        runs = self.runs()
        parts = _parts(self.spark, self.classes())
        merged = self.entries().mapInArrow(_recut(parts), CHUNKS).repartitionById(parts, F.col("part")).mapInArrow(_sorted_chunks, CHUNKS)
        places = [r["place"] for r in self._read("places", "place string").distinct().collect()]
        self._append(f"run-{runs[0].split('-')[1]}-{runs[-1].split('-')[2]}", merged, self.keys().groupBy("key").agg(F.min("first_at").alias("first_at")), sorted(places))
        for r in runs:
            p, fs = self._path(r)
            fs.delete(p, True)

    def links(self, keyed: DataFrame, tokens: DataFrame) -> DataFrame:
        """(a, b): verified pairs of new classes (class_id, signature) with accepted ones and with each other.

        A new class that an accepted one refuses is compared no further.
        """
        new = keyed.count()
        if not new:
            return self.spark.createDataFrame([], "a bigint, b bigint")
        history = self.classes()
        runs = self.entries()
        if new < 1000:  # few slots are asked for: chunks without any of them are not read
            asked = keyed.mapInArrow(_entries(1, True), CHUNKS).select("entries").mapInArrow(_asked, "slot int").distinct()
            slots = sorted(r[0] for r in asked.collect())  # TREES x SLOTS at most
            if len(slots) < TREES * SLOTS // 2:
                runs = runs.where(reduce(lambda x, y: x | y, [(F.col("first_slot") <= b) & (F.col("last_slot") >= a) for a, b in _spans(slots)], F.lit(False)))
        every = self.tokens(tokens)
        found = keep(search(runs, history, keyed, new, self.depth))
        pair = ["class_a", "class_b"]
        n = found.agg(F.count_if(F.expr(f"known and level >= {FIRST_LEVEL}")).alias("first"), F.count("*").alias("all"), F.count_if("more").alias("more")).first()
        first = keep(verified(found.where(f"known and level >= {FIRST_LEVEL}").select(pair), every, self.up, self.down).select(pair)) if n["first"] else found.select(pair).limit(0)
        out = [first]
        refused = first.select("class_a").distinct()
        if n["all"] > n["first"]:
            wider = found.where(f"not known or level < {FIRST_LEVEL}").join(refused, "class_a", "left_anti").join(refused.withColumnRenamed("class_a", "class_b"), "class_b", "left_anti")
            second = verified(wider.select(pair), every, self.up, self.down).select(pair)
            second = keep(second.join(found.where("known").select(*pair, F.lit(True).alias("known")), pair, "left").select(*pair, F.coalesce("known", F.lit(False)).alias("known")))
            out.append(second.select(pair))
            refused = refused.unionByName(second.where("known").select("class_a")).distinct()
        if n["more"]:  # ranges too wide to hand on at once
            more = found.where("more").select(F.explode(F.array(*pair)).alias("class_id")).distinct().join(refused.withColumnRenamed("class_a", "class_id"), "class_id", "left_anti")
            hot = keep(keyed.join(more, "class_id", "left_semi"), "none")
            rest = search(runs, history, hot, hot.count(), self.depth, True).join(found.select(pair), pair, "left_anti")
            out.append(verified(keep(rest.select(pair)), every, self.up, self.down).select(pair))
        return keep(reduce(DataFrame.unionByName, out).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct())

    def screen(self, deliveries: DataFrame, tokens: DataFrame, append: bool = True) -> DataFrame:
        """(at, accepted) of new deliveries (at, doc_id, class_id, raws, norms), in their order; what is accepted is appended.

        tokens: (class_id, tokens) of the batch.  ``at`` must be later than all that was accepted.
        """
        keys = keep(record_keys(deliveries).distinct())
        before = keep(self.keys().join(keys.select("key").distinct(), "key", "left_semi"))
        known = before.select("key").distinct()
        classes = deliveries.select("class_id").distinct().withColumn("key", F.xxhash64(_class_name("class_id"))).join(known, "key", "left_anti").select("class_id")
        keyed = keep(signatures(tokens.join(classes, "class_id", "left_semi").dropDuplicates(["class_id"])), "none")
        links = self.links(keyed, tokens)
        name = lambda c: F.xxhash64(_class_name(c))
        both = keep(links.select(name("a").alias("key"), name("b").alias("other")).unionByName(links.select(name("b").alias("key"), name("a").alias("other"))))
        linked = self.keys().join(both.select(F.col("other").alias("key")).distinct(), "key", "left_semi")
        before = before.unionByName(linked)
        # keys of a single delivery without links decide nothing
        shared = keys.groupBy("key").count().where("count > 1").select("key").unionByName(both.select("key")).unionByName(known).distinct()
        busy = keep(keys.join(shared, "key", "left_semi"))
        decided = keep(keys.select("at").distinct().join(decide(busy, both, before), "at", "left").select("at", F.coalesce("accepted", F.lit(True)).alias("accepted")))
        if append:
            accepted = keep(deliveries.join(decided.where("accepted").select("at"), "at", "left_semi"))
            if not accepted.isEmpty():
                self.add(accepted, tokens)
        return decided


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = np.unique(_slot(_joined([batch], 0)))
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32))], ["slot"])


def _spans(slots: list[int], most: int = 200) -> list[tuple[int, int]]:
    """Slots as a few spans; the smallest gaps are closed."""
    spans = [[s, s] for s in slots[:1]]
    gaps = sorted((b - a for a, b in zip(slots, slots[1:], strict=False)), reverse=True)
    least = gaps[most - 1] if len(gaps) >= most else 1
    for s in slots[1:]:
        if s - spans[-1][1] <= max(least, 1):
            spans[-1][1] = s
        else:
            spans.append([s, s])
    return [tuple(s) for s in spans]


def screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(delivery_id, batch_no, doc_id, accepted) of every delivery of a known record with a body.

    The first load is accepted as it stands; all later batches of the table are screened in one go, in
    their order, so nothing is searched twice.
    """
    intake = table(spark, sf_dir, "intake").select("delivery_id", "batch_no", "doc_id").where("delivery_id is not null and batch_no is not null and doc_id is not null").dropDuplicates(["delivery_id"])
    manifest = table(spark, sf_dir, "manifest").select("doc_id", plain_hash("sha256").alias("raw")).where("doc_id is not null").distinct()
    cleaned = table(spark, sf_dir, "cleaned")
    sets = text_sets(cleaned, "doc_id", "body")
    classes = sets.where("kind = 0").select("doc_id", "class_id").distinct()
    hashes = cleaned.select("doc_id", plain_hash("normalized_sha256").alias("norm")).where("norm is not null").distinct()
    known = manifest.groupBy("doc_id").agg(F.collect_set("raw").alias("raws"))
    norms = hashes.groupBy("doc_id").agg(F.collect_set("norm").alias("norms"))
    records = classes.join(known, "doc_id").join(norms, "doc_id", "left")
    deliveries = keep(intake.join(records, "doc_id").withColumn("at", F.shiftleft(F.col("batch_no").cast("bigint"), 44) + F.col("delivery_id")))
    tokens = sets.where("kind = 1").select("class_id", "tokens")
    place = sets.inputFiles()[0].rsplit("/", 1)[0] if sets.inputFiles() else None
    history = History(spark)
    history.add(deliveries.where("batch_no = 0"), tokens, place=place)
    decided = history.screen(deliveries.where("batch_no > 0"), tokens, append=False)
    return deliveries.join(decided, "at", "left").select("delivery_id", "batch_no", "doc_id", F.coalesce("accepted", F.lit(True)).alias("accepted"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, batch_no) of deliveries that are copies or near-copies of a record accepted before."""
    return screened(spark, sf_dir).where("not accepted").select("doc_id", "batch_no").distinct()


def p3_screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of a known record with a body, with its decision."""
    return screened(spark, sf_dir)


QUERIES = {"p3_found": p3_found, "p3_screened": p3_screened}
SQL: dict[str, str] = {}
