"""Problem 7: groups of records whose texts are nearly the same.

Adaptive multi-match prefixes.  A text is the set of its shingles.  All
shingles have one global order, rare ones first (a count sketch over every text
gives the frequencies).  Two sets of similarity t or more share at least k of
the first n - ceil(t n) + k shingles of each, for every k up to ceil(t n).  Each
text picks its own k: a longer prefix costs more postings but fewer candidates,
as a pair needs min(k_a, k_b) shared prefix shingles before it is verified.  No
pair at or above the threshold is lost, and every pair that comes out was
compared shingle by shingle.

Equal sets are one class from the start, so a third of all rows being copies
costs one prefix per task.  Pairs meet by prefix shingle in parts whose number
follows the size of the data.  A match counts only in as much of both prefixes
as the two sizes ask for.  Prefix shingles that are frequent are split into
blocks of bounded size that meet pairwise, each pair in one part.

Null, empty and blank texts belong to no class.  Texts too short for a shingle are
classed by their text as it looks, so they pair only with equal ones.  Repeated
rows count once; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import keep, ship, table
from .batches import slices
from .codepoints import SPACE, fold_points, tables, take_rows, to_points
from .wordset import TOKEN_BITS, mix, set_ids, token_sets

#: Counters of the frequency sketch: half as many as there are shingles, as most of these repeat; 2**MOST_SKETCH_BITS at most (a byte each).
LEAST_SKETCH_BITS, MOST_SKETCH_BITS = 20, 25
SKETCH_BLOCKS = 64
#: Longest extra prefix, and what verifying a candidate costs in matches.
MOST_MATCHES = 24
VERIFY_COST = 4
#: Postings of one shingle that one block holds at most before it is split.
HOT = 4096
#: Matches that a task holds before it hands them on.
MOST_HELD = 4_000_000
#: Tokens of the sets, in bytes, for each part in which pairs meet: the parts grow with the data, what a task holds does not.
PART_BYTES = 4 << 20
#: Tokens that a task orders at once, in bytes.
ORDER_BYTES = 4 << 20
#: Bits of the filter that says which sets have candidates.
FILTER_BITS = 24
#: Bytes of a token at rest. Two shingles of a pair of texts of n shingles meet with a chance of n * n / 2**32.
TOKEN_BYTES = 4
_SHIFT = np.uint64(TOKEN_BITS - 8 * TOKEN_BYTES)


def pack(tokens: np.ndarray) -> np.ndarray:
    """Tokens to their leading bytes, in order."""
    return np.ascontiguousarray((tokens >> _SHIFT).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]


def unpack(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = data.reshape(-1, TOKEN_BYTES)
    return out.view("<u8").ravel()


def binary(parts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array whose values lie one after the other; ends in bytes, beginning with 0."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(parts).tobytes())])


def binary_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array, and offsets."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


SETS = "kind int, doc_id string, class_id bigint, tokens binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a record with its class; kind 1: the tokens of a class, once a task at least."""
    seen: set[int] = set()
    for batch in slices(batches, "text"):
        points, at = fold_points(*to_points(batch.column(1)))
        shown = np.diff(np.concatenate([[0], np.cumsum((tables()["kind"][points] & SPACE) == 0)])[at])
        if not shown.all():  # nothing but white space is empty
            some = np.flatnonzero(shown)
            points, at = take_rows(points, at, some)
            batch = batch.take(pa.array(some))
        row, tokens, to = token_sets(points, at)
        ids = set_ids(tokens, to)
        bare = np.flatnonzero(ids == 0)
        if len(bare):  # no shingle: the text itself
            for i in bare.tolist():
                ids[i] = int(mix(np.array([hash_bytes(points[at[i] : at[i + 1]])], np.uint64))[0] >> np.uint64(1)) | 1
        n = batch.num_rows
        fresh = np.zeros(n, bool)
        for i, c in enumerate(ids.tolist()):
            if c not in seen:
                seen.add(c)
                fresh[i] = to[i + 1] > to[i]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), batch.column(0).cast(pa.string()), pa.array(ids), pa.nulls(n, pa.binary())], ["kind", "doc_id", "class_id", "tokens"])
        if fresh.any():
            part = pack(tokens[fresh[row]])
            ends = np.concatenate([[0], np.cumsum(np.diff(to)[fresh])]) * TOKEN_BYTES
            k = int(fresh.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.string()), pa.array(ids[fresh]), binary(part, ends)], ["kind", "doc_id", "class_id", "tokens"])


def hash_bytes(points: np.ndarray) -> int:
    """A 64-bit hash of a short text's code points."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for block in range(0, max(1, len(points)), 64):
            part = points[block : block + 64].astype(np.uint64)
            h = mix(np.array([h + np.sum(mix(part + np.arange(1, len(part) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))], np.uint64))[0]
    return int(h)


def _count(bits: int):
    """Tokens to blocks of counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in slices(batches, "tokens", ORDER_BYTES):
            data, _ = binary_points(batch.column(0))
            bucket, times = np.unique(bucket_of(unpack(data), bits), return_counts=True)
            counts[bucket] += times.astype(np.uint32)
        for b, block in enumerate(counts.reshape(SKETCH_BLOCKS, -1)):
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([zlib.compress(block.astype("<u4").tobytes(), 1)], pa.binary())], ["block", "counts"])

    return run


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(data), "<u4").astype(np.uint64)
            totals[b] = totals[b] + part if b in totals else part
    for b, total in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([zlib.compress(level_of(total).tobytes(), 1)], pa.binary())], ["block", "counts"])


def level_of(counts: np.ndarray) -> np.ndarray:
    """Counts as a byte on a logarithmic scale, eight steps for each doubling: 0 and 1 are themselves, 255 stands for two thousand million."""
    return np.where(counts > 1, np.minimum(1 + np.ceil(8 * np.log2(np.maximum(counts, 1).astype(float))), 255), counts).astype(np.uint8)


#: The count of each level.
LEVELS = np.concatenate([[0], np.round(2.0 ** (np.arange(255) / 8))]).astype(np.int64)


def sketch(tokens: DataFrame, bits: int) -> bytes:
    """Levels of the counts of all tokens: 2**bits bytes, 32 MB at most."""
    blocks = tokens.select("tokens").mapInArrow(_count(bits), "block bigint, counts binary").repartition(SKETCH_BLOCKS // 8, "block").mapInArrow(_add_blocks, "block bigint, counts binary")
    out = np.zeros((SKETCH_BLOCKS, (1 << bits) // SKETCH_BLOCKS), np.uint8)
    for r in blocks.collect():  # SKETCH_BLOCKS rows at most
        out[r["block"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint8)
    return out.tobytes()


def scattered(tokens: np.ndarray) -> np.ndarray:
    """A 32-bit number in another order; different ones stay different."""
    x = tokens.astype(np.uint32) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    return x ^ (x >> np.uint32(13))


def _prefixes(shared, bits: int, parts: int, up: int, down: int):
    """(class, tokens) to packed prefix records for each part; similarity up / down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(shared.value, np.uint8)
        for batch in slices(batches, "tokens", ORDER_BYTES):
            ids = batch.column(0).to_numpy()
            data, ends = binary_points(batch.column(1))
            tokens, at = unpack(data), ends // TOKEN_BYTES
            size = np.diff(at)
            row = np.repeat(np.arange(len(ids)), size)
            key = (row.astype(np.uint64) << np.uint64(40)) | (levels[bucket_of(tokens, bits)].astype(np.uint64) << np.uint64(32)) | scattered(tokens)
            key.sort()
            others = LEVELS[((key >> np.uint64(32)) & np.uint64(255)).astype(np.int64)] - 1
            least = -(-up * size // down)  # ceil
            # most matches are with texts of like size, which count in this much of the prefix only
            like = size - -(-2 * up * size // (up + down))
            run_cost = np.concatenate([[0], np.cumsum(np.maximum(others, 0))])
            k = np.minimum(np.arange(1, MOST_MATCHES + 1)[None, :], np.maximum(least, 1)[:, None])
            met = run_cost[np.minimum(at[:-1, None] + like[:, None] + k, at[1:, None])] - run_cost[at[:-1, None]]
            matches = np.take_along_axis(k, (met * (1 + VERIFY_COST / k)).argmin(1)[:, None], 1)[:, 0]
            pos = np.arange(len(key)) - at[row]
            index = np.flatnonzero((pos < np.minimum(size - least + matches, size)[row]) & (others > 0))
            r, p, many = row[index], pos[index], others[index]
            token = (key[index] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            side = np.zeros(len(r), np.uint8)
            splits = np.where(many > HOT, -(-many // HOT), 1)
            if (splits > 1).any():  # frequent shingles: a block meets itself and each other block once
                own = (mix(ids[r].view(np.uint64)) % splits.astype(np.uint64)).astype(np.int64)
                take = np.repeat(np.arange(len(r)), splits)
                other = np.arange(len(take)) - np.repeat(np.cumsum(splits) - splits, splits)
                own, split = own[take], splits[take] > 1
                low, high = np.minimum(own, other).astype(np.uint64), np.maximum(own, other).astype(np.uint64)
                place = mix(mix(token[take].astype(np.uint64) ^ (low << np.uint64(32))) ^ high)
                token = np.where(split, (place >> np.uint64(32)).astype(np.uint32), token[take])
                side = np.where(~split | (own == other), 0, np.where(own < other, 1, 2)).astype(np.uint8)
                r, p = r[take], p[take]
            part = (mix(token) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((r, part))
            r, p, token, side, part = r[order], p[order], token[order], side[order], part[order]
            if not len(r):
                continue
            first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (part[1:] != part[:-1])]))
            rec = np.zeros(len(first), RECORD)
            rec["id"], rec["size"], rec["matches"], rec["many"] = ids[r[first]], size[r[first]], matches[r[first]], np.diff(np.append(first, len(r)))
            post = np.zeros(len(r), POSTING)
            post["token"], post["pos"], post["side"] = token, np.minimum(p, UNKNOWN), side
            where = part[first]
            cut = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1], [True]]))
            rec_data = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * RECORD.itemsize).astype(np.int32).tobytes()), pa.py_buffer(rec.tobytes())])
            post_data = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((np.append(first, len(r))[cut] * POSTING.itemsize).astype(np.int32).tobytes()), pa.py_buffer(post.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(where[cut[:-1]].astype(np.int32)), rec_data, post_data], ["part", "records", "postings"])

    return run


RECORD = np.dtype([("id", "<i8"), ("size", "<u4"), ("matches", "u1"), ("many", "<u4")])
#: A shingle, its place in the order (UNKNOWN: there or later), and the side of a split one (0: not split or one block).
POSTING = np.dtype([("token", "<u4"), ("pos", "<u2"), ("side", "u1")])
UNKNOWN = 65535


def bucket_of(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Counter of a packed token."""
    return (tokens & np.uint64((1 << bits) - 1)).astype(np.int64)


PAIRS = "class_a bigint, class_b bigint, hits int, needed int"


def _meet(up: int, down: int):
    """Packed prefix records of one part to pairs with their matches in it.

    A match of sizes m and n counts where it lies in the first m - o + k and n - o + k
    shingles, o being the overlap that the similarity asks for and k the smaller number
    of matches: these hold k shared ones if any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recs, posts = [], []
        for batch in batches:
            data, _ = binary_points(batch.column(1))
            recs.append(data.view(RECORD))
            data, _ = binary_points(batch.column(2))
            posts.append(data.view(POSTING))
        if not recs:
            return
        rec, post = np.concatenate(recs), np.concatenate(posts)
        recs.clear()
        posts.clear()
        of = np.repeat(np.arange(len(rec), dtype=np.int32), rec["many"])
        size, need = rec["size"].astype(np.int64), rec["matches"].astype(np.int64)
        order = np.lexsort((rec["id"][of], size[of], post["token"]))
        post, of = post[order], of[order]
        token, pos, side = np.ascontiguousarray(post["token"]), post["pos"].astype(np.int64), np.ascontiguousarray(post["side"])
        # the same class from several tasks counts once
        once = np.flatnonzero(~np.concatenate([[False], (token[1:] == token[:-1]) & (side[1:] == side[:-1]) & (rec["id"][of[1:]] == rec["id"][of[:-1]])]))
        token, of, pos, side = token[once], of[once], pos[once], side[once]
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        end = np.repeat(edge[1:], np.diff(edge))
        live = np.arange(len(token))
        found_a, found_b, held, step = [], [], 0, 0
        while len(live):
            step += 1
            live = live[live + step < end[live]]
            kept = []
            for begin in range(0, len(live), 1 << 18):
                m = live[begin : begin + (1 << 18)]
                x, y = of[m], of[m + step]
                near_size = size[x] * down >= up * size[y]  # sizes rise, so the rest is no nearer
                m, x, y = m[near_size], x[near_size], y[near_size]
                kept.append(m)
                overlap = -(-up * (size[x] + size[y]) // (up + down))
                k = np.minimum(need[x], need[y])
                px, py = pos[m], pos[m + step]
                ok = ((px < size[x] - overlap + k) | (px >= UNKNOWN)) & ((py < size[y] - overlap + k) | (py >= UNKNOWN))
                ok &= (side[m] != side[m + step]) | (side[m] == 0)
                if ok.any():
                    found_a.append(x[ok])
                    found_b.append(y[ok])
                    held += len(found_a[-1])
                if held > MOST_HELD:
                    yield _summed(rec, found_a, found_b)
                    found_a, found_b, held = [], [], 0
            live = np.concatenate(kept) if kept else live[:0]
        if held:
            yield _summed(rec, found_a, found_b)

    return run


def _summed(rec: np.ndarray, found_a: list[np.ndarray], found_b: list[np.ndarray]) -> pa.RecordBatch:
    """Matches of pairs of records, added up."""
    x, y = np.concatenate(found_a), np.concatenate(found_b)
    ida, idb = rec["id"][x], rec["id"][y]
    a, b = np.minimum(ida, idb), np.maximum(ida, idb)
    order = np.lexsort((b, a))
    a, b, need = a[order], b[order], np.minimum(rec["matches"][x], rec["matches"][y])[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    hits = np.diff(np.append(first, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(hits.astype(np.int32)), pa.array(need[first].astype(np.int32))], ["class_a", "class_b", "hits", "needed"])


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        for c in (0, 1):
            bits[batch.column(c).to_numpy() & ((1 << FILTER_BITS) - 1)] = True
    if bits.any():
        packed = np.packbits(bits).reshape(64, -1)
        used = np.flatnonzero(packed.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array([packed[b].tobytes() for b in used], pa.binary())], ["block", "bits"])


def _or_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(data, np.uint8)
            totals[b] = totals[b] | part if b in totals else part
    for b, total in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["block", "bits"])


def id_filter(pairs: DataFrame) -> bytes:
    """A fixed 2 MB bit field of the classes named in pairs; it may hold others, never lacks one."""
    blocks = pairs.select("class_a", "class_b").mapInArrow(_filter_bits, "block bigint, bits binary").repartition(8, "block").mapInArrow(_or_blocks, "block bigint, bits binary")
    out = np.zeros((64, (1 << FILTER_BITS) // 8 // 64), np.uint8)
    for r in blocks.collect():  # 64 rows at most
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _only(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for batch in batches:
            keep_rows = wanted[batch.column(0).to_numpy() & ((1 << FILTER_BITS) - 1)]
            if keep_rows.any():
                yield batch.filter(pa.array(keep_rows))

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared shingles of each pair, all pairs of a slice in one sort."""
    for whole in batches:
        for begin in range(0, whole.num_rows, 512):
            batch = whole.slice(begin, 512)
            n = batch.num_rows
            keys, sizes = [], []
            for c in (2, 3):
                data, ends = binary_points(batch.column(c))
                tokens, size = unpack(data), np.diff(ends) // TOKEN_BYTES
                keys.append((np.repeat(np.arange(n), size).astype(np.uint64) << np.uint64(8 * TOKEN_BYTES)) | tokens)
                sizes.append(size)
            both = np.sort(np.concatenate(keys))
            same = both[:-1][both[1:] == both[:-1]] >> np.uint64(8 * TOKEN_BYTES)
            shared = np.bincount(same.astype(np.int64), minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.astype(np.int32)), pa.array(sizes[0].astype(np.int32)), pa.array(sizes[1].astype(np.int32))], ["class_a", "class_b", "shared", "size_a", "size_b"])


COMPARED = "class_a bigint, class_b bigint, shared int, size_a int, size_b int"


def verified(candidates: DataFrame, token_table: DataFrame, up: int, down: int) -> DataFrame:
    """Candidate pairs (class_a, class_b) that reach the similarity, compared shingle by shingle."""
    spark = candidates.sparkSession
    bits = spark.sparkContext.broadcast(id_filter(candidates))  # 2 MB
    wanted = token_table.mapInArrow(_only(bits), "class_id bigint, tokens binary").dropDuplicates(["class_id"])
    one = wanted.select(F.col("class_id").alias("class_a"), F.col("tokens").alias("tokens_a"))
    two = wanted.select(F.col("class_id").alias("class_b"), F.col("tokens").alias("tokens_b"))
    joined = candidates.select("class_a", "class_b").join(one, "class_a").join(two, "class_b").select("class_a", "class_b", "tokens_a", "tokens_b")
    return joined.mapInArrow(_compare, COMPARED).where(F.expr(f"shared * {down}L >= {up}L * (size_a + size_b - shared)"))


@dataclass
class Near:
    """members: (doc_id, class_id), one row a record; pairs: (class_a, class_b, shared, size_a, size_b) of different classes."""

    members: DataFrame
    pairs: DataFrame
    tokens: DataFrame


def text_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Classes and their tokens, written once."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text <> ''")
    return keep(rows.mapInArrow(_sets, SETS), "none")


def candidates(sets: DataFrame, up: int, down: int) -> DataFrame:
    """Pairs of classes that share enough prefix shingles."""
    spark = sets.sparkSession
    tokens = sets.where("kind = 1").select("class_id", "tokens")
    total = tokens.agg(F.coalesce(F.sum(F.length("tokens")), F.lit(0))).first()[0]
    bits = min(max((total // TOKEN_BYTES // 2).bit_length(), LEAST_SKETCH_BITS), MOST_SKETCH_BITS)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    levels = spark.sparkContext.broadcast(sketch(tokens, bits))  # 2**MOST_SKETCH_BITS bytes at most
    packed = tokens.mapInArrow(_prefixes(levels, bits, parts, up, down), "part int, records binary, postings binary")
    met = packed.repartitionById(parts, F.col("part")).mapInArrow(_meet(up, down), PAIRS)
    return met.groupBy("class_a", "class_b").agg(F.sum("hits").alias("hits"), F.min("needed").alias("needed")).where("hits >= needed").select("class_a", "class_b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "body", up: int = 4, down: int = 5) -> Near:
    """Classes of equal shingle sets and the pairs of classes with a Jaccard similarity of up / down or more."""
    sets = text_sets(df, id_col, text_col)
    members = sets.where("kind = 0").select("doc_id", "class_id").distinct()
    tokens = sets.where("kind = 1").select("class_id", "tokens")
    found = keep(candidates(sets, up, down))
    return Near(members, verified(found, tokens, up, down), tokens)


def expanded(near: Near) -> DataFrame:
    """All pairs of records (doc_id_a, doc_id_b): of linked classes and of equal texts."""
    one = near.members.select(F.col("class_id").alias("class_a"), F.col("doc_id").alias("one"))
    two = near.members.select(F.col("class_id").alias("class_b"), F.col("doc_id").alias("two"))
    same = near.members.groupBy("class_id").count().where("count > 1").select(F.col("class_id").alias("class_a"), F.col("class_id").alias("class_b"))
    links = near.pairs.select("class_a", "class_b").unionByName(same)
    out = links.join(one, "class_a").join(two, "class_b").where("class_a <> class_b or one < two")
    return out.select(F.least("one", "two").alias("doc_id_a"), F.greatest("one", "two").alias("doc_id_b")).where("doc_id_a <> doc_id_b").distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records that share at least 0.60 of their three-word sequences."""
    return expanded(near_duplicates(table(spark, sf_dir, "cleaned"), up=3, down=5))


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a record: its class of equal texts and how many other classes that is linked to."""
    near = near_duplicates(table(spark, sf_dir, "cleaned"), up=3, down=5)
    ends = near.pairs.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    return near.members.join(ends, "class_id", "left").select("doc_id", "class_id", F.coalesce("links", F.lit(0)).alias("links"))


QUERIES = {"p7_found": p7_found, "p7_classes": p7_classes}
SQL: dict[str, str] = {}
