"""Problem 2: oversized texts in pieces, cut at natural boundaries.

Content-defined chunking.  A rolling hash over 32 code points marks landmarks;
a piece ends at the first landmark between its least and most size, moved to
the nearest natural boundary: an end of a paragraph, section or code block,
else of a line, a sentence, a word.  As landmarks depend on the text around
them alone, an edit alters only the pieces near it.  Each piece repeats about
the last 200 characters of the one before, from a word's beginning.

A text above the limit is known by its second piece, a block above it by the
first cut that falls inside.

Null and empty texts have no pieces; texts up to the limit are one piece.
Repeated rows count once; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship, table
from .wordset import _values, mix, prefix_hash, _powers

LIMIT, OVERLAP, LEAST = 6000, 200, 3000
WINDOW, LANDMARK = 32, 1023
_FENCE = re.compile(r"[^\S\n]*(`{3,}|~{3,})")


def blocks(text: str) -> list[tuple[int, int, bool]]:
    """(begin, end, is code) of each block in code points, the last line end left out."""
    out: list[tuple[int, int, bool]] = []
    begin, end, fence, at = -1, -1, "", 0
    for line in text.split("\n"):
        stop = at + len(line)
        if fence:
            end = stop
            bare = line.strip()
            if len(bare) >= 3 and bare == fence * len(bare):
                out.append((begin, end, True))
                begin, fence = -1, ""
        elif m := _FENCE.match(line):
            if begin >= 0:
                out.append((begin, end, False))
            begin, end, fence = at, stop, m[1][0]
        elif not line or line.isspace():
            if begin >= 0:
                out.append((begin, end, False))
                begin = -1
        else:
            if begin < 0:
                begin = at
            end = stop
        at = stop + 1
    if begin >= 0:
        out.append((begin, end, bool(fence)))
    return out


def landmarks(points: np.ndarray) -> np.ndarray:
    """Positions behind which the rolling hash of the last 32 code points marks a landmark."""
    if len(points) < WINDOW:
        return np.zeros(0, np.int64)
    running = prefix_hash(_values()[points])
    _, inverse = _powers(len(running))
    h = mix((running[WINDOW:] - running[:-WINDOW]) * inverse[: len(points) - WINDOW + 1])
    return np.flatnonzero((h & np.uint64(LANDMARK)) == 0) + WINDOW


def boundaries(text: str, found: list[tuple[int, int, bool]]) -> list[np.ndarray]:
    """Natural boundaries, best first: blocks, lines, sentences, words. Each is the position where the next piece would begin."""
    starts = np.array([b for b, _, _ in found[1:]], np.int64)
    code = np.zeros(len(text) + 2, np.int8)
    for b, e, c in found:
        if c:
            code[b + 1] += 1
            code[e + 1] -= 1
    inside = np.cumsum(code)
    lines = np.array([m.end() for m in re.finditer(r"\n", text)], np.int64)
    sentences = np.array([m.end() for m in re.finditer(r"[.!?。！？।][»”\"')\]]*\s*", text)], np.int64)
    words = np.array([m.end() for m in re.finditer(r"\s+", text)], np.int64)
    out = [starts]
    for x in (lines, sentences, words):
        x = x[x < len(text)] if len(x) else x
        out.append(x[inside[x] == 0] if len(x) else x)
    out.append(lines)  # lines of code, where a block of code alone is too long
    return out


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP, least: int = LEAST) -> list[int]:
    """Where pieces end; the last one is the text's length."""
    most = limit - overlap - overlap // 4
    least = min(least, most // 2)
    if len(text) <= limit:
        return [len(text)] if text else []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    marks, kinds = landmarks(np.minimum(points, 0x10FFFF)), boundaries(text, blocks(text))
    out, begin = [], 0
    while len(text) - begin > most:
        low, high = begin + least, begin + most
        k = int(np.searchsorted(marks, low))
        aim = int(marks[k]) if k < len(marks) and marks[k] <= high else high
        cut = aim
        for kind in kinds:
            a, b = np.searchsorted(kind, [low, high + 1])
            if b > a:
                near = kind[a:b]
                cut = int(near[np.argmin(np.abs(near - aim))])
                break
        out.append(cut)
        begin = cut
    return [*out, len(text)]


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(begin, end) of each piece, overlaps included."""
    out, last = [], 0
    for cut in cuts(text, limit, overlap):
        begin = max(0, last - overlap)
        if begin:
            m = re.compile(r"\s+").search(text, max(0, begin - overlap // 4), min(last, begin + overlap // 4))
            begin = m.end() if m else begin
        out.append((begin if last else 0, cut))
        last = cut
    return out


def cut_blocks(text: str, ends: list[int], limit: int = LIMIT) -> dict[int, list[int]]:
    """By piece number, the blocks above the limit (numbered from 1) that the piece's end is the first to cut.

    A block above the limit can't stay whole, so each has such a cut.
    """
    found = blocks(text)
    first = [b for b, _, _ in found]
    out: dict[int, list[int]] = {}
    for piece, cut in enumerate(ends[:-1], 1):
        k = int(np.searchsorted(first, cut, side="left"))  # the last block that begins before the cut
        if k and cut < found[k - 1][1] and found[k - 1][1] - found[k - 1][0] > limit and (piece == 1 or ends[piece - 2] <= found[k - 1][0]):
            out[piece] = [k]
    return out


PIECES = "doc_id string, piece_no int, start_pos bigint, end_pos bigint, n_chars int, text string, cut_blocks array<int>"


def _run(limit: int, overlap: int, with_text: bool):
    schema = pa.schema([("doc_id", pa.string()), ("piece_no", pa.int32()), ("start_pos", pa.int64()), ("end_pos", pa.int64()), ("n_chars", pa.int32()), ("text", pa.string()), ("cut_blocks", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                made = pieces(text, limit, overlap)
                cut = cut_blocks(text, [e for _, e in made], limit)
                for k, (b, e) in enumerate(made, 1):
                    rows.append((doc, k, b + 1, e, e - b, text[b:e] if with_text else None, cut.get(k, [])))
                if len(rows) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def split(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True, all_texts: bool = False) -> DataFrame:
    """Pieces of the texts above the limit (of all texts if asked), in order, each with the number of the block that alone is too long and that its end is the first to cut."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where(F.length("text") > (0 if all_texts else limit))
    return rows.mapInArrow(_run(limit, overlap, with_text), PIECES)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, block_no): 0 for each body above the limit, and each of its blocks that alone is above it."""
    made = split(table(spark, sf_dir, "cleaned"), "doc_id", "body", with_text=False).where("doc_id is not null")
    several = F.when(F.col("piece_no") == 2, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return made.select("doc_id", F.explode(F.concat(several, "cut_blocks")).alias("block_no")).distinct()


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all oversized bodies."""
    return split(table(spark, sf_dir, "cleaned"), "doc_id", "body").drop("cut_blocks").distinct()


QUERIES = {"p2_found": p2_found, "p2_pieces": p2_pieces}
SQL: dict[str, str] = {}
