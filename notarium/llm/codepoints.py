"""Text as it looks: one code-point form for everything that reads the same.

Whole Arrow batches are turned into one array of code points, mapped through
lookup tables (gather plus expansion offsets), put into canonical mark order
and composed, all with array operations and without a call per row.

Rules: letters of any width become the plain ones, combining accents are
composed, each white-space character becomes one space (line breaks one line
feed), characters that show nothing vanish, and letters or hyphens drawn like
others become the Latin (or ASCII) one.  Case, punctuation and spelled-out
umlauts stay.  Null stays null, empty stays empty.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters of other scripts drawn like a Latin letter.
LOOK_ALIKE = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ԝ": "W", "Х": "X", "Ү": "Y", "У": "Y", "Ӏ": "I",
    # Greek
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j", "ι": "i", "υ": "u", "κ": "k", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Cyrillic drawn like Greek, dotless and script letters
    "Г": "Γ", "П": "Π", "Ф": "Φ", "к": "k", "ı": "i", "ɡ": "g", "ɑ": "a", "ſ": "s",
    # Armenian and others
    "օ": "o", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "զ": "q",
    # hyphens
    "‐": "-", "‑": "-", "﹣": "-", "˗": "-", "­": "",
}

#: Characters beyond category Cf that show nothing.
INVISIBLE = [(0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF)]

BREAKS = "\n\r\v\f\x1c\x1d\x1e\x85  "
TOP = 0x110000
GONE = np.uint32(0xFFFFFFFF)
LETTER, DIGIT, MARK, SPACE, DENSE, UPPER, LOWER = 1, 2, 4, 8, 16, 32, 64


def _visible(ch: str) -> str:
    """The lookup rule for one character."""
    cp = ord(ch)
    if ch in BREAKS:
        return "\n"
    if ch == "\t" or ch == "​" or unicodedata.category(ch) in ("Zs", "Cf", "Cc"):
        if unicodedata.category(ch) == "Zs" or ch == "\t":
            return " "
        return "" if unicodedata.category(ch) == "Cf" else ch
    if any(a <= cp <= b for a, b in INVISIBLE):
        return ""
    out = []
    for x in unicodedata.normalize("NFD", ch) if not 0xAC00 <= cp <= 0xD7A3 else ch:
        kind, _, rest = unicodedata.decomposition(x).partition(" ")
        if kind in ("<wide>", "<narrow>"):
            wide = "".join(chr(int(h, 16)) for h in rest.split())
            out.append(wide if wide == x else "".join(_visible(w) for w in wide))
        else:
            out.append(LOOK_ALIKE.get(x, x))
    return "".join(out)


@lru_cache(maxsize=1)
def tables() -> dict[str, np.ndarray]:
    """Lookup tables, made by rule once in each worker."""
    length = np.ones(TOP, np.uint8)
    start = np.arange(TOP, dtype=np.int64)
    pool = [np.arange(TOP, dtype=np.uint32)]
    extra: list[int] = []
    ccc = np.zeros(TOP, np.uint8)
    kind = np.zeros(TOP, np.uint8)
    lower = np.arange(TOP, dtype=np.uint32)
    pairs: dict[int, int] = {}
    ranges = [range(0x0, 0xAC00), range(0xD7B0, 0xD800), range(0xF900, 0x20000), range(0x2F800, 0x2FA20), range(0xE0000, 0xE0200)]
    for cp in (x for r in ranges for x in r):
        ch = chr(cp)
        cat = unicodedata.category(ch)
        if cat[0] == "L":
            kind[cp] |= LETTER | (UPPER if cat in ("Lu", "Lt") else LOWER if cat == "Ll" else 0)
        elif cat[0] == "N":
            kind[cp] |= DIGIT
        elif cat[0] == "M":
            kind[cp] |= MARK
        if ch.isspace():
            kind[cp] |= SPACE
        ccc[cp] = unicodedata.combining(ch)
        if cat == "Lu" and len(ch.lower()) == 1:
            lower[cp] = ord(ch.lower())
        to = _visible(ch)
        if to != ch:
            length[cp] = len(to)
            start[cp] = TOP + len(extra)
            extra.extend(map(ord, to))
        two = unicodedata.decomposition(ch).split(" ")
        if len(two) == 2 and two[0][0] != "<" and unicodedata.normalize("NFC", ch) == ch:
            base, mark = (int(h, 16) for h in two)
            base = ord(LOOK_ALIKE.get(chr(base)) or chr(base))
            pairs.setdefault((base << 21) | mark, cp)
    # a composed letter of another script drawn like a Latin one: the lowest code point stands for both
    for cp in range(0xAC00, 0xD7A4):
        kind[cp] |= LETTER
    for a, b in ((0x20000, 0x2F800), (0x2FA20, 0x32000)):
        kind[a:b] |= LETTER
    for a, b in ((0x0E00, 0x0E80), (0x3005, 0x3008), (0x3040, 0x3100), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFF9E), (0x20000, 0x32000)):
        kind[a:b] |= np.where(kind[a:b] & LETTER, DENSE, 0).astype(np.uint8)
    pool.append(np.array(extra, np.uint32))
    keys = np.array(sorted(pairs), np.int64)
    second = np.zeros(TOP, bool)
    second[keys & 0x1FFFFF] = True
    single = np.arange(TOP, dtype=np.uint32)
    hard = second.copy()  # marks that may join the letter before
    for cp in np.flatnonzero(start != np.arange(TOP)).tolist():
        form = extra[start[cp] - TOP : start[cp] - TOP + int(length[cp])]
        made = _compose(np.array(form, np.uint32), np.zeros(len(form), np.int64), {"ccc": ccc, "second": second, "keys": keys, "composed": np.array([pairs[k] for k in keys.tolist()], np.uint32)})[0] if len(form) > 1 else form
        single[cp] = made[0] if len(made) == 1 else GONE
        hard[cp] |= len(made) > 1 or (len(made) == 1 and bool(second[made[0]] or ccc[made[0]]))
    hard[0x1161:0x1176] = hard[0x11A8:0x11C3] = True
    hard |= (ccc > 0) & (ccc != 7) & (ccc != 9) & ~((np.arange(TOP) >= 0x0E00) & (np.arange(TOP) < 0x0F00)) & (np.arange(TOP) >= 0x300) & (np.arange(TOP) < 0x370)
    return {"single": single, "hard": hard, "length": length, "start": start, "pool": np.concatenate(pool), "ccc": ccc, "kind": kind, "lower": lower, "keys": keys, "composed": np.array([pairs[k] for k in keys.tolist()], np.uint32), "second": second}


def to_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a whole Arrow string array and where each row begins (rows + 1 offsets); null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = memoryview(data)[offsets[0] : offsets[-1]] if data is not None and len(texts) else b""
    points = np.frombuffer(str(raw, "utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return points, at


def to_arrow(points: np.ndarray, at: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """The Arrow string array of code points."""
    size = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    ends = np.concatenate([[0], np.cumsum(size)])[at]
    data = points.astype("<u4").tobytes().decode("utf-32-le", "replace").encode("utf-8", "replace")
    bits = pa.array(valid).buffers()[1] if valid is not None else None
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [bits, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data)])


def _compose(points: np.ndarray, rows: np.ndarray, t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Canonical order, then composition; rows: the row of each point."""
    ccc = t["ccc"][points]
    marked = ccc > 0
    if marked.any():
        fresh = np.concatenate([[True], rows[1:] != rows[:-1]])
        wrong = np.flatnonzero(marked[1:] & (ccc[1:] < ccc[:-1]) & ~fresh[1:]) + 1
        if len(wrong):
            group = np.cumsum(~marked | fresh)
            part = np.flatnonzero(np.isin(group, group[wrong]) & marked)
            order = np.lexsort((part, ccc[part], group[part]))
            points = points.copy()
            points[part] = points[part[order]]
            ccc = t["ccc"][points]
    while True:
        able = np.flatnonzero(t["second"][points])
        if not len(able) or not len(points):
            return points, rows
        ccc = t["ccc"][points]
        starters = np.flatnonzero(ccc == 0)
        if not len(starters):
            return points, rows
        at = np.searchsorted(starters, able, side="left") - 1  # the last starter before
        able, at = able[at >= 0], at[at >= 0]
        base = starters[at]
        before = able - 1
        free = (base == before) | ((ccc[before] < ccc[able]) & (ccc[before] > 0))
        free &= rows[base] == rows[able]
        able, base = able[free], base[free]
        key = (points[base].astype(np.int64) << 21) | points[able]
        slot = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
        hit = t["keys"][slot] == key
        able, base, slot = able[hit], base[hit], slot[hit]
        if not len(able):
            return points, rows
        base, first = np.unique(base, return_index=True)
        able, slot = able[first], slot[first]
        clash = np.isin(base, able)  # a starter that itself joins the one before waits for the next pass
        base, able, slot = base[~clash], able[~clash], slot[~clash]
        points = points.copy()
        points[base] = t["composed"][slot]
        keep = np.ones(len(points), bool)
        keep[able] = False
        points, rows = points[keep], rows[keep]


def _fold_fully(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decompose, map, order and compose everything."""
    t = tables()
    n = len(at) - 1
    length = t["length"][points].astype(np.int64)
    ends = np.cumsum(length)
    first = ends - length
    source = np.repeat(t["start"][points] - first, length) + np.arange(int(ends[-1]) if len(ends) else 0)
    out = t["pool"][source]
    per_row = np.concatenate([[0], ends])[at]
    rows = np.repeat(np.arange(n), np.diff(per_row))
    out, rows = _hangul(*_compose(out, rows, t))
    return out, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int64)


def _hangul(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Conjoining jamo as syllables: lead and vowel, then what ends them."""
    for second, base in ((0x1161, 0x1100), (0x11A8, 0xAC00)):
        if len(points) < 2:
            return points, rows
        a, b = points[:-1].astype(np.int64), points[1:].astype(np.int64)
        same = rows[1:] == rows[:-1]
        if base == 0x1100:
            hit = np.flatnonzero(same & (a >= 0x1100) & (a < 0x1113) & (b >= second) & (b < 0x1176))
            made = 0xAC00 + ((a[hit] - 0x1100) * 21 + b[hit] - second) * 28
        else:
            hit = np.flatnonzero(same & (a >= 0xAC00) & (a < 0xD7A4) & ((a - 0xAC00) % 28 == 0) & (b >= second) & (b < 0x11C3))
            made = a[hit] + b[hit] - 0x11A7
        if len(hit):
            points = points.copy()
            points[hit] = made
            keep = np.ones(len(points), bool)
            keep[hit + 1] = False
            points, rows = points[keep], rows[keep]
    return points, rows


def take_rows(points: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The points of the given rows."""
    size = at[rows + 1] - at[rows]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return points[np.repeat(at[rows] - (ends - size), size) + np.arange(total)], np.concatenate([[0], ends]).astype(np.int64)


def fold_points(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and row offsets of the text as it looks.

    Characters whose form is one character are mapped by a single gather; only
    rows that hold marks to compose or order, or characters that expand, take
    the full way.
    """
    t = tables()
    if not len(points):
        return points, at
    hard = np.flatnonzero(t["hard"][points])
    out = t["single"][points]
    keep = out != GONE
    if keep.all():
        out_at = at
    else:
        out_at = np.concatenate([[0], np.cumsum(keep)])[at]
        out = out[keep]
    if not len(hard):
        return out, out_at
    rows = np.unique(np.searchsorted(at, hard, side="right") - 1)
    full, full_at = _fold_fully(*take_rows(points, at, rows))
    size = np.diff(out_at)
    begin = out_at[:-1].copy()
    size[rows] = np.diff(full_at)
    begin[rows] = full_at[:-1] + len(out)
    ends = np.cumsum(size)
    both = np.concatenate([out, full])
    return both[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]))], np.concatenate([[0], ends]).astype(np.int64)


def fold(texts: pa.Array) -> pa.Array:
    """Arrow strings in, the same in the form as they look out; null stays null."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    points, at = fold_points(*to_points(texts))
    return to_arrow(points, at, texts.is_valid().to_numpy(zero_copy_only=False) if texts.null_count else None)
