"""Problem 10: the sentences of every text, in all its languages and scripts.

A text is cut into units (headings, list items, quotes, paragraphs; fenced code
is none).  Inside a unit every end mark that a gap follows, every end mark of a
dense script, and every gap of Thai text is a candidate, unless it stands
inside quotation marks or brackets that are closed in the unit.  A
maximum-entropy model over the neighbouring tokens, their case, length, digits
and script, the marks between and what is known of the token before decides;
frequent tokens before a mark are features of their own.
It is trained here on reliable boundaries of a bounded sample
(``SAMPLE_ROWS`` texts): end marks before a capital behind an ordinary word are
boundaries, gaps before a small letter and behind abbreviations are not.
Abbreviations are learned from counts over all texts, as tokens that nearly
always carry a period and hardly ever end a unit; a list of common ones serves
small inputs.

Null and empty texts have no sentences; positions count code points from 1;
repeated rows count once; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import keep, ship, table
from .markdown import fences

SAMPLE_ROWS = 3000
#: Hits a token needs to count as an abbreviation, also as a share of all tokens with a period: a million tokens at most.
LEAST_HITS, LEAST_RATE = 4, 1e-6
#: Letters of an abbreviation at most.
MOST_LETTERS = 8
#: Hits in the sample from which a token before a mark is a feature of its own.
TOKEN_HITS = 20

#: Common abbreviations that a name, number or further word follows.
ABBREVIATIONS = set(
    """Abb Abs Abschn Art Aufl Bd Bsp Dr Fa Fr Hr Hrsg Jh Kap Mio Mrd Nr Prof Sek Str Tab Tel bzw ca evtl ggf inkl max
    min sog vgl usf zzgl Zit geb
    Capt Col Corp Fig Figs Gen Gov Hon Inc Jr Ltd Mr Mrs Ms No Nos Ref Rep Rev Sec Sen Sgt Sr St Vol Vols approx cf
    ch dept ed eds esp est incl pp vs viz Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec
    Mme Mlle MM Mgr chap env fig vol art éd
    Sra Srta Dra Ud Uds aprox cap máx mín núm pág págs tel vid
    Sig Sigg sig dott Dott ing avv cfr ecc pag pagg cap
    Dhr Mevr blz bijv nr resp mw dhr mevr
    βλ κ σελ αρ Αρ περ κεφ εικ
    г гл им рис см стр Стр макс мин прим тел тыс ул напр
    डॉ प्रो श्री""".split()
)
#: Abbreviations that may end a sentence.
MAY_END = set("etc usw ecc enz osv κλπ κτλ и.т.д т.д др al".split())

OPEN, CLOSE = "([{（「『【《〈", ")]}）」』】》〉"
_PAIR = dict(zip(CLOSE, OPEN, strict=True))
QUOTES = "\"'‘’‚“”„«»"
_MARK = re.compile("[" + re.escape(OPEN + CLOSE + QUOTES) + "]")
_CAND = re.compile("[.!?…。！？．｡।॥;\u037e]+")
_THAI_GAP = re.compile(r"\s+(?=\S)")
_THAI = re.compile(r"[฀-๿]")
_GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]")
_CLOSERS = CLOSE + "\"'’“”«»‘*_"
_EMOJI = "\U0001f000-\U0001faff☀-➿⭐⬀-⯿️‍"
_AFTER = re.compile(rf"[^\S\n]*(?:[{_EMOJI}]+[^\S\n]*)*")
_GAP = re.compile(r"\s*")
_QUOTED_GAP = re.compile(r"(?:\s|(?<=\n)[^\S\n]*>[^\S\n]?)*")
_HEADING = re.compile(r"[^\S\n]*#{1,6}[^\S\n]+")
_ITEM = re.compile(r"[^\S\n]*(?:[-*+•‣◦]|\d{1,3}[.)])[^\S\n]+(?:\[[ xX]\][^\S\n]+)?")
_QUOTE = re.compile(r"[^\S\n]*(?:>[^\S\n]*)+(?:\[![^\]\n]*\][-+]?[^\S\n]*)?")
_RULE = re.compile(r"[^\w]*$")
_SPECIAL = re.compile(r"[^\S\n]*(?:#|>|[-*+•‣◦]|\d)")
_TOKEN_BEFORE = re.compile(r"[^\s()\[\]（）「」『』“”„«»\"‘¿¡]+$")
DENSE_MARKS = set("。！？．｡")


def units(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of each unit: h heading, l list item, q quote, p paragraph."""
    out: list[tuple[int, int, str]] = []
    code = fences(text)
    next_code, at = 0, 0
    begin, end, kind = -1, -1, ""
    for line in text.split("\n"):
        start, at = at, at + len(line) + 1
        while next_code < len(code) and code[next_code][1] < start:
            next_code += 1
        fenced = next_code < len(code) and code[next_code][0] <= start
        if fenced or not line or line.isspace():
            if begin >= 0:
                out.append((begin, end, kind))
                begin = -1
            continue
        stop = start + len(line.rstrip())
        if _SPECIAL.match(line):
            if m := _HEADING.match(line):
                if begin >= 0:
                    out.append((begin, end, kind))
                    begin = -1
                out.append((start + m.end(), stop, "h"))
                continue
            if m := _ITEM.match(line):
                if begin >= 0:
                    out.append((begin, end, kind))
                begin, end, kind = start + m.end(), stop, "l"
                continue
            if m := _QUOTE.match(line):
                if kind == "q" and begin >= 0 and m.end() < len(line.rstrip()):
                    end = stop
                    continue
                if begin >= 0:
                    out.append((begin, end, kind))
                    begin = -1
                if m.end() < len(line.rstrip()):
                    begin, end, kind = start + m.end(), stop, "q"
                continue
        if begin < 0:
            begin, kind = start + len(line) - len(line.lstrip()), "p"
        end = stop
    if begin >= 0:
        out.append((begin, end, kind))
    return out


def protected(u: str) -> list[tuple[int, int]]:
    """Outermost (open, close) positions of quotation marks and brackets that are closed in the unit."""
    stack: list[tuple[str, int]] = []
    spans: list[tuple[int, int]] = []

    def close(opens: str, at: int) -> bool:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in opens:
                spans.append((stack[k][1], at))
                del stack[k:]
                return True
        return False

    for m in _MARK.finditer(u):
        c, i = m[0], m.start()
        if c in OPEN:
            stack.append((c, i))
        elif c in CLOSE:
            close(_PAIR[c], i)
        elif c in "„‚":
            stack.append((c, i))
        elif c == "“":
            close("„", i) or stack.append((c, i))
        elif c == "”":
            close("“„", i)
        elif c == "«":
            close("»", i) or stack.append((c, i))
        elif c == "»":
            close("«", i) or stack.append((c, i))
        elif c == '"':
            close('"', i) or stack.append((c, i))
        else:
            before = u[i - 1] if i else " "
            after = u[i + 1] if i + 1 < len(u) else " "
            if c == "‘":
                close("‚", i) or stack.append((c, i))
            elif c == "’":
                after.isalnum() or close("‘‚", i)
            elif not before.isalnum() and before not in ".!?…" and after.isalnum():
                stack.append((c, i))
            elif not after.isalnum():
                close("'", i)
    spans.sort()
    out: list[tuple[int, int]] = []
    for s in spans:
        if not out or s[0] > out[-1][1]:
            out.append(s)
    return out


def _next_class(u: str, k: int) -> str:
    if k >= len(u):
        return "end"
    c = u[k]
    opened = ""
    while c in "([{（「『【《“„«»\"'‘‚¿¡*_" and k + 1 < len(u):
        opened = "o"
        k += 1
        c = u[k]
    if c.isalpha():
        return opened + ("U" if c.isupper() or c.istitle() else "l" if c.islower() else "n")
    return opened + ("d" if c.isdigit() else "x")


def _word_class(w: str) -> str:
    if not w:
        return "none"
    if w.isdigit():
        return "num2" if len(w) <= 2 else "num"
    if any(c.isdigit() for c in w):
        return "mixed"
    if "." in w:
        return "dotted"
    n = len(w)
    return "one" if n == 1 else "short" if n <= 3 else "word"


def candidates(u: str, kind: str) -> list[tuple[int, tuple[str, ...], str]]:
    """(where the next sentence would begin, features, token before) of each candidate of a unit."""
    out = []
    spans = protected(u) if _MARK.search(u) else []
    thai = bool(_THAI.search(u)) and 3 * len(_THAI.findall(u)) > len(u)
    greek = None
    s = 0
    gap_of = _QUOTED_GAP if kind == "q" else _GAP
    for m in _CAND.finditer(u):
        a, b = m.span()
        run = m[0]
        if ";" in run:
            if greek is None:
                greek = 3 * len(_GREEK.findall(u)) > len(u)
            if not greek:
                continue
        while s < len(spans) and spans[s][1] < a:
            s += 1
        e, closer = b, ""
        inside = s < len(spans) and spans[s][0] < a
        while e < len(u) and u[e] in _CLOSERS:
            if not inside and s < len(spans) and e == spans[s][0]:
                break  # an opening mark
            if u[e] == "«" or u[e] == "»" or u[e] == "“" or u[e] in "\"'":
                if not inside and not any(x[1] == e for x in spans[max(0, s - 1) : s + 1]):
                    break
            closer = "b" if u[e] in CLOSE and u[e] in ")]}）】》〉" else "q" if u[e] not in "*_" else closer
            e += 1
        if inside:
            k = b
            while k < len(u) and (u[k] in _CLOSERS or u[k] in "   ") and k < spans[s][1]:
                k += 1
            if k < spans[s][1]:
                continue  # inside quotation marks or brackets
            e = max(e, spans[s][1] + 1)
            closer = "b" if u[spans[s][1]] in ")]}）】》〉" else "q"
            while e < len(u) and u[e] in CLOSE + "”’*_":
                closer = "b" if u[e] in ")]}）】》〉" else closer
                e += 1
        if e >= len(u):
            continue
        dense = run[-1] in DENSE_MARKS
        after = _AFTER.match(u, e).end()
        k = gap_of.match(u, after).end()
        if k >= len(u):
            continue
        gap = k > e
        if not gap and not dense:
            continue
        nxt = _next_class(u, k)
        if nxt.endswith("x") and not (gap and u[k] in "¿¡-–—") and u[k] not in "「（“『":
            continue
        term = "dense" if dense else "danda" if run[-1] in "।॥" else "dots" if "…" in run or run.startswith("..") else "." if run == "." else "greek" if ";" in run or "\u037e" in run else "!"
        before = _TOKEN_BEFORE.search(u, max(0, a - 40), a)
        token = before[0] if before else ""
        mood = "emoji" if after > e and u[e:after].strip() else "gap" if gap else "close"
        out.append((k, (term, nxt, _word_class(token), closer, mood), token))
    if thai:
        s = 0
        taken = {c[0] for c in out}
        for m in _THAI_GAP.finditer(u):
            a, k = m.span()
            while s < len(spans) and spans[s][1] < a:
                s += 1
            if s < len(spans) and spans[s][0] < a or a == 0:
                continue
            k = gap_of.match(u, k).end()
            prev = u[a - 1]
            if k in taken or k >= len(u):
                continue
            out.append((k, ("thai", _next_class(u, k), "T" if _THAI.match(prev) else "c" if prev in _CLOSERS else "d" if prev.isdigit() else "x", "", "gap"), ""))
        out.sort(key=lambda c: c[0])
    return out


def _joint(f: tuple[str, ...]) -> list[tuple]:
    """Indicator features of a candidate: the parts, their pairs, and the token before where it is frequent."""
    term, nxt, prev, closer, mood, known, token = f
    own = [(12, token), (13, token, nxt)] if token else []
    return [*own, (0, term), (1, nxt), (2, prev), (3, closer), (4, mood), (5, known), (6, term, nxt), (7, term, closer, nxt), (8, known, nxt), (9, prev, nxt, term), (10, term, known), (11, term, closer, mood)]


class Model:
    """Maximum-entropy model over indicator features, and what is known of tokens before a period."""

    def __init__(self, weights: dict, abbreviations: set[str], may_end: set[str] = frozenset(), tokens: set[str] = frozenset()):
        self.weights, self.abbreviations, self.may_end, self.tokens = weights, abbreviations, may_end, tokens
        self.decided: dict[tuple, bool] = {}

    def __getstate__(self):
        return {"weights": self.weights, "abbreviations": self.abbreviations, "may_end": self.may_end, "tokens": self.tokens}

    def __setstate__(self, s):
        self.__init__(s["weights"], s["abbreviations"], s["may_end"], s["tokens"])

    def known(self, token: str) -> str:
        bare = token.lstrip("'’-–—*_")
        if bare in MAY_END or bare in self.may_end:
            return "may"
        return "abbr" if bare in self.abbreviations or bare in ABBREVIATIONS else "no"

    def cuts(self, f: tuple[str, ...], token: str) -> bool:
        key = (*f, self.known(token) if f[0] == "." else "no", token if token in self.tokens else "")
        got = self.decided.get(key)
        if got is None:
            got = self.decided[key] = sum(self.weights.get(j, 0.0) for j in _joint(key)) > 0
        return got

    def starts(self, text: str) -> list[tuple[int, int]]:
        """(begin, end) of each sentence."""
        out = []
        for begin, end, kind in units(text):
            u = text[begin:end]
            if _RULE.match(u):
                continue
            if kind == "h":
                out.append((begin, end))
                continue
            at = 0
            for k, f, token in candidates(u, kind):
                if k > at and self.cuts(f, token):
                    out.append((begin + at, begin + len(u[:k].rstrip())))
                    at = k
            out.append((begin + at, end))
        return out


#: Reliable candidates that every model learns from, whatever the sample: features, known, answer.
PRIOR = [
    *((("!", n, p, "", "gap", "no"), 1) for n in ("U", "oU", "d", "n", "oxn") for p in ("word", "short", "num")),
    *((("!", "l", p, c, "gap", "no"), 0) for p in ("word", "short") for c in ("", "q", "b")),
    *(((".", n, "word", "", "gap", "no"), 1) for n in ("U", "oU", "d", "od", "n")),
    *(((".", n, "word", c, "gap", "no"), 1) for n in ("U", "oU") for c in ("b", "q")),
    *(((".", "l", p, c, "gap", k), 0) for p in ("word", "short", "one", "dotted") for c in ("", "q", "b") for k in ("no", "abbr", "may")),
    *(((".", n, p, "", "gap", "abbr"), 0) for n in ("U", "d", "oU", "n") for p in ("word", "short", "one", "dotted")),
    *(((".", n, "one", "", "gap", "no"), 0) for n in ("U", "l")),
    *(((".", n, "num2", "", "gap", "no"), 0) for n in ("U", "l", "d")),
    *(((".", n, "num", "", "gap", "no"), 1) for n in ("U", "oU")),
    *(((".", n, "mixed", "", "gap", "no"), 1) for n in ("U", "oU")),
    *(((".", n, p, "", "gap", "may"), 1) for n in ("U", "oU", "d") for p in ("word", "short", "one")),
    *((("dots", n, p, "", "gap", "no"), 1) for n in ("U", "oU", "n") for p in ("word", "none", "short")),
    *((("dots", "l", p, "", "gap", "no"), 0) for p in ("word", "none", "short")),
    *((("danda", n, "word", c, "gap", "no"), 1) for n in ("n", "U", "on", "oU", "d", "l") for c in ("", "b")),
    *((("danda", n, p, "q", "gap", "no"), 0) for n in ("n", "U", "l", "d") for p in ("word", "short")),
    *((("!", "n", p, "q", "gap", "no"), 0) for p in ("word", "short", "none")),
    *((("!", "U", p, "q", "gap", "no"), 1) for p in ("word", "short", "none")),
    *((("dense", n, "word", c, m, "no"), 1) for n in ("n", "U", "on", "oU", "d", "l", "ox") for c in ("", "b") for m in ("close", "gap", "emoji")),
    *((("dense", n, "word", "q", "close", "no"), 0) for n in ("n", "U", "l", "d")),
    *((("greek", n, "word", "", "gap", "no"), 1) for n in ("U", "oU", "d")),
    *((("greek", "l", "word", c, "gap", "no"), 0) for c in ("", "q")),
    *((("thai", n, p, "", "gap", "no"), 1) for n in ("n", "U", "on", "oU", "d", "l") for p in ("T", "c", "d")),
    *(((t, n, "word", "", "emoji", "no"), 1) for t in (".", "!", "dots", "danda") for n in ("U", "n", "oU")),
]


_PERIOD = re.compile(r"(?<![^\s()\[\]（）「」『』“”„«»\"‘¿¡])([^\s()\[\]（）「」『』“”„«»\"‘¿¡]{1,%d})\.(?=\s+\S)" % MOST_LETTERS)
_LAST = re.compile(r"([^\s()«»„“”\"]+)\.\W*$")


def token_counts(text: str) -> tuple[Counter, Counter, Counter]:
    """Tokens of a text with a period inside a unit, those at a unit's end, and those without a period."""
    inside, ends, bare = Counter(), Counter(), Counter()
    for begin, end, kind in units(text):
        if kind == "h":
            continue
        u = text[begin:end]
        if last := _LAST.search(u[-200:]):
            ends[last[1]] += 1
        if "." in u:
            inside.update(_PERIOD.findall(u))
        bare.update(u.split())
    return inside, ends, bare


def _without_period(bare: Counter) -> Counter:
    """Counts of tokens between gaps to those of short words without a period, a comma or colon behind them left out."""
    out: Counter = Counter()
    for w, n in bare.items():
        w = w.rstrip(",;:")
        if w and len(w) <= MOST_LETTERS and w[-1] != ".":
            out[w] += n
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (token, inside, ends, bare), partial sums; only tokens that carry a period somewhere in the task."""
    total = (Counter(), Counter(), Counter())
    bare: Counter = Counter()

    def rows() -> pa.RecordBatch:
        names = [w for w in total[0] if w and not w[0].isdigit()]
        total[2].update(_without_period(bare))
        bare.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[w] for w in names], pa.int64()) for c in total)], ["token", "inside", "ends", "bare"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                for t, c in zip((total[0], total[1], bare), token_counts(text), strict=True):
                    t.update(c)
        if sum(map(len, total)) + len(bare) > 1_000_000:
            yield rows()
            for t in total:
                t.clear()
    if total[0]:
        yield rows()


def abbreviations(df: DataFrame, text_col: str) -> tuple[set[str], set[str]]:
    """By counts over all texts: tokens that nearly always carry a period and hardly ever end a unit, and single letters that do end units."""
    ship(df.sparkSession)
    by = df.select(text_col).mapInArrow(_counts, "token string, inside bigint, ends bigint, bare bigint").groupBy("token").agg(*(F.sum(c).alias(c) for c in ("inside", "ends", "bare")))
    kept = keep(by.where(f"inside >= {LEAST_HITS} and bare <= 0.1 * inside and (ends <= 0.02 * inside or length(token) = 1)"))
    total = kept.agg(F.sum("inside")).first()[0] or 0
    rows = kept.where(F.col("inside") >= LEAST_RATE * total).collect()  # 1 / LEAST_RATE rows at most
    return _sorted_out({r["token"]: (r["inside"], r["ends"], r["bare"]) for r in rows})


def _sorted_out(counts: dict[str, tuple[int, int, int]]) -> tuple[set[str], set[str]]:
    always = {w: (n, e) for w, (n, e, b) in counts.items() if n >= LEAST_HITS and not w[0].isdigit() and b <= 0.1 * n}
    return {w for w, (n, e) in always.items() if e <= 0.02 * n}, {w for w, (n, e) in always.items() if len(w) == 1 and e >= 0.1 * n}


def fit(texts: list[str], learned: tuple[set[str], set[str]] | None = None, rounds: int = 300) -> Model:
    """Learn weights from unlabelled texts, given abbreviations and letters that may end (by the same texts where there are none)."""
    if learned is None:
        counts = (Counter(), Counter(), Counter())
        for text in texts:
            for c, more in zip(counts, token_counts(text), strict=True):
                c.update(more)
        plain = _without_period(counts[2])
        learned = _sorted_out({w: (n, counts[1][w], plain[w]) for w, n in counts[0].items()})
    seen = [c for text in texts for begin, end, kind in units(text) if kind != "h" for c in candidates(text[begin:end], kind)]
    hits = Counter(token for _, f, token in seen if f[0] == ".")
    tokens = {w for w, n in hits.items() if n >= TOKEN_HITS and w}
    model = Model({}, *learned, tokens)
    counts: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    by_token: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for f, y in PRIOR:
        counts[(*f, "")][y] += 20.0
    for _, f, token in seen:
        term, nxt, prev, closer, _ = f
        known = model.known(token) if term == "." else "no"
        if known == "abbr" or (nxt == "l" and term in (".", "!", "dots", "greek")):
            y = 0
        elif term == "." and prev == "num2" and nxt == "U" and not closer:
            y = 0
        elif not closer and nxt in ("U", "oU") and (term in ("!", "dots", "greek") or (term == "." and prev == "word" and known == "no")):
            y = 1
        else:
            continue  # not reliable
        counts[(*f, known, "")][y] += 1
        if token in tokens:
            by_token[(*f, known, token)][y] += 1
    weights = _descend(counts, {}, rounds)
    # what the single tokens add to that
    return Model(_descend(by_token, weights, rounds), *learned, tokens)


def _descend(counts: dict[tuple, list[float]], fixed: dict, rounds: int) -> dict:
    """Weights of the features of labelled candidates by gradient ascent of the likelihood; those given stay."""
    names: dict[tuple, int] = {}
    rows = [[names.setdefault(j, len(names)) for j in _joint(k) if j not in fixed] for k in counts]
    base = np.array([sum(fixed.get(j, 0.0) for j in _joint(k)) for k in counts])
    of, at = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([k for r in rows for k in r], np.int64)
    n = np.array([np.log1p(sum(v)) for v in counts.values()])
    y = np.array([v[1] / sum(v) for v in counts.values()])
    w = np.zeros(len(names))
    for _ in range(rounds if len(w) else 0):
        p = 1 / (1 + np.exp(-base - np.bincount(of, weights=w[at], minlength=len(rows))))
        w -= 0.5 * (np.bincount(at, weights=(n * (p - y))[of], minlength=len(names)) / n.sum() * 8 + 1e-3 * w)
    return {**fixed, **{j: float(w[k]) for j, k in names.items()}}


def sample_model(df: DataFrame, id_col: str, text_col: str, rows: int = SAMPLE_ROWS) -> Model:
    """Abbreviations by all texts, weights by at most ``rows`` whole texts, chosen by a hash of the id."""
    ids = [r[0] for r in df.where(F.col(text_col) != "").select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(rows).collect()]
    # a short list of ids goes back as a filter, so that only their texts reach the driver
    got = df.where(F.col(id_col).isin(ids)).select(text_col).collect() if ids else []
    return fit(sorted({r[0] for r in got if r[0]}), abbreviations(df, text_col))


def _run(model, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                texts = batch.column(1).to_pylist()
                counts, first, last, parts = [], [], [], []
                for text in texts:
                    got = m.starts(text) if text else []
                    counts.append(len(got))
                    for a, b in got:
                        first.append(a)
                        last.append(b)
                    if with_text:
                        parts += [text[a:b] for a, b in got]
                counts = np.array(counts)
                take = np.repeat(np.arange(len(texts)), counts)
                number = np.arange(len(take)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
                arrays = [batch.column(0).take(pa.array(take)), pa.array(number.astype(np.int32)), pa.array(np.array(first, np.int32) + 1)]
                names = ["id", "sentence_no", "start_pos"]
                if with_text:
                    arrays += [pa.array(np.array(last, np.int32)), pa.array(parts, pa.string())]
                    names += ["end_pos", "sentence"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def sentences(df: DataFrame, id_col: str, text_col: str, with_text: bool = True, model: Model | None = None) -> DataFrame:
    """(id, sentence_no, start_pos, end_pos, sentence) of every sentence."""
    ship(df.sparkSession)
    model = model or sample_model(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few thousand weights and abbreviations
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    schema = f"id {kind}, sentence_no int, start_pos int" + (", end_pos int, sentence string" if with_text else "")
    return rows.mapInArrow(_run(shared, with_text), schema)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, start_pos) of every sentence of the documents."""
    found = sentences(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", with_text=False)
    return found.where("id is not null").select(F.col("id").alias("doc_id"), "start_pos")


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence with its text."""
    return sentences(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").withColumnRenamed("id", "doc_id")


QUERIES = {"p10_found": p10_found, "p10_sentences": p10_sentences}
SQL: dict[str, str] = {}
