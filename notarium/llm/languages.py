"""Problem 1: a language and a confidence for every text and every paragraph.

Rank-order profiles: the n-grams (n = 1 to 3) of a paragraph, most frequent
first, are compared with each language's profile by the out-of-place distance;
an n-gram that a profile lacks counts the most, and one that no profile holds
still takes its rank.  The profiles are trained here,
on a bounded sample of rows by their own labels (``SAMPLE_ROWS`` of each
language); as labels may be wrong, a second pass keeps only paragraphs that the
first profiles place where the label does.  A short text of every language is
always part of the training, so none lacks a profile on small inputs.

Prose is what is not heading, list, quote, table, code, formula or markup.  A
paragraph with too few letters, or with two languages almost equally near,
takes the language of the rest of the text; one whose n-grams next to no
profile holds is of a language without a profile (``und``).  Null, empty and prose-free texts
have no language (null) and are no case; repeated rows count once; further
columns are ignored; equal distances go to the first code by alphabet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship, table
from .batches import slices
from .codepoints import DENSE, GONE, LETTER, tables, to_points
from .markdown import without_fences

LANGUAGES = ["de", "el", "en", "es", "fr", "hi", "it", "ja", "nl", "ru", "th", "zh"]
PROFILE = 500
TABLE_BITS = 17
SAMPLE_ROWS = 150
#: Letters a paragraph needs (a dense letter counts three) and the least lead of the nearest language.
LEAST_LETTERS = 24
LEAST_LEAD = 0.1
LEAST_SENTENCE = 20
#: A paragraph of whose n-grams no more than this share is in any profile is in a language or script that has none: 'und'.
LEAST_HELD = 0.1
ASSIGNED = [*LANGUAGES, "und"]

#: Names of each language as labels give them.
NAMES = {
    "de": "de deu ger german deutsch allemand alemán tedesco duits немецкий",
    "el": "el ell gre greek griechisch grec griego greco grieks ελληνικά νέα-ελληνικά",
    "en": "en eng english englisch anglais inglés inglese engels английский",
    "es": "es spa spanish spanisch español castellano espagnol spagnolo spaans испанский",
    "fr": "fr fra fre french französisch français francés francese frans французский",
    "hi": "hi hin hindi हिन्दी हिंदी хинди",
    "it": "it ita italian italienisch italiano italien italiaans итальянский",
    "ja": "ja jpn japanese japanisch 日本語 japonais japonés giapponese japans японский",
    "nl": "nl nld dut dutch niederländisch nederlands néerlandais neerlandés olandese flemish vlaams",
    "ru": "ru rus russian russisch русский russe ruso russo",
    "th": "th tha thai thailändisch ไทย ภาษาไทย thaï tailandés",
    "zh": "zh zho chi chinese chinesisch 中文 汉语 漢語 普通话 chinois chino cinese chinees китайский cmn",
    "mul": "mul multilingual mehrsprachig multiple multilingue multilingüe meertalig mixed gemischt",
}
#: A sentence of each language (the first article of the Universal Declaration of Human Rights).
SEED = {
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen.",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.",
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros.",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité.",
    "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "th": "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ",
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
}

_BLANK = re.compile(r"\n(?:[^\S\n]*\n)+")
_SENTENCE = re.compile(r"(?<=[.!?…;])\s+|(?<=[。！？।])|(?<=[\u0e00-\u0e7f)”])\s+")
_MARKER = re.compile(
    r"[^\S\n]*(?:#{1,6}\s|>|[-*+•]\s|\d{1,3}[.)]\s|\||={2,}|!\[|\{[{|]|</?(?:h[1-6]|ul|ol|li|table|tbody|tr|td|th|pre|code|blockquote|hr)\b"
    r"|\\(?:(?:sub)*section|chapter|paragraph|begin|end|item|documentclass|usepackage|title|maketitle)\b|\\\\|\$|:::|\[\^|[-*_=~]{3,}\s*$)",
    re.I,
)
_NOISE = re.compile(r"`[^`\n]*`|\[\[[^\]\n]*\]\]|\]\([^)\n]*\)|https?://\S+|\$[^$\n]+\$|<script\b.*?</script>|<!--.*?-->|</?[A-Za-z][^<>]{0,120}>|\{\{[^}\n]*\}\}|\\[A-Za-z]+|[A-Za-z0-9.:~$-]*[\\/_][A-Za-z0-9.\\/_:~$-]*|&#?\w+;", re.S | re.I)


def paragraphs(text: str) -> list[str]:
    """The prose paragraphs of a text, without code, links and markup."""
    text = without_fences(text)
    out = []
    for block in _BLANK.split(text):
        if _MARKER.match(block):
            if block.lstrip()[:1] == "#" and "\n" in block:  # prose right behind a heading
                lines = block.split("\n")
                while lines and lines[0].lstrip()[:1] == "#":
                    lines.pop(0)
                block = "\n".join(lines)
                if not block or _MARKER.match(block):
                    continue
            else:
                continue
        if "\n" in block:
            lines = block.split("\n")
            for i, line in enumerate(lines):
                if i and _MARKER.match(line):
                    block = "\n".join(lines[:i])
                    break
        out.append(_NOISE.sub(" ", block))
    return out


#: Scripts whose small letters have symbols of their own; the letters of all others share the rest of the 1,024.
_OWN = [(0x41, 0x180), (0x370, 0x400), (0x400, 0x460), (0x900, 0x970), (0xE01, 0xE5C), (0x3041, 0x30FF)]


def _symbols() -> np.ndarray:
    """A 10-bit symbol for each code point's small letter, 0 for what is none; made by rule."""
    t = tables()
    letter = np.where((t["kind"] & LETTER) > 0, t["lower"], 0).astype(np.uint32)
    wide = np.arange(0xFF21, 0xFF5B)
    single = t["single"][wide]
    letter[wide] = np.where((single != GONE) & (letter[wide] > 0), t["lower"][np.where(single != GONE, single, 0)], 0)
    marks = np.concatenate([np.arange(0x900, 0x904), np.arange(0x93A, 0x950), np.arange(0xE31, 0xE4F)])
    letter[marks] = marks  # vowel signs belong to the word
    own = np.concatenate([np.unique(letter[a:b][letter[a:b] > 0]) for a, b in _OWN])
    own = np.unique(own)[:900]
    number = np.zeros(len(letter), np.uint32)
    number[own] = np.arange(1, len(own) + 1)
    rest = 1023 - len(own)
    shared = (len(own) + 1 + letter % np.uint32(rest)).astype(np.uint32)
    return np.where(letter == 0, 0, np.where(number[letter] > 0, number[letter], shared)).astype(np.uint32)


class Profiles:
    """Ranks of n-grams by language; classifies paragraphs in bulk."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.keys, self.ranks = keys, ranks  # sorted n-grams; (languages, n-grams)
        self._symbols = None

    def __getstate__(self):
        return {"keys": self.keys, "ranks": self.ranks}

    def __setstate__(self, s):
        self.__init__(s["keys"], s["ranks"])

    def _prepare(self) -> None:
        if self._symbols is None:
            self._symbols = _symbols()
            self._table = np.full(1 << TABLE_BITS, -1, np.int16)
            slot = self._slot(self.keys)
            order = np.arange(len(self.keys))[::-1]
            self._table[slot[order]] = order
            lost = np.flatnonzero(self._table[slot] != np.arange(len(self.keys)))
            self._lost_keys, self._lost_ids = self.keys[lost], lost.astype(np.int16)  # keys are sorted

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS)

    def _ids(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the n-grams, -1 for one in no profile."""
        out = self._table[self._slot(keys)]
        miss = np.flatnonzero(out >= 0)
        miss = miss[self.keys[out[miss]] != keys[miss]]
        out[miss] = -1
        if len(self._lost_keys) and len(miss):
            at = np.minimum(np.searchsorted(self._lost_keys, keys[miss]), len(self._lost_keys) - 1)
            out[miss] = np.where(self._lost_keys[at] == keys[miss], self._lost_ids[at], -1)
        return out

    def nearest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each paragraph the index of the nearest language, its lead over the next one, its letters, and the share of its n-grams that some profile holds.

        Ranks are those among all n-grams of the paragraph, most frequent first; equally frequent ones
        share their mean rank.  An n-gram of no profile takes its rank, but adds the same to every language.
        """
        self._prepare()
        n = len(texts)
        row, gram, letters = grams(texts, self._symbols)
        key = (row.astype(np.uint64) << np.uint64(32)) | gram
        key.sort()
        if not len(key):
            return np.zeros(n, np.int64), np.zeros(n), letters, np.zeros(n)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.minimum(np.diff(np.append(first, len(key))), 65535)
        key = key[first]
        ids = self._ids((key & np.uint64(0xFFFFFFFF)).astype(np.uint32)).astype(np.uint16)  # 65,535 for one of no profile
        ranked = ((key >> np.uint64(32)) << np.uint64(32)) | ((65535 - times).astype(np.uint64) << np.uint64(16)) | ids
        ranked.sort()
        ids = (ranked & np.uint64(0xFFFF)).astype(np.int64)
        tie = np.flatnonzero(np.concatenate([[True], (ranked[1:] >> np.uint64(16)) != (ranked[:-1] >> np.uint64(16)), [True]]))
        row = (ranked >> np.uint64(32)).astype(np.int64)
        at = np.searchsorted(row, np.arange(n + 1))
        mean = np.repeat((tie[:-1] + tie[1:] - 1) / 2, np.diff(tie)) - at[row]
        held = ids != 65535
        of_all, of_held = np.diff(at), np.bincount(row[held], minlength=n)
        row, ids, rank = row[held], ids[held], np.minimum(mean[held], PROFILE).astype(np.int32)
        at = np.searchsorted(row, np.arange(n + 1))
        some = np.flatnonzero(np.diff(at) > 0)
        far = np.zeros((len(self.ranks), n))
        for k, ranks in enumerate(self.ranks):
            place = ranks[ids]
            apart = np.where(place < PROFILE, np.abs(place - rank), PROFILE)
            far[k, some] = np.add.reduceat(apart, at[some]) if len(some) else 0
        order = np.argsort(far, axis=0, kind="stable")
        best, second = np.take_along_axis(far, order[:2], 0)
        return order[0], np.where(second > 0, (second - best) / np.maximum(second, 1), 0.0), letters, of_held / np.maximum(of_all, 1)


def grams(texts: list[str], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram) of every n-gram with a letter, and the letters of each row; a dense letter counts three."""
    points, at = to_points(pa.array([" " + t + " " for t in texts], pa.string()))
    m = symbols[points]
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at))
    dense = (tables()["kind"][points] & DENSE) > 0
    any_dense = dense.any()
    total = np.concatenate([[0], np.cumsum((m > 0) + 2 * dense.astype(np.int8) if any_dense else m > 0)])[at]
    letters = np.diff(total).astype(float)
    keep = np.empty(len(m), bool)
    keep[:1] = True
    np.logical_or(m[1:], m[:-1], out=keep[1:])
    keep[at[:-1][at[:-1] < len(m)]] = True
    m, row = m[keep], row[keep]
    parts = []
    if any_dense:
        single = np.flatnonzero(dense[keep])
        parts.append((row[single], m[single] | np.uint32(1 << 30)))
    if len(m) > 2:
        two = (m[:-1] << np.uint32(10)) | m[1:]
        inside = row[1:] == row[:-1]
        parts.append((row[:-1][inside], two[inside] | np.uint32(2 << 30)))
        three = (two[:-1] << np.uint32(10)) | m[2:]
        inside = row[2:] == row[:-2]
        parts.append((row[:-2][inside], three[inside]))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.uint32), letters
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), letters


def train(texts: dict[str, list[str]]) -> Profiles:
    """Profiles of the PROFILE most frequent n-grams of each language."""
    symbols = _symbols()
    tops = []
    for lang in LANGUAGES:
        _, g, _ = grams(texts.get(lang) or [""], symbols)
        u, c = np.unique(g, return_counts=True)
        tops.append(u[np.lexsort((u, -c))[:PROFILE]])
    keys = np.unique(np.concatenate(tops))
    ranks = np.full((len(LANGUAGES), len(keys)), PROFILE, np.int32)
    for k, top in enumerate(tops):
        ranks[k, np.searchsorted(keys, top)] = np.arange(len(top))
    return Profiles(keys, ranks)


def fit_profiles(rows: list[tuple[str, str]]) -> Profiles:
    """Train on (language, text) twice: on all prose, then on the paragraphs that agree with their label."""
    first = {k: [v] for k, v in SEED.items()}
    spread = []
    for lang, text in rows:
        for p in paragraphs(text):
            spread.append((lang, p))
            first.setdefault(lang, []).append(p)
    profiles = train(first)
    if spread:
        best, _, letters, _ = profiles.nearest([p for _, p in spread])
        second = {k: [v] for k, v in SEED.items()}
        for (lang, p), b, n in zip(spread, best.tolist(), letters.tolist(), strict=True):
            if n >= LEAST_LETTERS and LANGUAGES[b] == lang:
                second[lang].append(p)
        profiles = train(second)
    return profiles


def label_language(c: Column) -> Column:
    """The two-letter code that a label names ('mul' for several), null where it names none."""
    text = F.lower(F.trim(F.regexp_replace(c, "[\\s\\u00a0]+", " ")))
    bare = F.regexp_replace(text, "[-_ (].*$", "")
    known = F.create_map(*(F.lit(x) for lang, names in NAMES.items() for n in names.split() for x in (n, lang)))
    return F.coalesce(F.try_element_at(known, text), F.try_element_at(known, bare))


def with_label(df: DataFrame) -> DataFrame:
    """Add ``label``: what lang, language or sprache of the JSON front matter says."""
    get = lambda k: F.get_json_object("frontmatter", f"$.{k}")
    return df.withColumn("label", label_language(F.coalesce(get("lang"), get("language"), get("sprache"))))


def sample_profiles(df: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = SAMPLE_ROWS) -> Profiles:
    """Profiles from at most ``rows`` whole texts of each language, chosen by a hash of the id."""
    first = Window.partitionBy(label_col).orderBy(F.xxhash64(id_col), id_col)
    ids = df.where(F.col(label_col).isin(LANGUAGES) & F.col(id_col).isNotNull()).select(id_col, label_col).withColumn("k", F.row_number().over(first)).where(F.col("k") <= rows).select(id_col)
    chosen = [r[0] for r in ids.collect()]  # rows x languages at most
    got = df.where(F.col(id_col).isin(chosen) & F.col(text_col).isNotNull()).select(id_col, label_col, text_col).collect() if chosen else []
    return fit_profiles(sorted({(r[1], r[2]) for r in got if r[1] in LANGUAGES}))


FOUND = "doc_id string, label string, lang string, confidence double, paragraph_no int, letters int, mixed boolean"


def _assign(profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Profiles = profiles.value
        for batch in slices(batches, "text"):
            ids, labels, texts = (batch.column(i).to_pylist() for i in range(3))
            parts, owner, number = [], [], []
            for i, text in enumerate(texts):
                for k, p in enumerate(paragraphs(text), 1):
                    parts.append(p)
                    owner.append(i)
                    number.append(k)
            if not parts:
                continue
            best, lead, letters, held = model.nearest(parts)
            unlike = (held <= LEAST_HELD) & (letters >= LEAST_LETTERS)
            best, lead = np.where(unlike, len(LANGUAGES), best), np.where(unlike, LEAST_LEAD, lead)
            owner = np.array(owner)
            sure = (letters >= LEAST_LETTERS) & (lead >= LEAST_LEAD)
            # the language of a text: that of most letters in sure paragraphs, else in all
            weight = np.zeros((len(texts), len(ASSIGNED)))
            np.add.at(weight, (owner, best), np.where(sure, letters, letters * 1e-6))
            main = weight.argmax(1)
            other = np.flatnonzero(sure & (best != main[owner]))
            if len(other):  # a paragraph that has a sentence in the text's language is not wholly foreign
                bits = [(k, x) for k in other.tolist() for x in _SENTENCE.split(parts[k]) if len(x) > 6]
                if bits:
                    at, ahead, size, _ = model.nearest([x for _, x in bits])
                    of = np.array([k for k, _ in bits])
                    own = of[(at == main[owner[of]]) & (ahead >= LEAST_LEAD) & (size >= LEAST_SENTENCE)]
                    sure[own] = False
            lang = np.where(sure, best, main[owner])
            kinds = np.zeros((len(texts), len(ASSIGNED)), bool)
            kinds[owner[sure], best[sure]] = True
            mixed = kinds.sum(1) > 1
            prose = np.flatnonzero(weight[owner].sum(1) > 0)
            prose = prose[(letters[prose] >= LEAST_LETTERS) | ~kinds[owner[prose]].any(1) & (letters[prose] > 8)]
            take = owner[prose]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in take], pa.string()), pa.array([labels[i] for i in take], pa.string()), pa.array([ASSIGNED[k] for k in lang[prose]], pa.string()), pa.array(np.round(np.minimum(1.0, lead[prose] * 4), 4)), pa.array([number[i] for i in prose], pa.int32()), pa.array(letters[prose].astype(np.int32)), pa.array(mixed[take])],
                ["doc_id", "label", "lang", "confidence", "paragraph_no", "letters", "mixed"],
            )

    return run


def paragraph_languages(df: DataFrame, id_col: str, text_col: str, label_col: str, profiles: Profiles | None = None) -> DataFrame:
    """One row for each prose paragraph with its language, confidence and whether its text mixes languages."""
    ship(df.sparkSession)
    profiles = profiles or sample_profiles(df, id_col, text_col, label_col)
    model = df.sparkSession.sparkContext.broadcast(profiles)  # languages x PROFILE n-grams
    rows = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(label_col).alias("label"), F.col(text_col).alias("text")).where("text <> ''")
    return rows.mapInArrow(_assign(model), FOUND)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_languages(with_label(table(spark, sf_dir, "cleaned").select("doc_id", "body", "frontmatter")), "doc_id", "body", "label")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang) for bodies whose label is missing or not right: one row for each language with a whole paragraph."""
    wrong = _labelled(spark, sf_dir).where(F.when(F.col("mixed"), ~F.col("label").eqNullSafe("mul")).otherwise(~F.col("label").eqNullSafe(F.col("lang"))))
    return wrong.where("doc_id is not null").select("doc_id", "lang").distinct()


def p1_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per body its language ('mul' if mixed), confidence by letters, and the number of prose paragraphs."""
    parts = _labelled(spark, sf_dir)
    by = parts.groupBy("doc_id", "lang").agg(F.sum("letters").alias("letters"), F.sum(F.col("letters") * F.col("confidence")).alias("weight"), F.count_distinct("paragraph_no").alias("n"), F.max("mixed").alias("mixed"))
    out = by.groupBy("doc_id").agg(F.max("mixed").alias("mixed"), F.max_by("lang", F.struct("letters", "lang")).alias("main"), F.round(F.sum("weight") / F.sum("letters"), 4).alias("confidence"), F.sum("n").alias("paragraphs"))
    return out.select("doc_id", F.when(F.col("mixed"), "mul").otherwise(F.col("main")).alias("lang"), F.col("main").alias("main_lang"), "confidence", "paragraphs")


QUERIES = {"p1_found": p1_found, "p1_languages": p1_languages}
SQL: dict[str, str] = {}
