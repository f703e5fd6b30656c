"""Queries that pass over whole documents; most have no SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import documents as fn
from ..session import table
from . import base as b
from .corpus import DE, EN
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    return b.cleaned(spark, d).select("doc_id", "body")


@query("w1_fenced_lines")
def w1(spark: SparkSession, d: str) -> DataFrame:
    def count(t: str):
        flags = fn.fence_flags(t.split("\n"))
        return [(len(flags), sum(flags))]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", count, "lines int, code int")


@query("w2_audit_fences")
def w2(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose code differs between the two fence rules."""

    def differ(t: str):
        lines = t.split("\n")
        a, c = fn.fence_flags(lines), fn.audit_fence_flags(lines)
        return [(sum(a), sum(c))] if a != c else []

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", differ, "code int, audit_code int")


@query("f8_partition")
def f8(spark: SparkSession, d: str) -> DataFrame:
    return fn.map_texts(_bodies(spark, d), "doc_id", "body", lambda t: [(i, lang, len(c)) for i, (lang, c) in enumerate(fn.code_blocks(t))], "block_no int, lang string, chars int")


@query("f5_normal_body")
def f5(spark: SparkSession, d: str) -> DataFrame:
    x = fn.map_texts(table(spark, d, "documents"), "doc_id", "text", lambda t: [(fn.normal_body(t),)], "body string")
    return x.select(F.col("id").alias("doc_id"), F.length("body").alias("chars"), F.sha2("body", 256).alias("sha256"))


@query("f1_slugs")
def f1(spark: SparkSession, d: str) -> DataFrame:
    def slugs(t: str):
        stem = t.rsplit(".", 1)[0]
        return [(fn.slug(stem), fn.slug(stem, 50, "batch", True), fn.slug(stem, 60, "note"))]

    return fn.map_texts(b.manifest(spark, d), "doc_id", "filename", slugs, "slug string, batch_slug string, note_slug string")


@query("w14_segments")
def w14(spark: SparkSession, d: str) -> DataFrame:
    def cut(t: str):
        return [(i, " > ".join(p), len(x.split()), len(x), "```" in x) for i, p, x in fn.segments(t)]

    x = fn.map_texts(_bodies(spark, d), "doc_id", "body", cut, "segment_index int, heading_path string, word_count int, char_count int, contains_code boolean")
    return x.withColumn("segment_id", F.concat("id", F.lit("-S"), F.lpad("segment_index", 4, "0")))


@query("w12_pack_words")
def w12(spark: SparkSession, d: str) -> DataFrame:
    def packs(t: str):
        sizes = [sum(len(x.split()) for x in blk) for blk in fn.blocks(t.split("\n"))]
        return [(i, len(p), sum(sizes[k] for k in p)) for i, p in enumerate(fn.pack_blocks(sizes, 200))]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", packs, "pack int, blocks int, words int")


@query("w13_pack_tokens")
def w13(spark: SparkSession, d: str) -> DataFrame:
    """Sections of each document in prompt batches of a token budget, four characters a token."""

    def packs(t: str):
        sizes = [max(1, len("\n".join(ls)) // 4) for _, ls in fn.sections(t)]
        return [(i, len(p), sum(sizes[k] for k in p)) for i, p in enumerate(fn.pack_blocks(sizes, 500))]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", packs, "batch int, sections int, tokens int")


@query("w15_book_sections")
def w15(spark: SparkSession, d: str) -> DataFrame:
    """Adjacent sections with the same first two headings, merged and split at a word budget."""

    def parts(t: str):
        return [(i, " > ".join(p), len(x.split())) for i, (p, x) in enumerate(fn.book_parts(t))]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", parts, "part int, path string, words int")


@query("d1_repair")
def d1(spark: SparkSession, d: str) -> DataFrame:
    def fix(t: str):
        new, actions = fn.repair(t)
        added, removed = fn.changed_lines(t, new) if actions else (0, 0)
        return [(",".join(actions), fn.tier(t, new), added, removed, fn.repair(new)[0] == new)]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", fix, "actions string, tier string, added int, removed int, idempotent boolean")


@query("d5_fence_convert")
def d5(spark: SparkSession, d: str) -> DataFrame:
    def convert(t: str):
        new = fn.fence_indented(t)
        return [(new != t, fn.content_lines(new) == fn.content_lines(t), fn.fence_indented(new) == new)]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", convert, "changed boolean, lossless boolean, idempotent boolean")


@query("f40_fence_languages")
def f40(spark: SparkSession, d: str) -> DataFrame:
    blocks = b.structured(spark, d).select("doc_id", F.posexplode("code_blocks").alias("block_no", "cb")).select(F.concat_ws("#", "doc_id", "block_no").alias("block"), "cb.content")
    return fn.map_texts(blocks, "block", "content", lambda t: [(fn.language_of(t),)], "lang string")


@query("f33_keyphrases")
def f33(spark: SparkSession, d: str) -> DataFrame:
    stop = set((DE + " " + EN).split())
    return fn.map_texts(_bodies(spark, d), "doc_id", "body", lambda t: [(i, p) for i, p in enumerate(fn.keyphrases(t, stop))], "place int, phrase string")


@query("f42_link_spacing", b.with_(b.C) + r"select doc_id, regexp_matches(body, '\[\[[ \t]|[ \t]\]\]') as spaced from c where body is not null and contains(body, '[[')")
def f42(spark: SparkSession, d: str) -> DataFrame:
    return _bodies(spark, d).where("body is not null and contains(body, '[[')").select("doc_id", F.col("body").rlike(r"\[\[[ \t]|[ \t]\]\]").alias("spaced"))


#: Rules of the document type, as label, tenths, what is looked at, and what for.
RULES = [
    ("cheat_sheet", 5, "when", "tables_count >= 1 and words < 300"),
    ("cheat_sheet", 3, "when", "tables_count >= 2"),
    ("cheat_sheet", 3, "when", "n_code >= 3"),
    ("cheat_sheet", 4, "title", "cheat|befehle|commands|quick"),
    ("reference", 2, "when", "n_named > 0"),
    ("reference", 5, "title", "api|referenz|reference|spec"),
    ("reference", 2, "when", "tables_count >= 1 and n_code >= 1"),
    ("tutorial", 5, "title", "tutorial|anleitung|einführung|guide|intro"),
    ("tutorial", 3, "heads", "schritt|step|einführung|einleitung"),
    ("tutorial", 1, "when", "n_code >= 1 and words > 150"),
    ("how-to", 5, "heads", "REGEX"),
    ("how-to", 4, "title", "how to|howto|wie man|wie du"),
    ("projektidee", 6, "title", "projektnotiz"),
    ("projektidee", 3, "when", "contains(title, 'projekt') and not contains(title, 'projektnotiz')"),
    ("projektidee", 3, "heads", "idee|technologie|offene fragen"),
    ("projektidee", 2, "when", "contains(heads, 'status') and words < 600"),
    ("projektplanung", 5, "heads", "phase|meilenstein|milestone|planung"),
    ("projektplanung", 4, "title", "planung|plan|roadmap"),
    ("gedanke", 3, "when", "n_code = 0 and tables_count = 0 and words < 350 and not contains(title, 'projekt')"),
    ("gedanke", 4, "when", "(contains(title, 'gedanke') or contains(title, 'notiz') or contains(title, 'note')) and not contains(title, 'projekt')"),
    ("gedanke", 3, "body", "ich denke|meine meinung|ich glaube"),
    ("explanation", 4, "when", "words > 500 and n_code <= 2 and tables_count = 0"),
    ("explanation", 4, "title", "erklärung|explanation|was ist|einleitung|grundlagen"),
    ("wiki", 5, "title", "wiki|glossar|begriffe|überblick|overview"),
    ("wiki", 3, "when", "n_headings > 5 and words > 350"),
    ("manual", 4, "heads", "installation|konfiguration|configuration|requirements|voraussetzungen"),
    ("manual", 4, "title", "manual|handbuch|dokumentation"),
]


def type_scores(regex: str) -> dict[str, str]:
    """For each label in order the SQL of its score in tenths; ``regex`` is the engine's match function."""
    out: dict[str, list[str]] = {}
    for label, tenths, kind, what in RULES:
        test = what if kind == "when" else f"{regex}(heads, '(schritt|step)[ ]*[0-9]')" if what == "REGEX" else "(" + " or ".join(f"contains({kind}, '{w}')" for w in what.split("|")) + ")"
        out.setdefault(label, []).append(f"case when {test} then {tenths} else 0 end")
    return {label: " + ".join(parts) for label, parts in out.items()}


def _best(scores: dict[str, str]) -> tuple[str, str]:
    """SQL of the highest score and of its first label."""
    most = "greatest(" + ", ".join(f"({s})" for s in scores.values()) + ")"
    label = "case " + " ".join(f"when ({s}) = best then '{name}'" for name, s in scores.items()) + " end"
    return most, label


_MOST, _LABEL = _best(type_scores("regexp_matches"))


@query("f13_doc_type", b.with_(b.C, b.S, f"x as (select s.doc_id, lower(coalesce(s.title, '')) as title, lower(coalesce(array_to_string([h.text for h in s.headings], ' '), '')) as heads, lower(c.body) as body, {b.sql_words('c.body')} as words, len(s.code_blocks) as n_code, len(list_filter(s.code_blocks, lambda cb: cb.lang <> 'unknown')) as n_named, s.tables_count, len(s.headings) as n_headings, len(list_filter(s.headings, lambda h: h.level <= 2)) as n_top from s join c on s.doc_id = c.doc_id where c.body is not null)", f"y as (select *, {_MOST} as best from x)") + f"select doc_id, case when words > 8000 and n_top >= 5 then 'book' when best <= 2 then 'unklar' else {_LABEL} end as label, case when words > 8000 and n_top >= 5 then 0.9 when best <= 2 then 0.3 else round(least(0.95, greatest(0.3, best / 10.0)), 2) end::double as confidence from y")
def f13(spark: SparkSession, d: str) -> DataFrame:
    s, c = b.structured(spark, d), b.cleaned(spark, d).where("body is not null").select("doc_id", "body")
    x = s.join(c, "doc_id").select(
        "doc_id",
        F.lower(F.coalesce("title", F.lit(""))).alias("title"),
        F.lower(F.array_join(F.transform("headings", lambda h: h["text"]), " ")).alias("heads"),
        F.lower("body").alias("body"),
        b.words("body").alias("words"),
        F.size("code_blocks").alias("n_code"),
        F.size(F.filter("code_blocks", lambda cb: cb["lang"] != "unknown")).alias("n_named"),
        "tables_count",
        F.size("headings").alias("n_headings"),
        F.size(F.filter("headings", lambda h: h["level"] <= 2)).alias("n_top"),
    )
    most, label = _best(type_scores("regexp_like"))
    y = x.withColumn("best", F.expr(most))
    book = (F.col("words") > 8000) & (F.col("n_top") >= 5)
    score = F.round(F.least(F.lit(0.95), F.greatest(F.lit(0.3), F.col("best") / 10.0)), 2)
    return y.select("doc_id", F.when(book, "book").when(F.col("best") <= 2, "unklar").otherwise(F.expr(label)).alias("label"), F.when(book, 0.9).when(F.col("best") <= 2, 0.3).otherwise(score).alias("confidence"))


@query("d21_backfill")
def d21(spark: SparkSession, d: str) -> DataFrame:
    """Key phrases put into front matter, with the proof that taking them out gives the same note."""
    from ..functions import notes

    stop = set((DE + " " + EN).split())

    def fill(t: str):
        before = "---\ntitle: x\n---\n" + t
        after = notes.add_list(before, "keyphrases", fn.keyphrases(t, stop))
        return [(after != before, notes.is_additive(before, after, "keyphrases"))]

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", fill, "added boolean, additive boolean")


@query("d2_patches")
def d2(spark: SparkSession, d: str) -> DataFrame:
    """What the review patches would change; they are never applied by themselves."""
    from ..functions import notes

    def patch(t: str):
        one, a = notes.without_tokens(t)
        _, c = notes.rebuilt_links(one)
        return [(a, c)] if a or c else []

    return fn.map_texts(_bodies(spark, d), "doc_id", "body", patch, "tokens int, links int")
