"""Line rules at their edges, on a written table of notes."""

from __future__ import annotations

import pytest

from notarium.operators import corpus, tfidf, vectors
from notarium.plans import build, lines, quality, review, similar  # noqa: F401

NOTES = {
    "blank": "a\n\n\n\n\nb\n```\n\n\n\n\n\n```\n\n\n\nc",
    "code": "# Real\n```\n# not one\n- [[a]]\n- [[b]]\n- [[c]]\nTODO\n```\ntext",
    "empty": "# One\n\n# Two\ntext\n# Three\n```\nx\n```\n# Four",
    "links": "- [[a]]\n- [x](http://a.example)\n```\ncode\n```\nhttps://b.example\ntext\n[[d]]\n[[e]]",
    "setext": "Title\n===\n\n---\n# h\n---\n```\nx\n===\n```\n---",
    "menu": "Start | About | Contact\nclick here\n\nStart | A label that is far too long for menus | b",
    "weak": "Start | About | Contact",
    "cookie": "Diese Seite verwendet Cookies.",
    "gap": "TODO and TBD ??? `TODO` siehe oben\nsiehe Abschnitt 3\nnothing",
    "mash": "turn0search1 <a>https://x ",
    "old": "Stand: März 2019 und as of 2024\n`Stand 1999`",
}
META = {"links": '{"updated": "2024-12-01", "created": "2019-01-01"}', "old": '{"created": "2023-06-01T10:00:00"}', "weak": '{"title": "x", "summary": "y"}', "cookie": '{"type": "gedanke"}'}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("notes"))
    rows = [(k, v, META.get(k), None) for k, v in NOTES.items()] + [("none", None, None, None), ("void", "", "{}", None)]
    spark.createDataFrame(rows + rows[:3], "doc_id string, body string, frontmatter string, normalized_sha256 string").write.parquet(f"{d}/cleaned.parquet")
    return d


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_blank_lines(spark, folder):
    got = {r["doc_id"]: (r["dropped"], r["longest"]) for r in lines.w3(spark, folder).collect()}
    assert got["blank"] == (1, 4)


def test_code_is_no_heading_link_or_gap(spark, folder):
    assert {r["section"] for r in lines.w6(spark, folder).where("doc_id = 'code'").collect()} == {"real"}
    assert rows(lines.w9(spark, folder).where("doc_id in ('empty', 'code')")) == {("empty", 1), ("empty", 9)}
    assert rows(lines.w10(spark, folder)) == {("links", 1, 3)}
    assert not lines.f24(spark, folder).where("doc_id = 'code'").collect()
    assert rows(lines.f24(spark, folder)) == {("gap", 1, 3, True), ("gap", 2, 0, True)}


def test_setext(spark, folder):
    assert rows(lines.w8(spark, folder)) == {("setext", 2)}


def test_boilerplate_needs_two_signs_or_a_notice(spark, folder):
    assert rows(lines.f26(spark, folder)) == {("menu", 1, "nav"), ("menu", 2, "cta"), ("cookie", 1, "consent")}


def test_fragments(spark, folder):
    got = {r["doc_id"]: r["lacks"] for r in lines.f28(spark, folder).collect()}
    assert "weak" not in got and "cookie" not in got and "code" not in got and "none" not in got and got["gap"] == "title"


def test_corruption_and_age(spark, folder):
    assert rows(lines.f23(spark, folder).where("doc_id = 'mash'")) == {("mash", 1, "token_leak", "error"), ("mash", 1, "url_mash", "warning"), ("mash", 1, "private_use", "error")}
    got = {r["doc_id"]: (r["age"], r["year"], r["old"], r["old_mark"]) for r in lines.f25(spark, folder).collect()}
    assert got == {"links": (31, None, False, False), "old": (580, 2019, True, True)}


def test_places_in_a_hot_key(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("hot" if i % 3 else "b", i) for i in range(500)], "k string, v int")
    got = corpus.placed(df, "k", [F.col("v")], 7).collect()
    for key in ("hot", "b"):
        mine = sorted((r["v"], r["place"]) for r in got if r["k"] == key)
        assert [p for _, p in mine] == list(range(1, len(mine) + 1))
    ids = corpus.numbered(df.selectExpr("concat('x', v) as k"), "k", 5).collect()
    assert [r["n"] for r in sorted(ids, key=lambda r: r["k"])] == list(range(500))


def test_marks_tell_sets_apart(spark):
    a, z = "ab" * 32, "cd" * 32
    df = spark.createDataFrame([("one", a), ("two", a), ("two", z), ("two", z), ("three", a), ("three", a), ("three", a)], "k string, sha string")
    got = {r["k"]: r["mark"] for r in corpus.set_mark(df, ["k"], "sha").collect()}
    assert len(set(got.values())) == 3


def test_vocabulary_is_the_most_frequent_terms(spark):
    texts = [(str(i), f"alpha beta gamma w{i} w{i}") for i in range(30)]
    v = tfidf.weights(spark.createDataFrame(texts, "id string, text string"), "id", "text", 2, 3)
    assert {r["term"] for r in v.select("term").distinct().collect()} == {"alpha", "alpha beta", "beta"}


def test_search_blocks_and_nearest(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id bigint, v array<double>")
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 256)
    got = {(r["query_id"], r["vec_id"]) for r in vectors.search(df, df.where("id % 10 = 0"), "id", "v", 0.4).collect()}
    s = x @ x.T
    assert got == {(a, b) for a in range(0, 120, 10) for b in range(120) if a != b and s[a, b] >= 0.4}
    best = {}
    for r in vectors.search(df, df.where("id % 10 = 0"), "id", "v", -1.0, nearest=True).collect():
        best.setdefault(r["query_id"], []).append((r["cosine"], r["vec_id"]))
    np.fill_diagonal(s, -2)
    assert {q: max(v)[1] for q, v in best.items()} == {q: int(s[q].argmax()) for q in range(0, 120, 10)}
    assert vectors.search(df, df.where("false"), "id", "v", 0.4).count() == 0


def test_write_changed_archives_what_it_replaces(spark, tmp_path):
    from notarium.sources.files import write_changed

    at = f"file://{tmp_path}/notes"
    make = lambda rows: spark.createDataFrame(rows, "k string, t string")
    assert rows(write_changed(make([("a", "1"), ("b", "2"), ("n", None)]), at, "k", "t")) == {("a", "new"), ("b", "new"), ("n", "new")}
    assert rows(write_changed(make([("a", "1"), ("b", "3"), ("c", "4"), ("n", None)]), at, "k", "t")) == {("a", "same"), ("b", "changed"), ("c", "new"), ("n", "same")}
    assert rows(write_changed(make([("c", "4")]), at, "k", "t")) == {("a", "absent"), ("b", "absent"), ("n", "absent"), ("c", "same")}
    assert rows(spark.read.parquet(f"{at}/archive").select("k", "t")) == {("b", "2")}
    assert rows(spark.read.parquet(f"{at}/v2").select("k", "t")) == {("a", "1"), ("b", "3"), ("c", "4"), ("n", None)}


def test_streams_go_on_where_they_ended(spark, tmp_path):
    from notarium.streaming import ingest

    src, at = f"{tmp_path}/in", f"file://{tmp_path}/out"
    make = lambda n: spark.range(n).selectExpr("id", "timestamp_seconds(id + 1000000000) as ts").write.mode("append").parquet(src)
    make(5)
    assert ingest.drain(ingest.first_of(ingest.stream(spark, src), ["id"]), folder=at).count() == 5
    make(8)
    assert ingest.drain(ingest.first_of(ingest.stream(spark, src), ["id"]), folder=at).count() == 8
    assert ingest.drain(ingest.first_of(ingest.stream(spark, src), ["id"], "ts", "1 hour")).count() == 8
