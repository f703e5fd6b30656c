"""Operators on small tables with nulls, ties, repeats and nothing at all."""

from __future__ import annotations

import math
import random
from collections import Counter

from notarium.operators import corpus, graph, tfidf, vectors, vocabulary
from notarium.sources import files
from notarium.streaming import ingest


def test_copies_and_first_kept(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4"), (None, "5")], "sha string, id string")
    assert {tuple(r) for r in corpus.copies(df, "sha", "id").collect()} == {("a", "1", 2, True), ("a", "2", 2, False)}
    kept = {r["id"]: (r["status"], r["duplicate_of"]) for r in corpus.first_kept(df, "sha", "id").collect()}
    assert kept["2"] == ("duplicate", "1") and kept["1"] == kept["4"] == kept["5"] == ("kept", None)


def test_percentiles(spark):
    df = spark.createDataFrame([("x", i, i) for i in range(10)] + [("y", None, 1)], "k string, v int, t int")
    assert {(r["p"], r["v"]) for r in corpus.index_percentiles(df, "k", "v", "t", [0.0, 0.5, 1.0]).collect()} == {(0.0, 0), (0.5, 5), (1.0, 9)}


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in parent}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 40)]
    loose = [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)]
    edges = chain + loose + [(7, 7), (500, 500), (3, 2)]
    df = spark.createDataFrame(edges + [(None, 1)], "src bigint, dst bigint")
    got = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert got == brute_components(edges)
    assert graph.components(df.where("false")).count() == 0


def test_resolve(spark):
    tags = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", "c"), ("d", "z")], "doc_id string, tag string")
    out = vocabulary.resolve(tags, spark.createDataFrame([("a",)], "tag string"), spark.createDataFrame([("b", "a"), ("c", None)], "tag string, canonical string"))
    assert {(r["tag"], r["canonical"], r["status"]) for r in out.collect()} == {("a", "a", "identity"), ("b", "a", "synonym"), ("c", None, "dropped"), ("z", None, "unknown")}


def test_search(spark):
    rows = [(i, [1.0 if k == i % 3 else 0.0 for k in range(3)]) for i in range(9)] + [(99, None)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    got = {(r["query_id"], r["vec_id"]) for r in vectors.search(df, df.where("id < 2"), "id", "v", 0.5).collect()}
    assert got == {(a, b) for a in (0, 1) for b in range(9) if a != b and a % 3 == b % 3}


def test_all_vectors_meet(spark, tmp_path, monkeypatch):
    from notarium.plans import catalogue

    monkeypatch.setattr(vectors, "PAIR_BLOCK", 16)
    rng = random.Random(8)
    rows = []
    for i in range(90):
        v = [rng.gauss(0, 1) for _ in range(8)]
        length = math.sqrt(sum(x * x for x in v))
        rows.append((i + 1, [x / length for x in v]))
    dot = {(a, b): sum(x * y for x, y in zip(v, w)) for a, v in rows for b, w in rows if a < b}
    df = spark.createDataFrame([*rows, (400, None)], "vec_id bigint, embedding array<double>")
    got = {(r["a"], r["b"]): r["cosine"] for r in vectors.all_pairs(df, "vec_id", "embedding", 0.6).collect()}
    want = {e for e, c in dot.items() if c >= 0.6}
    assert want and got.keys() == want and all(abs(got[e] - dot[e]) < 1e-9 for e in want)
    # links without an end that is divisible by 50, and vectors without links
    axis = lambda k: [1.0 if j == k else 0.0 for j in range(5)]
    rows = [(1, axis(0)), (2, axis(0)), (3, axis(0)), (7, axis(1)), (8, axis(1)), (9, axis(2)), (50, axis(3))]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {r["node"]: r["component"] for r in catalogue.QUERIES["a7_all_vector_components"](spark, str(tmp_path)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 9, 50: 50}


def test_threshold_clusters(spark):
    rng = random.Random(9)
    ids = list(range(1, 61))
    pairs = [(a, b, rng.random()) for a in ids for b in ids if a < b and rng.random() < 0.04]
    df = spark.createDataFrame([(i, [1.0]) for i in ids], "vec_id bigint, v array<double>")
    p = spark.createDataFrame(pairs, "a bigint, b bigint, cosine double")
    got = {r["theta"]: tuple(r)[1:] for r in vectors.simulate(df, p, "vec_id", "v", [0.1, 0.5, 0.8, 2.0]).collect()}
    assert got.keys() == {0.1, 0.5, 0.8, 2.0} and got[2.0] == (0, 0, 0.0, 100.0)
    for theta, found in got.items():
        sizes = [n for n in Counter(brute_components([(a, b) for a, b, c in pairs if c >= theta]).values()).values() if n >= 3]
        assert found == (len(sizes), max(sizes, default=0), round(sum(sizes) / len(sizes), 1) if sizes else 0.0, round((60 - sum(sizes)) / 60 * 100, 1))
    assert {tuple(r)[1:] for r in vectors.simulate(df.where("false"), p.where("false"), "vec_id", "v", [0.1]).collect()} == {(0, 0, 0.0, 0.0)}


def test_similar_loses_nothing(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(40)]
    texts += [t + " extra" for t in texts[:10]]
    df = spark.createDataFrame(list(enumerate(texts)) + [(900, ""), (901, None)], "id bigint, text string")
    w = tfidf.weights(df, "id", "text")
    vec = {}
    for r in w.collect():
        vec.setdefault(r["id"], {})[r["term"]] = r["w"]
    brute = {(a, b) for a in vec for b in vec if a < b and sum(vec[a][t] * vec[b].get(t, 0) for t in vec[a]) >= 0.7}
    assert brute and {(r["a"], r["b"]) for r in tfidf.similar(w, 0.7).collect()} == brute


def test_near_dups_of_short_sections(spark, tmp_path):
    from notarium.plans import catalogue

    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in [8] * 12 + [150] * 4]
    texts += [t + " " + " ".join(t.split()[:3]) for t in texts] + ["", texts[0], None]
    spark.createDataFrame([(f"s{i:03}", t, "p") for i, t in enumerate(texts)], "segment_id string, text string, source_path string").write.parquet(str(tmp_path / "segments.parquet"))
    first = {}
    for i, t in enumerate(texts):
        if t is not None:
            first.setdefault(t, f"s{i:03}")
    tf = {}
    for t, i in first.items():
        w = t.split()
        tf[i] = Counter(w + [f"{x} {y}" for x, y in zip(w, w[1:])])
    df = Counter(t for c in tf.values() for t in c)
    vec = {}
    for i, c in tf.items():
        raw = {t: (1 + math.log(k)) * (math.log((1 + len(tf)) / (1 + df[t])) + 1) for t, k in c.items() if df[t] >= 2}
        length = math.sqrt(sum(x * x for x in raw.values()))
        vec[i] = {t: x / length for t, x in raw.items()}
    want = {(a, b): round(s, 4) for a in vec for b in vec if a < b and (s := sum(x * vec[b].get(t, 0) for t, x in vec[a].items())) >= 0.72}
    short = {i for t, i in first.items() if len(t) < 400}
    assert {len({*e} & short) for e in want} == {0, 2}
    got = {(r["a"], r["b"]): r["similarity"] for r in catalogue.QUERIES["j6_near_dups"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and all(abs(got[e] - want[e]) < 2e-4 for e in want)


def test_sources(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "rest-api.md").write_text("---\ntitle: T\n---\n# Hi\r\nword word\n", "utf-8")
    (tmp_path / "in" / "sub" / "rest_api.md").write_text("x", "utf-8")
    (tmp_path / "in" / "skip.tmp.md").write_text("no", "utf-8")
    notes = files.notes(spark, str(tmp_path / "in"), exclude=["*.tmp.md"])
    m = {r["path"]: r for r in files.manifest_of(notes).collect()}
    assert {r["doc_id"] for r in m.values()} == {"D_rest-api", "D_rest-api_2"}
    assert m["rest-api.md"]["line_count"] == 5 and m["rest-api.md"]["word_count"] == 8
    c = {r["path"]: r for r in files.cleaned_of(notes).collect()}
    assert c["rest-api.md"]["body"] == "# Hi\nword word\n" and c["rest-api.md"]["frontmatter"] == '{"title": "T"}'
    (tmp_path / "t.md").write_text("| a | b |\n|---|---|\n| 1 | 2 |\n", "utf-8")
    assert [tuple(r) for r in files.pipe_table(spark, str(tmp_path / "t.md"), ["a", "b"]).collect()] == [("1", "2")]
    (tmp_path / "d.yaml").write_text("tags: {x: y, z: null}\n", "utf-8")
    assert {tuple(r) for r in files.dimension(spark, str(tmp_path / "d.yaml"), "tags").collect()} == {("x", "y"), ("z", None)}
    rows = spark.createDataFrame([(1, None), (2, "bad")], "i int, error string")
    assert files.split_errors(rows, "error is not null", str(tmp_path / "dead")).count() == 1
    assert spark.read.json(str(tmp_path / "dead")).count() == 1
    assert [r["answer"] for r in files.answers(spark.createDataFrame([("a",), (None,)], "p string"), "p", str.upper).collect()] == ["A", None]
    sheet = spark.createDataFrame([("s", 1, "### q1"), ("s", 2, "decision: yes"), ("s", 3, "value: 5"), ("s", 4, "### q2"), ("s", 5, "decision: ")], "sheet string, line_no int, line string")
    assert [tuple(r) for r in files.decisions(sheet).collect()] == [("s", "q1", "yes", "5")]
    fam = files.families(spark.createDataFrame([("CK_x.md",), ("CK_x.body.md",), ("CK_y.meta.json",)], "filename string"))
    assert {(r["stem"], r["md"], r["body"], r["meta"]) for r in fam.collect()} == {("CK_x", True, True, False), ("CK_y", False, False, True)}


def test_upsert_batches(spark, tmp_path):
    for k, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)]]):
        spark.createDataFrame(rows, "key string, t int").coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
    stream = ingest.stream(spark, str(tmp_path / "src"), 1)
    ingest.upsert_batches(stream, "key", "t", f"file://{tmp_path}/out")
    newest = max((p.name for p in (tmp_path / "out").glob("v*")), key=lambda n: int(n[1:]))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / newest)).select("key", "t").collect()} == {("a", 2), ("b", 1)}


def test_shared_items(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "b"), (3, "c"), (4, "z")], "d int, t string")
    assert {tuple(r) for r in vocabulary.shared_items(df, "d", "t", 2).collect()} == {("a,b", "a,b,c", 2, 2, 1)}
