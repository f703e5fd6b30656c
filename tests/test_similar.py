"""The TF-IDF join by blocks: exact whatever the blocks, and no pair of a term is written or shuffled."""

from __future__ import annotations

import random

import pytest

from notarium.operators import tfidf
from notarium.plans import catalogue, similar


def texts() -> list[str]:
    rng = random.Random(7)
    words = [f"w{i}" for i in range(70)]
    out = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 12, 60]))) for _ in range(120)]
    return out + [f"{t} {t.split()[0]} Größe" for t in out[:30]] + ["", "a b", "w1  w1"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("similar")
    rows = [(f"s{i:03}", t, "p") for i, t in enumerate(texts())] + [("s900", None, "p")]
    spark.createDataFrame(rows, "segment_id string, text string, source_path string").write.parquet(str(d / "segments.parquet"))
    bodies = [(f"D{i:03}", None, f"h{i}", t) for i, t in enumerate([*texts(), *texts()[:3]])] + [("D900", None, "h", None)]
    spark.createDataFrame(bodies, "doc_id string, frontmatter string, normalized_sha256 string, body string").write.parquet(str(d / "cleaned.parquet"))
    spark.createDataFrame([(i, [1.0, i / 50]) for i in range(20)], "vec_id bigint, embedding array<float>").write.parquet(str(d / "embeddings.parquet"))
    return str(d)


def agrees(spark, folder: str, name: str) -> bool:
    import duckdb

    con = duckdb.connect()
    for t in ("segments", "cleaned", "embeddings"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    want = con.execute(catalogue.SQL[name])
    names = [x[0] for x in want.description]
    got = [tuple(r) for r in catalogue.QUERIES[name](spark, folder).select(*names).collect()]
    rows = want.fetchall()
    return bool(rows) and sorted(map(repr, rows)) == sorted(map(repr, got))


def plan(spark, folder: str, name: str) -> str:
    return catalogue.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("entries", [40, 700, 1 << 20])
def test_blocks_lose_nothing(spark, folder, monkeypatch, entries):
    monkeypatch.setattr(tfidf, "BLOCK_ENTRIES", entries)
    assert agrees(spark, folder, "j6_near_dups")


def test_terms_beyond_two_bytes(spark):
    import numpy as np

    assert (tfidf._long([tfidf._short(np.array(v)).tobytes() for v in ([1, 65535], [65536])], np.array([2, 1])) == [1, 65535, 65536]).all()


def test_j6_is_no_join_of_postings(spark, folder):
    assert not any(x in plan(spark, folder, "j6_near_dups") for x in ("Exchange", "Join"))


def test_d16_reads_bodies_once(spark, folder, monkeypatch):
    calls, cleaned = [], similar.b.cleaned
    monkeypatch.setattr(similar.b, "cleaned", lambda *a, **k: calls.append(a) or cleaned(*a, **k))
    assert agrees(spark, folder, "d16_redundancy") and len(calls) == 1


@pytest.mark.parametrize("name", ["pj11_sim_bins", "t2_top_edges"])
def test_bins_and_top_edges_join_no_postings(spark, folder, name):
    assert "Join" not in plan(spark, folder, name) and agrees(spark, folder, name)


@pytest.mark.parametrize("name", ["f32_bands", "j7_clusters"])
def test_bands_and_clusters_read_bodies_once(spark, folder, monkeypatch, name):
    calls, cleaned = [], similar.b.cleaned
    monkeypatch.setattr(similar.b, "cleaned", lambda *a, **k: calls.append(a) or cleaned(*a, **k))
    assert agrees(spark, folder, name) and len(calls) == 1


@pytest.mark.parametrize(("read", "hits", "cells"), [(0.9, 1 << 15, 1 << 19), (0.9, 1, 1), (0.75, 50, 900), (0.999, 300, 4000)])
def test_few_postings_are_read_and_no_pair_is_lost(monkeypatch, read, hits, cells):
    import numpy as np
    import pyarrow as pa

    for name, value in (("READ", read), ("CHUNK_HITS", hits), ("CHUNK_CELLS", cells)):
        monkeypatch.setattr(tfidf, name, value)
    rng, ranks, theta = np.random.default_rng(3), 90, 0.72
    dense = rng.random((250, ranks)) ** 3 * (rng.random((250, ranks)) < rng.choice([0.02, 0.2, 0.7], 250)[:, None])
    dense[150:] = dense[:100] * (rng.random((100, ranks)) < 0.8)
    dense[240:] = dense[:10]
    dense[dense.sum(1) == 0, 5] = 1
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    row, t = np.nonzero(dense)
    rows = tfidf._packed(pa.array([f"s{i:03}" for i in range(250)]), row, t, dense[row, t], dense[row, t], theta)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as to:
        to.write_batch(rows)
    block = type("Block", (), {"value": {"rows": sink.getvalue().to_pybytes()}})
    got = [tuple(r.values()) for b in tfidf._meet(block, theta, None, ranks)(iter([rows.slice(0, 70), rows.slice(70)])) for r in b.to_pylist()]
    near = dense @ dense.T
    want = {(f"s{i:03}", f"s{j:03}"): near[i, j] for i in range(250) for j in range(i + 1, 250) if near[i, j] >= theta}
    assert len(got) == len(want) > 100 and all(abs(want[a, b] - v) < 1e-12 for a, b, v in got)
    # postings of a term are in the order of what follows them, so that a row reads only the first
    x = block.value["index"]
    assert (np.diff(x.key) >= 0).all() and len(x.row) == (x.suffix >= read * theta - 1e-6).sum()


ODD = ["a", "B", "ß", "İ", "İx", "𝒳", "𝒳y", "٣٤", "_", "__", "-", " ", "  ", "\n", " ", "\x0b", "Größe", "漢字", "字", "'", "é", "²", "Ⅷ", "ǅ", "🙂", "ﬁ"]


def odd_texts(n: int) -> list[str]:
    rng = random.Random(1)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "  a  bb "]


def test_texts_are_read_once(spark):
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    own = [t for t in texts() if t]
    df = spark.createDataFrame(list(enumerate(own)), "id int, text string").mapInArrow(count, "id int, text string")
    assert tfidf.similar_texts(df, "id", "text", 0.72, 2, 20_000).count() > 10 and rows.value == len(own)


def test_words_split_in_the_worker_are_those_of_the_weights(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(odd_texts(500))), "id int, t string")
    rows = df.select(tfidf._words("t").alias("ws"), tfidf._spaced("t").alias("x")).collect()
    n, words = tfidf._split(pa.array([r.x for r in rows]))
    assert n.tolist() == [len(r.ws) for r in rows] and words.to_pylist() == [w for r in rows for w in r.ws]
    # blank texts are told by the text as it is
    from notarium.operators import scan

    assert not df.where(F.col("t").rlike(r"\S") != (scan.plain("t") != "")).count()


def test_coded_words_do_not_depend_on_the_pieces(monkeypatch):
    import pyarrow as pa

    own = [*texts(), *odd_texts(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(own))), pa.array(own)], ["id", "text"])
    found = []
    for coded, counted in ((1 << 16, 1 << 20), (1, 1), (37, 100)):
        monkeypatch.setattr(tfidf, "CODED_WORDS", coded), monkeypatch.setattr(tfidf, "BATCH_WORDS", counted)
        rows = list(tfidf._code(iter([batch, batch.slice(0, 0)])))
        assert sum((r.column("ids").flatten().to_pylist() for r in rows), []) == list(range(len(own)))
        got = {}
        for ids, row, names, code in tfidf._tokens(iter(rows)):
            for i, k in zip(row.tolist(), code.tolist()):
                got.setdefault(ids[i].as_py(), []).append(names[k].as_py())
        terms = {}
        for b in tfidf._count_terms(iter(rows)):
            for r in b.to_pylist():
                old = terms.get(r["term"], (0, 0))
                terms[r["term"]] = (old[0] + r["df"], old[1] + r["times"])
        found.append((got, terms))
    assert found[0] == found[1] == found[2]
    assert found[0][0] == {i: ws for i, t in enumerate(own) if (ws := [w for w in t.split(" ") if len(w) > 1])}


@pytest.mark.parametrize("dense", [0, 1 << 30])
def test_sums_passed_in_a_row_or_picked_lose_no_pair(monkeypatch, dense):
    monkeypatch.setattr(tfidf, "DENSE", dense)
    test_few_postings_are_read_and_no_pair_is_lost(monkeypatch, 0.9, 300, 4000)


def test_clusters_write_words_as_numbers(spark, folder, monkeypatch):
    kept, keep = [], tfidf.keep
    monkeypatch.setattr(tfidf, "keep", lambda df, *a: kept.append(df.columns) or keep(df, *a))
    assert agrees(spark, folder, "j7_clusters") and kept == [["ids", "n", "names", "codes"], ["id", "last", "n", "t", "x"]]


def shuffled(spark, run) -> tuple[int, int]:
    """Records and bytes that a run writes to shuffles."""
    sc = spark.sparkContext

    def total() -> tuple[int, int]:
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        every = [stages.apply(i) for i in range(stages.size())]
        return sum(s.shuffleWriteRecords() for s in every), sum(s.shuffleWriteBytes() for s in every)

    before = total()
    run()
    return tuple(y - x for x, y in zip(before, total()))


def test_scan_shuffles_texts_once(spark, tmp_path):
    from pyspark.sql import functions as F
    from notarium.operators import scan

    rng = random.Random(5)
    bodies = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789 ", k=20_000)) for _ in range(100)]
    rows = [(f"D{i:03}", None, f"h{i}", t) for i, t in enumerate([*bodies, *bodies[:5], " ", None])]
    spark.createDataFrame(rows, "doc_id string, frontmatter string, normalized_sha256 string, body string").write.parquet(str(tmp_path / "cleaned.parquet"))
    vecs, edges = (spark.createDataFrame([], s) for s in ("doc_id string, v array<float>", "a string, b string, similarity double"))
    seen, found = [], []

    def near(texts):
        seen.extend(r.id for r in texts.select("id").collect())
        return edges

    docs = similar.b.cleaned(spark, str(tmp_path)).select("doc_id", "body")
    _, size = shuffled(spark, lambda: found.extend(scan.pairs(docs, lambda ids: vecs, "doc_id", "body", 0.7, "case when exact then 'exact' end", near).select("a", "b").collect()))
    assert sorted(map(tuple, found)) == [(f"D{i:03}", f"D{i + 100:03}") for i in range(5)] and sorted(seen) == [f"D{i:03}" for i in range(100)]
    assert size < 1.5 * sum(map(len, bodies))


@pytest.mark.parametrize("kind", ["frequent", "flat", "apart"])
def test_terms_that_cannot_be_in_the_vocabulary_are_not_shuffled(spark, kind):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(2000)]
    each = {"frequent": [1 / (i + 1) for i in range(2000)], "flat": [1] * 2000, "apart": [1 / (i + 1) for i in range(2000)]}[kind]
    own = [" ".join((f"p{i // 125}" if kind == "apart" else "") + w for w in rng.choices(words, each, k=40)) for i in range(500)]
    own += [t + " w5 w6" for t in own[:60]]
    df = spark.createDataFrame(list(enumerate(own)), "id int, text string").repartitionByRange(8, "id")
    for vocabulary in (40, 97):
        found = []
        records, _ = shuffled(spark, lambda: found.extend(tfidf.similar_texts(df, "id", "text", 0.72, 2, vocabulary).collect()))
        want = tfidf.similar(tfidf.weights(df, "id", "text", 2, vocabulary), 0.72).collect()
        assert {(r.a, r.b): round(r.similarity, 9) for r in found} == {(r.a, r.b): round(r.similarity, 9) for r in want} and len(found) == len(want) > 50
        terms = len({t for x in own for ws in [x.split()] for t in [*ws, *map(" ".join, zip(ws, ws[1:]))]})
        assert kind != "frequent" or records < terms / 3
