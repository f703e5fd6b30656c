"""Operators for text collections against brute force, with nulls, blanks, repeats, long texts, clashing names and empty tables."""

from __future__ import annotations

import itertools
import random
import re
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from notarium.llm import codepoints, forest, languages, lookalike, markup, mixing, near, packing, pieces, repeats, sentences, wordset
from notarium.llm.markdown import fences

WORDS = "the old folder links every empty section and the parser stores a short excerpt while nobody asks for the weekly plan again".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, body, text, id, kind, tokens): the last four only clash with names used inside."""
    rng = random.Random(3)
    base = [prose(rng, rng.randint(20, 120)) for _ in range(30)]
    rows = [(f"d{i:03}", t) for i, t in enumerate(base)]
    for i in range(12):  # small edits
        w = base[i].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((f"e{i:03}", " ".join(w)))
    rows += [(f"c{i:03}", base[0]) for i in range(9)]  # copies
    rows += rows[:5]  # repeated rows
    rows += [("n1", None), ("n2", ""), ("n3", " \n\t"), ("s1", "ab"), ("s2", "ab"), ("s3", "a\u200bb"), (None, base[1]), ("z" * 9, prose(rng, 20000))]
    return [(i, t, "x", 1, None, b"") for i, t in rows]


SCHEMA = "doc_id string, body string, text string, id int, kind string, tokens binary"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


def shingles(t: str) -> frozenset:
    w = re.findall(r"[^\W_]+", t.replace("\u200b", "").lower())
    return frozenset(zip(w, w[1:], w[2:]))


def brute_pairs(rows) -> set:
    have = {i: t for i, t, *_ in rows if i and t and t.strip()}
    out = set()
    for a, b in itertools.combinations(sorted(have), 2):
        x, y = shingles(have[a]), shingles(have[b])
        if x and y:
            same = len(x & y)
            hit = 5 * same >= 3 * (len(x) + len(y) - same)
        else:
            hit = not x and not y and have[a].replace("\u200b", "") == have[b].replace("\u200b", "")
        if hit:
            out.add((a, b))
    return out


def test_near_duplicates(docs):
    got = {tuple(r) for r in near.expanded(near.near_duplicates(docs, up=3, down=5)).collect()}
    assert got == brute_pairs(corpus())


def test_near_duplicates_split_blocks(docs, monkeypatch):
    monkeypatch.setattr(near, "HOT", 2)
    got = {tuple(r) for r in near.expanded(near.near_duplicates(docs, up=3, down=5)).collect()}
    assert got == brute_pairs(corpus())


def test_counts_have_no_end():
    import numpy as np

    n = np.array([0, 1, 2, 3, 1000, 65_535, 65_536, 10**9], np.uint64)
    level = near.level_of(n)
    assert (np.diff(level.astype(int)) >= 0).all() and level[-1] > level[-2] > level[-4]
    assert (abs(near.LEVELS[level] / np.maximum(n, 1) - 1)[1:] < 0.1).all()


def test_prefixes_lose_nothing(spark):
    """Random sets of few shingles over a small alphabet: many pairs near the threshold."""
    rng = random.Random(8)
    rows = [(f"r{i:03}", " ".join(rng.choice("abc") for _ in range(rng.randint(3, 30)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id string, body string")
    got = {tuple(r) for r in near.expanded(near.near_duplicates(df, up=3, down=5)).collect()}
    assert got == brute_pairs(rows)


def test_empty_tables(docs):
    none = docs.where("false")
    assert near.expanded(near.near_duplicates(none)).count() == 0
    assert pieces.split(none, "doc_id", "body").count() == 0
    assert repeats.labelled(none, "doc_id", "body").count() == 0
    assert sentences.sentences(none, "doc_id", "body").count() == 0
    assert languages.paragraph_languages(languages.with_label(none.withColumnRenamed("kind", "frontmatter")), "doc_id", "body", "label").count() == 0
    assert lookalike.one_form(none, ["body"]).count() == 0
    assert packing.pack(none.selectExpr("doc_id", "1L as tokens")).count() == 0
    assert markup.clean_texts(none.withColumnRenamed("kind", "host"), "doc_id", "body", "host").count() == 0


def test_forest_decides_like_the_loop(spark, tmp_path):
    rng = random.Random(5)
    rows = [r[:2] for r in corpus() if r[0]]
    ids = sorted({r[0] for r in rows})
    body = dict(rows)
    raw = {i: (f"SHA256:{hash(body[i]) % 7:x}" if rng.random() < 0.1 else None) for i in ids}
    deliveries = [(n, 0 if n < 20 else 1 + n // 15, rng.choice([*ids, "unknown"]), None, None) for n in range(90)]
    spark.createDataFrame(deliveries + deliveries[:9] + [(None, 1, "d001", None, None)], "delivery_id bigint, batch_no int, doc_id string, arrived_at timestamp, source string").write.parquet(f"{tmp_path}/intake.parquet")
    spark.createDataFrame([(i, raw[i]) for i in ids], "doc_id string, sha256 string").write.parquet(f"{tmp_path}/manifest.parquet")
    spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id string, body string, normalized_sha256 string").write.parquet(f"{tmp_path}/cleaned.parquet")
    links: dict = {}
    for a, b in brute_pairs(rows):
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    accepted, hashes, want = set(), set(), set()
    for n, batch, doc, *_ in sorted(deliveries, key=lambda x: (x[1], x[0])):
        if doc not in body or not (body[doc] or "").strip():
            continue
        if batch and (doc in accepted or raw[doc] and raw[doc].lower() in hashes or links.get(doc, set()) & accepted):
            want.add((doc, batch))
            continue
        accepted.add(doc)
        hashes |= {raw[doc].lower()} if raw[doc] else set()
    got = {tuple(r) for r in forest.p3_found(spark, str(tmp_path)).collect()}
    assert want and got == want


def test_history_takes_ten_batches(spark, tmp_path):
    """Batch after batch, opened again each time, against the loop over all; only the batch's texts become tokens."""
    rng = random.Random(11)
    rows = {r[0]: r[1] for r in corpus() if r[0] and r[1] and r[1].strip() and len(r[1]) < 9000}
    ids = sorted(rows)
    rng.shuffle(ids)
    linked: dict = {}
    for a, b in brute_pairs([(i, t) for i, t in rows.items()]):
        linked.setdefault(a, set()).add(b)
        linked.setdefault(b, set()).add(a)
    accepted: set = set()
    for batch in range(10):
        part = [rng.choice(ids) for _ in range(6)] if batch else ids[:12]
        texts = near.text_sets(spark.createDataFrame([(i, rows[i]) for i in part], "doc_id string, body string"), "doc_id", "body")
        classes = {r["doc_id"]: r["class_id"] for r in texts.where("kind = 0").collect()}
        assert set(classes) == set(part)
        at = {n + 100 * batch: i for n, i in enumerate(part)}
        deliveries = spark.createDataFrame([(n, i, classes[i], [], None) for n, i in at.items()], "at bigint, doc_id string, class_id bigint, raws array<string>, norms array<string>")
        history = forest.History(spark, f"file://{tmp_path}/history", most_runs=3)
        tokens = texts.where("kind = 1").select("class_id", "tokens")
        if not batch:
            history.add(deliveries, tokens)
            accepted |= set(part)
            continue
        got = {at[r["at"]] if r["accepted"] else None for r in history.screen(deliveries, tokens).collect()} - {None}
        want = set()
        for i in at.values():
            if i not in accepted and not linked.get(i, set()) & accepted:
                want.add(i)
                accepted.add(i)
        assert got == want, batch
        assert len(history.runs()) <= 4
    stored = history.entries().collect()
    assert sum(len(r["entries"]) for r in stored) == history.classes() * forest.TREES * forest.ENTRY.itemsize
    slots = [(r["first_slot"], r["last_slot"]) for r in stored]
    assert all(a <= b for a, b in slots)


def test_range_search_is_that_of_prefixes(spark, monkeypatch):
    """Every pair with the same first hashes in a permutation, also in ranges too wide to hand on at once."""
    import numpy as np

    rng = np.random.default_rng(4)
    sigs = rng.integers(0, 3, (60, forest.TREES * forest.APART), dtype=np.uint8)
    order = forest.permutations()
    keyed = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sigs)], "class_id bigint, signature binary")
    runs = forest.sorted_run(keyed.where("class_id < 40"), 40)
    want = {}
    for a, b in itertools.combinations(range(60), 2):
        same = [int(np.argmin(np.append(sigs[a][o] == sigs[b][o], False))) for o in order]
        if b >= 40 and max(same) >= 4:
            want[(b, a) if a < 40 else (a, b)] = max(same)
    for most in (512, 2):
        monkeypatch.setattr(forest, "MOST_RANGE", most)
        out = forest.search(runs, 40, keyed.where("class_id >= 40"), 20, 4, all_of=True).collect()
        assert {(r["class_a"], r["class_b"]): r["level"] for r in out} == want
        some = forest.search(runs, 40, keyed.where("class_id >= 40"), 20, 4).collect()
        assert {(r["class_a"], r["class_b"]) for r in some} <= set(want)
    assert forest.depth_for(0.6) == forest.APART and forest.depth_for(0.3) < forest.APART


# --- the form as it looks -------------------------------------------------------

TEXT = st.text(alphabet=st.sampled_from(list("aeéèoñçäöüße\u0301\u0308\u0327\u0323xyz АВесоё Ωωάα日本ｱﾞカﾊﾟ한국ก็ \u00a0\u2009\u3000\u200b\u00ad\ufeffＡｂ１\n‐-")), max_size=30)


def slow_form(t: str) -> str:
    """One character after the other, by the library's normal forms."""
    out = "".join(codepoints._visible(c) for c in t)
    return unicodedata.normalize("NFC", out)


@settings(deadline=None, max_examples=300)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_fold(texts):
    got = codepoints.fold(pa.array([*texts, None])).to_pylist()
    assert got[-1] is None
    assert codepoints.fold(pa.array(got[:-1])).to_pylist() == got[:-1]  # idempotent
    for t, g in zip(texts, got, strict=False):
        assert g == codepoints.fold(pa.array([unicodedata.normalize("NFD", t)])).to_pylist()[0] or "\u115f" in t
        simple = slow_form(t)
        if not any(c in codepoints.LOOK_ALIKE for c in unicodedata.normalize("NFD", t)):
            assert g == simple


def test_same_look():
    one = lambda x: codepoints.fold(pa.array([x])).to_pylist()[0]
    assert one("cafe\u0301 Ｚｅｎ\u00a0рор\u200b") == one("café Zen pop")
    assert one("Straße") != one("Strasse") and one("A") != one("a") and one("a!") != one("a.")


def test_alike(spark):
    rows = [("a", "x y"), ("b", "x\u00a0y"), ("c", "x\u2009y"), ("d", "x y"), ("d", "x y"), ("e", None), ("f", " "), ("g", "\u00a0"), ("h", "X y")]
    df = spark.createDataFrame([("f1", i, v, 5) for i, v in rows], "field string, id string, value string, form int")
    assert {tuple(r)[1:] for r in lookalike.alike(df).collect()} == {("a", "b"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "d")}


# --- pieces -------------------------------------------------------------------------


def test_pieces():
    rng = random.Random(2)
    text = "\n\n".join(prose(rng, 90) for _ in range(60))
    parts = pieces.pieces(text)
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    for (a, b), (c, e) in itertools.pairwise(parts):
        assert a < c <= b < e and 100 <= b - c <= 250
    assert all(b - a <= 6000 for a, b in parts)
    assert sum(text[b - 2 : b] == "\n\n" for _, b in parts[:-1]) == len(parts) - 1  # all at paragraph ends
    edited = text[:9000] + "EDIT " + text[9000:]
    before = {text[a:b] for a, b in parts}
    after = [edited[a:b] for a, b in pieces.pieces(edited)]
    assert sum(p in before for p in after) >= len(after) - 4
    whole = "x" * 50000
    assert all(b - a <= 6000 for a, b in pieces.pieces(whole)) and pieces.pieces("") == [] and pieces.pieces("ab") == [(0, 2)]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.sampled_from(["", " ", "text", "```", "```js", "~~~~", "````", "  ~~~ ", "a\tb"]), max_size=14).map("\n".join))
def test_blocks(text):
    found = pieces.blocks(text)
    covered = set()
    for b, e, _ in found:
        covered |= set(range(b, e))
    assert all(text[i].isspace() for i in range(len(text)) if i not in covered)
    assert [(b, e) for b, e, code in found if code] == fences(text)
    assert all(x[1] <= y[0] for x, y in itertools.pairwise(found))


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(st.sampled_from(["a", "ab. ", "word ", "x\n"]), st.integers(1, 9000), st.booleans()), min_size=1, max_size=6))
def test_cut_blocks_are_those_above_the_limit(parts):
    text = "\n\n".join(("```\n" + (t * n)[:n] + "\n```" if code else (t * n)[:n]) for t, n, code in parts)
    made = pieces.pieces(text)
    cut = pieces.cut_blocks(text, [e for _, e in made])
    assert sorted(k for v in cut.values() for k in v) == [k for k, (b, e, _) in enumerate(pieces.blocks(text), 1) if e - b > pieces.LIMIT]


# --- repeats ---------------------------------------------------------------------------


def slow_share(t: str, k: int = 6) -> float:
    w = re.findall(r"[^\W_]+", t.lower())
    seen, covered = set(), set()
    for i in range(len(w) - k + 1):
        g = tuple(w[i : i + k])
        if g in seen:
            covered |= set(range(i, i + k))
        seen.add(g)
    return len(covered) / max(1, len(w))


def test_repeats(spark):
    rng = random.Random(6)
    texts = [prose(rng, n) + " " + " ".join([prose(rng, 12)] * k) for n, k in itertools.product((10, 60, 200), (1, 2, 4, 9))] + ["", "a a a a a a a a a", None, " "]
    df = spark.createDataFrame([(str(i), t, 1.0) for i, t in enumerate(texts)], "doc_id string, body string, share double")
    got = {r["doc_id"]: r for r in repeats.labelled(df, "doc_id", "body").collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert str(i) not in got
        else:
            assert abs(got[str(i)]["share"] - slow_share(t)) < 1e-9 and got[str(i)]["repetitive"] == (slow_share(t) >= 0.3)
            assert got[str(i)]["short_share"] >= got[str(i)]["share"] and (got[str(i)]["rule"] > 0 or got[str(i)]["share"] < 0.3)
    assert "share" not in repeats.FEATURES
    dense = "".join(chr(0x4E00 + rng.randrange(900)) for _ in range(80))
    row = repeats.statistics(spark.createDataFrame([("x", dense * 2)], "d string, t string"), "d", "t").first()
    assert row["share"] == row["short_share"] == 0.5


def test_decision_list_learns_conjunctions():
    import numpy as np

    rng = np.random.default_rng(1)
    x = {k: rng.random(600) for k in repeats.FEATURES}
    y = (x["short_share"] > 0.4) & (x["words"] <= 0.5)
    rules = repeats.learn(x, y)
    hit = np.zeros(600, bool)
    for r in rules:
        hit |= r.holds(x)
    assert (hit == y).mean() > 0.95 and hit[y].mean() > 0.95


# --- packing and mixing -----------------------------------------------------------------


@pytest.mark.parametrize("rows", [500_000, 70])
def test_packing(spark, monkeypatch, rows):
    monkeypatch.setattr(packing, "PART_ROWS", rows)
    rng = random.Random(9)
    sizes = [(i, max(0, int(rng.lognormvariate(6, 1)))) for i in range(3000)] + [(9000 + i, 700) for i in range(1500)] + [(9999, None)]
    out = packing.pack(spark.createDataFrame(sizes, "doc_id bigint, tokens bigint")).collect()
    load, seen = Counter(), Counter()
    for r in out:
        load[r["container"]] += r["tokens"]
        seen[r["doc_id"]] += r["tokens"]
    assert max(load.values()) <= packing.CAPACITY
    assert seen == Counter({i: n for i, n in sizes if n})
    cut = Counter(r["doc_id"] for r in out)
    assert all(cut[i] == -(-n // packing.CAPACITY) for i, n in sizes if n)
    assert sum(load.values()) / (len(load) * packing.CAPACITY) > 0.9
    assert sorted({r["container"] for r in out}) == list(range(1, len(load) + 1))


@settings(deadline=None, max_examples=200)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=20))
def test_patterns(histogram):
    found = packing.patterns(histogram, 50)
    total: Counter = Counter()
    for lengths, count in found:
        assert sum(lengths) <= 50 and count > 0
        for n in lengths:
            total[n] += count
    assert total == Counter(histogram)


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, "big", rng.randint(5, 60)) for i in range(4000)] + [(5000 + i, "small", rng.randint(5, 60)) for i in range(120)] + [(7000, None, 5), (7001, "other", 9), (7002, "big", 0)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 4), ("absent", 0.1, 3)], "source string, target_share double, max_repeats int")
    drawn, planned = mixing.draw(sizes, targets)
    got: Counter = Counter()
    uses: Counter = Counter()
    for r in drawn.collect():
        got[r["source"]] += r["tokens"]
        uses[r["doc_id"]] += 1
        assert r["source"] in ("big", "small")
    total = sum(got.values())
    for r in planned.collect():
        assert abs(got[r["source"]] - r["budget"]) <= 30
    assert max(mixing.plan({"a": 1000, "b": 70}, {"a": (0.5, 1), "b": (0.5, 4)})[k][5] for k in (0, 1)) == 280
    assert abs(got["big"] / total - 5 / 9) < 0.01 and abs(got["small"] / total - 4 / 9) < 0.01
    assert max(uses.values()) <= 4 and max(uses[i] for i in range(4000)) <= 1
    assert {r["source"]: r["budget"] for r in planned.collect()}["absent"] == 0
    flat = mixing.plan({"a": 900, "b": 100}, {"a": (0.5, 1), "b": (0.5, 2)}, total=800)
    assert all(r[5] <= r[3] * r[2] for r in flat) and abs(sum(r[5] for r in flat) - 800) <= 2
    e = mixing.exponent_for_entropy([0.9, 0.1], 0.6)
    assert abs(mixing.entropy(mixing.tempered([0.9, 0.1], e)) - 0.6) < 1e-6


# --- languages, markup, sentences ---------------------------------------------------------


def test_many_paragraphs_keep_their_language():
    model = languages.fit_profiles([])
    n = 65_536 + 40
    texts = [""] * n
    places = {0: "de", 17: "fr", 65_535: "en", 65_536: "es", n - 1: "it"}
    for k, lang in places.items():
        texts[k] = languages.SEED[lang]
    best, lead, letters, held = model.nearest(texts)
    assert len(best) == len(lead) == len(letters) == len(held) == n
    for k, lang in places.items():
        b, ahead, size, _ = model.nearest([languages.SEED[lang]])
        assert languages.LANGUAGES[best[k]] == lang and (best[k], lead[k], letters[k]) == (b[0], ahead[0], size[0])


def test_languages(spark):
    rows = [("a", languages.SEED["de"] + "\n\n" + languages.SEED["fr"], '{"lang": "de"}'), ("b", languages.SEED["en"], '{"language": " EN-gb "}'), ("c", languages.SEED["ja"], None), ("d", "# Kopf\n\n```\nfor the and of to in\n```", None), ("e", None, None), ("f", languages.SEED["es"] + "\n\n> " + languages.SEED["it"], '{"sprache": "Español"}')]
    df = languages.with_label(spark.createDataFrame(rows + rows[:1], "doc_id string, body string, frontmatter string"))
    out = languages.paragraph_languages(df, "doc_id", "body", "label").collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add((r["lang"], r["mixed"], r["label"]))
    assert by == {"a": {("de", True, "de"), ("fr", True, "de")}, "b": {("en", False, "en")}, "c": {("ja", False, None)}, "f": {("es", False, "es")}}


def test_each_paragraph_comes_out_once(spark):
    rows = [(f"d{i:04}", languages.SEED["en"] if i % 3 else languages.SEED["de"] + "\n\n" + languages.SEED["ru"], None) for i in range(1000)]
    rows.append(("ar", "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا", None))
    df = languages.with_label(spark.createDataFrame(rows, "doc_id string, body string, frontmatter string")).coalesce(1)
    out = languages.paragraph_languages(df, "doc_id", "body", "label").collect()
    assert len(out) == len({(r["doc_id"], r["paragraph_no"]) for r in out}) == 334 * 2 + 666 + 1
    assert [r["lang"] for r in out if r["doc_id"] == "ar"] == ["und"]


def test_ranks_are_those_among_all_own_ngrams():
    """Against the definition, one paragraph at a time."""
    model = languages.fit_profiles([])
    model._prepare()
    for lang, text in languages.SEED.items():
        _, gram, _ = languages.grams([text], model._symbols)
        times = Counter(gram.tolist())
        order = sorted(times.values(), reverse=True)
        far = []
        for ranks in model.ranks:
            known = dict(zip(model.keys.tolist(), ranks.tolist(), strict=True))
            d = 0
            for g, n in times.items():
                if g in known:
                    rank = int(min(order.index(n) + (order.count(n) - 1) / 2, languages.PROFILE))
                    d += abs(known[g] - rank) if known[g] < languages.PROFILE else languages.PROFILE
            far.append(d)
        best, lead, _, held = model.nearest([text])
        low = sorted(far)
        assert languages.LANGUAGES[best[0]] == lang == languages.LANGUAGES[far.index(low[0])]
        assert abs(lead[0] - (low[1] - low[0]) / low[1]) < 1e-12 and 0 < held[0] <= 1


def test_markup():
    assert markup.kinds_of_body("a <b>x</b> '''y''' \\textbf{z}") == {"html", "wiki", "latex"}
    for own in ("List<String> x < y > Z", "a == b == C", "C:\\notes\\setup\\X", "Q&A & 5 < 7", "<https://a.example/x>", "[[link|alias]] ![[embed]]", "$\\frac{1}{2}$ and $$\\sum_{i}$$", "`<b>` and `{{x}}`", "```\n<p>\n```", "> [!note] text", ""):
        assert markup.kinds_of_body(own) == set(), own
    assert markup.clean("<h2>T</h2>\n<ul><li>a &amp; b</li></ul>\n<pre><code>x &lt; 1</code></pre>") == "## T\n\n- a & b\n\n```\nx < 1\n```"
    assert markup.clean("\\section{T}\n\\begin{itemize}\n\\item a\\footnote{n}\n\\end{itemize} $x$").startswith("# T")
    assert markup.clean("== T ==\n{{Box|a=1}} [[Datei:x.png|mini|cap]] [https://a.example t]") == "## T\n1 cap t"
    assert markup.clean("<script>bad()</script>ok") == "ok"
    assert markup.kinds_of_heading("**x**") == {"markdown"} and markup.kinds_of_heading("'''x'''") == {"wiki"} and markup.kinds_of_heading("plain: 2 * 3") == set()
    assert markup.kinds_of_code("python", "a &lt; b") == {"html"} and markup.kinds_of_code("html", "<p>&lt;</p>") == set()
    assert markup.clean_code("bash", "a\\_b &amp;&amp; c<br/>") == "a_b && c"


def test_hosts_vote_on_paths(spark):
    """A path that holds links only on most pages of a host is left out on all of them, on another host it stays."""
    menu = '<div class="menu"><a href="x">Home page here</a></div><p>Real text of the page.</p>'
    odd = '<div class="menu">A few words that are no links</div><p>Other text.</p>'
    rows = [(f"a{i}", menu, "site") for i in range(6)] + [("a9", odd, "site"), ("b1", odd, "other"), ("c1", "plain", None), ("c2", None, "site"), ("c3", "", "site"), (None, menu, "site")]
    df = spark.createDataFrame(rows + rows[:2], "doc_id string, body string, host string")
    got = {r["doc_id"]: r["text"] for r in markup.clean_texts(df, "doc_id", "body", "host").collect()}
    assert "Real text" in got["a0"] and "Home page" not in got["a0"]
    assert "few words" not in got["a9"] and "Other text" in got["a9"]
    assert "few words" in got["b1"] and got["c1"] == "plain" and got["c2"] is None and got["c3"] == ""
    made = markup.extract(menu, frozenset({"div.menu"}))
    assert made[1] == {"html"} and "Home" not in made[0]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.sampled_from(["<p>", "</p>", "text ", "'''b'''", "\\emph{x}", "{{t|v}}", "\n", "&lt;", "`<b>`", "$x<y$", "}", "<table><tr><td>1</td></tr></table>", "\\begin{a}", "== h ==", "\\ "]), max_size=12).map("".join))
def test_clean_never_fails_and_keeps_words(text):
    done = markup.clean(text)
    assert isinstance(done, str)
    assert done.count("text") == text.count("text")


MODEL = sentences.fit([])
CASES = [
    ("Das ist z. B. gut. Dr. Meier kam am 16. März. Er ging!", ["Das", "Dr.", "Er"]),
    ("„Das genügt. Wirklich.“, so Meier. (Ein Satz. Noch einer.) Danach kam er.", ["„Das", "(Ein", "Danach"]),
    ("# 2.3 Titel. Mehr\n\n- eins. Zwei\n- drei\n\n> Zitat eins. Zitat zwei.", ["2.3", "eins.", "Zwei", "drei", "Zitat", "Zitat"]),
    ("这是第一句。“他说。好。”王说。第三句！", ["这是第一句。“他说。好。”王说。第三句！"[:6], "“他说", "第三句"]),
    ("The log grew... and more. It ended. 🎉 Then at 10.30 a.m. it began? Yes.", ["The", "It", "Then", "Yes"]),
    ("```\nNo. Sentence. Here.\n```\n\nOne line\nruns over. Two", ["One", "Two"]),
    ("Η πηγή τελείωσε; Το σχέδιο αρχίζει.", ["Η", "Το"]),
]


@pytest.mark.parametrize(("text", "starts"), CASES)
def test_sentences(text, starts):
    got = [text[a:b] for a, b in MODEL.starts(text)]
    assert len(got) == len(starts) and all(g.startswith(s[: len(g)]) for g, s in zip(got, starts, strict=True)), got


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=st.sampled_from(list("aA1.!?…。 \n\r\t„“»«()'\"#->`~🎉ก")), max_size=60))
def test_sentences_are_in_order(text):
    got = MODEL.starts(text)
    assert all(a < b <= len(text) and not text[a].isspace() for a, b in got)
    assert all(x[1] <= y[0] for x, y in itertools.pairwise(got))


def test_words_and_tokens():
    points, at = codepoints.to_points(pa.array(["Ab cd ab", "", None, "ab CD ab"]))
    w = wordset.Words(points, at)
    assert list(w.word_at) == [0, 3, 3, 3, 6] and (w.hash[:3] == w.hash[3:]).all()
    _, tokens, to = wordset.token_sets(points, at)
    assert list(to) == [0, 1, 1, 1, 2] and tokens[0] == tokens[1]
