"""Changes of single notes, asset folders, run log."""

from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st

from notarium.functions import notes
from notarium.operators import assets


@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cc", "Cs", "Zl", "Zp")), min_size=1, max_size=8), max_size=4), st.text(max_size=30))
def test_additive(values, body):
    before = "---\ntitle: a\n---\n" + body
    after = notes.add_list(before, "keyphrases", values)
    assert notes.is_additive(before, after, "keyphrases")
    assert notes.add_list(after, "keyphrases", values) == after
    assert notes.add_list(body.replace("---", ""), "keyphrases", values) == body.replace("---", "")


def test_patches():
    assert notes.without_tokens("a turn0search12 b turn3view4") == ("a b", 2)
    assert notes.rebuilt_links("urlDocshttps://x.example/y and <T>https://z.example") == ("[Docs](https://x.example/y) and [T](https://z.example)", 2)
    assert notes.rebuilt_links("<https://a.example> plain") == ("<https://a.example> plain", 0)


def test_asset_folders(spark):
    n = spark.createDataFrame([("a", "p"), ("b", "q"), ("c", "r"), ("d", "s"), ("e", "t")], "stem string, parent string")
    f = spark.createDataFrame([("p", "a_assets", 3), ("p", "assets", 1), ("q", "assets", 1), ("r", "x", 2), ("r", "y", 2), ("s", "only", 1), ("t", "empty", 0)], "parent string, folder string, images int")
    got = {r["stem"]: (r["folder"], r["state"]) for r in assets.asset_folders(n, f).collect()}
    assert got == {"a": ("a_assets", "found"), "b": ("assets", "found"), "c": (None, "quarantine"), "d": ("only", "found"), "e": (None, "none")}


def test_run_row(spark):
    df = spark.createDataFrame([("a",), ("b",)], "id string")
    one = assets.run_row(spark, "s", df, "id", {"k": 1}, 0.5).first()
    assert one["run_key"] == assets.run_row(spark, "s", df.orderBy("id", ascending=False), "id", {"k": 1}, 0.1).first()["run_key"]
    assert one["run_key"] != assets.run_row(spark, "s", df, "id", {"k": 2}, 0.5).first()["run_key"]
    assert assets.run_row(spark, "s", df.where("false"), "id", {}, 0.0).first()["rows"] == 0
