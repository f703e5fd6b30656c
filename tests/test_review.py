"""Chains of transforms and review decisions."""

from __future__ import annotations

import pytest

from notarium.operators import build, chain, quality, review


def test_chain(spark):
    text = "## **Bold**\r\nx\t\n\n[[ a ]]"
    assert chain.apply(text, ["normalize", "repair", "links"]) == "## Bold\nx\n\n[[a]]"
    assert chain.writable(["normalize"]) and not chain.writable(["normalize", "fence_indented"])
    with pytest.raises(ValueError):
        chain.register(chain.Transform("repair", str))
    df = spark.createDataFrame([("a", text), ("b", "same"), ("c", None), ("d", "")], "doc_id string, body string")
    got = {r["id"]: (r["changed"], r["stable"]) for r in chain.plan(df, "doc_id", "body", ["normalize", "repair"]).collect()}
    assert got == {"a": (True, True), "b": (False, True), "d": (False, True)}


def test_review(spark):
    waiting = review.items(("quality", spark.createDataFrame([("d1", "x"), ("d1", "x"), ("d2", None)], "doc_id string, current string")))
    assert {r["item"] for r in waiting.collect()} == {"quality::d1::x", "quality::d2::"}
    decided = spark.createDataFrame([("quality::d1::x", "yes", "v"), ("quality::d2::", "", None)], "item string, decision string, value string")
    assert {(r["doc_id"], r["state"]) for r in review.apply(waiting, decided).collect()} == {("d1", "decided"), ("d2", "open")}
    cats = spark.createDataFrame([(0, "a"), (4, "b")], "number int, name string")
    assert {tuple(r) for r in review.with_category(cats, "c").collect()} == {(0, "a"), (4, "b"), (5, "c")}
    assert review.with_category(cats, "b").count() == 2
    syn = spark.createDataFrame([("x", "y")], "tag string, canonical string")
    assert {tuple(r) for r in review.with_synonym(syn, "x", None).collect()} == {("x", None)}


def test_build(spark):
    df = spark.createDataFrame([("a", None), ("a", "1"), ("b", "2")], "old string, new string")
    assert [r["status"] for r in build.write_status(df, "old", "new").collect()] == ["skipped", "overwritten", "overwritten"]
    new, old = spark.createDataFrame([("k", None, "n")], "id string, a string, b string"), spark.createDataFrame([("k", "o", "o")], "id string, a string, b string")
    assert tuple(build.overlay(new, old, "id", ["a", "b"]).first()) == ("k", "o", "n")


def test_quality_axes(spark):
    df = spark.createDataFrame([(100.0, None), (None, None), (50.0, 0.0)], "d1 double, d2 double")
    from pyspark.sql import functions as F

    got = [r["m"] for r in df.select(quality.weighted_mean([F.col("d1"), F.col("d2")], [1.0, 1.0]).alias("m")).collect()]
    assert got == [100.0, 0.0, 25.0]
    rows = {r["dimension"]: (r["low"], r["median"], r["high"]) for r in quality.distribution(df, ["d1", "d2"]).collect()}
    assert rows == {"d1": (50.0, 75.0, 100.0), "d2": (0.0, 0.0, 0.0)}
