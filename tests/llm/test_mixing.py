"""Mixing sources against a plain reading of the contract."""

import re

import pytest
from pyspark.sql import functions as F

from tabwright.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shares(sizes, weights=(3, 1, 2), share=1.5, limit=2):
    """Targets by resharing until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, fixed, total = set(order), {}, share * sum(sizes.values())
    while left:
        each = (total - sum(fixed.values())) / sum(weight[s] for s in left)
        above = {s for s in left if each * weight[s] > limit * sizes[s]}
        if not above:
            return {**fixed, **{s: each * weight[s] for s in left}}
        fixed |= {s: limit * sizes[s] for s in above}
        left -= above
    return fixed


def check(docs, out):
    sizes, got, want = {}, {}, {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    goal = shares(sizes)
    source = {(r["doc_id"], size(r["text"])): r["source"] for r in docs.collect()}
    for r in out.collect():
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s], abs=1e-6)
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[s] = got.get(s, 0) + r["taken"]
        want[s] = int(r["target"] + 0.5)
    assert got == want


@pytest.mark.parametrize("parts", [1, 5])
def test_sources(spark, parts):
    """Sources of very unequal size, so that targets stop, are shared again, and are cut inside a document."""
    rows = [(i, "w " * (1 + i % 7), s) for i, s in enumerate(["hot"] * 300 + ["a"] * 2 + ["b"] * 9 + [None] * 40 + [""] * 3 + ["é"] + ["z"] * 25)]
    rows.append((1_000, "word " * 900, "long"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
    check(docs, mixing.mix(docs))


def test_reruns_agree(spark, some):
    first = sorted(map(tuple, mixing.mix(some).collect()))
    assert first == sorted(map(tuple, mixing.mix(some.repartition(7, F.rand(1))).collect()))
    check(some, mixing.mix(some))


def test_weights_and_epochs(spark):
    docs = spark.createDataFrame([(i, "a b c d", "one" if i % 2 else "two") for i in range(40)], "doc_id long, text string, source string")
    out = mixing.mix(docs, weights=(4, 1), share=2.0, limit=3).withColumn("odd", F.col("doc_id") % 2).groupBy("odd").agg(F.sum("taken").alias("t"), F.min("taken").alias("low"))
    assert {r["odd"]: (r["t"], r["low"]) for r in out.collect()} == {1: (240, 12), 0: (80, 4)}


def test_odd_rows(spark, odd, none):
    check(odd.dropDuplicates(["doc_id"]), mixing.mix(odd.dropDuplicates(["doc_id"])))
    got = mixing.mix(odd)
    assert got.count() == odd.count() and got.agg(F.sum("size")).first()[0] == sum(size(r["text"]) for r in odd.collect())
    assert mixing.mix(none).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string"))
    assert [tuple(r)[1:] for r in blank.collect()] == [(0, 0, 0.0, 0)] * 2
