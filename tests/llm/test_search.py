"""Nearest neighbours and near duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import ann, neardup


def exact(ids, x, queries, k=5):
    out = {}
    for q in queries:
        i = np.flatnonzero(ids == q)[0]
        s = x @ x[i] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[i])
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want = exact(ids, x, ids[ids % 50 == 0])
    got = {}
    for r in ann.nearest(vectors, F.col("vec_id") % 50 == 0, shard=700).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([r for r, _, _ in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values()) and set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]), (9, [0.0, 1.0]), (50, [1.0, 1.0]), (100, [0.0]), (None, [1.0, 0.0]), (150, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in ann.nearest(table, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False))).orderBy("query_id", "rank").collect()]
    assert [(q, r, v) for q, r, v, _ in got if q == 0] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 9)]
    assert [v for q, _, v, _ in got if q == 50] == [0, 1, 2, 9]
    assert {q for q, *_ in got} == {0, 50}
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0


def test_lone_queries_among_copies(spark):
    """The pilot sees copies only; queries without a copy still get all their neighbours, each once."""
    rng = np.random.default_rng(7)
    groups, lone = rng.standard_normal((120, 8)), rng.standard_normal((8, 8))
    x = np.concatenate([np.repeat(groups, 10, axis=0), lone])
    ids = np.arange(len(x))
    ids[-8:] += 100_000
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    table = table.withColumn("q", (F.col("vec_id") % 10 == 0) | (F.col("vec_id") >= 100_000))
    got = {}
    for r in ann.nearest(table, F.col("q"), shard=5_000).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == {r["vec_id"] for r in table.filter("q").collect()}
    assert all(len(v) == len(set(v)) == 5 and q not in v for q, v in got.items())


def test_no_block_is_broadcast(spark, monkeypatch):
    """Blocks meet shards in an exchange: a broadcast would hold every block once per shard. Rows are the same however blocks are run together."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((600, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    met, map_in_arrow = [], type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda df, *args: met.append(df) or map_in_arrow(df, *args))
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    parts, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 8, 50):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(tuple(r) for r in ann.nearest(table, F.col("vec_id") % 10 == 0, shard=100).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert got[0] == got[1] == got[2] and len(got[0]) == 5 * 60
    want = exact(np.arange(600), x, range(0, 600, 10))
    assert sum(v in {j for j, _ in want[q]} for q, _, v, _ in got[0]) >= 0.9 * 5 * 60
    assert len(met) == 6  # the pilot and all queries, three times
    for df in met:
        df.collect()  # from then on the plan is the one that ran
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def words(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n)]


def planted(rng):
    """Texts in classes: copies, near copies of one text, a chain, a shared passage, and texts of their own."""
    docs, classes = [], []

    def add(text, c):
        docs.append((len(docs), text))
        classes.append(c)

    base = words(rng, 120)
    for i in range(60):  # near copies, each with two words of its own
        own = list(base)
        own[5], own[60] = f"own{i}", f"other{i}"
        add(" ".join(own), "near")
    for _ in range(40):
        add(" ".join(base), "near")
    passage = words(rng, 55)
    for i in range(80):
        add(" ".join([*words(rng, 60), *passage, *words(rng, 60)]), f"own{i}")
    chain = words(rng, 200)
    for i in range(5):
        chain = [*chain[14:], *words(rng, 14)]
        add(" ".join(chain), "chain")
    add("too short", "short")
    add("Too  short", "short")
    return docs, classes


def shingle_sets(docs, texts):
    flat, sizes, _ = neardup.word_hashes(texts)
    owner, code, weight = neardup.shingles(flat, sizes, neardup.idf(*neardup.frequencies(docs)))
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(code[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]


def test_planted_classes(spark):
    docs, classes = planted(np.random.default_rng(6))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    least = {}
    for (d, _), c in zip(docs, classes):
        least.setdefault(c, d)
    assert got == {d: least[c] for (d, _), c in zip(docs, classes)}


def test_links_in_a_hot_bucket(spark, monkeypatch):
    """Pairs of like texts that share most of their words with hundreds of unlike ones are found, however large the buckets."""
    rng = np.random.default_rng(8)
    passage, docs, want = words(rng, 90), [], {}
    for i in range(150):
        own = words(rng, 60)
        for j in range(2):
            docs.append((2 * i + j, " ".join([*own[:59], f"copy{j}", *passage])))
            want[2 * i + j] = 2 * i
    monkeypatch.setattr(neardup, "CELL", 8)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_close_links_in_a_hot_bucket(spark, monkeypatch):
    """Pairs just over the threshold are found among hundreds of texts just under it, which took over 12 rounds of cuts."""
    rng = np.random.default_rng(9)
    passage, docs, want = words(rng, 300), [], {}
    for i in range(150):
        own, n = words(rng, 9), 6 + i % 4
        for j in range(2):
            docs.append((2 * i + j, " ".join([*own, *words(rng, n), *passage])))
            want[2 * i + j] = 2 * i
    monkeypatch.setattr(neardup, "CELL", 8)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets = shingle_sets(df, [t for _, t in docs])
    pairs = [neardup.similarity(sets[2 * i], sets[2 * i + 1]) for i in range(150)]
    others = [neardup.similarity(sets[0], sets[i]) for i in range(2, 300)]
    assert 0.8 <= min(pairs) and max(pairs) < 0.86 and 0.7 < min(others) and max(others) < 0.8
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()} == want


def test_links_through_matched_texts(spark):
    """A text that is like one of the leader's many likes only is linked through it."""
    rng = np.random.default_rng(10)
    base, docs = words(rng, 400), []
    for i in range(150):
        at = int(rng.integers(0, 330))
        like = [*base[:at], *words(rng, 8), *base[at + 8 :]]
        docs.append((2 * i, " ".join(like)))
        docs.append((2 * i + 1, " ".join([*like[: at + 8], *words(rng, 18), *like[at + 26 :]])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets = shingle_sets(df, [t for _, t in docs])
    assert min(neardup.similarity(sets[2 * i], sets[2 * i + 1]) for i in range(150)) >= 0.8
    assert {r["class_id"] for r in neardup.near_duplicates(df).collect()} == {0}


def test_all_links_found(spark, some):
    """Classes are those of all pairs at the weighted similarity, by brute force."""
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    n, df = neardup.frequencies(some)
    flat, sizes, plain = neardup.word_hashes([t or "" for _, t in rows])
    owner, code, weight = neardup.shingles(flat, sizes, neardup.idf(n, df))
    cut = np.searchsorted(owner, np.arange(len(rows) + 1))
    sets = [(code[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and neardup.similarity(sets[i], sets[j]) >= 0.8:
                root[find(i)] = find(j)
    want = {}
    for i, (d, _) in enumerate(rows):
        want.setdefault(find(i), []).append(d)
    got = {}
    for r in neardup.near_duplicates(some).collect():
        got.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_overlaps_are_those_of_pairs():
    """Shared weights by matrix products, with repeated shingles, equal weights and texts without words."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abcd"), n)) for n in rng.integers(0, 60, 30)] + ["", "a b c", "a b c"]
    flat, sizes, _ = neardup.word_hashes(texts)
    weights = rng.uniform(0.5, 3, 1 << neardup.DF_BITS).astype(np.float32)
    owner, code, weight = neardup.shingles(flat, sizes, weights)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    sets = [(code[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]
    total = np.array([w.sum(dtype=float) for _, w in sets])
    whole = neardup.overlaps(owner, code, weight, len(texts), len(texts))
    for left in (10, len(texts)):
        shared = neardup.overlaps(owner, code, weight, len(texts), left)
        for i in range(left):
            for j in range(left if left < len(texts) else 0, len(texts)):
                if i == j:
                    continue
                m = shared[i, j - left if left < len(texts) else j]
                assert m == pytest.approx(whole[i, j])
                union = total[i] + total[j] - m
                assert (m / union if union else 0.0) == pytest.approx(neardup.similarity(sets[i], sets[j]), abs=1e-6)


def test_spanning_links():
    linked = np.zeros((7, 7), bool)
    for i, j in ((0, 3), (3, 5), (0, 5), (1, 2)):
        linked[i, j] = linked[j, i] = True
    a, b = neardup.spanning(linked)
    assert len(a) == 3 and {frozenset(p) for p in zip(a.tolist(), b.tolist())} <= {frozenset(p) for p in ((0, 3), (3, 5), (0, 5), (1, 2))}


def test_names_of_the_operator_in_the_input(spark, odd):
    docs = odd.selectExpr("doc_id", "text", "7 AS _mark", "8 AS _root", "9 AS _member", "10 AS _stays")
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and {tuple(r)[2:] for r in kept.collect()} == {(7, 8, 9, 10)}


def test_samples_estimate_similarity():
    rng = np.random.default_rng(3)
    code = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    w = rng.uniform(0.5, 4, 400).astype(np.float32)
    a, b = (code[:300], w[:300]), (code[100:], w[100:] * np.float32(1.3))
    owner = np.repeat([0, 1], 300)
    got = neardup.samples(owner, np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 2, 3000)
    assert abs((got[0] == got[1]).mean() - neardup.similarity(a, b)) < 0.04


def test_odd_documents(odd, none):
    got = {}
    for r in neardup.near_duplicates(odd).collect():
        got.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"]))
    assert got[1] == got[2] == [(1, 2)] and got[7] == [(7, 2)] * 2
    assert got[3] == [(3, 1)] and got[4] == [(4, 1)] and got[5] == [(5, 1)] and got[None] == [(None, 1)]
    assert neardup.near_duplicates(none).count() == 0
    kept = neardup.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 10] and ids.count(None) == 1


def test_one_of_each_judges_rows(spark):
    """Rows without a doc_id, or with the same one, stay or go by the class of their own text."""
    rng = np.random.default_rng(11)
    a, b, c, d, e = (" ".join(words(rng, 30)) for _ in range(5))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (2, a), (2, d), (3, e), (3, e)]
    kept = neardup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, a), (None, b), (None, c), (None, c), (2, d), (3, e)], key=str)
