"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tabwright.llm import variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def letter(c):
    return c.isascii() and c.isalpha() or "À" <= c <= "ÿ"


def counted(docs):
    """Words of at least 7 code points, by reading the texts letter by letter."""
    out = Counter()
    for doc_id, text in docs:
        for run in "".join(c if letter(c) else " " for c in text or "").split(" "):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if word and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def expected(vocabulary):
    holes, words = {}, sorted(vocabulary)
    for w in words:
        for i in range(len(w) + 1):
            for key in {(len(w), w[:i] + "?" + w[i + 1 :]), (len(w) + 1, w[:i] + "?" + w[i:])}:
                holes.setdefault(key, set()).add(w)
    found = {w: set() for w in words}
    for group in holes.values():
        for a in group:
            found[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in words:
        best = min(found[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best and vocabulary[best] >= 10 * vocabulary[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, vocabulary[w], len(found[w]), vocabulary.get(form[w])))
    return rows


def rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_documents(spark, some):
    docs = [(r["doc_id"], r["text"]) for r in some.collect()]
    assert rows(variants.spelling_variants(some)) == expected(counted(docs))


@pytest.mark.parametrize("limit", [3, 40, 2_000])
def test_dense_words(spark, limit):
    """Many near words, chains of forms, long shared beginnings and ends; small limits split buckets to the end."""
    rng = random.Random(limit)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 8, 9]))) for _ in range(900)}
    words |= {"x" * 40 + "".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(300)}
    words |= {"".join(rng.choice("abcdefgh") for _ in range(4)) + "yz" * 300 for _ in range(200)}
    vocabulary = {w: rng.choice([2, 3, 4, 30, 400, 5_000]) for w in words}
    table = spark.createDataFrame(sorted(vocabulary.items()), "word string, n long")
    entries = variants.bucket_entries(table, limit=limit)
    if limit > 3:  # no bucket over the limit is left
        assert entries.groupBy("c", "path", "bucket").count().filter(f"count > {limit}").isEmpty()
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"]) for r in variants.near_words(table, limit=limit).collect()}
    want = {w: [x for x in words if near(w, x)] for w in words}
    for w, others in want.items():
        best = min(others, key=lambda x: (-vocabulary[x], x), default=None)
        assert got[w] == (vocabulary[w], len(others), best, vocabulary.get(best))


def test_chain(spark):
    counts = {"abcdefgh": 2, "abcdefgg": 20, "abcdeffg": 200, "abcdeefg": 2_000, "abcddefg": 20_000, "unrelated": 5}
    text = " ".join(" ".join([w] * n) for w, n in counts.items())
    doc_id = next(i for i in range(1_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in counts))
    docs = spark.createDataFrame([(doc_id, text, "mine")], "doc_id long, text string, word string")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants.spelling_variants(docs).collect()}
    names = list(counts)
    for i, w in enumerate(names[:4]):
        assert got[w] == (names[i + 1], "abcddefg", counts[w], 1 + (i > 0), counts[names[i + 1]])
    assert got["unrelated"] == (None, "unrelated", 5, 0, None)


def test_odd_rows(spark, odd, none):
    docs = odd.withColumnRenamed("score", "n")
    assert rows(variants.spelling_variants(docs)) == expected(counted([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert variants.spelling_variants(none).count() == 0
    long = "ab" * 600
    got = rows(variants.spelling_variants(spark.createDataFrame([(None, f"{long} {long} {long}c {long}c")], "doc_id long, text string")))
    assert got == expected(counted([(None, f"{long} {long} {long}c {long}c")]))


def test_index_sets():
    """The sets of the index are those of a plain comparison, over more than one machine word."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.choice([7, 8]))) for _ in range(150)})
    index = variants.PositionIndex(words, np.arange(len(words)), np.zeros(len(words), np.int64), 7, "")
    for m in (7, 8):
        at, found = index.near(m)
        for r, bits in zip(at, np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")):
            w = index.words[r]
            assert {index.words[i] for i in np.flatnonzero(bits)} == {x for x in words if near(w, x) and min(len(w), len(x)) == 7}
