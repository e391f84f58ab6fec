"""Token operators against the libraries on whole texts."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabwright.llm import offsets, packing, pieces, token_counts
from tabwright.llm.queries import vocabulary

BYTE, WORD, PIECE = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json"), vocabulary("piece_bpe_32k.model")


def key(d):
    return (d is not None, d or 0)


def rows_of(df):
    return sorted([(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()], key=lambda r: (key(r[0]), r[1]))


def test_merges_make_each_symbol_once():
    """What allows merging all lowest pairs of a sequence at once: a symbol has one pair, ranked after its parts."""
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in json.load(open(BYTE))["model"]["merges"]]
    rank = {a + b: i for i, (a, b) in enumerate(merges)}
    assert len(rank) == len(merges)
    assert all(rank.get(a, -1) < i and rank.get(b, -1) < i for i, (a, b) in enumerate(merges))


@pytest.mark.parametrize("table", ["odd", "some", "none"])
def test_counts(request, table):
    docs = request.getfixturevalue(table)
    library = Tokenizer.from_file(BYTE)
    want = sorted((key(d), len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024) for d, t in rows_of(docs))
    got = token_counts.token_counts(docs, BYTE).collect()
    assert sorted((key(r[0]), *r[1:]) for r in got) == want


@pytest.mark.parametrize("table", ["odd", "some", "none"])
def test_files(spark, request, table):
    docs = request.getfixturevalue(table)
    library, start, want = Tokenizer.from_file(BYTE), 0, []
    folder, manifest = offsets.write_token_files(docs, BYTE, file_ids=20_000)
    got = offsets.read_token_files(spark, folder, manifest).collect()
    for d, t in rows_of(docs):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in sorted(got, key=lambda r: r["start"])] == want


def test_elias_fano():
    rng = np.random.default_rng(1)
    for values in ([], [0], [5, 5, 5], [-7, -7, 0, 2**62], np.sort(rng.integers(-1000, 10**9, 3000)), np.arange(700)):
        values = np.array(values, np.int64)
        coded = offsets.EliasFano.of(values)
        back, _ = offsets.EliasFano.read(memoryview(coded.to_bytes()), 0)
        assert back.values().tolist() == values.tolist()
        assert [back.select(i) for i in range(len(values))] == values.tolist()
    dense = offsets.EliasFano.of(np.cumsum(rng.integers(1, 2000, 10_000)))
    assert len(dense.to_bytes()) * 8 < 10_000 * 14


@pytest.mark.parametrize("table", ["odd", "some", "none"])
def test_pieces(request, table):
    import sentencepiece

    docs = request.getfixturevalue(table)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = []
    for d, t in rows_of(docs):
        ids = sp.encode(t, add_bos=True, add_eos=True)
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((key(d), len(ids), sha, hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = pieces.encode_pieces(docs, PIECE).collect()
    assert sorted((key(r[0]), *r[1:]) for r in got) == sorted(want)


@pytest.mark.parametrize("table", ["odd", "some", "none"])
def test_packing(request, table):
    docs = request.getfixturevalue(table)
    library, want = Tokenizer.from_file(WORD), []
    for d, t in rows_of(docs):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want += [(key(d), k, s, len(p := ids[s : s + 4096]), zlib.crc32(p.tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    got = packing.pack_documents(docs, WORD).collect()
    assert sorted((key(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(w[3] for w in want) // 4096) + 1


def test_packing_blocks(spark):
    """Many blocks: close to the least number of bins, with a third of the rows of one length."""
    rng = np.random.default_rng(2)
    sizes = np.where(rng.random(3000) < 1 / 3, 2000, np.minimum(4096, rng.lognormal(6, 1, 3000).astype(int) + 1))
    table = spark.createDataFrame([(int(s),) for s in sizes], "length long")
    packed = packing.pack(table, block=256)
    bins = packed.groupBy("sequence_id").sum("length").collect()
    assert packed.count() == 3000 and max(r[1] for r in bins) <= 4096
    assert len(bins) <= packing.least_bins(sizes, 4096) * 1.02 + 1


def test_crossover_keeps_items():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 4096, 400)
    a, b = packing.first_generation(sizes, 4096, 2, rng)[:2]
    for _ in range(20):
        child = packing.crossover(a, b, sizes, 4096, rng)
        assert (child >= 0).all() and packing.fills(child, sizes).max() <= 4096 and len(np.unique(child)) == child.max() + 1
        a, b = b, child


def test_crossover_beats_best_fit(spark):
    """Lengths of which two or three fill a sequence: islands end with fewer sequences than best fit by decreasing length."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(1000, 2100, 3000)
    plain = np.full(len(sizes), -1, np.int32)
    fitted = packing.best_fit(np.argsort(-sizes, kind="stable").tolist(), sizes, plain, [], 0, 4096)
    population = packing.first_generation(sizes, 4096, packing.POPULATION, rng)
    assert len(population) > 1
    evolved = packing.evolve(population, sizes, 4096, packing.CROSSOVERS, packing.POPULATION, rng)
    assert max(p.max() + 1 for p in evolved[:1]) < min(p.max() + 1 for p in population) <= fitted
    packed = packing.pack(spark.createDataFrame([(int(s),) for s in sizes], "length long"))
    assert packed.select("sequence_id").distinct().count() < fitted


def test_names_of_packing_in_the_input(spark):
    table = spark.createDataFrame([(100 + i, i, "x", "y") for i in range(50)], "length long, _row int, sequence_id string, offset string")
    packed = packing.pack(table)
    assert packed.columns[:4] == table.columns and packed.count() == 50
    assert {tuple(r)[2:4] for r in packed.collect()} == {("x", "y")} and packed.select("_sequence_id").distinct().count() == 2
    assert sorted(r["_row"] for r in packed.collect()) == list(range(50))
