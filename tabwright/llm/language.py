"""Language identification by multinomial naive Bayes over hashed character n-grams."""

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.texts import held_out, spare, text_slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
ROW = 4096  # counts shuffled in one row
# Odd multipliers that spread the characters of an n-gram over 32 bits.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text numbers) of the n-grams of each order, in the order of the texts.

    Characters are lowered, all but letters become a space and runs of spaces count once, so n-grams cover words
    and their edges and never reach from one text into the next.
    """
    low = [t.lower() for t in texts]
    flat = np.frombuffer("  ".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) + 2 for t in low])[: len(flat)]
    letter = letters()[flat]
    keep = letter | np.r_[True, letter[:-1]] if len(flat) else letter
    code = np.where(letter, flat, np.uint32(32))[keep]
    owner, solid = owner[keep], letter[keep]
    for n in ORDERS:
        size = len(code) - n + 1
        if size < 1:
            continue
        value = np.full(size, n, np.uint32)
        for j in range(n):
            value = (value ^ code[j : j + size]) * MIX[j]
        whole = solid[:size].copy() if n == 1 else owner[:size] == owner[n - 1 :]
        if n == 3:
            whole &= solid[1 : 1 + size]
        yield (value >> np.uint32(16)).astype(np.int32)[whole], owner[:size][whole]


def train(docs: DataFrame, alpha: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages in order and the matrix of log-probabilities, buckets x languages, from the docs' text and lang.

    Counts cover every row with a lang. Each task adds up its own counts and shuffles them as short arrays, so a
    language with most of the rows is no hot group; what comes to the driver is one number per bucket and language.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for rows, texts in text_slices(batches):
            langs = rows.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            sums = np.zeros(len(names) * BUCKETS, np.int64)
            for bucket, owner in ngrams(texts):
                sums += np.bincount(number[owner] * BUCKETS + bucket, minlength=len(sums))
            for name, part in zip(names, sums.reshape(len(names), BUCKETS)):
                totals[name] = totals.get(name, 0) + part
        for name, part in totals.items():
            found = part.reshape(-1, ROW)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(found), "part": list(range(len(found))), "counts": [f.tobytes() for f in found]}, schema=pa.schema([("lang", pa.string()), ("part", pa.int32()), ("counts", pa.binary())]))

    def add(frame):
        import pandas as pd

        total = sum(np.frombuffer(c, np.int64) for c in frame.counts)
        return pd.DataFrame({"lang": [frame.lang.iloc[0]], "part": [frame.part.iloc[0]], "counts": [total.tobytes()]})

    known = docs.filter(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")
    sums = known.mapInArrow(count, "lang string, part int, counts binary").groupBy("lang", "part").applyInPandas(add, "lang string, part int, counts binary")
    rows = sums.collect()
    names = sorted({r["lang"] for r in rows})
    totals = np.zeros((len(names), BUCKETS))
    for r in rows:
        totals[names.index(r["lang"]), r["part"] * ROW : (r["part"] + 1) * ROW] = np.frombuffer(r["counts"], np.int64)
    smooth = totals + alpha
    return names, np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)


def posteriors(texts: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages, whether a text has a letter): every language's share under equal priors."""
    score = np.zeros((len(texts), matrix.shape[1]))
    lettered = np.zeros(len(texts), bool)
    for bucket, owner in ngrams(texts):
        lettered[owner] = True
        if len(owner):
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for j in range(matrix.shape[1]):
                score[owner[start], j] += np.add.reduceat(matrix[:, j][bucket], start, dtype=np.float64)
    if matrix.shape[1]:
        score = np.exp(score - score.max(axis=1, keepdims=True))
        score /= score.sum(axis=1, keepdims=True)
    return score, lettered


def predict(docs: DataFrame, names: list[str], matrix: np.ndarray) -> DataFrame:
    """Append lang_pred and score (with more underscores where such columns exist) to every row; the model is broadcast, its size is BUCKETS numbers per language."""
    model = docs.sparkSession.sparkContext.broadcast((names, matrix))
    lang_name, score_name = spare(docs, "lang_pred"), spare(docs, "score")
    fields = T.StructType([*docs.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = model.value
        for rows, texts in text_slices(batches):
            share, lettered = posteriors(texts, logs)
            best = share.argmax(axis=1) if known else np.zeros(len(texts), int)
            found = lettered & bool(known)
            lang = [known[b] if f else "und" for b, f in zip(best, found)]
            top = np.where(found, share[np.arange(len(best)), best], 0.0) if known else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(lang, pa.string()), pa.array(top, pa.float64())], [*rows.schema.names, lang_name, score_name])

    return docs.mapInArrow(score, fields)


def identify(docs: DataFrame) -> DataFrame:
    """Predicted language of every whole text: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from text and lang of the rows that are not held out and predicts from text alone. A null text, or one
    without a letter, is "und" with score 0, and so is every text when there is nothing to learn from. A text in
    several languages gets the one with the largest share of evidence, ties go to the first name. Repeated rows
    are learned and returned as often as they occur.
    """
    names, matrix = train(docs.filter(~held_out(F.col("doc_id"))))
    plain = docs.select("doc_id", "text")
    return predict(plain, names, matrix).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accept(docs: DataFrame, floor: float = 0.5) -> DataFrame:
    """The rows whose language is found with a score of `floor` or more; a missing lang is filled in.

    Columns stay as they are. The learned languages come from all rows with a lang.
    """
    names, matrix = train(docs)
    lang, score = F.col(spare(docs, "lang_pred")), F.col(spare(docs, "score"))
    found = predict(docs, names, matrix).filter((lang != "und") & (score >= floor))
    return found.withColumn("lang", F.coalesce(F.col("lang"), lang)).select(*docs.columns)
