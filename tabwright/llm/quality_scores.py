"""Quality scores by Bradley-Terry pairwise ranking."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.texts import held_out, least_rows, text_slices
from tabwright.session import settle

TRAIN_ROWS = 20_000  # labelled documents that the ranking is fitted on
PAIRS_EACH = 8  # preference pairs per document of the rarer label
THRESHOLD = 0.3
FEATURES = (
    "length line_length word_length letters capitals digits blanks stops bars bangs symbols distinct repeats top_word dup_lines title_words".split()
)


def features(text: str) -> list[float]:
    """Statistics of one whole text; an empty one has zeros."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    lines = [x for x in text.split("\n") if x.strip()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    letters = sum(map(len, words))
    count = text.count
    bars, bangs = count("|"), count("!")
    symbols = sum(map(count, "#*$%&<>~^_={}[]"))
    stops = count(".") + count(",") + count(";") + count(":") + count("?")
    upper = sum(map(str.isupper, words))
    digits = sum(map(count, "0123456789"))
    marks = bars + bangs + symbols + stops + digits
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        np.log1p(len(words)),
        np.log1p(len(words) / len(lines)),
        letters / len(words),
        (letters - marks) / n,
        upper / len(words),
        digits / n,
        count(" ") / n,
        stops / len(words),
        bars / len(words),
        bangs / len(words),
        symbols / len(words),
        len(counts) / len(words),
        same / len(words),
        max(counts.values()) / len(words),
        1 - len(set(lines)) / len(lines),
        sum(map(str.istitle, words)) / len(words),
    ]


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the feature array of every whole text, in one pass."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            values = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), values], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, x array<double>")


def expanded(x: np.ndarray, centre: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Standardised features, bounded at six widths, and their sizes, so that both tails can count against a text."""
    z = np.clip((x - centre) / width, -6, 6)
    return np.hstack([z, np.abs(z)])


class Ranking:
    """Bradley-Terry scores: the odds that one document is preferred to another are exp(score - score)."""

    def __init__(self, x: np.ndarray, label: np.ndarray, penalty: float = 1e-3, seed: int = 3):
        some = len(x) > 0
        self.centre = x.mean(axis=0) if some else np.zeros(x.shape[1])
        self.width = (x.std(axis=0) if some else np.ones(x.shape[1])) + 1e-6
        z = expanded(x, self.centre, self.width)
        self.weights = np.zeros(z.shape[1])
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        if len(good) and len(bad):
            rng = np.random.default_rng(seed)
            n = PAIRS_EACH * min(len(good), len(bad))
            pairs = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
            for _ in range(25):  # Newton steps on the logistic loss of the differences
                p = 1 / (1 + np.exp(-np.clip(pairs @ self.weights, -30, 30)))
                gradient = pairs.T @ (p - 1) / n + penalty * self.weights
                curve = (pairs * (p * (1 - p))[:, None]).T @ pairs / n + penalty * np.eye(len(self.weights))
                step = np.linalg.solve(curve, gradient)
                self.weights -= step
                if np.abs(step).max() < 1e-6:
                    break
        share = len(bad) / len(label) if len(label) else 0.0
        self.cut = float(np.quantile(z @ self.weights, share)) if len(label) else 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; THRESHOLD at the quantile of the training scores that the share of label 0 marks."""
        s = expanded(x, self.centre, self.width) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(s + np.log(THRESHOLD / (1 - THRESHOLD)), -60, 60)))


def fit(table: DataFrame, rows: int = TRAIN_ROWS) -> Ranking:
    """Fit on at most `rows` rows (x, quality), those with the smallest hash of doc_id."""
    sample = least_rows(table, F.xxhash64(F.col("doc_id").cast("string")), rows, "doc_id").select("x", "quality").collect()
    x = np.array([r["x"] for r in sample], float).reshape(-1, len(FEATURES))
    return Ranking(x, np.array([r["quality"] for r in sample]))


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Quality of every whole text: doc_id, held_out, score, predicted.

    Preference pairs are drawn between documents of label 1 and 0 among at most `rows` labelled documents that are
    not held out. Labels that are null, or contradict each other for one doc_id, are not learned; without labels, or
    with labels of one kind only, every score is THRESHOLD. A null or empty text has zeros for features and is scored like any other.
    Repeated rows are returned as often as they occur.
    """
    table = settle(described(docs))
    clear = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
    clear = clear.filter(F.col("quality") == F.col("_other")).drop("_other")
    ranking = docs.sparkSession.sparkContext.broadcast(fit(table.filter(~held_out(F.col("doc_id"))).join(clear, "doc_id"), rows))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = ranking.value.score(x)
            s = np.where(np.abs(s - THRESHOLD) < 1e-12, THRESHOLD, s)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = table.mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
