"""Spelling variants: words one edit apart, found in a bit-sliced position index, and the frequent form each leads to."""

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.texts import text_slices
from tabwright.session import settle

LEAST = 7  # code points of the shortest word
BLOCK = 1_024  # words from which on an index is full; it ends at the next border of buckets
BUCKET = 2_048  # words of a bucket that is not split further
HELD_WORDS = 100_000  # distinct words a task counts before it hands them on
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def dealt_word(doc_id, run: str) -> str:
    """The word a run of letters stands for: A-Z in lower case; one letter goes if 31 divides the checksum of document and run."""
    word = run.translate(_ASCII_LOWER)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % 31 else word[: h % len(word)] + word[h % len(word) + 1 :]


def vocabulary(docs: DataFrame, least: int = LEAST, occurrences: int = 2) -> DataFrame:
    """(word, n) of the words with at least `least` code points and so many occurrences in `text` of all documents.

    A null text has none; a null doc_id counts as an empty one. Tasks add up words before the shuffle.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")  # shorter runs give shorter words only

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for rows, texts in text_slices(batches):
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts):
                for run, n in Counter(runs.findall(text)).items():
                    counts[dealt_word(doc_id, run)] += n
            if len(counts) > HELD_WORDS:
                yield emit(counts)
                counts = Counter()
        yield emit(counts)

    found = docs.select("doc_id", "text").mapInArrow(count, "word string, n long").filter(F.length("word") >= least)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


# --- buckets ---------------------------------------------------------------------------------------------
#
# Two near words, the shorter of c letters, have c - 1 letters before and behind the edit in common at least, so
# they share their first or their last c // 2 letters. A bucket holds the words of c or c + 1 letters that share
# these; the same holds for the letters between the shared ones, by which a bucket is split in two ways again.
# `path` lists the ways taken. A pair is counted on one path only: the second way asks that the first fails.


def _bucket(path: Column, c: Column, p: Column, s: Column) -> Column:
    ends = F.substr("word", F.lit(1), p), F.right(F.col("word"), s)
    return F.struct(c.alias("c"), path.alias("path"), p.alias("p"), s.alias("s"), F.xxhash64(path, c, *ends).alias("bucket"))


def _split(entries: DataFrame) -> DataFrame:
    """Both ways to extend the letters that the words of a bucket share."""
    half = F.floor((F.col("c") - F.col("p") - F.col("s")) / 2).cast("int")
    left = _bucket(F.concat("path", F.lit("0")), F.col("c"), F.col("p") + half, F.col("s"))
    right = _bucket(F.concat("path", F.lit("1")), F.col("c"), F.col("p"), F.col("s") + half)
    return entries.select("word", "n", F.inline(F.array(left, right)))


def bucket_entries(words: DataFrame, least: int = LEAST, limit: int = BUCKET) -> DataFrame:
    """(word, n, c, path, p, s, bucket): each word in all its buckets; those over `limit` words are split as far as it goes.

    A bucket that cannot be split has one free letter or two, and so no more words than there are pairs of letters.
    """
    none = F.lit(0)
    classes = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda c: c >= least)
    whole = words.select("word", "n", F.explode(classes).alias("c")).select("*", F.lit("").alias("path"), none.alias("p"), none.alias("s"))
    open_, done, key = _split(whole), [], ["c", "path", "bucket"]
    while True:
        sizes = open_.filter(F.col("c") - F.col("p") - F.col("s") >= 2).groupBy(*key).agg(F.count(F.lit(1)).alias("_size"))
        large = settle(sizes.filter(F.col("_size") > limit))
        if large.isEmpty():
            break
        open_ = open_.join(large, key, "left")
        done.append(open_.filter(F.col("_size").isNull()).drop("_size"))
        open_ = _split(open_.filter(F.col("_size").isNotNull()))
    for part in done:
        open_ = open_.unionByName(part)
    return open_


# --- the index -------------------------------------------------------------------------------------------


class PositionIndex:
    """Bitsets over the words of one class and path: for each position and letter the words that have it there.

    Words are numbered by falling n, ties in code-point order, so the first word of a set is its most frequent one.
    """

    def __init__(self, words: list[str], n: np.ndarray, buckets: np.ndarray, c: int, path: str):
        order = np.lexsort((np.array(words), -n))
        self.words, self.n, self.c, self.path = [words[i] for i in order], n[order], c, path
        self.letters = np.array(self.words, dtype=f"U{c + 1}").view(np.uint32).reshape(len(words), c + 1)
        self.lengths = np.where(self.letters[:, c] == 0, c, c + 1)
        self.alphabet = np.unique(self.letters)
        self.slots = np.searchsorted(self.alphabet, self.letters)
        self.groups, self.group = np.unique(buckets[order], return_inverse=True)

    def pack(self, flags: np.ndarray) -> np.ndarray:
        """Rows of flags, one per word, as rows of 64-bit words."""
        whole = np.zeros((len(flags), -(-flags.shape[1] // 64) * 64), bool)
        whole[:, : flags.shape[1]] = flags
        return np.packbits(whole, axis=1, bitorder="little").view("<u8")

    def at(self, position: int) -> np.ndarray:
        """For each letter of the alphabet the set of words that have it at a position."""
        if not 0 <= position <= self.c:
            return np.zeros((len(self.alphabet), -(-len(self.words) // 64)), np.uint64)
        return self.pack(self.slots[:, position] == np.arange(len(self.alphabet))[:, None])

    def near(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """The words of m letters and for each the set of its near words in its own bucket and class.

        The letters of all these words are read in step. `equal` holds the words without an error so far; of those
        with one error, `replaced` read the same position, `longer` the next one and `shorter` the one before.
        """
        rows = np.flatnonzero(self.lengths == m)
        same = self.pack(self.group == np.arange(len(self.groups))[:, None])[self.group[rows]]
        equal = same.copy()
        replaced, longer, shorter = (np.zeros_like(same) for _ in range(3))
        free: list[tuple[int, int]] = []  # letters in which the words of a pair must differ
        p = s = 0
        for way in self.path:
            half = (self.c - p - s) // 2
            if way == "1":
                free.append((p, p + half))
                s += half
            else:
                p += half
        shared = [same.copy() for _ in free]
        before, here, after = self.at(-1), self.at(0), self.at(1)
        for i in range(m):
            letter = self.slots[rows, i]
            hit = here[letter]
            for k, (a, b) in enumerate(free):
                if a <= i < b:
                    shared[k] &= hit
            if m == self.c:
                replaced = (replaced & hit) | (equal & ~hit)
                longer = (longer | equal) & after[letter]
            else:
                shorter = (shorter & before[letter]) | equal
            equal &= hit
            before, here, after = here, after, self.at(i + 2)
        sizes = self.pack(self.lengths == np.array([[self.c], [self.c + 1]]))
        found = (replaced & sizes[0]) | ((longer | equal) & sizes[1]) if m == self.c else shorter & sizes[0]
        for words in shared:
            found &= ~words
        return rows, found

    def best(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(words with near words, their number, the first of them), by word number."""
        for m in (self.c, self.c + 1):
            rows, found = self.near(m)
            count = np.bitwise_count(found).sum(axis=1).astype(np.int64)
            rows, found, count = rows[count > 0], found[count > 0], count[count > 0]
            at = (found != 0).argmax(axis=1)
            low = np.take_along_axis(found, at[:, None], 1)[:, 0]
            low &= ~low + np.uint64(1)
            yield rows, count, at * 64 + np.log2(low.astype(np.float64)).astype(np.int64)


def _index_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries, indexed in blocks that end where a bucket does and hold one class and path."""
    held: list[tuple] = []

    def solve() -> pa.RecordBatch:
        index = PositionIndex([e[0] for e in held], np.array([e[1] for e in held]), np.array([e[4] for e in held]), held[0][2], held[0][3])
        out: dict[str, list] = {"word": [], "n": [], "n_near": [], "form": [], "form_n": []}
        for rows, count, first in index.best():
            out["word"] += [index.words[r] for r in rows]
            out["n"] += index.n[rows].tolist()
            out["n_near"] += count.tolist()
            out["form"] += [index.words[r] for r in first]
            out["form_n"] += index.n[first].tolist()
        text, number = pa.string(), pa.int64()
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([("word", text), ("n", number), ("n_near", number), ("form", text), ("form_n", number)]))

    for batch in batches:
        for entry in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "c", "path", "bucket"))):
            if held and (entry[2:4] != held[0][2:4] or (len(held) >= BLOCK and entry[4] != held[-1][4])):
                yield solve()
                held = []
            held.append(entry)
    if held:
        yield solve()


def near_words(words: DataFrame, least: int = LEAST, limit: int = BUCKET) -> DataFrame:
    """(word, n, n_near, form, form_n): the number of words one edit away, and the most frequent of them (null if none).

    `words` is unique on word and settled. Each task indexes runs of whole buckets and sends one row per word and
    bucket, whatever the number of pairs.
    """
    entries = bucket_entries(words, least, limit)
    order = ["c", "path", "bucket"]
    dealt = entries.select("word", "n", *order).repartitionByRange(*order).sortWithinPartitions(*order)
    found = dealt.mapInArrow(_index_blocks, "word string, n long, n_near long, form string, form_n long")
    blank = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("long").alias("form_n"))
    first = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("word"))))
    merged = found.unionByName(blank).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("_first"))
    return merged.select("word", "n", "n_near", F.col("_first.word").alias("form"), (-F.col("_first.n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word along its forms to the last. A form is more frequent than its word, so paths end."""
    ahead = settle(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = settle(ahead.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        ahead = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return ahead


def spelling_variants(docs: DataFrame, least: int = LEAST, occurrences: int = 2, ratio: int = 10, limit: int = BUCKET) -> DataFrame:
    """The words of all documents with their near words, form and root: word, form, root, n, n_near, form_n.

    Input: doc_id and text; other columns are ignored. Words are near if one inserted, deleted or replaced code point
    makes them equal. The form of a word is its most frequent near word (ties: the first in code-point order), if that
    occurs `ratio` times as often at least, else null; `form_n` is its count. The root ends the chain of forms, or is
    the word itself. Null and empty texts give no words, repeated rows count again, an empty table gives no rows; a
    word as long as a whole text is a word like others.
    """
    words = settle(vocabulary(docs, least, occurrences))
    near = near_words(words, least, limit)
    holds = F.col("form_n") >= ratio * F.col("n")
    forms = settle(near.select("word", "n", "n_near", F.when(holds, F.col("form")).alias("form"), F.when(holds, F.col("form_n")).alias("form_n")))
    out = forms.join(roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
