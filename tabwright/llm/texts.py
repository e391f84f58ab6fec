"""Helpers the operators share: bounded slices of text from Arrow batches, and memo tables of text chunks."""

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4_000_000  # text handled at once inside a task
MEMO_ENTRIES = 1_200_000  # chunks a Python worker remembers before it starts anew
# White space that may reach over a space: only there do the two ways to cut a text differ.
_RUN = re.compile(r"\s (?:\s|\Z)")


def text_slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut record batches into runs of rows with about `limit` bytes of text; a null text is an empty one."""
    for batch in batches:
        sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0).to_numpy(zero_copy_only=False)
        if not len(sizes):
            continue
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            rows = batch.slice(a, b - a)
            yield rows, [t or "" for t in rows.column(column).to_pylist()]


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def spare(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it as long as the frame has such a column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def least_rows(table: DataFrame, order: Column, rows: int, *ties: str) -> DataFrame:
    """The `rows` rows of a settled table that come first by `order`, a 64-bit hash, then by `ties`.

    Counts of the hash's leading bits tell which rows can be among them, so that tasks do not each send `rows` rows.
    """
    lead = F.shiftright(order, 52)  # 4,096 ranges
    seen, last = 0, None
    for r in sorted(table.groupBy(lead.alias("lead")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["lead"]):
        if seen < rows:
            seen, last = seen + r["n"], r["lead"]
    return table.filter(lead <= F.lit(last)).orderBy(order, *ties).limit(rows)


def documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def learn(table: dict, parts: list[list[str]], solve: Callable[[list[str]], Iterable]) -> None:
    """Add the keys that occur in `parts` and are not in the table yet."""
    new = [*set().union(*parts).difference(table)]
    if new:
        table.update(zip(new, solve(new)))


class ChunkTable:
    """Results per distinct chunk of text, for encoders that treat the chunks of a text independently.

    `solve` gets the chunks not seen before, all together. A chunk is what follows one space, with that space
    (`spaced`), the part of a text before its first space, or, where white space runs on over a space, a
    pre-token of `pattern` (`plain`). The tables are a memo: when full they are emptied and filled again.
    """

    def __init__(self, solve: Callable[[list[str]], list], pattern, limit: int = MEMO_ENTRIES):
        self.solve, self.pattern, self.limit = solve, pattern, limit
        self.spaced: dict[str, object] = {}
        self.plain: dict[str, object] = {}

    def split(self, text: str) -> tuple[list[str], list[str]]:
        """(chunks as they stand, chunks less their leading space), the former first in the text."""
        if _RUN.search(text):
            return self.pattern.findall(text), []
        first, *rest = text.split(" ")
        return [first] if first else [], rest

    def lookup(self, texts: list[str]) -> Iterator[Iterable]:
        """For each text its chunks' results in order."""
        if len(self.spaced) + len(self.plain) > self.limit:
            self.spaced.clear()
            self.plain.clear()
        parts = [self.split(t) for t in texts]
        for table, side, lead in ((self.plain, 0, ""), (self.spaced, 1, " ")):
            learn(table, [p[side] for p in parts], lambda new: self.solve([lead + c for c in new]))
        plain, spaced = self.plain.__getitem__, self.spaced.__getitem__
        for head, rest in parts:
            yield [*map(plain, head), *map(spaced, rest)] if head else map(spaced, rest)
