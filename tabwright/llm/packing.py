"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.llm.encoding import word_encoder
from tabwright.llm.texts import spare, text_slices
from tabwright.session import settle

CAPACITY = 4096
BLOCK = 4096  # pieces that one group of islands packs together
ISLANDS = 2
EPOCHS = 2  # with a migration of the elite in between
POPULATION = 4
CROSSOVERS = 12  # per island and epoch
FULL = 0.99  # bins filled less than this are packed again with those of other blocks


def best_fit(items: Iterable[int], lengths: np.ndarray, bins: np.ndarray, room: list[tuple[int, int]], used: int, capacity: int) -> int:
    """Put the items in their order into the open bin with the least sufficient room; `room` holds (room, bin), sorted."""
    for i in items:
        size = int(lengths[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, used
            used += 1
        bins[i] = b
        if left > size:
            insort(room, (left - size, b))
    return used


def decreasing(items: np.ndarray, lengths: np.ndarray) -> list[int]:
    return items[np.argsort(-lengths[items], kind="stable")].tolist()


def renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fills(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths).astype(np.int64)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins that are rather full than alike."""
    f = fills(bins, lengths)
    return -len(f), float(np.mean((f / capacity) ** 2)) if len(f) else 0.0


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    return max(-(-int(lengths.sum()) // capacity), int((lengths * 2 > capacity).sum()))


def crossover(into: np.ndarray, giver: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject well-filled bins of `giver` whole, drop the bins of `into` that share an item with them, and fit the displaced items best."""
    given = fills(giver, lengths)
    well = np.flatnonzero(given >= np.quantile(given, 0.5))
    chosen = np.zeros(len(given), bool)
    chosen[rng.permutation(well)[: max(1, len(well) // 2)]] = True
    moved = chosen[giver]
    hit = np.zeros(int(into.max()) + 1, bool)
    hit[into[moved]] = True
    child = np.where(moved, giver + len(hit), into).astype(np.int64)
    displaced = np.flatnonzero(hit[into] & ~moved)
    child[displaced] = -1
    kept = child >= 0
    child[kept] = renumber(child[kept])
    f = fills(child[kept], lengths[kept])
    room = sorted((capacity - int(v), b) for b, v in enumerate(f) if v < capacity)
    best_fit(decreasing(displaced, lengths), lengths, child, room, len(f), capacity)
    return child.astype(np.int32)


def first_generation(lengths: np.ndarray, capacity: int, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit by decreasing length, then by decreasing length with noise."""
    out = []
    for k in range(size):
        noise = 1 if k == 0 else rng.uniform(0.8, 1.2, len(lengths))
        bins = np.full(len(lengths), -1, np.int32)
        best_fit(np.argsort(-lengths * noise, kind="stable").tolist(), lengths, bins, [], 0, capacity)
        out.append(bins)
        if fitness(bins, lengths, capacity)[0] == -least_bins(lengths, capacity):
            break
    return out


def evolve(population: list[np.ndarray], lengths: np.ndarray, capacity: int, crossovers: int, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Crossovers of ranked parents; a child replaces the worst. Stops at the fewest bins possible. Best first."""
    score = lambda b: fitness(b, lengths, capacity)
    population = sorted(population, key=score, reverse=True)[:size]
    for _ in range(crossovers if len(population) > 1 else 0):
        if score(population[0])[0] == -least_bins(lengths, capacity):
            break
        a, b = sorted(rng.choice(len(population), 2, replace=False))
        child = crossover(population[a], population[b], lengths, capacity, rng)
        population = sorted([*population, child], key=score, reverse=True)[:size]
    return population


def pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, keep: bool = False) -> DataFrame:
    """Ids of each document with its end id, cut only where longer than a sequence: doc_id, piece, start, length, ids_crc32 (and ids)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        for rows, texts in text_slices(batches):
            ids = [np.frombuffer(b + end, encoder.dtype).astype("<u4") for b in encoder.encode(texts)]
            found = [(r, k, s, i[s : s + capacity]) for r, i in enumerate(ids) for k, s in enumerate(range(0, len(i), capacity))]
            columns = [
                rows.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                pa.array([f[1] for f in found], pa.int32()),
                pa.array([f[2] for f in found], pa.int64()),
                pa.array([len(f[3]) for f in found], pa.int64()),
                pa.array([zlib.crc32(f[3].tobytes()) for f in found], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep:
                columns.append(pa.array([f[3].astype(np.int32) for f in found], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _islands(lengths: DataFrame, capacity: int, seed: int) -> DataFrame:
    """Pack the pieces of each block: `row`, `block`, `bin`. Input: row, block, length.

    Every block is one problem of about BLOCK pieces. Its islands are rows of their own, evolved in parallel;
    between epochs the elite of each island moves to the next one. A block's state is a few arrays of BLOCK
    numbers, whatever the size of the corpus.
    """
    problem = lengths.groupBy("block").applyInPandas(
        lambda p: pd.DataFrame({"block": [p.block.iloc[0]], "rows": [p.sort_values("row").row.to_numpy(np.int64).tobytes()], "lengths": [p.sort_values("row").length.to_numpy(np.int32).tobytes()]}),
        "block long, rows binary, lengths binary",
    )
    state = problem.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn("population", F.array().cast("array<binary>"))

    def epoch(number: int):
        def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                grown = []
                for block, island, sizes, population in zip(f.block, f.island, f.lengths, f.population):
                    sizes = np.frombuffer(sizes, np.int32).astype(np.int64)
                    rng = np.random.default_rng([seed, int(block), int(island), number])
                    own = [np.frombuffer(b, np.int32) for b in population] if number else first_generation(sizes, capacity, POPULATION, rng)
                    grown.append([b.tobytes() for b in evolve(own, sizes, capacity, CROSSOVERS, POPULATION, rng)])
                yield f.assign(population=grown)

        return run

    schema = "block long, rows binary, lengths binary, island int, population array<binary>"
    for number in range(EPOCHS):
        if number:  # the elite also goes to the next island of the block
            copies = F.array(
                F.struct("island", "population"),
                F.struct(((F.col("island") + 1) % ISLANDS).alias("island"), F.slice("population", 1, 1).alias("population")),
            )
            state = state.withColumn("c", F.explode(copies)).groupBy("block", F.col("c.island").alias("island"))
            state = state.agg(F.first("rows").alias("rows"), F.first("lengths").alias("lengths"), F.array_distinct(F.flatten(F.collect_list("c.population"))).alias("population"))
            state = state.select("block", "rows", "lengths", "island", "population")
        state = state.mapInPandas(epoch(number), schema)

    def best(p: pd.DataFrame) -> pd.DataFrame:
        sizes = np.frombuffer(p.lengths.iloc[0], np.int32).astype(np.int64)
        found = max((np.frombuffer(b, np.int32) for q in p.sort_values("island").population for b in q), key=lambda b: fitness(b, sizes, capacity))
        full = fills(found, sizes)[found] if len(found) else found
        return pd.DataFrame({"row": np.frombuffer(p.rows.iloc[0], np.int64), "block": p.block.iloc[0], "bin": found.astype(np.int64), "fill": full})

    return state.groupBy("block").applyInPandas(best, "row long, block long, bin long, fill long")


def pack(table: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """Add sequence_id and offset to a table with a `length` column, none longer than `capacity`, in as few sequences as possible.

    Rows are dealt to blocks at random by hash, packed block by block, and the rows of bins that are not nearly
    full are packed once more in blocks of their own, since every block leaves about one partly filled bin.
    Equal lengths and repeated rows are packed like any others; an empty table gives an empty result. Where the table
    has columns of the new names, underscores are put before the new ones.
    """
    row, sequence, offset = (spare(table, c) for c in ("_row", "sequence_id", "offset"))
    table = settle(table.withColumn(row, F.monotonically_increasing_id()))
    rows = table.select(F.col(row).alias("row"), "length")
    count = rows.count()

    def dealt(part: DataFrame, n: int, level: int) -> DataFrame:
        blocks = max(1, math.ceil(n / block))
        return part.select("row", "length", F.pmod(F.xxhash64("row", F.lit(seed + level)), F.lit(blocks)).alias("block"))

    first = settle(_islands(dealt(rows, count, 0), capacity, seed))
    loose = F.col("fill") < int(FULL * capacity)
    again = first.filter(loose).join(rows, "row").select("row", "length")
    second = _islands(dealt(again, first.filter(loose).count(), 1), capacity, seed + 1)
    name = lambda level: (F.col("block") * 2 * (1 << 20) + F.col("bin") * 2 + level).alias(sequence)
    placed = first.filter(~loose).select("row", name(0)).unionByName(second.select("row", name(1)))
    order = W.partitionBy(sequence).orderBy(F.desc("length"), row)
    joined = table.join(placed.withColumnRenamed("row", row), row)
    return joined.withColumn(offset, F.sum("length").over(order) - F.col("length")).drop(row)


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, keep: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone. Only documents longer than a sequence are cut. Ids stay in the
    task that made them unless `keep` asks for them; what is shuffled is one short row per piece.
    """
    return pack(pieces(docs, path, end_id, capacity, keep), capacity)
