"""Approximate nearest neighbours by a hash-prefix forest."""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.session import settle

TREES = 24
BITS = 64  # length of a hash string
SHARD = 16_384  # vectors in one forest
QUERY_BLOCK = 512  # queries matched against a forest at once
PILOT = 96  # queries whose true neighbours are found to measure recall
RECALL = 0.97  # share of the pilot's true neighbours that the search must reach


def planes(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((trees * BITS, dim))


def hash_strings(x: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """One string of BITS signs per tree and row, as unsigned integers that sort like the strings."""
    signs = (x @ planes(x.shape[1], trees, seed).T) >= 0
    return np.packbits(signs.reshape(len(x), trees, BITS), axis=2).view(">u8").reshape(len(x), trees).astype(np.uint64)


class Forest:
    """Sorted arrays of hash strings, one per tree, over the vectors of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, trees: int = TREES, seed: int = 5):
        self.ids, self.x, self.trees, self.seed = ids, x, trees, seed
        self.norm = np.sqrt((x * x).sum(axis=1))
        codes = hash_strings(x, trees, seed)
        self.rows = [np.argsort(codes[:, t], kind="stable") for t in range(trees)]
        self.sorted = [codes[r, t] for t, r in enumerate(self.rows)]
        self.codes = codes

    def ranges(self, codes: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, the run of the sorted array that shares a prefix of `depth` bits."""
        rest = np.where(depth == 0, np.uint64(2**64 - 1), (np.uint64(1) << (np.uint64(BITS) - np.maximum(depth, 1).astype(np.uint64))) - np.uint64(1))
        low = np.empty(codes.shape, np.int64)
        high = np.empty(codes.shape, np.int64)
        for t in range(self.trees):
            low[:, t] = np.searchsorted(self.sorted[t], codes[:, t] & ~rest, "left")
            high[:, t] = np.searchsorted(self.sorted[t], codes[:, t] | rest, "right")
        return low, high

    def depths(self, codes: np.ndarray, wanted: int) -> np.ndarray:
        """The longest common prefix length at which all trees together offer `wanted` candidates.

        Descending to the longest match of each tree and ascending all trees in step ends at this depth; as the
        offer only grows on the way up, it is found by halving.
        """
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), BITS)
        while (low < high).any():
            middle = (low + high + 1) // 2
            a, b = self.ranges(codes, middle)
            enough = (b - a).sum(axis=1) >= wanted
            low, high = np.where(enough, middle, low), np.where(enough, high, middle - 1)
        return low

    def offered(self, low: np.ndarray, high: np.ndarray, query_id: int) -> np.ndarray:
        """Distinct rows in the runs of all trees, less those of the query's own id."""
        found = np.zeros(len(self.ids), bool)
        for t in range(self.trees):
            found[self.rows[t][low[t] : high[t]]] = True
        return np.flatnonzero(found & (self.ids != query_id))

    def search(self, query_ids: np.ndarray, q: np.ndarray, wanted: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The k best of each query's candidates by exact cosine: (rows of the shard, scores)."""
        codes = hash_strings(q, self.trees, self.seed)
        depth = self.depths(codes, wanted)
        low, high = self.ranges(codes, depth)
        norm = np.sqrt((q * q).sum(axis=1))
        for i in range(len(q)):
            rows = self.offered(low[i], high[i], query_ids[i])
            while len(rows) < k and depth[i]:  # offers repeat over trees and hold the query itself: ascend until k others are found
                depth[i] -= 1
                a, b = self.ranges(codes[i : i + 1], depth[i : i + 1])
                rows = self.offered(a[0], b[0], query_ids[i])
            if len(rows) > k:  # a first look by one product, then the same sum for every row near the k-th
                rough = (self.x[rows] @ q[i]) / (self.norm[rows] * norm[i])
                rows = rows[rough >= np.partition(rough, -k)[-k] - 1e-9]
            score = (self.x[rows] * q[i]).sum(axis=1) / (self.norm[rows] * norm[i])
            best = np.lexsort((self.ids[rows], -score))[:k]
            yield rows[best], score[best]

    def needed(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The number of wanted candidates from which on the search for one query reaches the given rows."""
        codes = hash_strings(query[None, :], self.trees, self.seed)
        differ = codes ^ self.codes[rows]
        shared = np.where(differ == 0, BITS, BITS - 1 - np.floor(np.log2(np.maximum(differ, 1).astype(np.float64))).astype(np.int64))
        depth = np.minimum(shared.max(axis=1) + 1, BITS)
        low, high = self.ranges(np.repeat(codes, len(rows), 0), depth)
        return np.where(shared.max(axis=1) >= BITS, 0, (high - low).sum(axis=1)) + 1


def usable(vectors: DataFrame, vec: str = "embedding") -> Column:
    """True for vectors that are neither null, empty nor zero and hold only finite numbers."""
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda v: v != 0), F.lit(False))


def _pack(df: DataFrame, block: str, n: int, salt: int) -> DataFrame:
    """Rows dealt to n blocks by hash, each block one row: ids and the matrix as binary, by dimension."""

    def join(p):
        import pandas as pd

        p = p.sort_values("id")
        data = np.stack(p.v.to_numpy()).astype("<f8")
        return pd.DataFrame({block: [p[block].iloc[0]], "dim": [p.dim.iloc[0]], "ids": [p.id.to_numpy("<i8").tobytes()], "data": [data.tobytes()]})

    dealt = df.select(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int").alias(block), F.size("v").alias("dim"), "id", "v")
    return dealt.groupBy(block, "dim").applyInPandas(join, f"{block} int, dim int, ids binary, data binary")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, shard: int = SHARD, recall: float = RECALL, seed: int = 5) -> DataFrame:
    """Each query's k nearest other vectors by cosine, as the forest finds them: query_id, rank, vec_id, score.

    Input: vec_id and embedding; rows for which `is_query` holds are the queries. Every usable vector is indexed:
    the rows are dealt to shards of about `shard` vectors and each shard builds its forest; blocks of queries meet
    every shard, and a query's best k per shard are merged. Per query and shard the trees are ascended in step
    until enough candidates are on offer. How many are enough is measured: a pilot of at most PILOT queries (those
    with the smallest hash) is matched exactly against all rows, and the number is the smallest with which the
    search reaches `recall` of their true neighbours; a query ascends further until a shard offers it k other rows, or all
    it has, so copies and repeated offers never leave it without neighbours. Scores are double-precision cosines of the original vectors;
    ties go to the smaller vec_id; a query with fewer than k other vectors gets all of them. Vectors that are null,
    empty, zero or not finite take no part; vectors of another dimension than the query's are no candidates.
    vec_ids are taken as unique; of rows with the same vec_id none is a candidate for another.
    """
    good = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("q"))
    good = good.filter(F.col("id").isNotNull() & usable(good, "v"))
    sizes = good.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("q")).first()
    n_shards = max(1, math.ceil(sizes["n"] / shard))
    shards = settle(_pack(good, "shard", n_shards, seed))
    queries = good.filter("q")
    merge = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def met(block_count: int, asking: DataFrame, salt: int, wanted: int) -> DataFrame:
        """Blocks of queries against all shards, `k` rows per query and shard.

        A cell is a shard and a run of blocks; a run has about as many queries as a shard has vectors, or fewer where
        tasks would be left without a cell. Both sides go to the task of their cell in one exchange: no join, whose
        broadcast would send every block through the driver once per shard. A cell's forest is built once.
        """

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            built: tuple = (None, None)
            for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                dim = row["dim"]
                ids, x = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["data"], "<f8").reshape(-1, dim)
                if row["block"] < 0:  # the shard comes first
                    built = ((row["cell"], dim), Forest(ids, x, trees, seed))
                elif built[0] == (row["cell"], dim):  # else the shard has no vector of this dimension
                    forest = built[1]
                    out = {"query_id": [], "vec_id": [], "score": [], "needed": []}
                    for i, (rows, score) in enumerate(forest.search(ids, x, wanted, k)):
                        out["query_id"] += [int(ids[i])] * len(rows)
                        out["vec_id"] += forest.ids[rows].tolist()
                        out["score"] += score.tolist()
                        out["needed"] += forest.needed(x[i], rows).tolist() if wanted >= 1 << 60 else [0] * len(rows)
                    yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("needed", pa.int64())]))

        tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        runs = min(block_count, max(math.ceil(block_count * QUERY_BLOCK / shard), math.ceil(tasks / n_shards)))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        held = shards.select("shard", each(runs).alias("run"), "dim", F.lit(-1).alias("block"), "ids", "data")
        asked = _pack(asking, "block", block_count, salt).select(each(n_shards).alias("shard"), (F.col("block") % runs).alias("run"), "dim", "block", "ids", "data")
        cells = held.unionByName(asked).select((F.col("shard") * runs + F.col("run")).alias("cell"), "dim", "block", "ids", "data")
        n = min(tasks, n_shards * runs)
        cells = cells.repartitionById(n, (F.col("cell") % n).cast("int")).sortWithinPartitions("cell", "dim", "block")
        return cells.mapInArrow(run, "query_id long, vec_id long, score double, needed long")

    pilot = queries.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(PILOT)
    truth = met(1, pilot, seed, 1 << 60).withColumn("rank", F.row_number().over(merge)).filter(F.col("rank") <= k)
    need = sorted(r["needed"] for r in truth.select("needed").collect())  # at most PILOT * k numbers
    wanted = need[min(len(need) - 1, math.ceil(recall * len(need)))] if need else 1

    found = met(max(1, math.ceil(sizes["q"] / QUERY_BLOCK)), queries, seed + 1, max(wanted, k + 1)).withColumn("rank", F.row_number().over(merge)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
