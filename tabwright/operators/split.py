"""Train and test splits as columns or long tables; rows are never listed on the driver."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.hashing import hash_hex, hash_long
from tabwright.functions.ranks import hash_cuts, hashed_index, with_cut_code
from tabwright.session import settle

# The training shares of a learning curve.
LEARNING_SHARES = (0.05, 0.0625, 0.075, 0.0875, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0)


def chunk_counts(n: Column, k: int) -> list[Column]:
    """Running row counts at the ends of k chunks of n rows, the first `n mod k` chunks one row longer."""
    whole = ((n - n % k) / k).cast("long")
    return [(i + 1) * whole + F.least(F.lit(i + 1), n % k) for i in range(k - 1)]


def with_chunks(df: DataFrame, key: str, k: int, seed: int, by: str | None = None, name: str = "chunk") -> DataFrame:
    """Add the random chunk 0..k-1 of each row, inside each `by` group; a narrow step after passes that count hashes of the key."""
    cuts = hash_cuts(df, key, seed, lambda n: chunk_counts(n, k), by)
    return with_cut_code(df, key, seed, cuts, name)


def separate_split(df: DataFrame, split: int, k: int, fold: str = "fold", chunk: str = "chunk") -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one split: train rows outside the chunk, test rows inside it.

    Training rows come only from the train fold and test rows only from the test fold.
    """
    train = F.col(fold) == "train"
    if k > 1:
        train = train & (F.col(chunk) != split)
    return df.filter(train), df.filter((F.col(fold) == "test") & (F.col(chunk) == split))


def separate_split_table(df: DataFrame, key: str, k: int, seed: int = 42, fold: str = "fold") -> DataFrame:
    """All splits in long form: (split, role, key)."""
    rows = with_chunks(df.filter(F.col(fold).isin("train", "test")).select(key, fold), key, k, seed, by=fold)
    split = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    other = F.col("chunk") != F.col("split") if k > 1 else F.lit(True)
    member = F.when(F.col(fold) == "test", F.col("chunk") == F.col("split")).otherwise(other)
    return rows.withColumn("split", split).filter(member).select("split", F.col(fold).alias("role"), key)


def bootstrap_table(df: DataFrame, key: str, k: int, seed: int = 42, fold: str = "fold") -> DataFrame:
    """k bootstrap splits: as many draws with replacement as the fold has rows. (split, role, key, multiplicity)

    Every row stands for one draw and picks its row by hash, so the draws need no generated table.
    """
    rows = df.filter(F.col(fold).isin("train", "test")).select(key, fold)
    indexed = settle(hashed_index(rows, key, seed, by=[fold], size="_total"))
    draws = indexed.select(fold, F.col("idx").alias("_draw"), "_total", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_rep"))
    draws = draws.withColumn("_seed", F.col("_rep") * seed)
    pick = hash_long(hash_hex(["_draw", "_seed"], "draw")) % F.col("_total")
    drawn = draws.select(fold, (F.col("_rep") - 1).alias("split"), pick.alias("idx"))
    drawn = drawn.groupBy(fold, "split", "idx").agg(F.count(F.lit(1)).alias("multiplicity"))
    return drawn.join(indexed.select(fold, "idx", key), [fold, "idx"]).select(
        "split", F.col(fold).alias("role"), key, "multiplicity"
    )


def k_fold(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a disjoint random fold 0..k-1; usable as `foldCol` of a CrossValidator."""
    return with_chunks(df, key, k, seed, name=name)


def repeated_k_fold(df: DataFrame, key: str, k: int = 5, n_rep: int = 10, seed: int = 42) -> DataFrame:
    """Fold 1..k of every row in every repetition: (rep, fold, key)."""
    reps = df.select(key, F.explode(F.sequence(F.lit(1), F.lit(n_rep))).alias("rep"))
    cuts = hash_cuts(reps, [key, "rep"], seed, lambda n: chunk_counts(n, k), "rep")
    coded = with_cut_code(reps, [key, "rep"], seed, cuts, "fold")
    return coded.select("rep", (F.col("fold") + 1).alias("fold"), key)


def shuffle_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 999, name: str = "role") -> DataFrame:
    """Add `role`: a random test share rounded up, the rest train."""
    cuts = hash_cuts(df, key, seed, lambda n: [F.ceil(F.lit(test_size) * n)])
    coded = with_cut_code(df, key, seed, cuts, name)
    return coded.withColumn(name, F.when(F.col(name) == 0, "test").otherwise("train"))


def learning_subsets(df: DataFrame, key: str, seed: int = 42, shares: Sequence[float] = LEARNING_SHARES) -> DataFrame:
    """Add `step`, the first share whose nested prefix holds the row: subset s is `step <= s`."""
    cuts = hash_cuts(df, key, seed, lambda n: [F.floor(F.lit(s) * n) for s in shares])
    return with_cut_code(df, key, seed, cuts, "step").filter(F.col("step") < len(shares))
