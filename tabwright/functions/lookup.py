"""Join a keyed table onto rows: broadcast by measured bytes, else shuffled with the heavy keys of the rows spread."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import settle

BROADCAST_BYTES = 64_000_000  # a settled table of at most this size is sent to every executor
HEAVY_KEYS = 256  # heavy keys looked for; TRACKED counters bound the error of a count to rows / TRACKED
TRACKED = 8192


def broadcast_if_light(table: DataFrame) -> DataFrame:
    """A settled table, marked for broadcasting if its values take at most BROADCAST_BYTES as text."""
    width = sum([F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in table.columns], F.lit(0))
    taken = table.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(table) if taken <= BROADCAST_BYTES else table


def heavy_keys(df: DataFrame, key: Column, parts: int) -> list[int]:
    """Hashes of the keys of `df` that hold more than half a part of its rows, from one mergeable sketch of bounded size."""
    sketch = F.call_function("approx_top_k", key, F.lit(HEAVY_KEYS), F.lit(TRACKED))
    found = df.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    limit = max(found["n"] / (2 * parts), 1)
    return [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] > limit]


def attach(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", settled: bool = False) -> DataFrame:
    """Join `table`, unique on `on`, to `df`.

    The table is settled once (unless the caller did) and measured. A light one is broadcast. Otherwise both sides are
    shuffled, and the heavy keys of `df`, as a sketch of it finds them, are salted: their rows spread over as many
    tasks as there are shuffle partitions and their table rows are copied as often. Rows without a key spread too.
    """
    on = list(on)
    table = table if settled else settle(table)
    light = broadcast_if_light(table)
    if light is not table:
        return df.join(light, on, how)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.xxhash64(*on)
    heavy = heavy_keys(df, hashed, parts)
    spread = reduce(or_, [F.col(c).isNull() for c in on])
    if heavy:
        spread = spread | hashed.isin(heavy)
    salt = F.when(spread, F.pmod(F.xxhash64(*df.columns), F.lit(parts))).otherwise(F.lit(0)).cast("int")
    copies = F.when(hashed.isin(heavy), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))) if heavy else F.array(F.lit(0))
    salted = table.withColumn("_salt", F.explode(copies))
    return df.withColumn("_salt", salt).join(salted, [*on, "_salt"], how).drop("_salt")
