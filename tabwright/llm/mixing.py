"""Mix the sources of a corpus to target weights, cut at exact word budgets."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.ranks import cumulate, ordered_index
from tabwright.session import settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # words of the mix, as a multiple of all words
LIMIT = 2  # largest multiple of its own words that a source gives
SEED = 12


def n_words(text: str) -> Column:
    """Runs of characters other than space and the controls 9 to 13; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(group, size) of the sources to (group, size, target): shares by weight that stop at `limit` times the size.

    The weights repeat over the sources in the order of `group`. What the stopped sources leave is shared again by
    weight until none is above its limit. The result is one water level: a source gets the level times its weight, or its
    limit where that is less. Sources are ordered by limit / weight; the level follows from the sums of those below.
    """
    numbered = ordered_index(sizes, ["group"], name="_i")
    by_turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = numbered.withColumn("_w", F.element_at(by_turn, (F.col("_i") % len(weights) + 1).cast("int")))
    weighed = settle(weighed.withColumn("_cap", limit * F.col("size").cast("double")).withColumn("_level", F.col("_cap") / F.col("_w")))
    steps = cumulate(weighed, "_level", {"cap": F.sum("_cap"), "w": F.sum("_w")})
    total = F.col("cap_total") / limit * share
    full = F.col("cap_before") + F.col("_level") * (F.col("w_total") - F.col("w_before")) <= total  # this source and those below stop
    found = steps.agg(
        F.max(total).alias("total"),
        F.max("w_total").alias("w"),
        F.max_by(F.col("cap_before") + F.col("cap"), F.when(full, F.col("_level"))).alias("stopped"),
        F.max_by(F.col("w_before") + F.col("w"), F.when(full, F.col("_level"))).alias("stopped_w"),
    ).first()
    left = (found["w"] or 0.0) - (found["stopped_w"] or 0.0)
    level = ((found["total"] or 0.0) - (found["stopped"] or 0.0)) / left if left > 0 else float("inf")
    return weighed.select("group", "size", F.least(F.col("_cap"), F.lit(level) * F.col("_w")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = SEED) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken.

    Input: doc_id, text and source; other columns are ignored. A document's size is its number of words. A source whose
    target reaches its size is taken whole as often as it fits; the rest of the budget (the target, rounded) takes
    documents in a random order of the source, the last of them only up to the word at which the budget ends, so a
    source's words sum to its budget exactly. The order is that of a hash of doc_id, text and seed: reruns agree,
    however the rows are dealt. Null sources are one source; documents without words are taken with 0 words; of
    equal doc_id and text, which tie, the larger size comes first and equal rows are interchangeable. An empty table
    gives no rows. Documents are dealt to ranges of (source, hash), so a source of any size spreads over many tasks;
    each range sends its total, and a document's place is the total of earlier ranges plus the running sum in its own.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed)), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    group = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))  # code-point order, null last
    sized = settle(docs.select("doc_id", group.alias("group"), key.alias("_key"), n_words("text").alias("size")))
    ranged = settle(sized.repartitionByRange("group", "_key").withColumn("_range", F.spark_partition_id()))
    # one row per source and range: no more than sources and ranges together
    parts = settle(ranged.groupBy("group", "_range").agg(F.sum("size").alias("_words")))
    sources = targets(parts.groupBy("group").agg(F.sum("_words").alias("size")), weights, share, limit)
    earlier = W.partitionBy("group").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    starts = starts.join(sources.withColumnRenamed("size", "source_size"), "group").drop("_words")
    inside = W.partitionBy("group", "_range").orderBy("_key", "doc_id", F.desc("size")).rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.join(starts, ["group", "_range"]).withColumn("_before", F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_sql(weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = SEED) -> str:
    """`mix` in SQL."""
    turns = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(weights))
    return f"""WITH d AS (SELECT doc_id, coalesce('0' || source, '1') AS g, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}:' || md5(coalesce(text, ''))) AS k FROM documents),
      s AS (SELECT g, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY g) - 1) % {len(weights)} {turns} END AS w FROM d GROUP BY g),
      t AS (SELECT *, {float(limit)} * source_size AS cap, {float(limit)} * source_size / w AS lv FROM s),
      c AS (SELECT lv, sum(cap) OVER (ORDER BY lv) AS below, sum(w) OVER (ORDER BY lv) AS w_below, sum(cap) OVER (ORDER BY lv) - sum(cap) OVER (PARTITION BY lv) AS b0,
        sum(w) OVER (ORDER BY lv) - sum(w) OVER (PARTITION BY lv) AS w0, sum(w) OVER () AS ws, {float(share)} * sum(source_size) OVER () AS total FROM t),
      f AS (SELECT max(total) AS total, max(ws) AS ws, coalesce(max(below) FILTER (b0 + lv * (ws - w0) <= total), 0) AS stopped,
        coalesce(max(w_below) FILTER (b0 + lv * (ws - w0) <= total), 0) AS stopped_w FROM c),
      r AS (SELECT g, source_size, least(cap, CASE WHEN ws - stopped_w > 0 THEN (total - stopped) / (ws - stopped_w) * w ELSE cap END) AS target FROM t, f),
      p AS (SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.g ORDER BY k, doc_id, size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM d JOIN r ON d.g = r.g),
      e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
      SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
        CAST(epochs * size + greatest(0, least(budget - epochs * source_size - seen, size)) AS BIGINT) AS taken FROM e"""
