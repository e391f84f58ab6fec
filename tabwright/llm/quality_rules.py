"""Quality rules in column expressions, and robust multivariate outliers by minimum covariance determinants."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.texts import spare
from tabwright.session import settle

WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"

VECTOR = ("x_length", "x_symbols", "x_lines", "x_repeats", "x_capitals")
# Standard deviations that every statistic is granted beside its own: where a group's rows are all alike, an estimate
# of its spread alone would make an outlier of the first row that differs at all.
GRANTED = (0.05, 0.20, 0.20, 0.20, 0.10)
SUPPORT = 0.75  # share of a group's rows with the least distances that its estimate is made of
STEPS = 3  # concentration steps
LEAST_ROWS = 50  # groups with fewer rows use the estimate of their language, or else of all rows
SALTS = 32  # parts that the rows of a group are dealt to for joins
CUTOFF = 100.0  # squared distance beyond which a row is an outlier
# Squared distances are spread wider by estimating from the inner SUPPORT of the rows: the 0.75 quantile of a
# chi-squared variable with 5 degrees of freedom; the estimate is scaled so that this quantile of the distances meets it.
CHI2_SUPPORT = 6.6257


def dropped(text: Column, characters: str) -> Column:
    """Number of characters of `text` that are among `characters`."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, from the array of window hashes."""

    def covered(ordered: Column) -> Column:
        # ordered: (hash, place) pairs; a window is repeated if a neighbour has its hash
        places = F.filter(
            F.transform(
                ordered,
                lambda w, k: F.when(
                    w["h"].eqNullSafe(F.get(ordered, k - 1)["h"]) | w["h"].eqNullSafe(F.get(ordered, k + 1)["h"]), w["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
        gaps = lambda p: F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW))))
        return F.aggregate(let(F.sort_array(places), gaps), F.lit(0).cast("long"), lambda total, n: total + n)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(pairs, covered))


def base_statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, without a shuffle: the columns of `docs` but text, and the counts.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_capitals. Settle the result
    before filtering by a count: a filter pushed below would compute the words anew for every window.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    out = docs.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    out = out.withColumn("_lines", lines)
    out = out.withColumn("word_chars", (F.char_length(text) - dropped(text, BLANKS)).cast("long"))
    out = out.withColumn("n_symbols", dropped(text, SYMBOLS).cast("long")).withColumn("n_capitals", dropped(text, CAPITALS).cast("long"))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    at = F.col("_words")
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(at) - WINDOW), lambda i: F.xxhash64(*[F.get(at, i + j) for j in range(WINDOW)])
    )
    out = out.withColumn("_windows", F.when(F.size(at) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("n_repeat_words", repeated_words(F.col("_windows")))
    out = out.withColumn("n_lines", F.size("_lines").cast("long"))
    out = out.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    return out.drop("text", "_words", "_lines", "_windows")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def transformed() -> dict[str, Column]:
    """The statistics as roughly normal variables."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return {
        "x_length": F.log(chars / words),
        "x_symbols": F.log1p(100 * F.col("n_symbols") / chars),
        "x_lines": F.log1p(10 * F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        "x_repeats": F.log1p(10 * F.col("n_repeat_words") / words),
        "x_capitals": F.log1p(10 * F.col("n_capitals") / chars),
    }


def whitened(at: DataFrame) -> DataFrame:
    """Replace `spread`, the lower triangle of a covariance row by row, by `white`, that of the inverse of its Cholesky factor.

    Written out column by column on a table with one row per group.
    """
    p = len(VECTOR)
    others = [c for c in at.columns if c != "spread"]
    cov = lambda i, j: F.get("spread", F.lit(i * (i + 1) // 2 + j))
    f = lambda i, j: F.col(f"_f{i}_{j}")
    w = lambda i, j: F.col(f"_w{i}_{j}")
    total = lambda terms: sum(terms, F.lit(0.0))
    for i in range(p):
        for j in range(i + 1):
            rest = cov(i, j) - total(f(i, k) * f(j, k) for k in range(j))
            at = at.withColumn(f"_f{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / f(j, j))
    for i in range(p):
        for j in range(i + 1):
            value = F.lit(1.0) if i == j else -total(f(i, k) * w(k, j) for k in range(j, i))
            at = at.withColumn(f"_w{i}_{j}", value / f(i, i))
    return at.select(*others, F.array(*[w(i, j) for i in range(p) for j in range(i + 1)]).alias("white"))


def distance() -> Column:
    """Squared Mahalanobis distance of the statistics from the columns `mean` and `white`."""
    p = len(VECTOR)
    gap = [F.col(VECTOR[j]) - F.get("mean", F.lit(j)) for j in range(p)]
    rows = [sum((F.get("white", F.lit(i * (i + 1) // 2 + j)) * gap[j] for j in range(i + 1)), F.lit(0.0)) for i in range(p)]
    return sum((F.pow(r, 2) for r in rows), F.lit(0.0))


def groups() -> Column:
    """The groups of a row, narrowest first: language and source, language, all rows."""
    none = F.lit("")
    of = lambda level, lang, source: F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))
    return F.array(of(0, F.col("_lang"), F.col("_source")), of(1, F.col("_lang"), none), of(2, none, none))


def moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance (with the granted variances) per group from one aggregation of sums."""
    p = range(len(VECTOR))
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(VECTOR[i]).alias(f"s{i}") for i in p],
        *[F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"s{i}_{j}") for i in p for j in range(i + 1)],
    )
    mean = [F.col(f"s{i}") / F.col("n") for i in p]
    spread = [
        F.col(f"s{i}_{j}") / F.col("n") - mean[i] * mean[j] + (F.lit(GRANTED[i] ** 2) if i == j else F.lit(0.0)) for i in p for j in range(i + 1)
    ]
    return sums.select(*keys, "n", F.array(*mean).alias("mean"), F.array(*spread).alias("spread"))


def estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Minimum-covariance-determinant estimate per group: keys, n, mean, white (see `whitened`), scale.

    Starts from the rows near the group's medians and makes STEPS concentration steps: estimate mean and
    covariance, measure distances, keep the SUPPORT share with the least ones. Each step never enlarges the
    determinant. Every step is two aggregations with partial sums and bounded quantile sketches, so a group with
    a third of all rows is summed where its rows lie and only a table with one row per group is joined back.
    """
    within = lambda c, q: F.percentile_approx(c, q, 2000)
    at = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*[within(x, 0.5) for x in VECTOR]).alias("mean"))
    p = range(len(VECTOR))
    own = salted(rows, at, keys)
    parts = F.array(*[within(F.abs(F.col(VECTOR[i]) - F.get("mean", F.lit(i))), 0.5) for i in p])
    wide = own.groupBy(*keys).agg(parts.alias("mad"))
    square = lambda i, j: F.pow(1.4826 * F.get("mad", F.lit(i)), 2) + GRANTED[i] ** 2 if i == j else F.lit(0.0)
    at = at.join(wide, keys).select(*keys, "n", "mean", F.array(*[square(i, j) for i in p for j in range(i + 1)]).alias("spread"))
    at = settle(whitened(settle(at)))
    for _ in range(STEPS):
        cut = near(rows, at, keys).groupBy(*keys).agg(within(F.col("d"), SUPPORT).alias("cut"))
        kept = near(rows, at.join(cut, keys), keys, "cut").filter(F.col("d") <= F.col("cut"))
        at = settle(whitened(settle(moments(kept, keys))))
    cut = near(rows, at, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("all"), within(F.col("d"), SUPPORT).alias("cut"))
    scale = F.greatest(F.col("cut") / CHI2_SUPPORT, F.lit(1.0))
    return settle(at.join(cut, keys).select(*keys, F.col("all").alias("n"), "mean", "white", scale.alias("scale")))


def salted(rows: DataFrame, at: DataFrame, keys: list[str]) -> DataFrame:
    """Join a table with one row per group to the rows, the rows of a group spread over SALTS parts by `_salt`."""
    return rows.join(at.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "_salt"])


def near(rows: DataFrame, at: DataFrame, keys: list[str], *more: str) -> DataFrame:
    joined = salted(rows, at.select(*keys, "mean", "white", *more), keys)
    return joined.withColumn("d", distance()).drop("mean", "white")


def group(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("\x00"))


def judge(docs: DataFrame, *more: Column) -> DataFrame:
    """Counts and verdict of every document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance.

    `kept` is false if a base rule fails, and if the statistics of the text lie beyond CUTOFF (squared Mahalanobis
    distance) from the robust estimate of its language and source. Groups are those of lang and source, nulls
    included; estimates are made from the rows that pass the base rules. A group of fewer than LEAST_ROWS such rows
    uses the estimate of its language, a language of fewer that of all rows; with fewer rows altogether nothing is
    an outlier. A null or empty text has no words and fails. Repeated rows count as often as they occur.
    `more` are further columns of `docs` to return.
    """
    plain = docs.select("doc_id", group("lang").alias("_lang"), group("source").alias("_source"), "text", *more)
    others = plain.columns[4:]
    counted = base_statistics(plain).withColumn("base_failed", base_failed()).withColumns(transformed())
    counted = settle(counted)
    passed = counted.filter(~F.col("base_failed")).select(
        F.explode(groups()).alias("group"), F.pmod(F.xxhash64("doc_id", *VECTOR), F.lit(SALTS)).cast("int").alias("_salt"), *VECTOR
    )
    est = estimates(passed, ["group"]).filter(F.col("n") >= LEAST_ROWS)
    out = counted
    for level in range(3):  # the estimate of the first of a row's groups that has one
        own = est.filter(F.col("group.level") == level).select(F.col("group").alias(f"_g{level}"), F.struct("mean", "white", "scale").alias(f"_e{level}"))
        out = out.withColumn(f"_g{level}", groups()[level]).join(own, f"_g{level}", "left")
    out = out.withColumn("_e", F.coalesce("_e0", "_e1", "_e2")).withColumn("mean", F.col("_e.mean")).withColumn("white", F.col("_e.white"))
    out = out.withColumn("distance", distance() / F.col("_e.scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *names, "base_failed", kept.alias("kept"), "distance", *others)


def accept(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns; rows that share a doc_id, or have none, each by its own verdict."""
    mark = F.xxhash64(group("text"), group("lang"), group("source"))  # all that a verdict depends on
    own, of, at = (spare(docs, c) for c in ("_bad", "_of", "_mark"))
    bad = judge(docs, mark.alias(of)).filter(~F.col("kept")).select(F.col("doc_id").alias(own), of).distinct()
    marked = docs.withColumn(at, mark)
    return marked.join(bad, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(at) == F.col(of)), "left_anti").select(docs.columns)
