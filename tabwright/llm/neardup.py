"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.texts import spare, text_slices
from tabwright.session import settle

WORDS = 5  # per shingle
SIMILARITY = 0.8
BANDS, ROWS = 20, 4  # a pair at 0.8 shares no band with probability (1 - 0.8 ** 4) ** 20 = 3e-5
CELL, CELL_BYTES = 512, 4_000_000  # texts of a family that are compared with each other in one place, and their bytes
BLOCK_SIDE = 1_024  # texts on each side of a block in which candidates of different cells are looked for
COLUMNS = 512  # shingles multiplied at once
DF_BITS = 17  # document frequencies are counted per word hash of so many bits
DRAWS = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK, PLACES = 1 << 18, 1 << 12  # bytes hashed at once, places in a word told apart


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray]:
    """Random odd numbers: one per byte value, one per place in a word (again from the start after PLACES)."""
    rng = np.random.default_rng(22)
    odd = [rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, PLACES)]
    return odd[0], odd[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """64-bit hashes of all words (lower case, cut at white space), words per text, and the texts with single spaces.

    A word's hash sums a mix of every byte with its place, for all words of a block of bytes at once.
    """
    parts = [t.lower().split() for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    plain = [" ".join(p) for p in parts]
    raw = np.frombuffer("".join(p + " " for p in plain if p).encode(), np.uint8)
    start = np.r_[0, np.flatnonzero(raw == ord(" ")) + 1]  # of each word, and the end
    bytes_, places = letters()
    flat = np.empty(len(start) - 1, np.uint64)
    cut = [0, *(np.flatnonzero(np.diff(start[:-1] // BLOCK)) + 1).tolist(), len(flat)] if len(flat) else [0]
    for x, y in zip(cut, cut[1:]):
        first = start[x:y] - start[x]
        block = raw[start[x] : start[y]]
        place = np.arange(len(block), dtype=np.int32) - np.repeat(first.astype(np.int32), np.diff(start[x : y + 1]))
        value = bytes_[block] * places[place % PLACES]
        value ^= value >> np.uint64(32)
        flat[x:y] = np.add.reduceat(value, first)
    flat = (flat ^ (flat >> np.uint64(29))) * MIX
    return flat ^ (flat >> np.uint64(32)), sizes, plain


def content_keys(plain: list[str]) -> list[bytes | None]:
    """128 bits per text without regard to case and spacing; null for a text without a word."""
    return [xxhash.xxh3_128_digest(p) if p else None for p in plain]


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(texts with a word, documents per word bucket) over all documents: one number per bucket comes to the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts_seen = np.zeros(1 << DF_BITS, np.int64), 0
        for _, texts in text_slices(batches):
            flat, sizes, _ = word_hashes(texts)
            owner = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
            pairs = np.sort((owner << DF_BITS) | (flat >> np.uint64(64 - DF_BITS)).astype(np.int64))
            pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
            total += np.bincount(pairs & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
            texts_seen += int((sizes > 0).sum())
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": np.r_[-1, found].astype(np.int32), "n": np.r_[texts_seen, total[found]]})

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    df = np.zeros(1 << DF_BITS, np.int64)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return int(n[bucket < 0].sum()), df


def idf(n: int, df: np.ndarray) -> np.ndarray:
    return (1 + np.log10((1 + n) / (1 + df))).astype(np.float32)


def shingles(flat: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, weight) of the distinct shingles of each text, sorted by text and hash.

    The weight is the count of the shingle times the mean inverse document frequency of its words. A text of
    fewer than WORDS words is one shingle. Frequencies are those of words, not of shingles: a shingle shared by
    a group of copies is as common as the group is large, and would weigh the less the more copies there are.
    """
    n = len(flat)
    word = weights[(flat >> np.uint64(64 - DF_BITS)).astype(np.int64)]
    code = np.zeros(n, np.uint64)
    weight = np.zeros(n, np.float32)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - place  # words from here to the end of the text
    for j in range(min(WORDS, int(sizes.max()) if len(sizes) else 0)):
        inside = n - j
        ok = left[:inside] > j
        code[:inside] = np.where(ok, (code[:inside] ^ flat[j:]) * MIX + np.uint64(j + 1), code[:inside])
        weight[:inside] += np.where(ok, word[j:], np.float32(0))
    keep = (left >= WORDS) | (place == 0)
    code, owner = code[keep], owner[keep]
    weight = weight[keep] / np.minimum(WORDS, left[keep])
    code = (code ^ (code >> np.uint64(29))) * MIX
    order = np.lexsort((code, owner))
    code, owner, weight = code[order], owner[order], weight[order].astype(np.float32)
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]) if len(code) else np.zeros(0, int)
    count = np.diff(np.r_[first, len(code)]).astype(np.float32)
    return owner[first], code[first], weight[first] * count


@lru_cache(maxsize=1)
def draws() -> np.ndarray:
    """Random values of consistent weighted sampling, a row (r, 1 / r, ln c, beta) each: r and c from Gamma(2, 1), beta uniform."""
    rng = np.random.default_rng(20)
    r, c = rng.gamma(2, 1, DRAWS).astype(np.float32), rng.gamma(2, 1, DRAWS)
    return np.stack([r, 1 / r, np.log(c), rng.random(DRAWS, np.float32)], axis=1).astype(np.float32)


def samples(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, texts: int, count: int = BANDS * ROWS) -> np.ndarray:
    """texts x count fingerprints; two texts agree in one with the probability of their weighted Jaccard similarity.

    Per sample every shingle draws r, c and beta from tables by its hash; t = floor(ln w / r + beta), and the
    shingle with the least ln c - r (t - beta + 1) is sampled together with t.
    """
    out = np.zeros((texts, count), np.int32)
    if not len(code):
        return out
    table = draws()
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    length = np.diff(np.r_[start, len(owner)])
    log_w = np.log(weight)
    short = (code >> np.uint64(32)).astype(np.uint32)
    multipliers = np.random.default_rng(21).integers(0, 1 << 31, (count, 2), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    for j in range(count):
        at = ((short * multipliers[j, 0] + multipliers[j, 1]) >> np.uint32(16)).astype(np.intp)
        r, r_inverse, log_c, beta = table.take(at, axis=0).T
        t = np.floor(log_w * r_inverse + beta)
        a = log_c - r * (t - beta + 1)
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, start), length))
        least = least[np.r_[True, owner[least[1:]] != owner[least[:-1]]]]
        value = code[least] * MIX + t[least].astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        out[owner[least], j] = (value >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts given as (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - low
    return low / total if total else 0.0


def mark() -> Column:
    """Tells apart rows that share a doc_id, or have none, by their texts."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signatures(docs: DataFrame, weights) -> DataFrame:
    """content (null without a word) and its samples, for every row of `docs`, with doc_id and mark."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, 400_000):
            flat, sizes, plain = word_hashes(texts)
            found = samples(*shingles(flat, sizes, weights.value), len(texts))
            values = pa.ListArray.from_arrays(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), pa.array(content_keys(plain), pa.binary()), values], ["doc_id", "mark", "content", "samples"])

    return docs.select("doc_id", "text", mark().alias("mark")).mapInArrow(sign, f"doc_id {kind}, mark long, content binary, samples array<int>")


def texts_of(contents: DataFrame, named: DataFrame, docs: DataFrame) -> DataFrame:
    """content, text: one text for each of the contents.

    The text is found by one doc_id of its content and checked by its key, so repeated doc_ids with different texts
    do no harm.
    """
    wanted = contents.join(named, "content").select("content", F.col("doc_id").alias("_id"))
    texts = wanted.join(docs.select(F.col("doc_id").alias("_d"), "text"), F.col("_id").eqNullSafe(F.col("_d"))).select("content", "text")

    def right(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in text_slices(batches):
            keys = content_keys(word_hashes(found)[2])
            yield rows.filter(pa.array([k == c.as_py() for k, c in zip(keys, rows.column("content"))], pa.bool_()))

    return settle(texts.mapInArrow(right, "content binary, text string").dropDuplicates(["content"]))


def overlaps(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, texts: int, left: int) -> np.ndarray:
    """Shared weight of the first `left` texts (rows) with all others, or with each other if there are no others.

    The smaller of two weights of a shingle is the sum of the steps between its distinct weights that both reach, so a
    step is a column that the texts reaching it share, and the sums are matrix products over blocks of columns.
    """
    order = np.lexsort((weight, code))
    owner, code, weight = owner[order], code[order], weight[order].astype(np.float64)
    new_code = np.ones(len(code), bool)
    new_code[1:] = code[1:] != code[:-1]
    group = np.cumsum(new_code) - 1
    shared = np.bincount(group)[group] > 1  # shingles of one text are in no overlap
    owner, code, weight, new_code = owner[shared], code[shared], weight[shared], new_code[shared]
    new_step = new_code.copy()
    new_step[1:] |= weight[1:] != weight[:-1]
    step = np.cumsum(new_step) - 1
    height = weight[new_step]
    height[1:] -= np.where(new_code[new_step][1:], 0.0, height[:-1].copy())
    first = step[new_code][np.cumsum(new_code) - 1] if len(step) else step
    reached = step - first + 1
    column = np.repeat(first, reached) + np.arange(reached.sum()) - np.repeat(np.cumsum(reached) - reached, reached)
    row = np.repeat(owner, reached)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    across = slice(left, None) if left < texts else slice(None)
    out = np.zeros((left, texts - left if left < texts else texts))
    for start in range(0, len(height), COLUMNS):
        x, y = np.searchsorted(column, [start, start + COLUMNS])
        block = np.zeros((texts, min(COLUMNS, len(height) - start)))
        block[row[x:y], column[x:y] - start] = 1.0
        out += (block[:left] * height[start : start + COLUMNS]) @ block[across].T
    return out


def similar(shared: np.ndarray, total_left: np.ndarray, total_right: np.ndarray) -> np.ndarray:
    """Whether texts reach SIMILARITY, from shared and whole weights."""
    union = total_left[:, None] + total_right[None, :] - shared
    return (union > 0) & (shared >= SIMILARITY * union - 1e-12 * union)


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j), one less than its texts for each connected part of a symmetric matrix of links."""
    free, a, b = np.ones(len(linked), bool), [], []
    for i in range(len(linked)):
        if not free[i]:
            continue
        free[i] = False
        border = [i]
        while border:
            at = border.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            border += new.tolist()
            a += [at] * len(new)
            b += new.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def in_groups(batches: Iterable[pa.RecordBatch], keys: list[str], limit: int = 400_000) -> Iterator[tuple[pa.Table, np.ndarray, list[str]]]:
    """Whole runs of equal keys in sorted rows, together about `limit` bytes of text: (rows, starts of the runs, texts)."""
    held: list[pa.RecordBatch] = []
    size = 0

    def run() -> tuple[pa.Table, np.ndarray, list[str]]:
        table = pa.Table.from_batches(held).combine_chunks()
        return table, np.flatnonzero(changes(table)), [t or "" for t in table.column("text").to_pylist()]

    def changes(rows) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for k in keys:
            codes = rows.column(k).to_numpy(zero_copy_only=False) if not isinstance(rows, pa.Table) else rows.column(k).to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        return new

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = [*np.flatnonzero(changes(batch)).tolist(), batch.num_rows]
        for x, y in zip(starts, starts[1:]):
            part = batch.slice(x, y - x)
            key = tuple(part.column(k)[0].as_py() for k in keys)
            if held and key != last and size >= limit:
                yield run()
                held, size = [], 0
            held.append(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            last = key
    if held:
        yield run()


def verified(rows: DataFrame, keys: list[str], weights) -> DataFrame:
    """Links (a, b) that connect the similar texts of each group of `rows` (keys…, side, content, text).

    All texts of a group are compared exactly, each on side 0 with those on side 1, or with each other where there is
    no side 1. At most one link less than texts leaves a group, whatever the number of similar pairs.
    """

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, texts in in_groups(batches, keys):
            flat, sizes, _ = word_hashes(texts)
            owner, code, weight = shingles(flat, sizes, weights.value)
            cut = np.searchsorted(owner, np.arange(len(texts) + 1))
            total = np.add.reduceat(np.r_[weight, 0.0].astype(np.float64), np.minimum(cut[:-1], len(weight))) * (np.diff(cut) > 0)
            side = table.column("side").to_numpy()
            content = table.column("content").combine_chunks()
            for x, y in zip(starts, [*starts[1:], len(texts)]):
                inside = slice(cut[x], cut[y])
                left = int(y - x - side[x:y].sum())  # side 0 comes first
                shared = overlaps(owner[inside] - x, code[inside], weight[inside], y - x, left)
                if left < y - x:
                    linked = np.zeros((y - x, y - x), bool)
                    linked[:left, left:] = similar(shared, total[x : x + left], total[x + left : y])
                    linked |= linked.T
                else:
                    linked = similar(shared, total[x:y], total[x:y])
                a, b = spanning(linked)
                if len(a):
                    yield pa.RecordBatch.from_arrays([content.take(pa.array(a + x)), content.take(pa.array(b + x))], ["a", "b"])

    dealt = rows.select(*keys, "side", "content", "text").repartition(*keys).sortWithinPartitions(*keys, "side")
    return dealt.mapInArrow(compare, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node that the edges (a, b) connect it with, by alternating large and small stars."""
    edges = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())

    def star(pairs: DataFrame, of: DataFrame) -> DataFrame:
        least = of.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = star(large, large).select(F.col("v").alias("x"), "u", "m")
        small = small.select(F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        new = settle(small.select("e.u", "e.v").filter("u != v").distinct())
        changed = new.exceptAll(edges).limit(1).count() + edges.exceptAll(new).limit(1).count()
        edges = new
        if not changed:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def links(docs: DataFrame, signed: DataFrame, weights) -> DataFrame:
    """Pairs (a, b) of different contents that connect all texts linked by similar pairs of a shared bucket.

    A family is a content, the leader, with all contents of the buckets in which it is the least one. Its contents are
    dealt to cells, each with the leader, and all pairs of a cell are compared exactly. Families of several cells
    that are not connected then have the pairs between cells compared too: those that share a bucket and are not
    connected yet, in blocks of (texts outside the largest connected part) x (all). Cells and blocks hold each text
    once and send links that span what they found, so what moves grows with the texts and not with their pairs.
    """
    named = signed.filter(F.col("content").isNotNull()).groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.first("samples").alias("samples"))
    bands = F.array(*[F.xxhash64(F.lit(b), F.slice("samples", b * ROWS + 1, ROWS)) for b in range(BANDS)])
    named = settle(named.select("content", "doc_id", bands.alias("bands")))
    banded = named.select("content", F.explode("bands").alias("key"))
    leaders = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("content").alias("leader")).filter("size > 1")
    family = settle(banded.join(leaders, "key").select("leader", "content").distinct())
    texts = texts_of(family.select("content").distinct(), named, docs)
    lengths = texts.select("content", F.octet_length("text").alias("bytes"))
    sizes = family.join(lengths, "content").groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    cells = F.greatest(F.ceil(F.col("n") / CELL), F.ceil(F.col("bytes") / CELL_BYTES)).cast("int")
    sizes = settle(sizes.select("leader", "n", cells.alias("cells")))
    members = family.join(sizes, "leader")
    own = F.when(F.col("content") == F.col("leader"), F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(F.array(F.pmod(F.xxhash64("content"), F.col("cells")).cast("int")))
    dealt = members.select("leader", "content", F.explode(own).alias("cell"), F.lit(0).alias("side")).join(texts, "content")
    found = settle(verified(dealt.withColumn("leader", F.xxhash64("leader")), ["leader", "cell"], weights).distinct())
    spread = members.filter("cells > 1").select("leader", "content")
    if spread.isEmpty():
        return found
    return found.unionByName(between(spread, named.select("content", "bands"), components(found), texts, weights))


def between(family: DataFrame, named: DataFrame, roots: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """Links (a, b) between texts of a family that share a bucket and that `roots` does not connect."""

    def involved(block: pa.Table) -> pa.Table:
        """The rows of a block with a candidate on the other side, found by their buckets alone."""
        block = block.combine_chunks()
        side, part = block.column("side").to_numpy(), block.column("part").to_numpy()
        bands = block.column("bands").combine_chunks().flatten().to_numpy().reshape(len(side), -1)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        open_ = np.zeros((len(x), len(y)), bool)
        for one, other in zip(bands[x].T, bands[y].T):
            open_ |= one[:, None] == other
        open_ &= part[x][:, None] != part[y]
        keep = np.r_[x[open_.any(axis=1)], y[open_.any(axis=0)]]
        return block.select(["leader", "i", "j", "side", "content"]).take(pa.array(keep))

    rows = family.join(named, "content").join(roots.withColumnRenamed("node", "content"), "content", "left")
    rows = settle(rows.select(F.xxhash64("leader").alias("leader"), "content", "bands", F.xxhash64(F.coalesce("root", "content")).alias("part")))
    parts = rows.groupBy("leader", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("leader").agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("part", F.struct("n", "part")).alias("main"))
    rows = settle(rows.join(sizes.filter("most < all"), "leader"))
    blocks = lambda size: F.ceil(size / BLOCK_SIDE).cast("int")
    place = lambda n: F.pmod(F.xxhash64("content"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    across, down = blocks(F.col("all")), blocks(F.col("all") - F.col("most"))
    names = ["leader", "content", "bands", "part"]
    left = rows.filter("part != main").select(*names, F.lit(0).alias("side"), place(down).alias("i"), upto(across).alias("j"))
    right = rows.select(*names, F.lit(1).alias("side"), place(across).alias("j"), upto(down).alias("i"))
    both = left.unionByName(right).groupBy("leader", "i", "j").applyInArrow(involved, "leader long, i int, j int, side int, content binary")
    return verified(settle(both).join(texts, "content"), ["leader", "i", "j"], weights).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The class of every document: doc_id, class_id, class_size.

    Documents whose texts reach a weighted Jaccard similarity of SIMILARITY over TF-IDF shingles of WORDS words,
    directly or through others, are one class; class_id is its least doc_id. Texts that differ in case or spacing
    only are the same text. A null or empty text is a class of its own. A text of fewer than five words is one
    shingle, so only its copies match. Repeated rows are copies; rows with a null doc_id take the class of their
    text, null if no row of it has an id. Other columns are not read.
    """
    return marked_classes(docs).select("doc_id", "class_id", "class_size")


def marked_classes(docs: DataFrame) -> DataFrame:
    """`near_duplicates` with the mark of each row and the root of its class, null for a text without a word."""
    plain = docs.select("doc_id", "text")
    n, df = frequencies(plain)
    weights = docs.sparkSession.sparkContext.broadcast(idf(n, df))  # one number per word bucket
    signed = settle(signatures(plain, weights))
    roots = components(links(plain, signed, weights))
    member = signed.select("doc_id", "mark", "content").join(roots.withColumnRenamed("node", "content"), "content", "left")
    member = settle(member.select("doc_id", "mark", F.coalesce("root", "content").alias("root")))
    classes = member.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    known = member.filter(F.col("root").isNotNull()).join(classes, "root").select("doc_id", "mark", "root", "class_id", "class_size")
    empty = member.filter(F.col("root").isNull()).select("doc_id", "mark", "root", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return known.unionByName(empty)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` less all but one document of each class, the one with the least doc_id.

    Of several rows of the class that have this doc_id one stays. Rows with a null doc_id go only if a row of their
    class has one. Rows that share a doc_id with different texts are judged each by its own text. All columns of `docs`
    stay as they are, whatever their names.
    """
    of, at, root, stays = (spare(docs, c) for c in ("_member", "_mark", "_root", "_stays"))
    member = marked_classes(docs).filter("class_size > 1").select("doc_id", "mark", "root", "class_id").distinct()
    named = settle(member.select(F.col("doc_id").alias(of), F.col("mark").alias(f"{at}_of"), F.col("root").alias(root), F.col("doc_id").eqNullSafe(F.col("class_id")).alias(stays)))
    marked = docs.withColumn(at, mark())
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(at) == F.col(f"{at}_of"))
    alone = marked.join(named, same, "left_anti").select(docs.columns)
    one = marked.join(named.filter(F.col(stays) & F.col(of).isNotNull()), same).dropDuplicates([root]).select(docs.columns)
    nameless = marked.join(named.filter(F.col(stays) & F.col(of).isNull()), same, "left_semi").select(docs.columns)
    return alone.unionByName(one).unionByName(nameless)
