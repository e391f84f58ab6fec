"""Token-id files: concatenated ids with Elias-Fano coded document boundaries.

One file holds a run of documents in ascending doc_id order:

    magic "EFT1", header (HEADER), null count, doc_ids (Elias-Fano), boundaries (Elias-Fano), ids

A coded sequence keeps the low bits of each value packed, the high bits in unary, and a directory with the place
of every SELECT_STEP-th one bit, so that `select` finds a single value without decoding the others. For m values
below u this takes about m * (2 + log2(u / m)) bits, against 64 m for a table of offsets.
"""

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.llm.encoding import byte_encoder
from tabwright.llm.texts import text_slices
from tabwright.session import checkpoint_dir, settle

MAGIC = b"EFT1"
HEADER = struct.Struct("<4sBQQQ")  # magic, bytes per id, documents, documents with a null doc_id, ids
SEQUENCE = struct.Struct("<qQBQQ")  # least value, values, low bits, bytes of low bits, bytes of high bits
SELECT_STEP = 256
FILE_IDS = 8_000_000  # ids after which a task starts its next file


class EliasFano:
    """A non-decreasing sequence of integers."""

    def __init__(self, base: int, size: int, low_bits: int, low: bytes, high: bytes, places: np.ndarray):
        self.base, self.size, self.low_bits = base, size, low_bits
        self.low, self.high, self.places = low, high, places

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        base = int(values[0]) if len(values) else 0
        rest = values.astype(np.uint64) - np.uint64(base & (2**64 - 1))
        top = int(rest[-1]) + 1 if len(rest) else 1
        low_bits = max(0, (top // max(1, len(rest))).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((rest[:, None] >> shifts) & np.uint64(1)).astype(bool).ravel(), bitorder="little").tobytes()
        ones = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(len(rest))
        bits = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, bool)
        bits[ones] = True
        return cls(base, len(rest), low_bits, low, np.packbits(bits, bitorder="little").tobytes(), ones[::SELECT_STEP].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = SEQUENCE.pack(self.base, self.size, self.low_bits, len(self.low), len(self.high))
        return head + self.low + self.high + self.places.astype("<u8").tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple["EliasFano", int]:
        base, size, low_bits, n_low, n_high = SEQUENCE.unpack_from(data, at)
        at += SEQUENCE.size
        low, high = data[at : at + n_low], data[at + n_low : at + n_low + n_high]
        at += n_low + n_high
        steps = -(-size // SELECT_STEP)
        return cls(base, size, low_bits, low, high, np.frombuffer(data, "<u8", steps, at)), at + 8 * steps

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        part = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        return (part >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the directory, a short walk over the unary bits to the i-th one."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        place, left = int(self.places[i // SELECT_STEP]), i % SELECT_STEP
        byte, bit = place // 8, place % 8
        word = self.high[byte] >> bit << bit
        while (n := word.bit_count()) <= left:
            left -= n
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        high = byte * 8 + (word & -word).bit_length() - 1 - i
        return self.base + (high << self.low_bits) + self._low(i)

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.size]
        high = (ones - np.arange(self.size)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.size * self.low_bits]
        low = bits.reshape(self.size, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)
        return (high + low.sum(axis=1, dtype=np.uint64) + np.uint64(self.base & (2**64 - 1))).astype(np.int64)


class TokenFile:
    """Reader of one file: `document(i)` decodes one document, `bounds` all boundaries."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, width, self.n_docs, self.n_null, self.n_ids = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self.doc_ids, at = EliasFano.read(view, HEADER.size)
        self.bounds, at = EliasFano.read(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]


def file_bytes(doc_ids: list[int | None], ids: list[bytes], dtype: np.dtype) -> bytes:
    """A file for documents in ascending doc_id order, nulls first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    sizes = np.array([len(i) // dtype.itemsize for i in ids], np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    head = HEADER.pack(MAGIC, dtype.itemsize, len(doc_ids), len(doc_ids) - len(known), int(bounds[-1]))
    return b"".join([head, EliasFano.of(known).to_bytes(), EliasFano.of(bounds).to_bytes(), *ids])


def _store(folder: str, name: str, data: bytes) -> None:
    """Write under a name of its own and then rename, so that a task run twice leaves one whole file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(data)
    store.move(draft, f"{path}/{name}")


def write_token_files(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 0, file_ids: int = FILE_IDS) -> tuple[str, DataFrame]:
    """Write the ids of all documents, each with `end_id` appended, and return the folder and its manifest.

    Documents are range-partitioned and sorted by doc_id; a task streams its range into files of about `file_ids`
    ids, so no file, group or buffer grows with the corpus. `folder` is a URI all executors reach; by default a
    new one below spark.checkpoint.dir. Manifest: file, first ("part" of the range and "seq" in it), n_docs,
    n_ids. A null text is empty (its end id only), a null doc_id comes first, equal doc_ids keep all their rows.
    """
    folder = folder or f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/token_files-{uuid.uuid4().hex}"
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ranged = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        doc_ids, ids, held, seq, part = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:06d}.eft"
            _store(folder, name, file_bytes(doc_ids, ids, encoder.dtype))
            columns = {"file": [name], "part": [part], "seq": [seq], "n_docs": [len(ids)], "n_ids": [held]}
            return pa.RecordBatch.from_pydict(columns, schema=pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("part", "seq", "n_docs", "n_ids"))]))

        for rows, texts in text_slices(batches):
            part = rows.column("part")[0].as_py()
            for d, i in zip(rows.column("doc_id").to_pylist(), encoder.encode(texts)):
                if held >= file_ids:
                    yield close()
                    doc_ids, ids, held, seq = [], [], 0, seq + 1
                doc_ids.append(d)
                ids.append(i + end)
                held += len(ids[-1]) // encoder.dtype.itemsize
        if ids:
            yield close()

    return folder, settle(ranged.mapInArrow(write, "file string, part long, seq long, n_docs long, n_ids long"))


def read_token_files(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files alone.

    Only the files of the manifest are read, each by one task. The starts come from a running total over the
    manifest, which has one row per file.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                found = TokenFile(data.as_py())
                bounds = found.bounds.values()
                crc = [zlib.crc32(found.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:])]
                columns = {
                    "file": [name.rpartition("/")[2]] * found.n_docs,
                    "doc_id": [None] * found.n_null + found.doc_ids.values().tolist(),
                    "inner": bounds[:-1],
                    "n_tokens": np.diff(bounds),
                    "ids_crc32": crc,
                }
                yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([("file", pa.string()), *((c, pa.int64()) for c in list(columns)[1:])]))

    starts = manifest.select("file", (F.sum("n_ids").over(W.orderBy("part", "seq")) - F.col("n_ids")).alias("before"))
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.eft").load(folder).select("path", "content")
    rows = files.mapInArrow(read, "file string, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "file").select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
