"""SentencePiece encoding and decoding by a table of distinct marked words."""

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.texts import MEMO_ENTRIES, learn, text_slices

MARK = "▁"


class PieceTable:
    """Ids per distinct marked word: a white-space mark, or a run of them, with what follows up to the next.

    The table holds while no piece has a mark after another character, the normaliser leaves text as it is and
    a mark is put before a text; this is checked against the model. If it fails, or a text holds the mark
    itself, the library segments the whole text.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = self.sp.bos_id(), self.sp.eos_id()
        pieces = map(self.sp.id_to_piece, range(self.sp.get_piece_size()))
        probe = " ｆ①  Á\t"
        self.cuts = all(MARK not in p.lstrip(MARK) for p in pieces) and self.sp.decode(self.sp.encode(probe)) == probe
        self.words: dict[str, bytes] = {}

    def _bytes(self, ids: list[list[int]]) -> list[bytes]:
        return [np.array(i, "<u4").tobytes() for i in ids]

    def marked_words(self, text: str) -> list[str]:
        """Words less one mark; a run of spaces stays with the word after it, and at the end stands alone."""
        words = text.split(" ")
        if "" not in words:
            return words
        out, blank = [], 0
        for w in words:
            if w:
                out.append(" " * blank + w)
                blank = 0
            else:
                blank += 1
        if blank and len(words) > blank:
            out.append(MARK * blank)
        elif blank > 1:  # nothing but spaces
            out.append(MARK * blank)
        return out

    def segment(self, words: list[str]) -> list[bytes]:
        runs = [w for w in words if w.startswith(MARK)]
        alone = {w: self.sp.encode(" " * (len(w) - 1)) if len(w) > 1 else [self.sp.piece_to_id(MARK)] for w in runs}
        rest = [w for w in words if w not in alone]
        found = dict(zip(rest, self._bytes(self.sp.encode(rest, num_threads=1)))) if rest else {}
        return [np.array(alone[w], "<u4").tobytes() if w in alone else found[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids without begin and end, as little-endian 32-bit integers."""
        if len(self.words) > MEMO_ENTRIES:
            self.words.clear()
        whole = {i for i, t in enumerate(texts) if not self.cuts or MARK in t}
        parts = [[] if i in whole else self.marked_words(t) for i, t in enumerate(texts)]
        learn(self.words, parts, self.segment)
        known = self.words.__getitem__
        out = [b"".join(map(known, p)) for p in parts]
        for i in whole:
            out[i] = np.array(self.sp.encode(texts[i]), "<u4").tobytes()
        return out

    def frame(self, ids: bytes) -> np.ndarray:
        """The ids with begin and end."""
        return np.concatenate([[self.bos], np.frombuffer(ids, "<u4"), [self.eos]]).astype("<u4")


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


def encode_pieces(docs: DataFrame, path: str, keep: bool = False) -> DataFrame:
    """Encode each whole text with begin and end ids, and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with `keep` the ids and the decoded text as well.
    A null or empty text is begin and end only and decodes to the empty text. Repeated rows give repeated rows,
    a null doc_id stays null, other columns are not read. One pass without a shuffle: a task segments each
    distinct marked word once and joins the ids back by position; the table is bounded and local to the task's
    worker, because a corpus-wide one would shuffle every word of the corpus to save work that is done already.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(path)
        for rows, texts in text_slices(batches):
            ids = [table.frame(b) for b in table.encode(texts)]
            decoded = [table.sp.decode(i.tolist()) for i in ids]
            columns = [
                rows.column("doc_id"),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns += [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)
