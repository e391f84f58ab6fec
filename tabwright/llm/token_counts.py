"""Token counts by rank-synchronous array merging."""

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tabwright.llm.texts import ChunkTable, learn, text_slices

# Fixed value: the pre-token pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class RankMerger:
    """Counts the symbols that are left when all merges of a byte-pair vocabulary have been made."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = len(vocab)
        self.first = np.array([vocab[c] for c in byte_symbols()], np.int64)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", []) if t["special"]]
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}
        self.chunks = ChunkTable(self.count_chunks, self.pattern)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], _NONE).astype(np.int32)

    def merged_sizes(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token. All pre-tokens advance together: in each round every sequence merges
        all occurrences of its own lowest-ranked pair, and a sequence without a pair leaves the arrays."""
        sizes = np.array([len(w) for w in words], np.int64)
        out = np.minimum(sizes, 1)
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        live = (sizes > 1)[owner]
        symbol, owner = symbol[live], owner[live]
        rank = np.full(symbol.size, _NONE, np.int32)  # of the pair that a symbol makes with the next one
        stale = np.arange(symbol.size)
        while symbol.size:
            stale = stale[:-1] if stale.size and stale[-1] == symbol.size - 1 else stale
            inner = stale[owner[stale] == owner[stale + 1]]
            rank[stale] = _NONE
            rank[inner] = self._ranks(symbol[inner], symbol[inner + 1])
            rank[-1] = _NONE
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[start, symbol.size])
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == _NONE
            out[owner[start[done]]] = length[done]
            hit = np.flatnonzero((rank == np.repeat(lowest, length)) & (rank != _NONE))
            if hit.size:  # of pairs that overlap, as in aaa, every second one from the left
                head = np.r_[True, np.diff(hit) != 1]
                place = np.arange(hit.size) - np.maximum.accumulate(np.where(head, np.arange(hit.size), 0))
                hit = hit[place % 2 == 0]
                symbol[hit] = self.product[rank[hit]]
            keep = np.repeat(~done, length)
            keep[hit + 1] = False
            at = (np.cumsum(keep) - 1)[hit]  # only pairs beside a new symbol change their rank
            stale = np.unique(np.r_[at, np.maximum(at - 1, 0)])
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
        return out

    def count_chunks(self, chunks: list[str]) -> list[int]:
        if len(self.known) > self.chunks.limit:
            self.known.clear()
        cut = [self.pattern.findall(c) for c in chunks]
        learn(self.known, cut, lambda new: self.merged_sizes([w.encode() for w in new]).tolist())
        return [sum(map(self.known.__getitem__, ws)) for ws in cut]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens per text. A special string inside a text is one token, and cuts the text."""
        marked = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if not marked:
            return [sum(c) for c in self.chunks.lookup(texts)]
        out = list(texts)
        plain = [i for i in range(len(texts)) if i not in set(marked)]
        for i, n in zip(plain, self.count([texts[i] for i in plain])):
            out[i] = n
        cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        for i in marked:
            parts = cut.split(texts[i])
            out[i] = len(parts) - 1 + sum(sum(c) for c in self.chunks.lookup(parts))
        return out


@lru_cache(maxsize=2)
def merger(path: str) -> RankMerger:
    return RankMerger(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Tokens of each whole text under a byte-level BPE vocabulary, as the tokenizers library counts them.

    Returns doc_id, n_bytes, n_tokens, over_limit. A null or empty text has 0 bytes and 0 tokens; repeated rows
    give repeated rows, a null doc_id stays null, other columns are not read. The work is one pass without a
    shuffle: each task holds slices of a few MB and a bounded memo of counts per chunk, so a long text or a hot
    source costs its length and nothing else.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merger(path)
        for rows, texts in text_slices(batches):
            n = pa.array(model.count(texts), pa.int64())
            size = pc.cast(pc.fill_null(pc.binary_length(rows.column("text")), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
