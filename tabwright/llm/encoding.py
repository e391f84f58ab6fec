"""Token ids from the tokenizers library, each distinct chunk of text encoded once per worker."""

import json
import os
from functools import lru_cache

import numpy as np
import regex

from tabwright.llm.texts import ChunkTable, learn
from tabwright.llm.token_counts import PATTERN, byte_symbols

RUN = 2000  # chunks given to the library in one text
SEPARATOR = "\x01"  # not white space, never part of a longer pre-token here


class ByteEncoder:
    """Ids of a byte-level BPE file as little-endian bytes, joined from the ids of its chunks.

    Pre-tokens never reach over the boundaries at which `ChunkTable` cuts, so the joined ids are those of the
    whole text. A text that holds a special string is given to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size(True) <= 1 << 16 else np.dtype("<u4")
        self.opens = np.zeros(self.library.get_vocab_size(True), bool)
        space = byte_symbols()[32]
        self.opens[[i for t, i in self.library.get_vocab(True).items() if t.startswith(space)]] = True
        self.chunks = ChunkTable(self.solve, regex.compile(PATTERN))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def solve(self, chunks: list[str]) -> list[bytes]:
        """Chunks that start with their only white space are encoded in runs: a token with a leading space opens a chunk."""
        easy = [c for c in chunks if c[:1] == " " and len(c.split()) == 1 and len(c) > 1 and not c[1:2].isspace() and not c[-1].isspace()]
        found: dict[str, bytes] = {}
        for run in map(easy.__getitem__, (slice(i, i + RUN) for i in range(0, len(easy), RUN))):
            ids = np.array(self.library.encode_batch_fast(["".join(run)], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(run):
                flat, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
                ends = [*(cuts[1:] * size).tolist(), len(flat)]
                found.update(zip(run, (flat[a:b] for a, b in zip((cuts * size).tolist(), ends))))
        rest = [c for c in chunks if c not in found]
        found.update(zip(rest, self._whole(rest)))
        return [found[c] for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        marked = [any(s in t for s in self.special) for t in texts]
        if not any(marked):
            return [b"".join(c) for c in self.chunks.lookup(texts)]
        whole = iter(self._whole([t for t, m in zip(texts, marked) if m]))
        cut = iter([b"".join(c) for c in self.chunks.lookup([t for t, m in zip(texts, marked) if not m])])
        return [next(whole) if m else next(cut) for m in marked]


class WordEncoder(ByteEncoder):
    """The same for a vocabulary whose pre-tokens hold no white space: texts are cut at spaces and line ends."""

    def __init__(self, path: str):
        super().__init__(path)
        self.words: dict[str, bytes] = {"": b""}
        mark = self.library.encode(SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def solve(self, words: list[str]) -> list[bytes]:
        """Words are encoded in runs, a control character between them, whose token ends a word."""
        easy = [w for w in words if self.mark is not None and SEPARATOR not in w]
        found: dict[str, bytes] = {}
        for run in map(easy.__getitem__, (slice(i, i + RUN) for i in range(0, len(easy), RUN))):
            text = f" {SEPARATOR} ".join(run) + f" {SEPARATOR}"
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(run):
                flat, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
                starts = [0, *((ends[:-1] + 1) * size).tolist()]
                found.update(zip(run, (flat[a:b] for a, b in zip(starts, (ends * size).tolist()))))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, self._whole(rest)))
        return [found[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.chunks.limit:
            self.words = {"": b""}
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        learn(self.words, parts, self.solve)
        known = self.words.__getitem__
        return [b"".join(map(known, p)) for p in parts]


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
