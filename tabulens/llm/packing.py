"""Packing of tokenised documents by the sum-of-squares rule, with level arrays per task.

A document's tokens beyond whole sequences go, as one piece, to the open sequence whose new level keeps the sum of squared numbers of
open sequences per level smallest; ties go to the fullest, and to an open one before a new one. When more than `max_open` sequences are
open, the next piece is cut to top up the fullest one. What is open when a task has placed all its rows is cut into full sequences; the
last is split into powers of two, which need no padding. Each task packs its own rows: nothing is shuffled, and memory is bounded by
`max_open` sequences.

Defined results: a null or empty text is one end token; repeated rows and null ids are packed like any other; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabulens.llm.common import batches_of

CAPACITY, END_ID = 2048, 1
#: Words a Python worker remembers before it starts anew.
REMEMBERED = 1_500_000
#: Words of one string the tokenizer gets.
JOINED = 500


class WordIds:
    """Token ids of whole texts as little-endian bytes.

    Tokens of this vocabulary never cross white space, nor the border between letters and punctuation, and ignore case. So words are
    encoded once, without the punctuation at their end, and remembered. Lower-case words of letters only, which the tokenizer's
    normalisation leaves as they are, go to its model many at a time; the tokens that end a word are known from the vocabulary. All
    other words pass the whole tokenizer one by one.
    """

    shared: dict[str, WordIds] = {}

    @classmethod
    def of(cls, path: str) -> WordIds:
        """One per Python worker, so later tasks know the words of earlier ones."""
        if path not in cls.shared:
            cls.shared[path] = cls(path)
        return cls.shared[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        words = [(t or "").replace("\n", " ").split(" ") for t in texts]
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*words)
        self._learn(new)
        end, known = np.array([end_id], "<u4").tobytes(), self.known
        return [b"".join([known[w] for w in ws]) + end for ws in words]

    def _learn(self, words: set[str]) -> None:
        known, parts = self.known, {}
        for w in words:
            base = w.rstrip(string.punctuation)
            if base.isalpha() and "\u03a3" not in base and "\u0130" not in base:  # letters whose lower case depends on more than themselves
                parts[w] = (base.lower(), w[len(base) :])
        needed = {p for pair in parts.values() for p in pair if p}
        needed.update(w for w in words if w not in parts)
        needed.difference_update(known)
        letters = [w for w in needed if w.isalpha() and w == w.lower() and unicodedata.is_normalized("NFC", w)]
        groups = [letters[at : at + JOINED] for at in range(0, len(letters), JOINED)]
        for some, e in zip(groups, self.plain.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                data = ids.tobytes()
                known.update((w, data[4 * a : 4 * b]) for w, a, b in zip(some, [0, *stops[:-1].tolist()], stops.tolist()))
        rest = [w for w in needed if w not in known]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            known[w] = np.array(e.ids, "<u4").tobytes()
        for w, (base, tail) in parts.items():
            known[w] = known[base] + (known[tail] if tail else b"")


class Packer:
    """Places documents one by one. A piece is (doc_id, start, ids as bytes, doc_tokens); a full sequence is a list of pieces."""

    def __init__(self, capacity: int = CAPACITY, max_open: int = 256):
        self.capacity, self.max_open = capacity, max_open
        self.levels, self.open, self.n_open = np.zeros(capacity + 1, np.int64), {}, 0

    def choose(self, size: int) -> int:
        """The level whose sequence should take a piece of this size; 0 is a new one."""
        used = np.flatnonzero(self.levels[1 : self.capacity - size + 1]) + 1
        if not len(used):
            return 0
        grown = used + size
        change = 2 * self.levels[grown] - 2 * self.levels[used] + 2
        change[grown == self.capacity] -= 1  # a full sequence is counted no more
        best = len(used) - 1 - int(np.argmin(change[::-1]))
        return int(used[best]) if change[best] <= 2 * self.levels[size] + 1 else 0

    def add(self, doc_id, ids: bytes) -> list[list[tuple]]:
        """Sequences that this document fills."""
        full, total, at, step = [], len(ids) // 4, 0, 4 * self.capacity
        while total - at >= self.capacity:
            full.append([(doc_id, at, ids[4 * at : 4 * at + step], total)])
            at += self.capacity
        while at < total:
            size = total - at
            level = self.choose(size)
            if level == 0 and self.n_open >= self.max_open:
                level = max(l for l, w in self.open.items() if w)
                size = min(size, self.capacity - level)
            full += self._put(level, (doc_id, at, ids[4 * at : 4 * (at + size)], total), size)
            at += size
        return full

    def _put(self, level: int, piece: tuple, size: int) -> list[list[tuple]]:
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + size == self.capacity:
            return [pieces]
        self.open.setdefault(level + size, []).append(pieces)
        self.levels[level + size] += 1
        self.n_open += 1
        return []

    def close(self) -> list[list[tuple]]:
        """The open sequences' pieces, fullest first, cut into full sequences and one rest in powers of two."""
        left = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        self.__init__(self.capacity, self.max_open)
        total = sum(len(p[2]) // 4 for p in left)
        rest = total % self.capacity
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        out, queue = [], iter(left)
        piece = next(queue, None)
        for size in sizes:
            pieces = []
            while size:
                doc_id, start, ids, doc_tokens = piece
                take = min(size, len(ids) // 4)
                pieces.append((doc_id, start, ids[: 4 * take], doc_tokens))
                size -= take
                piece = (doc_id, start + take, ids[4 * take :], doc_tokens) if 4 * take < len(ids) else next(queue, None)
            out.append(pieces)
        return out


def pack(
    docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    max_open: int = 256, with_ids: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece, and its `ids` on demand."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches):
        encoder, packer = WordIds.of(path), Packer(capacity, max_open)
        serial = TaskContext.get().partitionId() << 40

        def rows(full):
            nonlocal serial
            out = []
            for pieces in full:
                offset = 0
                for doc_id, start, ids, doc_tokens in pieces:
                    n = len(ids) // 4
                    out.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, serial, offset, ids))
                    offset += n
                serial += 1
            columns = list(zip(*out)) or [()] * 8
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids)

        for batch in batches_of(batches):
            full = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist(), end_id)):
                full += packer.add(doc_id, ids)
            yield rows(full)
        yield rows(packer.close())

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
