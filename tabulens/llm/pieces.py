"""SentencePiece encoding and decoding with the pieces and scores of a vocabulary file: batched Viterbi in numpy.

Spaces become U+2581, one is put before the text, and the text is cut where a run of them begins; no piece reaches across such a cut.
Different words of one length advance together, one character per step: the hashes of all substrings that end there probe the sorted
hashes of the pieces, and the best score of each word is kept with its last piece. Ties go to the longer last piece. A character in no
piece costs UNKNOWN less than the worst score and is written as its UTF-8 bytes; so is a U+2581 of the text itself, which makes
decoding exact. A word whose pieces don't spell it (two substrings with one hash) would be encoded again by a plain search.

Defined results: null texts are empty and have no pieces; repeated rows each get a row; other columns are ignored; an empty table gives
no rows. A word of any length is encoded whole, in memory proportional to its length times the longest piece.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulens.llm.common import batches_of

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
UNKNOWN = 10.0
MULTIPLIER = 0x9E3779B97F4A7C15
#: Words a Python worker remembers before it starts anew, and cells (words x length) one group of words may have.
REMEMBERED, CELLS = 1_500_000, 1 << 18
LEADING_BITS = 20


class Pieces:
    """A vocabulary: pieces with scores, and one piece per byte."""

    shared: dict[str, Pieces] = {}

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls.shared:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            ids = range(model.get_piece_size())
            normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
            of_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
            cls.shared[path] = cls({model.id_to_piece(i): (i, model.get_score(i)) for i in normal}, [of_byte[b] for b in range(256)])
        return cls.shared[path]

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces, self.byte_ids, self.known = pieces, byte_ids, {}
        self.longest = max(map(len, pieces))
        self.unknown = min(s for _, s in pieces.values()) - UNKNOWN
        self.powers = np.array([pow(MULTIPLIER, i, 1 << 64) for i in range(self.longest + 1)], np.uint64)
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array([i for i, _ in pieces.values()], np.int64)[order]
        self.scores = np.array([s for _, s in pieces.values()])[order]
        self.leading = np.zeros(1 << LEADING_BITS, bool)  # leading bits of the keys: most substrings are no pieces and need no search
        self.leading[self.keys >> np.uint64(64 - LEADING_BITS)] = True
        self.spelled = {i: p.replace(SPACE, " ").encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.is_byte = np.zeros(max(self.spelled) + 1, bool)
        self.is_byte[byte_ids] = True
        self.literal = np.array([byte_ids[b] for b in SPACE.encode()], "<u4").tobytes()

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * MULTIPLIER + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def viterbi(self, words: list[str]) -> list[list[int]]:
        """Piece ids of words of one length, -1 - character for a character that is in no piece."""
        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, length)
        prefix = np.zeros((n, length + 1), np.uint64)
        best, start, last = np.full((n, length + 1), -np.inf), np.zeros((n, length + 1), np.int64), np.zeros((n, length + 1), np.int64)
        best[:, 0] = 0
        rows = np.arange(n)
        with np.errstate(over="ignore"):
            for j in range(1, length + 1):
                prefix[:, j] = prefix[:, j - 1] * np.uint64(MULTIPLIER) + codes[:, j - 1] + np.uint64(1)
                first = max(0, j - self.longest)  # the longest piece comes first and wins ties
                hashes = prefix[:, j, None] - prefix[:, first:j] * self.powers[j - first : 0 : -1]
                maybe, at = self.leading[hashes >> np.uint64(64 - LEADING_BITS)], np.zeros(hashes.shape, np.int64)
                at[maybe] = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
                found = maybe & (self.keys[at] == hashes)
                total = np.where(found, best[:, first:j] + self.scores[at], -np.inf)
                alone = ~found[:, -1]
                total[alone, -1] = best[alone, j - 1] + self.unknown
                choice = total.argmax(axis=1)
                best[:, j], start[:, j] = total[rows, choice], first + choice
                last[:, j] = np.where(found[rows, choice], self.ids[at[rows, choice]], -1 - codes[:, j - 1].astype(np.int64))
        out: list[list[int]] = [[] for _ in words]
        place, steps, live = np.full(n, length), [], rows
        while len(live):
            steps.append((live, last[live, place[live]]))
            place[live] = start[live, place[live]]
            live = live[place[live] > 0]
        for some, ids in reversed(steps):
            for r, i in zip(some.tolist(), ids.tolist()):
                out[r].append(i)
        return out

    def slow(self, word: str) -> list[int]:
        """The same by a plain search over the pieces' texts."""
        best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        for j in range(1, len(word) + 1):
            options = [(best[i][0] + self.pieces[word[i:j]][1], -i, self.pieces[word[i:j]][0]) for i in range(max(0, j - self.longest), j) if word[i:j] in self.pieces]
            if word[j - 1] not in self.pieces:
                options.append((best[j - 1][0] + self.unknown, 1 - j, -1 - ord(word[j - 1])))
            score, begin, piece = max(options, key=lambda o: o[:2])
            best.append((score, -begin, piece))
        out, j = [], len(word)
        while j:
            out.append(best[j][2])
            j = best[j][1]
        return out[::-1]

    def _bytes(self, ids: list[int]) -> bytes:
        """Ids as little-endian bytes, unknown characters as their byte pieces."""
        if min(ids) < 0:
            ids = [x for i in ids for x in ([i] if i >= 0 else [self.byte_ids[b] for b in chr(-1 - i).encode()])]
        return np.array(ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, group in by_length.items():
            step = max(1, CELLS // length)
            for at in range(0, len(group), step):
                some = group[at : at + step]
                for w, ids in zip(some, self.viterbi(some)):
                    data = self._bytes(ids)
                    if self.spell(data) != w.replace(SPACE, " ").encode():
                        data = self._bytes(self.slow(w))
                    self.known[w] = data

    def encode(self, texts: list[str]) -> list[bytes]:
        """Piece ids of whole texts, as little-endian unsigned 32-bit integers."""
        cut = []
        for t in texts:
            parts = t.split(SPACE) if t else []
            cut.append([WORD.findall((SPACE if i == 0 else "") + p.replace(" ", SPACE)) for i, p in enumerate(parts)])
        new = {w for parts in cut for words in parts for w in words}
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        self.learn(new.difference(self.known))
        known = self.known
        return [self.literal.join([b"".join([known[w] for w in words]) for words in parts]) for parts in cut]

    def spell(self, ids: bytes) -> bytes:
        spelled = self.spelled
        return b"".join([spelled[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def decode(self, ids: bytes) -> str:
        """The text of encoded ids."""
        return self.spell(ids)[1:].decode()


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_chars, n_pieces, n_byte_pieces, ids_crc32, decoded_sha256, round_trip), and the ids on demand."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    names = ["doc_id", "n_chars", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_sha256", "round_trip"] + ["ids"] * with_ids

    def run(batches):
        pieces = Pieces.of(path)
        for batch in batches_of(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            encoded = pieces.encode(texts)
            decoded = [pieces.decode(e) for e in encoded]
            ids = [np.frombuffer(e, "<u4") for e in encoded]
            columns = [
                batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(i) for i in ids], pa.int64()), pa.array([int(pieces.is_byte[i].sum()) for i in ids], pa.int64()),
                pa.array([zlib.crc32(e) for e in encoded], pa.int64()), pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()), pa.array([a == b for a, b in zip(texts, decoded)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns + [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))] * with_ids, names)

    schema = "doc_id long, n_chars long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None, ids_col: str = "ids") -> DataFrame:
    """The rows with the decoded `text`; null ids give null."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    @F.pandas_udf("string")
    def text(ids):
        pieces = Pieces.of(path)
        return ids.map(lambda x: None if x is None else pieces.decode(np.asarray(x, "<u4").tobytes()))

    return encoded.withColumn("text", text(ids_col))
