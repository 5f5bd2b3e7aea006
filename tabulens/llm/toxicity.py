"""Toxicity by subword bags: averaged embeddings of words' character n-grams under a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its hashed n-grams (3 to 6 characters, with word borders) and of itself; a document's vector
is the mean over its words, and a linear softmax gives the probability of label 1. A misspelling shares most n-grams with the word it
comes from. Training sees a bounded sample: about `rows` hashed documents per label, whole and together of at most `sample_bytes` bytes, and
every word of them. Scoring reads whole texts; since everything after the n-gram vectors is linear, a word adds one number to the score.

Defined results: null and empty texts get the score of no evidence (the softmax of its bias); rows without id or label are not learned from;
of several labels of an id the largest counts, of several texts one, repeated rows are learned from once;
if a label has no rows all scores are 0 or 1 by the label that has, or 0; repeated rows each get a row; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import string
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabulens.llm.common import batches_of, staged

BUCKETS, DIMENSIONS = 1 << 17, 8
LENGTHS = (3, 4, 5, 6)
#: Documents average hundreds of words; the mean is brought to the size of one word in so many.
SCALE = np.float32(100.0)
#: Weight of label 1 in training.
POSITIVE = 0.25
#: Words a Python worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: Entries of the training sample that are multiplied at a time.
PIECE = 1 << 16


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its n-grams."""
    marked = f"<{word}>"
    grams = [marked] + [marked[i : i + n] for n in LENGTHS for i in range(len(marked) - n + 1) if n < len(marked)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in grams]


def plain(word: str) -> str:
    return word.strip(string.punctuation)


@dataclass
class Model:
    """What a word's n-grams add to the log odds, and the odds without evidence."""

    weights: np.ndarray
    bias: float

    def word(self, word: str) -> float:
        grams = subwords(word)
        return float(self.weights[grams].mean()) if word else 0.0


def _sums(values: np.ndarray, taken: np.ndarray, owners: np.ndarray, n: int, shares: np.ndarray | None = None) -> np.ndarray:
    """Sums of values[taken] (times shares) by owner, PIECE entries at a time; owners are sorted."""
    out = np.zeros((n, values.shape[1]), np.float32)
    for at in range(0, len(owners), PIECE):
        own = owners[at : at + PIECE]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        some = np.take(values, taken[at : at + PIECE], axis=0)
        if shares is not None:
            some *= shares[at : at + PIECE, None]
        out[own[first]] += np.add.reduceat(some, first, axis=0)
    return out


def train(texts: list[str], labels: np.ndarray, epochs: int = 50, rate: float = 0.03, decay: float = 1e-5, seed: int = 7) -> Model:
    """Full-batch Adam on the cross entropy; label 1 has POSITIVE of the weight, however often it was sampled."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, np.float32), 30.0 if len(labels) and labels[0] else -30.0)
    index: dict[str, int] = {}
    doc, word, share = array("i"), array("i"), array("f")
    for d, t in enumerate(texts):
        words = [plain(w) for w in t.lower().split()]
        for w, n in Counter(words).items():
            doc.append(d)
            word.append(index.setdefault(w, len(index)))
            share.append(n / len(words))
    doc, word, share = np.array(doc, np.int32), np.array(word, np.int32), np.array(share, np.float32)
    gram, width = array("i"), array("i")
    for w in index:
        own = subwords(w)
        gram.extend(own)
        width.append(len(own))
    gram, width = np.array(gram, np.int32), np.array(width, np.int32)
    gram_word, part = np.repeat(np.arange(len(index), dtype=np.int32), width), (1 / width).astype(np.float32)[:, None]
    by_word, by_gram = np.argsort(word, kind="stable"), np.argsort(gram, kind="stable")
    # the same entries in the order of their words and of their n-grams, for the way back
    back_doc, back_share, back_word = doc[by_word], share[by_word], word[by_word]
    back_gram_word, back_gram = gram_word[by_gram], gram[by_gram]
    del by_word, by_gram
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32), rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    target = np.eye(2, dtype=np.float32)[labels]
    weight = (np.array([1 - POSITIVE, POSITIVE]) / np.bincount(labels, minlength=2))[labels].astype(np.float32)[:, None]
    for step in range(1, epochs + 1):
        embedding, linear, bias = params
        vectors = _sums(embedding, gram, gram_word, len(index)) * part
        hidden = _sums(vectors, word, doc, len(texts), share) * SCALE
        logits = hidden @ linear + bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        error = (odds / odds.sum(axis=1, keepdims=True) - target) * weight
        back = (error @ linear.T) * SCALE
        to_word = _sums(back, back_doc, back_word, len(index), back_share) * part
        to_gram = _sums(to_word, back_gram_word, back_gram, BUCKETS)
        gradients = [to_gram + decay * embedding, hidden.T @ error, error.sum(axis=0)]
        for p, g, m, v in zip(params, gradients, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    embedding, linear, bias = params
    return Model(((embedding @ (linear[:, 1] - linear[:, 0])) * SCALE).astype(np.float64), float(bias[1] - bias[0]))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = 2500, sample_bytes: int = 32 << 20) -> Model:
    """A model from the labelled rows (id, label 0 or 1) of docs; about `rows` rows per label reach the driver, whole.

    The sample is drawn from the labels, so its ids have a fixed bound and are broadcast; no text is shuffled. Rows of a label are taken in
    the order of their hashes; one that doesn't fit into what is left of its half of `sample_bytes` is left out.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    known = known.groupBy("id").agg(F.max("label").alias("label")).withColumn("k", F.xxhash64("id"))
    found = dict(known.groupBy("label").count().collect())
    share = F.create_map(*[x for label in (0, 1) for x in (F.lit(label), F.lit(min(1 << 40, int(rows / max(found.get(label, 0), 1) * (1 << 40)) + 1)))])
    picked = known.where(F.pmod("k", F.lit(1 << 40)) < share[F.col("label")])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    drawn = texts.join(F.broadcast(picked), "id").select("k", F.xxhash64("text").alias("h"), "text", "label", F.octet_length("text").alias("size"))
    drawn = staged(drawn, "toxicity-sample")
    left, fitting = {0: sample_bytes // 2, 1: sample_bytes // 2}, []
    # one row an id, however often it occurs and however many texts it has
    firsts = drawn.groupBy("k", "label").agg(F.min(F.struct("h", "size")).alias("first")).select("k", "first.h", "label", "first.size")
    for k, h, label, size in sorted(map(tuple, firsts.collect())):
        if size <= left[label]:
            left[label] -= size
            fitting.append((k, h))
    chosen = docs.sparkSession.createDataFrame(sorted(set(fitting)), "k long, h long")
    sample = drawn.join(F.broadcast(chosen), ["k", "h"]).dropDuplicates(["k", "h"]).select("k", "text", "label").collect()
    sample.sort()
    return train([r["text"] for r in sample], np.array([r["label"] for r in sample], np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; the model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, known = shared.value, {}
        for batch in batches_of(batches):
            means = []
            for text in batch.column(1).to_pylist():
                words = (text or "").lower().split()
                if len(known) > REMEMBERED:
                    known.clear()
                for w in set(words).difference(known):
                    known[w] = model.word(plain(w))
                means.append(sum([known[w] for w in words]) / max(len(words), 1))
            odds = np.clip(np.array(means, np.float64) + model.bias, -700, 700)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-odds)))], ["doc_id", "score"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, score double")
