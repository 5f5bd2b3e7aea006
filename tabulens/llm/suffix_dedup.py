"""Removal of repeated byte strings: shard Burrows-Wheeler transforms merged by interleave refinement.

A byte goes if a string of `length` bytes that covers it also starts earlier (smaller doc_id, or the same document before). Matches never
cross documents and are judged on the input.

1. Every window of `length` bytes holds k-grams; the one with the smallest hash (leftmost of equals) is its anchor. Equal windows have
   equal anchors at equal offsets. Consecutive windows of one anchor form a record; a record is about 140 bytes long.
2. Records meet by anchor hash, sorted by content hash. All but the first of equal records are removed. A group with one content is
   done; of the others the first record of each content is a candidate, with its bytes.
3. Candidates of equal anchors share a task. There, shards of records get their own Burrows-Wheeler transform, and the shards are merged:
   the interleave starts as shard after shard and is refined by stable passes over the preceding symbols (two at a time), which order it
   by contexts that grow by two symbols each pass. Blocks whose contexts agree so far are the repeated intervals of that length; suffixes
   alone in their block have reached their longest common prefix and leave. Blocks left at `length` symbols are the repeated strings.

Step 2 only passes on what can repeat; step 3 decides. Copies of a text never bring more than their records' hashes into one task. An
anchor whose candidates have more than CROWD_BYTES (a phrase in very many contexts) would be merged in one task, so its windows become
records of their own, which lie under as many different keys as there are different windows and are settled as in step 2.

Defined results: null texts are empty; texts shorter than `length` stay whole; repeated rows of a document (same doc_id and text) count as
one document and each get its row; rows of one doc_id with different texts follow each other in the order of a hash of their texts; a null
doc_id comes before all others; other columns are ignored by `remove_repeats` and kept by `cut_documents`; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tabulens.llm.common import batches_of, staged

LENGTH = 100
GRAM = 24
#: Bytes of text hashed at once, bytes of one shard, and bytes of shards merged at once.
HASH_BYTES, SHARD_BYTES, MERGE_BYTES = 4 << 20, 1 << 18, 1 << 21
#: Bytes of different contexts one anchor may bring into one merge.
CROWD_BYTES = 4 << 20
#: Low bits of a hash that give way to the position in the batch; a batch is shorter than 2 ** PLACE_BITS.
PLACE_BITS = 31
#: Positions are ordinal * 2 ** ORDINAL_BITS + start; the ordinal tells texts of one doc_id apart.
ORDINAL_BITS = 40


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that begin at each position as an integer."""
    out = np.zeros(len(data) - 7, np.uint64)
    for o in range(8):
        part = data[o : o + (len(data) - o) // 8 * 8].view("<u8")
        out[o::8] = part[: len(out[o::8])]
    return out


def records(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of every record; `ends` are the ends of the texts that `data` concatenates."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none
    w, n = _words(data), len(data) - gram + 1
    with np.errstate(over="ignore"):
        h = w[:n] * np.uint64(0x9E3779B97F4A7C15)
        for o in range(8, gram - 7, 8):
            h ^= h >> np.uint64(29)
            h += w[o : o + n]
            h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
    place = np.uint64((1 << PLACE_BITS) - 1)
    low = (h & ~place) | np.arange(n, dtype=np.uint64)
    span, size = length - gram + 1, 1
    while 2 * size <= span:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if size < span:
        low = np.minimum(low[: size - span], low[span - size :])
    at = (low & place).astype(np.int64)  # the anchor of each window
    inside = np.ones(len(at), bool)
    for e in ends[:-1]:
        inside[max(0, e - length + 1) : e] = False
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(change & inside)
    stops = np.append(np.flatnonzero(change | ~inside), len(at))
    count = stops[np.searchsorted(stops, first, "right")] - first
    return first, count, h[at[first]].view(np.int64)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches_of(batches, HASH_BYTES):
            doc, ordinal = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = batch.column(2).to_pylist()
            blob = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            first, count, h = records(np.frombuffer(blob, np.uint8), ends, length)
            row = np.searchsorted(ends, first, "right")
            start = first - np.append(0, ends)[row]
            digest = xxhash.xxh3_64_intdigest
            content = np.array([digest(blob[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist())], np.uint64)
            columns = _combine(h, content.view(np.int64), doc[row].astype(np.int64), (ordinal[row].astype(np.int64) << ORDINAL_BITS) + start, count.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "r", "doc", "at", "n"])

    return docs.select("doc", "ordinal", F.col("text").cast("binary").alias("text")).mapInArrow(run, "h long, r long, doc long, at long, n int")


def _combine(h, r, doc, at, n):
    """The rows of a batch, where only the first of equal records keeps its anchor. The others begin later than a record of the same batch,
    so they are repeats whatever else there is: they get an arbitrary anchor and a negative n, and a frequent record meets once per batch."""
    order = np.argsort(r, kind="stable")
    same = np.append(False, r[order][1:] == r[order][:-1])
    group = order[same | np.append(same[1:], False)]
    group = group[np.lexsort((at[group], doc[group], r[group]))]
    head = np.append(True, r[group][1:] != r[group][:-1]) if len(group) else np.zeros(0, bool)
    own = group[np.flatnonzero(head)][np.cumsum(head) - 1]
    later = (doc[group] != doc[own]) | (at[group] != at[own])
    repeat, again = group[later], group[~later & ~head]  # again: the same place of a repeated row
    with np.errstate(over="ignore"):
        h[repeat] = (doc[repeat] * 1_000_003 + at[repeat]) * np.int64(0x1E3779B97F4A7C15)
    n[repeat] *= -1
    kept = np.ones(len(h), bool)
    kept[again] = False
    return tuple(x[kept] for x in (h, r, doc, at, n))


def _settle(batches):
    """Of rows sorted by (h, r, doc, at): repeats of equal records (candidate false), and the first of each content where an anchor has several."""
    last = pending = None  # (h, r, doc, at) of the current run's first record; the only content so far of the current anchor
    for batch in batches:
        if not batch.num_rows:
            continue
        every = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        known = every[4] < 0
        yield _settled(every[2][known], every[3][known], -every[4][known])
        h, r, d, at, n = (x[~known] for x in every)
        if not len(h):
            continue
        before = last or (~h[0], 0, 0, 0)
        hs, rs = np.append(before[0], h), np.append(before[1], r)
        new_h = hs[1:] != hs[:-1]
        new = new_h | (rs[1:] != rs[:-1])
        starts, run = np.flatnonzero(new), np.cumsum(new)
        own_d, own_at = np.append(before[2], d[starts])[run], np.append(before[3], at[starts])[run]
        repeat = np.flatnonzero(~new & ((d != own_d) | (at != own_at)))
        lone = new_h[starts]  # first content of its anchor
        several = ~lone
        several[:-1] |= ~lone[1:]
        chosen = starts[several]
        rows = [(h[chosen], d[chosen], at[chosen], n[chosen])]
        if len(starts):
            if pending and not lone[0]:
                rows.append(tuple(np.array([x]) for x in pending))
            s = starts[-1]
            pending = (h[s], d[s], at[s], n[s]) if lone[-1] else None
        last = (h[-1], r[-1], own_d[-1], own_at[-1])
        yield _settled(d[repeat], at[repeat], n[repeat], *(np.concatenate(x) for x in zip(*rows)))


def _settled(d, at, n, h=np.zeros(0, np.int64), some_d=np.zeros(0, np.int64), some_at=np.zeros(0, np.int64), some_n=np.zeros(0, np.int32)):
    """A batch of repeats and of candidates with their anchors."""
    candidate = np.append(np.zeros(len(d), bool), np.ones(len(h), bool))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(candidate), pa.array(np.append(np.zeros(len(d), np.int64), h), mask=~candidate),
            *(pa.array(np.append(x, y).astype(t)) for x, y, t in ((d, some_d, np.int64), (at, some_at, np.int64), (n, some_n, np.int32))),
        ],
        ["candidate", "h", "doc", "at", "n"],
    )


def shard_bwt(symbols: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, its inverse) of one shard by contexts of at least `length` symbols; `symbols` is 0 after each record."""
    rank, depth = symbols.astype(np.int64), 1
    while depth < length:
        follow = np.zeros_like(rank)
        follow[:-depth] = rank[depth:]
        rank = np.unique(rank * (int(rank.max()) + 2) + follow, return_inverse=True)[1]
        depth *= 2
    order = np.argsort(rank, kind="stable")
    inverse = np.empty_like(order)
    inverse[order] = np.arange(len(order))
    return order, inverse


def merge_shards(texts: list[bytes], length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, text, start) of every string of `length` bytes that occurs at least twice, by block of equal strings.

    Row i of the concatenated shard transforms stands for a suffix; `pair[i]` are the two symbols before it (the farther one first) and
    `back[i]` the row of the suffix that begins with them. The interleave `row` holds the rows whose contexts may still repeat.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + 1
    symbols[base + sizes] = 0
    cuts = [0]
    for b, s in zip(base.tolist(), sizes.tolist()):
        if b + s + 1 - cuts[-1] > shard_bytes and b > cuts[-1]:
            cuts.append(b)
    cuts.append(len(symbols))
    order, inverse = np.empty(len(symbols), np.int64), np.empty(len(symbols), np.int64)
    for a, b in zip(cuts, cuts[1:]):
        o, i = shard_bwt(symbols[a:b], length)
        order[a:b], inverse[a:b] = o + a, i + a
    before = lambda k: symbols[np.maximum(order - k, 0)]
    pair = (np.maximum(before(2) - 1, 0).astype(np.uint16) << 8) | np.maximum(before(1) - 1, 0).astype(np.uint16)
    back = inverse[np.maximum(order - 2, 0)]
    windows = np.maximum(sizes - length + 1, 0)
    ends = np.repeat(base + length, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    row = np.sort(inverse[ends])  # shard after shard, each in its own order
    block = np.zeros(len(row), np.int64)
    for _ in range(length // 2):
        if not len(row):
            break
        c = pair[row]
        by = np.argsort(c, kind="stable")
        c, block, row = c[by], block[by], back[row[by]]
        edge = np.ones(len(row) + 1, bool)
        edge[1:-1] = (c[1:] != c[:-1]) | (block[1:] != block[:-1])
        shared = ~(edge[:-1] & edge[1:])
        block, row = np.cumsum(edge[:-1])[shared], row[shared]
    place = order[row]
    text = np.searchsorted(base, place, "right") - 1
    return block, text, place - base[text]


def _merged(length: int):
    def settle(rows):
        doc, at, texts = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), [r[2] for r in rows]
        block, text, start = merge_shards(texts, length)
        d, a = doc[text], at[text] + start
        by = np.lexsort((a, d, block))
        block, d, a = block[by], d[by], a[by]
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
        own = np.repeat(first, np.diff(np.append(first, len(block))))
        gone = (d != d[own]) | (a != a[own])
        d, a = d[gone], a[gone]
        by = np.lexsort((a, d))
        d, a = d[by], a[by]
        edge = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (a[1:] > a[:-1] + 1))) if len(d) else np.zeros(0, np.int64)
        stop = np.append(edge[1:], len(d)) - 1
        return pa.RecordBatch.from_arrays([pa.array(d[edge]), pa.array(a[edge]), pa.array((a[stop] - a[edge] + 1).astype(np.int32) if len(edge) else np.zeros(0, np.int32))], ["doc", "at", "n"])

    def run(batches):
        rows, size, key = [], 0, None
        for batch in batches:
            for h, doc, at, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= MERGE_BYTES and h != key:
                    yield settle(rows)
                    rows, size = [], 0
                rows.append((doc, at, data))
                size, key = size + len(data), h
        if rows:
            yield settle(rows)

    return run


def _windows(length: int):
    """Every window of the candidates as a record of its own, under its own hash."""

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches_of(batches, HASH_BYTES // length):
            doc, at, data = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_pylist()
            count = np.array([len(d) - length + 1 for d in data], np.int64)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            r = np.array([digest(d[i : i + length]) for d in data for i in range(len(d) - length + 1)], np.uint64).view(np.int64)
            columns = _combine(r.copy(), r, np.repeat(doc, count), np.repeat(at, count) + place, np.ones(len(r), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "r", "doc", "at", "n"])

    return run


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with `doc` (doc_id, null first) and `ordinal` (0, or the place of the text among different texts of one doc_id)."""
    docs = docs.withColumn("doc", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))))
    hashed = docs.select("doc", F.xxhash64("text").alias("t"))
    clash = hashed.groupBy("doc").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("doc")
    if clash.isEmpty():
        return docs.withColumn("ordinal", F.lit(0))
    order = Window.partitionBy("doc").orderBy("t")
    ordinals = hashed.join(clash, "doc").distinct().withColumn("ordinal", F.row_number().over(order) - 1)
    keyed = docs.withColumn("t", F.xxhash64("text")).join(ordinals, ["doc", "t"], "left")
    return keyed.withColumn("ordinal", F.coalesce("ordinal", F.lit(0))).drop("t")


def _settled_rows(rows: DataFrame) -> DataFrame:
    return rows.repartition("h").sortWithinPartitions("h", "r", "doc", "at").mapInArrow(_settle, "candidate boolean, h long, doc long, at long, n int")


def repeated_ranges(numbered: DataFrame, length: int = LENGTH, crowd_bytes: int = CROWD_BYTES) -> DataFrame:
    """(doc, ordinal, ranges): the windows of each text that begin earlier elsewhere, as (first start, number of starts)."""
    settled = staged(_settled_rows(_anchor_rows(numbered, length)), "records")
    ordinal = F.shiftright("at", ORDINAL_BITS).cast("int").alias("ordinal")
    start = F.col("w.at").bitwiseAND((1 << ORDINAL_BITS) - 1).cast("int")

    def with_bytes(candidates: DataFrame) -> DataFrame:
        wanted = candidates.groupBy("doc", ordinal).agg(F.collect_list(F.struct("h", "at", "n")).alias("wanted"))
        cut = numbered.select("doc", "ordinal", F.col("text").cast("binary").alias("text")).join(wanted, ["doc", "ordinal"])
        return cut.select("doc", "text", F.explode("wanted").alias("w")).select(F.col("w.h").alias("h"), "doc", F.col("w.at").alias("at"), F.substring("text", start + 1, F.col("w.n") + length - 1).alias("data"))

    def merged(candidates: DataFrame) -> DataFrame:
        return with_bytes(candidates).repartition("h").sortWithinPartitions("h", "doc", "at").mapInArrow(_merged(length), "doc long, at long, n int")

    candidates = settled.where("candidate").select("h", "doc", "at", "n")
    repeats = settled.where("not candidate").select("doc", "at", "n")
    crowded = staged(candidates.groupBy("h").agg(F.sum(F.col("n") + length - 1).alias("size")).where(F.col("size") > crowd_bytes).select("h"), "crowded-anchors")
    if crowded.isEmpty():
        repeats = repeats.union(merged(candidates))
    else:
        windows = with_bytes(candidates.join(crowded, "h", "left_semi")).mapInArrow(_windows(length), "h long, r long, doc long, at long, n int")
        repeats = repeats.union(merged(candidates.join(crowded, "h", "left_anti"))).union(_settled_rows(windows).select("doc", "at", "n"))
    return repeats.groupBy("doc", ordinal).agg(F.collect_list(F.struct("at", "n")).alias("ranges"))


def _kept(data: bytes, ranges, length: int) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    if not len(ranges):
        return data, 0, 0
    mask = (1 << ORDINAL_BITS) - 1
    step = np.zeros(len(data) + 1, np.int64)
    first = np.array([r["at"] for r in ranges], np.int64) & mask
    np.add.at(step, first, 1)
    np.add.at(step, first + np.array([r["n"] for r in ranges], np.int64) + length - 1, -1)
    gone = np.cumsum(step)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False, crowd_bytes: int = CROWD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), and the remaining bytes as `kept` on demand."""
    if length % 2 or length <= GRAM + 8:
        raise ValueError(f"length must be even and above {GRAM + 8}")
    numbered = _numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    joined = numbered.select("doc_id", "doc", "ordinal", F.col("text").cast("binary").alias("text")).join(repeated_ranges(numbered, length, crowd_bytes), ["doc", "ordinal"], "left")

    def run(batches):
        for batch in batches_of(batches):
            out = [_kept(t, r or (), length) for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            sizes = [len(t) + n for t, n, _ in out]
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), pa.array([hashlib.sha256(x[0]).hexdigest() for x in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array([x[0] for x in out], pa.binary())] * with_text, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    return joined.select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)


def cut_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with what remains of their texts; parts of a character whose other bytes went are left out, n_chars follows the text."""
    carried = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"))
    numbered = _numbered(rows)
    joined = numbered.join(repeated_ranges(numbered, length), ["doc", "ordinal"], "left")
    cut = F.pandas_udf(lambda texts, ranges: _cut_series(texts, ranges, length), "string")
    text = F.when(F.col("ranges").isNull(), F.col("text")).otherwise(cut("text", "ranges"))
    out = joined.select("row.*", text.alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _cut_series(texts, ranges, length):
    import pandas as pd

    return pd.Series([t if r is None else _kept(t.encode(), r, length)[0].decode(errors="ignore") for t, r in zip(texts, ranges)], dtype=object)
