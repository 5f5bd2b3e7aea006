"""Prefix trie of conversations, built from sorted shards around the skeleton of the splitter paths.

A conversation is the path of its turns; a turn is an entry of ENTRY bytes (SHA-256 of role and text, bytes of the text), so paths compare
as binary strings and conversations with a common beginning lie side by side. Splitter paths, drawn from a sample of bounded size, cut the
sorted order into ranges. A node reaches beyond one range only if its path begins a splitter: these nodes form the skeleton, which is
broadcast. Each range is sorted by itself and its task finishes every other node with a stack of open nodes; for skeleton nodes it reports
partial aggregates, which are reduced by node and then folded up the skeleton.

Equal conversations meet before the ranges are dealt: their ids are joined in blocks of BLOCK ids (each in one bounded group), and the
blocks of a path are hashed in order as a stream, so no task holds the ids of a large group of copies.

Defined results: rows without conversation id belong to no conversation and are left out; null role or text counts as empty; turns come in
ascending order, null first, ties by the digest of role and text; repeated rows are repeated turns; other columns are ignored; an empty
table gives no rows (not even a root). One conversation's entries (36 bytes a turn, not its texts) are handled in one task.
"""

from __future__ import annotations

import hashlib
import itertools
import os.path
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulens.llm.common import staged

DIGEST, SIZE = 32, 4
ENTRY = DIGEST + SIZE
#: Width of a block of ids that are joined together.
BLOCK = 4096
#: Bytes of paths that are sampled for the splitters, and bytes the skeleton may have.
SAMPLE_BYTES, SKELETON_BYTES = 4 << 20, 8 << 20
#: Entries a range holds on average.
RANGE_ENTRIES = 200_000
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: `inner`: number of the skeleton node that the row is a part of; `up`: number of the skeleton node above it.
PART = f"inner int, up int, {NODE}"


def own_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the entries of each conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text)
    entry = F.unhex(F.concat(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), F.lpad(F.hex(size), 2 * SIZE, "0")))
    rows = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", entry.alias("entry")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["entry"].alias("turns"))


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the first h turns of conversation c - c % 5, then the own turns after the first h; h = crc32(c) % 9."""
    own = own_paths(conversations)
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    base = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("first"))
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(base, "base", "left")
    head = F.slice(F.coalesce("first", F.array().cast("array<binary>")), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.unhex(F.array_join(F.transform(F.concat(head, tail), F.hex), "")).alias("path"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, n, least, sha): from blocks in the order of path and block; the hash goes on over the blocks of a path."""
    path = running = None
    n = least = 0
    out: list[tuple] = []
    for batch in batches:
        for p, count, first, text in zip(*(c.to_pylist() for c in batch.columns)):
            if p != path or running is None:
                if running is not None:
                    out.append((path, n, least, running.hexdigest()))
                path, running, n, least = p, hashlib.sha256(text.encode()), count, first
            else:
                running.update(b"," + text.encode())
                n, least = n + count, min(least, first)
        if len(out) > 5000:
            yield _rows(out, ("path", "n", "least", "sha"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))
            out = []
    if running is not None:
        out.append((path, n, least, running.hexdigest()))
    yield _rows(out, ("path", "n", "least", "sha"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))


def _rows(rows: list[tuple], names: tuple, types: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """(path, n, least, sha): each distinct path with the number of its conversations, the smallest id and the hash of all ids."""
    ids = F.sort_array(F.collect_list("conv_id"))
    # floor, not truncation: blocks follow the order of the ids below zero as well
    blocks = paths.groupBy("path", F.floor(F.col("conv_id") / F.lit(BLOCK)).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids"))
    ordered = blocks.repartition("path").sortWithinPartitions("path", "block").select("path", "n", "least", "ids")
    return ordered.mapInArrow(_ends, "path binary, n long, least long, sha string")


class Skeleton:
    """The trie of the splitter paths. Node i has path `paths[i]`; nodes are in sorted order, so parents come before their children."""

    def __init__(self, sample: list[bytes], ranges: int):
        sample = sorted(set(sample))
        chosen = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)} if sample else set())
        while True:
            self.splitters = self._shortened(chosen)
            nodes = {s[:at] for s in self.splitters for at in range(0, len(s) + 1, ENTRY)} | {b""}
            if sum(map(len, nodes)) <= SKELETON_BYTES or not chosen:
                break
            chosen = chosen[::2] if len(chosen) > 1 else []
        self.paths = sorted(nodes)
        self.number = {p: i for i, p in enumerate(self.paths)}
        self.parents = [-1 if not p else self.number[p[:-ENTRY]] for p in self.paths]

    @staticmethod
    def _shortened(chosen: list[bytes]) -> list[bytes]:
        """Each splitter up to the first turn that tells it from both neighbours: the order stays."""
        common = [0, *(len(os.path.commonprefix([a, b])) // ENTRY for a, b in itertools.pairwise(chosen)), 0]
        return [s[: (max(common[i], common[i + 1]) + 1) * ENTRY] for i, s in enumerate(chosen)]

    def range_of(self, path: bytes) -> int:
        return bisect_right(self.splitters, path)


def skeleton(paths: DataFrame) -> Skeleton:
    """Splitters from about SAMPLE_BYTES of paths; only these reach the driver."""
    # every path counts as one entry more: the root's path is empty
    total = paths.agg(F.sum(F.length("path") + ENTRY)).first()[0] or 0
    share = min(1.0, SAMPLE_BYTES / max(total, 1))
    picked = paths.where(F.pmod(F.xxhash64("path"), F.lit(1 << 30)) < int(share * (1 << 30))).select("path")
    return Skeleton([bytes(r[0]) for r in picked.toLocalIterator()], total // (RANGE_ENTRIES * ENTRY) + 2 * _parallel(paths.sparkSession))


def _parallel(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class _Open:
    """A node whose subtree is being read."""

    __slots__ = ("children", "inner", "leaves", "least", "n", "rows", "saved", "sha", "size")

    def __init__(self, size: int, inner: int):
        self.size, self.inner = size, inner
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.sha, self.rows = None, NOTHING, []


def _finish(frame: Skeleton, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Finished nodes and parts of skeleton nodes, from the sorted distinct paths of one or more ranges."""
    stack, last = [_Open(0, 0)], b""
    done: list[tuple] = []

    def close() -> None:
        node, above = stack.pop(), stack[-1] if stack else None
        if above is not None:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.inner >= 0:
            done.append((node.inner, None, node.least, len(stack), None, node.n, node.children, node.leaves, node.saved, node.sha))
            return
        leaves, saved = node.leaves + (not node.children), node.saved + (node.n - 1) * node.size
        above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
        row = (node.least, len(stack), node.n, node.children, leaves, saved, node.sha)
        done.extend((None, None, least, depth, node.least, *rest) for least, depth, *rest in node.rows)
        if above.inner >= 0:
            done.append((None, above.inner, node.least, len(stack), None, *row[2:]))
        else:
            above.rows.append(row)

    empty = True
    for path, n, least, sha in rows:
        empty = False
        depth = len(path) // ENTRY
        shared = len(os.path.commonprefix([last, path])) // ENTRY
        while len(stack) - 1 > shared:
            close()
        for d in range(len(stack), depth + 1):
            inner = frame.number.get(path[: d * ENTRY], -1) if stack[-1].inner >= 0 else -1
            stack.append(_Open(int.from_bytes(path[d * ENTRY - SIZE : d * ENTRY], "big"), inner))
        node = stack[-1]
        node.n, node.sha, node.least = n, sha, least
        last = path
        if len(done) > 5000:
            yield from done
            done.clear()
    while stack and not empty:
        close()
    yield from done


def trie(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, path), columns of NODE."""
    spark = paths.sparkSession
    distinct = staged(distinct_paths(paths), "trie-paths")
    frame = skeleton(distinct)
    shared = spark.sparkContext.broadcast(frame)  # at most SKELETON_BYTES of paths

    def deal(batches):
        for batch in batches:
            number = [shared.value.range_of(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), *batch.columns], ["part", *batch.schema.names])

    schema = pa.schema([("inner", pa.int32()), ("up", pa.int32()), *((c, pa.string() if c == "ends_sha256" else pa.int64()) for c in (x.split()[0] for x in NODE.split(", ")))])

    def finish(batches):
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4))))
        found = _finish(shared.value, rows)
        while some := list(itertools.islice(found, 10_000)):
            yield _rows(some, schema.names, schema.types)

    dealt = distinct.mapInArrow(deal, "part int, path binary, n long, least long, sha string").repartition(max(len(frame.splitters) + 1, _parallel(spark)), "part")
    parts = staged(dealt.sortWithinPartitions("path").select("path", "n", "least", "sha").mapInArrow(finish, PART), "trie-nodes")
    # one row per skeleton node: as bounded as the skeleton
    reduced = parts.where("inner is not null").groupBy("inner").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max(F.when(F.col("ends_sha256") != NOTHING, F.col("ends_sha256")))).collect()
    inner = spark.createDataFrame(_fold(frame, {r[0]: tuple(r)[1:] for r in reduced}), f"number int, {NODE}")
    above = F.broadcast(inner.select(F.col("number").alias("up"), F.col("conv_id").alias("above")))
    outer = parts.where("inner is null").join(above, "up", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    names = [x.split()[0] for x in NODE.split(", ")]
    return outer.select(*names).union(inner.select(*names))


def _fold(frame: Skeleton, sums: dict[int, tuple]) -> list[tuple]:
    """The rows of the skeleton nodes: children come after their parents, so one pass from the end adds them up."""
    state = {i: list(sums[i]) for i in range(len(frame.paths)) if i in sums}
    for i in reversed(state):
        least, n, children, leaves, saved, _ = state[i]
        path = frame.paths[i]
        leaves += not children
        saved += (n - 1) * int.from_bytes(path[-SIZE:], "big") if path else 0
        state[i][3:5] = leaves, saved
        if path:
            above = state[frame.parents[i]]
            above[2], above[3], above[4] = above[2] + 1, above[3] + leaves, above[4] + saved
    return [
        (i, least, len(frame.paths[i]) // ENTRY, state[frame.parents[i]][0] if frame.paths[i] else None, n, children, leaves, saved, sha or NOTHING)
        for i, (least, n, children, leaves, saved, sha) in state.items()
    ]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return trie(rebuilt_paths(conversations))
