"""SimHash near-duplicate groups: pigeonhole blocks, a join on them, Hamming checks, connected components.

Fingerprints within `distance` bits are linked. The 64 bits are cut into `blocks` blocks; a linked pair differs in at most `distance`
of them, so it agrees on at least `blocks - distance` blocks, and one of the combinations of that many blocks is a key both share.
The join runs over distinct fingerprints: copies of a text never meet each other.

Defined results: a null or empty text has fingerprint 0 and is linked like any other; rows sharing a doc_id each get a row; a null
doc_id is no candidate for `component_id` (null if a component has no other); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tabulens.llm.common import batches_of, staged
from tabulens.llm.components import connected_components

#: Shingles whose bits are counted at once, so a very long text needs no more memory.
CHUNK = 1 << 15


def simhash(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The unsigned fingerprint of one text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(words, len(parts))
    starts, ends = starts[: len(parts) - n + 1].tolist(), ends[n - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * set_bits > len(starts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42, id_type: str = "long") -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""

    def run(batches):
        for batch in batches_of(batches):
            values = [simhash(t, words, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast(id_type).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"doc_id {id_type}, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """A signed 64-bit mask for every combination of `blocks - distance` blocks."""
    if not 0 <= distance < blocks <= 64:
        raise ValueError("distance must be at least 0 and below blocks, blocks at most 64")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [_signed(sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in c)) for c in combinations(range(blocks), blocks - distance)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(prints: DataFrame, distance: int = 4, blocks: int = 7, crowd: int = 2048) -> DataFrame:
    """(a, b): edges between the distinct fingerprints `fp` that connect everything within `distance` bits.

    Buckets of up to `crowd` fingerprints are joined with themselves and their pairs verified. In a larger one (thousands of different
    fingerprints that agree on a combination of blocks) pairs would grow with its square, so its members meet through the values that
    differ from them in at most half of `distance` bits: two fingerprints within an even `distance` share such a value, and two that
    share one are within `distance`. Every member is linked to the smallest of each value, which is linear in the bucket and exact.
    """
    if distance % 2:
        raise ValueError("an even distance is needed")
    masks = block_masks(blocks, distance)
    keyed = prints.select("fp", F.posexplode(F.lit(masks))).select("fp", F.col("pos").alias("way"), F.col("fp").bitwiseAND(F.col("col")).alias("key"))
    keyed = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("way", "key")))
    few = keyed.where(f"n between 2 and {crowd}")
    a = few.select("way", "key", F.col("fp").alias("a"))
    b = few.select("way", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # a pair that agrees on more blocks than needed is taken under the first combination only
    earlier = F.exists(F.slice(F.lit(masks), 1, F.col("way")), lambda m: F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(m) == 0)
    pairs = a.join(b, ["way", "key"]).where((F.col("a") > F.col("b")) & near & ~earlier).select("a", "b")
    flips = [_signed(sum(1 << i for i in c)) for k in range(distance // 2 + 1) for c in combinations(range(64), k)]
    crowded = keyed.where(f"n > {crowd}").select("fp").distinct()
    values = crowded.select("fp", F.explode(F.lit(flips)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    centres = values.groupBy("value").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = values.join(centres, "value").where("fp > b").select(F.col("fp").alias("a"), "b").distinct()
    return pairs.union(stars)


def _classes(firsts: DataFrame, distance: int, blocks: int, crowd: int) -> DataFrame:
    """The rows (fp, ...) of different fingerprints, each with the root of its component."""
    roots = connected_components(links(firsts.select("fp"), distance, blocks, crowd))
    return firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42, distance: int = 4, blocks: int = 7, crowd: int = 2048
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest doc_id reachable over links."""
    prints = staged(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    firsts = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    labelled = _classes(firsts, distance, blocks, crowd)
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = labelled.join(smallest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, words: int = 4, seed: int = 42, distance: int = 4, blocks: int = 7, crowd: int = 2048) -> DataFrame:
    """The rows of one document per group: that with the smallest doc_id, of several texts under it the one with the smallest fingerprint and
    text hash. Repeated rows of it count as one, rows without doc_id stay."""
    key, digest = docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    prints = staged(fingerprints(docs.where("doc_id is not null").select(F.struct(key.alias("id"), digest.alias("h")).alias("d"), "text"), "d", "text", words, seed, "struct<id:bigint,h:bigint>"), "fingerprints")
    firsts = staged(prints.groupBy("fp").agg(F.min(F.struct("doc_id.id", "fp", "doc_id.h")).alias("first")), "distinct-fingerprints")
    kept = _classes(firsts, distance, blocks, crowd).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.id").alias("kept_id"), F.col("first.h").alias("kept_h"))
    taken = set(docs.columns)
    mark = next(n for n in (f"hash{i}" for i in range(len(taken) + 1)) if n not in taken)
    named = docs.withColumn(mark, digest).join(kept, (key == kept["kept_id"]) & (F.col(mark) == kept["kept_h"]), "left_semi").dropDuplicates(["doc_id", mark]).drop(mark)
    return named.union(docs.where("doc_id is null"))
