"""Phrase collocations from counts in weighted acyclic automata.

Texts are gathered into shards of one language. Each shard sorts its n-grams and builds a transducer from n-gram to count; the shards'
transducers are cut at the edges of ranges, and each range unites its parts and sums their weights. Three rounds go from short to
long, as no phrase is more frequent than its parts: words, pairs of frequent words, then runs of three to `longest` words of frequent
pairs only. What a range finds frequent goes back to the shards that hold it (never to all of them). Phrases and the parts they are cut
into are looked up by composing them with the united transducers.

Edges come from a sample of bounded size; they decide where a count is made, never what is counted.

Defined results: null texts are empty, null lang is `und`; repeated rows count each time; other columns are ignored; an empty table gives
no rows. Words are of any length (one text is held by one task).
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabulens.llm.common import batches_of, discard, staged
from tabulens.llm.transducer import Transducer, packed, sort_paths, union, unpacked

#: Bytes of text in a shard.
SHARD_BYTES = 8 << 20
#: Sampled places for the edges at least, such places per range, places at most, and bytes of a word that an edge keeps.
EDGE_SAMPLE, EDGE_PLACES, EDGE_MOST, EDGE_BYTES = 8192, 8, 1 << 18, 64
#: States a range holds on average.
RANGE_STATES = 400_000
LOWER = bytes(range(65, 91))
#: A-Z becomes a-z, a tab a space, and what ends a piece a byte that UTF-8 never has.
BREAK = 0xFF
TABLE = bytes.maketrans(LOWER + b".,;:!?\n\x0b\x0c\r\t", LOWER.lower() + bytes([BREAK]) * 10 + b" ")
WORDS = pa.list_(pa.binary())


def tokens(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, sorted, and the texts as numbers of words, -1 between pieces."""
    data = np.frombuffer(bytes([BREAK]).join(texts).translate(TABLE), np.uint8)
    inside = (data != 32) & (data != BREAK)
    begins = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    piece = np.cumsum(data == BREAK, dtype=np.int32)[begins]
    offsets = np.append(0, np.cumsum(ends - begins)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    stream = np.full(len(begins) + int((piece[1:] != piece[:-1]).sum()), -1, np.int32)
    stream[np.arange(len(begins)) + np.append(0, np.cumsum(piece[1:] != piece[:-1]))[: len(begins)]] = rank[coded.indices.to_numpy()]
    return coded.dictionary.take(pa.array(order)), stream


def _by_frequency(counts: np.ndarray) -> np.ndarray:
    """Order of the word numbers, most frequent first: streams of such ranks pack well."""
    return np.argsort(-counts, kind="stable")


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(shard, lang, total, words, counts, ids): sorted words of a shard, their counts, and its texts as ranks by frequency (0: end of a piece)."""
    schema = pa.schema([("shard", pa.string()), ("lang", pa.string()), ("total", pa.int64()), ("words", WORDS), ("counts", pa.list_(pa.int64())), ("ids", pa.binary())])

    def row(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        words, stream = tokens(texts)
        counts = np.bincount(stream[stream >= 0], minlength=len(words))
        rank = np.zeros(len(words) + 1, np.int64)  # the last entry stays 0, for breaks
        rank[_by_frequency(counts)] = np.arange(1, len(words) + 1)
        columns = [[uuid.uuid4().hex], [lang], [int(counts.sum())], None, [counts], [packed(rank[stream])]]
        lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary()))
        return pa.RecordBatch.from_arrays([lists if c is None else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        for batch in batches_of(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                open_.setdefault(lang, []).append(text)
                held[lang] = held.get(lang, 0) + len(text) + 1
                if held[lang] >= shard_bytes:
                    yield row(lang, open_.pop(lang))
                    del held[lang]
            while sum(held.values()) > 2 * shard_bytes:  # many languages: the fullest shard is closed
                lang = max(held, key=held.get)
                yield row(lang, open_.pop(lang))
                del held[lang]
        for lang, some in open_.items():
            yield row(lang, some)

    source = docs.where("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return source.mapInArrow(run, "shard string, lang string, total long, words array<binary>, counts array<long>, ids binary")


def _ranges(spark: SparkSession, states: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), states // RANGE_STATES + 1)


def _sampling(n: int, states: int, ranges: int) -> tuple[Column, float, Column]:
    """For places that lie evenly over the states of n shards: the shards to look at, the states from one place of a shard to the next, and
    those before its first. Each shard starts at a share of its own, as shards have much the same order: equal shares would meet at few states.
    """
    wanted = min(EDGE_MOST, max(EDGE_SAMPLE, EDGE_PLACES * ranges))
    share = min(1.0, wanted / max(n, 1))
    step = max(1.0, states * share / wanted)
    picked = F.pmod(F.xxhash64("shard"), F.lit(1 << 30)) < int(share * (1 << 30))
    return picked, step, F.pmod(F.xxhash64("shard", F.lit(1)), F.lit(1 << 30)) * F.lit(step / (1 << 30))


def _edges(sample: list, ranges: int) -> list:
    sample = sorted(sample)
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []


def _word_edges(stored: DataFrame) -> list[tuple[str, bytes]]:
    n, states = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    ranges = _ranges(stored.sparkSession, states)
    picked, step, first = _sampling(n, states, ranges)
    last = F.ceil((F.size("words") - F.col("first")) / step) - 1
    places = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.substring(F.get("words", (F.col("first") + i * F.lit(step)).cast("int")), 1, EDGE_BYTES))
    few = stored.where(picked).withColumn("first", first).where(F.size("words") > F.col("first"))
    return _edges([(r[0], bytes(r[1])) for r in few.select("lang", F.explode(places).alias("edge")).where("edge is not null").collect()], ranges)


def frequent_words(stored: DataFrame, least: int) -> DataFrame:
    """Two kinds of rows. (lang, word, gid, n): words with n >= least, numbered in their order within lang. (lang, shard, local, gids): the
    numbers of a shard's words that are frequent, and their gids."""
    edges = _word_edges(stored)

    def deal(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                lang, words, counts = batch.column("lang")[i].as_py(), batch.column("words").slice(i, 1).flatten(), batch.column("counts").slice(i, 1).flatten()
                mine = [w for at, w in edges if at == lang]
                first = bisect_right(edges, (lang, b""))
                # edges of the language are a run of the edges; place them in the shard's sorted words
                cuts = [0, *(_first_not_below(words, w) for w in mine), len(words)]
                for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        offsets = pa.array([0, b - a], pa.int32())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([first + j], pa.int64()), batch.column("lang").slice(i, 1), batch.column("shard").slice(i, 1), pa.array([a], pa.int64()),
                             pa.ListArray.from_arrays(offsets, words.slice(a, b - a)), pa.ListArray.from_arrays(offsets, counts.slice(a, b - a))],
                            ["part", "lang", "shard", "begin", "words", "counts"])

    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("gid", pa.int64()), ("n", pa.int64()), ("shard", pa.string()), ("local", pa.binary()), ("gids", pa.binary())])

    def unite(key, table):
        lang, part = key[0].as_py(), key[1].as_py()
        table = table.combine_chunks()
        words, sizes = pc.list_flatten(table["words"]).combine_chunks(), pc.list_value_length(table["words"]).to_numpy()
        coded = (words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words).dictionary_encode()
        codes = coded.indices.to_numpy()
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, codes, pc.list_flatten(table["counts"]).to_numpy())
        often = np.flatnonzero(total >= least)
        some = coded.dictionary.take(pa.array(often))
        order = pc.array_sort_indices(some).to_numpy()
        gid = np.full(len(total), -1, np.int64)
        gid[often[order]] = (part << 32) + np.arange(len(order))
        rows = {c: [] for c in schema.names}

        def add(**values):
            for c in schema.names:
                rows[c].append(values.get(c))

        for w, g, f in zip(some.take(pa.array(order)).to_pylist(), gid[often[order]].tolist(), total[often[order]].tolist()):
            add(lang=lang, word=w, gid=g, n=f)
        starts = np.append(0, np.cumsum(sizes))
        for shard, begin, a, b in zip(table["shard"].to_pylist(), table["begin"].to_pylist(), starts, starts[1:]):
            mine = gid[codes[a:b]]
            known = np.flatnonzero(mine >= 0)
            if len(known):
                add(lang=lang, shard=shard, local=packed(known + begin), gids=packed(mine[known]))
        return pa.table({c: pa.array(rows[c], schema.field(c).type) for c in schema.names})

    dealt = stored.select("lang", "shard", "words", "counts").mapInArrow(deal, "part long, lang string, shard string, begin long, words array<binary>, counts array<long>")
    return dealt.groupBy("lang", "part").applyInArrow(unite, "lang string, word binary, gid long, n long, shard string, local binary, gids binary")


def _first_not_below(words: pa.Array, bound: bytes) -> int:
    low, high = 0, len(words)
    while low < high:
        mid = (low + high) // 2
        if words[mid].as_py() < bound:
            low = mid + 1
        else:
            high = mid
    return low


def pairs_of_shards(stored: DataFrame, found: DataFrame) -> DataFrame:
    """(shard, lang, codes, gids, states, automaton): runs of three frequent words or more in the texts (one more than their numbers, 0: break), and the transducer of their pairs."""
    known = found.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("local", "gids")).alias("known"))
    joined = stored.select("shard", "lang", "ids", "counts").join(known, "shard")

    def run(batches):
        for batch in batches_of(batches):
            for r in batch.to_pylist():
                local = np.concatenate([unpacked(k["local"]) for k in r["known"]])
                gids = np.concatenate([unpacked(k["gids"]) for k in r["known"]])
                order, words = np.argsort(gids), _by_frequency(np.array(r["counts"], np.int64))
                gids, code = gids[order], np.full(len(words), -1, np.int32)
                code[local[order]] = np.arange(len(order), dtype=np.int32)
                stream = np.append(np.int32(-1), code[words])[unpacked(r["ids"])]
                good = (stream[:-1] >= 0) & (stream[1:] >= 0)
                both = np.flatnonzero(good)
                key, n = np.unique(stream[both].astype(np.int64) * len(gids) + stream[both + 1], return_counts=True)
                made = Transducer.from_sorted(np.stack([gids[key // len(gids)], gids[key % len(gids)]], axis=1), n)
                # of the text only words in runs of three frequent ones stay, and one break between runs
                threes = np.append(good[:-1] & good[1:], [False, False]) if len(stream) > 1 else np.zeros(len(stream), bool)
                inside = threes | np.append(False, threes)[:-1] | np.append([False, False], threes)[: len(stream)]
                stream = np.where(inside, stream, -1)
                stream = stream[inside | np.append(False, inside)[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in ((r["shard"], pa.string()), (r["lang"], pa.string()), (packed(stream + 1), pa.binary()), (packed(gids), pa.binary()), (len(key), pa.int64()), (made.to_bytes(), WORDS))],
                    ["shard", "lang", "codes", "gids", "states", "automaton"])

    return joined.mapInArrow(run, "shard string, lang string, codes binary, gids binary, states long, automaton array<binary>")


def runs_of_shards(coded: DataFrame, pairs: DataFrame, longest: int) -> DataFrame:
    """(shard, lang, states, automaton): the transducer of the runs of 3 to `longest` words whose pairs are all frequent."""
    known = pairs.where("shard is not null").groupBy("shard").agg(F.collect_list("local").alias("known"))
    joined = coded.select("shard", "lang", "codes", "gids").join(known, "shard")

    def run(batches):
        for batch in batches_of(batches):
            for r in batch.to_pylist():
                gids, stream = unpacked(r["gids"]), unpacked(r["codes"]) - 1
                often = np.concatenate([unpacked(k).reshape(-1, 2) for k in r["known"]])
                often = np.sort(np.searchsorted(gids, often[:, 0]) * len(gids) + np.searchsorted(gids, often[:, 1]))
                key = stream[:-1].astype(np.int64) * len(gids) + stream[1:]
                good = (stream[:-1] >= 0) & (stream[1:] >= 0)
                good &= often[np.searchsorted(often, key).clip(0, len(often) - 1)] == key
                good = np.append(good, np.zeros(longest, bool))  # good[i]: words i and i + 1 are a frequent pair
                at = np.flatnonzero(good[:-1] & good[1:])
                steps, alive = [gids[stream[at]], gids[stream[at + 1]]], np.ones(len(at), bool)
                for d in range(1, longest - 1):
                    alive = alive & good[at + d]
                    steps.append(np.where(alive, gids[stream[np.minimum(at + d + 1, len(stream) - 1)]], -1))
                paths, ones = sort_paths(np.stack(steps, axis=1), np.ones(len(at), np.int64))
                made = Transducer.from_sorted(paths, ones, prefixes=3)
                states = sum(len(x[0]) for x in made.layers)
                if states:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in ((r["shard"], pa.string()), (r["lang"], pa.string()), (states, pa.int64()), (made.to_bytes(), WORDS))], ["shard", "lang", "states", "automaton"])

    return joined.mapInArrow(run, "shard string, lang string, states long, automaton array<binary>")


def _path_edges(made: DataFrame, width: int) -> np.ndarray:
    n, states = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("states"), F.lit(0))).first()
    ranges = _ranges(made.sparkSession, states)
    picked, step, first = _sampling(n, states, ranges)

    def sample(batches):
        for batch in batches_of(batches):
            for at, lang, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = []
                for piece in Transducer.of_bytes(parts).pieces():
                    paths, _ = piece.paths()
                    places = np.arange(at, len(paths), step)
                    found.append(paths[places.astype(np.int64), :width])
                    at += len(places) * step - len(paths)
                some = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.tolist(), pa.list_(pa.int64()))], ["lang", "edge"])

    few = made.where(picked).withColumn("first", first).where(F.col("first") < F.col("states")).select("first", "lang", "automaton")
    # languages share the edges
    return np.array(_edges([tuple(r[1]) for r in few.mapInArrow(sample, "lang string, edge array<long>").collect()], ranges), np.int64).reshape(-1, width)


def united(made: DataFrame, least: int, width: int) -> DataFrame:
    """Two kinds of rows. (lang, path, n): paths with a summed weight n >= least. (lang, shard, local): a shard's frequent paths, if width is 2.

    `made` is a stored table of transducers of `width` layers.
    """
    edges = _path_edges(made, width)

    def deal(batches):
        for batch in batches_of(batches):
            for lang, shard, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                cut = [(p, a.to_bytes()) for p, a in Transducer.of_bytes(parts).cuts(edges)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in cut], pa.int64()), pa.array([lang] * len(cut), pa.string()), pa.array([shard] * len(cut), pa.string()), pa.array([a for _, a in cut], WORDS)], ["part", "lang", "shard", "automaton"])

    schema = pa.schema([("lang", pa.string()), ("path", pa.binary()), ("n", pa.int64()), ("shard", pa.string()), ("local", pa.binary())])

    def unite(key, table):
        automata = [Transducer.of_bytes(p) for p in table["automaton"].to_pylist()]
        whole = union(automata)
        paths, total = whole.paths()
        often = total >= least
        found = [encode(p) for p in paths[often]]
        rows = [[key[0].as_py()] * len(found), found, total[often].tolist(), [None] * len(found), [None] * len(found)]
        if width == 2:
            for shard, automaton in zip(table["shard"].to_pylist(), automata):
                mine, _ = automaton.paths()
                mine = mine[whole.compose(mine) >= least]
                if len(mine):
                    for column, value in zip(rows, (key[0].as_py(), None, None, shard, packed(mine))):
                        column.append(value)
        return pa.table({f.name: pa.array(c, f.type) for f, c in zip(schema, rows)})

    dealt = made.select("lang", "shard", "automaton").mapInArrow(deal, "part long, lang string, shard string, automaton array<binary>")
    return dealt.groupBy("lang", "part").applyInArrow(unite, "lang string, path binary, n long, shard string, local binary")


def encode(path: np.ndarray) -> bytes:
    """The labels as 8 bytes each, in an order that is that of the numbers."""
    return path[path >= 0].astype(">i8").tobytes()


def _matrix(paths: list[bytes], depth: int) -> np.ndarray:
    out = np.full((len(paths), depth), -1, np.int64)
    for i, p in enumerate(paths):
        out[i, : len(p) // 8] = np.frombuffer(p, ">i8")
    return out


def looked_up(parts: DataFrame, grams: DataFrame, longest: int) -> DataFrame:
    """(lang, path, n) of all distinct (lang, path) of parts: composed with the transducers of the grams that begin alike."""
    spark = grams.sparkSession
    pieces = _ranges(spark, grams.count())
    bucket = F.pmod(F.xxhash64(F.substring("path", 1, 16)), F.lit(pieces))

    def compose(_, asked, counted):
        paths, n = sort_paths(_matrix(counted["path"].to_pylist(), longest), counted["n"].to_numpy())
        found = Transducer.from_sorted(paths, n).compose(_matrix(asked["path"].to_pylist(), longest))
        return pa.table({"lang": asked["lang"], "path": asked["path"], "n": pa.array(found, pa.int64())})

    asked = parts.select("lang", "path").distinct().withColumn("bucket", bucket).groupBy("lang", "bucket")
    return asked.cogroup(grams.select("lang", "path", "n").withColumn("bucket", bucket).groupBy("lang", "bucket")).applyInArrow(compose, "lang string, path binary, n long")


def counted(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, total), (lang, word, gid) and (lang, path, n): words of each language, frequent words, frequent phrases of 1 to `longest` words."""
    stored = staged(shards(docs), "collocation-shards")
    words = staged(frequent_words(stored, least), "collocation-words")
    coded = staged(pairs_of_shards(stored, words), "collocation-pairs")
    totals = staged(stored.groupBy("lang").agg(F.sum("total").alias("total")), "collocation-totals")
    discard(stored)
    pairs = staged(united(coded, least, 2), "collocation-pair-counts")
    named = words.where("shard is null").select("lang", "word", "gid", "n")
    single = named.select("lang", F.unhex(F.lpad(F.hex("gid"), 16, "0")).alias("path"), "n")
    grams = single.union(pairs.where("shard is null").select("lang", "path", "n"))
    if longest > 2:
        runs = staged(runs_of_shards(coded, pairs, longest), "collocation-runs")
        discard(coded)
        grams = grams.union(united(runs, least, longest).select("lang", "path", "n"))
    return totals, named.drop("n"), staged(grams, "collocation-counts")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    totals, words, grams = counted(docs, least, longest)
    phrases = grams.where(F.length("path") > 8).select("lang", "path", F.col("n").alias("a"))
    size = F.expr("length(path) div 8").cast("int")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumn("first", F.expr("substring(path, 1, 8 * k)")).withColumn("rest", F.expr("substring(path, 8 * k + 1)"))
    parts = cuts.select("lang", F.explode(F.array("first", "rest")).alias("path"))
    known = staged(looked_up(parts, grams, longest), "collocation-parts")
    scored = cuts.join(known.select("lang", F.col("path").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(known.select("lang", F.col("path").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(totals, "lang")
    # 1000 * a * total can pass 64 bits, never 38 digits
    exact = F.expr("cast((cast(1000 * a as decimal(19, 0)) * cast(total as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) as bigint)")
    best = scored.groupBy("lang", "path", "a", F.col("total").alias("n")).agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
    # what lies inside a longer phrase that is as frequent
    inner = phrases.where(size > 2).withColumn("at", F.explode(F.sequence(F.lit(0), size - 2))).withColumn("len", F.explode(F.sequence(F.lit(2), F.least(size - F.col("at"), size - 1))))
    inner = inner.select("lang", F.expr("substring(path, 8 * at + 1, 8 * len)").alias("path"), F.col("a").alias("longer")).groupBy("lang", "path").agg(F.max("longer").alias("longer"))
    left = best.join(inner, ["lang", "path"], "left").where("longer is null or 100 * longer < 100 * a").drop("longer")
    # ties at the end stay until their words are known
    order = [F.col("cut.score").desc(), F.col("a").desc()]
    few = left.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place")
    single = few.withColumn("at", F.explode(F.sequence(F.lit(0), size - 1))).withColumn("gid", F.conv(F.hex(F.expr("substring(path, 8 * at + 1, 8)")), 16, 10).cast("long"))
    named = single.join(words, ["lang", "gid"]).groupBy("lang", "path", "a", "n", "cut").agg(F.sort_array(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word"))))["word"].alias("w"))
    listed = named.withColumn("phrase", F.array_join("w", " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    return listed.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
