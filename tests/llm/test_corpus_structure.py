"""The conversation trie, the source mix and the collocations against brute force, on awkward tables too. Their SQL runs with the registry."""

import hashlib
from bisect import bisect_right
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulens.llm import collocations, mixing, prefix_trie
from tabulens.llm.transducer import Transducer, ranges_of, sort_paths, union


def _brute_trie(rows):
    """rows: (conv_id, turn, role, text), turns without ties."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    nodes, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = set()
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(x[:-1] == q and x for x in nodes)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children), len(leaves), saved, hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return out


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, path long, depth string")


@pytest.mark.parametrize("entries", [200_000, 3])
def test_trie_matches_brute_force(spark, monkeypatch, entries):
    """With three entries a range, most nodes belong to the skeleton."""
    monkeypatch.setattr(prefix_trie, "RANGE_ENTRIES", entries)
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "long " * 50])) for c in range(120) for t in range(rng.randint(1, 7))]
    rows += [(1000 + c, t, "user", "same") for c in range(60) for t in range(12)]  # copies
    rows += [(5000 + 5 * c, t, "user", f"t{t}" if t < 40 else f"own {c}") for c in range(30) for t in range(41)]  # a long common beginning
    rows += [(None, 0, "user", "nobody's"), (77, None, "user", "first of all"), (10**15 + 1, 3, "a", "x" * 100_000)]
    got = prefix_trie.prefix_trie(_conversations(spark, rows)).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == _brute_trie(rows)


def test_trie_of_little(spark):
    assert prefix_trie.prefix_trie(_conversations(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(_conversations(spark, [(None, 0, "user", "x")])).count() == 0
    repeated = [(3, 0, "user", "x"), (3, 0, "user", "x")]
    # conversation 3 keeps what comes after its first h turns: repeated rows are two turns
    h = zlib.crc32(b"3") % 9
    assert prefix_trie.prefix_trie(_conversations(spark, repeated)).count() == 1 + max(0, 2 - h)


def test_skeleton_stays_in_bounds(monkeypatch):
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 40 * prefix_trie.ENTRY)
    turns = [hashlib.sha256(bytes([i])).digest() + bytes(4) for i in range(200)]
    frame = prefix_trie.Skeleton([b"".join(turns[:n]) for n in range(1, 200)], 64)
    assert sum(map(len, frame.paths)) <= 40 * prefix_trie.ENTRY and frame.splitters == sorted(set(frame.splitters))
    assert all(frame.range_of(s) == i + 1 for i, s in enumerate(frame.splitters))


def _documents(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "p") for r in rows], "doc_id long, source string, lang string, text string, size long, slot long, place string")


def _by_source(df):
    out = {}
    for r in df.collect():
        key = (r["source_size"], r["target"])
        out[key] = out.get(key, 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    return out


def test_mix_reaches_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", "é", None, "tiny"]) if i else "tiny2", None, " ".join(["w"] * rng.randint(0, 90))) for i in range(400)]
    rows += [(500, "a", None, None), (None, "b", None, "null id"), (501, "b", None, "x y"), (501, "b", None, "x y"), (502, "void", None, ""), (503, "b", None, "v " * 5000)]
    docs = _documents(spark, rows)
    got = mixing.taken_words(docs)
    assert got.count() == len(rows) and got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    sizes = {}
    for _, s, _, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s]}
        if not more:
            break
        full |= more
    want = {s: float(3 * sizes[s]) if s in full else weight[s] * level for s in order}
    seen = _by_source(got)
    expected = sorted((sizes[s], want[s], int(want[s] + 1e-9)) for s in order)
    assert full and len({sizes[s] for s in order}) == len(order) and np.array(sorted((*k, v) for k, v in seen.items())) == pytest.approx(np.array(expected))
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.taken_words(docs.repartition(7)).collect()))


def test_mix_is_even_all_along(spark):
    """Any stretch of the schedule holds the sources in about their shares, and the mix's words are those counted as taken."""
    rows = [(i, "abc"[i % 3], None, " ".join(f"{'abc'[i % 3]}{i}_{j}" for j in range(50))) for i in range(600)]
    docs = _documents(spark, rows)
    mixed = mixing.mix(docs).toPandas()
    shares = mixed.groupby("source").n_words.sum() / mixed.n_words.sum()
    assert shares.to_dict() == pytest.approx({"a": 0.625, "b": 0.25, "c": 0.125}, abs=1e-3)
    for _, part in mixed.groupby(mixed.slot // 128):
        if part.n_words.sum() > 1500:
            assert (part.groupby("source").n_words.sum() / part.n_words.sum()).to_dict() == pytest.approx(shares.to_dict(), abs=0.06)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(docs).collect()}
    assert mixed.groupby("doc_id").n_words.sum().to_dict() == {k: v for k, v in taken.items() if v}
    words = {}
    for r in mixing.texts(docs, mixing.mix(docs)).collect():
        for w in r["text"].split(" "):
            words[int(w[1:].split("_")[0])] = words.get(int(w[1:].split("_")[0]), 0) + 1
    assert words == {k: v for k, v in taken.items() if v}


def test_mix_of_nothing(spark):
    assert mixing.taken_words(_documents(spark, [])).count() == 0
    got = mixing.taken_words(_documents(spark, [(1, "a", None, ""), (2, None, None, None)])).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def _count_phrases(rows, longest):
    found, totals = {}, {}
    table = str.maketrans({c: "\n" for c in ".,;:!?\n\x0b\x0c\r"})
    for _, _, lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(table).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] = totals.get(lang, 0) + len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    found[key] = found.get(key, 0) + 1
    return found, totals


@pytest.mark.parametrize("settings", [{}, {"SHARD_BYTES": 200, "RANGE_STATES": 5}])
def test_collocations_match_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(9)
    words = ["the", "THE", "of", "é", "a\x00b", "日本", "\x1f", "x" * 300, "new", "york"]
    rows = [(i, None, rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\t", ". ", "\r\n"]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(1, None, "en", None), (1, None, "en", ""), (2, None, "xx", "..., \n"), (3, None, "en", "new york city " * 3000), (3, None, "en", "new york city " * 3000), (4, None, "one", "only " * 40)]
    docs, least = _documents(spark, rows), 12
    shards = settings.get("SHARD_BYTES", collocations.SHARD_BYTES)
    monkeypatch.setattr(collocations, "shards", lambda d, made=collocations.shards: made(d, shards))
    found, totals = _count_phrases(rows, 5)
    often = {k: n for k, n in found.items() if n >= least}
    want = {}
    for (lang, g), a in often.items():
        if len(g) > 1 and not any(len(h) > len(g) and other == lang and 100 * n >= 100 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for (other, h), n in often.items()):
            score, k = min((1000 * a * totals[lang] // (found[lang, g[:k]] * found[lang, g[k:]]), k) for k in range(1, len(g)))
            want.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), found[lang, g[:k]], found[lang, g[k:]]))
    for top in (2000, 3):
        expected = sorted((lang, i + 1, p.decode(), -a, le, r, totals[lang], -s) for lang, some in want.items() for i, (s, a, p, le, r) in enumerate(sorted(some)[:top]))
        got = collocations.collocations(docs, least=least, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == expected
    assert collocations.collocations(docs.limit(0)).count() == 0


def _shards_alike(spark, n, size):
    """Sorted paths of n shards with much the same distribution, and their transducers as a table."""
    rng, rows, every = np.random.default_rng(4), [], []
    for i in range(n):
        paths, ones = sort_paths(rng.integers(0, 400, (size, 2)), np.ones(size, np.int64))
        made = Transducer.from_sorted(paths, ones)
        every.append(made.paths()[0])
        rows.append((f"shard{i}", "en", len(every[-1]), made.to_bytes()))
    return every, spark.createDataFrame(rows, "shard string, lang string, states long, automaton array<binary>")


@pytest.mark.parametrize("n", [20, 200])
def test_ranges_stay_even_with_more_shards_than_places(spark, monkeypatch, n):
    """Shards of one distribution: places at equal shares of each of them would meet at few states."""
    monkeypatch.setattr(collocations, "EDGE_SAMPLE", 100)
    monkeypatch.setattr(collocations, "RANGE_STATES", n * 10)
    every, made = _shards_alike(spark, n, 200)
    edges = collocations._path_edges(made, 2)
    held = sum(np.bincount(ranges_of(p, edges), minlength=len(edges) + 1) for p in every)
    assert len(held) >= 15 and held.max() < 6 * n * 10
    words = [(f"shard{i}", "en", sorted({b"%08d" % (400 * a + b) for a, b in p})) for i, p in enumerate(every)]
    edges = [w for _, w in collocations._word_edges(spark.createDataFrame(words, "shard string, lang string, words array<binary>"))]
    held = np.bincount([bisect_right(edges, w) for _, _, some in words for w in some], minlength=len(edges) + 1)
    assert len(held) >= 15 and held.max() < 6 * n * 10


def test_pieces_of_a_transducer_hold_its_paths_in_order():
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 9, (400, 4))
    rows[rng.random(400) < 0.3, 3] = -1
    whole = Transducer.from_sorted(*sort_paths(rows, np.ones(400, np.int64)), prefixes=3)
    paths, weights = whole.paths()
    order = np.lexsort(paths.T[::-1])
    assert (order == np.arange(len(paths))).all() and weights.min() > 0
    edges = np.unique(rng.integers(0, 9, (6, 4)), axis=0)
    for states in (1, 100, 10**6):
        pieces = [p.paths() for p in whole.pieces(states)]
        assert len(pieces) == {1: 9, 10**6: 1}.get(states, len(pieces))
        assert (np.concatenate([p for p, _ in pieces]) == paths).all() and (np.concatenate([w for _, w in pieces]) == weights).all()
    assert (np.concatenate([p.paths()[0] for _, p in whole.cuts(edges)]) == paths).all()
    assert list(whole.pieces(1))[0].layers[0][0].base is not None


def test_runs_of_one_beginning_are_cut_too(spark, monkeypatch):
    """All runs begin with the same three words; a range still holds only some of them."""
    monkeypatch.setattr(collocations, "RANGE_STATES", 50)
    rng, rows, want = np.random.default_rng(5), [], {}
    for i in range(10):
        runs = np.concatenate([np.tile([1, 2, 3], (60, 1)), rng.integers(0, 30, (60, 2))], axis=1)
        runs[rng.random(60) < 0.2, 4] = -1
        paths, ones = sort_paths(runs, np.ones(60, np.int64))
        rows.append((f"shard{i}", "en", 200, Transducer.from_sorted(paths, ones, prefixes=3).to_bytes()))
        for r in runs.tolist():
            for k in range(3, 6):
                if min(r[:k]) >= 0:
                    want[tuple(r[:k])] = want.get(tuple(r[:k]), 0) + 1
    made = spark.createDataFrame(rows, "shard string, lang string, states long, automaton array<binary>")
    assert len(collocations._path_edges(made, 5)) > 10
    got = {tuple(np.frombuffer(r["path"], ">i8").tolist()): r["n"] for r in collocations.united(made, 3, 5).collect()}
    assert got == {k: n for k, n in want.items() if n >= 3}


def test_scores_beyond_64_bits(spark):
    """The product of a, n and 1000 takes 70 bits here; the quotient is exact."""
    a, total = 10**8 + 7, 10**13 + 9
    got = spark.createDataFrame([(a, total, a, a)], "a long, total long, l long, r long").select(F.expr(
        "cast((cast(1000 * a as decimal(19, 0)) * cast(total as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) as bigint)")).first()[0]
    assert got == 1000 * a * total // (a * a)


def test_transducers():
    rng = np.random.default_rng(1)
    parts, want = [], {}
    for _ in range(4):
        rows = rng.integers(0, 4, (300, 4))
        rows[rng.random(300) < 0.4, 3] = -1
        rows[(rows[:, 3] < 0) & (rng.random(300) < 0.3), 2] = -1
        paths, ones = sort_paths(rows, np.ones(300, np.int64))
        parts.append(Transducer.of_bytes(Transducer.from_sorted(paths, ones).to_bytes()))
        for r in map(tuple, rows.tolist()):
            want[r] = want.get(r, 0) + 1
    whole = union(parts)
    paths, weights = whole.paths()
    assert dict(zip(map(tuple, paths.tolist()), weights.tolist())) == want
    asked = rng.integers(-1, 6, (500, 4))
    asked[(asked[:, 0] < 0)] = 0
    for d in range(1, 4):
        asked[asked[:, d - 1] < 0, d] = -1
    assert whole.compose(asked).tolist() == [want.get(r, 0) for r in map(tuple, asked.tolist())]
    edges = np.unique(rng.integers(0, 4, (3, 2)), axis=0)
    cut = whole.cut(edges)
    assert sum(len(p.paths()[0]) for _, p in cut) == len(want)
    for number, part in cut:
        assert all(sum(tuple(e) <= r[:2] for e in edges.tolist()) == number for r in map(tuple, part.paths()[0].tolist()))
    counting = Transducer.from_sorted(*sort_paths(np.array([[1, 2, 3], [1, 2, -1], [1, 2, 3]]), np.ones(3, np.int64)), prefixes=2)
    assert counting.compose(np.array([[1, 2, -1], [1, 2, 3], [1, -1, -1]])).tolist() == [3, 2, 0]
