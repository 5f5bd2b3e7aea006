"""Every operator against a brute-force version, a round trip or held-out labels, and on awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tabulens.llm import chat, language_id, packing, pieces, queries, quality_rules, simhash, sketches, suffix_dedup, toxicity, warc
from tabulens.llm.common import staged, table
from tabulens.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (1, None, "en"), (2, "", None), (3, "a", "en"), (4, " \n\t ", "de"), (4, " \n\t ", "de"), (5, "Wort " * 9000, "de"), (6, "x" * 70_000, "en"), (None, "null id, some words", "en"),
    (7, "éà ### </turn> \\ ▁ <|endoftext|> \U0001f600", None), (8, "the same text again " * 8, "en"), (9, "the same text again " * 8, "en"), (9, "another text of one id", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns named as the operators' own."""
    rows = [(i, t, lang, "s", 0, 1, "k", 2) for i, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, fp string, start int")


def test_quality_counts(spark, docs, texts):
    got = {r["doc_id"]: r for r in queries.op1_quality_rules(spark, FOLDER).collect()}
    for i, text in texts.items():
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        windows = [tuple(words[j : j + 3]) for j in range(len(words) - 2)]
        covered = {j + k for j, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 400 else None
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        if covered is not None:
            assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(words) < 50 or 100 * r["n_repeat_words"] > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_quality_verdict_follows_labels(spark):
    folder = "/root/testdata/sf0.01"
    joined = queries.op1_quality_rules(spark, folder).join(table(spark, folder, "labels"), "doc_id").where("not base_failed")
    assert joined.where("kept = (quality = 1)").count() >= 0.98 * joined.count()


def test_quality_posteriors_match_brute_force(spark):
    """Expectation-maximisation over the documents themselves; its verdict isn't that of any rule."""
    folder = "/root/testdata/sf0.01"
    rows = queries.op1_quality_rules(spark, folder).collect()
    votes = np.array([[r["pattern"] // 3**j % 3 for j in range(len(quality_rules.RULES))] for r in rows])
    good = ((votes == 2).sum(1) + 1) / ((votes != 1).sum(1) + 2)
    for _ in range(quality_rules.ITERATIONS):
        odds = np.full(len(rows), np.log((good.sum() + 1) / ((1 - good).sum() + 1)))
        for j in range(votes.shape[1]):
            for v in range(3):
                hit = votes[:, j] == v
                odds[hit] += np.log((good[hit].sum() + 1) / (good.sum() + 3)) - np.log(((1 - good)[hit].sum() + 1) / ((1 - good).sum() + 3))
        good = 1 / (1 + np.exp(-odds))
    assert np.array([r["posterior"] for r in rows]) == pytest.approx(good, abs=1e-9)
    assert [r["kept"] for r in rows] == [bool(g >= 0.5 and not r["base_failed"]) for g, r in zip(good, rows)]
    against, kept, met = (votes == 0).any(1), np.array([r["kept"] for r in rows]), np.array([not r["base_failed"] for r in rows])
    assert (against & kept).any() and (~kept & met & (votes == 2).any(1)).any()


def test_kept_rows_have_any_column_names(spark):
    frame = spark.createDataFrame([("some words. " * 40, 1, 2, 3)], "text string, _quality_of int, `a.b` int, __quality_x int")
    assert quality_rules.keep_good(frame).columns == frame.columns
    cut = suffix_dedup.cut_documents(frame.withColumn("doc_id", F.lit(1)))
    assert cut.columns == [*frame.columns, "doc_id"] and cut.first()["a.b"] == 2


def test_simhash_matches_brute_force(spark, docs, texts):
    def brute(text):
        words = text.encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    prints = {i: brute(t) for i, t in texts.items()}
    ids, parent = sorted(prints), {}
    find = lambda x: x if parent.get(x, x) == x else find(parent[x])
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op3_simhash(spark, FOLDER).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}
    assert sorted(r["doc_id"] for r in simhash.keep_representatives(docs).collect()) == sorted({find(i) for i in ids})


def test_crowded_buckets_link_the_same(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(60)} | {rng.getrandbits(64) for _ in range(60)}
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    roots = lambda crowd: sorted(map(tuple, connected_components(simhash.links(frame, crowd=crowd)).collect()))
    assert roots(2) == roots(2048)


def test_representative_of_an_id_with_two_texts(spark):
    """The text that is the smallest of its group stays, not the one whose group has a smaller id."""
    copied, other = " ".join(f"word{i}" for i in range(40)), " ".join(f"Wort{i * 7}" for i in range(40))
    rows = [(2, copied), (5, copied), (5, other), (9, other)]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        assert sorted(map(tuple, simhash.keep_representatives(frame).collect())) == [(2, copied), (5, other)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}


def _brute_repeats(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        data = texts[i].encode()
        gone = np.zeros(len(data), bool)
        for j in range(len(data) - 99):
            w = data[j : j + 100]
            if w in seen:
                gone[j : j + 100] = True
            seen.add(w)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i] = (i, len(data), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_matches_brute_force(spark, texts):
    assert {r[0]: tuple(r) for r in queries.op2_suffix_dedup(spark, FOLDER).collect()} == _brute_repeats(texts)


def test_crowded_anchors_give_the_same(spark, docs, texts):
    assert {r[0]: tuple(r) for r in suffix_dedup.remove_repeats(docs, crowd_bytes=300).collect()} == _brute_repeats(texts)


@pytest.mark.parametrize("alphabet", [b"ab", b"abc \n\xc3\xa9"])
def test_merged_transforms_find_all_repeats(alphabet):
    rng = random.Random(5)
    base = bytes(rng.choice(alphabet) for _ in range(700))
    some = [base[i : i + 300] for i in range(0, 400, 41)] + [b"a" * 230, b"", b"short"] + [bytes(rng.choice(alphabet) for _ in range(200)) for _ in range(9)]
    want: dict[bytes, set] = {}
    for i, t in enumerate(some):
        for j in range(len(t) - 99):
            want.setdefault(t[j : j + 100], set()).add((i, j))
    got: dict[int, set] = {}
    for block, text, start in zip(*(x.tolist() for x in suffix_dedup.merge_shards(some, 100, 500))):
        got.setdefault(block, set()).add((text, start))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_repeats_across_small_random_texts(spark):
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcd é") for _ in range(rng.randint(60, 400))) for _ in range(8)]
    made = {i: "".join(rng.sample(pool, rng.randint(1, 3))) + "z" * rng.choice([0, 150]) for i in range(40)}
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(5)
    assert {r[0]: tuple(r) for r in suffix_dedup.remove_repeats(frame).collect()} == _brute_repeats(made)


def test_piece_encoding(spark, odd):
    vocabulary = pieces.Pieces.of(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    words = {"▁" + "".join(rng.choice("aeinrst.é日") for _ in range(rng.randint(0, 12))) for _ in range(300)}
    vocabulary.learn(words)
    assert all(vocabulary.known[w] == vocabulary._bytes(vocabulary.slow(w)) for w in words)
    encoded = pieces.encode(odd, with_ids=True)
    assert encoded.where("not round_trip").count() == 0
    assert sorted(r["text"] for r in pieces.decode(encoded).collect()) == sorted(t or "" for _, t, _ in ODD)


def test_archives(spark, tmp_path):
    long = "<p>" + "word " * 300
    rows = [(1, "http://a/ b", long), (2, None, long), (3, "http://c", None), (4, "d", "short"), (5, "e", "short"), (None, "f", long), (6, "g", "é\r\n\r\n" * 400), (6, "g", "é\r\n\r\n" * 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/archives"
    written = staged(warc.write(pages, folder), "warc-files")
    assert written.agg(F.sum("records")).first()[0] == len(rows)
    # what a lost attempt left behind isn't read
    warc.write(pages, folder).count()
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"]) for r in warc.read(written, folder, with_payload=True).collect())
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html == long and i != 2
        want.append((i or 0, "revisit" if revisit else "response", 2 if revisit else None, len(data), hashlib.sha1(data).hexdigest(), b"" if revisit else data))
    assert got == sorted(want)
    assert warc.read(staged(warc.write(pages.limit(0), folder), "warc-files"), folder).count() == 0
    with pytest.raises(Exception, match="records instead of"):
        warc.read(written.withColumn("records", F.col("records") + 1), folder).count()


def test_archived_pages_match_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in table(spark, folder, "pages").select("page_id", "html").collect()]
    largest = {}
    for i, data in rows:
        if len(data) >= 1000:
            largest[data] = max(i, largest.get(data, i))
    want = [(i, len(d), hashlib.sha1(d).hexdigest(), "response" if largest.get(d, i) == i else "revisit", None if largest.get(d, i) == i else largest[d]) for i, d in rows]
    assert sorted(map(tuple, queries.op5_warc(spark, folder).collect()), key=str) == sorted(want, key=str)


def test_broken_archives_are_refused():
    data = warc.archive([warc.record(1, "u", b"payload" * 300, None)])
    assert [warc.parse(x)[1] for x in warc.frames(data)] == [b"payload" * 300]
    for broken in (data[:-5], b"no archive", data[:40]):
        with pytest.raises(ValueError):
            list(warc.frames(broken))
    whole = warc.record(1, "u", b"payload", None)
    for wrong in (whole.replace(b"payload\r\n", b"payloaD\r\n"), whole[:-1], whole.replace(b"WARC/1.1", b"WARC/9"), whole.replace(b"WARC-Date", b"Date")):
        with pytest.raises(ValueError):
            warc.parse(wrong)


def test_fingerprints(spark, texts):
    got = {r["doc_id"]: r for r in queries.op6_fingerprints(spark, FOLDER).collect()}
    ids = sorted(texts)

    def kept(text):
        words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ")
        words = [w for w in words if w]
        out = set()
        for i in range(len(words) - 4):
            h = 42
            for w in words[i : i + 5]:
                h = xxhash.xxh64_intdigest(w.encode(), h)
            out.add(h)
        if 0 < len(words) < 5:
            out.add(xxhash.xxh64_intdigest(" ".join(words).encode(), 42))
        signed = sorted(simhash._signed(h) for h in out)
        return len(out), [h for h in signed if h < -(1 << 63) + (1 << 64) // sketches.FRACTION]

    for i, after in zip(ids, ids[1:] + ids[:1]):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        n, own = kept(text)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == f"{n}:" + "".join(f"{h & (1 << 64) - 1:016x}" for h in own)
        other = kept(edited)[1]
        if own or other:
            assert r["near_edited"] == pytest.approx(len(set(own) & set(other)) / len(set(own) | set(other)))


def test_fingerprints_of_few_shingles(spark):
    """Sets without a retained hash are compared by all their hashes: unrelated texts of equal count share nothing, equal texts all."""
    signed = lambda t: simhash._signed(xxhash.xxh64_intdigest(t.encode(), 42))
    bare = [w for w in (f"word{i}" for i in range(200)) if signed(w) >= 0][:3]
    made = dict(enumerate([bare[0], bare[1], bare[2], bare[2]]))
    for fraction in (2, 8):
        got = {r["doc_id"]: r for r in sketches.compare_edited(spark.createDataFrame(list(made.items()), "doc_id long, text string"), fraction=fraction).collect()}
        assert [got[i]["near_next"] for i in range(4)] == [0, 0, 1, 0] and [got[i]["within_next"] for i in range(4)] == [0, 0, 1, 0]
        assert got[0]["fingerprint"] == f"1::{signed(bare[0]):016x}" and len({r["fingerprint"] for r in got.values()}) == 3


def test_short_texts_keep_hashes(spark):
    folder = "/root/testdata/sf0.1"
    short = table(spark, folder, "documents").where("size(split(text, ' ')) between 20 and 60")
    got = sketches.with_shingles(short, "text", "all").select(F.size("all").alias("n"), F.size(sketches.sketch(F.col("all"))).alias("kept"))
    assert got.where("n > 12 and kept = 0").count() == 0 < got.where("n > 12").count()


def test_packing(spark, odd, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces_ = queries.op7_packing(spark, FOLDER).toPandas()
    for i, own in pieces_.groupby("doc_id"):
        ids, at = tokenizer.encode(texts[i], add_special_tokens=False).ids + [1], 0
        for _, p in own.sort_values("start").iterrows():
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes()))
            at += p.length
        assert at == len(ids)
    sizes = pieces_.groupby("sequence_id").length.sum()
    assert set(pieces_.doc_id) == set(texts) and all(0 < s <= 2048 and s & (s - 1) == 0 for s in sizes)
    for _, own in pieces_.sort_values("offset").groupby("sequence_id"):
        assert (own.offset.to_numpy() == np.append(0, own.length.cumsum().to_numpy()[:-1])).all()
    some = packing.pack(odd, capacity=64, max_open=3, with_ids=True).toPandas()
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(map(len, some.ids)) == some.length.sum() == sum(len(x) // 4 for x in words.encode([t for _, t, _ in ODD], 1))
    for text in ["don't 'll it's 's, 12", "a\r\nb <|endoftext|>\n <|endoftext|>q", "ΑΣ. İ ŉ ét. Å", "日本語 1２ ª² ''s \x00"]:
        assert np.frombuffer(words.encode([text], 1)[0], "<u4").tolist()[:-1] == tokenizer.encode(text, add_special_tokens=False).ids


def test_sum_of_squares_choice():
    packer, rng = packing.Packer(64), random.Random(2)
    for n in range(300):
        size = rng.randint(1, 63)
        level, before = packer.choose(size), packer.levels.copy()

        def cost(h):
            after = before.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 64
            return int((after[1:] ** 2).sum())

        options = [h for h in range(64 - size + 1) if h == 0 or before[h]]
        assert cost(level) == min(map(cost, options))
        packer.add(n, b"\0" * 4 * size)


def test_languages_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op8_language_id(spark, folder).where("held_out").join(table(spark, folder, "documents"), "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.where("lang is not null").count()


def test_unlearned_languages_go(spark):
    """Clean texts of the learned languages stay; texts of one that was left out, random letters and unwanted languages go."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang").where("lang is not null and length(text) >= 300")
    learned = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    rng = random.Random(4)
    noise = spark.createDataFrame([(-i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(80)), "xx") for i in range(1, 41)], docs.schema)
    share = lambda kept, all_: {r["lang"]: r["n"] / r["all"] for r in all_.groupBy("lang").agg(F.count("*").alias("all")).join(kept.groupBy("lang").agg(F.count("*").alias("n")), "lang").collect()}
    full = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    clean = docs.where(language_id.held_out(F.col("doc_id"))).union(noise)
    kept = share(language_id.keep_identified(clean, full), clean)
    assert "xx" not in kept and all(kept[x] >= 0.99 for x in learned), kept
    assert set(share(language_id.keep_identified(clean, full, wanted=learned[:1]), clean)) <= set(learned[:2])
    fewer = language_id.fit(docs.where(F.col("lang") != learned[0]).where(~language_id.held_out(F.col("doc_id"))))
    kept = share(language_id.keep_identified(clean, fewer), clean)
    assert kept.get(learned[0], 0) <= 0.05 and all(kept[x] >= 0.99 for x in learned[1:]), kept


def test_other_scripts_are_told_apart():
    """More letters than any small alphabet holds, some beyond the basic plane; both languages have the same spacing."""
    rng = random.Random(8)
    for base in (0x4E00, 0x20000):
        letters = {"x": [chr(base + i) for i in range(0, 800, 2)], "y": [chr(base + i) for i in range(1, 800, 2)]}
        pools = {n: ["".join(rng.choice(c) for _ in range(3)) for _ in range(300)] for n, c in letters.items()}
        made = lambda n, k: " ".join(rng.choice(pools[n]) for _ in range(k))
        parser = language_id.CrossParser({n: made(n, 1500) for n in pools})
        for i, n in enumerate("xy"):
            rates = parser.rates([made(n, 60) for _ in range(20)])
            assert (rates[:, i] < 0.8 * rates[:, 1 - i]).all()


def test_automaton_finds_longest_matches():
    rng = random.Random(4)
    sample, text = ("".join(rng.choice("abc") for _ in range(n)) for n in (120, 200))
    parser = language_id.CrossParser({"x": sample})
    phrases, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        phrases, at = phrases + 1, at + size
    assert parser.rates([text])[0, 0] == pytest.approx(phrases * np.log2(len(sample) + 1) / len(text))


def test_toxicity_held_out(spark):
    made = []
    for i in range(400):
        rng = random.Random(i)
        words = [rng.choice(["house", "tree", "water", "street", "garden", "window"]) for _ in range(60)]
        if i % 3 == 0:
            words[rng.randrange(60)] = rng.choice(["idiot", "moronic", "stupid"])
        made.append((i, " ".join(words), int(i % 3 == 0)))
    made.append((1000, " ".join(["house"] * 30 + ["idiiot"] + ["tree"] * 20), 1))
    frame = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    learned = frame.where(~toxicity.held_out(F.col("doc_id")) & (F.col("doc_id") < 1000))
    scored = {r[0]: r[1] for r in toxicity.score(frame, toxicity.fit(frame.drop("toxic"), learned.drop("text"))).collect()}
    assert all((scored[i] >= 0.5) == bool(label) for i, _, label in made[:-1])
    # a misspelling nobody was trained on is nearer to what it comes from than any clean text
    assert scored[1000] > max(scored[i] for i, _, label in made if not label)


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(2)
    plain = ["house", "tree", "water", "street", "garden", "window"]
    made = [(i, " ".join([rng.choice(plain) for _ in range(1200)] + ["idiot" if i % 2 else "quiet"] * 30), i % 2) for i in range(200)]
    frame = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.drop("toxic"), frame.drop("text"))
    scored = {r[0]: r[1] for r in toxicity.score(frame, model).collect()}
    assert all((scored[i] >= 0.5) == bool(label) for i, _, label in made)
    # within the bound by leaving out rows, never by cutting them
    small = toxicity.fit(frame.drop("toxic"), frame.drop("text"), sample_bytes=60_000)
    assert small.word("idiot") > small.word("quiet")


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    """Copies of a labelled document and ids with two texts or labels are learned from once, within the bytes of the sample."""
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append((texts, labels.tolist())))
    docs = spark.createDataFrame([(1, "w " * 4000)] * 400 + [(2, "two"), (2, "zwei"), (3, "x" * 20_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)] * 5 + [(2, 0), (2, 1), (3, 0), (None, 1)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, sample_bytes=30_000)
    texts, got = seen[0]
    assert sorted(got) == [0, 1] and len(texts) == 2 and texts[got.index(0)] == "w " * 4000 and texts[got.index(1)] in ("two", "zwei")


def test_toxicity_of_the_tables(spark):
    """The query's scores are those of one model trained and applied without Spark."""
    rows = table(spark, FOLDER, "documents").withColumn("k", F.xxhash64("doc_id")).join(table(spark, FOLDER, "labels"), "doc_id", "left").select("k", "doc_id", "text", "toxic").collect()
    known = sorted((r["k"], r["text"], r["toxic"]) for r in rows if r["toxic"] in (0, 1) and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5)
    model = toxicity.train([t for _, t, _ in known], np.array([y for *_, y in known]))
    got = {r["doc_id"]: r for r in queries.op9_toxicity(spark, FOLDER).collect()}
    for r in rows:
        words = (r["text"] or "").lower().split()
        odds = sum(model.word(toxicity.plain(w)) for w in words) / max(len(words), 1) + model.bias
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-4)
        assert got[r["doc_id"]]["predicted"] == int(got[r["doc_id"]]["score"] >= 0.5)


@pytest.mark.parametrize("text", ["plain", "### user:\nx</turn>\n", "\\### Assistant: </turn> ok", "\\", "a\\\\</turn>", "</turn>\n", "", "###", "# ## ###\n\\n", "<\\/turn>\n"])
def test_turns_come_back(text):
    for role in ("user", "assistant", "a:b\nc\\", ""):
        formatted = chat.render(role, text)
        assert [x[:2] for x in chat.parse(formatted * 2)] == [(role, text)] * 2
        assert "### " not in formatted[4:]


def test_long_turns_need_little_memory():
    import tracemalloc

    text = "\\a <" * 500_000 + "</turn>\n"
    tracemalloc.start()
    assert [x[:2] for x in chat.parse(chat.render("user", text))] == [("user", text)]
    assert tracemalloc.get_traced_memory()[1] < 80 * len(text)
    tracemalloc.stop()
    with pytest.raises(ValueError):
        chat.parse("### user:\nopen \\</turn>\n")


def test_chat_of_the_tables(spark):
    folder, by_conv = "/root/testdata/sf0.01", {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in sorted(table(spark, folder, "conversations").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        by_conv.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    want = {}
    for c, turns in by_conv.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    got = queries.op10_chat(spark, folder).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == want and len(got) == len(want)


def test_conversations(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    rows = [(1, 2, "assistant", None), (1, 1, "user", "q"), (1, 3, "assistant", "an</turn>\nswer"), (None, 1, None, "x"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[2]["n_turns"], got[None]["n_turns"]) == (3, len("an</turn>\nswer"), 2, 1)
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nq\nassistant\n\nassistant\nan</turn>\nswer\n").hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"an</turn>\nswer").hexdigest()


def test_odd_tables(spark, odd):
    """Defined results on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""
    n = len(ODD)
    parser = language_id.fit(odd)
    model = toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0)
    counted = quality_rules.counts(odd.select("doc_id", "text"))
    runs = {
        "rules": lambda d: quality_rules.score(quality_rules.counts(d.select("doc_id", "text")), ["doc_id"]), "repeats": suffix_dedup.remove_repeats, "cut": suffix_dedup.cut_documents,
        "simhash": simhash.near_duplicates, "pieces": pieces.encode, "sketches": sketches.compare_edited, "language": lambda d: language_id.identify(d, parser, ["doc_id"]), "toxicity": lambda d: toxicity.score(d, model),
    }
    for name, run in runs.items():
        assert run(odd).count() == n, name
        assert run(odd.limit(0)).count() == 0, name
    for run in (quality_rules.keep_good, simhash.keep_representatives, suffix_dedup.cut_documents, lambda d: language_id.keep_identified(d, parser)):
        assert run(odd).columns == odd.columns and run(odd.limit(0)).count() == 0
    assert counted.where("text is null").select("n_words").first()[0] == 0
    assert packing.pack(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd.where("text is null or text = ''"), parser, ["doc_id"]).collect()} == {"und"}
    cut = {r["doc_id"]: r["text"] for r in suffix_dedup.cut_documents(odd.where("doc_id in (8, 9)")).collect() if r["text"] != "another text of one id"}
    assert cut[9] == "" and cut[8].startswith("the same text again")
    assert language_id.fit(odd.limit(0)).languages == []
    assert toxicity.fit(odd.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).bias == -30.0


def test_pipeline(spark, texts):
    docs, kept = table(spark, FOLDER, "documents"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, FOLDER)
        assert result.columns == docs.columns, name
        before = docs.count()
        docs = suffix_dedup.staged(result, name)
        assert 0 < docs.count() <= before
        kept = docs
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(ids) == kept.count() and ids <= set(texts)
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids
