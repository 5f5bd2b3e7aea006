"""Language identification by cross-parsing: the fewer phrases of a language's text a document needs, the likelier the language.

For each language a suffix automaton is built over a bounded sample of labelled text. A document is parsed greedily into the longest
phrases that occur in the sample; phrases * log2(sample length) / characters estimates the cross entropy, and the smallest wins (ties:
the language that comes first by name). Automata and phrases are over UTF-8 bytes, so every script is parsed exactly; each automaton has
columns only for the bytes of its sample. Documents are parsed in segments of SEGMENT bytes, all segments of a batch in step, so a
segment's end also ends a phrase, for every language alike.

Defined results: null texts and texts without a letter are `und` with score 0, as is everything if nothing was learned; rows without id
or lang are not learned from; repeated rows each get a row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Collection

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabulens.llm.common import batches_of

SEGMENT = 256
#: What fills a segment up: a byte that UTF-8 never has.
PAD = 0xFF
#: Sharpness of the score.
SHARPNESS = 8.0
FLAG = 1 << 30


def suffix_automaton(codes: list[int], n_codes: int) -> np.ndarray:
    """Transitions (states x n_codes) of the automaton of all substrings; -1 where there is none."""
    follow, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = twin
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = twin
                    p = link[p]
        last = new
    table = np.full((len(follow), n_codes), -1, np.int32)
    for state, edges in enumerate(follow):
        if edges:
            table[state, list(edges)] = list(edges.values())
    return table


class CrossParser:
    """Automata of all languages over bytes."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.codes, self.tables, self.bits = [], [], []
        for name in self.languages:
            data = self.encode(samples[name])
            present = np.unique(data)
            n_codes = len(present) + 2
            # 0: bytes that the sample lacks, 1 and on: its bytes, the last: padding
            code = np.zeros(256, np.int32)
            code[present] = np.arange(1, len(present) + 1)
            code[PAD] = n_codes - 1
            table = suffix_automaton(code[data].tolist(), n_codes).astype(np.int64)
            # a missing transition ends the phrase (FLAG) and begins the next with the same byte
            begin = np.where(table[0] >= 0, table[0], 0)
            step = np.where(table >= 0, table, begin | FLAG)
            step[:, n_codes - 1] = np.arange(len(table))
            if len(table) * n_codes >= FLAG:
                raise ValueError("sample too long")
            self.codes.append(code)
            self.tables.append((((step & (FLAG - 1)) * n_codes) | (step & FLAG)).astype(np.int32).ravel())
            self.bits.append(np.log2(len(samples[name]) + 1))
        self.limits = np.full(len(self.languages), np.inf)

    def calibrate(self, excerpts: dict[str, list[str]]) -> None:
        """Bound the bits per character of each language's texts, by labelled excerpts that are not part of the samples.

        The limit lies halfway between what nine in ten of its own excerpts stay below and what half of the other languages' excerpts need:
        a text beyond it is as far from the language as other languages are. Without excerpts of its own the limit is the others' median,
        without excerpts of others there is none.
        """
        names = [name for name in self.languages for _ in excerpts.get(name, ())]
        if not names:
            return
        rates, names = self.rates([x for name in self.languages for x in excerpts.get(name, ())]), np.array(names, object)
        for i, name in enumerate(self.languages):
            own, others = rates[names == name, i], rates[names != name, i]
            if len(others):
                foreign = float(np.median(others))
                near = float(np.quantile(own, 0.9)) if len(own) else foreign
                self.limits[i] = max(near, (near + foreign) / 2)

    @staticmethod
    def encode(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)

    def rates(self, texts: list[str]) -> np.ndarray:
        """(text, language): bits per character."""
        characters = np.array([len(t) for t in texts], np.int64)
        data = [self.encode(t) for t in texts]
        sizes = np.array([len(d) for d in data], np.int64)
        parts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        grid = np.full((int(parts.sum()), SEGMENT), PAD, np.uint8)
        # texts begin at a segment; what they don't fill stays padding
        target = np.repeat((np.cumsum(parts) - parts) * SEGMENT - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        grid.ravel()[target] = np.concatenate([*data, np.zeros(0, np.uint8)])
        lanes = np.ascontiguousarray(grid.T)
        out = np.zeros((len(texts), len(self.languages)))
        for i, (code, table) in enumerate(zip(self.codes, self.tables)):
            state, phrases = np.zeros(len(grid), np.int32), np.ones(len(grid), np.int32)
            for column in lanes:
                state = table[state + code[column]]
                phrases += state >> 30
                state &= FLAG - 1
            out[:, i] = np.bincount(owner, phrases, len(texts)) * self.bits[i]
        return out / np.maximum(characters, 1)[:, None]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 150, chars: int = 400, sample_chars: int = 20_000) -> CrossParser:
    """A parser from at most `sample_chars` characters per language, excerpts of `chars` characters from about 2 * `rows` hashed rows each;
    those beyond `sample_chars` set the limits of the languages.

    The only data that reach the driver; the bounds are parameters and do not grow with the input.
    """
    source = labelled.select(F.xxhash64(id_col).alias("k"), F.lower(F.col(text_col)).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text rlike '\\\\p{L}'")
    found = dict(source.groupBy("lang").count().collect())
    if not found:
        return CrossParser({})
    share = F.create_map(*[x for lang, n in sorted(found.items()) for x in (F.lit(lang), F.lit(min(1 << 40, int(2 * rows / n * (1 << 40)) + 1)))])
    picked = source.where(F.pmod("k", F.lit(1 << 40)) < share[F.col("lang")])
    start = F.pmod(F.shiftright("k", 8), F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1
    samples: dict[str, str] = dict.fromkeys(found, "")
    beyond: dict[str, list[str]] = {lang: [] for lang in found}
    excerpts = picked.select("lang", "k", F.substring("text", start, F.lit(chars)).alias("x")).collect()
    for lang, _, text in sorted(excerpts):
        if len(samples[lang]) < sample_chars:
            samples[lang] = (samples[lang] + "\n" + text)[:sample_chars]
        else:
            beyond[lang].append(text)
    parser = CrossParser(samples)
    parser.calibrate(beyond)
    return parser


def identify(docs: DataFrame, parser: CrossParser, carried: list[str], text_col: str = "text") -> DataFrame:
    """The carried columns of each row with lang_pred, score and `within`: whether the text stays below the limit of its language (an
    unfinished last phrase isn't held against it)."""
    shared = docs.sparkSession.sparkContext.broadcast(parser)
    source = docs.select(*carried, F.when(F.col(text_col).rlike(r"\p{L}"), F.lower(F.col(text_col))).alias("_lowered"))
    schema = source.drop("_lowered").schema.add("lang_pred", "string").add("score", "double").add("within", "boolean")

    def run(batches):
        model = shared.value
        for batch in batches_of(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            lettered = np.array([t is not None for t in texts], bool) & bool(model.languages)
            names, scores, within = np.full(len(texts), "und", object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if lettered.any():
                characters = np.array([len(t) for t, ok in zip(texts, lettered) if ok])
                rates = model.rates([t for t, ok in zip(texts, lettered) if ok])
                best = rates.argmin(axis=1)
                names[lettered] = np.array(model.languages, object)[best]
                scores[lettered] = 1 / np.exp(-SHARPNESS * (rates - rates.min(axis=1)[:, None])).sum(axis=1)
                within[lettered] = rates.min(axis=1) <= model.limits[best] + np.array(model.bits)[best] / characters
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(names, pa.string()), pa.array(scores), pa.array(within)], [*batch.schema.names[:-1], "lang_pred", "score", "within"])

    return source.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, parser: CrossParser, least: float = 0.5, wanted: Collection[str] | None = None) -> DataFrame:
    """The rows in a wanted language (None: any that was learned), with a score of at least `least` and within the language's limit.

    A text in a language nobody labelled, random letters or markup needs as many phrases as foreign text does, and goes, as does a text
    whose language is a toss-up.
    """
    taken = set(docs.columns)
    row = next(n for n in (f"row{i}" for i in range(len(taken) + 1)) if n not in taken)
    marked = identify(docs.select(F.struct("*").alias(row), "text"), parser, [row])
    chosen = F.col("lang_pred") != "und" if wanted is None else F.col("lang_pred").isin(sorted(wanted))
    return marked.where(chosen & F.col("within") & (F.col("score") >= least)).select(f"{row}.*")
