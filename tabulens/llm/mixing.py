"""Mixing sources to target weights with a low-discrepancy schedule of equal blocks of words.

Sources get target words by weight, never more than REPEATS times what they hold. Each source's documents are put in a hashed order and its
words are cut into blocks of equal length; after the last block the source begins again. Slot i of the schedule takes the i-th van der
Corput point, maps it through the cumulative shares of the sources, and gets the next block of the source it hits: the slots of a source
are ranked, and rank and block number are joined. So every stretch of the schedule holds the sources in about their final shares.
Slots beyond what a source needs go, what a source still needs afterwards follows at the end, and the last block is cut: each source ends
at the whole words of its target.

Running totals and ranks are taken within buckets and chunks of bounded size, and over the sums of these; no window holds a source.
The length of a block is the mix over 2 ** 20, from 16 to 2,048 words.

Defined results: a null or empty text has size 0 and is never taken; null sources are one source, the last; repeated rows each get a row
and their own words; rows of one id and text stand side by side in the order; other columns are ignored; an empty table gives no rows, and
where no document has a word all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulens.llm.common import staged

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Bits of a van der Corput point, and slots whose ranks are counted together.
BITS, CHUNK = 40, 1 << 16
#: Documents a bucket of the hashed order holds on average.
BUCKET_ROWS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, place): words and hashed place of each document."""
    text = F.coalesce("text", F.lit(""))
    place = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.conv(F.substring(place, 1, 15), 16, 10).cast("long").alias("place"))


def _before(parts: DataFrame, total: str, order: str, *by: str) -> DataFrame:
    """Sum of `total` over the earlier rows of `order`; one row per part, so the window is short."""
    w = Window.partitionBy(*by).orderBy(order) if by else Window.partitionBy(F.lit(0)).orderBy(order)
    return parts.withColumn("before", F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(total))


def _cumulated(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of `value` over the rows before, over a stored table with columns `part` (a range of the order) and `source`."""
    sums = _before(df.groupBy("part").agg(F.sum(value).alias("here")), "here", "part").select("part", "before")
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(sums, "part").withColumn(name, F.col("before") + F.sum(value).over(inside) - value).drop("before")


def targets(sized: DataFrame) -> DataFrame:
    """(source, number, source_size, target, need, first, blocks, block): one row per source; need: slots, first: slots of the sources before."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size")).repartitionByRange(F.col("source").asc_nulls_last())
    per = staged(per.withColumn("part", F.spark_partition_id()), "mix-sources")
    per = _cumulated(per, F.lit(1), "number")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    per = staged(per.withColumn("weight", weight.cast("long")), "mix-weights")
    most = F.col("source_size") * REPEATS
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, seen = 0.0, -1
    while True:  # the level only rises, and each round but the last puts at least one more source at its limit
        full = most < F.col("weight") * F.lit(level)
        row = per.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, most)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if row[0] == seen or not row[2]:
            break
        seen, level = row[0], (total - row[1]) / row[2]
    block = min(2048, max(16, total >> 20))
    size, want = F.col("source_size"), F.floor("target")
    per = per.withColumn("target", F.least(most.cast("double"), F.col("weight") * F.lit(level))).withColumn("blocks", F.ceil(size / F.lit(block)).cast("long"))
    need = F.when(size > 0, F.expr("floor(target) div source_size") * F.col("blocks") + F.ceil((want % size) / F.lit(block))).otherwise(0).cast("long")
    per = staged(per.withColumn("need", need).withColumn("block", F.lit(block).cast("long")), "mix-needs")
    return staged(_cumulated(per, F.col("need"), "first").select("source", "number", "source_size", "target", "need", "first", "blocks", "block"), "mix-targets")


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, number, rank): which source each slot takes from, and the how-manieth time."""
    spark = sources.sparkSession
    n, count = sources.agg(F.coalesce(F.sum("need"), F.lit(0)), F.count(F.lit(1))).first()
    cells = max(4096, count)
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), BITS, "0")), 2, 10).cast("double")
    parts = max(spark.sparkContext.defaultParallelism, n // 1_000_000 + 1)
    slots = spark.range(0, n, 1, parts).select(F.col("id").alias("slot")).withColumn("at", F.floor(point * F.lit(float(n)) / F.lit(float(1 << BITS))))
    slots = slots.withColumn("cell", F.floor(F.col("at") * F.lit(float(cells)) / F.lit(float(max(n, 1)))))
    cell = lambda c: F.floor(c * F.lit(float(cells)) / F.lit(float(max(n, 1))))
    # a source lies in the cells it covers: at most `cells` rows more than sources
    covered = sources.where("need > 0").select("number", "first", "need", F.explode(F.sequence(cell(F.col("first")), cell(F.col("first") + F.col("need") - 1))).alias("cell"))
    hit = slots.join(covered, "cell").where("at >= first and at < first + need").select("slot", "number", "need")
    hit = hit.withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    inside = Window.partitionBy("number", "chunk").orderBy("slot")
    ranked = staged(hit.withColumn("rank", F.row_number().over(inside).cast("long") - 1), "mix-slots")
    earlier = _before(ranked.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n")), "n", "chunk", "number")
    placed = ranked.join(earlier, ["number", "chunk"]).select("slot", "number", (F.col("rank") + F.col("before")).alias("rank"), "need").where("rank < need")
    found = earlier.groupBy("number").agg(F.sum("n").alias("n"))
    short = sources.join(found, "number", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).where("n < need")
    more = short.select("number", "first", F.explode(F.sequence(F.col("n"), F.col("need") - 1)).alias("rank"))
    return placed.drop("need").select("slot", "number", "rank").union(more.select((F.lit(n) + F.col("first") + F.col("rank")).alias("slot"), "number", "rank"))


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with their source's columns and `start`, the words of the source before them."""
    rows = sized.count()
    width = (1 << 60) // max(1, rows // BUCKET_ROWS)
    joined = sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("bucket", F.floor(F.col("place") / F.lit(width).cast("long")))
    sums = _before(joined.groupBy("number", "bucket").agg(F.sum("size").alias("n")), "n", "bucket", "number").drop("n")
    inside = Window.partitionBy("number", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return joined.join(sums, ["number", "bucket"]).withColumn("start", F.col("before") + F.sum("size").over(inside) - F.col("size")).drop("before", "bucket")


def pieces(docs: DataFrame) -> DataFrame:
    """All documents cut at the blocks of their sources (documents without words: one piece), with the slots that take from the piece.

    Columns: doc_id, source, size, number, source_size, target, start, first_word, slots (array of slot and n_words).
    """
    sized = staged(sizes(docs), "mix-sizes")
    sources = targets(sized)
    b = F.col("block")
    slots = schedule(sources).join(sources.select("number", "source_size", "target", "blocks", "block"), "number")
    slots = slots.withColumn("of", F.expr("rank % blocks")).withColumn("at", F.expr("rank div blocks") * F.col("source_size") + F.col("of") * b)
    words = F.least(b, F.col("source_size") - F.col("of") * b, F.floor("target") - F.col("at"))
    # a block is taken once per round, REPEATS times at most
    taken = slots.groupBy("number", "of").agg(F.collect_list(F.struct("slot", words.alias("words"))).alias("taken"))
    cut = _placed(sized, sources)
    last = F.when(F.col("size") > 0, F.col("start") + F.col("size") - 1).otherwise(F.col("start"))
    cut = cut.withColumn("of", F.explode(F.sequence(F.expr("start div block"), F.floor(last / b))))
    begin = F.greatest(F.col("start"), F.col("of") * b)
    cut = cut.withColumn("first_word", begin - F.col("start")).withColumn("offset", begin - F.col("of") * b).withColumn("length", F.least(F.col("start") + F.col("size"), (F.col("of") + 1) * b) - begin)
    joined = cut.join(taken, ["number", "of"], "left")
    used = F.transform("taken", lambda t: F.struct(t["slot"].alias("slot"), F.least(F.greatest(t["words"] - F.col("offset"), F.lit(0)), F.col("length")).alias("n_words")))
    keep = F.filter(F.coalesce(used, F.array().cast("array<struct<slot:bigint,n_words:bigint>>")), lambda t: t["n_words"] > 0)
    return joined.select("doc_id", "source", "size", "number", "source_size", "target", "start", "first_word", keep.alias("slots"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself, ordered by (slot, source_word): which words of which document each slot holds."""
    return pieces(docs).select(F.explode("slots").alias("s"), "source", "doc_id", "first_word", (F.col("start") + F.col("first_word")).alias("source_word")).select("s.slot", "source", "source_word", "doc_id", "first_word", "s.n_words")


def texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """(slot, source_word, text): the words of the mix; ids must be unique."""
    named = docs.select(F.col("doc_id").alias("of"), F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"))
    joined = mixed.join(named, F.col("doc_id").eqNullSafe(F.col("of")))
    return joined.select("slot", "source_word", F.array_join(F.slice("words", (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int")), " ").alias("text"))


def taken_words(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    used = F.aggregate("slots", F.lit(0).cast("long"), lambda n, s: n + s["n_words"])
    cut = pieces(docs).withColumn("used", used)
    some = cut.where("size > 0").groupBy("number", "start", "doc_id", "size", "source_size", "target").agg(F.sum("used").alias("taken"))
    return some.select("doc_id", "size", "source_size", "target", "taken").union(cut.where("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long")))
