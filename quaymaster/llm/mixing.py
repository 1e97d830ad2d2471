"""Mixing sources to target weights.

The words of a source, in document order, are packed into blocks of fixed length. The mix has
as many slots of a source as its target asks for; a multinomial draw with fixed totals deals
them to the output shards, so every shard has its own counts by source. A slot's number runs
over the shards and is mapped through a pseudorandom permutation of the source's block
indices, a new one for each pass, and blocks are joined by index. So a block is taken at
most once a pass, and a source at most ``most`` times.

Null texts have no words. A null source is a source; it comes last. Documents without
words are never taken. Repeated rows are documents of their own, told apart by a copy number.
Columns other than doc_id, text and source only ride along. All steps are Spark expressions,
and the result depends on the rows and the seed alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymaster.operators.running import running_total
from quaymaster.session import materialise

SPACE = r"\x20\x09-\x0D"
KEY = ["doc_id", "_h", "_copy"]


@dataclass(frozen=True)
class MixSettings:
    weights: tuple[int, ...] = (5, 2, 1)  # repeating, by source in code point order
    share: float = 1.5  # words of the mix over words of the input
    most: int = 2  # passes over a source
    block_words: int = 64
    least_blocks: int = 64  # a source too small for so many blocks has shorter ones
    shard_blocks: int = 1024  # mean blocks of an output shard
    rounds: int = 10  # of the permutation
    seed: int = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("source"))


def numbered(rows: DataFrame) -> DataFrame:
    """Copy number of repeated rows; equal rows are interchangeable."""
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy("doc_id", "_h").orderBy("doc_id")))


def sizes_of(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        text_hash().alias("_h"), word_count(F.col("text")).alias("size"),
    )
    return materialise(numbered(rows), "mix-sizes")


def targets(sizes: DataFrame, settings: MixSettings) -> DataFrame:
    """One row a source: number, size, target, block length, blocks, slots.

    A target is ``least(most * size, level * weight)``: reshaping the excess by weight until no
    source is above its bound ends at the level where the sum of targets is the mix. Sorted by
    bound over weight, the level is that of the first source its own level does not fill.
    The windows run over the list of sources, one row each.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("number", F.row_number().over(order) - 1).withColumn(
        "weight", F.get(weights, F.pmod("number", F.lit(len(settings.weights)))))
    s = s.withColumn("bound", F.lit(float(settings.most)) * F.col("source_size")).withColumn("reach", F.col("bound") / F.col("weight"))
    fill = Window.orderBy("reach", "number")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    s = s.withColumn("total", F.sum("source_size").over(everything) * F.lit(settings.share)).withColumn(
        "level_here", (F.col("total") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(from_here))
    is_open = F.col("reach") > F.col("level_here")
    first_open = F.min(F.when(is_open, F.struct("reach", "number", "level_here")))
    s = s.withColumn("level", first_open.over(everything)["level_here"]).withColumn(
        "target", F.least("bound", F.coalesce(F.col("level") * F.col("weight"), F.col("bound"))))
    size = F.col("source_size")
    length = F.least(F.lit(settings.block_words), F.greatest(F.lit(1), F.floor(size / settings.least_blocks))).cast("bigint")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("bigint")
    s = s.withColumns({"block_words": length, "passes": passes}).withColumn("blocks", F.ceil(size / F.col("block_words")))
    rest = F.least("blocks", F.round((F.col("target") - F.col("passes") * size) / F.col("block_words")).cast("bigint"))
    slots = F.least(F.col("passes") * F.col("blocks") + F.greatest(F.lit(0), rest), settings.most * F.col("blocks"))
    return materialise(s.withColumn("slots", slots).select(
        "source", "number", "source_size", "target", "block_words", "blocks", "slots"), "mix-sources")


def draw_counts(sources: DataFrame, settings: MixSettings) -> DataFrame:
    """Slots of each source in each output shard: (number, shard, n), a multinomial draw with the totals fixed."""
    chunk = 1 << 16
    shards = F.greatest(F.lit(1), F.ceil(sources.agg(F.sum("slots")).scalar() / settings.shard_blocks))
    chunks = sources.where("slots > 0").select(
        "number", "slots", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / chunk))).alias("part"))
    each = chunks.repartition("number", "part").select("number", F.explode(F.sequence(
        F.col("part") * chunk, F.least(F.col("slots"), (F.col("part") + 1) * chunk) - 1)).alias("slot"))
    shard = F.pmod(F.xxhash64(F.lit(settings.seed), "number", "slot"), shards)
    return each.groupBy("number", shard.alias("shard")).agg(F.count("*").alias("n"))


def permuted(index: Column, size: Column, *key: Column, rounds: int) -> Column:
    """Swap-or-not shuffle of 0..size-1: each round swaps an index with its mirror image if their hash bit says so."""

    def step(i: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - i, size)
        swap = F.xxhash64(*key, r, F.greatest(i, mirror)).bitwiseAND(F.lit(1).cast("bigint")) == 1
        return F.when(swap, mirror).otherwise(i)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), index.cast("bigint"), step)


def slots_of(sources: DataFrame, settings: MixSettings) -> DataFrame:
    """The mix by slots: (number, shard, slot, pass, block)."""
    counts = running_total(draw_counts(sources, settings), ["number"], ["shard"], "n", "first")
    # Few rows make many slots, so the tasks are fixed in number: adaptive execution would merge them by size.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = counts.repartition(tasks, "number", "shard").select("number", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    known = slots.join(sources.select("number", "blocks"), "number")
    turn = F.floor(F.col("slot") / F.col("blocks")).cast("bigint")
    index = F.pmod("slot", F.col("blocks"))
    return known.withColumn("pass", turn).select(
        "number", "shard", "slot", "pass",
        permuted(index, F.col("blocks"), F.lit(settings.seed), F.col("number"), F.col("pass"), rounds=settings.rounds).alias("block"))


def pieces_of(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """The stretch of every document in every block: (number, block, key, from_word, words)."""
    placed = running_total(sizes.where("size > 0"), ["source"], KEY, "size", "_start")
    listed = sources.select(F.col("source").alias("_source"), "number", "block_words")
    rows = placed.join(listed, F.col("source").eqNullSafe(F.col("_source")))
    end = F.col("_start") + F.col("size")
    b = F.col("block_words")
    cut = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("_start") / b), F.floor((end - 1) / b))))
    first = F.greatest("_start", F.col("block") * b)
    last = F.least(end, (F.col("block") + 1) * b)
    return cut.select("number", "block", *KEY, (first - F.col("_start")).alias("from_word"), (last - first).alias("words"))


@dataclass(frozen=True)
class Mix:
    sizes: DataFrame
    sources: DataFrame
    rows: DataFrame  # number, shard, slot, pass, block, key, from_word, words


def mix(docs: DataFrame, settings: MixSettings = MixSettings()) -> Mix:
    sizes = sizes_of(docs)
    sources = targets(sizes, settings)
    rows = slots_of(sources, settings).join(pieces_of(sizes, sources), ["number", "block"])
    return Mix(sizes, sources, rows)


def _same(a: DataFrame, b: DataFrame) -> Column:
    test = F.lit(True)
    for k in KEY:
        test = test & a[k].eqNullSafe(b[k])
    return test


def taken_words(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """Size, source size, target and taken words of every document."""
    m = mix(docs, settings)
    taken = m.rows.groupBy(*KEY).agg(F.sum("words").alias("taken")).alias("t")
    rows = m.sizes.join(m.sources.select(F.col("source").alias("_source"), "source_size", "target"),
                        F.col("source").eqNullSafe(F.col("_source"))).alias("s")
    return rows.join(taken, _same(rows, taken), "left").select(
        F.col("s.doc_id").alias("doc_id"), "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))


def mixed_documents(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix as documents: one row for each pass over a document, with the stretches of its text that the pass takes.

    A stretch starts with the white space before its first word; the white space at either end of
    a cut text goes. Documents taken whole keep their text as it is. Columns are those of ``docs``.
    """
    m = mix(docs, settings)
    ranges = m.rows.groupBy(*KEY, "pass").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("ranges"), F.sum("words").alias("words_taken"))
    held = numbered(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("_h"), F.struct(*docs.columns).alias("_doc")))
    both = held.join(ranges, _same(held, ranges))
    text = F.col("_doc.text")
    words = F.regexp_extract_all(text, F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0))
    cut = F.array_join(F.flatten(F.transform(
        "ranges", lambda r: F.slice(words, (r["from_word"] + 1).cast("int"), r["words"].cast("int")))), "")
    kept = F.when(F.col("words_taken") == word_count(text), text).otherwise(F.regexp_replace(cut, f"^[{SPACE}]+", ""))
    fresh = both.select("_doc", kept.alias("_text"))
    return fresh.select(*[
        F.col("_text").alias("text") if c == "text"
        else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("_doc")[c].alias(c)
        for c in docs.columns])
