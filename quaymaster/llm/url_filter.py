"""Exact URL rules without joins: a cascade of Bloom filters over the keys of the corpus.

A rule is a host and a path prefix. Every URL has a few keys that a rule could equal: a
suffix of its host at a label boundary, joined to a prefix of its path. The distinct keys
of all URLs are the universe. Level 0 of a cascade holds the listed keys; every later level
holds the keys of the other kind that pass all levels before it, until none is left. A key
of the universe is then listed exactly if the first level that refuses it is odd. Only the
build looks at the universe; a URL is judged by bit tests on array literals.

Filter sizes follow the list of rules, never the corpus: the rate of level 0 is chosen so
that the false positives of the universe are about as many as the listed keys.

Null urls and urls without ``://`` have an empty host and path, which no rule fits. Rows are
judged one by one, so repeated rows give repeated results; other columns are not touched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaymaster.session import materialise

WORD = 32
PARTS = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit(""))
    return F.translate(found, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def keys_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Keys of a URL that have as many labels and path characters as some rule."""
    labels = F.split(host, r"\.")
    out = []
    for n, length in sorted({(r.host.count(".") + 1, len(r.path)) for r in rules}):
        suffix = F.array_join(F.slice(labels, -n, n), ".")
        fits = (F.size(labels) >= n) & (F.length(path) >= length)
        out.append(F.when(fits, F.concat(suffix, F.substring(path, 1, length))))
    return F.array_distinct(F.array_compact(F.array(*out)))


# Bloom filters ---------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: list[int]


def _slots(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)]


def build_level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """Bloom filter of ``keys``; its words come to the driver, about 1.5 bits a key for each halving of ``rate``."""
    bits = max(WORD, math.ceil(count * math.log2(1 / rate) / math.log(2) / WORD) * WORD)
    hashes = max(1, min(30, round(bits / max(count, 1) * math.log(2))))
    slots = keys.select(F.explode(F.array(*_slots(F.col("key"), number, bits, hashes))).alias("slot"))
    found = (
        slots.select((F.col("slot") / WORD).cast("bigint").alias("word"), F.pmod("slot", F.lit(WORD)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("mask"))
    )
    words = [0] * (bits // WORD)
    for row in found.toLocalIterator():
        words[row["word"]] = row["mask"]
    return Level(bits, hashes, words)


def passes(key: Column, number: int, level: Level) -> Column:
    words = F.lit(level.words).cast("array<bigint>")
    test = F.lit(True)
    for slot in _slots(key, number, level.bits, level.hashes):
        word = F.get(words, (slot / WORD).cast("int"))
        test = test & (F.call_function("getbit", word, F.pmod(slot, F.lit(WORD)).cast("int")) == 1)
    return test


def passes_all(key: Column, levels: list[Level]) -> Column:
    test = F.lit(True)
    for number, level in enumerate(levels):
        test = test & passes(key, number, level)
    return test


def build_cascade(universe: DataFrame, listed: Column) -> list[Level]:
    """Levels for the keys of ``universe`` (column ``key``) for which ``listed`` holds."""
    seen = universe.withColumn("_in", listed)
    inside, outside = seen.agg(F.count_if("_in"), F.count_if(~F.col("_in"))).first()
    if not inside:
        return []
    rate = min(0.5, max(1e-6, inside * math.sqrt(0.5) / max(outside, 1)))
    levels: list[Level] = []
    wanted, count = True, inside
    while count:
        member = F.col("_in") == F.lit(wanted)
        keys = seen.where(member & passes_all(F.col("key"), levels))
        levels.append(build_level(keys, len(levels), count, rate if not levels else 0.5))
        wanted = not wanted
        count = seen.where((F.col("_in") == F.lit(wanted)) & passes_all(F.col("key"), levels)).count()
    return levels


def contains(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed: the first level that refuses it is odd, or none refuses and the last holds listed keys."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in reversed(range(len(levels))):
        answer = F.when(~passes(key, number, levels[number]), F.lit(number % 2 == 1)).otherwise(answer)
    return answer


# Judging ---------------------------------------------------------------------


def rule_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.key, r.verdict) for r in rules], "key string, verdict string")


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the longest that fits) and ``verdict`` to every row.

    A URL that no rule fits is not on the block list and is allowed. If a key is listed
    with both verdicts, block holds. An empty rule list allows everything.
    """
    spark = pages.sparkSession
    url_col = F.col(url).cast("string")
    parsed = pages.withColumns({"host": host_of(url_col), "path": path_of(url_col)})
    if not rules:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    keys = keys_of(F.col("host"), F.col("path"), rules)
    corpus = parsed.select(F.explode(keys).alias("key")).withColumn("verdict", F.lit(None).cast("string"))
    universe = materialise(
        corpus.distinct().unionByName(rule_frame(spark, rules)).groupBy("key").agg(
            F.max(F.col("verdict").isNotNull()).alias("ruled"),
            F.coalesce(F.max(F.col("verdict") == "block"), F.lit(False)).alias("blocked"),
        ),
        "url-keys",
    )
    ruled = build_cascade(universe, F.col("ruled"))
    blocked = build_cascade(universe, F.col("blocked"))
    fitting = F.filter(keys, lambda k: contains(k, ruled))
    longest = F.aggregate(
        fitting, F.lit(None).cast("string"),
        lambda best, k: F.when(best.isNull() | (F.length(k) > F.length(best)), k).otherwise(best),
    )
    judged = parsed.withColumn("rule", longest)
    on_list = F.col("rule").isNotNull() & contains(F.col("rule"), blocked)
    return judged.withColumn("verdict", F.when(on_list, "block").otherwise("allow"))
