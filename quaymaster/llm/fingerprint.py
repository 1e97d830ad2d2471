"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: its lines, cut after every eight words so that a text of
one line has parts too. Every paragraph is hashed to a vector of 128 bits, one for each lane;
a fingerprint is the number of paragraphs and the sum of the vectors, each lane modulo 2**31, which
a text cannot reach: signs are right up to 2**30 paragraphs, and a paragraph has two characters or more.
Sums do not depend on order, and a paragraph is added or removed by adding or subtracting
its vector. Read as signs (bit 1: +1, bit 0: -1), two fingerprints' inner product over the
lanes estimates the paragraphs they share; ``likeness`` is their cosine, cut to 0..1.

Null texts are empty; an empty text has no paragraphs and the zero fingerprint. Two empty
fingerprints have likeness 1, an empty and another one 0. Everything is a Spark expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymaster.llm.common import sha256_hex, texts_of
from quaymaster.session import materialise

LANES = 128
MODULUS = 2**31
PARAGRAPH = r"(?:\S+[^\S\n]*){1,8}"
# Two lanes are summed in one long, 31 bits apart: exact up to 2**31 paragraphs of a text.
HALF = 31


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))


def lane_sums(units: str = "unit", only: Column | None = None) -> list[Column]:
    """Sums of the packed lanes of the paragraphs in column ``units``."""
    out = []
    for j in range(LANES // 2):
        seed, shift = divmod(2 * j, 64)
        word = F.col(f"_h{seed}")
        low = F.shiftrightunsigned(word, shift).bitwiseAND(F.lit(1).cast("bigint"))
        high = F.shiftrightunsigned(word, shift + 1).bitwiseAND(F.lit(1).cast("bigint"))
        packed = low + F.shiftleft(high, HALF)
        out.append(F.sum(packed if only is None else F.when(only, packed).otherwise(0)).alias(f"_p{j}"))
    return out


def hash_words(unit: str) -> dict[str, Column]:
    return {f"_h{seed}": F.xxhash64(F.lit(seed), F.col(unit)) for seed in range(LANES // 64)}


def unpacked(total: str, packs: list[str]) -> Column:
    """Array of the paragraph count and the lanes, modulo 2**31; an empty text has none but zeros."""
    below = F.lit((1 << HALF) - 1)
    lanes = [F.col(total)]
    for p in packs:
        lanes += [F.col(p).bitwiseAND(below), F.shiftright(F.col(p), HALF)]
    return F.array(*[F.pmod(x, F.lit(MODULUS)).cast("int") for x in lanes])


def fingerprints(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key`` and ``lanes`` of every distinct key; the texts of a key are added up."""
    units = df.select(*key, F.explode_outer(paragraphs(F.col(text))).alias("unit"))
    present = F.col("unit").isNotNull()
    sums = units.withColumns(hash_words("unit")).groupBy(*key).agg(
        F.count_if(present).alias("_n"), *lane_sums(only=present)
    )
    return sums.select(*key, unpacked("_n", [f"_p{j}" for j in range(LANES // 2)]).alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint after adding (or, with -1, removing) the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x.cast("bigint") + sign * y, F.lit(MODULUS)).cast("int"))


def as_text(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _signed(lanes: Column) -> Column:
    n = F.element_at(lanes, 1).cast("bigint")
    half = MODULUS // 2
    return F.transform(
        F.slice(lanes, 2, LANES), lambda c: (F.pmod(2 * c.cast("bigint") - n + half, F.lit(MODULUS)) - half).cast("double")
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the sign sums of two fingerprints, 0 to 1; equal ones have 1."""
    x, y = _signed(a), _signed(b)
    sizes = F.sqrt(_dot(x, x)) * F.sqrt(_dot(y, y))
    cosine = F.when(sizes > 0, _dot(x, y) / sizes).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


# Neighbours in order ------------------------------------------------------------


def successors(keys: DataFrame, order: list[str]) -> DataFrame:
    """Every row of ``keys`` with its successor by ``order`` (after the last: the first) in column ``next``.

    The rows are range partitioned and written; a slice finds successors inside itself, and the
    last row of a slice takes the first of the next slice that has rows. That table has one row a
    slice, which bounds both its window and its broadcast.
    """
    sliced = materialise(
        keys.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "ordered"
    )
    fields = F.struct(*keys.columns)
    inside = Window.partitionBy("_slice").orderBy(*order)
    firsts = sliced.groupBy("_slice").agg(F.min(F.struct(*order, fields.alias("row"))).alias("f")).select(
        "_slice", F.col("f.row").alias("row")
    )
    ring = Window.orderBy("_slice")
    heads = firsts.select(
        F.col("_slice").alias("_s"),
        F.coalesce(F.lead("row").over(ring), F.first("row").over(ring)).alias("_head"),
    )
    return (
        sliced.withColumn("_lead", F.lead(fields).over(inside))
        .join(F.broadcast(heads), F.col("_slice") == F.col("_s"))
        .select(*keys.columns, F.coalesce("_lead", "_head").alias("next"))
    )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    The edited text replaces the last quarter of the code points by the first as many of the
    next document by ``doc_id`` (then by length and hash of the text; null ids first). Repeated
    rows follow each other: all but the last have a copy of themselves as the next document.

    Texts move once, by their key; besides them only the prefixes that go to a neighbour.
    """
    texts = texts_of(docs).select(
        F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id0"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("h"), "doc_id", "text", F.length("text").cast("bigint").alias("n_chars"),
    )
    key = ["id0", "h"]
    small = texts.groupBy(*key, "doc_id", "n_chars").agg(F.count("*").alias("copies"))
    chain = successors(small, ["doc_id", "n_chars", "h"])
    need = F.floor(F.col("n_chars") / 4).cast("int")
    to_next = chain.select(*key, "doc_id", "n_chars", need.alias("need"), F.lit(1).cast("bigint").alias("times"),
                           F.col("next.id0").alias("next_id0"), F.col("next.h").alias("next_h"))
    to_self = chain.where(F.col("copies") > 1).select(
        *key, "doc_id", "n_chars", need.alias("need"), (F.col("copies") - 1).alias("times"), F.col("id0").alias("next_id0"), F.col("h").alias("next_h"))
    links = to_next.unionByName(to_self)
    # One row of each key, by a window in the order that the merge joins below need anyway. Both uses
    # below read the same columns, so that they share one exchange of the texts.
    by_key = texts.select(*key, "text").repartition(*key)
    one = by_key.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*key))).where("_nth = 1").drop("_nth")
    wanted = links.select(F.col("next_id0").alias("id0"), F.col("next_h").alias("h"),
                          F.col("id0").alias("for_id0"), F.col("h").alias("for_h"), "doc_id", "n_chars", "need", "times")
    heads = one.join(wanted, key).select(
        F.col("for_id0").alias("id0"), F.col("for_h").alias("h"), F.col("id0").alias("next_id0"), F.col("h").alias("next_h"),
        "doc_id", "n_chars", "times", F.left("text", "need").alias("head"))
    pair = one.join(heads, key).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")), F.col("head")))
    carried = ["doc_id", *key, "n_chars", "next_id0", "next_h", "times", "edited_sha256"]
    both = F.concat(
        F.transform(paragraphs(F.col("text")), lambda u: F.struct(F.lit(False).alias("e"), u.alias("unit"))),
        F.transform(paragraphs(F.col("edited")), lambda u: F.struct(F.lit(True).alias("e"), u.alias("unit"))),
    )
    units = pair.withColumn("edited_sha256", sha256_hex(F.col("edited"))).select(*carried, F.explode_outer(both).alias("u"))
    sums = units.select(*carried, F.col("u.e").alias("e"), F.col("u.unit").alias("unit")).withColumns(hash_words("unit")).groupBy(
        *carried, "e").agg(F.count("unit").alias("_n"), *lane_sums(only=F.col("unit").isNotNull()))
    lanes = sums.select(*carried, F.coalesce("e", F.lit(False)).alias("e"), unpacked("_n", [f"_p{j}" for j in range(LANES // 2)]).alias("lanes"))
    zero = F.array_repeat(F.lit(0), LANES + 1)
    prints = materialise(
        lanes.groupBy(*carried).agg(
            F.coalesce(F.max(F.when(~F.col("e"), F.col("lanes"))), zero).alias("own"),
            F.coalesce(F.max(F.when(F.col("e"), F.col("lanes"))), zero).alias("changed"),
        ),
        "fingerprints",
    )
    following = prints.groupBy(F.col("id0").alias("next_id0"), F.col("h").alias("next_h")).agg(F.max("own").alias("next_own"))
    return (
        prints.join(following, ["next_id0", "next_h"])
        .select(
            "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("_copy"),
        )
        .drop("_copy")
    )
