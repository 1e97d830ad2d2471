"""Benchmark decontamination by a prefix-filtered join of word shingles.

An item's windows are all runs of ten of its words; an item of fewer words, but not none, is one window. A
window is the set of its shingles of five words (a window of fewer than five is one shingle). A document
contains a window only if it contains all of its shingles, so the rarest one, a prefix of one token in
the order of rarity, is a necessary condition:

1. Documents are cut into words once. The shingles that stand in some window are kept with their
   position; a row of position -1 stands for every document.
2. Shingles are ordered by how often all documents hold them. Only the rarest of a window looks for
   candidates: its place in the window and in the document give the window's place there, which has to lie
   inside the document (positional and length bounds).
3. Containment is verified over that stretch: the shingles at its first and its last place, which cover it, have to be
   those of the window. Shingles are compared as text, so no hash decides.

Texts do not move: what is written and shuffled is one small row a document and the shingles shared with the benchmark. The
shingles of the benchmark are broadcast if they take at most ``BROADCAST_BYTES`` by their measured size; otherwise
both sides are shuffled. A frequent shingle makes rows in proportion to its places in documents.

Words are ``WORD`` after A-Z are lower-cased. Null texts have no words. Rows are taken as they are: repeated documents
return repeatedly. Items without id mark words, but are neither counted nor named; items of one id are one item. An empty
benchmark contaminates nothing, no documents give no rows. Other columns are not looked at. Memory follows the longest text.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from quaymaster.session import materialise

# Fixed values of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64  # of a broadcast row besides its text


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def runs(words: Column, size: int | Column) -> Column:
    """All runs of ``size`` words, in order; none if there are fewer words."""
    last = F.size(words) - size
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, size), " "))
    return F.when(last >= 0, cut).otherwise(F.array().cast("array<string>"))


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct (item_id, window, length) of the items that have words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    sized = items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    return sized.select("item_id", "length", F.explode(runs(F.col("words"), F.col("length"))).alias("window")).distinct()


def shingles_of(windows: DataFrame, size: int) -> DataFrame:
    """(window, length, size, grams) of every distinct window; ``grams`` are its shingles in order."""
    one = windows.select("window", "length").distinct().withColumn("size", F.least("length", F.lit(size)))
    return one.withColumn("grams", runs(F.split("window", " "), F.col("size")))


def run_hashes(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, in order."""
    last = F.size(words) - size
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def hash_of(gram: Column, sizes: list[int]) -> Column:
    """The hash of a shingle as ``run_hashes`` makes it."""
    words = F.split(gram, " ")
    same = [F.when(F.size(words) == s, F.xxhash64(*[F.get(words, F.lit(k)) for k in range(s)])) for s in sizes]
    return F.when(gram == "", F.lit(0)).otherwise(F.coalesce(*same, F.lit(0)))


def shared_shingles(docs: DataFrame, wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, doc_id, n_words, pos, gram): a row of position -1 for every document, and one for every shingle in ``wanted``.

    The empty text is in ``wanted`` and stands once in every document, so that every one keeps a row in the join.
    """
    cut = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), words_of(F.col("text")).alias("words"))
    words, kept = F.col("words"), ["row", "doc_id", F.size("words").cast("bigint").alias("n_words")]
    # Positions count on from the runs of one size to those of the next.
    ends, end = [], F.lit(0)
    for s in sizes:
        ends.append((s, end, end + F.greatest(F.col("n_words") - s + 1, F.lit(0))))
        end = ends[-1][2]
    at, pos, size = F.col("at") - 1, F.when(F.col("at") == 0, F.lit(-1)), F.when(F.col("at") == 0, F.lit(0))
    for s, start, stop in ends:
        pos, size = pos.when(at < stop, (at - start).cast("int")), size.when(at < stop, F.lit(s))
    # The arrays are never empty; the outer explode keeps Spark from making them once more to test that.
    need = wanted.agg(F.coalesce(F.sum(F.octet_length("gram") + ROW_BYTES), F.lit(0))).first()[0]
    if need > BROADCAST_BYTES:
        grams = cut.select(*kept, F.concat(F.array(F.lit("")), *[runs(words, s) for s in sizes]).alias("grams"))
        placed = grams.select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("at", "gram"))
        return placed.withColumn("pos", pos).join(wanted, "gram").select("row", "doc_id", "n_words", "pos", "gram")
    # Hashes find the few shingles whose text is made and compared. The words of a document stay where they are meanwhile:
    # explode, join and comparison are one generated function. Two inequalities, as an equation would become a key
    # of the join, to be made for every shingle.
    hashes = cut.select(*kept, "words", F.concat(F.array(F.lit(0).cast("bigint")), *[run_hashes(words, s) for s in sizes]).alias("hashes"))
    placed = hashes.select("row", "doc_id", "n_words", "words", F.posexplode_outer("hashes").alias("at", "hash"))
    near = placed.join(F.broadcast(wanted.withColumn("hash", hash_of(F.col("gram"), sizes))), "hash")
    said = F.when(F.col("at") == 0, "").otherwise(F.array_join(F.slice("words", F.greatest(pos, F.lit(0)) + 1, size), " "))
    same = near.where((F.col("gram") >= said) & (F.col("gram") <= said))
    return same.select("row", "doc_id", "n_words", pos.alias("pos"), "gram")


def prefixes(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """The rarest shingle of every window whose shingles all occur: (gram, offset, window, length, first, last, last_offset)."""
    placed = grams.select("window", "length", "size", F.element_at("grams", 1).alias("first"), F.element_at("grams", -1).alias("last"),
                          F.posexplode("grams").alias("offset", "gram"))
    known = placed.join(counts, "gram", "left").withColumn("places", F.coalesce("places", F.lit(0)))
    rarest = known.groupBy("window", "length", "size", "first", "last").agg(
        F.min(F.struct("places", "gram", "offset")).alias("rarest"))
    return rarest.where("rarest.places > 0").select(
        F.col("rarest.gram").alias("gram"), F.col("rarest.offset").alias("offset"), "window", "length", "first", "last",
        (F.col("length") - F.col("size")).alias("last_offset"))


def occurrences(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, start, length, window) of every place of a window in a document."""
    near = found.where("pos >= 0").join(wanted, "gram").select(
        "row", "n_words", "window", "length", "first", "last", "last_offset", (F.col("pos") - F.col("offset")).alias("start"))
    inside = near.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    for gram, shift in (("first", F.lit(0)), ("last", F.col("last_offset"))):
        there = found.select(F.col("row").alias("_row"), F.col("pos").alias("_pos"), F.col("gram").alias("_gram"))
        same = (F.col("row") == F.col("_row")) & (F.col("start") + shift == F.col("_pos")) & (F.col(gram) == F.col("_gram"))
        inside = inside.join(there, same, "left_semi")
    return inside.select("row", "start", "length", "window")


def covered(spans: Column) -> Column:
    """Words under (start, stop) spans that are sorted by start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(spans, zero, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["end"]))).alias("n"), F.greatest(s["end"], x["stop"]).alias("end")))
    return total["n"].cast("bigint")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every document with ``n_words``, ``spans`` (start and stop of the found windows, in words, by start) and ``items`` (sorted ids).

    ``spans`` and ``items`` are null where nothing is found or named.
    """
    size = (window + 1) // 2  # two shingles cover a window
    holders = materialise(windows_of(benchmark, window), "item-windows")
    grams = materialise(shingles_of(holders, size), "item-shingles")
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # at most ``size`` numbers
    mark = docs.sparkSession.range(1).select(F.lit("").alias("gram"))
    wanted = materialise(grams.select(F.explode("grams").alias("gram")).union(mark).distinct(), "item-grams")
    found = materialise(shared_shingles(docs, wanted, sizes), "shared-shingles")
    # Aggregates are written before they are joined: a side that is a plain exchange can be split at a hot key.
    counts = materialise(found.where("pos >= 0").groupBy("gram").agg(F.count("*").alias("places")), "shingle-places")
    places = materialise(occurrences(found, materialise(prefixes(grams, counts), "rarest-shingles")), "window-places")
    spans = places.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("stop")))).alias("spans"))
    named = places.select("row", "window").distinct().join(
        holders.where("item_id IS NOT NULL").select("window", "item_id"), "window")
    items = named.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return found.where("pos = -1").select("row", "doc_id", "n_words").join(spans, "row", "left").join(items, "row", "left").drop("row")
