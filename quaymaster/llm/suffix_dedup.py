"""Removal of every byte that a repeated 200-byte string covers, by sparse suffix arrays of shards.

1. Anchors. Of the 64-byte grams inside every 200-byte window the one of least hash (the leftmost, if
   equal) is an anchor. It depends on the window's bytes only, so two equal windows have
   equal anchors at equal offsets. An anchor's context are the bytes of all windows that hold it.
2. An anchor that occurs once proves its windows unique. Occurrences of equal contexts prove all
   their windows repeated: what copies and the insides of shared passages come down to. Both
   follow from counts of hashes. Left are anchors with several contexts, at the edges.
3. The different contexts of those anchors go into shards of bounded size, by anchor. A shard sorts, in place of
   all its suffixes, those that begin at anchors, and the texts before anchors, read backwards; common
   prefixes of neighbours in the two orders say which windows of one anchor and offset share 200 bytes. (The
   suffix array of a whole shard, by Larsson-Sadakane refinement with Kasai's prefixes, is kept as a
   reference: tests compare the two.)
4. An anchor with too many contexts for one shard has several. Each hands over its sorted
   distinct windows as hashes, cut into ranges; a merging task finds by binary search which windows of
   one shard occur in another.
5. Intervals are gathered by document and cut out of its text.

Text hashes have 64 bits; bytes are compared in step 3 only. Texts are UTF-8 bytes, null is empty.
Texts below 200 bytes keep everything. Repeated rows are repeats of each other. Other
columns ride along in ``without_repeats`` only.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from quaymaster.llm.common import blocks_of, held, map_batches, mix64, ship_package, window_minima
from quaymaster.session import materialise

SPAN = 200
GRAM = 64
REACH = SPAN - GRAM  # context bytes on either side of an anchor
SHARD = 4000  # contexts of a shard
POSITIONS = 24  # bits of a position in a block of text
KEY = ["id0", "h"]


# Anchors -----------------------------------------------------------------------------


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


FACTOR = 0xD6E8FEB86659FD93
INVERSE = pow(FACTOR, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2**64."""

    def make() -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(n + 1, FACTOR, np.uint64), np.full(n + 1, INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    return held(("powers", n), make)


class RangeHash:
    """Hash of any range of a byte array, from prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        n = 1 << max(20, (len(data) + 1).bit_length())
        up, self.down = powers(n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_values()[data] * up[: len(data)], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 64 bytes from each position on, doubling from one byte."""
    h, n, factor = byte_values()[data], 1, FACTOR
    while n < GRAM:
        h = mix64(h[:-n] * np.uint64(factor) + h[n:]) if n == GRAM // 2 else h[:-n] * np.uint64(factor) + h[n:]
        n, factor = n * 2, factor * factor & 0xFFFFFFFFFFFFFFFF
    return h


def window_anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted anchor positions of the texts [start, end) that make up ``data``, and the grams' hashes."""
    if len(data) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hashes(data)
    return window_minima(grams, starts, np.maximum(starts, ends - GRAM + 1), REACH + 1, POSITIONS), grams


def anchor_rows(texts: DataFrame) -> DataFrame:
    """(anchor, ctx, key, pos) of every anchor; ``ctx`` stands for the bytes around it and how they are cut off."""
    largest = 1 << (POSITIONS - 1)

    def one(data, starts, ends):
        at, grams = window_anchors(data, starts, ends)
        row = np.searchsorted(starts, at, "right") - 1
        left = np.minimum(at - starts[row], REACH)
        right = np.minimum(ends[row] - at - GRAM, REACH)
        ranged = RangeHash(data)
        ctx = mix64(ranged(at - left, at + GRAM + right) + (left * 1024 + right).astype(np.uint64) * np.uint64(FACTOR))
        return at, row, grams[at].view(np.int64), ctx.view(np.int64)

    def work(batch: pa.RecordBatch):
        body = batch.column("body")
        offsets = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
        data = np.frombuffer(body.buffers()[2], np.uint8) if body.buffers()[2] else np.zeros(0, np.uint8)
        id0, h = batch.column("id0").to_numpy(), batch.column("h").to_numpy()
        for a, b in blocks_of(np.diff(offsets)):
            base = offsets[a]
            starts, ends = offsets[a:b] - base, offsets[a + 1 : b + 1] - base
            block = data[base : offsets[b]]
            if len(block) <= largest:
                keep = ends > starts
                rows = np.flatnonzero(keep)
                at, row, anchor, ctx = one(block, starts[keep], ends[keep])
                if len(at):
                    row = rows[row]
                    yield {"anchor": anchor, "ctx": ctx, "id0": id0[a:b][row], "h": h[a:b][row], "pos": (at - starts[row]).astype(np.int32)}
                continue
            # One very long text: overlapping pieces, each owning the anchors that have their whole context in it.
            step = largest - 4 * SPAN
            for s in range(0, len(block), step):
                lo, hi = max(0, s - 2 * SPAN), min(len(block), s + step + 2 * SPAN)
                at, row, anchor, ctx = one(block[lo:hi], np.zeros(1, np.int64), np.full(1, hi - lo, np.int64))
                own = (at + lo >= s) & (at + lo < s + step)
                n = int(own.sum())
                if n:
                    yield {"anchor": anchor[own], "ctx": ctx[own], "id0": np.full(n, id0[a]), "h": np.full(n, h[a]),
                           "pos": (at[own] + lo).astype(np.int32)}

    return map_batches(texts, work, "anchor bigint, ctx bigint, id0 bigint, h bigint, pos int")


# Suffix arrays -----------------------------------------------------------------------


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Order of all suffixes by Larsson-Sadakane refinement: tied groups are sorted by the group after them."""
    n = len(data)
    symbols = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])  # 0 is the end
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = key << np.uint64(9) | symbols[k : k + n]
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    first = np.flatnonzero(fresh)
    group = np.empty(n + 1, np.int64)  # of a suffix: the first place of its group, from 1 on; 0 is the end
    number = np.repeat(first, np.diff(np.concatenate([first, [n]])))
    group[order] = number + 1
    group[n] = 0
    depth = 7
    while True:
        sizes = np.diff(np.concatenate([np.flatnonzero(fresh), [n]]))
        tied = np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        suffixes = order[at]
        after = group[np.minimum(suffixes + depth, n)]
        head = group[suffixes]
        place = np.lexsort((after, head))
        suffixes, after, head = suffixes[place], after[place], head[place]
        order[at] = suffixes
        new = np.concatenate([[True], (head[1:] != head[:-1]) | (after[1:] != after[:-1])])
        fresh[at] = new
        starts = np.flatnonzero(fresh)
        number = np.repeat(starts, np.diff(np.concatenate([starts, [n]])))
        group[order[at]] = number[at] + 1
        depth *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, fences: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, exact up to ``most`` less the distance to the last fence.

    Kasai's rule: a suffix whose left neighbour byte equals that of its predecessor shares one byte less
    than the suffix to its left. Only the others, and those at a fence, are compared byte by byte.
    """
    n = len(data)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    direct = np.ones(n, bool)
    inner = (i > 0) & (before > 0)
    direct[inner] = data[i[inner] - 1] != data[before[inner] - 1]
    direct[fences] = True
    direct[before < 0] = True
    direct[1:] |= before[:-1] < 0
    value = np.zeros(n, np.int64)
    live = np.flatnonzero(direct & (before >= 0))
    padded = np.concatenate([data.astype(np.int16), np.full(most + 8, -1, np.int16)])
    length = 0
    while len(live) and length < most:
        same = padded[live + length] == padded[before[live] + length]
        same &= np.maximum(live, before[live]) + length < n
        live = live[same]
        length += 1
        value[live] = length
    marks = np.maximum.accumulate(np.where(direct, i, 0))
    shared = np.maximum(value[marks] - (i - marks), 0)
    return shared[order]


def ordered_parts(parts: list[bytes], width: int, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the parts by anchor, then by their bytes, and the common prefix of each with the one before it.

    Parts are filled up with zeros to ``width``; with the part before of another anchor there is none (-1).
    """
    filled = np.array(parts, f"S{width}")
    order = np.argsort(filled, kind="stable")
    order = order[np.argsort(anchors[order], kind="stable")]
    data = filled.view(np.uint8).reshape(len(parts), width)[order]
    differ = data[1:] != data[:-1]
    shared = np.full(len(parts), -1, np.int64)
    shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared[1:][anchors[order][1:] != anchors[order][:-1]] = -1
    return order, shared


def repeated_windows(bodies: list[bytes], anchors: np.ndarray, lefts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a shard's contexts by their group of equals.

    Returns, for each window, its context, its start there, its group (windows of one anchor and one offset
    that share 200 bytes) and the group's size; windows by group.

    A window that begins ``o`` bytes before its anchor is ``o`` bytes before it and 200 - o from it on. Sorted are, in
    place of all suffixes of the shard, those that begin at an anchor, and the texts before anchors, read
    backwards: what shares k bytes is a run of either order, cut where a common prefix is below k.
    """
    m = len(bodies)
    none = np.zeros(0, np.int64)
    if not m:
        return none, none, none, none
    lengths = np.fromiter(map(len, bodies), np.int64, m)
    _, anchor = np.unique(anchors, return_inverse=True)
    after = ordered_parts([b[n:] for b, n in zip(bodies, lefts)], SPAN, anchor)
    before = ordered_parts([b[:n][::-1] for b, n in zip(bodies, lefts)], REACH, anchor)
    keys, found = [], []
    rank = np.empty((2, m), np.int64)
    for o in range(REACH + 1):
        at = np.flatnonzero((lefts >= o) & (lengths - lefts >= SPAN - o))
        if len(at):
            for side, (order, shared), k in ((0, after, SPAN - o), (1, before, o)):
                rank[side, order] = np.cumsum(shared < k)
            keys.append((o * (m + 1) + rank[0, at]) * (m + 1) + rank[1, at])
            found.append(np.stack([at, lefts[at] - o]))
    if not keys:
        return none, none, none, none
    key, (ctx, start) = np.concatenate(keys), np.concatenate(found, axis=1)
    place = np.argsort(key)
    key, ctx, start = key[place], ctx[place], start[place]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(new) - 1
    return ctx, start, group, np.bincount(group)[group]


def as_intervals(ctx: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered stretches (context, from, to) of windows given by context and start."""
    if not len(ctx):
        return ctx, start, start
    place = np.lexsort((start, ctx))
    ctx, start = ctx[place], start[place]
    new = np.ones(len(ctx), bool)
    new[1:] = (ctx[1:] != ctx[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(ctx)]]) - 1
    return ctx[first], start[first], start[last] + SPAN


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in ("anchor", "left", "copies", "id0", "h", "pos")}


INTERVALS = "id0 bigint, h bigint, start int, end int"


def resolve_shard(table: pa.Table) -> pa.Table:
    """Intervals of the single contexts of a shard."""
    c = _columns(table)
    ctx, start, _, size = repeated_windows(table.column("body").to_pylist(), c["anchor"], c["left"].astype(np.int64))
    hit = (size > 1) & (c["copies"][ctx] == 1)
    ctx, lo, hi = as_intervals(ctx[hit], start[hit])
    base = c["pos"][ctx] - c["left"][ctx]
    return pa.table({"id0": c["id0"][ctx], "h": c["h"][ctx], "start": (base + lo).astype(np.int32), "end": (base + hi).astype(np.int32)})


RUNS = "anchor bigint, range int, part bigint, hashes binary, id0 binary, h binary, at binary, single binary"


def offer_shard(table: pa.Table) -> pa.Table:
    """The windows of one shard of a split anchor, as sorted runs of hashes for the merge.

    Of each group of equals the first window is offered. ``single`` marks what is still to be decided;
    windows that the shard has found repeated are offered as evidence and handed on with it (range -1).
    """
    c = _columns(table)
    bodies = table.column("body").to_pylist()
    ctx, start, group, size = repeated_windows(bodies, c["anchor"], c["left"].astype(np.int64))
    anchor, part, parts = int(c["anchor"][0]), int(table.column("part")[0].as_py()), int(table.column("parts")[0].as_py())
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    begin = np.cumsum(lengths) - lengths
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    fc, fs = ctx[first], start[first]
    at = begin[fc] + fs
    offset = (c["left"][fc] - fs + SPAN).astype(np.uint64)
    hashes = mix64(RangeHash(np.frombuffer(b"".join(bodies), np.uint8))(at, at + SPAN) + offset * np.uint64(FACTOR))
    single = (size[first] == 1) & (c["copies"][fc] == 1)
    place = np.argsort(hashes)
    hashes, fc, fs, single = hashes[place], fc[place], fs[place], single[place]
    cuts = np.searchsorted(hashes, (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64))
    rows: dict[str, list] = {k: [] for k in ("anchor", "range", "part", "hashes", "id0", "h", "at", "single")}

    def add(number, hashes, ctx, at, single):
        for k, v in zip(rows, (anchor, number, part, hashes.tobytes(), c["id0"][ctx].astype(np.int64).tobytes(),
                               c["h"][ctx].astype(np.int64).tobytes(), at.astype(np.int64).tobytes(), single.tobytes())):
            rows[k].append(v)

    absolute = c["pos"][fc] - c["left"][fc] + fs
    for number, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(hashes)])):
        if hi > lo:
            add(number, hashes[lo:hi], fc[lo:hi], absolute[lo:hi], single[lo:hi])
    known = (size > 1) & (c["copies"][ctx] == 1)
    kc, ks = ctx[known], start[known]
    if len(kc):
        add(-1 - part, np.zeros(0, np.uint64), kc, c["pos"][kc] - c["left"][kc] + ks, np.zeros(0, bool))
    return pa.table(rows, schema=pa.schema([("anchor", pa.int64()), ("range", pa.int32()), ("part", pa.int64())] + [
        (k, pa.binary()) for k in ("hashes", "id0", "h", "at", "single")]))


def merge_runs(table: pa.Table) -> pa.Table:
    """Windows of one range of hashes that several shards hold, found by binary search in all runs together."""
    runs = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    everything = np.sort(np.concatenate(runs))
    found = []
    for i, run in enumerate(runs):
        id0, h, at = (np.frombuffer(table.column(k)[i].as_py(), np.int64) for k in ("id0", "h", "at"))
        if len(run):
            single = np.frombuffer(table.column("single")[i].as_py(), bool)
            copies = np.searchsorted(everything, run, "right") - np.searchsorted(everything, run, "left")
            hit = single & (copies > 1)
            id0, h, at = id0[hit], h[hit], at[hit]
        found.append(np.stack([id0, h, at]))
    id0, h, at = np.concatenate(found, axis=1)
    if not len(at):
        return pa.table({"id0": id0, "h": h, "start": at.astype(np.int32), "end": at.astype(np.int32)})
    place = np.lexsort((at, h, id0))
    id0, h, at = id0[place], h[place], at[place]
    new = np.ones(len(at), bool)
    new[1:] = (id0[1:] != id0[:-1]) | (h[1:] != h[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return pa.table({"id0": id0[first], "h": h[first], "start": at[first].astype(np.int32), "end": (at[last] + SPAN).astype(np.int32)})


# The whole ---------------------------------------------------------------------------


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    body = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")).alias("id0"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("h"), body.alias("body"), *more)


def contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (bucket, part, parts, anchor, copies, key, pos) with ``left`` and the context's ``body``."""
    lists = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("bucket", "part", "parts", "anchor", "copies", "pos")).alias("asked"))

    def work(batch: pa.RecordBatch):
        bodies, asked = batch.column("body"), batch.column("asked")
        counts = pa.compute.list_value_length(asked).to_numpy()
        row = np.repeat(np.arange(len(counts)), counts)
        flat = asked.flatten()
        get = {k: flat.field(k).to_numpy() for k in ("bucket", "part", "parts", "anchor", "copies", "pos")}
        cut, left, last, body = [], np.minimum(get["pos"], REACH), -1, b""
        for r, p, n in zip(row, get["pos"], left):
            if r != last:
                last, body = r, bodies[int(r)].as_py()
            cut.append(body[p - n : p + SPAN])
        yield {**get, "left": left, "body": cut, "id0": batch.column("id0").to_numpy()[row], "h": batch.column("h").to_numpy()[row]}

    return map_batches(
        texts.join(lists, KEY).select(*KEY, "body", "asked"), work,
        "bucket bigint, part bigint, parts bigint, anchor bigint, copies bigint, id0 bigint, h bigint, pos int, left int, body binary")


def repeats(docs: DataFrame, *more: Column) -> DataFrame:
    """Every row of ``docs`` (and ``more``) with its bytes and the intervals that repeats cover: (more, body, found)."""
    ship_package(docs.sparkSession)
    anchors = materialise(anchor_rows(keyed(docs)), "anchors")
    several = anchors.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("n > 1")
    shared = materialise(
        anchors.join(several.select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")), "anchor"), "shared-anchors")
    mixed = shared.where("mixed")
    each = materialise(mixed.groupBy("anchor", "ctx").agg(
        F.count("*").alias("copies"), F.min(F.struct(*KEY, "pos")).alias("at")), "contexts")
    many = each.groupBy("anchor").agg(F.ceil(F.count("*") / SHARD).alias("parts"))
    buckets = max(1, each.count() // SHARD + 1)
    wanted = each.join(many, "anchor").select(
        "anchor", "copies", "parts", F.col("at.id0").alias("id0"), F.col("at.h").alias("h"), F.col("at.pos").alias("pos")
    ).withColumns({
        "part": F.pmod(F.xxhash64(*KEY, "pos"), F.col("parts")), "bucket": F.pmod(F.xxhash64("anchor"), F.lit(buckets))})
    whole = shared.where(~F.col("mixed")).select(*KEY, "pos").unionByName(
        mixed.join(each.where("copies > 1").select("anchor", "ctx"), ["anchor", "ctx"]).select(*KEY, "pos")
    ).select(*KEY, (F.col("pos") - REACH).alias("start"), (F.col("pos") + SPAN).alias("end"))
    # All uses of the texts read the same columns by the same key: one exchange serves them.
    texts = keyed(docs, *more).repartition(*KEY)
    plain = [f.name for f in texts.schema.fields[3:]]
    small = contexts(texts, wanted.where("parts = 1")).groupBy("bucket").applyInArrow(resolve_shard, INTERVALS)
    split = contexts(texts, wanted.where("parts > 1")).groupBy("anchor", "part").applyInArrow(offer_shard, RUNS).groupBy(
        "anchor", "range").applyInArrow(merge_runs, INTERVALS)
    found = whole.unionByName(small).unionByName(split).groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "end")).alias("found"))
    return texts.join(found, KEY, "left").select(*plain, "body", "found")


def cut_out(found: DataFrame, passing: list[str], as_text: bool = False) -> DataFrame:
    """``passing`` columns with ``n_bytes``, ``spans`` (merged intervals) and ``kept``: the remaining bytes, or
    the text of the characters that are left whole."""

    def work(batch: pa.RecordBatch):
        kept, spans, sizes = [], [], []
        for body, asked in zip(batch.column("body").to_pylist(), batch.column("found").to_pylist()):
            merged: list[list[int]] = []
            for x in sorted((max(0, x["start"]), min(len(body), x["end"])) for x in asked or ()):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            rest, at = [], 0
            for lo, hi in merged:
                rest.append(body[at:lo])
                at = hi
            rest.append(body[at:])
            kept.append("".join(p.decode("utf-8", "ignore") for p in rest) if as_text else b"".join(rest))
            spans.append([{"start": lo, "end": hi} for lo, hi in merged])
            sizes.append(len(body))
        yield {**{c: batch.column(c) for c in passing}, "n_bytes": sizes, "spans": spans, "kept": kept}

    schema = ", ".join(
        [f"`{c}` {found.schema[c].dataType.simpleString()}" for c in passing]
        + ["n_bytes bigint", "spans array<struct<start: int, end: int>>", "kept string" if as_text else "kept binary"])
    return map_batches(found, work, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every document."""
    return cut_out(repeats(docs, F.col("doc_id").cast("bigint").alias("doc_id")), ["doc_id"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the covered bytes cut out of the texts; characters that lose a part of their bytes go.

    A null text stays null. ``n_chars``, if there, is counted anew.
    """
    others = F.struct(F.col("text").isNull().alias("_none"), *[c for c in docs.columns if c != "text"])
    done = cut_out(repeats(docs, others.alias("_doc")), ["_doc"], as_text=True)
    fresh = done.select("_doc", F.when(~F.col("_doc._none"), F.col("kept")).alias("_text"))
    return fresh.select(*[
        F.col("_text").alias("text") if c == "text"
        else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("_doc")[c].alias(c)
        for c in docs.columns])
