"""Near copies by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its runs of five words (in lower case, parted by white space; a
shorter text is one run). A weight is (1 + ln tf) times an inverse document frequency,
ln(1 + N / df) / ln(1 + N), of every shingle: 1 for one that a single document of the N holds, less for each further
document, so boilerplate counts little. Documents are counted after copies and their variants are folded: a first pass
with equal frequencies joins texts from a similarity of 0.7 on, and one text of each group counts, so the size of a group of
copies does not matter, nor do those of its texts that fall just short of a copy. Two texts are linked if their weighted
Jaccard similarity is at least 0.8; classes are the connected components of the second pass.

* Document frequencies are exact. Texts are dealt to blocks of about 8 MB; a block sends each of its shingles once, with
  the number of its documents, to the part of its hash. A part adds up and answers each block with its shingles
  that more than one document holds, so a shingle of all documents is a row of each block, not of each document.
* Signatures: 64 samples of improved consistent weighted sampling, in 16 bands of 4. A pair at
  0.8 shares a band with probability 0.9998, one at 0.3 with 0.12.
* Links: equal texts are one node. A band's bucket is three stars: all its texts are compared with three
  of them. What is still in different components then is compared completely: the
  texts outside the bucket's largest component against all its texts of other components, in blocks,
  so no class that banding finds is lost.
* Every candidate pair is verified on its whole texts.

Null texts are empty. Equal texts are in one class, empty ones too; a text of white space
has no shingles and is linked to equal texts only. A class has the least ``doc_id`` of its rows (null
if all are null). Other columns are ignored, repeated rows stay rows.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymaster.llm.common import blocks_of, map_batches, mix64, release, ship_package, tidy
from quaymaster.llm.components import components
from quaymaster.session import free_driver, materialise, scratch_scope

WORDS = 5
SIMILARITY = 0.8
FOLDED = 0.7  # similarity, by equal frequencies, from which on texts count as one document
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
BLOCK_BYTES = 8 << 20  # of texts whose shingles are counted together
PART_BYTES = 24 << 20  # of texts, for each part that the shingles are dealt to
LEADERS = 3  # texts of a bucket that all its texts are compared with at first
BLOCK = 1000  # texts of a bucket that meet as many others in one task
MEMBERS = 1000  # links of a leader that one task verifies
DRAWN = 1 << 14  # elements that are drawn from together, so that the arrays of a sample stay in a core's cache
SIGNED = 4_000_000  # characters of texts that are signed together
LIKELY = 6  # no element of a set is below this number over its weight with probability exp(-6)
GRID = 1 << 17  # points of a distribution that are held at a time

MIXERS = [np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)]  # of mix64
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


SPACE = np.zeros(256, bool)  # the white space of ASCII
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
PIECE = 1 << 16  # bytes that are hashed together, so that tables of powers stay small
LETTERS = mix64(np.arange(1, 257, dtype=np.uint64) * MULTIPLIERS[0])  # a number for each byte


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and those of its inverse."""
    factor = 0x9E3779B97F4A7C15
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(PIECE, x, np.uint64))) for x in (factor, pow(factor, -1, 1 << 64)))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of ``data``, which are parted by white space of ASCII.

    A word's hash is the sum of its letters' numbers by powers, the difference of two sums from the first letter on.
    """
    letters = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(letters) + 2, bool)
    np.logical_not(SPACE[letters], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    up, down = powers()
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(stops, base + PIECE, "right")))
        if stops[j - 1] - base > PIECE:
            out[i] = xxhash.xxh3_64_intdigest(data[base : stops[i]])
        else:
            n = stops[j - 1] - base
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(LETTERS[letters[base : base + n]] * up[:n], out=total[1:])
            at = starts[i:j] - base
            out[i:j] = (total[stops[i:j] - base] - total[at]) * down[at]
        i = j
    return starts, mix64(out)


def shingles_of(texts: list[str | None]) -> list[np.ndarray]:
    """For each text, the hashes of its runs of five words, in order."""
    out: list[np.ndarray] = []
    for start, stop in blocks_of([len(t or "") for t in texts], PIECE):
        lower = [(t or "").lower() for t in texts[start:stop]]
        data = [(t if t.isascii() else " ".join(t.split())).encode() for t in lower]
        at, h = word_hashes(b" ".join(data))
        ends = np.searchsorted(at, np.cumsum([len(d) + 1 for d in data])).tolist()
        n = len(h) - WORDS + 1
        runs = np.zeros(max(0, n), np.uint64)
        for k in range(WORDS if n > 0 else 0):
            runs += h[k : k + n] * MULTIPLIERS[k]
        runs = mix64(runs)
        for lo, hi in zip([0, *ends], ends):
            if hi - lo >= WORDS:
                out.append(runs[lo : hi - WORDS + 1])
            else:  # one run of all words, if there are any
                out.append(mix64((h[lo:hi] * MULTIPLIERS[: hi - lo]).sum(keepdims=True)) if hi > lo else np.zeros(0, np.uint64))
    return out


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the runs of five words, in order."""
    return shingles_of([text])[0]


def weighted(text: str | None, common: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their weights. ``common`` is sorted and has ``idf`` beside it."""
    return weighed(shingles(text), common, idf)


def weighed(runs: np.ndarray, common: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of the runs of a text."""
    found, counts = np.unique(runs, return_counts=True)
    weights = 1.0 + np.log(counts)
    if len(common) and len(found):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        hit = common[at] == found
        weights[hit] *= idf[at[hit]]
    return found, weights


# Document frequencies ----------------------------------------------------------------


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    """Consecutive stretches of ``values``; ``starts`` has the end as well."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values))


def _flat(table: pa.Table, name: str, dtype) -> np.ndarray:
    """The values of all lists of a column."""
    found = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks]
    return np.concatenate([np.zeros(0, dtype), *found]).astype(dtype, copy=False)


def common_shingles(texts: DataFrame, total: int, blocks: int, parts: int) -> DataFrame:
    """The shingles that two or more documents hold, for each block of ``texts`` (block, text, counted) that has them.

    Of the texts, ``total`` are counted as documents. Returns (block, shingles, idf), several rows a block.
    """

    def of_block(key: tuple, table: pa.Table) -> pa.Table:
        each = [np.unique(x) for x in shingles_of(table.column("text").to_pylist())]
        counted, none = table.column("counted").to_pylist(), np.zeros(0, np.uint64)
        keys, n = np.unique(np.concatenate([none, *each]), return_counts=True)
        other, folded_n = np.unique(np.concatenate([none, *[x for x, c in zip(each, counted) if not c]]), return_counts=True)
        n[np.searchsorted(keys, other)] -= folded_n
        part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)  # in the order of the keys
        there, starts = np.unique(part, return_index=True)
        ends = np.append(starts, len(keys))
        return pa.table({
            "part": pa.array(there, pa.int32()), "block": pa.array(np.full(len(there), key[0].as_py()), pa.int64()),
            "shingles": _lists(keys.view(np.int64), ends), "n": _lists(n.astype(np.int32), ends)})

    def of_part(table: pa.Table) -> pa.Table:
        release()
        keys, n = _flat(table, "shingles", np.int64), _flat(table, "n", np.int64)
        row = np.repeat(np.arange(table.num_rows), pa.compute.list_value_length(table.column("shingles")).to_numpy())
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, np.int64)
        df = np.empty(len(keys), np.int64)
        df[order] = np.repeat(np.add.reduceat(n[order], starts) if len(keys) else n, np.diff(np.append(starts, len(keys))))
        hit = df >= 2
        ends = np.append(0, np.cumsum(np.bincount(row[hit], minlength=table.num_rows)))
        idf = (np.log1p(total / df[hit]) / np.log1p(total)).astype(np.float32)
        found = pa.table({"block": table.column("block").combine_chunks(), "shingles": _lists(keys[hit], ends), "idf": _lists(idf, ends)})
        tidy()
        return found.filter(pa.array(np.diff(ends) > 0))

    ship_package(texts.sparkSession)
    dealt = texts.groupBy("block").applyInArrow(of_block, "part int, block bigint, shingles array<bigint>, n array<int>")
    return dealt.groupBy("part").applyInArrow(of_part, "block bigint, shingles array<bigint>, idf array<float>")


def signed_again(texts: DataFrame, common: DataFrame) -> DataFrame:
    """``texts`` (block, tid, text) as (tid, sig, common, idf): signatures by weight, and what is common of a text's shingles."""

    def sign(rows: pa.Table, known: pa.Table) -> pa.Table:
        keys, idf = _flat(known, "shingles", np.int64).view(np.uint64), _flat(known, "idf", np.float32)
        order = np.argsort(keys)
        keys, idf = keys[order], idf[order]
        sigs, own, own_idf, strings = [], [], [], rows.column("text").to_pylist()
        for start, stop in blocks_of(map(len, strings), SIGNED):
            sets = []
            for found, counts in (np.unique(x, return_counts=True) for x in shingles_of(strings[start:stop])):
                weights = 1.0 + np.log(counts)
                at = np.minimum(np.searchsorted(keys, found), max(0, len(keys) - 1))
                hit = keys[at] == found if len(keys) else np.zeros(len(found), bool)
                at = at[hit]
                weights[hit] *= idf[at]
                sets.append((found, weights))
                own.append(found[hit].view(np.int64))
                own_idf.append(idf[at])
            full = [s for s in sets if len(s[0])]
            drawn = iter(signatures(full)) if full else iter(())
            sigs += [next(drawn) if len(s[0]) else None for s in sets]
        ends = np.append(0, np.cumsum([len(x) for x in own])).astype(np.int64)
        return pa.table({
            "tid": rows.column("tid"), "sig": pa.array(sigs, pa.list_(pa.int32())),
            "common": _lists(np.concatenate([np.zeros(0, np.int64), *own]), ends),
            "idf": _lists(np.concatenate([np.zeros(0, np.float32), *own_idf]), ends)})

    ship_package(texts.sparkSession)
    return texts.select("block", "tid", "text").groupBy("block").cogroup(common.groupBy("block")).applyInArrow(
        sign, "tid binary, sig array<int>, common array<bigint>, idf array<float>")


def listed(rows: pa.RecordBatch | pa.Table, text: str, common: str, idf: str):
    """The weighted set of each row, by its text, the text's common shingles and their frequencies; that of the row before if the text is."""
    for batch in rows.to_batches() if isinstance(rows, pa.Table) else [rows]:
        keys, weights = batch.column(common), batch.column(idf)
        k, w = keys.values.to_numpy(zero_copy_only=False).view(np.uint64), weights.values.to_numpy(zero_copy_only=False)
        k_at, w_at = keys.offsets.to_numpy(), weights.offsets.to_numpy()
        texts, own = batch.column(text).to_pylist(), None
        for start, stop in blocks_of(map(len, texts)):
            new = [i for i in range(start, stop) if i == start or texts[i] != texts[i - 1]]
            runs = dict(zip(new, shingles_of([texts[i] for i in new])))
            for i in range(start, stop):
                if i in runs:
                    own = weighed(runs.pop(i), k[k_at[i] : k_at[i + 1]], w[w_at[i] : w_at[i + 1]])
                yield own


# Signatures --------------------------------------------------------------------------


@lru_cache(maxsize=1)
def gamma_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution in 2**16 steps, their inverses and logarithms."""
    # The grid is walked in steps: all workers of an executor do this at once, and the whole would take 130 MB in each.
    points, step, share = 4_000_000, 40 / 4_000_000, (np.arange(1 << 16) + 0.5) / (1 << 16)
    r = np.empty(1 << 16)
    for start in range(0, points, GRID):
        x = np.arange(start, min(start + GRID, points) + 1) * step
        cdf = 1 - np.exp(-x) * (1 + x)
        lo, hi = np.searchsorted(share, cdf[[0, -1]]) if start + GRID < points else (np.searchsorted(share, cdf[0]), 1 << 16)
        r[lo:hi] = np.interp(share[lo:hi], cdf, x)
    return r.astype(np.float32), (1 / r).astype(np.float32), np.log(r).astype(np.float32)


@lru_cache(maxsize=16)
def reachable(reach: float) -> np.ndarray:
    """For each quantile of r, the greatest of c for which ln c - r is at most ``reach``, or 0."""
    r_of, _, log_of = gamma_tables()
    return np.maximum(np.searchsorted(log_of, r_of + np.float32(reach + 1e-3), "right") - 1, 0).astype(np.uint16)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """64 samples of each weighted set, one row a set; sets must not be empty.

    For each sample, an element's hash gives r and c by Gamma(2, 1) and beta uniformly; with
    t = floor(ln w / r + beta), the element of least ln c - r (t + 1 - beta) is drawn, together with t.
    """
    out = np.empty((len(sets), SAMPLES), np.int32)
    sizes, total = (np.array(x) for x in zip(*((len(w), w.sum()) for _, w in sets)))
    top = np.array([np.log(w.max()) for _, w in sets], np.float32)
    alike = np.stack([np.ceil(2 * top), np.log2(total) // 2])  # sets with such bounds are drawn from together
    order = np.lexsort(alike)
    for group in np.split(order, np.flatnonzero(np.diff(alike[:, order]).any(axis=0)) + 1):
        for start, stop in blocks_of(sizes[group].tolist(), DRAWN):
            rows = group[start:stop]
            limit = float(np.log(LIKELY / total[rows].min()))
            out[rows] = _draw([sets[i] for i in rows], sizes[rows], limit, limit + float(top[rows].max()))
    return out


def _draw(sets: list[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray, limit: float, reach: float) -> np.ndarray:
    """The samples of some sets.

    ln c - r - ln w is a lower bound of what is least in the sample. Elements where it is above ``limit`` are left out; a
    set in which no other is at most ``limit`` is drawn from as a whole. So the samples are those of all elements.
    """
    starts = np.cumsum(sizes) - sizes
    elements = np.concatenate([s[0] for s in sets])
    log_w = np.log(np.concatenate([s[1] for s in sets])).astype(np.float32)
    greatest = reachable(np.ceil(4 * reach) / 4)
    n = len(elements)
    h, moved = np.empty(n, np.uint64), np.empty(n, np.uint64)
    r, c, near = np.empty(n, np.intp), np.empty(n, np.uint16), np.empty(n, bool)
    bits = h.view(np.uint16).reshape(n, 4)
    out = np.empty((len(sets), SAMPLES), np.int32)
    missed: list[tuple[int, int]] = []
    hashes, places, held, first = [], [], 0, 0
    for k in range(SAMPLES):
        _hashes(elements, k, h, moved)
        r[:] = bits[:, 0]
        np.less_equal(bits[:, 1], np.take(greatest, r, out=c, mode="clip"), out=near)
        at = np.flatnonzero(near)
        hashes.append(h[at])
        places.append(at + (k - first) * n)
        held += len(at)
        if held < DRAWN // 2 and k + 1 < SAMPLES:
            continue
        samples = np.arange(k + 1 - first)
        place = np.concatenate(places)
        packed = np.append(_ranked(np.concatenate(hashes), log_w[place % n]), np.iinfo(np.int64).max)
        lo = np.searchsorted(place, (samples[:, None] * n + starts).ravel())
        best = np.minimum.reduceat(packed, lo)
        out[:, first : k + 1] = best.view(np.int32)[::2].reshape(len(samples), -1).T
        bound = _order(np.array([limit], np.float32))[0]
        none = (np.diff(np.append(lo, len(place))) == 0) | (best.view(np.int32)[1::2] > bound)
        missed += [(first + i // len(sets), i % len(sets)) for i in np.flatnonzero(none).tolist()]
        hashes, places, held, first = [], [], 0, k + 1
    for k, i in missed:
        lo, hi = starts[i], starts[i] + sizes[i]
        _hashes(elements[lo:hi], k, h[lo:hi], moved[lo:hi])
        out[i, k] = _ranked(h[lo:hi], log_w[lo:hi]).min(keepdims=True).view(np.int32)[0]
    return out


def _hashes(elements: np.ndarray, k: int, h: np.ndarray, moved: np.ndarray) -> None:
    """The elements' hashes for sample ``k``, into ``h``: mix64 in place."""
    np.add(elements, np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), out=h)
    for factor in MIXERS:
        h ^= np.right_shift(h, np.uint64(33), out=moved)
        h *= factor
    h ^= np.right_shift(h, np.uint64(33), out=moved)


def _order(a: np.ndarray) -> np.ndarray:
    """Integers in the order of the numbers."""
    bits = a.view(np.int32)
    return bits ^ ((bits >> np.int32(31)) & np.int32(0x7FFFFFFF))


def _ranked(h: np.ndarray, log_w: np.ndarray) -> np.ndarray:
    """What is least in a sample, with 32 bits below that tell the element and its t."""
    r_of, inverse_of, log_of = gamma_tables()
    bits = h.view(np.uint16).reshape(-1, 4)
    i, beta = bits[:, 0].astype(np.intp), bits[:, 2].astype(np.float32) * np.float32(1 / 65536)
    t = np.floor(log_w * inverse_of[i] + beta)
    a = log_of[bits[:, 1].astype(np.intp)] - r_of[i] * (t + np.float32(1) - beta)
    packed = np.empty(len(h), np.int64)
    packed.view(np.int32)[1::2] = _order(a)
    packed.view(np.uint32)[::2] = ((h >> np.uint64(20)) ^ t.astype(np.int64).view(np.uint64) * MULTIPLIERS[0]).view(np.uint32)[::2]
    return packed


def signed(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, tid, text) with ``sig``, by equal frequencies, in place of the text; null where there are no shingles."""
    none, nothing = np.zeros(0, np.uint64), np.zeros(0)

    def work(batch: pa.RecordBatch):
        column = batch.column("text")
        lengths = pa.compute.binary_length(column).to_numpy(zero_copy_only=False)
        for start, stop in blocks_of(lengths, SIGNED):
            part = batch.slice(start, stop - start)
            strings = part.column("text").to_pylist()
            first: dict[str, int] = {}
            place = [first.setdefault(t, len(first)) for t in strings]
            sets = [weighed(x, none, nothing) for x in shingles_of(list(first))]
            full = [i for i, s in enumerate(sets) if len(s[0])]
            rows = signatures([sets[i] for i in full]) if full else np.zeros((0, SAMPLES), np.int32)
            by_text: dict[int, np.ndarray] = dict(zip(full, rows))
            yield {"doc_id": part.column("doc_id"), "tid": part.column("tid"), "sig": [by_text.get(i) for i in place]}

    return map_batches(texts, work, "doc_id bigint, tid binary, sig array<int>")


# Links -------------------------------------------------------------------------------


def text_id(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.substring(F.sha2(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"), 256), 1, 32))


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) of nodes whose texts are similar enough. ``texts`` has a row (node, text, common, idf) for each node.

    The members of a leader u are dealt to as many tasks as they need, each with a copy of its text.
    """
    parts = F.ceil(F.count("*") / MEMBERS)
    hot = pairs.groupBy("u").agg(parts.alias("parts"))
    dealt = pairs.join(hot, "u").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts"))).drop("parts")
    leaders = hot.select("u", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    side = lambda name: [F.col(c).alias(f"{name}_{c}") for c in ("text", "common", "idf")]
    left = texts.join(leaders, texts["node"] == leaders["u"]).select("u", "part", *side("a"))
    right = texts.join(dealt, texts["node"] == dealt["v"]).select("u", "part", "v", *side("b"))

    def work(batch: pa.RecordBatch):
        a, b = (listed(batch, f"{name}_text", f"{name}_common", f"{name}_idf") for name in "ab")
        mask = pa.array([similarity(x, y) >= least for x, y in zip(a, b)], pa.bool_())
        yield {"u": batch.column("u").filter(mask), "v": batch.column("v").filter(mask)}

    return map_batches(right.join(left, ["u", "part"]).drop("part"), work, "u bigint, v bigint")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of least over the sum of greatest weights."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    j = np.flatnonzero(a[0][at] == b[0])
    i = at[j]
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def star_pairs(keys: DataFrame, leader: Column) -> DataFrame:
    """Every bucket's members paired with one of them, the one of least ``leader``; keys is (key, node, comp)."""
    heads = keys.groupBy("key").agg(F.min(F.struct(leader.alias("o"), "node", "comp")).alias("head"))
    met = keys.join(heads, "key").where(F.col("comp") != F.col("head.comp"))
    return met.select(F.col("head.node").alias("u"), F.col("node").alias("v")).distinct()


def remaining_links(keys: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (u, v) between texts of a bucket that are in different components; keys is (key, node, comp).

    The texts outside a bucket's largest component are the queries; each is compared with all its
    texts of other components, in blocks of texts that go to a task together. One link is returned for a query and
    another component. A bucket of two has been compared already.
    """
    sizes = keys.groupBy("key", "comp").agg(F.count("*").alias("n"))
    tops = sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all")).where("all > 2").select(
        "key", F.col("top.comp").alias("top"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("asking"))
    placed = keys.join(tops, "key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    some = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    asked = placed.where("comp <> top").select("key", some("asking").alias("q"), every("blocks").alias("b"), "node", "comp")
    rows = placed.select("key", every("asking").alias("q"), some("blocks").alias("b"), "node", "comp")

    def compare(queries: pa.Table, members: pa.Table) -> pa.Table:
        u, v = [], []
        if queries.num_rows and members.num_rows:
            sets = list(listed(members, "m_text", "m_common", "m_idf"))
            node, comp = members.column("m_node").to_numpy(), members.column("m_comp").to_numpy()
            total = np.array([w.sum() for _, w in sets])
            shingle, of = np.concatenate([x for x, _ in sets]), np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
            weight = np.concatenate([w for _, w in sets])
            order = np.argsort(shingle, kind="stable")
            shingle, of, weight = shingle[order], of[order], weight[order]
            asking = (queries.column(c).to_pylist() for c in ("node", "comp"))
            for q_node, q_comp, (x, w) in zip(*asking, listed(queries, "text", "common", "idf")):
                lo, n = np.searchsorted(shingle, x), np.searchsorted(shingle, x, "right") - np.searchsorted(shingle, x)
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                shared = np.bincount(of[at], np.minimum(weight[at], np.repeat(w, n)), len(sets))
                hit = np.flatnonzero((shared >= least * (w.sum() + total - shared)) & (comp != q_comp))
                _, first = np.unique(comp[hit], return_index=True)
                u += [q_node] * len(first)
                v += node[hit[first]].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    columns = ["key", "q", "b", "node", "comp", "text", "common", "idf"]
    left = asked.join(texts, "node").select(*columns)
    right = rows.join(texts, "node").select(*[F.col(c).alias(f"m_{c}") for c in columns])
    return left.groupBy("key", "q", "b").cogroup(right.groupBy("m_key", "m_q", "m_b")).applyInArrow(compare, "u bigint, v bigint")


def mixed_buckets(keys: DataFrame, joined: DataFrame) -> DataFrame:
    """Bucket members with their component, of the buckets that hold more than one."""
    placed = keys.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return materialise(placed.join(mixed, "key"), "mixed-buckets")


def linked(rows: DataFrame, texts: DataFrame, least: float) -> tuple[DataFrame, ...]:
    """The nodes (tid, sig, common, idf, node) of signed texts, the links (u, v) of ``least`` similarity and the classes (node, component).

    ``rows`` is (tid, sig, common, idf), ``texts`` (tid, text).
    """
    nodes = materialise(
        rows.dropDuplicates(["tid"]).select("tid", "sig", "common", "idf", F.monotonically_increasing_id().alias("node")), "text-nodes")
    sigs = nodes.where("sig IS NOT NULL").select("node", "sig")
    band = lambda i: F.xxhash64(i, *[F.get("sig", i * ROWS + j) for j in range(ROWS)])
    buckets = sigs.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)).alias("key"))
    full = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    keys = materialise(buckets.join(full, "key").select("key", "node", F.col("node").alias("comp")), "buckets")
    wanted = keys.select("node").distinct().join(nodes.select("node", "tid", "common", "idf"), "node")
    texts_by_node = materialise(
        texts.dropDuplicates(["tid"]).join(wanted, "tid").select("node", "text", "common", "idf"), "candidate-texts")

    def check(pairs: DataFrame) -> DataFrame:
        each = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        return materialise(verified(materialise(each, "pairs"), texts_by_node, least), "links")

    orders = [F.col("node"), *[F.xxhash64(F.lit(i), "node") for i in range(1, LEADERS)]]
    pairs = reduce(DataFrame.unionByName, [star_pairs(keys, order) for order in orders])
    links = check(pairs)
    joined = materialise(components(links), "components")
    more = materialise(remaining_links(mixed_buckets(keys, joined), texts_by_node, least), "links")
    if not more.isEmpty():
        links = materialise(links.unionByName(more).distinct(), "links")
        joined = materialise(components(links), "components")
    return nodes, links, joined


def folded(texts: DataFrame, nodes: DataFrame, joined: DataFrame) -> DataFrame:
    """Every text once as (tid, text, counted); of a group, the text of its least node is counted."""
    counted = F.col("component").isNull() | (F.col("component") == F.col("node"))
    heads = nodes.select("tid", "node").join(joined, "node", "left").select("tid", counted.alias("counted"))
    return texts.select("tid", "text").dropDuplicates(["tid"]).join(heads, "tid")


def weighted_rows(texts: DataFrame) -> DataFrame:
    """``texts`` (tid, text, counted) signed by their weights."""
    size = texts.agg(F.count_if("counted").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks, parts = (int((size["bytes"] or 0) // share) + 1 for share in (BLOCK_BYTES, PART_BYTES))
    placed = texts.withColumn("block", F.pmod(F.xxhash64("tid"), F.lit(blocks).cast("bigint")))
    common = materialise(common_shingles(placed.select("block", "text", "counted"), size["n"], blocks, parts), "common-shingles")
    return materialise(signed_again(placed, common), "signatures")


def near_copies(docs: DataFrame) -> DataFrame:
    """Every document with its class: (doc_id, tid, component, class_id, class_rows, links).

    ``links`` counts the verified comparisons that joined the document's text to its class, not all similar texts:
    in large groups there are far fewer, and which they are depends on the leaders drawn. Equal texts are one text.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        text_id(F.col("text")).alias("tid"))
    spark, none = docs.sparkSession, [F.array().cast("array<bigint>").alias("common"), F.array().cast("array<float>").alias("idf")]
    with scratch_scope(spark) as keep:
        signs = materialise(signed(texts), "signatures")
        nodes, _, joined = linked(signs.select("tid", "sig", *none), texts, FOLDED)
        each, rows = keep(folded(texts, nodes, joined), "folded-texts"), keep(signs.select("doc_id", "tid"), "rows")
    free_driver(spark)
    nodes, links, joined = linked(weighted_rows(each), each.select("tid", "text"), SIMILARITY)
    degree = links.select("u").unionAll(links.select(F.col("v"))).groupBy("u").agg(F.count("*").alias("links"))
    known = nodes.select("tid", "node").join(joined, "node", "left").join(
        degree.withColumnRenamed("u", "node"), "node", "left").select(
        "tid", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
    placed = rows.select("doc_id", "tid").join(known, "tid")
    classes = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"))
    return placed.join(classes, "component").select("doc_id", "tid", "component", "class_id", "class_rows", "links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the least ``doc_id`` (nulls last, then by text), columns as they are."""
    found = near_copies(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tid"))
    kept = found.groupBy("component").agg(first.alias("f")).select(F.col("f.doc_id").alias("_kept_id"), F.col("f.tid").alias("_kept_tid"))
    held = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col("doc_id").cast("bigint").alias("_id"), text_id(F.col("text")).alias("_tid"))
    same = (F.col("_tid") == F.col("_kept_tid")) & F.col("_id").eqNullSafe(F.col("_kept_id"))
    nth = F.row_number().over(Window.partitionBy("_kept_tid", "_kept_id").orderBy("_kept_tid"))
    chosen = held.join(kept, same).withColumn("_nth", nth).where("_nth = 1")
    return chosen.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
