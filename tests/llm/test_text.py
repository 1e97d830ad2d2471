"""Repeated strings, near copies, shared passages, SentencePiece and toxicity against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaymaster.llm import compact_windows, minhash, piece, suffix_dedup, toxicity
from quaymaster.llm.common import mix64
from quaymaster.llm.components import components

# Repeated strings --------------------------------------------------------------------


def covered(texts):
    """(bytes, removed, spans, hash of the rest) of each text, by counting all 200-byte strings."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    out = []
    for b in bodies:
        marks = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                marks[i] += 1
                marks[i + 200] -= 1
        gone = np.cumsum(marks)[: len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for t in range(60):
        data = rng.integers(0, [2, 3, 256][t % 3], int(rng.integers(1, 300))).astype(np.uint8)
        if t % 5 == 0:
            data = np.tile(data, 3)
        raw = data.tobytes()
        order = suffix_dedup.suffix_array(data)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = suffix_dedup.common_prefixes(data, order, np.zeros(1, np.int64), 10**6)
        for k in range(1, len(raw)):
            x, y = raw[order[k] :], raw[order[k - 1] :]
            assert shared[k] == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


@pytest.mark.parametrize("shard", [5, 4000])
def test_repeats_against_counting(docs, words, monkeypatch, shard):
    """With small shards the shared passage's anchors are split and merged."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    r = random.Random(3)
    p, q = words(60, 1), words(12, 2)
    texts = [None, "", p, "ab" * 400, "ab" * 399 + "c", "x" * 3000, "same " * 100, "same " * 100]
    texts += [words(r.randint(0, 40), 100 + i) + p[: r.randint(150, len(p))] + words(r.randint(0, 20), 200 + i) for i in range(30)]
    texts += [words(5, 300 + i) + p[r.randint(0, 100) :] + words(5, 400 + i) + q * r.randint(1, 9) for i in range(20)]
    texts += texts[12:16]
    rows = [(i if i != 9 else None, t) for i, t in enumerate(texts)] + [(20, texts[20]), (20, texts[20])]
    texts += [texts[20], texts[20]]
    out = suffix_dedup.repeated_spans(docs(*rows)).collect()
    got = Counter((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out)
    assert got == Counter((row[0], *want) for row, want in zip(rows, covered(texts)))


def anchored_contexts(n, seed=0):
    """Contexts of a few anchors with changed bytes, some cut off at an end: (bodies, anchors, lefts)."""
    r = random.Random(seed)
    bases = [bytes(r.choices(b"\0ab", k=336)) for _ in range(4)]
    bodies, anchors, lefts = [], [], []
    for _ in range(n):
        anchor = r.randrange(3)
        body = bytearray(bases[r.choice([anchor, 3])])
        body[136:200] = bases[anchor][136:200]
        for p in r.choices([*range(136), *range(200, 336)], k=r.randrange(3)):
            body[p] ^= 1
        left, right = r.choice([136, r.randrange(137)]), r.choice([200, 64 + r.randrange(137)])
        bodies.append(bytes(body[136 - left : 136 + right]))
        anchors.append(anchor * 1000 - 7)
        lefts.append(left)
    return bodies, np.array(anchors, np.int64), np.array(lefts, np.int64)


@pytest.mark.parametrize("n", [1, 2, 60])
def test_windows_of_a_shard_against_all_suffixes(monkeypatch, n):
    """Groups of equal windows are those of the whole suffix array, which is not built for them."""
    bodies, anchors, lefts = anchored_contexts(n)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    lengths = np.array([len(b) for b in bodies])
    starts = np.cumsum(lengths) - lengths
    order = suffix_dedup.suffix_array(data)
    runs = np.cumsum(suffix_dedup.common_prefixes(data, order, starts, 10**4) < 200)
    want = defaultdict(set)
    for at, run in zip(order.tolist(), runs.tolist()):
        c = int(np.searchsorted(starts, at, "right")) - 1
        if at - starts[c] + 200 <= lengths[c] and at - starts[c] <= lefts[c]:
            want[run, anchors[c], lefts[c] - (at - starts[c])].add((c, int(at - starts[c])))

    def whole(data):
        raise AssertionError("all suffixes of a shard are sorted")

    monkeypatch.setattr(suffix_dedup, "suffix_array", whole)
    got, sizes = defaultdict(set), {}
    for c, start, group, size in zip(*(x.tolist() for x in suffix_dedup.repeated_windows(bodies, anchors, lefts))):
        got[group].add((c, start))
        sizes[group] = size
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert all(len(got[g]) == sizes[g] for g in got) and list(got) == sorted(got)


def test_cut_texts_keep_whole_characters(docs, words):
    p = "é" * 120
    rows = [(1, "a" + p + "tail"), (2, "b" + p + "end"), (3, None), (4, "short")]
    d = docs(*rows)
    out = {r["doc_id"]: r for r in suffix_dedup.without_repeats(d).collect()}
    assert {k: r["text"] for k, r in out.items()} == {1: "atail", 2: "bend", 3: None, 4: "short"}
    assert out[1]["n_chars"] == 5 and out[1]["size"] == "x" and suffix_dedup.without_repeats(d.limit(0)).collect() == []


# Near copies ----------------------------------------------------------------------------


def test_components(spark):
    r = random.Random(1)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}


def peak_bytes(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_quantiles_are_made_in_steps(monkeypatch):
    """The whole grid of the distribution took over 100 MB in every worker of an executor at once."""
    made = []
    assert peak_bytes(lambda: made.append(minhash.gamma_tables.__wrapped__())) < 16 << 20
    monkeypatch.setattr(minhash, "GRID", 4_000_000)
    assert all(np.array_equal(x, y) for x, y in zip(made[0], minhash.gamma_tables.__wrapped__()))


def test_samples_do_not_depend_on_how_sets_are_drawn(monkeypatch):
    """What is held for a sample does not grow with the sets; weights of 1, few others and many others draw by one rule."""
    rng = np.random.default_rng(2)
    sets = []
    for n in [1, 3, 20_000, *rng.integers(50, 400, 300).tolist()]:
        weights, changed = np.ones(n), rng.random(n) < rng.choice([0, 0.05, 1])
        weights[changed] = rng.random(changed.sum()) * 3 + 0.01
        sets.append((np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)), weights))
    got = []
    minhash.gamma_tables()
    assert peak_bytes(lambda: got.append(minhash.signatures(sets))) < 5 << 20
    monkeypatch.setattr(minhash, "DRAWN", 1)
    assert np.array_equal(got[0], minhash.signatures(sets))
    r_of, inverse_of, log_of = minhash.gamma_tables()
    for k in (0, 63):
        for row in (0, 1, 5, 200):
            elements, weights = sets[row]
            h = mix64(elements + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            i, c, b = (((h >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64) for shift in (0, 16, 32))
            beta = b.astype(np.float32) / np.float32(65536)
            t = np.floor(np.log(weights).astype(np.float32) * inverse_of[i] + beta)
            least = int(np.argmin(log_of[c] - r_of[i] * (t + np.float32(1) - beta)))
            drawn = (int(h[least]) >> 20 ^ int(t[least]) * int(minhash.MULTIPLIERS[0])) & 0xFFFFFFFF
            assert int(got[0][row, k]) & 0xFFFFFFFF == drawn


def test_shingles_of_many_texts_are_those_of_each():
    """A word is what ``split`` gives, in lower case, wherever it stands; long ones are hashed too."""
    texts = ["", None, " \t", "a", "A b c d", "a b c d e", "  a\tb\x1cc\u3000d e\xa0f ", "\u0130 \u03a3\u03c2 \xdf \u212a x y z", "w " * 40_000, "x" * 70_000 + " y z a b c"]
    for text, found in zip(texts, minhash.shingles_of(texts)):
        every = [int(minhash.word_hashes(w.encode())[1][0]) for w in (text or "").lower().split()]
        runs = [every[i : i + 5] for i in range(max(1, len(every) - 4))] if every else []
        want = [sum(h * int(m) for h, m in zip(run, minhash.MULTIPLIERS)) & (1 << 64) - 1 for run in runs]
        assert np.array_equal(found, mix64(np.array(want, np.uint64))) and np.array_equal(found, minhash.shingles(text))
    words = [f"{a}{b}" for a in range(300) for b in ("", "x", "xx", "yx", "xy")]
    assert len({int(h) for h in minhash.word_hashes(" ".join(words).encode())[1]}) == len(set(words))


def test_few_elements_are_drawn_from_in_full(monkeypatch):
    """All were, in each of 64 samples. A set of which none of the few is least is drawn from as a whole."""
    rng, seen, ranked = np.random.default_rng(6), [0], minhash._ranked
    sets = [(rng.integers(0, 1 << 63, n).astype(np.uint64), rng.choice([0.3, 1, 1, 1], n)) for n in rng.integers(300, 900, 60)]
    monkeypatch.setattr(minhash, "_ranked", lambda h, w: (seen.__setitem__(0, seen[0] + len(h)), ranked(h, w))[1])
    drawn = minhash.signatures(sets)
    assert seen[0] < sum(len(w) for _, w in sets) * minhash.SAMPLES / 5
    for likely in (0.1, 1e9):
        monkeypatch.setattr(minhash, "LIKELY", likely)
        assert np.array_equal(drawn, minhash.signatures(sets))


def near_classes(rows):
    """Classes by comparing all pairs of texts."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    none = np.zeros(0, np.uint64)
    sets = [minhash.weighted(t, none, np.zeros(0)) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and minhash.similarity(sets[i], sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for doc_id, t in rows:
        groups[find(texts.index(t or ""))].append(doc_id)
    return groups


def test_near_copies_against_all_pairs(docs, words):
    r = random.Random(5)
    rows = [(i, words(80, i)) for i in range(40)]
    for i in range(60):
        w = rows[i % 12][1].split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = "new"
        rows.append((100 + i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, "  "), (203, "one two"), (204, "one two"), (None, "one two"), (203, "one two"), (300, words(9000, 9))]
    found = minhash.near_copies(docs(*rows)).collect()
    assert Counter(x["doc_id"] for x in found) == Counter(d for d, _ in rows)
    want = {d: min(x for x in g if x is not None) for g in near_classes(rows).values() for d in g}
    assert {x["doc_id"]: x["class_id"] for x in found} == want
    kept = minhash.one_of_each(docs(*rows)).collect()
    assert sorted(x["doc_id"] for x in kept) == sorted(set(want.values())) and kept[0]["size"] == "x"


def test_a_third_of_the_rows_are_copies(docs, words):
    base = words(204, 1).split()
    rows, similarities = [(0, " ".join(base))], []
    for i in range(1, 51):
        edited = list(base)
        for k in range(3 + i % 2):
            edited[20 + 40 * k + i % 7] = f"edit{i}at{k}"
        rows.append((i, " ".join(edited)))
        a, b = (set(minhash.shingles(t).tolist()) for t in (rows[0][1], rows[-1][1]))
        similarities.append(len(a & b) / len(a | b))
    assert 0.8 <= min(similarities) and max(similarities) <= 0.87
    rows += [(100 + i, words(100, 500 + i) + " the same line stands in every other text of the table") for i in range(100)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs(*rows)).collect()}
    assert {got[i] for i in range(51)} == {0} and all(got[i] == i for i in got if i >= 100)


def test_document_frequencies_against_counting(docs, words):
    line = words(8, 1)
    texts = [words(30, 10 + i) + (" " + line if i % 3 else "") + (" " + words(20, 2)) * (i > 36) for i in range(40)]
    counted = [i % 4 > 0 for i in range(40)]
    df = Counter(s for t, c in zip(texts, counted) if c for s in set(minhash.shingles(t).view(np.int64).tolist()))
    spark = docs((1, "a")).sparkSession
    rows = spark.createDataFrame([(i % 3, t, c) for i, (t, c) in enumerate(zip(texts, counted))], "block long, text string, counted boolean")
    got = {}
    for r in minhash.common_shingles(rows, sum(counted), 3, 4).collect():
        for shingle, idf in zip(r["shingles"], r["idf"]):
            assert (r["block"], shingle) not in got
            got[r["block"], shingle] = idf
    held = {(i % 3, s) for i, t in enumerate(texts) for s in minhash.shingles(t).view(np.int64).tolist()}
    want = {(b, s): np.log1p(sum(counted) / df[s]) / np.log1p(sum(counted)) for b, s in held if df[s] > 1}
    assert set(got) == set(want) and max(abs(got[k] - want[k]) for k in want) < 1e-6
    assert len(set(want.values())) > 1 and max(df.values()) > 1 and min(n for n in df.values() if n > 1) <= sum(counted) / 20 * 2


def test_a_passage_of_few_documents_counts_less(docs, words):
    """It stands in 4 of some 100 documents, which are fewer than a twentieth."""
    passage, own = words(104, 1), words(70, 2)
    rows = [(i, f"{passage} {own} {words(20, 3 + i)}") for i in range(2)]
    a, b = (set(minhash.shingles(t).tolist()) for _, t in rows)
    assert len(a & b) / len(a | b) >= 0.8
    rows += [(10 + i, f"{passage} {words(100, 10 + i)}") for i in range(3)]
    rows += [(100 + i, words(60, 100 + i)) for i in range(100)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(docs(*rows)).collect()}
    assert all(got[i] == i for i, _ in rows)


def test_near_copies_of_an_empty_table(docs):
    empty = docs((1, "a")).limit(0)
    assert minhash.near_copies(empty).collect() == [] and minhash.one_of_each(empty).collect() == []


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(1, 2**60, 4000).astype(np.uint64))
    w = np.ones(len(a))
    sigs = minhash.signatures([(a[:3000], w[:3000]), (a[1000:], w[1000:]), (a[:3000], w[:3000])])
    true = 2000 / (len(a))
    assert (sigs[0] == sigs[2]).all() and abs((sigs[0] == sigs[1]).mean() - true) < 0.25


# Shared passages ------------------------------------------------------------------------------


def test_compact_windows_cover_every_passage_once():
    rng = np.random.default_rng(4)
    runs = rng.integers(0, 2**60, 300).astype(np.uint64)
    _, _, lo, c, hi = compact_windows.compact_windows(runs, np.array([0]), np.array([300]), 1)
    n, width = 300, compact_windows.SHORTEST
    for start in range(0, n - width + 1, 17):
        for stop in range(start + width - 1, n, 13):
            holds = (lo <= start) & (start <= c) & (c <= stop) & (stop <= hi)
            assert holds.sum() == 1


@pytest.mark.parametrize("period", [1, 2, 7, 46, 60])
def test_a_stretch_that_repeats_itself_has_few_windows(period):
    """A word that stands hundreds of times in a row had a window for each time, all of the same runs."""
    rng, width = np.random.default_rng(6), compact_windows.SHORTEST
    far = lambda n: rng.integers(0, 2**60, n).astype(np.uint64)
    runs = np.concatenate([far(50), np.resize(far(period), 400), far(50), np.resize(far(period), 30), far(20)])
    n, count = len(runs), 0
    for f in range(3):
        _, _, lo, c, hi = compact_windows.compact_windows(runs, np.array([0]), np.array([n]), f)
        count += len(c)
        for start in range(0, n - width + 1, 5):
            for stop in range(start + width - 1, n, 9):
                first = np.where((lo <= start) & (c <= stop) & (stop <= hi), np.minimum(start, c), n)
                assert any(set(runs[x : stop + 1].tolist()) == set(runs[start : stop + 1].tolist()) for x in set(first[first < n].tolist()))
    assert count < 3 * (30 if period <= width else 60)


def test_texts_that_repeat_a_word_share_passages(docs, words):
    again = ["the"] * 300
    rows = [(i, " ".join([words(30 + i, 10 + i), *again[: 60 + 40 * i], words(30, 20 + i)])) for i in range(4)]
    rows += [(9, " ".join([words(40, 5), *again[:40], words(40, 6)]))]
    got = {r["doc_id"]: r for r in compact_windows.shared_passages(docs(*rows)).collect()}
    for i in range(4):
        assert got[i]["class_id"] == 0 and got[i]["links"] >= 1 and len(got[i]["spans"]) == 1
        assert got[i]["spans"][0]["lo"] <= 30 + i and got[i]["spans"][0]["hi"] >= 90 + 41 * i
    assert got[9]["class_id"] == 9 and got[9]["links"] == 0


def test_texts_are_exchanged_compressed_and_whole(docs, words):
    texts = ["", "a", "éa  b\n的🙂\x00 c", words(5000, 3)]
    frame = docs(*enumerate(texts)).selectExpr("doc_id AS node", "text")
    packed = {r["node"]: bytes(r["packed"]) for r in compact_windows.packed_texts(frame).collect()}
    assert [compact_windows.unpack(packed[i]) for i in range(4)] == texts and len(packed[3]) < len(texts[3].encode()) / 1.5
    blocks = list(compact_windows.unpacked(pa.array([packed[i] for i in range(4)] * 100)))
    assert [t for _, block in blocks for t in block] == texts * 100 and len(blocks) > 1
    assert [start for start, _ in blocks] == np.cumsum([0, *[len(b) for _, b in blocks]])[:-1].tolist()


def test_partners_of_a_window_against_all_pairs():
    rng, width = np.random.default_rng(14), compact_windows.SHORTEST
    whole = [rng.integers(0, 2**60, 91).astype(np.uint64) for _ in range(3)]
    whole[1][:60] = whole[0][20:80]
    each, at, nodes = [], [], []
    for i in range(60):
        x = whole[i % 3].copy()
        hit = rng.random(91) < rng.choice([0.0, 0.03, 0.15, 0.3])
        x[hit] = rng.integers(0, 2**60, hit.sum())
        x[45] = 7
        lo, hi = int(rng.integers(0, 46)), int(rng.integers(46, 92))
        each.append(x[lo:hi])
        at.append(45 - lo)
        nodes.append(i // 2)
    lengths, told = np.array([len(x) for x in each]), rng.random(60) < 0.8
    near = compact_windows.Neighbours(np.concatenate(each), lengths, np.array(at), np.array(nodes))
    can = np.zeros((60, 60), bool)
    for i in range(60):
        for j in range(60):
            if nodes[i] != nodes[j]:
                x, y, size = compact_windows.numbered(each[i], each[j])
                can[i, j] = compact_windows.possible(x, y, size, np.array([at[i]]), np.array([at[j]]))[0]
    assert 100 < can.sum() < 3000 and (near.alive() | ~can.any(axis=1)).all() and not near.alive().all()
    for i in range(60):
        others, shared = near.partners(i, told)
        assert others.tolist() == np.flatnonzero(can[i] & told).tolist()
        assert all(np.array_equal(s, np.isin(each[i], each[j])) for j, s in zip(others, shared))


def test_shared_passages(docs, words):
    p = words(70, 1)
    rows = [(i, words(60, 10 + i) + " " + p + " " + words(40, 50 + i)) for i in range(8)]
    changed = p.split()
    changed[30] = "changed"
    rows += [(20, words(90, 3)), (21, words(20, 4) + " " + " ".join(changed) + " " + words(9, 5)), (22, None), (23, "few words"), (24, "few words"), (20, words(90, 3))]
    out = compact_windows.shared_passages(docs(*rows)).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d for d, _ in rows)
    got = {r["doc_id"]: r for r in out}
    assert {got[i]["class_id"] for i in (*range(8), 21)} == {0} and got[20]["class_id"] == 20 and got[24]["class_id"] == 23
    assert all(got[i]["links"] >= 1 and sum(s["hi"] - s["lo"] for s in got[i]["spans"]) >= 70 for i in range(8))
    assert got[20]["links"] == 0 and got[20]["spans"] == []
    assert compact_windows.shared_passages(docs((1, "a")).limit(0)).collect() == []


def test_passage_whose_least_runs_are_frequent_elsewhere(docs, words):
    p = words(60, 1)
    rows = [(i, words(50, 210 + i) + " " + p + " " + words(50, 230 + i)) for i in range(2)]
    a, b = (minhash.shingles(t) for _, t in rows)
    for f in range(compact_windows.FUNCTIONS):
        least = [set(x[compact_windows.compact_windows(x, np.array([0]), np.array([len(x)]), f)[3]].tolist()) for x in (a, b)]
        for run in sorted(least[0] & least[1]):
            at = a.tolist().index(run)
            quoted = " ".join(rows[0][1].split()[at : at + minhash.WORDS])
            rows += [(100 + i, words(60, 1000 + i) + " " + quoted + " " + words(60, 3000 + i)) for i in range(len(rows), len(rows) + 30)]
    got = {r["doc_id"]: r for r in compact_windows.shared_passages(docs(*rows)).collect()}
    assert [(got[i]["class_id"], got[i]["class_rows"], got[i]["links"]) for i in range(2)] == [(0, 2, 1)] * 2
    assert all(len(got[i]["spans"]) == 1 and got[i]["spans"][0]["lo"] <= 50 and got[i]["spans"][0]["hi"] >= 110 for i in range(2))
    assert all(r["links"] == 0 for i, r in got.items() if i >= 100)


def test_passage_whose_own_windows_are_frequent_elsewhere(docs, words):
    """As above, by the hashes that windows are made from."""
    p = words(60, 1)
    rows = [(i, words(50, 210 + i) + " " + p + " " + words(50, 230 + i)) for i in range(2)]
    a, b = (compact_windows.run_hashes(t) for _, t in rows)
    for f in range(compact_windows.FUNCTIONS):
        least = [set(x[compact_windows.compact_windows(x, np.array([0]), np.array([len(x)]), f)[3]].tolist()) for x in (a, b)]
        for run in sorted(least[0] & least[1]):
            at = a.tolist().index(run)
            quoted = " ".join(rows[0][1].split()[at : at + minhash.WORDS])
            rows += [(100 + i, words(60, 1000 + i) + " " + quoted + " " + words(60, 3000 + i)) for i in range(len(rows), len(rows) + 30)]
    got = {r["doc_id"]: r for r in compact_windows.shared_passages(docs(*rows)).collect()}
    assert [(got[i]["class_id"], got[i]["class_rows"], got[i]["links"]) for i in range(2)] == [(0, 2, 1)] * 2
    assert all(r["links"] == 0 for i, r in got.items() if i >= 100)


def test_places_that_no_passage_can_cover(monkeypatch):
    """Scattered common runs were walked through in ever smaller surroundings for every window."""
    rng, width = np.random.default_rng(8), compact_windows.SHORTEST
    for n in (10, width, 70, 150):
        for p in (0.7, 0.85, 0.9):
            hits = rng.random(n) < p
            want = np.zeros(n, bool)
            for i in range(n):
                for j in range(i + width, n + 1):
                    if hits[i:j].sum() >= compact_windows.SHARED * (j - i) - 1e-9:
                        want[i:j] = True
            assert np.array_equal(compact_windows.around(hits, compact_windows.SHARED), want)
    a = rng.integers(0, 2**60, 600).astype(np.uint64)
    b = a.copy()
    b[::6] = rng.integers(0, 2**60, 100)
    calls = []
    monkeypatch.setattr(compact_windows, "stretch", lambda *x: calls.append(x) or (0, 0))
    assert compact_windows.shared_passage(a, b, 301, 301) is None and not calls


def test_agreeing_windows_against_all_pairs(docs, monkeypatch):
    rng, width = np.random.default_rng(12), compact_windows.SHORTEST
    names = ("f", "lu", "cu", "ru", "lv", "cv", "rv")
    rows = []
    for k, n in enumerate((1, 2, 40, 3, 25)):
        lo, long, shift = rng.integers(0, 400, n), rng.integers(0, 150, n), rng.integers(-40, 40, n)
        rows.append((k, 100 + k, [(int(f), int(x), int(x), int(x + w), int(x + d), int(x + d), int(x + d + w)) for f, x, w, d in zip(rng.integers(0, 3, n), lo + 50, long, shift)]))
    spark = docs((1, "a")).sparkSession
    frame = spark.createDataFrame(rows, "u long, v long, windows array<struct<" + ",".join(f"{n}: {'tinyint' if n == 'f' else 'int'}" for n in names) + ">>")
    overlap = lambda x, y: x[0] != y[0] and all(min(x[e], y[e]) - max(x[b], y[b]) + 1 >= width for b, e in ((1, 3), (4, 6)))
    want = {u: [w for w in ws if any(overlap(w, x) for x in ws)] for u, _, ws in rows}
    for at_once in (1, 7, 1 << 18):
        monkeypatch.setattr(compact_windows, "JOINED", at_once)
        got = {r["u"]: [tuple(w) for w in r["windows"]] for r in compact_windows.agreeing(frame.coalesce(1)).collect()}
        assert got == {u: ws for u, ws in want.items() if ws} and got
    starts = [x for at, near in compact_windows.joined(3, np.array([5])) for x in zip(at.tolist(), near.tolist())]
    assert starts == [(3, x) for x in range(4, 9)]


def test_stray_repeats_do_not_hide_an_edited_passage():
    rng = np.random.default_rng(9)
    p = rng.integers(0, 2**60, 50).astype(np.uint64)
    edited = p.copy()
    edited[22:27] = rng.integers(0, 2**60, 5)
    far = lambda n: rng.integers(0, 2**60, n).astype(np.uint64)
    a = np.concatenate([far(100), p, far(300)])
    for stray in (p[40:41], p[35:45]):
        b = np.concatenate([stray, far(400), edited, far(200), stray, far(100)])
        at_b = 400 + len(stray) + 40
        for got in (compact_windows.shared_passage(a, b, 140, at_b), compact_windows.shared_passage(b, a, at_b, 140)):
            assert got is not None
            lo, hi = got[:2] if got[0] <= 140 < got[1] and got[1] <= 200 else got[2:]
            assert lo <= 104 and hi >= 146 and hi - lo <= 60


def test_a_passage_within_a_repeated_one(docs, words):
    p = words(60, 1)
    line = " ".join(p.split()[20:26])
    changed = p.split()
    changed[45] = "changed"
    rows = [(1, words(50, 2) + " " + p + " " + words(50, 3)), (2, line + " " + words(300, 4) + " " + " ".join(changed) + " " + words(300, 5) + " " + line)]
    got = {r["doc_id"]: r for r in compact_windows.shared_passages(docs(*rows)).collect()}
    assert got[1]["class_id"] == got[2]["class_id"] == 1
    assert all(sum(s["hi"] - s["lo"] for s in r["spans"]) in range(54, 76) for r in got.values())


@pytest.mark.parametrize("salt", range(4))
def test_passage_that_stands_twice_in_a_text(docs, words, salt):
    p = words(70, 1)
    rows = [(1, " ".join([words(60, 10 + salt), p, words(60, 20 + salt), p, words(60, 30 + salt)])), (2, words(50, 40 + salt) + " " + p)]
    got = {r["doc_id"]: r for r in compact_windows.shared_passages(docs(*rows)).collect()}
    for i, starts in ((1, (60, 190)), (2, (50,))):
        assert len(got[i]["spans"]) == len(starts) and all(
            s["lo"] <= x and s["hi"] >= x + 70 for s, x in zip(got[i]["spans"], starts))


def test_altered_passages_against_brute_force(docs, words):
    import random

    r, rows, alike = random.Random(3), [], set()
    for i in range(120):
        p = words(50, 10_000 + i).split()
        q = list(p)
        q[r.randrange(4, 46)] = f"changed{i}"
        rows += [(2 * i, " ".join(p)), (2 * i + 1, " ".join(q))]
        x, y = (set(minhash.shingles(t).tolist()) for _, t in rows[-2:])
        if len(x & y) >= 0.8 * len(x | y):
            alike.add(2 * i)
    got = {r["doc_id"]: r["class_id"] for r in compact_windows.shared_passages(docs(*rows)).collect()}
    assert len(alike) == 120 and {i for i in alike if got[i] == got[i + 1] == i} == alike


# SentencePiece -----------------------------------------------------------------------------------

model = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_encoding_equals_the_library():
    table = piece.table_of(piece.model_bytes(model))
    r = random.Random(1)
    parts = list("abcdefgh  \n\t.,;:!?'\"()[]{}<>/\\|0123456789éèüß的人あ한🙂▁ﬁ①Ａ　 ​\x00\x01") + [
        "the", "ing", "  ", "    ", " " * 17, "https://", "<s>", "</s>", "<unk>", "<0x0A>", "ation", "return", "\r\n"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(4000)] + ["", " ", "a" * 20_000, " " * 5000, "\n" * 500]
    assert [table.encode(t)[:-1] for t in texts] == table.sp.encode(texts)


def test_encoded_documents(docs):
    rows = [(1, "Hello  world\n"), (2, None), (3, ""), (None, "é▁x"), (1, "Hello  world\n")]
    out = piece.encode_documents(docs(*rows), model).collect()
    sp = piece.table_of(piece.model_bytes(model)).sp
    want = Counter((d, (*sp.encode(t or ""), 2), sp.decode(sp.encode(t or ""))) for d, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in out) == want
    whole = piece.encode_columns(docs(*rows), model)
    assert whole.columns == ["doc_id", "lang", "source", "n_chars", "node", "size", "key", "ids", "decoded"]
    assert piece.encode_documents(docs(*rows).limit(0), model).collect() == []


# Toxicity ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def restorer(spark):
    words = "the quick idiot said that stupid people and a loser went over there to see an idiotic trash moron book soon feel".split()
    texts = [(i, " ".join(random.Random(i).choices(words, k=40))) for i in range(100)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    return toxicity.Restorer(toxicity.language_model(df))


@pytest.mark.parametrize("given, word", [
    ("1d10t", "idiot"), ("!diot", "idiot"), ("idi0t!", "idiot"), ("stuuuupid", "stupid"), ("looooser", "loser"), ("s t u p i d", "stupid"),
    ("m.o.r.o.n", "moron"), ("tr4$h", "trash"), ("STUPID", "stupid"), ("ídiot", "idiot"), ("boook", "book"), ("id​iot", "idiot"), ("st*pid", "stupid"),
])
def test_disguised_words_are_restored(restorer, given, word):
    assert word in restorer.words(f"see {given} there")


def test_plain_words_stay(restorer):
    assert restorer.words("Feel the Book, soon!") == {"feel", "the", "book", "soon"} and restorer.words("") == set()
    assert restorer.words("2024-01-02 12:30") == set()


def test_scores_find_held_out_toxic_texts(spark, docs, words):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        text, toxic = words(40, i % 350), i % 5 == 0
        if toxic:
            bad = r.choice(["idiot", "1d10t", "loser"] if i % 2 else ["idiot", "loser"])
            text += f" {bad} " + words(10, 1000 + i)
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None), (901, ""), (None, "idiot loser"), (3, rows[3][1])]
    labels += [(3, 1, None), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.with_scores(docs(*rows).select("doc_id", "text"), frame, F.col("doc_id") % 3 != 1).collect()
    assert len(out) == len(rows)
    held = [(x["_score"] >= 0.7, x["doc_id"] % 5 == 0) for x in out if x["doc_id"] is not None and x["doc_id"] < 400 and x["doc_id"] % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= x["_score"] <= 1 for x in out)
    none = toxicity.with_scores(docs(*rows).select("doc_id", "text"), frame.limit(0)).collect()
    assert {x["_score"] for x in none} == {0.5}


def test_score_looks_up_features_with_a_weight_only(monkeypatch):
    r = random.Random(4)
    vocabulary = ["".join(r.choices("abc", k=r.randint(1, 7))) for _ in range(60)]
    texts = [set(r.choices(vocabulary, k=r.randint(0, 40))) for _ in range(50)]
    every = sorted(set().union(*map(toxicity.features, texts)))
    weights = {f: r.uniform(-1, 1) for f in every if r.random() < 0.3}
    want = [-0.2 + sum(weights[f] for f in sorted(toxicity.features(t) & weights.keys())) for t in texts]

    def whole(words):
        raise AssertionError("all features of a text are made")

    monkeypatch.setattr(toxicity, "features", whole)
    classifier = toxicity.Classifier(-0.2, weights)
    assert [classifier.score(t) for t in texts] == [1 / (1 + np.exp(-w)) for w in want]
