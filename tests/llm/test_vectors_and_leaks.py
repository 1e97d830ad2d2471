"""Whitening, vector codes and decontamination against plain loops."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymaster.llm import decontaminate, vector_codes, whitening
from quaymaster.llm.queries import QUERIES, op12_sql

EXTRA = ", id int, vec string, code int, at int, part int, row int, n int"
CLASH = (1, "x", 2, 3, 4, 5, 6)


def vectors_frame(spark, rows, kind="float", parts=5):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], label, *CLASH) for i, v, label in rows]
    return spark.createDataFrame(full, f"vec_id bigint, embedding array<{kind}>, label int{EXTRA}").repartition(parts)


def odd_rows():
    return [
        (9001, None, 1), (9002, [1.0, None] + [0.0] * 22, 1), (9003, [float("nan")] * 24, 1), (9004, [float("inf")] * 24, 2),
        (9005, [], 1), (9006, [0.5] * 7, None),
    ]


def usable(rows, width):
    return [(i, np.array(v, np.float64), label) for i, v, label in rows
            if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(500, 24)) * np.linspace(1.0, 0.1, 24)
    base[:, 3] += 0.7 * base[:, 0]
    rows = [(int(i), [float(np.float32(c)) for c in v], int(i) % 3 if i % 7 else None) for i, v in enumerate(base)]
    rows += [(700 + i, rows[10][1], 1) for i in range(40)] + [(11, rows[11][1], 2), (None, rows[12][1], None)]
    random.Random(1).shuffle(rows)
    return rows


# Whitening -----------------------------------------------------------------------------------


@pytest.mark.parametrize("spread", [1, 300, 2**30])
def test_block_sums_are_exact(spread):
    rng = np.random.default_rng(1)
    x = rng.integers(-spread, spread + 1, (777, 6)) + 100_000
    x[:, 2] = 41  # no spread
    sums, cross = whitening.block_sums(x)
    exact = x.astype(object)
    assert list(sums) == list(exact.sum(0))
    for i in range(6):
        for j in range(i, 6):
            assert cross[i, j] == (exact[:, i] * exact[:, j]).sum()


def test_whitening_equals_a_plain_computation(spark, vector_rows):
    got = whitening.whiten(vectors_frame(spark, vector_rows + odd_rows())).collect()
    kept = usable(vector_rows, 24)
    x = np.stack([np.floor(1024 * v).astype(np.int64) + 100_000 for _, v, _ in kept]).astype(object)
    n, total = len(x), x.sum(0)
    centred = ((n * x - total) / n).astype(np.float64)
    cov = np.array((n * x - total).T @ (n * x - total) / n**3, np.float64)
    values, components = np.linalg.eigh(cov)
    values, components = values[::-1][:8], components[:, ::-1][:, :8]
    white = centred @ components / np.sqrt(values)
    exact = {}
    for (i, _, _), row, w in zip(kept, x, white):
        exact.setdefault(i, []).append((int(sum((n * c - t) ** 2 for c, t in zip(row, total))), w))
    assert len(got) == 8 * n and {r["component"] for r in got} == set(range(1, 9))
    signs = {}
    for r in got:
        options = exact[r["id"]]
        k = r["component"] - 1
        assert r["n"] == n and int(r["deviation"]) in {d for d, _ in options}
        near = [w[k] for d, w in options if d == int(r["deviation"])]
        best = min(near, key=lambda y: abs(abs(y) - abs(r["whitened"])))
        assert abs(abs(best) - abs(r["whitened"])) < 1e-9
        if abs(best) > 1e-6:
            signs.setdefault(k, set()).add(np.sign(best) == np.sign(r["whitened"]))
        assert math.isclose(r["explained"], values[k] / np.trace(cov), rel_tol=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_few_and_of_none(spark):
    none = vectors_frame(spark, odd_rows()[:5])
    assert whitening.whiten(none).collect() == []
    one = whitening.whiten(vectors_frame(spark, [(1, [0.5, 0.25], 0), (1, [0.5, 0.25], 0)])).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] == 0 for r in one)
    line = whitening.whiten(vectors_frame(spark, [(1, [0.0, 0.0], 0), (2, [1.0, 1.0], 0)])).collect()
    assert sorted(round(abs(r["whitened"]), 9) for r in line if r["component"] == 1) == [1.0, 1.0]
    assert all(r["whitened"] is None for r in line if r["component"] == 2)
    # The commonest length is kept; of two equally common ones the longer.
    mixed = whitening.whiten(vectors_frame(spark, [(1, [0.0], 0), (2, [1.0, 2.0], 0), (3, [1.0], 0), (4, [1.0, 3.0], 0)])).collect()
    assert {r["id"] for r in mixed} == {2, 4}


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i % 2) * 2.0**28, 1.0], 0) for i in range(40)]
    got = whitening.whiten(vectors_frame(spark, rows, "double")).where("component = 1").collect()
    x = [int(i % 2) * 2**38 + 100_000 for i in range(40)]
    assert {r["id"]: int(r["deviation"]) for r in got} == {i: (40 * x[i] - sum(x)) ** 2 for i in range(40)}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(vectors_frame(spark, [(1, [2.0**31], 0)], "double"))


# Vector codes -----------------------------------------------------------------------------------


def plain_codes(rows, width, rounds=6):
    """Every part against every entry in every round."""
    kept = sorted(usable(rows, width), key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    step = -(-width // 8)
    x = np.zeros((len(kept), 8 * step), np.int64)
    x[:, :width] = [np.floor(4096 * v) for _, v, _ in kept]
    x = x.reshape(len(kept), 8, step)
    books = x[:16].transpose(1, 0, 2).copy()
    for n in range(rounds + 1):
        far = ((x[:, :, None] - books[None]) ** 2).sum(3)
        code = far.argmin(2)
        for p in range(8):
            for e in range(books.shape[1] if n < rounds else 0):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    error = np.take_along_axis(far, code[:, :, None], 2)[:, :, 0].sum(1)
    by_label = {}
    for (_, _, label), e in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + int(e)
    rows = sorted(((i, "".join(f"{c:02x}" for c in cs), int(e), by_label[label]) for (i, _, label), cs, e in zip(kept, code, error)), key=repr)
    return rows, hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


@pytest.mark.parametrize("width", [24, 21])
def test_codes_equal_full_rounds(spark, vector_rows, width):
    rows = [(i, v[:width], label) for i, v, label in vector_rows]
    done = vector_codes.compress(vectors_frame(spark, rows + odd_rows()))
    got = vector_codes.with_label_errors(done).collect()
    want, books = plain_codes(rows, width)
    assert done.books_sha256 == books
    assert sorted(((r["id"], "".join(f"{c:02x}" for c in r["code"]), r["error"], r["label_error"]) for r in got), key=repr) == want


def test_active_entries_keep_ties_and_distances():
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (400, 2, 2))
    books = vector_codes.Codebooks(rng.integers(-3, 4, (2, 9, 2)), np.ones((2, 9), bool))
    code, far = vector_codes.assigned(x, books, None, None)
    for _ in range(25):
        entries = books.entries.copy()
        moved = rng.random((2, 9)) < 0.3
        entries[moved] = rng.integers(-3, 4, (int(moved.sum()), 2))
        books = vector_codes.Codebooks(entries, (entries != books.entries).any(2))
        code, far = vector_codes.assigned(x, books, code, far)
        full = ((x[:, :, None] - entries[None]) ** 2).sum(3)
        assert (code == full.argmin(2)).all() and (far == full.min(2)).all()


def test_codes_of_few_and_of_none(spark):
    assert vector_codes.compress(vectors_frame(spark, odd_rows()[:5])) is None
    rows = [(3, [1.0] * 8, None), (3, [2.0] * 8, 4), (5, [1.0] * 8, None)]
    done = vector_codes.compress(vectors_frame(spark, rows))
    got = sorted((r["id"], r["code"][0], r["error"], r["label_error"]) for r in vector_codes.with_label_errors(done).collect())
    assert got == [(3, 0, 0, 0), (3, 1, 0, 0), (5, 0, 0, 0)] and done.books.entries.shape == (8, 3, 1)


# Decontamination --------------------------------------------------------------------------------


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_hits(docs, bench):
    windows = []
    for item, text in bench:
        w = plain_words(text)
        n = min(10, len(w))
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w, hit, items = plain_words(text), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    items |= {str(item)} if item is not None else set()
        ids = ",".join(sorted(items))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def write_tables(spark, folder, docs, bench, parts=3):
    spark.createDataFrame([(i, t, 1, "x", 2, 3, "y") for i, t in docs], "doc_id bigint, text string, row int, gram string, pos int, n_words int, window string") \
        .repartition(parts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t, 7) for i, t in bench], "item_id bigint, text string, length int").write.parquet(f"{folder}/benchmark.parquet")
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
                   for r in QUERIES["op13_decontaminate"](spark, str(folder)).collect()), key=repr)


def leak_tables():
    r = random.Random(4)
    vocabulary = ["the", "The", "of", "Ünï", "ß9", "x1", "żółw", "q", "AA", "b7", "ω"]
    say = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "--", "\x7f"]) for _ in range(n))
    bench = [(i, say(r.choice([1, 2, 3, 4, 5, 7, 9, 10, 11, 14, 30]))) for i in range(14)]
    bench += [(2, say(12)), (3, bench[3][1]), (None, say(11)), (50, None), (51, ""), (52, "- , ."), (100, bench[4][1].upper())]
    docs = [(i, say(r.randint(0, 80)) + (r.choice(bench)[1] or "") + say(r.randint(0, 30))) for i in range(60)]
    docs += [(7, docs[7][1]), (7, docs[7][1]), (None, bench[0][1]), (None, None), (80, ""), (81, "!!!"), (82, None)]
    docs += [(90, say(15_000) + bench[11][1])]
    return docs, bench


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_leaks_equal_a_plain_search(spark, tmp_path, monkeypatch, limit):
    """With the shingles of the benchmark broadcast, and with both sides shuffled."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    docs, bench = leak_tables()
    assert write_tables(spark, tmp_path, docs, bench) == plain_hits(docs, bench)


def test_windows_share_no_more_than_their_words(spark, tmp_path):
    """All shingles of a window, but at other places: not contained. Repeated shingles are found at each of their places."""
    words = [f"w{i}" for i in range(12)]
    bench = [(1, " ".join(words[:10])), (2, "a a a a a a a a a a a a"), (3, "short one")]
    docs = [
        (1, " ".join(words[:9])), (2, " ".join(words[1:10] + words[:5] + words[4:9])), (3, "x " + " ".join(words[:10]).upper() + " y"),
        (4, "a " * 9), (5, "a " * 23 + "b " + "a " * 10), (6, "one short one short"), (7, " ".join(words[:5]) + " x " + " ".join(words[5:10])),
    ]
    assert write_tables(spark, tmp_path, docs, bench) == plain_hits(docs, bench)
    assert [r[2] for r in plain_hits(docs, bench)] == [0, 0, 10, 0, 33, 2, 0]


def test_leaks_without_items_or_documents(spark, tmp_path):
    assert write_tables(spark, tmp_path / "a", [(1, "a b"), (None, None)], []) == plain_hits([(1, "a b"), (None, None)], [])
    assert write_tables(spark, tmp_path / "b", [], [(1, "a b")]) == []


def test_prefixes_are_the_rarest_shingles(spark):
    grams = spark.createDataFrame([("a b c", 3, 2, ["a b", "b c"]), ("c d e", 3, 2, ["c d", "d e"])], "window string, length int, size int, grams array<string>")
    counts = spark.createDataFrame([("a b", 9), ("b c", 4), ("c d", 1)], "gram string, places bigint")
    got = [tuple(r) for r in decontaminate.prefixes(grams, counts).collect()]
    assert got == [("b c", 1, "a b c", 3, "a b", "b c", 1)]  # the other window has a shingle that occurs nowhere


def test_reference_sql_of_the_rounds_is_for_eight_parts():
    assert op12_sql().count("AS MATERIALIZED") == 3 + 7 + 2 * 6 and F is not None
