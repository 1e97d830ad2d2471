"""Mixing, fingerprints, chat formatting and URL rules."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quaymaster.llm import chat, fingerprint, mixing, url_filter
from quaymaster.llm.queries import RULES


def test_targets_and_taken_words(docs, words):
    rows = [(i, words(20 + i * 7 % 300, i), f"s{i % 5}" if i % 7 else None) for i in range(60)]
    rows += [(None, words(30, 99), "s0"), (900, None, "s1"), (901, "", None), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    out = mixing.taken_words(docs(*rows)).collect()
    assert len(out) == len(rows)
    count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r[0], count(r[1])) for r in rows)
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + count(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 2 * sizes[s]
            free.remove(s)
        left = 1.5 * sum(sizes.values()) - sum(target.values())
    taken: dict = {}
    for r in out:
        assert r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.05 * sizes[s] + 2


def test_mixing_reruns_agree_and_empty_tables(docs, words, spark):
    rows = [(i, words(40, i), f"s{i % 3}") for i in range(20)]
    take = lambda d: sorted((r["doc_id"], r["taken"]) for r in mixing.taken_words(d).collect())
    assert take(docs(*rows, parts=2)) == take(docs(*rows, parts=5))
    empty = docs(*rows).limit(0)
    assert mixing.taken_words(empty).collect() == [] and mixing.mixed_documents(empty).columns == empty.columns


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), rounds=10).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def test_mixed_documents_keep_whole_texts_and_cut_at_words(docs, words):
    rows = [(i, words(300, i), "abc"[i % 3]) for i in range(9)] + [(50, None, "a")]
    d = docs(*rows)
    out = mixing.mixed_documents(d).collect()
    text = {r[0]: r[1] for r in rows}
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(d).collect()}
    got: dict = {}
    for r in out:
        pool = Counter(text[r["doc_id"]].split())
        assert not Counter(r["text"].split()) - pool and r["n_chars"] == len(r["text"]) and r["size"] == "x"
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == {k: v for k, v in taken.items() if v}


def edits(rows):
    """Brute force of the edited texts: rows in order, repeated rows after each other."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        k = len(text) // 4
        out.append((doc_id, hashlib.sha256((text[: len(text) - k] + nxt[:k]).encode()).hexdigest(), len(text)))
    return sorted(out, key=repr)


def test_edited_texts_and_likeness(docs, words):
    rows = [(i, words(30 + i, i)) for i in range(12)] + [(100, ""), (101, ""), (102, "x"), (103, words(4000, 7)), (7, words(37, 7)), (7, words(37, 7))]
    ordered = sorted([(i, t) for i, t in rows], key=lambda r: (r[0], len(r[1])))
    out = fingerprint.edited_likeness(docs(*rows)).collect()
    assert sorted(((r["doc_id"], r["edited_sha256"], r["n_chars"]) for r in out), key=repr) == edits(ordered)
    own = {}
    for r in out:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        own.setdefault(dict(rows)[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in own.values())
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[103]["near_edited"] > 0.6 > by_id[103]["near_next"] and by_id[100]["near_next"] == 1.0


def test_one_document_and_none(docs):
    out = fingerprint.edited_likeness(docs((None, "a b c d e f g h"))).collect()
    assert len(out) == 1 and out[0]["near_next"] == 1.0
    assert fingerprint.edited_likeness(docs((1, "x")).limit(0)).collect() == []


def test_likeness_of_a_text_of_many_equal_lines(docs, words):
    out = {r["doc_id"]: r for r in fingerprint.edited_likeness(docs((1, "same line\n" * 40_000), (2, words(100_000, 3)))).collect()}
    assert out[1]["near_edited"] > 0.9 and out[1]["near_next"] < 0.5


def test_fingerprints_add_and_remove(spark):
    df = spark.createDataFrame([(1, "a b\nc d"), (2, "c d\na b"), (3, "a b"), (4, "c d"), (5, "")], "id int, text string")
    f = {r["id"]: r["lanes"] for r in fingerprint.fingerprints(df, ["id"], "text").collect()}
    assert f[1] == f[2] != f[3] and f[5] == [0] * (fingerprint.LANES + 1)
    pair = spark.createDataFrame([(f[1], f[3], f[4])], "a array<int>, b array<int>, c array<int>")
    row = pair.select(fingerprint.combine(F.col("b"), F.col("c")).alias("x"), fingerprint.combine(F.col("a"), F.col("b"), -1).alias("y")).first()
    assert row["x"] == f[1] and row["y"] == f[4]


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n", "<\\|", "<", "|", "a\\", "<|im_sep|>", None, "", "é\n\n", "x" * 100_000, "<|im_start|>assistant\nhi", "\\n<\\\\|"]
    rows = [(c, t, ["user", "assistant", "as\nsist\\n<|x", None, "assistant"][(t + c) % 5], nasty[(t * 3 + c) % len(nasty)]) for c in range(8) for t in range(15)]
    rows += [(3, 4, "user", "again"), (3, 4, "user", "again"), (None, None, "assistant", "no id")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(4)
    out = chat.format_conversations(df).select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), "formatted").collect()
    want: dict = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for r in out:
        expected = [x[2:] for x in sorted(want[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == expected
        assert r["loss"] == "".join(t for role, t in expected if role == "assistant")
    merged = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b")], "conv_id int, turn int, role string, text string")
    assert chat.format_conversations(merged).first()["formatted"] == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n"
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_url_rules_against_plain_matching(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/en/1x?q", "http://a.b.example.org/es/", "http://org", "http://org/", "x://x.org#/y",
            "http://notexample.org/en/1", "https://com/de/1", "https://s.com/fr/", "https://s.com/frx", "http://h/" + "p" * 50_000, "a://b://c.org/"]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls + urls[:3])], "page_id int, url string, `key` int")

    def plain(url):
        m = re.search("://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.key), default=None)
        return host, path, best and best.key, best.verdict if best else "allow"

    for r in url_filter.judge(df, RULES).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(r["url"])
    assert url_filter.judge(df.limit(0), RULES).collect() == []
    assert {r["verdict"] for r in url_filter.judge(df, []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 50 == 0).alias("listed"))
    levels = url_filter.build_cascade(universe, F.col("listed"))
    assert len(levels) > 1
    assert universe.where(url_filter.contains(F.col("key"), levels) != F.col("listed")).count() == 0
