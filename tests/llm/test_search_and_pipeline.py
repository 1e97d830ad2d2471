"""Nearest neighbours and the corpus pipeline."""

import gc
import weakref

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quaymaster.llm import ann, toxicity
from quaymaster.session import stage_scope


def exact(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.asarray(v, np.float64)
    ids = np.array(sorted(ok))
    x = np.stack([ok[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = x @ ok[q]
        place = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), s[j]) for j in place]
    return out


def test_nearest_finds_the_true_neighbours(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    rows = [(i, [float(np.float32(y)) for y in base[i % 12] + 0.3 * rng.normal(size=8)]) for i in range(900)]
    rows += [(1000 + i, rows[20][1]) for i in range(300)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [float("nan")] * 8), (2080, [1.0]), (None, rows[0][1]), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got: dict = {}
    for r in ann.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    want = exact(rows, 20)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(found, found[1:]))
        hits += len({f[1] for f in found} & {w[0] for w in want[q]})
    assert hits >= 0.95 * 20 * len(want)


def test_few_vectors_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.nearest(df, F.col("id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).collect() == []


def test_pipeline_stages(spark, tmp_path, words):
    rows = [(i, words(120, i), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end", "en", "s0") for i in range(10)]
    passage = words(60, 999)
    rows += [(200 + i, words(50, 500 + i) + " " + passage + " " + words(50, 600 + i), "en", "s1") for i in range(6)]
    toxic = [(300 + i, words(40, 700 + i) + " idiot moron " + words(5, 800 + i), "en", "s2") for i in range(40)]
    docs = spark.createDataFrame(rows + toxic, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows] + [(t[0], 1, 1) for t in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns, now, seen = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.materialise(stage(spark, now, str(tmp_path)), "test-stage")
        assert now.columns == columns and now.dtypes == docs.dtypes
        seen[name] = {r["doc_id"]: r["text"] for r in now.collect()}
    assert set(seen["toxicity"]) == {r[0] for r in rows}
    assert set(seen["near_copies"]) == {r[0] for r in rows if not 100 <= r[0] < 110}
    assert set(seen["repeated_strings"]) == set(seen["near_copies"])
    assert all(passage not in t for t in seen["repeated_strings"].values()) and seen["repeated_strings"][30] == rows[30][1]
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in last} == set(seen["source_mix"]) and all(r["ids"][-1] == 2 for r in last)
    assert toxicity.THRESHOLD == 0.7


def test_the_driver_frees_what_a_stage_left(spark):
    """What only a cycle of references holds of a stage is gone when the next one begins."""

    class Frame:
        pass

    frame = Frame()
    frame.itself, left = frame, weakref.ref(frame)
    gc.disable()
    try:
        with stage_scope(spark):
            del frame
        assert left() is not None
        with stage_scope(spark):
            assert left() is None
    finally:
        gc.enable()
