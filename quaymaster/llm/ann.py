"""Nearest neighbours by largest inner product, from balanced posting lists.

Vectors get one more component so that all have the largest norm; a query gets a zero there, and its
nearest vectors are those of largest inner product. Centroids come from a bounded sample by k-means
whose distances grow with a cluster's size, which keeps the lists balanced. Every distinct vector goes
to its nearest list and, if it lies near a boundary, to others whose centroids are hardly farther. Centroids are
searched by a beam over a graph of near and random neighbours that every task holds in memory. A
query reads the lists whose centroid is within a ratio of the nearest one's distance (or of the usual one, if
that is more: a query may be a centroid). The ratio is fitted:
the least that finds enough of the true neighbours of sample queries in the sample.

Every row is indexed; equal vectors share one entry that keeps as many of their least ids as
a result can need. Lists and the queries of a list are dealt to as many tasks as their sizes ask for.

Rows without id, and vectors that are null, empty, zero, of another length than most, or with null or
non-finite components take no part. Rows of one id are one row. Scores are double precision inner products
of the vectors as given; ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quaymaster.llm.common import map_batches, ship_package
from quaymaster.session import materialise


@dataclass(frozen=True)
class IndexSettings:
    sample: int = 20_000  # vectors that centroids and ratio are fitted on, at most
    list_size: int = 200  # mean distinct vectors of a list, while there are fewer than the most lists
    most_lists: int = 2048
    replicas: int = 4
    boundary: float = 1.05  # a further list may be so much farther than the nearest
    recall: float = 0.97  # aim on the sample
    ratios: tuple[float, ...] = (1.05, 1.1, 1.15, 1.2, 1.25, 1.3, 1.4, 1.6, 2.0, 4.0)
    degree: int = 16
    leading: int = 4  # lists read first, for a bound on the scores
    task_vectors: int = 5000
    task_queries: int = 2000
    seed: int = 11


class CentroidGraph:
    """Centroids and a graph over them; bounded by the most lists."""

    def __init__(self, centroids: np.ndarray, degree: int, seed: int) -> None:
        self.centroids = centroids
        self.squares = (centroids**2).sum(1)
        n = len(centroids)
        rng = np.random.default_rng(seed)
        near = np.argsort(self.squares[None, :] - 2 * centroids @ centroids.T + self.squares[:, None], axis=1)[:, 1 : 1 + degree * 3 // 4]
        far = rng.integers(0, n, (n, degree - degree * 3 // 4))
        ring = ((np.arange(n) + 1) % n)[:, None]  # every centroid can be reached
        self.links = np.concatenate([near, far, ring], axis=1)
        self.entries = rng.permutation(n)[: max(1, min(n, 32))]

    def distances(self, x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Distances of each row of x to its row of nodes."""
        dots = np.einsum("bd,bkd->bk", x, self.centroids[nodes])
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + self.squares[nodes] - 2 * dots))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each row, nearest first, and their distances (infinite: none)."""
        b, beam = len(x), min(beam, len(self.centroids))
        rows = np.arange(b)
        seen = np.zeros((b, len(self.centroids)), bool)
        first = np.broadcast_to(self.entries, (b, len(self.entries)))
        seen[:, self.entries] = True
        nodes, far = first, self.distances(x, first)
        pad = max(0, beam - nodes.shape[1])
        nodes = np.concatenate([nodes, np.zeros((b, pad), np.int64)], axis=1)
        far = np.concatenate([far, np.full((b, pad), np.inf)], axis=1)
        done = np.isinf(far)
        while True:
            if nodes.shape[1] > beam:
                keep = np.argpartition(far, beam - 1, axis=1)[:, :beam]
                nodes, far, done = (np.take_along_axis(v, keep, 1) for v in (nodes, far, done))
            open_far = np.where(done, np.inf, far)
            j = open_far.argmin(1)
            active = np.isfinite(open_far[rows, j])
            if not active.any():
                break
            done[rows, j] |= active
            links = self.links[nodes[rows, j]]
            new = ~np.take_along_axis(seen, links, 1) & active[:, None]
            # A centroid may stand twice among the links; only its first place counts.
            place = np.argsort(links, axis=1, kind="stable")
            ordered = np.take_along_axis(links, place, 1)
            twice = np.zeros_like(new)
            np.put_along_axis(twice, place[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            new &= ~twice
            r, c = np.nonzero(new)
            seen[r, links[r, c]] = True
            d = np.where(new, self.distances(x, links), np.inf)
            nodes, far = np.concatenate([nodes, links], 1), np.concatenate([far, d], 1)
            done = np.concatenate([done, ~new], 1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(far, order, 1)


def balanced_centroids(x: np.ndarray, lists: int, seed: int, rounds: int = 8) -> np.ndarray:
    """K-means whose assignment adds a cost for full clusters, block by block."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), lists, replace=False)].copy()
    fair = len(x) / lists
    for _ in range(rounds):
        counts, sums = np.zeros(lists), np.zeros_like(centroids)
        scale = None
        for block in np.array_split(rng.permutation(len(x)), max(1, len(x) // 500)):
            d = (centroids**2).sum(1)[None, :] - 2 * x[block] @ centroids.T
            if scale is None:
                scale = float(np.std(d)) or 1.0
            nearest = (d + 0.5 * scale * np.maximum(0, counts / fair - 1)).argmin(1)
            counts += np.bincount(nearest, minlength=lists)
            np.add.at(sums, nearest, x[block])
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
        if (~full).any():
            centroids[~full] = x[rng.choice(len(x), int((~full).sum()), replace=False)]
    return centroids


@dataclass(frozen=True)
class Index:
    graph: CentroidGraph
    norm: float  # largest, squared
    ratio: float
    settings: IndexSettings
    typical: float = 0.0  # median distance of a vector from its nearest centroid

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(0, self.norm - (x**2).sum(1)))[:, None]], axis=1)

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for the nearest list of each vector and, at boundaries, others."""
        s = self.settings
        nodes, far = self.graph.search(self.lifted(x), max(16, s.replicas))
        nodes, far = nodes[:, : s.replicas], far[:, : s.replicas]
        row, col = np.nonzero(far <= s.boundary * far[:, :1])
        return row, nodes[row, col]

    def probes_of(self, q: np.ndarray, ratio: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for the lists that each query reads."""
        nodes, far = self.graph.search(np.concatenate([q, np.zeros((len(q), 1))], axis=1), len(self.graph.centroids))
        row, col = np.nonzero(far <= (ratio or self.ratio) * np.maximum(far[:, :1], self.typical))
        return row, nodes[row, col]


def fit_index(sample: np.ndarray, total: int, norm: float, settings: IndexSettings, k: int) -> Index:
    """Centroids, graph and ratio from a sample of distinct vectors."""
    lists = int(max(1, min(settings.most_lists, round(total / settings.list_size), len(sample) // 4 or 1)))
    index = Index(None, norm, math.inf, settings)  # type: ignore[arg-type]
    graph = CentroidGraph(balanced_centroids(index.lifted(sample), lists, settings.seed), settings.degree, settings.seed)
    near_far = [graph.search(index.lifted(sample[i : i + 512]), 16)[1][:, 0] for i in range(0, len(sample), 512)]
    typical = float(np.median(np.concatenate(near_far)))
    index = Index(graph, norm, math.inf, settings, typical)
    asked = sample[np.random.default_rng(settings.seed).permutation(len(sample))[:256]]
    near = np.argsort(-(asked @ sample.T), axis=1)[:, : min(k, len(sample))]
    held = np.zeros((len(sample), lists), bool)
    for start in range(0, len(sample), 512):
        row, found = index.lists_of(sample[start : start + 512])
        held[start + row, found] = True
    for ratio in settings.ratios:
        row, found = index.probes_of(asked, ratio)
        reads = np.zeros((len(asked), lists), bool)
        reads[row, found] = True
        hits = [(held[near[i]] & reads[i]).any(1).mean() for i in range(len(asked))]
        if np.mean(hits) >= settings.recall:
            break
    return Index(graph, norm, ratio, settings, typical)


# Spark -----------------------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, vec) of the vectors that take part."""
    v = F.col(vector)
    kind = vectors.schema[vector].dataType.elementType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        v = v.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), v.alias("vec")).where(
        F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (sizes["n"] if sizes else 0))


def as_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def listed(vectors: DataFrame, index: Index, probing: bool) -> DataFrame:
    """``vectors`` (node, vec, ...) once for each list that holds, or for a query reads, them; ``leading`` marks the nearest few."""
    others = [f for f in vectors.schema.fields]

    def work(batch: pa.RecordBatch):
        x = as_matrix(batch.column("vec"))
        for start in range(0, len(x), 512):
            block = x[start : start + 512]
            row, found = index.probes_of(block) if probing else index.lists_of(block)
            part = batch.slice(start, len(block)).take(pa.array(row))
            leading = np.arange(len(row)) - np.searchsorted(row, row) < index.settings.leading  # lists come nearest first
            yield {**{f.name: part.column(f.name) for f in others}, "list": found, "leading": leading}

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in others] + ["list int", "leading boolean"])
    return map_batches(vectors, work, schema)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
            settings: IndexSettings = IndexSettings()) -> DataFrame:
    """The ``k`` nearest other rows of every query row: (query_id, rank, id, score). ``is_query`` is a condition on ``id``."""
    spark = vectors.sparkSession
    ship_package(spark)
    out = "query_id bigint, rank int, id bigint, score double"
    rows = usable(vectors, id_column, vector)
    kept = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    nodes = materialise(
        rows.withColumn("_r", kept).where(F.col("_r") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, norm = nodes.agg(F.count("*"), F.max(square)).first()
    if not total:
        return spark.createDataFrame([], out)
    sample = nodes.select("vec", "node").orderBy(F.xxhash64(F.lit(settings.seed), "vec")).limit(settings.sample).toPandas()
    index = fit_index(np.stack([np.asarray(v, np.float64) for v in sample["vec"]]), total, norm, settings, k)

    asking = rows.where(is_query).select("id", "vec").distinct().join(nodes.select("vec", "node"), "vec").select(
        F.col("id").alias("query_id"), F.col("node").alias("qnode"))
    asking = materialise(asking, "queries")
    asked = asking.select(F.col("qnode").alias("node")).distinct().join(nodes.select("node", "vec"), "node")
    held = materialise(listed(nodes.select("node", F.element_at("ids", 1).alias("least"), "vec"), index, False), "postings")
    reads = materialise(listed(asked.select("node", "vec"), index, True), "probes")

    # One row a list, so at most ``most_lists`` rows to broadcast.
    sizes = held.groupBy("list").agg(F.ceil(F.count("*") / settings.task_vectors).cast("int").alias("parts")).join(
        reads.groupBy("list").agg(F.ceil(F.count("*") / settings.task_queries).cast("int").alias("qparts")), "list")
    sizes = F.broadcast(sizes)
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = held.join(sizes, "list").select(
        "list", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), steps("qparts").alias("qpart"), "node", "least", "vec")
    right = reads.join(sizes, "list").select(
        "list", steps("parts").alias("part"), F.pmod(F.xxhash64("node"), F.col("qparts")).cast("int").alias("qpart"),
        F.col("node").alias("qnode"), F.col("vec").alias("qvec"), "leading")

    def match(a: pa.Table, b: pa.Table) -> pa.Table:
        found = {"qnode": [], "node": [], "least": [], "score": []}
        if a.num_rows and b.num_rows:
            v, node, least = as_matrix(a.column("vec").combine_chunks()), a.column("node").to_numpy(), a.column("least").to_numpy()
            q, qnode = as_matrix(b.column("qvec").combine_chunks()), b.column("qnode").to_numpy()
            least_score = b.column("bound").to_numpy()
            for start in range(0, len(q), 256):
                scores = q[start : start + 256] @ v.T
                for i, s in enumerate(scores):
                    some = np.flatnonzero(s >= least_score[start + i])
                    if len(some) > k + 1:
                        cut = np.partition(s[some], len(some) - k - 1)[len(some) - k - 1]
                        some = some[s[some] >= cut]
                    some = some[np.lexsort((least[some], -s[some]))][: k + 1]
                    found["qnode"].append(np.full(len(some), qnode[start + i]))
                    found["node"].append(node[some])
                    found["least"].append(least[some])
                    found["score"].append(s[some])
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return pa.table({c: join(x, np.float64 if c == "score" else np.int64) for c, x in found.items()})

    by = ["list", "part", "qpart"]

    def matches(queries: DataFrame) -> DataFrame:
        there = queries.select(*[F.col(c).alias(f"q_{c}") for c in by], "qnode", "qvec", "bound")
        return left.groupBy(*by).cogroup(there.groupBy(*[f"q_{c}" for c in by])).applyInArrow(
            match, "qnode bigint, node bigint, least bigint, score double")

    # A query's leading lists give it a score that its result cannot fall below; all lists return what reaches it.
    none = F.lit(float("-inf"))
    first = matches(right.where("leading").withColumn("bound", none)).groupBy("qnode", "node").agg(
        F.max("score").alias("score"), F.min("least").alias("least"))
    in_rank = F.row_number().over(Window.partitionBy("qnode").orderBy(F.desc("score"), "least"))
    bounds = materialise(
        first.withColumn("_r", in_rank).where(F.col("_r") == k + 1).select("qnode", F.col("score").alias("bound")), "bounds")
    pairs = matches(right.join(bounds, "qnode", "left").withColumn("bound", F.coalesce("bound", none)))
    single = pairs.groupBy("qnode", "node").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    best = Window.partitionBy("qnode").orderBy(F.desc("score"), "least")
    few = single.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    spread = few.join(nodes.select("node", "ids"), "node").select("qnode", "score", F.explode("ids").alias("id"))
    top = Window.partitionBy("qnode").orderBy(F.desc("score"), "id")
    short = spread.withColumn("_r", F.row_number().over(top)).where(F.col("_r") <= k + 1)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        asking.join(short, "qnode").where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
    )
