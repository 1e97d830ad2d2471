"""Vector code compression: product codes with codebooks learned by active-entry Lloyd rounds.

Every component c becomes the integer floor(4096 * c), and a vector is cut into 8 equal parts. A
codebook of 16 entries for each part position starts from the vectors of the 16 least ids. A round
assigns every part to its nearest entry (ties: the lower index) and then replaces each entry by the floor of
its parts' mean; unused entries stay. After 6 rounds the parts are assigned once more.

Rounds keep, for every part, its entry and the exact distance to it. Only entries that the last update
moved are active: a part whose own entry stayed compares its stored distance with the moved entries alone, as all other
entries are as far as before and lost to its own already; a part whose entry moved is compared with all.

A round is one pass without a shuffle: a task reads vectors and state, writes the new state, and adds the
sums of its parts by entry as a few rows of the same table. Spark adds those up; only the sums of the 8 x 16 entries
reach the driver. The state before the last is deleted, so that two are kept at a time.

Rows whose vector is null or holds null or non-finite components are dropped; so are empty vectors and, where
lengths differ, vectors of another length than most (ties: the longer). If the length is not a multiple of 8,
zeros are appended. Rows of one id all count; the starting entries are the first 16 rows by id (null ids last), then
by components. With fewer than 16 rows there are as many entries as rows. An empty table gives no rows. Other
columns are not looked at. A component beyond 2**14 is an error, as its distances could leave a long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymaster.llm.ann import as_matrix
from quaymaster.llm.common import ship_package
from quaymaster.llm.vectors import as_lists, drop_folder, finite_vectors, scaled_integers
from quaymaster.session import materialise, scratch_path

# Fixed values of the contract.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

# Squares of differences stay below 2**55, sums of 128 of them below 2**62.
LIMIT = 2**26
STEP_ROWS = 16_384


@dataclass(frozen=True)
class Codebooks:
    """Entries (parts, entries, width) and which of them the last update moved."""

    entries: np.ndarray
    moved: np.ndarray

    def text(self) -> str:
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


def distances(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    away = x - entry
    return np.einsum("nw,nw->n", away, away)


def nearest(x: np.ndarray, books: Codebooks, part: int, code: np.ndarray | None, far: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Entry and exact distance of every row of ``x`` (rows, width) at ``part``; ``code`` and ``far`` are those before the last update."""
    entries, moved = books.entries[part], books.moved[part]
    new_code = np.zeros(len(x), np.int64)
    new_far = np.full(len(x), np.iinfo(np.int64).max)
    rescan = np.ones(len(x), bool)
    if code is not None:
        rescan = moved[code]
        new_code[~rescan], new_far[~rescan] = code[~rescan], far[~rescan]
    for rows, active in ((rescan, np.arange(len(entries))), (~rescan, np.flatnonzero(moved))):
        at = np.flatnonzero(rows)
        if not len(at) or not len(active):
            continue
        some, best, best_far = x[at], new_code[at], new_far[at]
        for e in active:
            d = distances(some, entries[e])
            better = (d < best_far) | ((d == best_far) & (e < best))
            best[better], best_far[better] = e, d[better]
        new_code[at], new_far[at] = best, best_far
    return new_code, new_far


def assigned(x: np.ndarray, books: Codebooks, code: np.ndarray | None, far: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Entries and distances (rows, parts) of the parts of ``x`` (rows, parts, width)."""
    new = [nearest(x[:, p], books, p, None if code is None else code[:, p], None if far is None else far[:, p]) for p in range(x.shape[1])]
    return np.stack([n[0] for n in new], 1), np.stack([n[1] for n in new], 1)


def usable(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, vec, label) of the vectors that take part."""
    rows = finite_vectors(vectors, id_column, vector, F.col(label).alias("label")).where(F.size("vec") > 0)
    most = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return rows.where(F.size("vec") == (most["dims"] if most else 0))


def start_entries(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """Codebooks of the first rows by id; one row of the driver for each entry."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    if not first:
        return None
    x = padded(scaled_integers(np.array([r["vec"] for r in first]), SCALE, 0, LIMIT), parts)
    book = x.transpose(1, 0, 2).copy()
    return Codebooks(book, np.ones(book.shape[:2], bool))


def padded(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width), with zeros appended to vectors that do not divide."""
    width = -(-x.shape[1] // parts)
    full = np.zeros((len(x), parts * width), np.int64)
    full[:, : x.shape[1]] = x
    return full.reshape(len(x), parts, width)


def round_pass(state: DataFrame, books: Codebooks, parts: int, last: bool) -> DataFrame:
    """New state of every row and, in rows with a ``part``, a task's sums by entry. The last pass leaves vectors and sums out."""
    label = state.schema["label"].dataType.simpleString()
    schema = f"id bigint, label {label}, vec array<bigint>, code array<int>, far array<bigint>, part int, entry int, rows bigint, sums array<bigint>"
    names = ["id", "label", "vec", "code", "far", "part", "entry", "rows", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, entries, width = books.entries.shape
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        label_type = None
        for whole in batches:
            label_type = whole.column("label").type
            for start in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(start, STEP_ROWS)
                n, first = batch.num_rows, "code" not in batch.schema.names
                c = as_matrix(batch.column("vec")) if first else batch.column("vec").flatten().to_numpy().reshape(n, -1)
                x = padded(scaled_integers(c, SCALE, 0, LIMIT), parts) if first else c.reshape(n, parts, width)
                before = [None, None] if first else [batch.column(k).flatten().to_numpy().reshape(n, parts) for k in ("code", "far")]
                code, far = assigned(x, books, *before)
                for p in range(0 if last else parts):
                    counts[p] += np.bincount(code[:, p], minlength=entries)
                    for e in range(entries):
                        sums[p, e] += x[code[:, p] == e, p].sum(0)
                none = lambda kind: pa.nulls(n, kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), none(pa.list_(pa.int64())) if last else as_lists(x.reshape(n, -1), pa.int64()),
                     as_lists(code, pa.int32()), as_lists(far, pa.int64()), none(pa.int32()), none(pa.int32()), none(pa.int64()),
                     none(pa.list_(pa.int64()))], names=names)
        part, entry = np.nonzero(counts)
        if len(part):
            none = lambda kind: pa.nulls(len(part), kind)
            yield pa.RecordBatch.from_arrays(
                [none(pa.int64()), none(label_type), none(pa.list_(pa.int64())), none(pa.list_(pa.int32())), none(pa.list_(pa.int64())),
                 pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), as_lists(sums[part, entry], pa.int64())],
                names=names)

    return state.mapInArrow(run, schema)


def updated(books: Codebooks, written: DataFrame) -> Codebooks:
    """Every used entry becomes the floor of the mean of its parts."""
    parts = written.where("part IS NOT NULL").select("part", "entry", "rows", F.posexplode("sums").alias("at", "value"))
    totals = parts.groupBy("part", "entry", "at").agg(F.sum("rows").alias("rows"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
    entries = books.entries.copy()
    for r in totals.collect():  # one row for each component of an entry
        entries[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["rows"]
    return Codebooks(entries, (entries != books.entries).any(2))


@dataclass(frozen=True)
class Compressed:
    codes: DataFrame  # id, label, code array<int>, error bigint
    books: Codebooks

    @property
    def books_sha256(self) -> str:
        return hashlib.sha256(self.books.text().encode()).hexdigest()


def compress(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Compressed | None:
    """Codes of all vectors and the final codebooks; none if no vector takes part."""
    spark: SparkSession = vectors.sparkSession
    ship_package(spark)
    state = usable(vectors, id_column, vector, label)
    books = start_entries(state, parts, entries)
    if books is None:
        return None
    old = None
    for _ in range(rounds):
        path = scratch_path(spark, "code-state")
        now = round_pass(state, books, parts, last=False)
        now.write.parquet(path)
        written = spark.read.schema(now.schema).parquet(path)
        books = updated(books, written)
        if old:
            drop_folder(spark, old)
        old, state = path, written.where("part IS NULL").select("id", "label", "vec", "code", "far")
        if not books.moved.any():
            break  # further rounds would change nothing
    error = F.aggregate("far", F.lit(0).cast("bigint"), lambda s, x: s + x)
    codes = materialise(round_pass(state, books, parts, last=True).select("id", "label", "code", error.alias("error")), "codes")
    if old:
        drop_folder(spark, old)
    return Compressed(codes, books)


def with_label_errors(done: Compressed) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over the rows of a label, null labels together.

    The sums are written before the join, so that both of its sides are plain exchanges and a label that holds
    a third of the rows can be split.
    """
    sums = materialise(done.codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "_label")
    return done.codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
