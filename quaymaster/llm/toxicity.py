"""Toxicity of texts whose words may be disguised.

1. A character language model (four letters, interpolated with shorter contexts) is counted
   over the words of all documents.
2. A word with digits or signs for letters, with a letter repeated three times or more or three letters doubled, or
   spaced out letter by letter is a lattice: each character may stand for some letters or for
   nothing, a run for one or two letters, and a spaced word may end after any letter. The
   Viterbi path under the language model is the restored word. Any other word's lattice has
   one path, the word itself in lower case without accents.
3. A logistic model over the restored words, and over how many of them share their first four
   letters, is fitted on a bounded number of labelled texts (``SAMPLE_ROWS``), one for each group
   of equal texts, and scores every restored text.

Null and empty texts have no words and get the score of the intercept. Labels, language,
source and id are not inputs of a score. Labels that are null are not used; if a document has
several, the highest holds. Repeated rows are scored each. Without any usable label, or with
one class only, the score is the smoothed share of toxic rows (0.5 for no rows).
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from dataclasses import dataclass
from functools import cached_property, lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from quaymaster.llm.common import blocks_of, held, map_batches, release, ship_package, texts_of, tidy
from quaymaster.session import materialise

SAMPLE_ROWS = 20_000  # labelled rows to learn from, at most
CHANCE_FEATURES = 1  # that the bar for a feature lets through, if none of all told anything
THRESHOLD = 0.7

# Letters that a digit or sign may stand for, and letters of other scripts that look alike.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
    "#": "abcdefghijklmnopqrstuvwxyz",
}
LOOKALIKE = str.maketrans("асеорхуіѕԁαοε", "aceopxyisdaoe")
INVISIBLE = re.compile("[­​-‏⁠﻿]")

LETTERS = 26
OTHER = LETTERS + 1  # any letter outside a-z
SIZE = LETTERS + 2  # with 0 for the end of a word
PART = re.compile(r"(?:[^\W_]|[@$!|+€£¢(*#])+")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+*])(?:[\s.\-_*/,]+(?:[^\W_]|[@$!|+*])(?![^\W_@$!|+])){2,}")
REPEATED = re.compile(r"(.)\1\1")
DOUBLES = re.compile(r"(.)\1")

# Costs in nats of what a disguise may have done.
SUBSTITUTED, DROPPED_SIGN, DROPPED_DIGIT, DOUBLED, PARTED = 0.7, 1.0, 4.0, 0.7, 3.0


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of every code point of the basic plane, after lower case and without accents."""
    table = np.zeros(1 << 16, np.int64)
    for code in range(1 << 16):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        if c.isalpha():
            base = unicodedata.normalize("NFKD", c.casefold())[0]
            table[code] = ord(base) - 96 if "a" <= base <= "z" else OTHER
    return table


def letter_class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else OTHER


# Language model ------------------------------------------------------------------


def gram_counts(docs: DataFrame) -> DataFrame:
    """Counts of four classes in a row inside words, over all documents: (gram, n).

    The context before a word is its boundary, so a word's letters are counted by themselves. Each task
    adds up in an array of 28**4 counters and emits those that are not zero.
    """

    def count(batches):
        release()
        total = np.zeros(SIZE**4, np.int64)
        table = letter_classes()
        for batch in batches:
            texts = batch.column("text")
            lengths = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
            for start, stop in blocks_of(lengths):
                joined = "\n".join(texts.slice(start, stop - start).to_pylist()) + "\n"
                codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
                c0 = table[np.minimum(codes, 0xFFFF)]
                c1 = np.concatenate([[0], c0[:-1]])
                c2 = np.where(c1 > 0, np.concatenate([[0], c1[:-1]]), 0)
                c3 = np.where(c2 > 0, np.concatenate([[0], c2[:-1]]), 0)
                grams = ((c3 * SIZE + c2) * SIZE + c1) * SIZE + c0
                total += np.bincount(grams[(c0 > 0) | (c1 > 0)], minlength=SIZE**4)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["gram", "n"])
        tidy()

    ship_package(docs.sparkSession)
    return texts_of(docs).select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame, strength: float = 8.0) -> np.ndarray:
    """Log-probability of a class after three others, as a flat array of 28**4 numbers.

    The counts that come to the driver are bounded by that size, whatever the input is.
    """
    counts = np.zeros(SIZE**4)
    found = gram_counts(docs).toPandas()
    counts[found["gram"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    four = counts.reshape(SIZE, SIZE, SIZE, SIZE)
    p = np.full(SIZE, 1.0 / SIZE)
    for level in (four.sum((0, 1, 2)), four.sum((0, 1)), four.sum(0), four):
        p = (level + strength * p) / (level.sum(-1, keepdims=True) + strength)
    return np.log(p).astype(np.float32).ravel()


# Restoring ---------------------------------------------------------------------------


def fold(text: str) -> str:
    """Lower case without accents, invisible characters and foreign lookalikes."""
    text = text.casefold()
    if text.isascii():
        return text
    text = "".join(c for c in unicodedata.normalize("NFKD", INVISIBLE.sub("", text)) if not unicodedata.combining(c))
    return text.translate(LOOKALIKE) if re.search("[a-z]", text) else text


def drawn_out(part: str) -> bool:
    """Whether a letter stands three times in a row, or three letters stand twice."""
    return bool(DOUBLES.search(part)) and (bool(REPEATED.search(part)) or len(DOUBLES.findall(part)) > 2)


class Restorer:
    """Viterbi decoder of disguised words; what it has decoded it remembers, up to a number of characters."""

    REMEMBERED = 1_500_000  # characters in each of two generations; an entry takes about 30 bytes a character
    LONGEST = 64

    def __init__(self, log_probability: np.ndarray) -> None:
        self.lm = log_probability.tolist()
        self.memo: dict[str, tuple[str, ...]] = {}
        self.older: dict[str, tuple[str, ...]] = {}
        self.held = 0

    def recall(self, key: str) -> tuple[str, ...] | None:
        found = self.memo.get(key)
        if found is None:
            found = self.older.get(key)
            if found is not None:
                self.remember(key, found)
        return found

    def remember(self, key: str, found: tuple[str, ...]) -> tuple[str, ...]:
        if len(key) <= self.LONGEST:
            if self.held >= self.REMEMBERED:
                self.older, self.memo, self.held = self.memo, {}, 0
            self.memo[key] = found
            self.held += len(key)
        return found

    def lattice(self, part: str, spaced: bool) -> list[list[tuple[str, float]]]:
        """For each run of one character the strings that it may stand for, with their cost; a space ends a word."""
        doubled = drawn_out(part)
        runs, i = [], 0
        while i < len(part):
            j = i
            while j < len(part) and part[j] == part[i]:
                j += 1
            c, n = part[i], j - i
            letters = STANDS_FOR.get(c)
            if letters is None:
                if n == 1:
                    options = [(c, 0.0)]
                elif n == 2 and not doubled:
                    options = [(c + c, 0.0), (c, DOUBLED + 2.0)]
                else:
                    options = [(c, 0.0), (c + c, DOUBLED)]
            else:
                wild = math.log(len(letters))
                options = [(x, SUBSTITUTED + wild) for x in letters]
                if n > 1:
                    options += [(x + x, SUBSTITUTED + wild + DOUBLED) for x in letters]
                options.append(("", DROPPED_DIGIT * n if c.isdigit() else DROPPED_SIGN))
            if spaced:
                options += [(x + " ", cost + PARTED) for x, cost in options if x]
            runs.append(options)
            i = j
        return runs

    def decode(self, part: str, spaced: bool = False) -> tuple[str, ...]:
        """Words of the best path through the lattice."""
        lm, square = self.lm, SIZE * SIZE
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # last three classes -> cost, path
        for options in self.lattice(part, spaced):
            reached: dict[int, tuple[float, tuple | None]] = {}
            for state, (cost, path) in states.items():
                for emitted, extra in options:
                    now, total = state, cost + extra
                    for c in emitted:
                        k = 0 if c == " " else ord(c) - 96 if "a" <= c <= "z" else OTHER
                        total -= lm[now * SIZE + k]
                        now = 0 if k == 0 else (now % square) * SIZE + k
                    best = reached.get(now)
                    if best is None or total < best[0]:
                        reached[now] = (total, (path, emitted) if emitted else path)
            states = reached
        _, path = min(((cost - lm[s * SIZE]) if s else cost, i, p) for i, (s, (cost, p)) in enumerate(states.items()))[::2]
        out = []
        while path is not None:
            path, emitted = path
            out.append(emitted)
        return tuple("".join(reversed(out)).split())

    def token(self, token: str) -> tuple[str, ...]:
        """Restored words of a token without white space."""
        found = self.recall(token)
        if found is None:
            words: list[str] = []
            plain = fold(token)
            if not token.isascii():
                words += [p for p in PART.findall(token.casefold()) if p.isalpha() and not p.isascii()]
            for part in [plain] if plain.isalpha() else PART.findall(plain):
                if part.isalpha():
                    words += [part] if not drawn_out(part) else self.decode(part)
                elif any(c.isalpha() for c in part) or len(part) > 2 and len(set(part)) > 1 and not part.isdigit():
                    words += self.decode(part)
            found = self.remember(token, tuple(words))
        return found

    def words(self, text: str) -> set[str]:
        """Distinct restored words of a text."""
        out: set[str] = set()
        known, token = self.memo.get, self.token
        for t in set(text.split()):
            found = known(t)
            out.update(token(t) if found is None else found)
        for m in SPACED.finditer(text):
            letters = fold(re.sub(r"[\s.\-_/,]+", "", m.group()))
            if any(c.isalpha() for c in letters):
                key = " " + letters
                found = self.recall(key)
                out.update(found if found is not None else self.remember(key, self.decode(letters, spaced=True)))
        return out


def features(words: set[str]) -> set[str]:
    """Words, and for the first four letters of longer ones a mark for one, two, three, four or more words."""
    shared: dict[str, int] = {}
    for w in words:
        if len(w) > 4:
            shared[w[:4]] = shared.get(w[:4], 0) + 1
    return words | {"^" * k + start for start, n in shared.items() for k in range(1, min(n, 4) + 1)}


def restorer(model: Broadcast) -> Restorer:
    """One decoder for each worker and model, kept from task to task of a stage."""
    key = hashlib.md5(model.value.tobytes()).digest()
    return held(("restorer", key), lambda: Restorer(model.value))


# Classifier ----------------------------------------------------------------------------


def learning_rows(labels: DataFrame, usable: Column | None = None, most: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``most`` labelled ids, chosen by hash: (doc_id, toxic)."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "toxic IS NOT NULL AND doc_id IS NOT NULL")
    if usable is not None:
        known = known.where(usable)
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(most)


@dataclass(frozen=True)
class Classifier:
    intercept: float
    weights: dict[str, float]

    @cached_property
    def known(self) -> tuple[frozenset[str], frozenset[str]]:
        """The features that have a weight, and the first four letters that some of them mark."""
        return frozenset(self.weights), frozenset(f.lstrip("^") for f in self.weights if f.startswith("^"))

    def score(self, words: set[str]) -> float:
        """Score from the ``features`` of the words; only those with a weight are looked up."""
        weights, (known, starts) = self.weights, self.known
        shared: dict[str, int] = {}
        for start in [w[:4] for w in words if w[:4] in starts and len(w) > 4]:
            shared[start] = shared.get(start, 0) + 1
        marks = {"^" * k + start for start, n in shared.items() for k in range(1, min(n, 4) + 1)}
        total = self.intercept + sum(weights[f] for f in sorted((words | marks if marks else words) & known))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, total))))


def fit_logistic(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_features: int, l1: float = 1e-5, steps: int = 3000) -> tuple[float, np.ndarray]:
    """Logistic regression with L1 penalty over sparse 0/1 features, by accelerated proximal steps."""
    n = len(y)
    w, b = np.zeros(n_features), math.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    per_row = np.bincount(rows, minlength=n).max() if len(rows) else 0
    rate = 4.0 / (1 + per_row)
    v, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        margin = vb + np.bincount(rows, v[cols], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        step = v - rate * np.bincount(cols, error[rows], minlength=n_features) / n
        new_w = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
        new_b = vb - rate * error.mean()
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, vb = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return b, w


def fit(docs: DataFrame, sample: DataFrame, model: Broadcast) -> Classifier:
    """Classifier from the texts of ``sample`` (doc_id, toxic; at most ``SAMPLE_ROWS`` rows, which bounds its broadcast and all that follows)."""
    texts = texts_of(docs).join(F.broadcast(sample), "doc_id").groupBy(F.xxhash64("text").alias("h")).agg(
        F.max("text").alias("text"), F.max("toxic").alias("toxic"))

    def work(batch: pa.RecordBatch):
        tool = restorer(model)
        yield {
            "h": batch.column("h"), "toxic": batch.column("toxic"),
            "found": [sorted(features(tool.words(t))) for t in batch.column("text").to_pylist()],
        }

    seen = materialise(map_batches(texts, work, "h bigint, toxic int, found array<string>", keeps=True), "toxicity-sample")
    pos, neg = seen.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not pos or not neg:
        share = (pos + 1) / (pos + neg + 2)
        return Classifier(math.log(share / (1 - share)), {})
    up = (F.col("p") + 0.5) / (pos + 1.0)
    down = (F.col("n") + 0.5) / (neg + 1.0)
    z = F.log(up / down) / F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5))
    counts = seen.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(
        F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") != 1).alias("n"))
    # So many features are tested that some stand out by chance alone; the bar is where a few would.
    tested = counts.where("p >= 3").withColumn("z", z)
    bar = max(3.0, NormalDist().inv_cdf(max(0.5, 1 - CHANCE_FEATURES / max(1, tested.count()))))
    chosen = tested.where(F.col("z") > bar).select("f")
    names = sorted(r["f"] for r in chosen.collect())  # from the words of the sample, which bounds them
    if not names:
        share = (pos + 1) / (pos + neg + 2)
        return Classifier(math.log(share / (1 - share)), {})
    place = {f: i for i, f in enumerate(names)}
    listed = seen.sparkSession.createDataFrame([(f, i) for f, i in place.items()], "f string, i int")
    hits = seen.select("h", F.explode("found").alias("f")).join(F.broadcast(listed), "f").groupBy("h").agg(
        F.sort_array(F.collect_list("i")).alias("i"))
    rows = seen.select("h", "toxic").join(hits, "h", "left").orderBy("h").toPandas()
    present = [i if i is not None else [] for i in rows["i"]]
    at = np.repeat(np.arange(len(rows)), [len(i) for i in present])
    cols = np.concatenate([np.asarray(i, np.int64) for i in present]) if len(at) else np.zeros(0, np.int64)
    b, w = fit_logistic(at, cols.astype(np.int64), (rows["toxic"].to_numpy() == 1).astype(float), len(names))
    return Classifier(float(b), {f: float(w[i]) for f, i in place.items() if abs(w[i]) > 1e-6})


def score_of(text: Column, classifier: Classifier, model: Broadcast) -> Column:
    """Score of a text. Only the text goes to the Python worker; the other columns of a row stay where they are."""

    def work(texts: pa.Array) -> pa.Array:
        tool = restorer(model)
        return pa.array([classifier.score(tool.words(t.as_py() or "")) for t in texts], pa.float64())

    return F.arrow_udf(work, "double")(text.cast("string"))


def score_column(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Column:
    """Language model and fit in one: the score of the rows of ``docs``, for a filter or a new column.

    ``usable`` is a condition on ``doc_id`` that a label must meet to be learned from.
    """
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(language_model(docs))
    sample = materialise(learning_rows(labels, usable), "toxicity-labels")
    return score_of(docs["text"], fit(docs, sample, model), model)


def with_scores(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> DataFrame:
    """``docs`` with ``_score`` (in place of a column of that name)."""
    return docs.withColumn("_score", score_column(docs, labels, usable))
