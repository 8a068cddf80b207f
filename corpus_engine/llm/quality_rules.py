"""Quality rules: countable rules and a calibrated classifier of hashed word and character n-grams.

The classifier is a logistic regression over the relative frequencies of hashed word 1- and 2-grams
and of hashed byte 2-, 3- and 4-grams of the raw text (case and symbols count). It learns from the whole texts of a
bounded sample of labelled ids, one row for each: at most ``Settings.train_rows``, in the order of a hash of the id, as long as the
n-grams of those before it number less than ``Settings.train_grams``. Both classes come in turns, so the bounds cut them alike, and
the sample is the same at any partitioning. One task learns, and only the weights come to the driver. Platt scaling on a part
that was not learnt turns the margin into a probability. Every text is then scored whole, in Arrow batches, against the fixed thresholds.

Defined results: a null or empty text has no words and fails the base rules; equal rows get equal
results, one row each; without labelled rows of both classes the rules alone decide (probability null).
Only the named columns are read, so further columns of any name do no harm. A null label row is left
out; a document labelled more than once learns from its lowest label, and of rows with one id the one with the smallest hash teaches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.llm.common import SPACES, prepare, texts

SYMBOLS = b"#*$%&|<>"
WORD_BITS = 17
CHAR_BITS = 17
WORDS, CHARS = 1 << WORD_BITS, 1 << CHAR_BITS
MIX = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Settings:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_probability: float = 0.5
    train_rows: int = 4_000  # bound of the labelled sample, half of it per class where there are enough
    train_grams: int = 20_000_000  # bound of the distinct n-grams of the sampled texts, counted text by text; 160 MB
    calibrate_share: float = 0.25
    epochs: int = 8
    rate: float = 0.5
    ridge: float = 1e-6


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of words, then of characters, then the intercept
    slope: float
    shift: float

    def probability(self, body: bytes, words: list[bytes]) -> float:
        at_words, at_chars = hashed(body, words)
        w = self.weights
        margin = float(w[-1])
        if len(at_words):
            margin += float(w[at_words].sum()) * SCALE / len(at_words)
        if len(at_chars):
            margin += float(w[at_chars].sum()) * SCALE / len(at_chars)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


SCALE = 8.0  # relative frequencies are small numbers; this keeps the learning rate in a usual range


def hashed(body: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places in the weights of the text's word and character n-grams, one for each occurrence."""
    w = np.fromiter(map(crc32, words), np.uint32, len(words))
    grams = [w % np.uint32(WORDS)]
    if len(w) > 1:
        grams.append(((w[:-1] * MIX) ^ w[1:]) % np.uint32(WORDS))
    b = np.frombuffer(body, np.uint8).astype(np.uint32)
    chars, rolled = [], b
    for order in (2, 3, 4):
        if len(b) < order:
            break
        rolled = rolled[:-1] * np.uint32(257) + b[order - 1:]
        chars.append(((rolled * MIX) >> np.uint32(32 - CHAR_BITS)) + np.uint32(WORDS))
    return np.concatenate(grams), np.concatenate(chars) if chars else np.zeros(0, np.uint32)


def sparse(body: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    places, values = [], []
    for found in hashed(body, words):
        if len(found):
            at, n = np.unique(found, return_counts=True)
            places.append(at)
            values.append(n * (SCALE / len(found)))
    if not places:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(places).astype(np.int32), np.concatenate(values).astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings, key: str, text: str, label: str) -> DataFrame:
    """One row (``turn``, ``id``, ``label``, ``body``) for each of at most ``train_rows`` ids, those with the smallest hashes in each class."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("id"))
    marks = marks.agg(F.min(label).cast("int").alias("label")).withColumn("draw", F.xxhash64("id"))
    drawn = [marks.where(F.col("label") == v).orderBy("draw", "id").limit(s.train_rows // 2) for v in (0, 1)]
    # At most train_rows narrow rows: small enough to broadcast, and to be ranked in one task.
    place = F.row_number().over(Window.partitionBy("label").orderBy("draw", "id"))
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]).withColumn("turn", place).drop("draw"))
    found = texts(docs, key, text).where("body is not null").join(chosen, "id")
    # Rows of one id are reduced in the tasks first, so that an id with very many rows sends one of each task.
    return found.groupBy("turn", "id", "label").agg(F.min(F.struct(F.xxhash64("body").alias("mark"), "body")).alias("first")).select("turn", "id", "label", "first.body")


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), key="doc_id", text="text", label="quality") -> Model | None:
    """The model, or None if the labelled sample lacks a class. One task learns from the bounded sample."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learn(((y, body) for batch in batches for y, body in zip(batch.column("label").to_pylist(), batch.column("body").to_pylist())), s)
        if model:
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.slope]), pa.array([model.shift])], ["weights", "slope", "shift"])

    ordered = labelled_sample(docs, labels, s, key, text, label).repartition(1).sortWithinPartitions("turn", "label").select("label", "body")
    made = ordered.mapInArrow(train, "weights binary, slope double, shift double").first()  # a megabyte
    return Model(np.frombuffer(made["weights"], np.float32), made["slope"], made["shift"]) if made else None


def learn(rows: Iterable[tuple[int, bytes]], s: Settings) -> Model | None:
    """AdaGrad over the rows in a fixed order, then Platt scaling on the rows kept aside."""
    made, size = [], 0
    for y, body in rows:
        if size < s.train_grams:
            made.append((y, *sparse(body, body.split())))
            size += len(made[-1][1])
    if {y for y, _, _ in made} != {0, 1}:
        return None
    made = [made[i] for i in np.random.default_rng(len(made)).permutation(len(made))]  # classes came in turns
    aside = [i for i in range(len(made)) if i % round(1 / s.calibrate_share) == 0]
    learnt = [i for i in range(len(made)) if i % round(1 / s.calibrate_share)] or aside
    share = {y: max(1, sum(made[i][0] == y for i in learnt)) / len(learnt) for y in (0, 1)}
    w = np.zeros(WORDS + CHARS + 1)
    square = np.full_like(w, 1e-8)
    for epoch in range(s.epochs):
        for i in np.random.default_rng(epoch).permutation(learnt):
            y, at, x = made[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x + w[-1], -30, 30)))
            slope = (p - y) * 0.5 / share[y]
            for where, gradient in ((at, slope * x + s.ridge * w[at]), (-1, slope)):
                square[where] += gradient * gradient
                w[where] -= s.rate * gradient / np.sqrt(square[where])
    tested = aside if {made[i][0] for i in aside} == {0, 1} else range(len(made))
    margin = np.array([w[made[i][1]] @ made[i][2] + w[-1] for i in tested])
    target = np.array([made[i][0] for i in tested], float)
    a, b = 1.0, 0.0
    good, bad = target.sum(), len(target) - target.sum()
    target = np.where(target == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(50):  # Newton steps on two parameters
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([(p - target) @ margin, (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[v @ (margin * margin), v @ margin], [v @ margin, v.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return Model(w.astype(np.float32), max(a, 1e-3), b)


def base_counts(body: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """Code points in words, symbols, lines equal to an earlier one, words in repeated 3-word windows."""
    spaces = len(body) - len(body.translate(None, SPACES))
    chars = len(body.decode("utf-8", "replace")) - spaces
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    lines = [x for x in body.split(b"\n") if x.strip()]
    doubled = len(lines) - len(set(lines))
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        until = 0
        for at, window in enumerate(windows):
            if often[window] > 1:
                repeated += at + 3 - max(at, until)
                until = at + 3
    return chars, symbols, doubled, repeated


COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, probability double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), key="doc_id", text="text", label="quality",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: the counts, the verdict of the base rules, the probability of good quality, ``kept``, and columns to carry along."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(fit(docs, labels, s, key, text, label))  # a megabyte, whatever the input

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body in batch.column("body").to_pylist():
                body = body or b""
                words = body.split()
                chars, symbols, doubled, repeated = base_counts(body, words)
                n = len(words)
                failed = n < s.min_words or 100 * repeated > s.max_repeat_percent * n
                p = model.value.probability(body, words) if model.value and words else None
                out.append((n, chars, symbols, doubled, repeated, failed, p,
                            not failed and (p is None or p >= s.min_probability)))
            columns = list(zip(*out)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds)), batch.column("carried")],
                [*(c.split()[0] for c in COLUMNS.split(", ")), "carried"])

    carried = F.struct(F.lit(0).alias("none"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("body"), carried.alias("carried"))
    scored = rows.mapInArrow(score, f"{COLUMNS}, carried {rows.schema['carried'].dataType.simpleString()}")
    return scored.select(*(c.split()[0] for c in COLUMNS.split(", ")), *(F.col(f"carried.c{i}").alias(c) for i, c in enumerate(carry)))
