"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

* Document frequencies of the hashed n-grams are counted over every training document.
* The weights are learnt by follow-the-regularised-leader (FTRL-proximal) with elastic-net
  penalties, on a bounded sample of training rows: of each language the ``per_language`` distinct rows (id and text) with the smallest
  hashes, so copies of a row count once and the sample is the same at any partitioning. A sampled text teaches as a whole and as
  two short pieces of it, so that short texts are learnt as well. One task learns, and only the weights come to the driver.
* A temperature, fitted on sampled rows the weights did not see, calibrates the probabilities.
* Every text is scored whole.

Characters are code points in lower case; runs of ASCII characters that are no letters become one space, so that a text's
markup, digits and case say nothing about its language.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is any text when
no training row has a language. Equal rows give equal results, one row each; ties between languages go
to the first by name. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.llm.common import prepare, pairs, texts
from corpus_engine.operators.sizing import settled_side

BITS = 16
PLACES = 1 << BITS
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
SCALE = 10.0
SPACE = np.uint32(32)
LETTER = np.array([chr(c).isalpha() for c in range(128)])


@dataclass(frozen=True)
class Settings:
    per_language: int = 400  # distinct rows of a language that teach
    window_words: int = 60  # of the longer piece
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    epochs: int = 4


@dataclass(frozen=True)
class Model:
    names: list[str]
    weights: np.ndarray  # PLACES + 1 rows, the last the intercept; a column for each language
    temperature: float

    def predict(self, body: bytes) -> tuple[str, float]:
        at = grams(body)
        z = self.weights[-1] + (self.weights[at].sum(0) * (SCALE / len(at)) if len(at) else 0)
        z = z / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.names[best], float(p[best])


def folded(body: bytes) -> np.ndarray:
    """Code points in lower case, words bounded by one space, also at both ends."""
    if body.isascii():
        codes = np.frombuffer(body.lower(), np.uint8).astype(np.uint32)
    else:
        codes = np.frombuffer(body.decode("utf-8", "replace").lower().encode("utf-32-le"), "<u4").astype(np.uint32)
    codes = np.where((codes < 128) & ~LETTER[np.minimum(codes, 127)], SPACE, codes)
    codes = np.concatenate([[SPACE], codes, [SPACE]])
    return codes[np.append((codes[:-1] != SPACE) | (codes[1:] != SPACE), True)]


def grams(body: bytes) -> np.ndarray:
    """Hashed places of all n-grams, one for each occurrence."""
    codes = folded(body)
    found, rolled = [], codes
    for order in ORDERS:
        if order > 1:
            rolled = rolled[:-1] * np.uint32(263) + codes[order - 1:]
        if len(rolled):
            found.append(((rolled + np.uint32(order)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(found)


def has_letter(body: bytes) -> bool:
    if re.search(rb"[A-Za-z]", body):
        return True
    return any(c.isalpha() for c in body.decode("utf-8", "replace")) if not body.isascii() else False


def document_frequencies(bodies: DataFrame) -> tuple[np.ndarray, int]:
    """For each place the number of documents with it, and the number of documents; all of them are counted.

    A task sends one vector of fixed length; vectors are added in two steps, so the driver gets one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(PLACES, bool)
        total, n = np.zeros(PLACES, np.int64), 0
        for _, found in pairs(batches):
            for body in found:
                at = grams(body)
                seen[at] = True
                total += seen
                seen[at] = False
                n += 1
        at = np.flatnonzero(total)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, PLACES)), pa.array(np.append(total[at], n))], ["place", "n"])

    counted = bodies.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(PLACES + 1, np.int64)
    out[counted["place"].to_numpy()] = counted["n"].to_numpy()
    return out[:-1], int(out[-1])


def sample(docs: DataFrame, s: Settings, key: str, text: str, lang: str) -> DataFrame:
    """``lang`` and ``body`` of at most ``per_language`` distinct rows of each language, in a fixed order in one partition."""
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(-1)).alias("id"), F.col(text).cast("string").cast("binary").alias("body"),
                       F.col(lang).cast("string").alias("lang")).where("body is not null and lang is not null")
    rows = rows.withColumn("mark", F.xxhash64("body"))
    named = rows.select("lang", "id", "mark").distinct().withColumn("draw", F.xxhash64("lang", "id", "mark"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "mark"))
    # The rank's limit is applied before the shuffle: a language with a third of all rows sends this many of each task.
    drawn = named.withColumn("place", place).where(F.col("place") <= s.per_language)
    found = rows.join(settled_side(drawn), ["lang", "id", "mark"]).groupBy("place", "lang", "id", "mark").agg(F.min("body").alias("body"))
    return found.repartition(1).sortWithinPartitions("place", "lang").select("lang", "body")


def pieces(body: bytes, mark: int, s: Settings) -> list[bytes]:
    """The whole text, ``window_words`` of its words, and one to four."""
    words = body.split()
    begin = mark % max(1, len(words) - s.window_words + 1)
    parts = [body, b" ".join(words[begin:begin + s.window_words]), b" ".join(words[mark % max(1, len(words)):][:1 + mark % 4])]
    return list(dict.fromkeys(parts))


def learn(rows: Iterable[tuple[str, bytes]], frequencies: np.ndarray, n: int, s: Settings) -> Model | None:
    idf = (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float64)
    made, aside, names = [], [], {}
    for name, body in rows:
        mark = crc32(body)
        label = names.setdefault(name, len(names))
        for part in pieces(body, mark, s):
            if has_letter(part):
                at, count = np.unique(grams(part), return_counts=True)
                x = count * (SCALE / count.sum()) * idf[at]
                (aside if mark % 5 == 0 else made).append((label, at.astype(np.int32), x.astype(np.float32)))
    if not names:
        return None
    order = {names[name]: k for k, name in enumerate(sorted(names))}
    made, aside = ([(order[y], at, x) for y, at, x in part] for part in (made, aside))
    names = sorted(names)
    k = len(names)
    z, squares = np.zeros((PLACES + 1, k)), np.zeros((PLACES + 1, k))
    made = made or aside

    def weights(at):
        drop = np.abs(z[at]) <= s.l1
        return np.where(drop, 0, -(z[at] - np.sign(z[at]) * s.l1) / ((s.beta + np.sqrt(squares[at])) / s.alpha + s.l2))

    for epoch in range(s.epochs):
        for i in np.random.default_rng(epoch).permutation(len(made)):
            y, at, x = made[i]
            at, x = np.append(at, PLACES), np.append(x, 1.0)
            w = weights(at)
            score = x @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[y] -= 1
            gradient = np.outer(x, p)
            rise = (np.sqrt(squares[at] + gradient**2) - np.sqrt(squares[at])) / s.alpha
            z[at] += gradient - rise * w
            squares[at] += gradient**2
    w = weights(slice(None))
    tested = aside or made
    scores = np.array([x @ w[at] + w[-1] for _, at, x in tested])
    truth = np.array([y for y, _, _ in tested])

    def loss(t: float) -> float:
        q = scores / t
        q = q - q.max(1, keepdims=True)
        return float((np.log(np.exp(q).sum(1)) - q[np.arange(len(q)), truth]).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 241))
    best = float(min(grid, key=loss))
    w[:-1] *= idf[:, None]
    return Model(names, w.astype(np.float32), best)


def fit(training: DataFrame, s: Settings = Settings(), key="doc_id", text="text", lang="lang") -> Model | None:
    """The model, or None if no row has a language. One task learns from the bounded sample."""
    known = training.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    held = training.sparkSession.sparkContext.broadcast(document_frequencies(texts(known, key, text)))  # two vectors of fixed length

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learn((row for batch in batches for row in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist())), *held.value, s)
        if model:
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.names]), pa.array([model.weights.tobytes()]), pa.array([model.temperature])],
                ["names", "weights", "temperature"])

    made = sample(training, s, key, text, lang).mapInArrow(train, "names array<string>, weights binary, temperature double").first()
    held.unpersist()
    return Model(made["names"], np.frombuffer(made["weights"], np.float32).reshape(-1, len(made["names"])), made["temperature"]) if made else None


def language_id(docs: DataFrame, held_out: Column, s: Settings = Settings(), key="doc_id", text="text", lang="lang") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row; rows that are held out teach nothing."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(fit(docs.where(~held_out), s, key, text, lang))  # PLACES x languages at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.predict(b) if model.value and b and has_letter(b) else (UNKNOWN, 0.0)
                     for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held"), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("body"),
                       held_out.alias("held"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
