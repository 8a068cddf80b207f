"""Language-model scores: marginal probabilities over subword lattices.

The vocabulary is an existing file's. Its scores, turned into a distribution, weight all segmentations of
a word; expected piece counts over the distinct words of the training documents re-estimate that
distribution (``rounds`` times), and a log-space forward recursion then sums over all segmentations.
A word seen in training also has one arc over the whole word, weighted by its discounted count, and the
discounts pay for the paths through pieces: log P(word) is the sum over all these paths. Text probability
is the product over its words and one end.

Work grows with the corpus only in tables: word counts are summed in tasks before they are shuffled;
words that make up at least 1/``frequent`` of all tokens are at most ``frequent`` in number (so many
counts of that size fill the corpus), and only they are broadcast; every other word is too rare to be a hot
key and is joined. Piece counts have the vocabulary's fixed length.

Defined results: a null or empty text is its end alone; every row gets a result, equal rows equal ones;
without a training document all base scores are 0 and the file's own scores decide. Very long words cost
time in proportion to their length. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import gathered, prepare, settled
from corpus_engine.llm.lattice import Parameters, Vocabulary, expected_counts, marginals

HOLD_WORDS = 200_000  # distinct words a task holds before it sends their counts on
AT_ONCE = 32_768  # words of one call of the lattice code
LN10 = log(10)
SUMS = ("base", "score", "alone", "share")  # of a word, added up over a text
SUM_COLUMNS = ", ".join(f"{c} double" for c in SUMS)


@dataclass(frozen=True)
class Settings:
    rounds: int = 2
    frequent: int = 400_000


@dataclass(frozen=True)
class Totals:
    documents: int  # of training; each has one end
    tokens: int  # of training, without ends
    words: int  # distinct, with a training count
    once: int
    twice: int

    @property
    def discount(self) -> float:
        return self.once / (self.once + 2 * self.twice) if self.once else 0.5

    @property
    def log_end(self) -> float:
        return log10((self.documents + 1) / (self.documents + self.tokens + 2))

    def log_word(self, counts: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """log10 P(word): the whole-word arc and all paths through pieces, given that the text goes on."""
        return self.log_parts(counts, pieces)[0]

    def log_parts(self, counts: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 P(word); the same from pieces alone; and the share of P(word) that paths through pieces have."""
        going_on = log10(1 - 10**self.log_end)
        alone = going_on + pieces / LN10
        if not self.tokens:
            return alone, alone, np.ones(len(alone))
        d = self.discount
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(counts - d, 0) / self.tokens)
            paths = np.log(d * self.words / self.tokens) + pieces
            total = np.logaddexp(whole, paths)
            return going_on + total / LN10, alone, np.exp(paths - total)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.from_file(path)


def default_vocabulary() -> str:
    """The public vocabulary file of the query; any path may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_words(rows: DataFrame) -> DataFrame:
    """``word`` and ``c``, its count in rows that are not held out; words only held out have 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught, other = Counter(), Counter()

        def flush():
            words = list(taught.keys() | other.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([taught[w] for w in words], pa.int64())], ["word", "c"])
            taught.clear()
            other.clear()
            return out

        for batch in batches:
            for held, body in zip(batch.column("held").to_pylist(), batch.column("body").to_pylist()):
                if body:
                    (other if held else taught).update(body.lower().split())
                if len(taught) + len(other) > HOLD_WORDS:
                    yield flush()
        if taught or other:
            yield flush()

    return rows.select("held", "body").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def estimate(counted: DataFrame, path: str, rounds: int) -> Parameters:
    """Re-estimates the vocabulary's distribution on the distinct training words."""
    v = vocabulary(path)
    p = v.parameters(v.first_weights())
    taught = counted.where("c > 0").select("word")
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], p=p) -> Iterator[pa.RecordBatch]:
            found, total = vocabulary(path), None
            for batch in gathered(batches, AT_ONCE):
                words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
                if words:
                    counts = expected_counts(found, words, p)
                    total = counts if total is None else total + counts
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "n"])

        sums = taught.mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        if not sums.num_rows:
            break
        weights = np.zeros(len(v.pieces) + 2)
        weights[sums["piece"].to_numpy()] = sums["n"].to_numpy()
        p = v.parameters(weights)
    return p


def lm_scores(docs: DataFrame, held_out: Column, path: str, s: Settings = Settings(), key="doc_id", text="text") -> DataFrame:
    """One row per document: token counts, the base score and the model's log10 probability of the text; that from pieces alone
    (``lattice_score``), and the mean share of a word's probability that paths through pieces have (``lattice_share``; null without words)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("body"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    counted = settled(count_words(rows), "lm-words")
    sums = counted.where("c > 0").agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))).first()
    totals = Totals(rows.where("not held").count(), *sums)
    parameters = spark.sparkContext.broadcast(estimate(counted, path, s.rounds))  # the vocabulary's length

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = vocabulary(path)
        for batch in gathered(batches, AT_ONCE):
            c = batch.column("c").to_numpy()
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            scores = totals.log_parts(c, marginals(found, words, parameters.value)) if words else [np.zeros(0)] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(np.log10(c + 1.0)), *map(pa.array, scores)], ["word", "c", *SUMS])

    weighed = settled(counted.mapInArrow(weigh, f"word binary, c long, {SUM_COLUMNS}"), "lm-scores")
    least = totals.tokens / s.frequent
    # At most `frequent` words have so large a share of all tokens.
    common = weighed.where((F.col("c") > 0) & (F.col("c") >= least)).toArrow()
    known = spark.sparkContext.broadcast(dict(zip(common["word"].to_pylist(), zip(*(common[c].to_pylist() for c in SUMS)))))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with the sums over a document's frequent words and its length, and a row for each of its other words."""
        frequent = known.value
        for batch in batches:
            out = [[] for _ in range(6 + len(SUMS))]
            for row, doc_id, held, body in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "held", "body"))):
                n_tokens = n_known = 0
                base = score = alone = share = 0.0
                rest = []
                for word, n in Counter((body or b"").lower().split()).items():
                    n_tokens += n
                    at = frequent.get(word)
                    if at is None:
                        rest.append((row, None, None, word, n, 0, 0.0, 0.0, 0.0, 0.0))
                    else:
                        n_known += n
                        base += n * at[0]
                        score += n * at[1]
                        alone += n * at[2]
                        share += n * at[3]
                for values in [(row, doc_id, held, None, n_tokens, n_known, base, score, alone, share), *rest]:
                    for column, value in zip(out, values):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), *[pa.float64()] * len(SUMS))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["row", "doc_id", "held_out", "word", "n", "known", *SUMS])

    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # read once; from here on the numbers are in a written table
    parts = settled(numbered.mapInArrow(
        split, f"row long, doc_id long, held_out boolean, word binary, n long, known long, {SUM_COLUMNS}"), "lm-parts")
    rare = parts.where("word is not null").select("row", "word", "n").join(
        weighed.where((F.col("c") < least) | (F.col("c") == 0)).select("word", "c", *SUMS), "word")
    rare = rare.select("row", F.lit(0).cast("bigint").alias("n"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"),
                       *[(F.col("n") * F.col(c)).alias(c) for c in SUMS])
    own = parts.where("word is null")
    summed = own.select("row", "n", "known", *SUMS).unionByName(rare).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n", "known", *SUMS)])
    tokens = totals.tokens + totals.documents
    distinct = totals.words + (totals.documents > 0)
    has_end = totals.documents > 0
    return own.select("row", "doc_id", "held_out").join(summed, "row").select(
        "doc_id", "held_out", (F.col("n") + 1).alias("n_tokens"), (F.col("known") + int(has_end)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + log10(totals.documents + 1) - (F.col("n") + 1) * log10(tokens + distinct + 1)).alias("base_score"),
        (F.col("score") + totals.log_end).alias("score"), (F.col("alone") + totals.log_end).alias("lattice_score"),
        F.when(F.col("n") > 0, F.col("share") / F.col("n")).alias("lattice_share"))
