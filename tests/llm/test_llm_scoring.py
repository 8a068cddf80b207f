"""Lattices against all segmentations written out, and scores against counts by hand."""

from collections import Counter
from itertools import product
from math import log10
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_engine.llm.common import held_out_remainder
from corpus_engine.llm.lattice import START, Vocabulary, expected_counts, marginals
from corpus_engine.llm.lm_scoring import Settings, Totals, count_words, default_vocabulary, estimate, lm_scores, vocabulary
from llm_helpers import documents, odd_rows, prose

TINY = Vocabulary([START + "a", START + "ab", "a", "b", "ab", "ba", START + "ba"], [-3, -1, -2, -6, -4, -5, -7])


def paths(word, p):
    """(probability, pieces) of every segmentation, by plain recursion."""
    marked, out = START + word, []

    def walk(at, weight, used):
        if at == len(marked):
            out.append((weight, used))
            return
        for end in range(at + 1, len(marked) + 1):
            if marked[at:end] in TINY.pieces and (at == 0 or marked[at] != START):
                i = TINY.pieces.index(marked[at:end])
                walk(end, weight * np.exp(p.pieces[i]), [*used, i])
        walk(at + 1, weight * np.exp(p.unknown), [*used, -2])

    walk(0, np.exp(p.end), [])
    return out


def test_forward_sum_is_the_sum_over_segmentations():
    p = TINY.parameters(TINY.first_weights())
    words = ["a", "ab", "aba", "abab", "zab", "bbaab", "b▁ab"]
    want = [np.log(sum(w for w, _ in paths(x, p))) for x in words]
    assert np.allclose(marginals(TINY, words, p), want)


def test_expected_counts_weight_segmentations():
    p = TINY.parameters(TINY.first_weights())
    words, want = ["ab", "aba", "zab"], np.zeros(len(TINY.pieces) + 2)
    for x in words:
        found = paths(x, p)
        for weight, used in found:
            for i in used:
                want[i] += weight / sum(w for w, _ in found)
    want[-1] = len(words)
    assert np.allclose(expected_counts(TINY, words, p), want)


def test_probabilities_of_words_sum_to_less_than_one_and_totals_to_one():
    p = TINY.parameters(TINY.first_weights())
    words = ["".join(x) for n in range(1, 9) for x in product("ab", repeat=n)]
    sub = marginals(TINY, words, p)
    assert np.exp(sub).sum() <= 1
    counts = np.array([3, 1, 2, 0, 1] + [0] * (len(words) - 5))
    totals = Totals(documents=4, tokens=7, words=4, once=2, twice=1)
    with_counts = (10 ** totals.log_word(counts, sub)).sum()
    assert with_counts <= 1 - 10**totals.log_end + 1e-9


@pytest.fixture(scope="module")
def rows():
    return odd_rows() + [(100 + i, prose(i, 40 + i)) for i in range(30)]


def by_hand(rows):
    taught = [(t or "") for i, t in rows if crc32(str("null" if i is None else i).encode()) % 7 != 2]
    counts = Counter(w for t in taught for w in t.encode().lower().split())
    n, v = sum(counts.values()) + len(taught), len(counts) + 1
    for i, t in rows:
        words = (t or "").encode().lower().split()
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in words) + log10((len(taught) + 1) / (n + v + 1))
        yield (i, len(words) + 1, 1 + sum(counts[w] > 0 for w in words), n, round(base, 4))


@pytest.mark.parametrize("frequent", [1, 50, 400_000])
def test_scores(spark, rows, frequent):
    held = held_out_remainder(F.col("doc_id"), 7) == 2
    got = lm_scores(documents(spark, rows), held, default_vocabulary(), Settings(frequent=frequent)).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=key) == sorted(by_hand(rows), key=key)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[1] == score[2] == score[3] > score[4] > score[8]


def test_scores_are_sums_over_the_words_of_a_text(spark, rows):
    """Every word's probability worked out in one go, without the joins."""
    held = held_out_remainder(F.col("doc_id"), 7) == 2
    frame = documents(spark, rows)
    got = lm_scores(frame, held, default_vocabulary(), Settings(frequent=50)).collect()
    raw = frame.select(F.col("text").cast("binary").alias("body"), held.alias("held"))
    p = estimate(count_words(raw), default_vocabulary(), Settings().rounds)
    taught = [(t or "").encode().lower().split() for i, t in rows if crc32(str("null" if i is None else i).encode()) % 7 != 2]
    counts = Counter(w for words in taught for w in words)
    totals = Totals(len(taught), sum(counts.values()), len(counts), sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values()))
    every = sorted({w for _, t in rows for w in (t or "").encode().lower().split()})
    scores = totals.log_parts(np.array([counts[w] for w in every]), marginals(vocabulary(default_vocabulary()), [w.decode("utf-8", "replace") for w in every], p))
    of = {w: tuple(float(x[k]) for x in scores) for k, w in enumerate(every)}
    want = []
    for i, t in rows:
        words = (t or "").encode().lower().split()
        score, alone, share = (sum(of[w][k] for w in words) for k in range(3))
        want.append((i, round(score + totals.log_end, 5), round(alone + totals.log_end, 5), round(share / len(words), 6) if words else None))
    key = lambda r: (r[0] is None, str(r))
    assert sorted(((r.doc_id, round(r.score, 5), round(r.lattice_score, 5), None if r.lattice_share is None else round(r.lattice_share, 6)) for r in got), key=key) == sorted(want, key=key)
    assert all(r.lattice_share is None or 0 <= r.lattice_share <= 1 + 1e-9 for r in got)


def test_empty_table_and_no_training(spark):
    assert lm_scores(documents(spark, []), F.lit(False), default_vocabulary()).collect() == []
    row = lm_scores(documents(spark, [(1, "a b")]), F.lit(True), default_vocabulary()).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0) and row.score < 0
