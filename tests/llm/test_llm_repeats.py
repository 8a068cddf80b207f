"""Repeated passages against a set of all windows seen so far."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_engine.llm.common import mark
from corpus_engine.llm.repeated_passages import Settings, remove_repeats, stretches, subtree_repeats
from llm_helpers import documents, odd_rows, prose


def by_hand(rows, marks, window=20):
    """Rows with equal id and text are one document; order is by id, null last, then by the text's hash."""
    seen, out = set(), {}
    for doc in sorted(set(zip(rows, marks)), key=lambda d: (d[0][0] is None, d[0][0] or 0, d[1])):
        words = (doc[0][1] or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc[0]] = (doc[0][0], len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted((out[r] for r in rows), key=str)


def check(spark, rows, s=Settings()):
    frame = documents(spark, rows)
    marks = {(r.doc_id, r.text): r.m for r in frame.select("doc_id", "text", mark(frame.text).alias("m")).collect()}
    got = remove_repeats(frame, s, carry=("lang", "body"), with_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == by_hand(rows, [marks[r] for r in rows])
    texts = {(r.doc_id, r.n_words): r for r in got}
    for doc_id, text in rows:
        r = texts.get((doc_id, len((text or "").encode().split())))
        if r and r.n_removed == 0 and [x[0] for x in rows].count(doc_id) == 1:
            assert r.kept_text == (text or "")


def passages(seed):
    r = random.Random(seed)
    shared = [prose(900 + i, r.randint(15, 70)) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(seed * 100 + i, r.randint(0, 50))]
        for _ in range(r.randrange(3)):
            words = r.choice(shared).split()
            a, b = sorted((r.randrange(len(words) + 1), r.randrange(len(words) + 1)))
            parts += [" ".join(words[a:b] if r.random() < 0.5 else words), prose(seed * 1000 + i, r.randint(0, 9))]
        rows.append((i, " \n".join(parts)))
    return rows


@pytest.mark.parametrize("s", [Settings(), Settings(group=1)])
def test_shared_passages(spark, s):
    check(spark, passages(1), s)


def test_few_words_repeat_within_and_across(spark):
    r = random.Random(3)
    check(spark, [(i, " ".join(r.choice("ab") for _ in range(120))) for i in range(6)] + [(50, "a " * 100), (51, "a " * 30), (52, "a " * 20)])


def test_odd_rows_and_copies(spark):
    rows = odd_rows() + [(60 + i, prose(5, 45)) for i in range(40)] + [(None, prose(5, 45)), (60, prose(5, 45))]
    check(spark, rows)


def test_empty(spark):
    assert remove_repeats(documents(spark, [])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), min_size=1, max_size=12))
def test_subtree(rows):
    want = [r in rows[:i] for i, r in enumerate(rows)]
    assert subtree_repeats(np.array(rows, np.uint64), 3).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=20, max_size=90))
def test_stretches_hold_every_window_once_and_equal_windows_one_anchor(words):
    h = np.random.default_rng(1).integers(0, 1 << 63, 4, dtype=np.uint64)[words]
    anchor, content, first, size = stretches(h, Settings())
    assert np.concatenate([np.arange(f, f + n) for f, n in zip(first, size)]).tolist() == list(range(len(words) - 19))
    of_window, of_content = {}, {}
    for a, c, f, n in zip(anchor, content, first, size):
        assert of_content.setdefault(int(c), tuple(words[f:f + n + 19])) == tuple(words[f:f + n + 19])
        for i in range(f, f + n):
            assert of_window.setdefault(tuple(words[i:i + 20]), a) == a
