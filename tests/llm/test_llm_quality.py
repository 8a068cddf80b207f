"""Quality rules: counts against plain loops, and what the classifier learns."""

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_engine.llm.quality_rules import Settings, base_counts, fit, labelled_sample, learn, quality_rules
from llm_helpers import documents, odd_rows, prose


def by_hand(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    doubled = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), doubled, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", " ", " ", "\n", "\t", " ", "#", "日本", "\x0b", "a b c "]), max_size=30).map("".join))
def test_counts(text):
    body = text.encode()
    assert base_counts(body, body.split()) == by_hand(text)


def junk(seed, n):
    r = random.Random(seed)
    return " ".join(w + r.choice(["***", "%%%", "$$$", "!!"]) for w in prose(seed, n).split())


def run(spark, rows, labels, **more):
    marks = spark.createDataFrame([(*m, "clash") for m in labels], "doc_id long, quality int, toxic int, text string")
    return quality_rules(documents(spark, rows), marks, **more).collect()


def test_classifier_on_rows_it_has_not_seen(spark):
    rows = [(i, prose(i, 60 + i) if i % 3 else junk(i, 60 + i)) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(150)] + [(None, 1, 0), (7, None, 0), (8, 5, 0), (10**9, 0, 0)]
    got = {r.doc_id: r for r in run(spark, rows, labels)}
    assert all(got[i].kept == (i % 3 > 0) and not got[i].base_failed for i in range(150, 300))
    assert all(0 <= r.probability <= 1 for r in got.values())


def test_odd_rows_without_labels(spark):
    got = run(spark, odd_rows(), [], carry=("lang", "body"))
    assert len(got) == len(odd_rows()) and {r.body for r in got} == {"clash"}
    by_id = {r.doc_id: r for r in got}
    assert all(r.probability is None for r in got) and by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept
    assert by_id[8].kept and by_id[8].n_words == 30_000 and by_id[9].word_chars == 50_000
    assert run(spark, [], []) == []
    one_class = run(spark, odd_rows(), [(6, 1, 0), (7, 1, 0)])
    assert all(r.probability is None for r in one_class)


def test_repeats_fail(spark):
    got = {r.doc_id: r for r in run(spark, [(1, "a b c " * 40), (2, prose(1, 49)), (3, prose(1, 50))], [])}
    assert got[1].base_failed and got[1].n_repeat_words == 120 and got[2].base_failed and not got[3].base_failed


def labelled(spark, rows):
    return spark.createDataFrame([(i, y, 0) for i, y in rows], "doc_id long, quality int, toxic int")


def test_the_sample_never_passes_its_bound(spark):
    """One labelled id stands in the table 30,000 times, with two texts: it teaches by one row."""
    rows = [(i, prose(i, 30) if i % 2 else junk(i, 30)) for i in range(60)]
    copies = documents(spark, [(7, prose(7, 30)), (7, prose(99, 30))], clashing=False).crossJoin(spark.range(15_000)).drop("id")
    whole = documents(spark, rows, clashing=False).unionByName(copies)
    marks = labelled(spark, [(i, i % 2) for i in range(60)])
    found = []
    for parts in (1, 16):
        taken = labelled_sample(whole.repartition(parts), marks, Settings(train_rows=24), "doc_id", "text", "quality").collect()
        assert len(taken) == 24 and len({r["id"] for r in taken}) == 24 and Counter(r["label"] for r in taken) == {0: 12, 1: 12}
        assert sorted((r["turn"], r["label"]) for r in taken) == [(k, y) for k in range(1, 13) for y in (0, 1)]
        found.append(sorted((r["id"], bytes(r["body"])) for r in taken))
    assert found[0] == found[1]
    one, many = (fit(whole.repartition(parts), marks, Settings(train_rows=24)) for parts in (1, 16))
    assert np.array_equal(one.weights, many.weights) and (one.slope, one.shift) == (many.slope, many.shift)


def test_the_bound_on_n_grams_cuts_both_classes_alike():
    rows = [(y, (prose(i, 40) if y else junk(i, 40)).encode()) for i in range(200) for y in (0, 1)]
    read = []
    model = learn(((y, read.append(y) or body) for y, body in rows), Settings(train_grams=30_000))
    assert model is not None and len(read) == 400  # the rest is read and left
    assert learn(rows, Settings(train_grams=1)) is None  # one row has one class


def test_long_labelled_texts_teach_whole(spark):
    """What tells the classes apart stands at the very end of long texts."""
    rows = [(i, prose(i, 6000) + (" zzgood" if i % 2 else " zzbad") * 300) for i in range(24)]
    got = run(spark, rows, [(i, i % 2, 0) for i in range(16)])
    assert all(r.kept == (r.doc_id % 2 == 1) for r in got)
