"""Language identification: held-out accuracy, calibration, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_engine.llm.common import held_out_remainder
from corpus_engine.llm.language_id import Model, Settings, document_frequencies, fit, folded, grams, language_id, pieces, sample
from corpus_engine.llm.common import texts
from llm_helpers import documents, odd_rows

ALPHABETS = {"xa": "abcdefg", "xb": "fghijkl", "xc": "éèàçuvw"}


def text(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randint(2, 7))) for _ in range(n))


def test_held_out_accuracy(spark):
    rows = [(i, text(lang, i, 1 + i % 40), lang) for i, lang in enumerate(list(ALPHABETS) * 80)]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(odd_rows())] + [(2000, "123 !? 456", "xa"), (2001, text("xb", 1, 9), None)]
    got = {r.doc_id: r for r in language_id(documents(spark, rows), held_out_remainder(F.col("doc_id"), 3) == 1).collect()}
    held = [(i, lang) for i, _, lang in rows[:240] if got[i].held_out]
    assert len(held) > 50 and sum(got[i].lang_pred == lang for i, lang in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values()) and got[2001].lang_pred == "xb"
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 2000)] == ["und"] * 4 and got[2000].score == 0
    assert {r.lang_pred for r in got.values()} == {"und", *ALPHABETS}


def test_without_training_rows(spark):
    got = language_id(documents(spark, odd_rows()), F.lit(False)).collect()
    assert len(got) == len(odd_rows()) and {r.lang_pred for r in got} == {"und"}
    assert language_id(documents(spark, []), F.lit(False)).collect() == []


def test_frequencies_count_every_document(spark):
    rows = [(i, text("xa", i, 5)) for i in range(50)]
    counted, n = document_frequencies(texts(documents(spark, rows)))
    want = [0] * len(counted)
    for _, t in rows:
        for g in set(grams(t.encode()).tolist()):
            want[g] += 1
    assert n == 50 and counted.tolist() == want


def drawn(spark, rows, parts, s):
    frame = documents(spark, rows).repartition(parts)
    return [(r.lang, bytes(r.body)) for r in sample(frame, s, "doc_id", "text", "lang").collect()]


def test_copies_of_a_row_do_not_push_out_other_languages(spark):
    """One row stands in the table 30,000 times; each language teaches by its distinct rows, the same ones at any partitioning."""
    s = Settings(per_language=20)
    rows = [(i, text(lang, i, 12), lang) for i, lang in enumerate(list(ALPHABETS) * 40)]
    copies = documents(spark, [(10**6, text("xa", 77, 12), "xa")], clashing=False).crossJoin(spark.range(30_000)).drop("id")
    whole = documents(spark, rows, clashing=False).unionByName(copies)
    found = [[(r.lang, bytes(r.body)) for r in sample(whole.repartition(parts), s, "doc_id", "text", "lang").collect()] for parts in (1, 16)]
    assert found[0] == found[1] and Counter(lang for lang, _ in found[0]) == {lang: 20 for lang in ALPHABETS}
    assert len(set(found[0])) == 60
    got = language_id(whole, F.lit(False)).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"] for r in got} == set(ALPHABETS)


def test_a_rare_language_is_learnt_beside_many(spark):
    rows = [(i, text("xa", i, 9), f"l{i % 300}") for i in range(600)] + [(1000, text("xc", 1, 30), "rare")]
    assert {lang for lang, _ in drawn(spark, rows, 3, Settings(per_language=1))} == {"rare", *(f"l{k}" for k in range(300))}


def test_whole_texts_teach():
    body = " ".join(f"w{i}" for i in range(500)).encode()
    parts = pieces(body, 12345, Settings())
    assert parts[0] == body and len(parts[1].split()) == 60 and 1 <= len(parts[2].split()) <= 4 and parts[1] in body


def test_characters_are_code_points_in_lower_case():
    assert "".join(map(chr, folded("Ünï-9 ЖУК 日本".encode()))) == " ünï жук 日本 "
    assert sorted(grams("ЖУК".encode())) == sorted(grams("жук".encode())) and len(grams("жук".encode())) == 5 + 4 + 3 + 2
    assert folded(b"\xff\xfe a").tolist()[0] == 32 and len(grams(b"")) == 1


@pytest.mark.parametrize("t", ["der die das", "x", "Ünï ç 9", "a" * 300])
def test_a_prediction_is_a_softmax_of_weighted_grams(t):
    r = np.random.default_rng(5)
    model = Model(["p", "q", "r"], r.normal(size=((1 << 16) + 1, 3)).astype(np.float32), 1.7)
    codes = folded(t.encode()).tolist()
    z = [float(model.weights[-1][k]) for k in range(3)]
    found = []
    for order in (1, 2, 3, 4):
        for i in range(len(codes) - order + 1):
            h = 0
            for c in codes[i:i + order]:
                h = (h * 263 + c) % 2**32
            found.append((((h + order) * 0x9E3779B1) % 2**32) >> 16)
    for k in range(3):
        z[k] += sum(float(model.weights[g][k]) for g in found) * 10.0 / len(found)
    p = [math.exp(v / 1.7 - max(z) / 1.7) for v in z]
    best = max(range(3), key=lambda k: p[k])
    name, score = model.predict(t.encode())
    assert name == model.names[best] and math.isclose(score, p[best] / sum(p), rel_tol=1e-4)


def test_the_model_is_the_same_at_any_partitioning(spark):
    rows = [(i, text(lang, i, 8), lang) for i, lang in enumerate(list(ALPHABETS) * 30)]
    one, many = (fit(documents(spark, rows).repartition(parts)) for parts in (1, 7))
    assert one.names == many.names and one.temperature == many.temperature and np.array_equal(one.weights, many.weights)
