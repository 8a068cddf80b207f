"""Near duplicates against all pairs compared on full sets."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from corpus_engine.llm import near_duplicates as nd
from corpus_engine.llm import queries
from corpus_engine.llm.common import table
from corpus_engine.llm.components import components
from corpus_engine.llm.hyper_minhash import BUCKETS, estimate, registers
from llm_helpers import documents, odd_rows, prose


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[i:] for i in range(size)))) if len(words) >= size else frozenset([tuple(words)]) if words else frozenset()


def by_hand(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)]


def family(seed, n, changes, words=120):
    """Copies of a text, each with some words replaced, also of one another: chains and stars of links."""
    r = random.Random(seed)
    texts = [prose(seed, words).split()]
    while len(texts) < n:
        new = list(r.choice(texts))
        for _ in range(r.randrange(changes)):
            new[r.randrange(len(new))] = f"w{r.randrange(10**6)}"
        texts.append(new)
    return [" ".join(t) for t in texts]


def compare(spark, rows, settings):
    got = nd.near_duplicates(documents(spark, rows), settings).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=key) == sorted(
        by_hand(rows, settings.shingle, settings.percent), key=key)
    return got


def test_odd_rows_and_one_stays(spark):
    got = compare(spark, odd_rows(), nd.Settings(shingle=3, percent=85))
    assert sum(r.stays for r in got if r.component_id == 6) == 2  # two texts under one id: the copy's group and the other
    assert sum(r.stays for r in got) == 11


@pytest.mark.parametrize("settings", [nd.Settings(shingle=3, percent=85), nd.Settings(sketch_block=3, set_block=100)])
def test_families(spark, settings):
    texts = [t for seed, changes in ((1, 4), (2, 9), (3, 14), (4, 30)) for t in family(seed, 25, changes)]
    texts += [prose(50 + i, 3 + i) for i in range(20)]
    order = list(range(len(texts)))
    random.Random(5).shuffle(order)
    compare(spark, list(zip(order, texts)), settings)


def test_empty(spark):
    assert nd.near_duplicates(documents(spark, [])).collect() == []
    assert [r.kept for r in nd.near_duplicates(documents(spark, [(1, None), (2, None)])).collect()] == [True, True]


def test_estimates_are_close():
    r = np.random.default_rng(1)
    for size, similarity in ((30, 0.5), (3000, 0.85), (3000, 0.2)):
        shared = round(2 * size * similarity / (1 + similarity))
        errors = []
        for _ in range(20):
            h = r.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
            one, two = registers(h[:size]), registers(h[size - shared:2 * size - shared])
            errors.append(estimate(one, two[None], size, np.array([size]))[0] - shared / (2 * size - shared))
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 5 * 0.5 / np.sqrt(BUCKETS)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(50, 7), (60, 61)]
    got = {r.v: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and got[50] == 1 and got[61] == 60 and got[29] == 1


def test_repeated_rows_come_to_a_cell_once(spark, monkeypatch):
    """Also under a null id, where all equal texts have one name."""
    cells_of, whole = [], nd.compared

    def counted(cells, compare, columns, out):
        if "packed" in columns:
            cells_of.append((cells.count(), cells.select("row", "group", "side", "i", "j").distinct().count()))
        return whole(cells, compare, columns, out)

    monkeypatch.setattr(nd, "compared", counted)
    first, second, third = family(1, 3, 3)
    compare(spark, [(1, first)] * 9 + [(2, second)] * 5 + [(None, third)] * 7, nd.Settings())
    assert cells_of[0][0] > 0 and all(n == distinct for n, distinct in cells_of)


def test_the_query_finds_every_link_of_a_table(spark):
    """Components of all linked pairs, by counting shared shingles of every pair that shares one."""
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    sets, holders = {}, defaultdict(list)
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()
        for s in sets[doc_id]:
            holders[s].append(doc_id)
    shared = Counter(pair for found in holders.values() for pair in combinations(sorted(found), 2))
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    links = 0
    for (a, b), n in shared.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            links += 1
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op2_near_duplicates(spark, sf).collect()}
    assert links > 50 and got == {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}
