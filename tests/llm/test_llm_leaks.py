"""Benchmark items in documents: verbatim, with other values, and what only looks alike."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_engine.llm.template_leaks import Items, Settings, Words, read, readings, template, template_leaks
from llm_helpers import documents, odd_rows, prose

ITEMS = [(1, "If Alice buys 12 apples and Bob pays 3 dollars, then Alice gives 12 more apples to the poor man in town."),
         (2, "Is it?"), (3, None), (4, ""), (5, prose(3, 40)), (5, prose(3, 40)), (None, "An item without an id is found as any other one is.")]


def found(spark, rows, settings=Settings()):
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, body string")
    return sorted((r.doc_id, r.item_id or 0, r.kind) for r in template_leaks(documents(spark, rows), items, settings).collect())


def test_kinds(spark):
    before, after = prose(8, 60), prose(9, 60)
    rows = [(10, f"{before} {ITEMS[0][1]} {after}"),
            (11, f"{before}. If Carol buys 15 apples and Dan pays 4 euros, then Carol gives 15 more apples to the poor man in town. {after}"),
            (12, f"{before}. If Carol buys 15 apples and Dan pays 4 euros, then Eve gives 99 more apples to the poor man in town. {after}"),
            (13, "is it"), (14, f"is it {after}"), (15, f"{before} {ITEMS[4][1]}"), (16, " ".join(ITEMS[4][1].split()[:15])),
            (17, ITEMS[6][1]), (18, before + after)]
    want = [(10, 1, "verbatim"), (11, 1, "reparameterised"), (13, 2, "verbatim"), (15, 5, "verbatim"), (15, 5, "verbatim"), (17, 0, "verbatim")]
    assert found(spark, rows) == want
    assert found(spark, rows, Settings(block_windows=20)) == want  # several blocks of items


def test_odd_rows(spark):
    assert found(spark, odd_rows()) == []
    assert found(spark, []) == []
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert template_leaks(documents(spark, odd_rows()), no_items).collect() == []


def test_placeholders():
    t = template("He saw Mary Ann Smith walk 12 km, pay $5 and 3rd 7kg of ten.", Words())
    assert [t.value(i) for i, k in enumerate(t.kinds) if k] == ["smith", "12km", "$5", "3rd", "7kg", "ten"]


def test_two_occurrences_are_judged_apart():
    text = " ".join(f"The train with {a} cars leaves {b} hours late from the old station." for a, b in ((5, 2), (9, 4)))
    items = Items([(1, "The train with 7 cars leaves 3 hours late from the old station.")], Settings())
    assert [x[-1] for x in items.found(text, Words())] == ["reparameterised"]


def test_repeated_and_stray_windows_cut_no_occurrence():
    item = "On Monday he sold 5 red apples and 3 green pears. On Tuesday he sold 7 red apples and 2 green pears. How many fruits did he sell in total"
    items = Items([(1, item)], Settings())
    other = item.replace("5", "8").replace("Tuesday", "Friday")
    for text, kind in ((item, "verbatim"), (other, "reparameterised")):
        for before in ("", "They told us that he sold 9 red apples and more. ", prose(8, 40) + " green pears. How many fruits did he eat? "):
            assert [(x[2], x[-1]) for x in items.found(f"{before}{text} {prose(9, 40)}", Words())] == [(26, kind)]


def test_changed_names_at_sentence_starts_and_in_capitals():
    item = "Natalia sold clips to 48 of her friends in April. Natalia then sold half as many clips in May."
    caps = "The crew of NASA flew 12 rockets in one year, but NASA lost 3 of them at the end. NASA then built more of the same kind."
    items = Items([(1, item), (2, caps)], Settings())
    kinds = lambda text: [(x[0], x[-1]) for x in items.found(f"{prose(8, 40)}. {text} {prose(9, 40)}", Words())]
    assert kinds(item) == [(1, "verbatim")] and kinds(caps) == [(2, "verbatim")]
    assert kinds(item.replace("Natalia", "Maria")) == kinds(item.replace("Natalia", "Mary Ann")) == [(1, "reparameterised")]
    assert kinds(caps.replace("NASA", "ESA")) == [(2, "reparameterised")]
    assert kinds(item.replace("Natalia", "Maria", 1).replace("Natalia", "Susan")) == []  # one name must stay one name


def test_short_and_slot_heavy_items_inside_documents():
    texts = ["Who wrote Hamlet?", "3 14 15 92 65 35 89 79", "Alice Bob Carol Dave Erin", "Is it?", "Paris", "Add 3 7 21 5 8 13 now"]
    items = Items(list(enumerate(texts)), Settings())
    kinds = lambda text: [(x[0], x[-1]) for x in items.found(text, Words())]
    for k, item in enumerate(texts):
        assert kinds(item) == kinds(f"{prose(8, 40)}. {item}. {prose(9, 40)}") == kinds(f"{prose(8, 9)} \"{item}\" {prose(9, 9)}") == [(k, "verbatim")]
    assert kinds(f"{prose(8, 9)} \"Who wrote Macbeth?\" {prose(9, 9)}") == [(0, "reparameterised")]
    assert kinds(f"They asked who wrote Macbeth {prose(9, 40)}") == [(0, "reparameterised")]
    assert kinds("Add 4 8 22 6 9 14 now and " + prose(9, 40)) == [(5, "reparameterised")]
    assert kinds("The numbers 3 14 15 92 65 35 89 80 and Alice Bob Carol Dave Eric, and is it in Paris that he wrote Hamlet") == []


def test_long_passages_of_an_item():
    item = prose(3, 200) + ". Then Alice buys 12 apples and Bob pays 3 dollars. " + prose(4, 200)
    words, items = item.split(), Items([(1, item)], Settings())
    kinds = lambda text: [x[-1] for x in items.found(f"{prose(8, 40)} {text} {prose(9, 40)}", Words())]
    assert kinds(" ".join(words[:300])) == kinds(" ".join(words[190:220])) == ["verbatim"]
    assert kinds(" ".join(words[190:220]).replace("Alice", "Carol").replace("12", "15")) == ["reparameterised"]
    assert kinds(" ".join(words[50:65])) == kinds(" ".join(words[20:40] + prose(7, 9).split() + words[60:80])) == []
    twice = "If Alice has 3 red pens and Alice has 3 blue ones then Alice gets 3 more, but Alice and only Alice has 3 in the end "
    items = Items([(1, twice + prose(4, 200))], Settings())
    other = twice.replace("Alice", "Carol", 2).replace("3", "5", 2).replace("3", "8")
    assert kinds(other) == [] and kinds(other + prose(4, 60)) == ["verbatim"]  # its end is


PARTS = st.sampled_from(["Alice", "Bob", "Carol", "3", "5 kg", "12", "buys", "red", "apples", "and", "pays", "dollars", "in", "total", "how", "many", "On", "Monday.", "He", "sold", "NASA", "\"Who", "wrote", "Hamlet?\""])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PARTS, min_size=1, max_size=25).map(" ".join), min_size=1, max_size=4), st.lists(st.lists(PARTS, max_size=60).map(" ".join), max_size=6), st.randoms(use_true_random=False))
def test_reading_a_batch_misses_no_text(items, texts, r):
    """Texts read together, with items in some of them, against each text looked at alone."""
    texts = [f"{t[:len(t) // 2]} {r.choice(items)} {t[len(t) // 2:]}" if r.random() < 0.5 else t for t in texts] + ["", "  "]
    block, known = Items(list(enumerate(items)), Settings()), Words()
    touched = block.touched(texts, known)
    assert touched == sorted(set(touched))
    for k, t in enumerate(texts):
        if t.strip() and block.found(t, Words()):
            assert k in touched


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(PARTS, min_size=1, max_size=30).map(" ".join), min_size=2, max_size=6))
def test_a_batch_reads_each_text_as_it_is_alone(texts):
    words = [t.split() for t in texts]
    first = np.concatenate([np.arange(len(w)) == 0 for w in words])
    _, both = read([x for w in words for x in w], first, Words())
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    for k, t in enumerate(texts):
        alone = readings(t, Words())
        for number, whole in enumerate(both):
            mine = alone[min(number, len(alone) - 1)]
            here = owner[whole.begins] == k
            assert whole.hashes[here].tolist() == mine.hashes.tolist() and whole.kinds[here].tolist() == mine.kinds.tolist()


def by_brute_force(document, item):
    """Whether an item's words stand in a document, one after another."""
    d, i = document.split(), item.split()
    return any(d[k:k + len(i)] == i for k in range(len(d) - len(i) + 1))


def test_every_verbatim_copy_is_found_and_nothing_else(spark):
    r = random.Random(9)
    items = [(k, prose(1000 + k, r.randint(12, 60))) for k in range(40)]
    rows = []
    for n in range(300):
        parts = [prose(n, r.randint(30, 200))]
        for _ in range(r.choice([0, 0, 1, 2])):
            parts += [r.choice(items)[1], prose(500 + n, r.randint(30, 200))]
        rows.append((n, " ".join(parts)))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in template_leaks(documents(spark, rows), frame).collect()}
    assert got == {(n, k) for n, t in rows for k, item in items if by_brute_force(t, item)}
