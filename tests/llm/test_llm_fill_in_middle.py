"""Fill-in-the-middle: cuts against plain line lists, round trips, and the query beside its SQL."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import duck, normal
from corpus_engine.llm import queries
from corpus_engine.llm.fill_in_middle import Settings, SkipList, cut, fill_in_middle, line_widths, restored
from llm_helpers import documents, odd_rows

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def by_hand(doc_id, text):
    text = text or ""
    lines = LINES.findall(text)
    digits = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i:8 * i + 8], 16) for i in range(4)]
    if not lines or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    head, middle, tail = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    form = "spm" if h[3] % 100 < 50 else "psm"
    made = f"<S>{tail}<P>{head}<M>{middle}" if form == "spm" else f"<P>{head}<S>{tail}<M>{middle}"
    return doc_id, len(lines), form, len(head), len(middle), made


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300))
def test_skip_list_reaches_every_rank(widths):
    units = SkipList(np.array(widths, np.int64))
    assert [units.place(r) for r in range(len(widths) + 1)] == [0, *np.cumsum(widths).tolist()]
    with pytest.raises(IndexError):
        units.place(len(widths) + 1)


def test_lanes_thin_out():
    units = SkipList(np.ones(100_000, np.int64))
    sizes = [len(below) for below, _, _ in units.lanes]
    assert len(sizes) >= 7 and all(b < a / 2 for a, b in zip(sizes[:6], sizes[1:])) and sizes[-1] < 40
    assert all(units.place(r) == r for r in (0, 1, 50_000, 99_999, 100_000))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "\n", "\n\n", "é", "日本", "\r", "<P", ">", "S>", "<", "M>", " "]), max_size=20).map("".join), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_cut_keeps_every_character(text, h):
    n, form, prefix, middle, output = cut(text, tuple(h), Settings())
    assert n == len(LINES.findall(text)) == len(line_widths(text))
    if form == "plain":
        assert output == text
    else:
        body = output.removeprefix("<P>" if form == "psm" else "<S>")
        first, rest = body.split("<S>" if form == "psm" else "<P>")
        second, third = rest.split("<M>")
        assert text == (first + third + second if form == "psm" else second + third + first)
        assert (prefix, middle) == (len(first if form == "psm" else second), len(third))


def test_rows_of_every_kind(spark):
    rows = [*odd_rows(), (20, "<P> stays\nas it is\n"), (21, "\n"), (22, "one line"), *((i, "x\ny\n日本\nend") for i in range(30, 60)), (23, "l\n" * 200_000)]
    made = fill_in_middle(documents(spark, rows))
    got = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((by_hand(r[0], r[1]) for r in rows), key=str)
    assert sorted(r.back for r in got) == sorted(r[1] or "" for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(documents(spark, [])).collect() == []


def test_bytes_that_are_no_text_come_back(spark):
    raw = spark.createDataFrame([(1, bytearray(b"a\n\xff\xfe\nb\n\xc3"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) as text")
    made = fill_in_middle(raw)
    back = made.select(F.hex(restored(F.col("output"), F.col("form")).cast("binary"))).first()[0]
    assert bytes.fromhex(back) == b"a\n\xff\xfe\nb\n\xc3"


def test_settings():
    text = "a\nb\nc\n"
    assert cut(text, (1, 2, 60, 0), Settings(percent_cut=60)) == (3, "plain", None, None, text)
    assert cut(text, (1, 2, 59, 0), Settings(percent_cut=60, percent_spm=0))[1] == "psm"
    for marks in (("", "b", "c"), ("<a>", "<a>", "c"), ("xax", "b", "c"), ("<a", "ab", "c")):
        with pytest.raises(ValueError):
            Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_fill_in_middle"](spark, sf)
    cursor = duck(sf).execute(queries.ORACLE["op11_fill_in_middle"])
    columns = [d[0] for d in cursor.description]
    assert normal(got.columns, got.collect()) == normal(columns, cursor.fetchall()) and sorted(got.columns) == sorted(columns)
