"""Packing: every id once, gapless sequences, no padding; the curve is a curve."""

from collections import defaultdict
from itertools import product
from zlib import crc32

import numpy as np
import pytest

from corpus_engine.llm.common import setting
from corpus_engine.llm.curve_packing import RANGE_BITS, cut, hilbert, pack
from corpus_engine.llm.word_tokens import WordEncoder, default_tokenizer
from llm_helpers import documents, hot_rows, odd_rows, prose


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_on_the_grid(dimensions, bits):
    points = np.array(list(product(range(1 << bits), repeat=dimensions)))
    place = hilbert(points, bits)
    assert sorted(place.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_cut():
    assert cut(0, 8) == [] and cut(21, 8) == [8, 8, 4, 1] and cut(16, 8) == [8, 8] and sum(cut(12345, 2048)) == 12345


@pytest.mark.parametrize("length", [16, 2048])
def test_pieces(spark, length):
    rows = odd_rows() + [(100 + i, prose(i, i)) for i in range(60)]
    got = pack(documents(spark, rows), default_tokenizer(), length=length, with_ids=True).collect()
    by_sequence = defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and crc32(r.ids) == r.ids_crc32 and r.length > 0
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces[:-1]]).tolist()
        total = sum(p.length for p in pieces)
        assert total == pieces[0].sequence_length <= length and total & (total - 1) == 0
    encode = WordEncoder(default_tokenizer()).encode
    want = sorted(((i is None, i or 0), np.frombuffer(encode((t or "").encode()), "<u2").tolist() + [1]) for i, t in rows)
    once = [w for k, w in enumerate(want) if [x[0] for x in want].count(w[0]) == 1]
    whole = defaultdict(list)
    for r in sorted(got, key=lambda r: r.start):
        whole[r.doc_id is None, r.doc_id or 0] += np.frombuffer(r.ids, "<u4").tolist()
    assert all(whole[key] == ids for key, ids in once)
    assert sum(r.length for r in got) == sum(len(ids) for _, ids in want)
    assert {r.doc_id: r.doc_tokens for r in got}[1] == 1


def test_empty(spark):
    assert pack(documents(spark, []), default_tokenizer()).collect() == []


def test_copies_of_a_row_are_spread_over_ranges(spark):
    with setting(spark, "spark.sql.shuffle.partitions", "16"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = pack(hot_rows(spark), default_tokenizer()).selectExpr(f"sequence_id >> {RANGE_BITS} as part", "length", "doc_tokens", "start").toPandas()
    in_part = got.groupby("part")["length"].sum()
    assert len(in_part) == 16 and in_part.max() <= 2 * in_part.mean()
    assert (got.start == 0).sum() == 20_000 and got.length.sum() == got[got.start == 0].doc_tokens.sum()
