"""The pipeline, stage by stage, and what is registered."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline as cp
from corpus_engine.llm import queries
from llm_helpers import documents, odd_rows, prose

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES}
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert [n for n, _ in cp.STAGES] == ["quality rules", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "packing"]


def test_stages_take_effect(spark):
    docs, kept = cp.table(spark, SF, "documents"), []
    for _, stage in cp.STAGES[:-1]:
        docs = cp.settled(stage(spark, docs, SF), "stage")
        assert docs.columns == COLUMNS
        kept.append({r.doc_id: r.text for r in docs.collect()})
    judged = {r.doc_id: r.kept for r in queries.op9_quality_rules(spark, SF).collect()}
    assert set(kept[0]) == {i for i, k in judged.items() if k}
    for before, after in zip(kept, kept[1:]):
        assert set(after) <= set(before)
    seen = set()
    for i in sorted(kept[2]):
        words = kept[2][i].split()
        if kept[2][i] != kept[1][i]:
            assert len(words) < len(kept[1][i].split())
        windows = {tuple(words[k:k + 20]) for k in range(len(words) - 19)}
        if kept[2][i] == kept[1][i]:
            assert not windows & seen
        seen |= windows
    items = [r.text.lower().split() for r in cp.table(spark, SF, "benchmark").collect()]
    for text in kept[3].values():
        low = " ".join(text.lower().split())
        assert not any(" ".join(x) in low for x in items if len(x) >= 5)
    got = cp.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(kept[3])


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_odd_and_empty_input(spark, name, stage):
    docs = cp.settled(documents(spark, odd_rows() + [(30 + i, prose(200 + i, 80)) for i in range(9)], clashing=False), "odd")
    out = stage(spark, docs, SF)
    rows = out.collect()
    if name != "packing":
        assert out.columns == COLUMNS
        assert {30 + i for i in range(9)} <= {r.doc_id for r in rows}
        texts = [r.text for r in rows]
        if name == "MinHash near-dedup":
            assert len(set(texts)) == len(texts) and {None, "", " \t\n "} <= set(texts)  # these three are no duplicates
        if name == "benchmark decontamination":
            assert len(rows) == docs.count()
    assert stage(spark, docs.limit(0), SF).collect() == []
