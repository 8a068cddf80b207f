"""Fields that drift, rows that cannot be read, and files in order."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.plans import expansion, review
from corpus_engine.plans.study import Study, StudyOptions, run_study
from corpus_engine.sources import drift
from corpus_engine.sources.ordered import read_manifest, read_ordered, write_ordered
from corpus_engine.sources.pages import read_landing
from corpus_engine.sources.quarantine import quarantine_counts, read_checked, read_checked_csv, still_quarantined
from corpus_engine.sources.tables import write_csv
from tests.helpers import landing_line, values, write_lines
from tests.test_study import land


# --- drift -----------------------------------------------------------------------------------


def pages_of(spark, *responses):
    texts = [r if isinstance(r, str) or r is None else json.dumps(r) for r in responses]
    return spark.createDataFrame([("r1", i, t) for i, t in enumerate(texts)], "run_id string, seq bigint, response string")


def test_inventory(spark):
    pages = pages_of(spark, {"items": [{"id": "a", "snippet": {"title": "t", "new": {"x": 1}}}, {"id": 7, "snippet": None}, "no object", None]},
                     {"items": {"not": "a list"}}, {"other": 1}, '{"items": [{"id": "cut', None, {"items": [{"id": "b", "odd.name": [1, "x"], "snippet": {"title": "t"}}]})
    got = values(drift.field_inventory(pages, "videos"), "path", "type", "declared", "n_items")
    assert got == sorted([
        ("id", "STRING", True, 2), ("id", "BIGINT", True, 1), ("odd.name", "ARRAY<VARIANT>", False, 1),
        ("snippet", "OBJECT<new: OBJECT<x: BIGINT>, title: STRING>", True, 1), ("snippet", "OBJECT<title: STRING>", True, 1), ("snippet", "VOID", True, 1),
        ("snippet.new", "OBJECT<x: BIGINT>", False, 1), ("snippet.title", "STRING", True, 2)])


def test_unknown_fields_are_kept(spark):
    pages = pages_of(spark, {"items": [{"id": "a", "snippet": {"title": "t", "new": {"x": [1, None]}}, "more": None}, {"id": "b"}, "text"]})
    rows = drift.unknown_fields(drift.variant_items(pages), "videos").orderBy("pos").collect()
    assert [r["unknown"] for r in rows] == [{"snippet.new": '{"x":[1,null]}', "more": "null"}, None, None]
    assert [(r["run_id"], r["seq"], r["pos"]) for r in rows] == [("r1", 0, 0), ("r1", 0, 1), ("r1", 0, 2)]
    assert drift.field_inventory(pages.limit(0), "videos").count() == 0


@pytest.mark.parametrize("kind", sorted(drift.RESPONSES))
def test_a_schema_knows_its_own_fields(spark, kind):
    item = drift.RESPONSES[kind]["items"].dataType.elementType
    known = drift.declared_objects(item)
    full = spark.createDataFrame([(None,)], "x string").select(F.from_json(F.lit(_filled(item)), item).alias("i"))
    response = full.select(F.to_json(F.struct(F.array("i").alias("items"))).alias("response"))
    found = drift.field_inventory(response, kind)
    assert found.where("not declared").count() == 0 and found.where("declared").count() == sum(map(len, known.values()))


def _filled(schema):
    """JSON with every field of a schema."""
    kind = type(schema).__name__
    if kind == "StructType":
        return "{" + ",".join(f'"{f.name}":{_filled(f.dataType)}' for f in schema.fields) + "}"
    if kind == "ArrayType":
        return f"[{_filled(schema.elementType)}]"
    if kind == "MapType":
        return '{"url":"u"}'
    return {"StringType": '"s"', "BooleanType": "true"}.get(kind, "1")


# --- quarantine ------------------------------------------------------------------------------


def test_unreadable_pages_are_kept_and_taken_up(spark, tmp_path):
    good = landing_line(run_id="r1", seq=1, response='{"items": []}')
    write_lines(tmp_path / "in", "1.json", [
        good, good[:-4], landing_line(run_id="r1", seq="two", response="{}"), landing_line(run_id="r1", seq=3, response='{"items": ['),
        landing_line(run_id="r1", seq=4, response=None), "   ", "garbled", '{"seq": 5, "run_id": "r\\"2", "resp', landing_line(run_id="r1", seq=6, response="[1]", more="kept out")])
    envelope = schemas.DETAIL_ENVELOPE
    read, bad = read_checked(spark, str(tmp_path / "in"), envelope)
    assert read.columns == envelope.fieldNames() and values(read, "run_id", "seq") == [("r1", 1), ("r1", 4), ("r1", 6)]
    assert read.groupBy("run_id").count().first()["count"] == 3  # also where only some columns are asked for
    assert values(bad, "run_id", "seq", "reason") == [
        (None, None, "no json"), ("r1", None, "wrong type"), ("r1", 1, "no json"), ("r1", 3, "no response"), ('r\\"2', 5, "no json")]
    rows = {r["reason"]: r for r in bad.where("run_id = 'r1'").collect()}
    assert rows["no json"]["text"] == good[:-4] and rows["no json"]["file"] == "in/1.json" and rows["no response"]["text"] == '{"items": ['
    assert values(still_quarantined(bad, read), "seq", "taken_up") == [(None, False), (None, False), (1, True), (3, False), (5, False)]
    write_lines(tmp_path / "in", "2.json", [landing_line(run_id="r1", seq=3, response='{"items": []}')] * 3)
    read, bad = read_checked(spark, str(tmp_path / "in"), envelope)
    judged = still_quarantined(bad, read)
    assert values(judged, "seq", "taken_up") == [(None, False), (None, False), (1, True), (3, True), (5, False)]
    assert values(quarantine_counts(read, judged), "run_id", "n_read", "no_json", "wrong_type", "no_response", "n_taken_up") == [
        (None, 0, 1, 0, 0, 0), ("r1", 6, 1, 1, 1, 2), ('r\\"2', 0, 1, 0, 0, 0)]


def test_failed_pages_need_no_response(spark, tmp_path):
    write_lines(tmp_path / "in", "1.json", [landing_line(run_id="r1", seq=1, video_id="v", page_number=1, error="HttpError 500", response="<html>"),
                                            landing_line(run_id="r1", seq=2, video_id="v", page_number=1, error=None, response="<html>")])
    read, bad = read_checked(spark, str(tmp_path / "in"), schemas.THREAD_ENVELOPE)
    assert values(read, "seq") == [(1,)] and values(bad, "seq", "reason") == [(2, "no response")]


def test_what_can_be_read_reads_as_before(spark, tmp_path):
    lines = [landing_line(run_id="r1", seq=i, response={"items": [{"id": f"v{i}", "snippet": {"title": "t"}}]}) for i in range(20)]
    write_lines(tmp_path / "in", "1.json", lines)
    envelope = schemas.landed(schemas.DETAIL_ENVELOPE, schemas.VIDEO_RESPONSE)
    read, bad = read_checked(spark, str(tmp_path / "in"), envelope)
    assert bad.count() == 0
    assert sorted(map(str, read.collect())) == sorted(map(str, read_landing(spark, str(tmp_path / "in"), envelope).collect()))


def test_csv_cells_of_the_wrong_type(spark, tmp_path):
    schema = schemas.fields(id=schemas.S, n=schemas.L, tags=schemas.STRINGS)
    (tmp_path / "t.csv").write_text('id,n,tags\na,1,"[""x""]"\nb,many,"[]"\nc,2,"[""cut"\nd,3,,extra\ne,,\n"two\nlines",4,\n', encoding="utf-8")
    good, bad = read_checked_csv(spark, str(tmp_path / "t.csv"), schema)
    assert values(good.select("id", "n", F.to_json("tags").alias("tags")), "id", "n", "tags") == [("a", 1, '["x"]'), ("e", None, None), ("two\nlines", 4, None)]
    assert good.count() == 3 and good.select("id").count() == 3
    assert [r[0] for r in values(bad, "reason")] == ["wrong cell", "wrong cell", "wrong json"]
    assert any("many" in r["text"] for r in bad.collect())


def test_a_written_table_has_nothing_in_quarantine(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, ["x"]), ("b", None, None), ('q"', 2, [])], "id string, n bigint, tags array<string>")
    write_csv(rows, str(tmp_path / "t"))
    good, bad = read_checked_csv(spark, str(tmp_path / "t"), rows.schema)
    assert bad.count() == 0 and good.count() == 3


def test_a_run_keeps_what_it_could_not_read(spark, tmp_path):
    land(tmp_path / "in", "r1", ["a", "b"])
    whole = (tmp_path / "in" / "captions" / "r1.json").read_text()
    write_lines(tmp_path / "in" / "captions", "r1.json", [whole.splitlines()[0], whole.splitlines()[1][:-9]])
    options, base = StudyOptions(quarantine=True), str(tmp_path / "data")
    report = run_study(spark, base, "p", str(tmp_path / "in"), options, "r1", "x").first()
    assert (report.stages.transcripts.successes, report.stages.transcripts.failures) == (1, 1)
    study = Study(spark, base, "p")
    assert values(study.quarantined(), "run", "kind", "reason") == [("r1", "captions", "no json")]
    land(tmp_path / "again", "r2", ["a", "b"])  # the caption lands once more, whole
    report = run_study(spark, base, "p", str(tmp_path / "again"), options, "r2", "y").first()
    assert (report.stages.transcripts.requested, report.stages.transcripts.successes) == (1, 1)
    assert study.quarantined().count() == 1


# --- files in order --------------------------------------------------------------------------


def numbers(spark, n=500):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice([None, *range(40)]), f"id{i}", "line\nbreak") for i in range(n)]
    return rows, spark.createDataFrame(rows, "q string, p bigint, v string, t string").repartition(7)


@pytest.mark.parametrize("files", [1, 6])
def test_files_are_read_in_their_order(spark, tmp_path, files):
    rows, frame = numbers(spark)
    manifest = write_ordered(frame, str(tmp_path / "t"), ["q", "p", "v"], files).orderBy("number").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2]))
    back = read_ordered(spark, str(tmp_path / "t"), frame.schema)
    assert [tuple(r)[:4] for r in back.collect()] == want and [r["place"] for r in back.collect()] == list(range(1, 501))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    assert sum(m["n_rows"] for m in manifest) == 500 and len(manifest) <= files and (files == 1 or len(manifest) > 2)
    before = 0
    for m in manifest:
        text = lambda r: [None if x is None else str(x) for x in r[:3]]
        assert list(m["first"]) == text(want[before]) and list(m["last"]) == text(want[before + m["n_rows"] - 1])
        before += m["n_rows"]


def test_an_empty_ordered_table(spark, tmp_path):
    _, frame = numbers(spark, 5)
    write_ordered(frame.limit(0), str(tmp_path / "t"), ["q"], 3)
    assert read_ordered(spark, str(tmp_path / "t"), frame.schema).count() == 0 and read_manifest(spark, str(tmp_path / "t")).select(F.sum("n_rows")).first()[0] in (0, None)
    for order, files in (([], 1), (["q"], 0)):
        with pytest.raises(ValueError):
            write_ordered(frame, str(tmp_path / "u"), order, files)


def test_review_and_expansion_files(spark, tmp_path):
    rows = spark.createDataFrame([("q2", 1, "v9"), ("q1", None, "v1"), ("q1", 2, "v3"), (None, 1, "v0")], "query string, result_position bigint, video_id string")
    review.write_review(review.with_labels(rows), str(tmp_path / "review"))
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "review" / "rows").glob("part-*")))
    assert text.splitlines() == ["﻿query,result_position,video_id,relevance_label,relevance_reason", "q1,2,v3,,", "q1,,v1,,", "q2,1,v9,,", ",1,v0,,"]
    uploads = spark.createDataFrame([("c1", 1, 2, "x"), ("c2", 1, 1, "y"), ("c1", 1, 1, "z")], "channel_id string, page_number bigint, position_in_page bigint, video_id string")
    found = spark.createDataFrame([("c1", "r2", 0), ("c2", "r1", 5), ("c3", "r0", 0)], "channel_id string, _run_id string, _seq bigint")
    expansion.write_expansion(uploads, found, str(tmp_path / "expansion"), 2)
    assert [r["video_id"] for r in read_ordered(spark, str(tmp_path / "expansion"), uploads.schema).collect()] == ["y", "z", "x"]
