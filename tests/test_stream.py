from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.sources import pages, tables
from corpus_engine.streaming.ingest import ingest_search_pages, ingest_stream, ingested_hits
from tests.helpers import landing_line, values, write_lines


def page(run, title, videos, captured):
    return landing_line(run_id=run, seq=0, response=captured and {"items": [
        {"id": v, "snippet": {"title": title}} for v in videos]})


def ingest(spark, tmp_path):
    def flatten(batch):
        rows = pages.flatten_video_pages(batch, F.lit("x"))
        return rows.withColumn("captured_at", F.col("_run_id"))

    ingest_stream(
        spark, str(tmp_path / "in"), schemas.DETAIL_ENVELOPE, flatten, str(tmp_path / "videos"), ["video_id"],
        str(tmp_path / "checkpoint"), files_per_batch=1, buckets=4).awaitTermination()
    return values(tables.read_table(spark, str(tmp_path / "videos"), schemas.VIDEO_FACTS, merged=True), "video_id", "title")


def test_new_files_merge_and_late_ones_do_not_win(spark, tmp_path):
    write_lines(tmp_path / "in", "1.json", [page("2026-02", "feb", ["a", "b"], True)])
    assert ingest(spark, tmp_path) == [("a", "feb"), ("b", "feb")]
    write_lines(tmp_path / "in", "2.json", [page("2026-03", "mar", ["b"], True)])
    write_lines(tmp_path / "in", "3.json", [page("2026-01", "late", ["a", "c"], True)])
    assert ingest(spark, tmp_path) == [("a", "feb"), ("b", "mar"), ("c", "late")]
    assert ingest(spark, tmp_path) == [("a", "feb"), ("b", "mar"), ("c", "late")]


def search_page(seq, number, videos, error=None):
    return landing_line(run_id="r1", seq=seq, theme="t", query="q", search_order="date", page_number=number, error=error,
                        response=None if error else '{"items": [%s]}' % ",".join('{"id": {"videoId": "%s"}}' % v for v in videos))


def test_search_pages_over_batches_equal_one_batch(spark, tmp_path):
    lines = [search_page(1, 1, ["a", "b"]), search_page(3, 3, ["d"]), search_page(2, 2, ["c"]), search_page(5, 5, ["f"]),
             search_page(4, 4, [], "403 quotaExceeded"), search_page(0, 0, ["late"])]
    table, stored = str(tmp_path / "hits"), []
    for i, line in enumerate(lines):
        write_lines(tmp_path / "in", f"{i}.json", [line])
        ingest_search_pages(spark, str(tmp_path / "in"), table, str(tmp_path / "checkpoint"), F.lit("now"), files_per_batch=1).awaitTermination()
        stored.append(values(ingested_hits(spark, table), "result_position", "video_id"))
        whole = spark.read.schema(schemas.SEARCH_ENVELOPE).json(str(tmp_path / "in"))
        assert stored[-1] == values(pages.flatten_search_pages(whole, F.lit("now")), "result_position", "video_id")
    assert stored[3] == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "f")]
    assert stored[4] == stored[3][:4]  # what lies behind the cut goes again
    assert stored[5] == [(1, "late"), (2, "a"), (3, "b"), (4, "c"), (5, "d")]
    assert ingested_hits(spark, str(tmp_path / "nothing")).count() == 0
