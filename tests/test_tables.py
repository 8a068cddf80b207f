from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.session import scratch_path, shared_dir
from corpus_engine.sources import tables
from tests.helpers import values

SCHEMA = schemas.fields(k=schemas.S, text=schemas.S, tags=schemas.STRINGS, error=schemas.ERRORS, n=schemas.L)
ROWS = [
    ("a", 'line\nbreak, "quoted", é', ["x", 'y"z'], {"s": ("T", "m"), "a": ("U", None)}, 1),
    ("b", None, [], None, None),
    ("c", "t", None, {}, 3),
]


def test_csv_round_trip_and_cell_format(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tables.write_csv(df, str(tmp_path / "csv"))
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbf") for p in (tmp_path / "csv").glob("part-*"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), SCHEMA)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    cells = df.select("k", *[tables.json_cell(F.col(c), SCHEMA[c].dataType).alias(c) for c in ("tags", "error")])
    got = {r.k: r for r in cells.collect()}
    assert got["a"].tags == '["x", "y\\"z"]'
    assert got["a"].error == '{"a": {"message": null, "type": "U"}, "s": {"message": "m", "type": "T"}}'
    assert (got["b"].tags, got["b"].error, got["c"].error) == ("[]", None, "{}")


def test_shared_folder():
    def session(master, configured=None, current=None):
        context = SimpleNamespace(master=master, folder=current)
        context.getCheckpointDir = lambda: context.folder
        context.setCheckpointDir = lambda path: setattr(context, "folder", path)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: configured))

    assert shared_dir(session("yarn", "s3://b/x")) == "s3://b/x"
    assert shared_dir(session("yarn", None, "hdfs:/y")) == "hdfs:/y"
    assert scratch_path(session("yarn", "s3://b/x/"), "a").startswith("s3://b/x/a-")
    local = session("local[2]")
    assert shared_dir(local) == local.sparkContext.getCheckpointDir() == shared_dir(local)
    with pytest.raises(ValueError):
        shared_dir(session("yarn"))


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert tables.read_table(spark, path, SCHEMA).count() == 0
    tables.write_table(df, path, "1", ["CSV"])
    assert tables.read_table(spark, path, SCHEMA).count() == 3
    tables.write_table(df.where("k = 'a'"), path, "2", ["parquet", "csv"])
    assert values(tables.read_table(spark, path, SCHEMA), "k") == [("a",)]
    # the version being read can feed the next one
    tables.write_table(tables.read_table(spark, path, SCHEMA).withColumn("n", F.lit(9).cast("bigint")), path, "3")
    assert values(tables.read_table(spark, path, SCHEMA), "n") == [(9,)]
    (tmp_path / "t.parquet" / "version=000000099-4").mkdir()  # not complete
    assert values(tables.read_table(spark, path, SCHEMA), "n") == [(9,)]
    with pytest.raises(ValueError):
        tables.write_table(df, path, "5", ["xml"])


def test_versions_count_in_the_order_of_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    for label in ("r9", "r10", "a"):
        tables.write_table(spark.createDataFrame([(label,)], "k string"), path, label)
        assert values(tables.read_table(spark, path, SCHEMA), "k") == [(label,)]
    with pytest.raises(ValueError):
        tables.write_table(spark.createDataFrame([("again",)], "k string"), path, "r10")
    assert values(tables.read_table(spark, path, SCHEMA), "k") == [("a",)]
    for left in (tmp_path / "t.parquet").rglob("_SUCCESS"):
        left.unlink()  # a committer that leaves no mark of its own
    assert values(tables.read_table(spark, path, SCHEMA), "k") == [("a",)]
    assert tables.drop_old_versions(spark, path) == 2
    assert values(tables.read_table(spark, path, SCHEMA), "k") == [("a",)]


def test_bucket_number_is_kept(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(20).selectExpr("cast(id as string) k", "id v", "'r1' _run_id", "id _seq")
    tables.merge_into_table(rows, path, ["k"], buckets=16)
    with pytest.raises(ValueError):
        tables.merge_into_table(rows, path, ["k"], buckets=6)
    tables.merge_into_table(rows, path, ["k"])
    assert tables.read_table(spark, path, SCHEMA, merged=True).count() == 20


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "m")
    first = spark.range(200).selectExpr("cast(id as string) k", "id v", "'r1' _run_id", "id _seq")
    tables.merge_into_table(first, path, ["k"], buckets=16)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "m.merged").rglob("*.parquet")}
    second = spark.createDataFrame([("5", 500, "r2", 0), ("5", 501, "r2", 1), ("new", 7, "r2", 2)], "k string, v long, _run_id string, _seq long")
    tables.merge_into_table(second, path, ["k"], buckets=16)
    again = values(tables.read_table(spark, path, SCHEMA, merged=True), "k", "v")
    expected = {str(i): i for i in range(200)} | {"5": 501, "new": 7}
    assert dict(again) == expected and len(again) == 201
    untouched = [p for p in stamps if p.exists() and p.stat().st_mtime_ns == stamps[p]]
    assert len(untouched) >= 14
    tables.merge_into_table(second, path, ["k"], buckets=16)
    assert values(tables.read_table(spark, path, SCHEMA, merged=True), "k", "v") == again


def test_merge_recovers_from_a_half_done_overwrite(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    rows = spark.range(50).selectExpr("cast(id as string) k", "id v", "'r1' _run_id", "id _seq")
    tables.merge_into_table(rows, path, ["k"], buckets=4)
    change = spark.createDataFrame([("7", 700, "r2", 0)], "k string, v long, _run_id string, _seq long")
    finish, calls = tables._finish_merge, []

    def dies_at_the_end(session, table):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        finish(session, table)

    monkeypatch.setattr(tables, "_finish_merge", dies_at_the_end)
    with pytest.raises(RuntimeError):
        tables.merge_into_table(change, path, ["k"], buckets=4)
    monkeypatch.setattr(tables, "_finish_merge", finish)
    (touched,) = {b for b in (tmp_path / "m.merged").glob("_bucket=*") if spark.read.parquet(str(b)).where("k = '7'").count()}
    for part in touched.iterdir():  # the old bucket is already gone, the new one not yet there
        part.unlink()
    later = spark.createDataFrame([("8", 800, "r3", 0)], "k string, v long, _run_id string, _seq long")
    tables.merge_into_table(later, path, ["k"], buckets=4)
    expected = {str(i): i for i in range(50)} | {"7": 700, "8": 800}
    assert dict(values(tables.read_table(spark, path, SCHEMA, merged=True), "k", "v")) == expected
    assert not (tmp_path / "m.pending").exists()


def test_csv_files_are_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "CSV_ROWS", 10)
    rows = spark.range(35).selectExpr("id", "concat('a\\n', id) as text").coalesce(1)
    tables.write_csv(rows, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 4
    assert values(tables.read_csv(spark, str(tmp_path / "csv"), rows.schema), "id", "text") == values(rows, "id", "text")


def test_scratch_tables_are_packed(spark):
    kept = tables.staged(spark.range(3).toDF("n"), "packed")
    assert values(kept, "n") == [(0,), (1,), (2,)] and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())


def test_a_batch_of_too_few_rows_is_refused(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(ValueError, match="has 3 rows, not 4"):
        tables.append_batch(spark.range(3), path, 0, rows=4)
    assert tables.read_batches(spark, path) is None
    tables.append_batch(spark.range(4), path, 0, rows=4)
    assert values(tables.read_batches(spark, path), "id") == [(0,), (1,), (2,), (3,)]
