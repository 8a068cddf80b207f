"""Archives: what is written is read back, in chunks."""

import hashlib
import io
from collections import defaultdict

import duckdb
import pytest

from corpus_engine.llm import queries
from corpus_engine.llm.common import as_uri
from corpus_engine.llm.warc_archive import chunks, read_archive, write_archive

BIG = "".join(chr(32 + i % 90) for i in range(300_000)) + "\r\n\r\nWARC/1.1\r\n\r\n"
PAGES = [(1, "http://a/", "x" * 100), (2, "http://b/", "x" * 100), (3, None, "x" * 99), (4, "http://d/", "x" * 99), (5, "u é\r\nX: 1", None), (6, None, ""),
         (7, "http://e/", BIG), (8, "http://f/", BIG), (None, "http://g/", "x" * 100), (2, "http://b/", "x" * 100), (1, "http://a/", "x" * 100)]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("archive"))
    pages = spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id long, url string, html string, digest string, payload string")
    return write_archive(pages, folder), folder


def test_round_trip(spark, archive):
    by_record = defaultdict(list)
    for r in read_archive(*archive, chunk=10_000).collect():
        by_record[r.record_id, r.page_id, r.record_type].append(r)
    bodies = {}
    for rows in by_record.values():
        so_far = hashlib.sha256()
        copies = sum(r.last for r in rows)
        rows = sorted({(r.chunk, bytes(r.data or b""), r.payload_bytes, r.payload_digest, r.last, r.valid, r.refers_to, r.record_type, r.page_id) for r in rows},
                      key=lambda r: r[0])
        assert [r[0] for r in rows] == list(range(len(rows))) and all(r[5] for r in rows) and copies >= 1
        body = b"".join(r[1] for r in rows)
        if rows[0][7] == "response":
            for chunk in rows:
                so_far.update(chunk[1])
                assert len(chunk[1]) <= 10_000 and chunk[3] == so_far.hexdigest()
            assert rows[-1][2] == len(body)
            bodies.setdefault(rows[0][8], []).append(body)
    assert bodies == {1: [b"x" * 100], 3: [b"x" * 99], 4: [b"x" * 99], 5: [b""], 6: [b""], 7: [BIG.encode()], None: [b"x" * 100]}


def test_addresses_come_back_as_they_were(spark, tmp_path):
    urls = ["http://a/x%20y?q=1#f", "http://ä/日本", " spaced ", "u é\r\nX: 1", "", "100%", "%C3%A4 ä", None]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = read_archive(write_archive(pages, str(tmp_path)), str(tmp_path)).collect()
    assert [r.url for r in sorted(got, key=lambda r: r.page_id)] == urls


def test_verdicts(spark, archive):
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read_archive(*archive, with_data=False).where("last").collect()),
                 key=str)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(i or 0, "revisit" if i in (2, 8) else "response", {2: 1, 8: 7}.get(i), len((t or "").encode()), digest(t)) for i, _, t in PAGES]
    assert got == sorted(want, key=str)


def test_small_files_and_tiny_reads(spark, tmp_path, monkeypatch):
    import corpus_engine.llm.warc_archive as wa

    folder = str(tmp_path)
    manifest = write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"), folder).collect()
    assert sum(m.n_records for m in manifest) == len(PAGES)
    monkeypatch.setattr(wa, "CHUNK", 7)
    rows = [row for m in manifest for row in chunks(io.BytesIO(open(m.file, "rb").read()), 5_000)]
    assert sum(r[-2] for r in rows) == len(PAGES)
    with pytest.raises(Exception):
        largest = max((open(m.file, "rb").read() for m in manifest), key=len)
        list(chunks(io.BytesIO(largest[:-20])))


def test_empty(spark, tmp_path):
    manifest = write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path))
    assert read_archive(manifest, as_uri(str(tmp_path))).collect() == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    cursor = con.execute(queries.ORACLE["op4_warc"])
    names = [d[0] for d in cursor.description]
    got = queries.op4_warc(spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cursor.fetchall())
