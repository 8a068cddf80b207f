"""Token files: read back whole, at random, and across batch bounds."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from corpus_engine.llm import token_files as tf
from corpus_engine.llm.common import setting
from corpus_engine.llm.word_tokens import WordEncoder, default_tokenizer
from llm_helpers import documents, hot_rows, odd_rows, prose


@pytest.fixture(scope="module")
def rows():
    return odd_rows() + [(1000 - i, prose(i, 3 * i)) for i in range(80)]


@pytest.fixture(scope="module")
def written(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens"))
    return tf.write_token_files(documents(spark, rows), folder, default_tokenizer()), folder


def test_read_back(spark, rows, written):
    encode = WordEncoder(default_tokenizer()).encode
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(np.frombuffer(encode((t or "").encode()), "<u2").tolist() + [1])
    got = sorted(tf.read_token_files(*written, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order) and len(got) == len(rows)
    for r in got:
        found = np.frombuffer(r.ids, "<u4").tolist()
        assert found in ids[r.doc_id] and r.n_tokens == len(found) and r.ids_crc32 == crc32(r.ids)


def test_sequences_are_views_of_the_file(spark, written):
    for shard in written[0].collect():
        reader = tf.shard_files(tf.as_uri(written[1]), shard.file)
        rows = sum(reader.get_batch(i).num_rows for i in range(reader.num_record_batches))
        assert rows == -(-shard.n_ids // tf.SEQUENCE) and reader.schema.equals(tf.LAYOUT)
        before = pa.total_allocated_bytes()
        last = tf.sequence_at(reader, rows - 1)
        assert len(last) == tf.SEQUENCE and pa.total_allocated_bytes() - before < 1000
        mask = reader.get_batch((rows - 1) // tf.SEQUENCES).column("mask")[(rows - 1) % tf.SEQUENCES].values.to_numpy(zero_copy_only=False)
        filled = shard.n_ids - (rows - 1) * tf.SEQUENCE
        assert mask.sum() == filled and mask[:filled].all() and (last[filled:] == 0).all() and last[filled - 1] == 1


def test_small_batches(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "SEQUENCES", 2)
    ids = np.arange(5 * tf.SEQUENCE + 3) % 60000
    path = tmp_path / "one.arrow"
    with pa.OSFile(str(path), "wb") as out, pa.ipc.new_file(out, tf.LAYOUT) as writer:
        for at in range(0, len(ids), 2 * tf.SEQUENCE):
            writer.write_batch(tf._batch(ids[at:at + 2 * tf.SEQUENCE].astype("<u2")))
    reader = tf.shard_files(tf.as_uri(str(tmp_path)), str(path))
    shard = tf.ShardIds(reader)
    for begin, end in ((0, 3), (2000, 9000), (9000, len(ids))):
        assert np.concatenate(list(shard.slices(begin, end))).tolist() == ids[begin:end].tolist()
    assert tf.sequence_at(reader, 3).tolist() == ids[3 * tf.SEQUENCE:4 * tf.SEQUENCE].tolist()


def test_empty(spark, tmp_path):
    manifest = tf.write_token_files(documents(spark, []), str(tmp_path), default_tokenizer())
    assert tf.read_token_files(manifest, str(tmp_path)).collect() == []


def test_copies_of_a_row_are_spread_over_shards(spark, tmp_path):
    with setting(spark, "spark.sql.shuffle.partitions", "16"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        manifest = tf.write_token_files(hot_rows(spark), str(tmp_path), default_tokenizer())
    sizes = [r.n_docs for r in manifest.collect()]
    assert len(sizes) == 16 and sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 16
    got = tf.read_token_files(manifest, str(tmp_path)).orderBy("start").collect()
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and got[-1].start + got[-1].n_tokens == sum(r.n_tokens for r in got)
