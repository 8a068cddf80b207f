"""Token ids as Arrow files of equal-length sequences.

Documents are range-partitioned by id; each partition becomes one shard, an Arrow IPC file whose
record batches hold ``ids`` and ``mask`` as fixed-size lists. A batch has ``SEQUENCES`` rows but for
the last, so row r is in batch r // SEQUENCES and its ids lie at a fixed offset in one buffer: any
sequence is read without copying or parsing what lies before it. A second, small Arrow file beside it
names the shard's documents in order. Ids take 16 bits where the vocabulary allows.

Files appear complete or not at all, under names unique to the attempt; the manifest names only
those of tasks that succeeded, so a lost executor or a repeated task leaves at most unnamed files.

Defined results: null or empty texts hold the end id alone; repeated ids are ordered by a hash of the text, a null id
comes first; an empty table has no shard. Long texts are encoded whole. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.llm.common import as_uri, prepare, open_folder, settled, texts, written_file
from corpus_engine.llm.word_tokens import END_ID, encoder

SEQUENCE = 2048
SEQUENCES = 256  # rows of a batch
KIND = pa.uint16()
LAYOUT = pa.schema([("ids", pa.list_(KIND, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])
INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard long, first_id long, file string, index string, n_docs long, n_ids long"


def _batch(ids: np.ndarray) -> pa.RecordBatch:
    """Whole sequences; the last one is padded with 0 and masked."""
    padded = -len(ids) % SEQUENCE
    mask = np.concatenate([np.ones(len(ids), bool), np.zeros(padded, bool)])
    ids = np.concatenate([ids, np.zeros(padded, ids.dtype)])
    return pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(ids, KIND), SEQUENCE),
         pa.FixedSizeListArray.from_arrays(pa.array(mask), SEQUENCE)], schema=LAYOUT)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, key="doc_id", text="text") -> DataFrame:
    """Writes the shards and returns their manifest, one row each."""
    prepare(docs.sparkSession)
    folder = as_uri(folder)
    whole = SEQUENCE * SEQUENCES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u2").tobytes()
        waiting, size, n_docs, n_ids = [], 0, 0, 0
        name = f"shard-{shard:06d}"
        with (written_file(folder, f"{name}.arrow") as (out, file), written_file(folder, f"{name}.docs.arrow") as (about, index),
              pa.ipc.new_file(out, LAYOUT) as sequences, pa.ipc.new_file(about, INDEX) as documents):
            batch = first
            while batch is not None:
                counts = []
                for body in batch.column("body").to_pylist():
                    ids = encode(body) + end
                    counts.append(len(ids) // 2)
                    waiting.append(ids)
                    size += counts[-1]
                    if size >= whole:
                        held = np.frombuffer(b"".join(waiting), "<u2")
                        cut = size // whole * whole
                        for at in range(0, cut, whole):
                            sequences.write_batch(_batch(held[at:at + whole]))
                        waiting, size = [held[cut:].tobytes()], size - cut
                documents.write_batch(pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64())], schema=INDEX))
                n_docs, n_ids = n_docs + len(counts), n_ids + sum(counts)
                batch = next(batches, None)
            if size:
                sequences.write_batch(_batch(np.frombuffer(b"".join(waiting), "<u2")))
        lowest = first.column("id")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in ((shard, pa.int64()), (lowest, pa.int64()), (file, pa.string()),
                                           (index, pa.string()), (n_docs, pa.int64()), (n_ids, pa.int64()))],
            [c.split()[0] for c in MANIFEST.split(", ")])

    rows = texts(docs, key, text)
    # A sort by id alone would gather rows of one id in a partition; the text's hash and the row number split them, copies of a row too.
    rows = rows.withColumns({"mark": F.xxhash64("body"), "row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("id", "mark", "row").sortWithinPartitions("id", "mark", "row")
    return settled(ordered.select("id", "body").mapInArrow(write, MANIFEST), "token-manifest")


def shard_files(uri: str, path: str) -> pa.ipc.RecordBatchFileReader:
    """A shard opened for random access: memory-mapped where the file system is local."""
    fs, _ = open_folder(uri)
    if fs.type_name == "local":
        return pa.ipc.open_file(pa.memory_map(path))
    return pa.ipc.open_file(fs.open_input_file(path))


def sequence_at(reader: pa.ipc.RecordBatchFileReader, row: int) -> np.ndarray:
    """Ids of one sequence, a view into the file's buffer."""
    return reader.get_batch(row // SEQUENCES).column("ids")[row % SEQUENCES].values.to_numpy(zero_copy_only=True)


class ShardIds:
    """Ids of a shard by position, a batch at a time."""

    def __init__(self, reader: pa.ipc.RecordBatchFileReader):
        self.reader, self.at, self.held = reader, -1, None

    def slices(self, start: int, stop: int) -> Iterator[np.ndarray]:
        whole = SEQUENCE * SEQUENCES
        while start < stop:
            if start // whole != self.at:
                self.at = start // whole
                self.held = self.reader.get_batch(self.at).column("ids").flatten().to_numpy(zero_copy_only=True)
            until = min(stop, (self.at + 1) * whole)
            yield self.held[start - self.at * whole:until - self.at * whole]
            start = until


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents read back: ``doc_id``, ``start`` over all shards, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``.

    ``ids`` and the checksum are over little-endian unsigned 32-bit integers."""
    uri = as_uri(folder)
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids, local = ShardIds(shard_files(uri, shard["file"])), 0
                index = shard_files(uri, shard["index"])
                for i in range(index.num_record_batches):
                    part = index.get_batch(i)
                    starts, sums, found = [], [], []
                    for n in part.column("n_tokens").to_pylist():
                        total, pieces = 0, []
                        for piece in ids.slices(local, local + n):
                            raw = piece.astype("<u4").tobytes()
                            total = crc32(raw, total)
                            if with_ids:
                                pieces.append(raw)
                        starts.append(shard["offset"] + local)
                        sums.append(total)
                        found.append(b"".join(pieces))
                        local += n
                    out = [part.column("doc_id"), pa.array(starts, pa.int64()), part.column("n_tokens"), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(out + [pa.array(found, pa.binary())] * with_ids, [c.split()[0] for c in columns.split(", ")])

    # One row for each shard, so the running total and the dealing out are over a short table.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("offset", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spark = manifest.sparkSession
    shards = placed.collect()
    if not shards:
        return spark.createDataFrame([], columns)
    dealt = spark.createDataFrame(spark.sparkContext.parallelize(shards, len(shards)), placed.schema)
    return dealt.mapInArrow(read, columns)
