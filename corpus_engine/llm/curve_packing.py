"""Packing along a space-filling curve.

A document's token ids are hashed to random directions in a few dimensions; the mean direction,
laid on a grid, gives its place on a Hilbert curve. Documents are range-sorted by that place, so
neighbours in the stream have similar words, and the stream of each range is cut into sequences of
``length`` ids. What is left at a range's end becomes sequences whose lengths are powers of two,
which need no padding; so no sequence has any.

Many equal documents share a place; the range is therefore over place, id, a hash of the ids and a row number, and a group of
copies is spread over as many ranges as its size asks for.

Defined results: null or empty texts are the end id alone; rows with a null or a repeated id are
documents of their own; an empty table has no pieces; texts are encoded whole. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import prepare, settled, texts
from corpus_engine.llm.word_tokens import END_ID, encoder

LENGTH = 2048
DIMENSIONS = 4
GRID_BITS = 10
RANGE_BITS = 40  # sequence numbers: the range above, the place in it below
VOCABULARY = 0x10000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long")


def directions() -> np.ndarray:
    """A fixed random direction for every id."""
    return np.random.default_rng(20260101).standard_normal((VOCABULARY, DIMENSIONS)).astype(np.float32)


def hilbert(points: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Place on the Hilbert curve of rows of grid coordinates, by Skilling's transform (2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        below = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) > 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


def grid(ids: np.ndarray, towards: np.ndarray) -> np.ndarray:
    """Grid coordinates of the mean direction of a document's distinct ids."""
    if not len(ids):
        return np.full(DIMENSIONS, 1 << (GRID_BITS - 1))
    distinct = np.unique(ids)
    mean = towards[distinct].sum(0) / np.sqrt(len(distinct))  # about normal, of variance one
    return np.clip((np.tanh(mean / 1.5) + 1) * (1 << (GRID_BITS - 1)), 0, (1 << GRID_BITS) - 1)


def tokenized(docs: DataFrame, tokenizer: str, key: str, text: str) -> DataFrame:
    """``id``, ``place`` on the curve, and ``ids`` with the end id as 16-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, towards = encoder(tokenizer).encode, directions()
        end = np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            found = [find(body) for body in batch.column("body").to_pylist()]
            points = [grid(np.frombuffer(f, "<u2"), towards) for f in found]
            places = hilbert(np.array(points)) if points else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(places, pa.int64()), pa.array([f + end for f in found], pa.binary())], ["id", "place", "ids"])

    return texts(docs, key, text).mapInArrow(encode, "id long, place long, ids binary")


def cut(total: int, length: int) -> list[int]:
    """Lengths of the sequences that ``total`` ids make: whole ones, then powers of two."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, key="doc_id", text="text", with_ids: bool = False) -> DataFrame:
    """A row for each piece of a document: where it starts, and its sequence and offset there.

    ``ids_crc32`` and, if asked for, ``ids`` are over the piece's ids as little-endian unsigned 32-bit integers."""
    prepare(docs.sparkSession)
    columns = PIECES + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.binary()] * with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << RANGE_BITS
        sequence, held, used = base, [], 0

        def row(piece, number, offset, size):
            doc_id, start, ids, total = piece
            raw = ids.astype("<u4").tobytes()
            return (doc_id, start, len(ids), crc32(raw), total, number, offset, size) + ((raw,) if with_ids else ())

        def closed(number, size):
            offset = 0
            for piece in held:
                yield row(piece, number, offset, size)
                offset += len(piece[2])

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            out = []
            for doc_id, raw in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                ids, at = np.frombuffer(raw, "<u2"), 0
                while at < len(ids):
                    take = min(len(ids) - at, length - used)
                    held.append((doc_id, at, ids[at:at + take], len(ids)))
                    at, used = at + take, used + take
                    if used == length:
                        out.extend(closed(sequence, length))
                        sequence, held, used = sequence + 1, [], 0
            if out:
                yield table(out)
        out, parts = [], cut(used, length)
        for size in parts:  # the last, unfilled sequence
            rest, room, offset = [], size, 0
            for doc_id, start, ids, total in held:
                take = min(room, len(ids))
                if take:
                    out.append(row((doc_id, start, ids[:take], total), sequence, offset, size))
                if take < len(ids):
                    rest.append((doc_id, start + take, ids[take:], total))
                room, offset = room - take, offset + take
            held, sequence = rest, sequence + 1
        if out:
            yield table(out)

    found = settled(tokenized(docs, tokenizer, key, text), "packing-ids")
    # The hash and the row number split what is equal in place and id; the order of equal documents is free.
    found = found.withColumns({"mark": F.xxhash64("ids"), "row": F.monotonically_increasing_id()})
    keys = ("place", "id", "mark", "row")
    ordered = found.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "ids")
    return settled(ordered.mapInArrow(place, columns), "packing-pieces")
