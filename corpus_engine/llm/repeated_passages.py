"""Removal of passages that repeat, by prefix-partitioned suffix trees.

Every window of ``window`` words is the beginning of a suffix. Two suffixes repeat each other if their first ``window``
words are equal, that is if they hang below one internal node of that depth in the corpus's suffix tree. The tree
is built in parts:

1. *Prefixes.* A window's prefix group is its *anchor*, the smallest hash of its runs of ``anchor`` words. Equal
   windows have equal anchors, and neighbouring windows mostly share one, so a document is a short list of
   stretches with one anchor each (about a seventh as many as it has words). Only (anchor, hash of the stretch, place)
   is shuffled, sorted and dealt by range: a light anchor is a short prefix and meets many others in a partition,
   a heavy one is split deeper, by the stretch's content and then by place, so no group need fit in one task.
2. *Equal stretches.* In sorted order all but the first of equal stretches are repeats as a whole. An anchor with a
   single stretch is a leaf: nothing below it repeats.
3. *Subtrees.* The first ones of different stretches with one anchor can still share windows at their ends. Their
   words are fetched, and each anchor's subtree is built in memory, as sorted suffixes with the common prefixes
   of neighbours; its nodes of depth ``window`` or more are the repeats, and all but the earliest suffix of each are
   marked. Anchors with over ``group`` stretches (and those a partition bound may have cut) take the longest prefix,
   the whole window, as group: there a node is one group, reduced to its earliest place before the shuffle.
4. The words that marked windows cover are removed.

Hashes are 64 bits for stretches (beside the 64 of their anchor) and 64 for words; equality of windows is of ``window``
word hashes in a row.

Earlier means a smaller document id (null last), then a smaller hash of the text among equal ids, then the start. Defined
results: null, empty and shorter texts lose nothing; rows with equal id and text are one document, written more than once, and
all get its result; an empty table gives no row; very long texts are handled whole. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import mark, packed, prepare, settled, unpacked

NARROW_ROWS = 16_384  # of a batch without texts
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LAST = (1 << 63) - 1  # stands for a null id, which comes last


@dataclass(frozen=True)
class Settings:
    window: int = 20
    anchor: int = 8
    group: int = 4096


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def stretches(h: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content hash, first window and number of windows of each stretch of a text's word hashes."""
    n = len(h) - s.window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    grams = np.zeros(len(h) - s.anchor + 1, np.uint64)
    for i in range(s.anchor):
        grams = grams * BASE + h[i:i + len(grams)]
    grams = mixed(grams)
    spans = np.lib.stride_tricks.sliding_window_view(grams, s.window - s.anchor + 1)
    smallest = spans.min(1)
    place = np.arange(n) + spans.argmin(1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    size = np.diff(np.append(first, n))
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), BASE)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), INVERSE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:-1])])
    end = first + size + s.window - 1
    content = mixed((sums[end] - sums[first]) * back[first] + size.astype(np.uint64) * BASE)
    return smallest[first], content, first, size


STRETCHES = "anchor long, content long, at long, mark long, start long, size long"
PLACE = ("anchor", "content", "at", "mark", "start")


def all_stretches(rows: DataFrame, s: Settings) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts = [], []
            for body in batch.column("body").to_pylist():
                found = stretches(word_hashes((body or b"").split()), s)
                parts.append(found)
                counts.append(len(found[0]))
            if not parts:
                continue
            anchor, content, start, size = (np.concatenate(c) for c in zip(*parts))
            at = np.repeat(batch.column("at").to_numpy(), counts)
            mark = np.repeat(batch.column("mark").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(at), pa.array(mark), pa.array(start), pa.array(size)],
                [*PLACE, "size"])

    return rows.mapInArrow(find, STRETCHES)


def repeats_and_firsts(found: DataFrame) -> DataFrame:
    """Of sorted stretches: repeats of a whole stretch, and the first ones of anchors with several, which need their words.

    ``cut`` tells anchors at a partition's bounds, which may go on in the next one."""
    ordered = found.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    names = ["anchor", "at", "mark", "start", "size", "whole", "cut"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_anchor, before, held = None, None, None  # held: the latest first stretch, whose anchor may have more
        held_shared = False

        def made(columns, whole, cut):
            n = len(columns[0])
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(np.full(n, whole)), pa.array(np.full(n, cut) if np.isscalar(cut) else cut)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in (*PLACE, "size")]
            again = np.ones(batch.num_rows, bool)  # the same place once more, of a document written more than once
            same = np.ones(batch.num_rows, bool)
            for k, c in enumerate(columns[:5]):
                equal = np.concatenate([[before is not None and before[k] == c[0]], c[1:] == c[:-1]])
                again &= equal
                if k < 2:
                    same &= equal
            before = [c[-1] for c in columns[:5]]
            if first_anchor is None:
                first_anchor = columns[0][0]
            stretch = [columns[k] for k in (0, 2, 3, 4, 5)]
            if (same & ~again).any():
                yield made([c[same & ~again] for c in stretch], True, False)
            firsts = [c[~same] for c in stretch]
            if held is not None:
                firsts = [np.concatenate([h, c]) for h, c in zip(held, firsts)]
            a = firsts[0]
            if not len(a):
                continue
            follows = np.concatenate([[held_shared], a[1:] == a[:-1]])
            shared = follows | np.concatenate([a[1:] == a[:-1], [False]])
            edge = a == first_anchor
            give = (shared | edge)[:-1]
            if give.any():
                yield made([c[:-1][give] for c in firsts], False, edge[:-1][give])
            held, held_shared = [c[-1:] for c in firsts], bool(follows[-1])
        if held is not None:
            yield made(held, False, True)  # the last anchor may go on in the next partition

    return ordered.mapInArrow(scan, "anchor long, at long, mark long, start long, size long, whole boolean, cut boolean")


def subtree_repeats(h: np.ndarray, window: int) -> np.ndarray:
    """Of suffixes, given as rows of their first ``window`` word hashes in order of place: which repeat an earlier one.

    Suffixes are sorted; the common prefix of neighbours gives the tree's internal nodes; a node at least ``window``
    deep is a stretch of neighbours whose common prefixes are all that long."""
    order = np.lexsort(h.T[::-1])
    ranked = h[order]
    differs = ranked[1:] != ranked[:-1]
    common = np.where(differs.any(1), differs.argmax(1), window)
    node = np.concatenate([[0], np.cumsum(common < window)])
    earliest = np.full(node[-1] + 1, len(h))
    np.minimum.at(earliest, node, order)
    out = np.zeros(len(h), bool)
    out[order] = order != earliest[node]
    return out


def marked_windows(rows: DataFrame, firsts: DataFrame, s: Settings) -> DataFrame:
    """``at``, ``mark`` and ``start`` of every window among the stretches in ``firsts`` that repeats an earlier one there."""
    heavy = firsts.groupBy("anchor").agg((F.max("cut") | (F.count(F.lit(1)) > s.group)).alias("heavy"))
    wanted = firsts.join(heavy, "anchor").groupBy("at", "mark").agg(F.collect_list(F.struct("anchor", "start", "size", "heavy")).alias("wanted"))
    fetched = rows.select("at", "mark", packed(F.col("body")).alias("packed")).join(wanted, ["at", "mark"])  # a document's own stretches
    names = ["anchor", "heavy", "at", "mark", "start", "size", "words"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in names]
            for at, mark, body, wanted in zip(*(batch.column(c).to_pylist() for c in ("at", "mark", "packed", "wanted"))):
                h = word_hashes(unpacked(body).split())
                for w in wanted:
                    raw = h[w["start"]:w["start"] + w["size"] + s.window - 1].tobytes()
                    values = (w["anchor"], w["heavy"], at, mark, w["start"], w["size"], raw)
                    for column, value in zip(out, values):
                        column.append(value)
            kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    parts = settled(fetched.mapInArrow(fetch, "anchor long, heavy boolean, at long, mark long, start long, size long, words binary"), "passage-firsts")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One subtree for each anchor; rows come sorted by anchor and place."""
        group, current = [], None

        def built():
            h = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(g[4], np.uint64), s.window) for g in group])
            sizes = [g[3] for g in group]
            repeat = subtree_repeats(h, s.window)
            at, mark = (np.repeat(np.array([g[k] for g in group], np.int64), sizes)[repeat] for k in (0, 1))
            start = np.concatenate([np.arange(g[2], g[2] + g[3]) for g in group])[repeat]
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(mark), pa.array(start)], ["at", "mark", "start"])

        for batch in batches:
            for anchor, *stretch in zip(*(batch.column(c).to_pylist() for c in ("anchor", "at", "mark", "start", "size", "words"))):
                if anchor != current and group:
                    yield built()
                    group = []
                current = anchor
                if not group or group[-1][:3] != stretch[:3]:  # else of a document written more than once
                    group.append(stretch)
        if group:
            yield built()

    def deepest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(4)]
            for at, mark, start, size, raw in zip(*(batch.column(c).to_pylist() for c in ("at", "mark", "start", "size", "words"))):
                for i in range(size):
                    out[0].append(xxhash.xxh3_128_digest(raw[8 * i:8 * (i + s.window)]))
                    out[1].append(at)
                    out[2].append(mark)
                    out[3].append(start + i)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), *(pa.array(c, pa.int64()) for c in out[1:])], ["prefix", "at", "mark", "start"])

    light = parts.where("not heavy").repartition("anchor").sortWithinPartitions("anchor", "at", "mark", "start").mapInArrow(trees, "at long, mark long, start long")
    nodes = parts.where("heavy").mapInArrow(deepest, "prefix binary, at long, mark long, start long")
    place = F.struct("at", "mark", "start")
    earliest = nodes.groupBy("prefix").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = nodes.join(earliest, "prefix").where(place != F.col("first")).select("at", "mark", "start")
    return light.unionByName(again)


def remove_repeats(docs: DataFrame, s: Settings = Settings(), key="doc_id", text="text", carry: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, the columns to ``carry`` along and, if asked for,
    ``kept_text``: the kept words joined by one space, or the text as it was if none was removed."""
    spark = docs.sparkSession
    prepare(spark)
    body = F.col(text).cast("string").cast("binary")
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)).alias("at"), mark(F.col(text)).alias("mark"), body.alias("body"),
                       F.struct(F.col(key).cast("bigint").alias("id"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))).alias("carried"))
    found = all_stretches(rows, s)
    prepare(spark, NARROW_ROWS)
    judged = settled(repeats_and_firsts(found), "passage-stretches")
    prepare(spark)
    firsts = judged.where("not whole").select("anchor", "at", "mark", "start", "size", "cut")
    windows = marked_windows(rows, firsts, s).select("at", "mark", "start", F.lit(1).cast("bigint").alias("size"))
    marks = settled(judged.where("whole").select("at", "mark", "start", "size").unionByName(windows), "passage-marks")
    marks = marks.groupBy("at", "mark").agg(F.collect_list(F.struct("start", "size")).alias("marks"))  # a document's own
    joined = rows.select("at", "mark", "carried", packed(F.col("body")).alias("packed")).join(marks, ["at", "mark"], "left").select("carried", "packed", "marks")
    kept_text = ", kept_text string" if with_text else ""
    columns = f"carried {joined.schema['carried'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string{kept_text}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for body, marks in zip(batch.column("packed").to_pylist(), batch.column("marks").to_pylist()):
                body = unpacked(body)
                words = body.split()
                kept = words
                if marks:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for m in marks:
                        edges[m["start"]] += 1
                        edges[m["start"] + m["size"] + s.window - 1] -= 1
                    covered = np.cumsum(edges[:-1]) > 0
                    kept = [w for w, c in zip(words, covered.tolist()) if not c]
                joined = b" ".join(kept)
                out[0].append(len(words))
                out[1].append(len(words) - len(kept))
                out[2].append(hashlib.sha256(joined).hexdigest())
                out[3].append((joined if marks else body).decode("utf-8", "replace") if with_text else None)
            arrays = [batch.column("carried"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            names = ["carried", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(out[3], pa.string())] * with_text, names + ["kept_text"] * with_text)

    done = joined.mapInArrow(cut, columns)
    return done.select(F.col("carried.id").alias("doc_id"), "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text,
                       *(F.col(f"carried.c{i}").alias(c) for i, c in enumerate(carry)))
