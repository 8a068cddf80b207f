"""Near-duplicate documents: HyperMinHash candidates, exact links, connected components.

1. Texts with equal shingle sets are one class; the row with the smallest id stands for it.
2. Bands of compressed registers put representatives into buckets. With 32 bands of 4 registers a pair at
   similarity 0.85 shares no bucket with probability 5e-11, one at 0.8 with 5e-8.
3. In each bucket every member is compared with one centre, by the collision-corrected estimate; what may reach the threshold
   is confirmed on full shingle sets. That alone joins nearly all members of a large group, with a row for each.
4. In buckets whose members still belong to several components, those outside the bucket's largest component are compared
   by estimate with all others; a member that may be near some member of another component is then compared exactly
   with *every* member of that component. So no link between components goes untested, and pairs within a
   component, of which a large group has very many, are never made.
5. The smallest id reachable over all confirmed links names the component.

Comparisons within a group are dealt in blocks (see ``blocked``): groups of any size are split over tasks, each of which holds
a bounded part, and no pair is a row unless it is a candidate. ``margin`` is five standard deviations of the estimate.

Defined results: null and empty texts, and those without a word, link with nothing; a null id comes last in order and
names a component only where no member has an id; repeated rows are one class, and all rows of the kept id are kept;
an empty table gives no row; texts are read whole. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import mark, packed, prepare, settled, texts, unpacked
from corpus_engine.llm.components import components
from corpus_engine.llm.hyper_minhash import BUCKETS, band_keys, band_values, estimate, registers, shingles

LAST = (1 << 63) - 1  # stands for a null id, which comes last


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    sketch_block: int = 1024  # sketches of one side that a task holds
    set_block: int = 1_000_000  # shingles of one side that a task holds, and one document more

    @property
    def margin(self) -> float:
        t = self.percent / 100
        return 5 * sqrt(t * (1 - t) / BUCKETS)


def sketches(rows: DataFrame, s: Settings) -> DataFrame:
    """``row`` (a number, read from this table alone), ``id`` and ``mark``, the set's size and digest, its registers (null if empty)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, found = [], [], []
            for body in batch.column("body").to_pylist():
                h = shingles(body, s.shingle)
                sizes.append(len(h))
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                found.append(registers(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.binary())],
                ["row", "id", "mark", "n", "digest", "sketch"])

    return rows.mapInArrow(make, "row long, id long, mark long, n long, digest binary, sketch binary")


def bands(reps: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u2").reshape(batch.num_rows, BUCKETS))
                rows = np.repeat(batch.column("row").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rows)], ["key", "row"])

    return reps.select("row", "sketch").mapInArrow(make, "key long, row long")


def blocked(xs: DataFrame, ys: DataFrame, limit: int) -> DataFrame:
    """All of a group's ``xs`` meet all its ``ys`` (``row``, ``group``, ``weight``), in blocks of about ``limit`` weight a side.

    A group with ``a`` blocks of xs and ``b`` of ys is dealt to a * b tasks' worth of cells (``i``, ``j``); small groups have one."""
    weights = xs.groupBy("group").agg((F.floor(F.sum("weight") / limit) + 1).alias("a")).join(
        ys.groupBy("group").agg((F.floor(F.sum("weight") / limit) + 1).alias("b")), "group")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    left = xs.join(weights, "group").select("row", "group", F.lit(1).alias("side"), place("a").alias("i"), spread("b").alias("j"))
    right = ys.join(weights, "group").select("row", "group", F.lit(0).alias("side"), place("b").alias("j"), spread("a").alias("i"))
    return left.unionByName(right)


def compared(cells: DataFrame, compare: Callable, columns: list[str], out: str) -> DataFrame:
    """Applies ``compare(ys, xs)`` to the rows of each cell; cells are read one after the other from sorted partitions."""
    names = [c.split()[0] for c in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides, made = None, ([], []), []
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in columns]
            for cell, side, row in zip(zip(*(batch.column(c).to_pylist() for c in ("group", "i", "j"))), batch.column("side").to_pylist(), zip(*values)):
                if cell != current:
                    if sides[1]:
                        made += compare(*sides)
                    current, sides = cell, ([], [])
                sides[side].append(row)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], names)
                made = []
        if sides[1]:
            made += compare(*sides)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], names)

    return cells.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side").mapInArrow(run, out)


def by_sketch(least: float, in_buckets: bool) -> Callable:
    """(x, y, label of y) where the estimate may reach the threshold: of each x one y for each other label.

    ``in_buckets``: groups are buckets of a band; a pair that shares several is given in the first of them only."""

    def compare(ys: list[tuple], xs: list[tuple]) -> list[tuple]:
        if not ys:
            return []
        rows, labels, sizes = (np.array([y[k] for y in ys]) for k in (0, 1, 2))
        many = np.frombuffer(b"".join(y[3] for y in ys), "<u2").reshape(len(ys), BUCKETS)
        bands = band_values(many)
        out = []
        for row, label, size, sketch, group in xs:
            one = np.frombuffer(sketch, "<u2")
            found = np.flatnonzero((estimate(one, many, size, sizes) >= least) & (labels != label) & (rows != row))
            if in_buckets and len(found):
                here = band_keys(one[None])[0].tolist().index(group)
                found = found[(bands[found] == band_values(one[None])).argmax(1) == here]
            if len(found):
                other, first = np.unique(labels[found], return_index=True)
                out += [(row, int(rows[found[k]]), int(o)) for o, k in zip(other, first)]
        return out

    return compare


def by_set(s: Settings) -> Callable:
    """(x, y) whose full sets reach the threshold: one y for each x of a cell."""

    def compare(ys: list[tuple], xs: list[tuple]) -> list[tuple]:
        if not ys:
            return []
        sets = [shingles(unpacked(y[1]), s.shingle) for y in ys]
        sizes = np.array([len(h) for h in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        out = []
        for row, body in xs:
            h = shingles(unpacked(body), s.shingle)
            begin, end = np.searchsorted(tokens, h, "left"), np.searchsorted(tokens, h, "right")
            n = end - begin
            at = np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            shared = np.bincount(owner[at], minlength=len(sets))
            near = np.flatnonzero(100 * shared >= s.percent * (len(h) + sizes - shared))
            near = [k for k in near if ys[k][0] != row]
            if near:
                out.append((row, ys[near[0]][0]))
        return out

    return compare


def near_duplicates(docs: DataFrame, s: Settings = Settings(), key="doc_id", text="text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``mark`` (a hash of the text) and ``stays``, which
    holds for exactly one row of each component."""
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs, key, text).withColumn("mark", mark(F.col("body").cast("string")))
    made = settled(sketches(rows.withColumn("row", F.monotonically_increasing_id()), s), "near-sketches")
    order = F.struct(F.coalesce("id", F.lit(LAST)).alias("id"), F.col("row"))
    classes = made.where("n > 0").groupBy("digest").agg(F.min(order).alias("first"))
    members = made.select("row", "id", "mark", "n", "digest").join(classes.select("digest", F.col("first.row").alias("rep")), "digest", "left")
    members = settled(members.select("row", "id", "mark", "n", F.coalesce("rep", "row").alias("rep")), "near-members")
    reps = settled(made.join(members.where("row = rep and n > 0").select("row"), "row").select("row", "id", "mark", "n", "sketch"), "near-classes")

    keyed = bands(reps)
    buckets = keyed.groupBy("key").agg(F.min("row").alias("centre"), F.count(F.lit(1)).alias("size")).where("size > 1")
    # Nearly all buckets have one member; only the others' rows are looked at again.
    keyed = settled(keyed.join(buckets.select("key", "centre"), "key"), "near-buckets")
    tried = settled(keyed.where("row <> centre").select("row", F.col("centre").alias("group")).distinct(), "near-tried")
    sketch = reps.select("row", F.col("row").alias("label"), "n", "sketch")
    least = s.percent / 100 - s.margin

    def estimated(xs: DataFrame, ys: DataFrame, labelled: DataFrame, in_buckets: bool) -> DataFrame:
        cells = blocked(xs.withColumn("weight", F.lit(1)), ys.withColumn("weight", F.lit(1)), s.sketch_block)
        return compared(cells.join(labelled, "row"), by_sketch(least, in_buckets), ["row", "label", "n", "sketch", "group"], "x long, y long, label long")

    size = reps.select("row", F.col("n").alias("weight"))
    named_by = reps.select("row", F.coalesce("id", F.lit(LAST)).alias("at"), "mark")
    # Only texts of buckets with several members can be asked for. One for each name, reduced in the tasks first: repeated rows would come
    # to a cell as often as they stand in the table.
    wanted = named_by.join(keyed.select("row").distinct(), "row", "left_semi").select("at", "mark").distinct()
    body = rows.select(F.coalesce("id", F.lit(LAST)).alias("at"), "mark", packed(F.col("body")).alias("packed"))
    body = body.groupBy("at", "mark").agg(F.first("packed").alias("packed")).join(wanted, ["at", "mark"], "left_semi")
    body = settled(body, "near-bodies")

    def confirmed(xs: DataFrame, ys: DataFrame) -> DataFrame:
        cells = blocked(xs.join(size, "row"), ys.join(size, "row"), s.set_block)
        return compared(cells.join(named_by, "row").join(body, ["at", "mark"]), by_set(s), ["row", "packed"], "a long, b long")

    centres = lambda pairs: pairs.select(F.col("group").alias("row"), "group").distinct()
    near = settled(estimated(tried, centres(tried), sketch, False).select(F.col("x").alias("row"), F.col("y").alias("group")).distinct(), "near-estimated")
    links = settled(confirmed(near, centres(near)), "near-links")

    labels = components(links)
    named = keyed.select("key", "row").join(labels.withColumnRenamed("v", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    named = settled(named, "near-named")
    shares = named.groupBy("key", "label").count()
    open_buckets = shares.groupBy("key").agg(F.max(F.struct("count", "label")).alias("most"), F.count(F.lit(1)).alias("n")).where("n > 1")
    inside = named.join(open_buckets.select("key", F.col("most.label").alias("main")), "key")
    inside = inside.select("row", F.col("key").alias("group"), (F.col("label") == F.col("main")).alias("main"))
    label_of = reps.join(labels.withColumnRenamed("v", "row"), "row", "left").select("row", F.coalesce("label", "row").alias("label"), "n", "sketch")
    label_of = settled(label_of, "near-labelled")
    # A member of the main component is compared as y; pairs of two others meet once as (x, y) and once as (y, x).
    others = estimated(inside.where("not main").select("row", "group"), inside.select("row", "group"), label_of, True)
    asked = settled(others.select(F.col("x").alias("row"), F.col("label").alias("group")).distinct(), "near-asked")
    answering = label_of.select("row", F.col("label").alias("group")).join(asked.select("group").distinct(), "group")
    more = settled(confirmed(asked, answering.select("row", "group")), "near-more")
    labels = components(links.unionByName(more))

    placed = members.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    names = placed.groupBy("label").agg(F.min("id").alias("component_id"), F.min(order).alias("first"))
    return placed.join(names, "label").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        "mark", (F.col("row") == F.col("first.row")).alias("stays"))
