"""Approximate nearest neighbours by NN-descent: a neighbour graph from joins of neighbours of neighbours, searched greedily.

1. Equal vectors are one node, which keeps the smallest ids of its rows: no more can be among the results, so copies, of which a
   vector may have very many, need no links between each other and are still all found.
2. The first graph comes from some random orders of the nodes: each node is compared with the others of a chunk.
3. A round brings the neighbours of a node, in both directions, together and compares them with each other, if one of the two is new to
   the node (a *local join*). What is nearer than a node's ``neighbours``-th neighbour so far becomes its neighbour. Rounds end when less
   than ``settled_share`` of the links are new. A node that very many others name as neighbour has its namers dealt into cells of about
   ``block``, each of which meets the node's own neighbours; nobody is left out.
4. A query starts at its own node and repeatedly looks at the neighbours of the ``beam`` nearest nodes seen, until all of those have been
   looked at. All queries advance together, one join a step.
5. The exact distances, on the original vectors, order what the beam holds.

Until step 5 vectors travel as one byte a component and a scale of their own. A node's row and its links are the only state;
rounds and steps are written to the shared folder. A local join holds a cell at a time, and a task keeps of its results the best of
each node before they are shuffled, so that a node named by many sends few rows.

Recall against brute force is 0.9 or more on the test tables (README); distances that are returned are exact.

Defined results: vectors that are null, empty, zero or with null or non-finite components take no part; a vector
meets only vectors of its own length; a query's own row is no candidate, equal rows are; a query row that occurs more than once gives its
results as often; a null id comes after all others; an empty table, or one without queries, gives no row. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.llm.common import prepare, settled

LAST = (1 << 63) - 1  # stands for a null id, which comes last
BATCH = 8192  # rows of codes that go to a task at a time
LARGEST = 1e148  # scale of a code, so that squared distances stay finite
FLUSH = 400_000  # links that a task holds before it sends the best of them


@dataclass(frozen=True)
class Settings:
    neighbours: int = 32
    block: int = 32  # namers of a node in a cell, on the average
    best: int = 10  # of a node in a cell
    chunk: int = 128
    orders: int = 3
    rounds: int = 25  # at most
    settled_share: float = 0.02
    beam: int = 200
    results: int = 10
    seed: int = 20260301


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` (a null one as the largest) and ``x`` (doubles, no negative zero) of the vectors that take part."""
    doubles = F.transform(F.col(vector).cast("array<double>"), lambda v: v + F.lit(0.0))
    rows = vectors.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)).alias("id"), doubles.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(finite & F.exists("x", lambda v: v != 0))


# --- codes -----------------------------------------------------------------------------------


def encoded(vectors: pa.Array) -> list[bytes]:
    """Of each vector its scale (a double) and a byte for each component."""
    sizes = np.diff(vectors.offsets.to_numpy())
    parts, flat, at = [], vectors.flatten().to_numpy(zero_copy_only=False), 0
    for run in np.split(sizes, np.flatnonzero(sizes[1:] != sizes[:-1]) + 1):
        if len(run):
            v = flat[at:at + len(run) * run[0]].reshape(len(run), -1)
            at += v.size
            scales = np.abs(v).max(1, keepdims=True)
            scales = np.clip(np.where(scales / 127 > 0, scales / 127, scales), None, LARGEST)
            raw = np.concatenate([scales.view(np.uint8), np.clip(np.rint(v / scales), -127, 127).astype(np.int8).view(np.uint8)], axis=1)
            parts += [r.tobytes() for r in raw]
    return parts


def decoded(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors, filled up with zeros to the length of the longest, and their lengths."""
    rows = codes.to_pylist()
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) - 8
    if len(set(sizes.tolist())) > 1:
        rows = [r.ljust(int(sizes.max()) + 8, b"\0") for r in rows]
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    scales = raw[:, :8].copy().view(np.float64)
    return raw[:, 8:].view(np.int8) * scales, sizes


def between(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Squared distances of all to all; infinite to itself and to other lengths."""
    with np.errstate(over="ignore", invalid="ignore"):
        norms = (x * x).sum(1)
        d = np.nan_to_num(norms[:, None] + norms - 2 * (x @ x.T), nan=np.inf, posinf=np.inf)
    np.fill_diagonal(d, np.inf)
    if sizes.min() != sizes.max():
        d[sizes[:, None] != sizes] = np.inf
    return np.maximum(d, 0)


def nearest_first(u: np.ndarray, v: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` nearest different ``v`` of each ``u``."""
    order = np.lexsort((v, d, u))
    u, v, d = u[order], v[order], d[order]
    # Equal links have equal distances, up to the rounding of different products; those left over go where links are merged.
    new = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
    u, v, d = u[new], v[new], d[new]
    begin = np.concatenate([[True], u[1:] != u[:-1]])
    place = np.arange(len(u)) - np.maximum.accumulate(np.where(begin, np.arange(len(u)), 0))
    return tuple(a[place < k] for a in (u, v, d))


class Links:
    """Links found by a task, of which the best of each node are sent."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0

    def add(self, nodes: np.ndarray, d: np.ndarray, best: int, below: np.ndarray | None = None) -> None:
        """Of each row of ``d`` the ``best`` smallest that are finite, and under ``below``."""
        best = min(best, len(nodes))
        at = np.argpartition(d, best - 1, 1)[:, :best]
        found = np.take_along_axis(d, at, 1)
        good = found < (np.inf if below is None else below[:, None])
        row, column = np.nonzero(good)
        if len(row):
            self.held.append((nodes[row], nodes[at[row, column]], found[row, column]))
            self.size += len(row)

    def batch(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            u, v, d = nearest_first(*(np.concatenate(c) for c in zip(*self.held)), self.k)
            self.held, self.size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(d)], ["u", "v", "d"])


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys, from sorted partitions; only a run and a batch are held."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        columns = [whole.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        begins = [0, *change.tolist()]
        for begin, end in zip(begins, begins[1:]):
            yield whole.slice(begin, end - begin)
        held = whole.slice(begins[-1])
    if held is not None:
        yield held


# --- graph -----------------------------------------------------------------------------------


def node_table(rows: DataFrame, s: Settings) -> DataFrame:
    """``node``, its vector ``x``, its ``code``, and the smallest ``ids`` of its rows."""
    place = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    few = rows.withColumn("place", place).where(F.col("place") <= s.results + 1)
    nodes = few.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most results + 1 of them

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pa.array(encoded(batch.column("x")), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], ["x", "ids", "code"])

    coded = nodes.select("x", "ids").mapInArrow(code, "x array<double>, ids array<long>, code binary")
    return settled(coded.select(F.monotonically_increasing_id().alias("node"), "x", "ids", "code"), "graph-nodes")


def first_graph(nodes: DataFrame, n: int, s: Settings) -> DataFrame:
    """Links within chunks of random orders, in which nodes of one length stand together; a task holds some dozen chunks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = Links(s.neighbours)
        for run in grouped(batches, ("turn", "size")):
            ends = np.linspace(0, run.num_rows, max(1, run.num_rows // s.chunk) + 1).astype(int).tolist()
            for begin, end in zip(ends, ends[1:]):
                part = run.slice(begin, end - begin)
                links.add(part.column("node").to_numpy(), between(*decoded(part.column("code"))), s.neighbours)
                if links.size > FLUSH:
                    yield from links.batch()
        yield from links.batch()

    orders = F.explode(F.sequence(F.lit(1), F.lit(s.orders))).alias("turn")
    dealt = nodes.select("node", "code", orders).withColumn("size", F.length("code")).withColumn("draw", F.xxhash64("node", "turn", F.lit(s.seed)))
    keys = ("turn", "size", "draw", "node")
    dealt = dealt.repartitionByRange(1 + s.orders * n // (64 * s.chunk), *keys).sortWithinPartitions(*keys)
    found = dealt.select("node", "code", "turn", "size").mapInArrow(compare, "u long, v long, d double")
    return settled(merged(found.withColumn("fresh", F.lit(True)), s), "graph-links")


def merged(links: DataFrame, s: Settings) -> DataFrame:
    """The nearest links of each node, each once; a link that was there before is not fresh. One shuffle, by node."""
    once = links.repartition("u").groupBy("u", "v").agg(F.min("d").alias("d"), F.bool_and("fresh").alias("fresh"))
    place = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    return once.withColumn("place", place).where(F.col("place") <= s.neighbours).select("u", "v", "d", "fresh")


def cells(links: DataFrame, turn: int, s: Settings) -> DataFrame:
    """``centre``, ``cell``, ``node``, ``fresh``: neighbours of a node in all its cells, and its namers in one each."""
    named = links.groupBy(F.col("v").alias("centre")).agg((F.floor(F.count(F.lit(1)) / s.block) + 1).cast("int").alias("n"))
    out = links.select(F.col("u").alias("centre"), F.col("v").alias("node"), "fresh").join(named, "centre", "left")
    out = out.select("centre", F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1)).alias("cell"), "node", "fresh")
    back = links.select(F.col("v").alias("centre"), F.col("u").alias("node"), "fresh").join(named, "centre")
    back = back.select("centre", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("n")).cast("int").alias("cell"), "node", "fresh")
    return out.unionByName(back)


def local_joins(nodes: DataFrame, links: DataFrame, turn: int, s: Settings) -> DataFrame:
    """The links after one round."""
    worst = links.groupBy(F.col("u").alias("node")).agg(F.max("d").alias("most"), F.count(F.lit(1)).alias("n"))
    worst = worst.select("node", F.when(F.col("n") >= s.neighbours, F.col("most")).otherwise(float("inf")).alias("worst"))
    facts = nodes.select("node", "code").join(worst, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = Links(s.neighbours)
        for run in grouped(batches, ("centre", "cell")):
            members, first = np.unique(run.column("node").to_numpy(), return_index=True)
            fresh = np.zeros(len(members), bool)
            np.logical_or.at(fresh, np.searchsorted(members, run.column("node").to_numpy()), run.column("fresh").to_numpy(zero_copy_only=False))
            if len(members) < 2 or not fresh.any():
                continue
            run = run.take(pa.array(first))
            d = between(*decoded(run.column("code")))
            d[~(fresh[:, None] | fresh)] = np.inf
            links.add(members, d, s.best, run.column("worst").to_numpy())
            if links.size > FLUSH:
                yield from links.batch()
        yield from links.batch()

    met = cells(links, turn, s).join(facts, "node").select("centre", "cell", "node", "fresh", "worst", "code")
    found = met.repartition("centre", "cell").sortWithinPartitions("centre", "cell").mapInArrow(compare, "u long, v long, d double")
    both = links.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True)))
    return settled(merged(both, s), "graph-links")


def build_graph(nodes: DataFrame, s: Settings) -> DataFrame:
    """``u``, ``v``, ``d``: the neighbours of each node."""
    links = first_graph(nodes, nodes.count(), s)
    for turn in range(s.rounds):
        links = local_joins(nodes, links, turn, s)
        n, fresh = links.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if fresh <= s.settled_share * n:
            break
    return links.select("u", "v", "d")


# --- search ----------------------------------------------------------------------------------


def distances(pairs: DataFrame) -> DataFrame:
    """``q``, ``node``, ``d`` of pairs with the codes of both."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both, _ = decoded(pa.concat_arrays([batch.column("mine").cast(pa.binary()), batch.column("code").cast(pa.binary())]))
                with np.errstate(over="ignore", invalid="ignore"):
                    apart = both[:batch.num_rows] - both[batch.num_rows:]
                    d = np.nan_to_num((apart * apart).sum(1), nan=np.inf, posinf=np.inf)
                yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(d)], ["q", "node", "d"])

    return pairs.select("q", "node", "mine", "code").mapInArrow(compare, "q long, node long, d double")


def greedy_search(nodes: DataFrame, links: DataFrame, queries: DataFrame, s: Settings) -> DataFrame:
    """``q`` and ``node``: the beam of each query (``q``, ``node``, ``code``), which begins at its own node."""
    beam = settled(queries.select("q", "node", F.lit(0.0).alias("d"), F.lit(True).alias("open")), "graph-beam")
    mine = queries.select("q", F.col("code").alias("mine"))
    place = F.row_number().over(Window.partitionBy("q").orderBy("d", "node"))
    while not beam.where("open").isEmpty():
        ahead = beam.where("open").select("q", F.col("node").alias("u")).join(links.select("u", F.col("v").alias("node")), "u")
        ahead = ahead.select("q", "node").distinct().join(beam.select("q", "node"), ["q", "node"], "left_anti")
        seen = distances(ahead.join(nodes.select("node", "code"), "node").join(mine, "q"))
        # A node that fell out of the beam cannot come back: the beam only gets nearer, and its order is total.
        both = beam.withColumn("open", F.lit(False)).unionByName(seen.withColumn("open", F.lit(True)))
        beam = settled(both.withColumn("place", place).where(F.col("place") <= s.beam).drop("place"), "graph-beam")
    return beam.select("q", "node")


def euclidean(a: Column, b: Column) -> Column:
    """In double precision, component by component."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, v: total + v))


def nearest_neighbours(vectors: DataFrame, asked: Column, s: Settings = Settings(), key="vec_id", vector="embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the rows nearest to each row for which ``asked`` holds."""
    prepare(vectors.sparkSession, BATCH)
    nodes = node_table(usable(vectors, key, vector), s)
    links = build_graph(nodes, s)
    rows = usable(vectors.where(asked), key, vector).groupBy("id", "x").agg(F.count(F.lit(1)).alias("copies"))
    queries = rows.join(nodes.select("x", "node", "code"), "x").select(F.monotonically_increasing_id().alias("q"), "id", "x", "copies", "node", "code")
    queries = settled(queries, "graph-queries")
    found = greedy_search(nodes, links, queries.select("q", "node", "code"), s)

    exact = found.join(nodes.select("node", F.col("x").alias("y"), "ids"), "node").join(queries.select("q", "id", "x", "node").withColumnRenamed("node", "own"), "q")
    exact = exact.withColumn("score", euclidean(F.col("x"), F.col("y")))
    # The query's own row is one of those with its id on its own node, if that is among the node's smallest.
    at = F.when(F.col("node") == F.col("own"), F.array_position("ids", F.col("id"))).otherwise(F.lit(0))
    others = F.filter("ids", lambda _, i: i + 1 != F.col("at"))
    exact = exact.withColumn("at", at).select("q", "score", F.explode(others).alias("vec"))
    place = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec"))
    top = exact.withColumn("rank", place).where(F.col("rank") <= s.results)
    top = top.join(queries.select("q", "id", "copies"), "q")
    top = top.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return top.select(known("id").alias("query_id"), "rank", known("vec").alias("vec_id"), "score")
