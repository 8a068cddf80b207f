"""Fill-in-the-middle: texts cut at two line ends and put together again with the middle last.

The units of a text are its lines (``[^\\n]*\\n|[^\\n]+``, left to right). They stand in an indexable skip list: every link of a
lane says how many units and how many code points it passes over (its *widths*). The bottom lane links every unit to the next;
each lane above keeps about a quarter of the units below, chosen by a hash of the unit's number, and its widths are the
sums of what it skips. A cut after ``r`` units is reached from the top lane down: a link is followed while the units passed
stay within ``r``, and the code points passed on the way are the place of the cut. So the cuts are exact, and a text's lines
are never copied: only their ends are kept.

Where a text is cut depends on its id alone (see :func:`draws`), not on partitions or other rows.

Defined results: a null text is empty; empty texts and texts that hold a sentinel stay as they are (form ``plain``, null
spans); a null id counts as the text "null"; repeated rows give equal results, one row each; bytes that are no UTF-8 count
as one code point each and come back unchanged; texts are cut whole, whatever their length; an empty table gives no row.
Only the named columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import prepare

MIX = np.uint64(0x9E3779B97F4A7C15)
# Shifts and factors of the splitmix64 finaliser.
MIXING = ((np.uint64(30), np.uint64(0xBF58476D1CE4E5B9)), (np.uint64(27), np.uint64(0x94D049BB133111EB)))
TOP = 24  # lanes at most


@dataclass(frozen=True)
class Settings:
    seed: str = "7:"
    percent_cut: int = 100  # of the texts that may be cut
    percent_spm: int = 50  # of those cut: suffix first; the others prefix first
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    sentinels: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        # A sentinel must not come about where a text and another sentinel meet, else a text could not be restored.
        if not all(marks) or any(a[i:] == b[:len(a) - i] for a in marks for b in marks for i in range(1, len(a))) or any(
                i != j and a in b for i, a in enumerate(marks) for j, b in enumerate(marks)):
            raise ValueError("sentinels must not be empty, overlap or hold each other")
        object.__setattr__(self, "sentinels", marks)


class SkipList:
    """Units of given code-point widths; ``lanes[k]`` has for each node the units and code points before it, and its place in the lane below."""

    def __init__(self, widths: np.ndarray):
        self.units = len(widths)
        before = np.concatenate([[0], np.cumsum(widths)])
        numbers = np.arange(self.units + 1, dtype=np.uint64)
        mixed = numbers * MIX
        for shift, factor in MIXING:
            mixed = (mixed ^ (mixed >> shift)) * factor
        # The head stands in every lane; a node rises with each pair of zero bits.
        lowest_bit = (mixed & (~mixed + np.uint64(1))).astype(np.float64)  # a power of two, so the conversion is exact
        heights = (np.frexp(lowest_bit)[1] - 1) // 2
        heights[0] = int(heights[1:].max(initial=0))
        self.lanes = []
        nodes = np.arange(self.units + 1)
        below, code_points = np.ones(self.units, np.int64), np.diff(before)
        self.lanes.append((below, code_points, nodes))
        for height in range(1, TOP):
            kept = np.flatnonzero(heights[nodes] >= height)
            if len(kept) < 2:
                break
            nodes = nodes[kept]
            # Widths of a lane are sums over the links of the lane below; what follows its last node is reached from below.
            last = int(kept[-1])
            below = np.add.reduceat(below[:last], kept[:-1])
            code_points = np.add.reduceat(code_points[:last], kept[:-1])
            self.lanes.append((below, code_points, kept))

    def place(self, rank: int) -> int:
        """Code points before the cut after ``rank`` units."""
        at, units, code_points = 0, 0, 0
        for height in range(len(self.lanes) - 1, -1, -1):
            unit_widths, point_widths, down = self.lanes[height]
            while at < len(unit_widths) and units + unit_widths[at] <= rank:
                units += int(unit_widths[at])
                code_points += int(point_widths[at])
                at += 1
            at = int(down[at])
        if units != rank:
            raise IndexError(rank)
        return code_points


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, the line break counted with the line that it ends."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return np.diff(np.array([0, *ends], np.int64))


def draws(key: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers: the first four groups of eight digits of the hex sha256 of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def cut(text: str, h: tuple[int, int, int, int], s: Settings) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text as put together."""
    widths = line_widths(text)
    n = len(widths)
    if not n or h[2] % 100 >= s.percent_cut or any(x in text for x in s.sentinels):
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, second = (units.place(r) for r in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    head, middle, tail = text[:first], text[first:second], text[second:]
    if h[3] % 100 < s.percent_spm:
        return n, "spm", first, second - first, f"{s.suffix}{tail}{s.prefix}{head}{s.middle}{middle}"
    return n, "psm", first, second - first, f"{s.prefix}{head}{s.suffix}{tail}{s.middle}{middle}"


def fill_in_middle(docs: DataFrame, s: Settings = Settings(), key="doc_id", text="text") -> DataFrame:
    """``doc_id``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.array(*draws(F.col(key), s.seed)).alias("draws"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("body"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cut(body.decode("utf-8", "surrogateescape"), h, s)
                    for h, body in zip(batch.column("draws").to_pylist(), batch.column("body").to_pylist())]
            columns = list(zip(*made)) or [()] * 5
            output = pa.array([x.encode("utf-8", "surrogateescape") for x in columns[4]], pa.binary())
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds)), output],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    made = rows.mapInArrow(make, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, s: Settings = Settings()) -> Column:
    """The text that an output was made of, from output and form alone."""
    # Each sentinel stands in a cut text once. These functions work on bytes, so what is no UTF-8 stays as it is.
    head, tail, middle = (F.substring_index(output, mark, -1) for mark in s.sentinels)
    until = F.substring_index
    psm = F.concat(until(head, s.suffix, 1), middle, until(tail, s.middle, 1))
    spm = F.concat(until(head, s.middle, 1), middle, until(tail, s.prefix, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
