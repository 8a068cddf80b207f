"""Sides of a join that are counted before anything is decided about them, and rows counted while they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpus_engine.session import shared_dir

BROADCAST_ROWS = 100_000


def counted(df: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """A narrow side, checkpointed, and its number of rows.

    Up to ``broadcast_rows`` rows it is marked for broadcast; a larger one is left to a shuffle join.
    """
    shared_dir(df.sparkSession)
    settled = df.checkpoint()
    rows = settled.count()
    return (F.broadcast(settled) if rows <= broadcast_rows else settled), rows


def settled_side(df: DataFrame) -> DataFrame:
    """Only the frame of :func:`counted`."""
    return counted(df)[0]


class Observed:
    """Counts taken while a frame is written; reading them afterwards runs no job.

    The counts stand right before the write, in the stage whose tasks count once however often they are tried.
    """

    def __init__(self, df: DataFrame, **more: Column):
        self._seen = Observation()
        self.frame = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in more.items()])

    def __getitem__(self, name: str):
        return self._seen.get[name]
