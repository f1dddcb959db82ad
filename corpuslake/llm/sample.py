"""Bounded, repeatable samples for fitting models, and short Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def in_share(key: Column, share: float) -> Column:
    """Whether the hash of key lies in the first share of all hashes: the same
    rows on every run, decided row by row, and nested for growing shares."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_003)) < F.lit(int(min(1.0, share) * 1_000_003) + 1)


def share_of(df: DataFrame, key: str, most: int) -> float:
    """The share that gives about `most` rows; the count reads only the key."""
    return min(1.0, most / max(df.where(F.col(key).isNotNull()).count(), 1))


def slices(batches, rows: int = 1000):
    """The batches cut to at most so many rows, so that what a worker keeps of
    a batch in Python is bounded by rows and not by the engine's batch size."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
