"""Last-writer-wins registers: state that carries the order of what it holds.

A register is ``struct(o, v)``, the order of a record and a value taken from it. The greater
register wins (the lesser one, for first-seen values), so merging is commutative,
associative and idempotent: batches may come late, twice or cut up in any way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_order() -> Column:
    """Where a record stands: its page and its place there."""
    return F.struct("file_name", "pos")


def register(value: Column, order: Column | None = None) -> Column:
    """A record's register; NULL where it has no value."""
    return F.when(value.isNotNull(), F.struct(
        (record_order() if order is None else order).alias("o"), value.alias("v")))


def merge(state: DataFrame | None, batch: DataFrame, key: str, first: bool = False) -> DataFrame:
    """Both sides' registers, the later (with ``first`` the earlier) of each; one row a key on
    both sides."""
    if state is None:
        return batch
    names = [c for c in batch.columns if c != key]
    old = state.select(key, *(F.col(c).alias(f"_old_{c}") for c in names))
    pick = F.least if first else F.greatest
    return batch.join(old, key, "full_outer").select(
        key, *(pick(F.col(c), F.col(f"_old_{c}")).alias(c) for c in names))


def values(registers: DataFrame, key: str) -> DataFrame:
    """What the registers hold, without the order."""
    return registers.select(key, *(F.col(f"{c}.v").alias(c) for c in registers.columns if c != key))
