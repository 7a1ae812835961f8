"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import delete_path, scratch_path

# white space of the contracts: space, tab, LF, VT, FF, CR
ASCII_SPACE = "[\\x20\\x09-\\x0D]+"

# rows handed to Python code at a time, whatever the size of the Arrow batch
SLICE_ROWS = 256


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(column: Column) -> Column:
    return column.cast("binary")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs the tasks since this table, not
    the whole job. Returns the reread frame and its folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    for held in _scopes[-1:]:
        held.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the tables that ``written`` stores inside the block, at its end; take out what must stay.

    Results are lazy and read those tables: write a result inside the block.
    """
    held: list[str] = []
    _scopes.append(held)
    try:
        yield held
    finally:
        _scopes.remove(held)
        for path in held:
            delete_path(spark, path)


BROADCAST_KEYS = 500_000          # rows of an id and a digest, about 20 MB


def few_or_shuffled(keys: DataFrame) -> DataFrame:
    """A written table of keys, marked for broadcast if it is counted to be small; else joins shuffle both sides."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys.hint("merge")


def drop(df: DataFrame, *paths: str) -> None:
    for path in paths:
        delete_path(df.sparkSession, path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Views of a bounded number of rows each."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slices_by_bytes(batches: Iterable[pa.RecordBatch], column: int, size: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Views whose strings in ``column`` have about ``size`` bytes together (one longer string stands alone)."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            until = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, until - at)
            at, done = until, int(ends[until - 1])


class Memo(dict):
    """A dictionary that fills itself with ``make(key)`` until it is full; early keys are the frequent ones."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.limit:
            self[key] = value
        return value
