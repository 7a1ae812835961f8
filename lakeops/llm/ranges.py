"""Running values per key over a global order, where one key may hold any share of the rows.

Rows are range-partitioned and sorted by (key, order), so a large key is
spread over many tasks. Each task scans its rows once and stores running
values that begin anew in each partition; what earlier partitions hold of a
partition's first key (its carry) is composed from one row per partition.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(df: DataFrame, *by: str | Column) -> DataFrame:
    """``df`` range-partitioned and sorted by ``by``, with its partition's number as ``part``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())


class Runs:
    """Cuts the batches of one partition, sorted by key, into runs of equal keys; the last run stays open."""

    def __init__(self):
        self.key, self.row = None, 0

    def cut(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row of a batch (not empty): where its run starts in the batch, and whether it continues the open run."""
        new = np.empty(len(keys), bool)
        new[0] = self.key is None or keys[0] != self.key
        new[1:] = keys[1:] != keys[:-1]
        self.key = keys[-1]
        at = np.arange(len(keys))
        return np.maximum.accumulate(np.where(new, at, 0)), np.cumsum(new) == 0

    def rows(self, n: int) -> np.ndarray:
        """Numbers of the next ``n`` rows within the partition."""
        self.row += n
        return np.arange(self.row - n, self.row)


def running_sum(values: np.ndarray, start: np.ndarray, continues: np.ndarray, held: int) -> np.ndarray:
    """Inclusive running sums within runs; ``held`` is the open run's sum so far."""
    total = np.cumsum(values)
    total -= np.where(start > 0, total[start - 1], 0)
    total[continues] += held
    return total


def carries(rows: DataFrame, key: str, values: list[str], compose: Callable, row: str = "row") -> DataFrame | None:
    """``(part, key, c_<value>...)`` for the partitions whose first key began in an earlier one; None if none did.

    ``rows`` has ``part``, the row's number in it, a key without NULLs and
    inclusive running values; ``compose(before, after)`` joins the values of
    two neighbouring runs. One row per partition visits the driver.
    """
    ends = (rows.groupBy("part").agg(F.min_by(key, row).alias("first"), F.max_by(F.struct(key, *values), row).alias("last"))
            .orderBy("part").collect())
    held_key, held, found = None, None, []
    for end in ends:
        total = tuple(end["last"][v] for v in values)
        if held is not None and end["first"] == held_key:
            found.append((end["part"], held_key, *held))
            if end["last"][key] == held_key:
                total = compose(held, total)
        held_key, held = end["last"][key], total
    if not found:
        return None
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(["part int", f"{key} {kinds[key]}", *(f"c_{v} {kinds[v]}" for v in values)])
    return F.broadcast(rows.sparkSession.createDataFrame(found, schema))


__all__ = ["in_order", "Runs", "running_sum", "carries"]
