"""Connected components of an edge list, by alternating star contraction.

Each round points every vertex's larger neighbours at its smallest one
("large star"), then the vertex and its smaller neighbours at the smallest
("small star"). Rounds are logarithmic in the longest chain, edges never
grow in number, every step is a minimum per vertex plus a join, and no
neighbour list is ever gathered. Every round is written to the shared
folder, so the plan stays short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def _smallest(edges: DataFrame) -> tuple[DataFrame, str]:
    """Per vertex ``u`` of the directed edges: its smallest neighbour, itself included. Stored, with its folder.

    A join of edges with their own aggregate would keep the aggregate's
    partitioning, and all edges of a hub in one task. Stored, both sides are
    plain shuffles: adaptive execution splits a hub's edges over many tasks,
    or moves none where the minima are few.
    """
    return written(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "smallest")


def _large_star(edges: DataFrame) -> tuple[DataFrame, str]:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low, path = _smallest(both)
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()), path


def _small_star(edges: DataFrame) -> tuple[DataFrame, str]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low, path = _smallest(down)
    linked = (down.join(low, "u").where("v <> m")
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return linked.unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), path


def _round(edges: DataFrame) -> tuple[DataFrame, str]:
    """The edges after a large and a small star, each stored; scratch tables in between are removed."""
    large, low_path = _large_star(edges)
    large, large_path = written(large, "edges")
    small, small_low = _small_star(large)
    done, path = written(small, "edges")
    drop(edges, low_path, large_path, small_low)
    return done, path


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every vertex of ``edges``; component = its smallest vertex.

    Vertices may be of any orderable type; edges may repeat, point either
    way or loop; edges with a NULL end are dropped. An empty edge list gives
    an empty result.
    """
    current, path = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                            .where("u is not null and v is not null and u <> v")
                            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                            .distinct(), "edges")
    state = _state(current)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        following, next_path = _round(current)
        seen, state = state, _state(following)
        drop(current, path)
        current, path = following, next_path
        if seen == state and _is_stars(current):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _is_stars(edges: DataFrame) -> bool:
    """Settled: no centre hangs on another vertex, and each vertex has one centre."""
    hanging = edges.select("v").join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    return hanging.limit(1).count() == 0
