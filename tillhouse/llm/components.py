"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is an aggregate (lowest neighbour) and a join. The edge table never grows by more than the number of
vertices; a vertex with very many edges is summed in partial aggregates, and its join partition can be split by adaptive execution.
A step is written by as many tasks as its edges need, not by one per shuffle partition: each file costs a task folder and, on a local
file system, three helper processes that Hadoop starts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import settle, settle_counted

MOST_ROUNDS = 60
EDGES_OF_TASK = 250_000


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has a and b, integers. One row per vertex of an edge: id, component (the least id reachable).

    Loops and repeated edges are harmless; an edge with a null end is ignored; without edges there are no rows.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    vertices, seen = settle_counted(pairs.distinct(), F.count("*").alias("n"))
    n_tasks = max(1, -(-seen.get("n", 0) // EDGES_OF_TASK))
    now = vertices.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    for _ in range(MOST_ROUNDS):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = settle(small.union(least.select("a", "low")).where("a <> b").distinct().coalesce(n_tasks))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
    # every vertex but the least of its component now has one edge, to that least one
    labels = now.groupBy("a").agg(F.min("b").alias("component"))
    ids = vertices.select(F.col("a").alias("id")).union(vertices.select("b")).distinct()
    labelled = ids.join(labels, ids.id == labels.a, "left").select("id", F.coalesce("component", "id").alias("component"))
    return settle(labelled.coalesce(n_tasks))


def star_edges(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the least id of each component of a small symmetric adjacency matrix to its other members."""
    low, high = [], []
    open_ = linked.any(1)
    for first in np.flatnonzero(open_):
        if not open_[first]:
            continue
        inside = np.zeros(len(ids), bool)
        inside[first] = True
        front = np.array([first])
        while len(front):
            new = linked[front].any(0) & ~inside
            inside |= new
            front = np.flatnonzero(new)
        open_[inside] = False
        members = ids[inside]
        root = members.min()
        members = members[members != root]
        low.append(np.full(len(members), root))
        high.append(members)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *low]), np.concatenate([empty, *high])
