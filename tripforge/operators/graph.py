"""Connected components of an edge table."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripforge.work import saved

LOG = logging.getLogger(__name__)
#: Edges that a task contracts at a time.
CONTRACTED = 500_000
#: Pairs of a node from which on its smallest neighbour is broadcast to them.
HUB = 100_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of up to about CONTRACTED rows as stars: each node with the smallest one that these edges reach."""
    parent: dict = {}
    kind = None

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def stars() -> pa.RecordBatch:
        nodes = list(parent)
        return pa.RecordBatch.from_arrays([pa.array([root(x) for x in nodes], kind), pa.array(nodes, kind)], ["a", "b"])

    held = 0
    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
        held += batch.num_rows
        if held >= CONTRACTED:
            yield stars()
            parent.clear()
            held = 0
    if parent:
        yield stars()


def _nearest(pairs: DataFrame, total: int) -> DataFrame:
    """(u, v, m) of `total` pairs (u, v): m is the smallest v of each u.

    A node of more than HUB pairs is found by the partial counts, and its smallest
    neighbour is broadcast to its pairs, so that they are not gathered in one task. There
    are fewer such nodes than pairs / HUB.
    """
    least = pairs.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if total <= HUB:
        return pairs.join(least, F.col("u") == F.col("of")).select("u", "v", "m")
    least = saved(least, "least")
    hubs = least.where(F.col("n") > HUB).select("of", "m")
    at_hubs = pairs.join(F.broadcast(hubs), F.col("u") == F.col("of")).select("u", "v", "m")
    others = pairs.join(F.broadcast(hubs.select("of")), F.col("u") == F.col("of"), "left_anti")
    return at_hubs.unionByName(others.join(least.where(F.col("n") <= HUB).select("of", "m"), F.col("u") == F.col("of")).select("u", "v", "m"))


def _settled(pairs: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """Distinct pairs (a, b) set down, and a number that stands for them."""
    told = Observation()
    # wide enough for sums of any number of hashes
    mark = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")]
    out = saved(pairs.distinct().observe(told, *mark), name)
    return out, (told.get["n"], told.get["sum"])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) with label the smallest node reachable; `edges` has columns a and b of one orderable type.

    Tasks first contract the edges that they hold to stars, which shortens paths. Then
    rounds of two steps follow until the edges stay as they are. In the first each node
    links its larger neighbours to the smallest of all its neighbours and itself; in the
    second, its smaller neighbours and itself to the smallest of them. Both keep the
    components, edges never grow in number, and paths shrink by about half a round, until
    every component is a star around its smallest node. Minima are partially aggregated
    group-bys; pairs of a node with very many go to them by a broadcast, so the centre of
    a large component is no single task's. Each step is written to the shared folder, and
    rounds are logged. No edges give an empty table. Self loops and repeated edges change
    nothing. Not reaching a fixed point in `max_rounds` raises.
    """
    pairs = edges.where("a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    contracted = saved(pairs.mapInArrow(_contract, pairs.schema), "contracted")
    now, mark = _settled(contracted.where("a < b"), "edges")
    for k in range(max_rounds):
        ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _nearest(now.select(F.explode(ends).alias("e")).select("e.u", "e.v"), 2 * mark[0]).where("v > u").select(F.least("m", "u").alias("a"), F.col("v").alias("b"))
        linked, (n, _) = _settled(large, "linked")
        small = _nearest(linked.select(F.col("b").alias("u"), F.col("a").alias("v")), n)
        both = F.array(F.struct(F.col("m").alias("a"), F.col("u").alias("b")), F.struct(F.col("m").alias("a"), F.col("v").alias("b")))
        was = mark
        now, mark = _settled(small.select(F.explode(both).alias("e")).select("e.a", "e.b").where("a < b"), "edges")
        LOG.info("round %d: %d edges, %s", k + 1, mark[0], "settled" if mark == was else "changed")
        if mark == was:
            # of nodes with loops alone, and of centres, the contracted edges have the names
            nodes = contracted.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            return nodes.join(now.toDF("label", "of"), F.col("node") == F.col("of"), "left").select("node", F.coalesce("label", "node").alias("label"))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
