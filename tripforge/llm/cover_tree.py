"""Embedding near-dedup: all pairs at or above a cosine, by dual traversal of cover trees.

On unit vectors a cosine of c is a distance of sqrt(2 - 2c), so pairs above a
cosine are pairs within a radius t. Balls of covering radius p and q around
centres at distance d hold no such pair if d > t + p + q, and only such pairs if
d + p + q <= t.

1. Equal vectors of a label become one class with a weight.
2. The upper levels of the tree are nets of halving radii over a bounded sample of
   each large label; every class goes to the cell of its nearest centre, and the
   cells' covering radii are measured on all of them.
3. A class is sent to another cell's ball if the ball can hold a partner of it, and
   two cells meet only if both have classes to send. A cell of a radius up to t / 2
   is linked as a whole and is not compared with itself.
4. Cells meet in tiles of bounded size, a task each. A tile builds the lower levels
   of its two trees, nested nets with halving radii, and walks both at once: pairs
   of nodes are pruned, linked as a whole (weights are added to ranges, without
   listing pairs), or opened. What is undecided at the leaves is measured.
5. A tile gives each class's linked weight and the root of its links, so that the
   edges that go to the components number its classes at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.operators.graph import connected_components
from tripforge.work import saved

#: Classes of a cell, about, as long as no more than MOST_CELLS cells are needed; larger tables have larger cells.
CELL, MOST_CELLS = 4_096, 16_384
#: Sampled vectors for each cell, from which the centres are taken. All vectors are placed and compared.
SAMPLED = 8
#: Classes on either side of a tile.
BLOCK = 4_096
#: Children of no more points are taken apart into these; balls of a radius under TINY are leaves.
LEAF, TINY = 12, 1e-7
#: By which distances of unit vectors in double precision may be off.
SLACK = 1e-6
#: Rows of a matrix of distances that are held at a time.
ROWS = 512


def unit(v: np.ndarray) -> np.ndarray:
    """Vectors at length 1; components of any finite size."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def leaders(x: np.ndarray, radius: float, most: int | None = None, chosen: list[int] | None = None) -> tuple[list[int], np.ndarray]:
    """A net: points further than `radius` from each other, with those `chosen` before, and for each point the number of one within `radius` (-1 if `most` were found first)."""
    net = list(chosen or [0])
    own = np.full(len(x), -1)
    for at in range(0, len(x), 256):
        block = np.arange(at, min(len(x), at + 256))
        away = _distance(x[block], x[net])
        near = away.argmin(1)
        close = away[np.arange(len(block)), near] <= radius
        own[block[close]] = near[close]
        left = block[~close]
        while len(left) and (most is None or len(net) < most):
            net.append(int(left[0]))
            # by the difference, which is exactly 0 for the point itself
            close = np.sqrt(((x[left] - x[left[0]]) ** 2).sum(1)) <= radius
            own[left[close]] = len(net) - 1
            left = left[~close]
    return net, own


def net_of(sample: np.ndarray, most: int, t: float) -> np.ndarray:
    """Up to `most` centres for cells: nested nets with radii from 1 down, none closer than t / 4."""
    chosen, radius = [0], 1.0
    while len(chosen) < most and radius >= t / 4:
        chosen, _ = leaders(sample, radius, most, chosen)
        radius /= 2
    return sample[chosen]


class CoverTree:
    """Nested nets with halving radii over unit vectors. Nodes are ranges of `order`; each has a centre, a measured covering radius and children, among them one with its own centre."""

    def __init__(self, x: np.ndarray, weight: np.ndarray) -> None:
        self.order = np.zeros(len(x), np.int64)
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.radius: list[float] = []
        self.centre: list[int] = []
        self.children: list[np.ndarray | None] = []
        filled = 0
        todo = [(np.arange(len(x)), 2.0, -1)]
        below: dict[int, list[int]] = {}
        while todo:
            points, level, parent = todo.pop()
            away = np.sqrt(((x[points] - x[points[0]]) ** 2).sum(1))
            radius, node = float(away.max()), len(self.lo)
            self.centre.append(int(points[0]))
            self.radius.append(radius)
            self.lo.append(filled)
            self.hi.append(filled + len(points))
            self.children.append(None)
            if parent >= 0:
                below.setdefault(parent, []).append(node)
            while level >= radius > TINY:
                level /= 2
            if len(points) == 1 or radius <= TINY:
                self.order[filled : filled + len(points)] = points
                filled += len(points)
                continue
            net, own = leaders(x[points], level)
            by = np.argsort(own, kind="stable")
            cuts = np.flatnonzero(np.diff(own[by], prepend=-1))
            # children are popped, and so numbered and laid out, one whole subtree after the other
            for part in np.split(by, cuts[1:]):
                if len(part) <= LEAF:
                    todo += [(points[p : p + 1], level, node) for p in part]
                    continue
                head = net[own[part[0]]]
                todo.append((points[np.concatenate([[head], part[part != head]])], level, node))
        for node, own_children in below.items():
            self.children[node] = np.array(own_children)
        self.lo, self.hi, self.radius, self.centre = np.array(self.lo), np.array(self.hi), np.array(self.radius), np.array(self.centre)
        self.x, self.weight = x[self.order], weight[self.order].astype(np.int64)
        self.middle = x[self.centre]
        total = np.concatenate([[0], np.cumsum(self.weight)])
        self.heavy = total[self.hi] - total[self.lo]


class _Links:
    """Linked weight and connected points, for ranges at a time."""

    def __init__(self, n: int) -> None:
        self.delta = np.zeros(n + 1, np.int64)
        self.root = np.arange(n)

    def add(self, lo, hi, weight) -> None:
        np.add.at(self.delta, lo, weight)
        np.add.at(self.delta, hi, -weight)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def join_range(self, lo: int, hi: int) -> None:
        if hi - lo > 1:
            self.join(np.arange(lo + 1, hi), np.full(hi - lo - 1, lo))


def link_trees(a: CoverTree, b: CoverTree | None, raw_a: np.ndarray, raw_b: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked weight and root of each point of a and then of b (of a alone, against itself, if b is None), in the trees' order. `raw` are the vectors that borderline pairs are measured on, in the trees' order."""
    t, shift = math.sqrt(2 - 2 * threshold), 0 if b is None else len(a.x)
    links = _Links(len(a.x) + (0 if b is None else len(b.x)))
    other, raw_other = (a, raw_a) if b is None else (b, raw_b)
    whole: set[tuple[int, int]] = set()

    def mark(lo: np.ndarray, hi: np.ndarray) -> None:
        several = hi - lo > 1
        whole.update(zip(lo[several].tolist(), hi[several].tolist()))

    def linked(i: np.ndarray, j: np.ndarray, same: bool) -> None:
        """Nodes i of a and j of the other tree, linked as a whole; `same` pairs are of a node with itself."""
        links.add(a.lo[i], a.hi[i], other.heavy[j])
        if not same:
            links.add(other.lo[j] + shift, other.hi[j] + shift, a.heavy[i])
        links.join(a.lo[i], other.lo[j] + shift)
        mark(a.lo[i], a.hi[i])
        mark(other.lo[j] + shift, other.hi[j] + shift)

    def measure(i: int, j: int) -> None:
        p, q = np.arange(a.lo[i], a.hi[i]), np.arange(other.lo[j], other.hi[j])
        for k in range(0, len(p), ROWS):
            cosine = a.x[p[k : k + ROWS]] @ other.x[q].T
            for r, c in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-9)):
                u, v = raw_a[p[k + r]], raw_other[q[c]]
                cosine[r, c] = float(np.dot(u, v)) / (math.sqrt(float(np.dot(u, u))) * math.sqrt(float(np.dot(v, v))))
            hit = cosine >= threshold
            if b is None and i == j:
                hit[np.arange(len(hit)), k + np.arange(len(hit))] = True
            r, c = np.nonzero(hit)
            np.add.at(links.delta, p[k + r], other.weight[q[c]])
            np.add.at(links.delta, p[k + r] + 1, -other.weight[q[c]])
            if b is not None or i != j:
                np.add.at(links.delta, q[c] + shift, a.weight[p[k + r]])
                np.add.at(links.delta, q[c] + shift + 1, -a.weight[p[k + r]])
            links.join(p[k + r], q[c] + shift)

    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if b is None and i == j and 2 * a.radius[i] + SLACK <= t:
            linked(np.array([i]), np.array([i]), True)
            continue
        left, right = a.children[i], other.children[j]
        if left is None and right is None:
            measure(i, j)
            continue
        if b is None and i == j:
            close = 2 * a.radius[left] + SLACK <= t
            linked(left[close], left[close], True)
            todo += [(int(k), int(k)) for k in left[~close]]
        if left is None or right is not None and not (b is None and i == j) and other.radius[j] > 2 * a.radius[i]:
            left = np.array([i])
        elif right is None or not (b is None and i == j) and a.radius[i] > 2 * other.radius[j]:
            right = np.array([j])
        for k in range(0, len(left), ROWS):
            own = left[k : k + ROWS]
            cosine = a.middle[own] @ other.middle[right].T
            reach = a.radius[own][:, None] + other.radius[right][None, :]
            open_ = cosine >= 1 - (t + reach + SLACK) ** 2 / 2
            if b is None and i == j:
                open_ &= own[:, None] < right[None, :]
            r, c = np.nonzero(open_)
            if not len(r):
                continue
            rest = t - reach[r, c] - SLACK
            sure = (rest > 0) & (cosine[r, c] >= 1 - np.maximum(rest, 0) ** 2 / 2)
            if sure.any():
                linked(own[r[sure]], right[c[sure]], False)
            todo += zip(own[r[~sure]].tolist(), right[c[~sure]].tolist())
    for lo, hi in whole:
        links.join_range(lo, hi)
    return np.cumsum(links.delta)[:-1], links.root


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)


def _compare(threshold: float):
    """One tile: (cls, links, root) of its classes."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, cls, w = (table[k].to_numpy() for k in ("side", "cls", "w"))
        raw = _matrix(table["v"], table["d"][0].as_py())
        raw = raw / np.abs(raw).max(1, keepdims=True)
        x = unit(raw)
        parts = [np.flatnonzero(side == k) for k in (0, 1)]
        at = table["a"][0].as_py() == table["b"][0].as_py() and table["i"][0].as_py() == table["j"][0].as_py()
        if not len(parts[0]) or not at and not len(parts[1]):
            return pa.table({"cls": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        trees = [CoverTree(x[p], w[p]) for p in parts if len(p)]
        order = np.concatenate([p[tree.order] for p, tree in zip(parts, trees)])
        raws = [raw[p][tree.order] for p, tree in zip(parts, trees)]
        links, root = link_trees(trees[0], None if at else trees[1], raws[0], None if at else raws[1], threshold)
        some = links > 0
        return pa.table({"cls": cls[order][some], "links": links[some], "root": cls[order][root[some]]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null, their lengths are
    equal, and their cosine in double precision is `threshold` or more; equal vectors
    of a label always are. n_links counts the other vectors that a vector is linked
    with; component_id is the smallest id that links reach, its own included; kept
    says whether it is the row's own.

    Vectors that are null, empty or zero, or hold null or non-finite components, link
    with nothing, as do rows with a null id, which stay with a null component. Rows that
    repeat an id are rows like any other: each counts as a partner, and an id alone
    links nothing. Other columns, whatever their names, are ignored; an empty table
    gives an empty table. Centres of cells are taken from a bounded sample; every
    vector is placed and compared, and no pair is missed.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must be between 0 and 1")
    spark, t = vectors.sparkSession, math.sqrt(2 - 2 * threshold)
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"), F.col(label_col).cast("string").alias("label"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    # 128 bits stand for a label and vector where rows find their class again
    key = [F.when(fine, F.xxhash64(F.lit(k), "label", "v")).alias(f"h{k}") for k in (1, 2)]
    rows = base.select("vec_id", "label", "v", *key)
    classes = rows.where("h1 is not null").groupBy("h1", "h2", "label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("w"))
    classes = saved(classes.select("h1", "h2", F.monotonically_increasing_id().alias("cls"), "id", "w", "label", F.size("v").alias("d"), "v"), "classes")

    total = classes.count()
    cell = max(CELL, -(-total // MOST_CELLS))
    sizes = classes.groupBy("label", "d").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    cells = sizes.select(F.col("label").alias("of"), F.col("d").alias("of_d"), F.expr(f"cast(ceil(n / {cell}) as int)").alias("cells"), (F.least(F.lit(1.0), F.lit(SAMPLED / cell) + F.lit(SAMPLED) / F.col("n")) * (1 << 30)).cast("long").alias("share"))
    # a row for each label of more classes than a cell, fewer than MOST_CELLS
    drawn = classes.join(F.broadcast(cells), (F.col("label") == F.col("of")) & (F.col("d") == F.col("of_d"))).where(F.pmod(F.xxhash64("cls"), F.lit(1 << 30)) < F.col("share"))

    def pick(table: pa.Table) -> pa.Table:
        d = table["d"][0].as_py()
        net = net_of(unit(_matrix(table["v"], d)), table["cells"][0].as_py(), t)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(net) + 1) * d, pa.int32()), pa.array(net.ravel()))
        return pa.table({"label": pa.array([table["label"][0].as_py()] * len(net), pa.string()), "d": pa.array([d] * len(net), pa.int32()), "v": lists})

    found: dict[tuple[str, int], list] = {}
    for r in drawn.select("label", "d", "v", "cells").groupBy("label", "d").applyInArrow(pick, "label string, d int, v array<double>").toArrow().to_pylist():
        found.setdefault((r["label"], r["d"]), []).append(r["v"])
    centres = spark.sparkContext.broadcast({k: np.array(v) for k, v in found.items()})

    def placed(batches: Iterator[pa.RecordBatch], radii: dict | None) -> Iterator[pa.RecordBatch]:
        """Adds each class's cell and its distance from the centre or, given radii, the other cells that may hold partners."""
        for batch in (x.slice(k, ROWS) for x in batches for k in range(0, x.num_rows, ROWS)):
            labels, d = batch.column("label").to_pylist(), batch.column("d").to_numpy()
            # a label without centres is one cell, of the radius of the sphere
            own, away = np.zeros(batch.num_rows, np.int32), np.full(batch.num_rows, 2.0)
            reach: list[np.ndarray] = [np.zeros(0, np.int32)] * batch.num_rows
            groups: dict[tuple[str, int], list[int]] = {}
            for i, k in enumerate(zip(labels, d.tolist())):
                if k in centres.value:
                    groups.setdefault(k, []).append(i)
            for k, of in groups.items():
                far = _distance(unit(_matrix(batch.column("v").take(pa.array(of)), k[1])), centres.value[k])
                own[of] = far.argmin(1)
                away[of] = far.min(1)
                if radii is not None:
                    may = far <= radii[k][None, :] + t + SLACK
                    may[np.arange(len(of)), own[of]] = False
                    for i, row in zip(of, may):
                        reach[i] = np.flatnonzero(row).astype(np.int32)
            if radii is None:
                yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("w"), batch.column("label"), batch.column("d"), pa.array(own), pa.array(away)], ["cls", "w", "label", "d", "cell", "away"])
                continue
            at = np.concatenate([[0], np.cumsum([len(x) for x in reach])])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cls", "w", "label", "d", "v")), pa.array(own), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(reach)))], ["cls", "w", "label", "d", "v", "cell", "reach"])

    thin = classes.select("cls", "w", "label", "d", "v")
    first = thin.mapInArrow(lambda batches: placed(batches, None), "cls long, w long, label string, d int, cell int, away double")
    parts = saved(first.groupBy("label", "d", "cell").agg(F.count("*").alias("n"), F.sum("w").alias("weight"), F.max("away").alias("radius"), F.min("cls").alias("head")), "cells")
    split = F.broadcast(cells.select("of", "of_d"))
    radii = {k: np.zeros(len(v)) for k, v in centres.value.items()}
    for r in parts.join(split, (F.col("label") == F.col("of")) & (F.col("d") == F.col("of_d"))).select("label", "d", "cell", "radius").toLocalIterator():
        if (r.label, r.d) in radii:
            radii[r.label, r.d][r.cell] = r.radius
    known = spark.sparkContext.broadcast(radii)
    cellwise = saved(thin.mapInArrow(lambda batches: placed(batches, known.value), f"cls long, w long, label string, d int, v array<{kind}>, cell int, reach array<int>"), "placed")

    parts = parts.withColumn("closed", 2 * F.col("radius") + 2 * SLACK <= t)
    met = cellwise.select("label", "d", "cell", F.explode("reach").alias("other")).groupBy("label", "d", F.least("cell", "other").alias("a"), F.greatest("cell", "other").alias("b"))
    met = met.agg(F.count_if(F.col("cell") < F.col("other")).alias("na"), F.count_if(F.col("cell") > F.col("other")).alias("nb")).where("na > 0 and nb > 0")
    alone = parts.where("not closed").select("label", "d", F.col("cell").alias("a"), F.col("cell").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"))
    blocks = lambda n: F.expr(f"cast(ceil({n} / {BLOCK}) as int)")
    grid = saved(met.unionByName(alone).select("label", "d", "a", "b", blocks("na").alias("qa"), blocks("nb").alias("qb")), "grid")

    sides = cellwise.select("cls", "w", "label", "d", "v", "cell", F.explode(F.concat("reach", F.array("cell"))).alias("other"))
    sides = sides.select("cls", "w", "label", "d", "v", F.least("cell", "other").alias("a"), F.greatest("cell", "other").alias("b"), F.when(F.col("cell") > F.col("other"), 1).otherwise(0).alias("side"))
    tiled = sides.join(grid, ["label", "d", "a", "b"])
    own = F.pmod(F.xxhash64("cls"), F.when(F.col("side") == 0, F.col("qa")).otherwise(F.col("qb"))).cast("int")
    tiled = tiled.withColumn("own", own).withColumn("to", F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("qb")).otherwise(F.col("qa")) - 1)))
    same = F.col("a") == F.col("b")
    i = F.when(same, F.least("own", "to")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("to"))
    j = F.when(same, F.greatest("own", "to")).when(F.col("side") == 0, F.col("to")).otherwise(F.col("own"))
    tiles = tiled.select("label", "d", "a", "b", i.alias("i"), j.alias("j"), F.when(same, (F.col("own") > F.col("to")).cast("int")).otherwise(F.col("side")).alias("side"), "cls", "w", "v")
    compared = tiles.groupBy("label", "d", "a", "b", "i", "j").applyInArrow(_compare(threshold), "cls long, links long, root long")
    whole = parts.where("closed").select(F.col("label").alias("of"), F.col("d").alias("of_d"), F.col("cell").alias("at"), "weight", "head")
    inside = cellwise.join(F.broadcast(whole), (F.col("label") == F.col("of")) & (F.col("d") == F.col("of_d")) & (F.col("cell") == F.col("at"))).select("cls", F.col("weight").alias("links"), F.col("head").alias("root"))
    linked = saved(compared.unionByName(inside), "linked")

    roots = connected_components(linked.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    mine = saved(classes.select("h1", "h2", "cls", "id").join(counts, "cls").join(roots, F.col("cls") == F.col("node"), "left").select("h1", "h2", "id", "links", "label"), "mine")
    names = mine.where("label is not null").groupBy(F.col("label").alias("root")).agg(F.min("id").alias("least"))
    known_as = mine.join(names, F.col("label") == F.col("root"), "left").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), (F.col("links") - 1).alias("n_links"), F.coalesce("least", "id").alias("least"))
    out = rows.select("vec_id", "h1", "h2").join(known_as, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    component = F.coalesce("least", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
