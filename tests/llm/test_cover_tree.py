"""Near vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tripforge.llm import cover_tree
from tripforge.llm.queries import QUERIES


def plain(rows, threshold=0.93):
    """vec_id, n_links, component of each of (vec_id, vector, label), by all pairs."""
    fine = [i for i, (name, v, label) in enumerate(rows) if name is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links: dict[int, set] = {i: set() for i in range(len(rows))}
    for n, i in enumerate(fine):
        a = np.array(rows[i][1]) / np.abs(rows[i][1]).max()
        for j in fine[n + 1 :]:
            if rows[i][2] == rows[j][2] and len(a) == len(rows[j][1]):
                b = np.array(rows[j][1]) / np.abs(rows[j][1]).max()
                if (a == b).all() or a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    root = {}
    for i in range(len(rows)):
        if i not in root:
            seen, todo = {i}, [i]
            while todo:
                for y in links[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
            least = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
            root |= dict.fromkeys(seen, least)
    return sorted(((str(rows[i][0]), len(links[i]), str(root[i]), rows[i][0] is None or root[i] == rows[i][0]) for i in range(len(rows))))


def groups(hit) -> int:
    left, n = set(range(len(hit))), 0
    while left:
        todo, n = [left.pop()], n + 1
        while todo:
            new = left & set(np.flatnonzero(hit[todo.pop()]).tolist())
            left -= new
            todo += new
    return n


def got(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def sample(seed, d, many):
    """Loose and dense groups around shared centres, chains, copies and multiples of copies."""
    rng = np.random.default_rng(seed)
    out = []
    for n, spread in many:
        middle = rng.standard_normal(d)
        out += [(middle + spread * rng.standard_normal(d)).tolist() for _ in range(n)]
    out += [out[0]] * 7 + [[2 * x for x in out[0]]] * 3
    return out


@pytest.mark.parametrize("d, many", [(3, [(200, 3.0)]), (8, [(150, 1.0), (120, 0.1), (80, 0.3), (60, 0.02)]), (64, [(300, 0.05), (200, 0.15), (100, 0.25), (100, 1.0)])])
def test_trees_against_all_pairs(d, many):
    x = cover_tree.unit(np.array(sample(3, d, many)))
    w = np.arange(1, len(x) + 1)
    half = len(x) // 2
    hit = x @ x.T >= 0.93
    tree = cover_tree.CoverTree(x, w)
    assert sorted(tree.order) == list(range(len(x)))
    for node, below in enumerate(tree.children):
        points = tree.x[tree.lo[node] : tree.hi[node]]
        assert np.sqrt(((points - tree.middle[node]) ** 2).sum(1)).max() <= tree.radius[node] + 1e-12
        if below is not None:
            assert sorted(np.concatenate([np.arange(tree.lo[c], tree.hi[c]) for c in below])) == list(range(tree.lo[node], tree.hi[node]))
    links, root = cover_tree.link_trees(tree, None, tree.x, None, 0.93)
    assert (links == (hit @ w)[tree.order]).all()
    near = hit[np.ix_(tree.order, tree.order)]
    assert all(root[i] == root[j] for i, j in zip(*np.nonzero(near))) and len(set(root)) == groups(hit)
    a, b = cover_tree.CoverTree(x[:half], w[:half]), cover_tree.CoverTree(x[half:], w[half:])
    links, root = cover_tree.link_trees(a, b, a.x, b.x, 0.93)
    order = np.concatenate([a.order, half + b.order])
    want = np.concatenate([hit[:half, half:] @ w[half:], hit[half:, :half] @ w[:half]])
    assert (links == want[order]).all()
    cut = hit.copy()
    cut[:half, :half] = cut[half:, half:] = False
    assert groups(cut | np.eye(len(x), dtype=bool)) == len(set(root))


@pytest.mark.parametrize("cell, block", [(4096, 4096), (40, 4096), (40, 25)])
def test_cells_and_tiles_against_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(cover_tree, "CELL", cell)
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    vectors = [(v, "a") for v in sample(5, 6, [(120, 1.5), (90, 0.05), (60, 0.3)])] + [(v, "b") for v in sample(6, 6, [(30, 0.2)])] + [(v, "c") for v in sample(7, 5, [(150, 0.02)])]
    rows = [(i * 3, v, label) for i, (v, label) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert got(cover_tree.near_vectors(df)) == plain(rows)


def test_odd_rows_and_extra_columns(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, [1e200, 2e200, 3e200], 1), (3, one, None), (4, one, 2), (None, one, 1), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, float("nan"), 3.0], 1),
        (8, [1.0, None, 3.0], 1), (9, [1.0, float("inf"), 3.0], 1), (10, [], 1), (11, [1.0, 2.0], 1), (12, [-0.0, 1.0, 0.0], 1), (13, [0.0, 1.0, 0.0], 1), (14, [-1.0, -2.0, -3.0], 1), (2, one, 1), (4, [3.0, -2.0, 1.0], 2),
    ]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, label int, cls int, h1 string")
    assert got(cover_tree.near_vectors(df)) == plain(rows)
    assert got(cover_tree.near_vectors(df.limit(0))) == []


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = got(QUERIES["op13_embedding_dedup"](spark, sf))
    assert found == plain(rows)
