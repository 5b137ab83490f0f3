"""Approximate nearest neighbours: inverted lists scanned with adaptive dimension sampling.

Vectors are rotated at random, so that any leading block of their columns is an
unbiased sample of the distance. A query scans its nearest lists' candidates
column block by column block; after k of d columns a candidate is abandoned
when partial * d / k > threshold * (1 + EPSILON / sqrt(k))^2, a test of the
hypothesis that its distance is below the current tenth-best. What is left is
measured on the original vectors in double precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.work import saved

#: Vectors that centroids and the number of probes are fitted on, about: PER_LIST for each of as many lists as the root of the table, from SAMPLE to MOST_SAMPLE. All vectors are indexed.
SAMPLE, MOST_SAMPLE, PER_LIST = 20_000, 400_000, 20
#: Sampled vectors that one process fits by itself; more are fitted in tasks, which send sums back. Rounds of fitting, and queries on which probes are fitted.
ALONE, ROUNDS, ASKED = 65_536, 8, 400
#: Columns of a block, and the strictness of the abandonment test.
COLUMNS, EPSILON = 16, 2.1
#: Candidates and queries that one task compares at a time.
CANDIDATES, QUERIES_AT_ONCE = 4_096, 512
#: Vectors, and distances to centroids, that are held at a time.
ROWS, DISTANCES = 2_048, 4_000_000
#: Share of true neighbours within the probed lists that the fit asks for, on the sample.
COVERAGE = 0.97


@dataclass
class Lists:
    centroids: np.ndarray
    rotation: np.ndarray
    probes: int

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """List numbers of each vector, nearest first."""
        return np.argsort(_squares(vectors, self.centroids), axis=1, kind="stable")


def _nearest_list(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector, in blocks of bounded size."""
    step = max(1, min(ROWS, DISTANCES // len(centroids)))
    return np.concatenate([_squares(vectors[k : k + step], centroids).argmin(1) for k in range(0, max(1, len(vectors)), step)])


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, in double precision, which holds those of any floats."""
    a, b = a.astype(np.float64, copy=False), b.astype(np.float64, copy=False)
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :]


def _lists(n: int, total: int) -> int:
    return int(np.clip(round(math.sqrt(total)), 1, max(1, n // PER_LIST)))


def _rotation(d: int, rng: np.random.Generator) -> np.ndarray:
    return np.linalg.qr(rng.standard_normal((d, d)))[0]


def _sums(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists that vectors are nearest to, how many are, and their sums."""
    own = _nearest_list(vectors, centroids)
    order = np.argsort(own, kind="stable")
    first = np.flatnonzero(np.diff(own[order], prepend=-1))
    return own[order][first], np.diff(np.append(first, len(own))), np.add.reduceat(vectors[order].astype(np.float64), first, axis=0)


def _probes(ranks: np.ndarray) -> int:
    """Lists to probe, from the places that the lists of true neighbours have among a query's lists."""
    depth = np.sort(ranks.ravel()) if ranks.size else np.zeros(1, int)
    return int(depth[min(len(depth) - 1, int(COVERAGE * len(depth)))]) + 1


def _places(asked: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The place of each list among the lists of each of `asked`, nearest first."""
    order = np.argsort(_squares(asked, centroids), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centroids))[None, :].repeat(len(asked), 0), 1)
    return rank


def _fit(sample: np.ndarray, total: int, k: int, seed: int = 13) -> Lists:
    rng = np.random.Generator(np.random.PCG64(seed))
    rotation = _rotation(sample.shape[1], rng)
    centroids = sample[rng.choice(len(sample), _lists(len(sample), total), replace=False)].astype(np.float64)
    for _ in range(ROUNDS):
        own, n, sums = _sums(sample, centroids)
        centroids[own] = sums / n[:, None]
    own = _nearest_list(sample, centroids)
    asked = rng.choice(len(sample), min(ASKED, len(sample)), replace=False)
    rank, near = _places(sample[asked], centroids), []
    for at, i in enumerate(asked):
        away = _squares(sample[i : i + 1], sample)[0]
        away[i] = np.inf
        few = min(k, len(sample) - 1)
        near.append(rank[at, own[np.argpartition(away, few - 1)[:few]]] if few else np.zeros(0, int))
    return Lists(centroids, rotation, _probes(np.array(near)))


def _fit_in_tasks(sample: DataFrame, n: int, total: int, d: int, k: int, seed: int = 13) -> Lists:
    """`_fit` of a table (h, v) of n sampled vectors, h a number of the row: every round is a job whose tasks send sums of lists, and neighbours are the nearest of each task's nearest."""
    spark = sample.sparkSession
    rotation = _rotation(d, np.random.Generator(np.random.PCG64(seed)))
    centroids = _vectors(sample.orderBy("h").limit(_lists(n, total)).select("v").toArrow().column(0), d).astype(np.float64)
    parts = max(1, min(len(centroids), spark.sparkContext.defaultParallelism))

    def rows(own: np.ndarray, many: np.ndarray, sums: np.ndarray, *first: pa.Array) -> list[pa.Array]:
        return [*first, pa.array(own, pa.int32()), pa.array(many, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * d, pa.int32()), pa.array(sums.ravel()))]

    def step(shared):
        def run(batches):
            sums, many = np.zeros((len(shared.value), d)), np.zeros(len(shared.value), np.int64)
            for batch in batches:
                if batch.num_rows:
                    own, some, added = _sums(_vectors(batch.column(0), d), shared.value)
                    sums[own] += added
                    many[own] += some
            own = np.flatnonzero(many)
            yield pa.RecordBatch.from_arrays(rows(own, many[own], sums[own], pa.array(own % parts, pa.int32())), ["part", "list", "n", "s"])

        return run

    def add(table: pa.Table) -> pa.Table:
        own, where = np.unique(table["list"].to_numpy(), return_inverse=True)
        sums, many = np.zeros((len(own), d)), np.zeros(len(own), np.int64)
        np.add.at(sums, where, _vectors(table["s"], d))
        np.add.at(many, where, table["n"].to_numpy())
        return pa.table(rows(own, many, sums), names=["list", "n", "s"])

    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(centroids)
        moved = sample.select("v").mapInArrow(step(shared), "part int, list int, n long, s array<double>").groupBy("part").applyInArrow(add, "list int, n long, s array<double>").toArrow()
        centroids = centroids.copy()
        centroids[moved.column("list").to_numpy()] = _vectors(moved.column("s"), d) / moved.column("n").to_numpy()[:, None]
        shared.destroy()

    few = sample.orderBy(F.xxhash64("h")).limit(ASKED).toArrow()
    asked, names = _vectors(few.column("v"), d), few.column("h").to_numpy()
    both = spark.sparkContext.broadcast((centroids, asked, names))

    def near(batches):
        centroids, asked, names = both.value
        away, own = np.full((len(asked), 0), np.inf), np.zeros((len(asked), 0), np.int64)
        for batch in (x.slice(j, ROWS) for x in batches for j in range(0, x.num_rows, ROWS)):
            v = _vectors(batch.column(1), d)
            far = _squares(asked, v)
            far[names[:, None] == batch.column(0).to_numpy()[None, :]] = np.inf
            away, own = np.concatenate([away, far], 1), np.concatenate([own, np.broadcast_to(_nearest_list(v, centroids), far.shape)], 1)
            if away.shape[1] > k:
                best = np.argpartition(away, k - 1, axis=1)[:, :k]
                away, own = np.take_along_axis(away, best, 1), np.take_along_axis(own, best, 1)
        query = np.repeat(np.arange(len(asked)), away.shape[1])
        fine = np.isfinite(away.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(query[fine], pa.int32()), pa.array(away.ravel()[fine]), pa.array(own.ravel()[fine], pa.int32())], ["query", "away", "list"])

    # k rows for each of ASKED queries and each task
    best = sample.select("h", "v").mapInArrow(near, "query int, away double, list int").toArrow()
    query, away, own = (best.column(c).to_numpy() for c in ("query", "away", "list"))
    order = np.lexsort((away, query))
    query, own = query[order], own[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    rank = _places(asked, centroids)
    return Lists(centroids, rotation, _probes(rank[query[place < k], own[place < k]]))


def _scan(queries: np.ndarray, candidates: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, rotation: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best of one block of candidates for each query, with early abandonment."""
    d = candidates.shape[1]
    exact = candidates.astype(np.float64)
    turned, asked = exact @ rotation, queries.astype(np.float64) @ rotation
    blocks = [(a, np.ascontiguousarray(turned[:, a : a + COLUMNS])) for a in range(0, d, COLUMNS)]
    out_q, out_v, out_s = [], [], []
    for i, q in enumerate(queries):
        q64 = q.astype(np.float64)
        best_d, best_v = np.zeros(0), np.zeros(0, np.int64)
        begin, step = 0, 64
        while begin < len(ids):
            alive = np.arange(begin, min(len(ids), begin + step))
            alive = alive[ids[alive] != query_ids[i]]
            bound = float(best_d[k - 1]) ** 2 if len(best_d) >= k else math.inf
            partial = np.zeros(len(alive))
            for a, block in blocks:
                partial = partial + ((block[alive] - asked[i, a : a + COLUMNS]) ** 2).sum(1)
                seen = min(a + COLUMNS, d)
                if bound < math.inf:
                    keep = partial * (d / seen) <= bound * (1 + EPSILON / math.sqrt(seen)) ** 2 + 1e-6 if seen < d else partial <= bound * 1.0001 + 1e-6
                    alive, partial = alive[keep], partial[keep]
                    if not len(alive):
                        break
            if len(alive):
                score = np.sqrt(((exact[alive] - q64) ** 2).sum(1))
                best_d, best_v = np.concatenate([best_d, score]), np.concatenate([best_v, ids[alive]])
                order = np.lexsort((best_v, best_d))[:k]
                best_d, best_v = best_d[order], best_v[order]
            begin, step = begin + step, 1024
        out_q += [query_ids[i]] * len(best_v)
        out_v += best_v.tolist()
        out_s += best_d.tolist()
    return out_q, out_v, out_s


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest by Euclidean distance found for each query: query_id, rank, vec_id, score.

    `is_query(column)` selects queries by id; candidates are all rows with
    another id. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do those of another than the most frequent
    length (the longer of equally frequent ones). Rows with a null id take no
    part; of rows that repeat an id each is a candidate, and the least vector is
    the query. Equal distances go to
    the smaller id. A query with fewer candidates gets all that there are; an
    empty table gives an empty table. Floats stay floats, vectors of other numbers
    are taken as doubles; finite components of any size that a float holds are
    told apart. Centroids and probes are fitted on a bounded sample; every vector
    is indexed.
    """
    spark = vectors.sparkSession
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(fine)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = "query_id long, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, total = lengths.d, lengths.n
    rows = rows.where(F.size("v") == d)
    share = int(min(1.0, np.clip(PER_LIST * math.sqrt(total), SAMPLE, MOST_SAMPLE) / total) * (1 << 30))
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) < share).select(F.xxhash64("vec_id").alias("h"), "v")
    if total * share / (1 << 30) > ALONE:
        drawn = saved(drawn, "sample")
        fitted = _fit_in_tasks(drawn, drawn.count(), total, d, k)
    else:
        sample = _vectors(drawn.orderBy("h").select("v").toArrow().column(0), d)
        fitted = _fit(sample if len(sample) else _vectors(rows.limit(1).select("v").toArrow().column(0), d), total, k)
    lists = spark.sparkContext.broadcast(fitted)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                own = _nearest_list(_vectors(batch.column(1), d), lists.value.centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.astype(np.int32))], ["vec_id", "v", "list"])

    indexed = saved(rows.mapInArrow(assign, f"vec_id long, v array<{kind}>, list int"), "indexed")
    sizes = {r.list: r.n for r in indexed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    amounts = np.array([sizes.get(j, 0) for j in range(len(lists.value.centroids))])

    def probe(batches):
        own = lists.value
        step = max(1, min(ROWS, DISTANCES // len(own.centroids)))
        for batch in (x.slice(k, step) for x in batches for k in range(0, x.num_rows, step)):
            order = own.nearest(_vectors(batch.column(1), d))
            # at least the fitted number of lists, and more until enough candidates are in them
            enough = (np.cumsum(amounts[order], axis=1) < 4 * (k + 1)).sum(1) + 1
            many = np.minimum(np.maximum(own.probes, enough), order.shape[1])
            at = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
            flat = np.concatenate([o[:m] for o, m in zip(order, many)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["vec_id", "v", "lists"])

    asked = saved(indexed.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(probe, f"vec_id long, v array<{kind}>, lists array<int>").select("vec_id", "v", F.explode("lists").alias("list")), "asked")
    wanted = {r.list: r.n for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}
    # as many rows as there are lists
    grid = spark.createDataFrame([(j, math.ceil(sizes.get(j, 0) / CANDIDATES), math.ceil(wanted.get(j, 0) / QUERIES_AT_ONCE)) for j in range(len(amounts)) if sizes.get(j) and wanted.get(j)] or [(-1, 1, 1)], "list int, cs int, qs int")

    def tiles(df: DataFrame, own: str, other: str, side: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
        return df.join(F.broadcast(grid), "list").withColumn("a", block).withColumn("b", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("list", F.col("a" if side == 0 else "b").alias("c"), F.col("b" if side == 0 else "a").alias("q"), F.lit(side).alias("side"), "vec_id", "v")

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        order = np.argsort(table["vec_id"].to_numpy(), kind="stable")
        ids, v = table["vec_id"].to_numpy()[order], _vectors(table["v"], d)[order]
        c, q = side[order] == 0, side[order] == 1
        got = _scan(v[q], v[c], ids[q], ids[c], lists.value.rotation, k) if c.any() and q.any() else ([], [], [])
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()), "score": pa.array(got[2], pa.float64())})

    both = tiles(indexed, "cs", "qs", 0).unionByName(tiles(asked, "qs", "cs", 1))
    found = both.groupBy("list", "c", "q").applyInArrow(compare, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
