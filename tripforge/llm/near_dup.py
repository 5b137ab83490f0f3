"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification, exact check, components.

1. One pass over the texts makes, per document, its shingle set's size and
   128-bit digest, the band keys of its MinHash signature and a compact
   signature of 8-bit values.
2. Documents with equal sets form classes; only each class's smallest id goes on.
3. In every band bucket the smallest id is the hub. Each other member makes one
   candidate pair with it, so a bucket of n members makes n - 1 pairs.
4. Batches of signature values are compared. After each batch a pair is dropped
   when the posterior probability of a similarity at or above the threshold
   (uniform prior) is below `miss`. Survivors are checked on full shingle sets.
5. Linked documents become components. Buckets that still hold several
   components are compared in blocks of at most `BLOCK` members, signature
   batch by signature batch. Pairs of different components that survive the
   Bayesian bounds are held against each other's shingle sets within the block,
   and only what links two components goes on to the exact check of the texts.
6. Components over all links; classes map every document to its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.operators.graph import connected_components
from tripforge.llm.textcore import chunks, digest128, mix64, shingles, utf8, words
from tripforge.work import bounded_batches, saved

#: Values of a signature that verification compares at a time, and all it has.
BATCH, DEPTH = 64, 256
#: Members of a bucket, and bytes of their shingle sets, that one task compares with as many others.
BLOCK, BLOCK_BYTES = 256, 8 << 20
#: Pairs of a document that meet one copy of its text in a task; a document with more pairs gets more copies.
PAIRS_PER_COPY = 256
#: Members by which sets cut to 32-bit hashes may differ from whole ones.
SLACK = 2
#: Rows of a band; the number of bands follows from the threshold.
ROWS = 6
#: Probability that no band of a pair at the threshold agrees, at most.
BAND_MISS = 1e-7
#: Posterior probability under which a pair is dropped before its exact check.
BAYES_MISS = 1e-4
#: Ids of documents to verify that are broadcast to the scan of texts, at most; beyond that the semi-join shuffles.
BROADCAST_IDS = 2_000_000


def band_count(threshold: float, rows: int = ROWS, miss: float = BAND_MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def least_matches(threshold: float, miss: float = BAYES_MISS) -> list[int]:
    """Per batch end, the fewest matches at which P(similarity >= threshold | matches) reaches `miss`.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at t equals P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, DEPTH + 1, BATCH):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
        out.append(m)
    return out


def _hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, count, dtype=np.uint32)


def _signer(ngram: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _hash_family(max(bands * rows, DEPTH))
        weights = mix64(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        salts = mix64(np.arange(bands, dtype=np.uint64) + np.uint64(99))
        for batch in batches:
            for part in chunks(batch, 1):
                raw, at = utf8(part.column(1))
                sh, of = shingles(*words(raw, at)[::3], ngram)
                n, low, high, keys, sigs = [], [], [], [], []
                for i in range(part.num_rows):
                    own = np.unique(sh[of[i] : of[i + 1]])
                    n.append(len(own))
                    if not len(own):
                        for x in (low, high, keys, sigs):
                            x.append(None)
                        continue
                    d = digest128(own)
                    x = (own >> np.uint64(32)).astype(np.uint32)
                    sig = (x[:1024, None] * a + b).min(0)
                    for k in range(1024, len(x), 1024):
                        np.minimum(sig, (x[k : k + 1024, None] * a + b).min(0), out=sig)
                    low.append(d[0])
                    high.append(d[1])
                    keys.append(mix64((sig[: bands * rows].reshape(bands, rows) * weights).sum(1) + salts).tobytes())
                    sigs.append((sig[:DEPTH] >> np.uint32(16)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "low", "high", "keys", "sig"],
                )

    return sign


def _spread_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 2000):
            part = batch.slice(k, 2000)
            keys = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64)
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), len(keys) // part.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["bucket", "doc_id"])


def _fold_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys cut to their low 32 bits."""
    for batch in batches:
        short = [np.frombuffer(k, np.uint64).astype(np.uint32).tobytes() for k in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(short, pa.binary())], ["doc_id", "sig", "bands"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, DEPTH)


def _bayes_filter(num: int, den: int, least: list[int]):
    """Keeps the pairs whose sizes allow the threshold and whose signature batches keep the posterior up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {k: batch.column(i) for i, k in enumerate(batch.schema.names)}
            na, nb = c["n_a"].to_numpy(), c["n_b"].to_numpy()
            alive = np.flatnonzero(den * np.minimum(na, nb) >= num * np.maximum(na, nb))
            sa, sb = _matrix(c["sig_a"]), _matrix(c["sig_b"])
            got = np.zeros(len(alive), np.int64)
            for k, need in enumerate(least):
                cut = slice(k * BATCH, (k + 1) * BATCH)
                got = got + (sa[alive, cut] == sb[alive, cut]).sum(1)
                alive, got = alive[got >= need], got[got >= need]
            take = pa.array(alive)
            yield pa.RecordBatch.from_arrays([c["a"].take(take), c["b"].take(take)], ["a", "b"])

    return run


def _block_filter(num: int, den: int, least: list[int]):
    """Within one (bucket, left block, right block): pairs of different components that survive the bounds.

    A pair is looked at only in the bucket of the first band that its two
    documents share. It leaves the block if its shingle sets, cut to 32-bit
    hashes, reach the threshold give or take SLACK members, and if links that
    are sure even so have not connected its components within the block yet.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bucket = np.int64(key[0].as_py()).astype(np.uint64).astype(np.uint32)
        bands = np.frombuffer(b"".join(table["bands"].to_pylist()), np.uint32).reshape(table.num_rows, -1)
        doc, comp, n = (table[x].to_numpy() for x in ("doc_id", "comp", "n"))
        side = table["side"].to_numpy()
        sig = _matrix(table["sig"].combine_chunks()) if table.num_rows else np.zeros((0, DEPTH), np.uint8)
        members = table["members"]
        sets: dict[int, np.ndarray] = {}
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        def own_set(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.frombuffer(members[i].as_py(), np.uint32)
            return sets[i]

        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if not len(right):  # a block against itself
            right = left
        out_a, out_b = [], []
        for i in left:
            ok = right[(doc[right] > doc[i] if right is left else doc[right] != doc[i]) & (comp[right] != comp[i])]
            ok = ok[den * np.minimum(n[ok], n[i]) >= num * np.maximum(n[ok], n[i])]
            got = np.zeros(len(ok), np.int64)
            for k, need in enumerate(least):
                if not len(ok):
                    break
                cut = slice(k * BATCH, (k + 1) * BATCH)
                got = got + (sig[ok, cut] == sig[i, cut]).sum(1)
                ok, got = ok[got >= need], got[got >= need]
            if len(ok):
                ok = ok[bands[i][(bands[ok] == bands[i]).argmax(1)] == bucket]
            for j in ok.tolist():
                a, b = root(int(comp[i])), root(int(comp[j]))
                if a == b:
                    continue
                both = len(np.intersect1d(own_set(int(i)), own_set(j), assume_unique=True))
                union = len(own_set(int(i))) + len(own_set(j)) - both
                if den * (both + SLACK) >= num * (union - SLACK):
                    out_a.append(doc[i])
                    out_b.append(doc[j])
                if den * (both - SLACK) >= num * (union + SLACK):
                    parent[max(a, b)] = min(a, b)
        a, b = np.array(out_a, np.int64), np.array(out_b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _exact_filter(num: int, den: int, ngram: int):
    """Keeps pairs whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def of(batch: pa.RecordBatch, i: int, side: int) -> np.ndarray:
            key = batch.column(side)[i].as_py()
            if key not in sets:
                if len(sets) >= 1_000:
                    sets.clear()
                sets[key] = shingle_set(batch.column(side + 2)[i].as_py(), ngram)
            return sets[key]

        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = of(batch, i, 0), of(batch, i, 1)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def shingle_set(text: str | None, ngram: int) -> np.ndarray:
    raw, at = utf8(pa.array([text], pa.string()))
    return np.unique(shingles(*words(raw, at)[::3], ngram)[0])


def _short_sets(ngram: int):
    """Shingle sets as sorted 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique((shingle_set(t, ngram) >> np.uint64(32)).astype(np.uint32)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "members"])

    return run


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, text) of the ids (column id), one text each."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return texts.join(ids, texts.doc_id == ids.id, "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def _exact_links(pairs: DataFrame, texts: DataFrame, num: int, den: int, ngram: int) -> DataFrame:
    """Pairs (a, b) held against both whole texts. Sides are joined one at a time; of b, which may be a hub of many pairs, there is a copy per PAIRS_PER_COPY pairs."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = saved(_texts_of(ends, texts), "texts")
    copies = saved(pairs.groupBy("b").agg(F.expr(f"cast(ceil(count(*) / {PAIRS_PER_COPY}) as int)").alias("copies")).where("copies > 1"), "copies")
    many = F.broadcast(copies) if copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else copies
    one = pairs.join(many, "b", "left").join(needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    one = one.withColumn("copy", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    hubs = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).join(many, "b", "left")
    hubs = hubs.select("b", "text_b", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
    return one.join(hubs, ["b", "copy"]).select("a", "b", "text_a", "text_b").mapInArrow(_exact_filter(num, den, ngram), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked when den * |A n B| >= num * |A u B| over their
    sets of distinct `ngram`-word shingles (A-Z lower-cased); fewer words make
    one shingle of the whole sequence. component_id is the smallest id that
    links reach, kept says whether it is the row's own.

    Null, empty or blank texts have empty sets, link with nothing and stay. A
    row with a null id is kept with a null component and links nothing. Rows
    that repeat an id with texts of different sets are compared each by itself
    and belong to one component, blank ones aside; each input row comes back.
    Other columns, whatever their names, are ignored. An empty table gives an
    empty table.
    """
    bounded_batches(docs.sparkSession)
    threshold = num / den
    rows = ROWS if threshold >= 0.82 else ROWS - 1
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = saved(base.mapInArrow(_signer(ngram, band_count(threshold, rows), rows), "doc_id long, n_shingles long, low long, high long, keys binary, sig binary"), "signed")
    own = F.struct(F.coalesce("low", F.lit(0)), F.coalesce("high", F.lit(0)))
    several = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min(own).alias("x"), F.max(own).alias("y")).where("x <> y").limit(1).count()
    return _by_row(base, signed, ngram, num, den) if several else _components(base, signed, rows, ngram, num, den)


def _by_row(base: DataFrame, signed: DataFrame, ngram: int, num: int, den: int) -> DataFrame:
    """`near_duplicates` where ids carry several texts: rows are numbered and compared, and those of an id tied together after that."""
    numbered = saved(base.where("doc_id is not null").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")
    found = near_duplicates(numbered, "row", "text", ngram, num, den).toDF("of", "n_shingles", "comp", "kept")
    both = saved(numbered.select("row", "doc_id").join(found, F.col("row") == F.col("of")).select("doc_id", "n_shingles", "comp"), "found")
    worded = both.where("n_shingles > 0")
    least = worded.groupBy("doc_id").agg(F.min("comp").alias("to")).select(F.col("doc_id").alias("id"), "to")
    ties = worded.join(least, worded.doc_id == least.id).where("comp <> to").select(F.col("comp").alias("a"), F.col("to").alias("b")).distinct()
    tied = worded.join(connected_components(ties), F.col("comp") == F.col("node"), "left").select("doc_id", "comp", F.coalesce("label", "comp").alias("whole"))
    names = tied.groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    known = tied.select("comp", "whole").distinct().join(names, "whole").select(F.col("comp").alias("c"), "component_id")
    out = both.join(known, F.col("comp") == F.col("c"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    unnamed = signed.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(unnamed).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def _components(base: DataFrame, signed: DataFrame, rows: int, ngram: int, num: int, den: int) -> DataFrame:
    """`near_duplicates` where an id has one set."""
    least = least_matches(num / den)
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    least_row = F.min(F.struct("doc_id", "n_shingles", "keys", "sig"))
    reps = saved(usable.groupBy("low", "high").agg(least_row.alias("r")).select("low", "high", F.col("r.doc_id").alias("doc_id"), F.col("r.n_shingles").alias("n"), F.col("r.keys").alias("keys"), F.col("r.sig").alias("sig")), "reps")
    classes = reps.select("low", "high", F.col("doc_id").alias("rep"))
    spread = saved(reps.select("doc_id", "keys").mapInArrow(_spread_bands, "bucket long, doc_id long"), "spread")
    hubs = spread.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").select(F.col("bucket").alias("of"), "hub")
    members = saved(spread.join(hubs, spread.bucket == hubs.of).select("bucket", "doc_id", "hub"), "members")
    pairs = members.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()

    sides = reps.select("doc_id", "n", "sig")
    withsig = pairs.join(sides.toDF("a", "n_a", "sig_a"), "a").join(sides.toDF("b", "n_b", "sig_b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    likely = saved(withsig.mapInArrow(_bayes_filter(num, den, least), "a long, b long"), "likely")
    links = saved(_exact_links(likely, base, num, den, ngram), "links")
    first = saved(connected_components(links), "first")

    comp = members.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("label", "doc_id").alias("comp"))
    comp = saved(comp, "comp")
    mixed = comp.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select(F.col("bucket").alias("of"))
    sizes = reps.select("doc_id", "n")
    residual = saved(comp.join(mixed, comp.bucket == mixed.of).select("bucket", "doc_id", "comp").join(sizes, "doc_id"), "residual")
    blocks = residual.groupBy(F.col("bucket").alias("of")).agg(F.expr(f"cast(greatest(ceil(count(*) / {BLOCK}), ceil(sum(4 * n) / {BLOCK_BYTES})) as int)").alias("blocks"))
    folded = reps.select("doc_id", "sig", "keys").mapInArrow(_fold_keys, "doc_id long, sig binary, bands binary")
    sets = _texts_of(residual.select(F.col("doc_id").alias("id")).distinct(), base).mapInArrow(_short_sets(ngram), "doc_id long, members binary")
    left = residual.join(blocks, residual.bucket == blocks.of).select("bucket", "doc_id", "comp", "n", "blocks").join(folded.join(sets, "doc_id"), "doc_id")
    tiles = (
        left.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .select("bucket", "doc_id", "comp", "n", "sig", "bands", "members", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("bucket", "doc_id", "comp", "n", "sig", "bands", "members", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))
    )
    rest = saved(tiles.groupBy("bucket", "i", "j").applyInArrow(_block_filter(num, den, least), "a long, b long"), "rest")
    more = saved(_exact_links(rest, base, num, den, ngram), "more")

    settled = connected_components(links.unionByName(more))
    by_class = classes.join(settled, classes.rep == settled.node, "left").select("low", "high", F.coalesce("label", "rep").alias("root"))
    out = signed.select("doc_id", "n_shingles", "low", "high").join(by_class, ["low", "high"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
