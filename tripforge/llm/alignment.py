"""Alignment of two tokenizers over a corpus: groups between shared ends, linked id pairs and their document counts.

1. One pass encodes every whole text with both vocabularies. Byte offsets where
   tokens of both end cut the tokens into groups; each stretch between two ends of
   either is the overlap of just one pair of tokens, a link. A document keeps its
   distinct id pairs and how often it has each.
2. An array made beforehand gives for each A id the B id of the same bytes. Pairs that
   it foretells, which is what one-to-one groups hold, are counted in tasks in
   vectors of the vocabulary's length; only other pairs enter a shuffle, summed up
   by task before.
3. Counts come back to the documents: foretold pairs by such a vector, the most
   frequent of the others by a sorted array of at most BROADCAST_PAIRS, the rest by
   a join on the pair.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.bpe import _byte_characters
from tripforge.llm.textcore import chunks
from tripforge.work import bounded_batches, saved

#: Fixed value: the pattern of a byte-level pre-tokenizer without one of its own.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pairs whose counts are broadcast, 16 bytes each.
BROADCAST_PAIRS = 2_000_000
#: Pairs that a task holds before it sums them up, and distinct ones before it passes them on.
HELD, DISTINCT = 4_000_000, 1_000_000
#: Bytes of text that are encoded at a time.
AT_ONCE = 1_000_000


class Vocabularies:
    """A byte-level BPE file (A) and a sentencepiece model (B): encoders, each id's bytes, and the B id of each A id's bytes (-1 if none has them).

    An A file that asks for more than byte-level merges in order of their ids raises.
    """

    def __init__(self, a: bytes, b: bytes) -> None:
        spec = json.loads(a)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("a plain BPE vocabulary without normalizer is needed")
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("the vocabulary's pre-tokenizer is not the byte-level one")
        of = {c: i for i, c in enumerate(_byte_characters())}
        ranks = {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if all(c in of for c in token)}
        for k, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if model["vocab"][left + right] != 256 + k:
                raise ValueError("the vocabulary's ids are not in the order of its merges")
        self.encoder = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        first = {}
        for i, token in enumerate(self.b_bytes):
            # of several ids the piece, not the byte that stands in for it
            if token not in first or self.pieces.is_byte(first[token]):
                first[token] = i
        self.same = np.array([first.get(token, -1) if token else -1 for token in self.a_bytes], np.int64)
        self.na, self.nb = len(self.a_bytes), len(self.b_bytes)
        self.a_length, self.b_length = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # an id with what stands behind it in a list of groups: more of its side, or the end of it
        self._written = pa.array([f"{i}{end}" for i in range(self.na) for end in ",|"] + [f"{i}{end}" for i in range(self.nb) for end in ",;"], pa.large_string())

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space + text by A and of text by B; none at all where either's bytes are not those of space + text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        a, b = self.encoder.encode_ordinary(whole), self.pieces.encode(text)
        raw = whole.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Per text: n_a, n_b, n_groups, n_links, the digest of its groups, and its distinct pairs (a * nb + b) with their numbers, as flat arrays with offsets."""
        both = [self.encode(t) for t in texts]
        n_a, n_b = (np.array([len(x[k]) for x in both], np.int64) for k in (0, 1))
        a, b = (np.concatenate([x[k] for x in both]) if both else np.zeros(0, np.int64) for k in (0, 1))
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        size = int(a_end[-1]) if len(a) else 0
        in_a, in_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        in_a[a_end], in_b[b_end] = True, True
        common = in_a & in_b
        document = np.repeat(np.arange(len(texts)), n_a)
        ends = np.flatnonzero(in_a | in_b)
        i, j = (np.cumsum(in_a) - in_a)[ends], (np.cumsum(in_b) - in_b)[ends]
        of_link = document[i] if len(ends) else ends
        pairs, times = np.unique(of_link * (self.na * self.nb) + a[i] * self.nb + b[j], return_counts=True)
        of_pair, pairs = pairs // (self.na * self.nb), pairs % (self.na * self.nb)
        # groups in order, A's ids before B's
        group = np.cumsum(common) - common
        ga, gb = group[a_end], group[b_end]
        groups = int(common.sum())
        ca, cb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
        fa, fb = np.cumsum(ca) - ca, np.cumsum(cb) - cb
        entries = np.zeros(len(a) + len(b), np.int64)
        entries[(fa + fb)[ga] + np.arange(len(a)) - fa[ga]] = 2 * a + common[a_end]
        entries[(fa + fb)[gb] + ca[gb] + np.arange(len(b)) - fb[gb]] = 2 * self.na + 2 * b + common[b_end]
        written = self._written.take(pa.array(entries))
        _, offsets, data = written.buffers()
        at = np.frombuffer(offsets, np.int64)[: len(entries) + 1] if len(entries) else np.zeros(1, np.int64)
        text, cut = memoryview(data if data is not None else b""), np.concatenate([[0], np.cumsum(n_a + n_b)])
        digests = [hashlib.sha256(text[at[p] : at[q] - 1]).hexdigest() if q > p else "" for p, q in zip(cut[:-1], cut[1:])]
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(document[np.searchsorted(a_end, np.flatnonzero(common))] if groups else ends, minlength=len(texts)),
            "n_links": np.bincount(of_link, minlength=len(texts)),
            "groups_sha256": digests,
            "at": np.concatenate([[0], np.cumsum(np.bincount(of_pair, minlength=len(texts)))]),
            "pairs": pairs,
            "times": times,
        }


@functools.lru_cache(1)
def vocabularies(a: bytes, b: bytes) -> Vocabularies:
    return Vocabularies(a, b)


def _lists(at: np.ndarray, flat: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))


def encode_both(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked pairs (a * nb + b) with times, how often it has each.

    Paths are on the driver; the files, whose size does not depend on the data, are
    broadcast. Texts that are null or empty, or whose tokens' bytes differ from those
    of space + text, have no tokens: zeros and an empty digest. Repeated rows come back
    repeated, a null id as null; other columns are ignored.
    """
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    vocabularies(*files)
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(*shared.value)
        for batch in batches:
            for part in chunks(batch, 2, AT_ONCE):
                got = both.align(part.column(2).to_pylist())
                counts = [pa.array(got[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *counts, pa.array(got["groups_sha256"], pa.string()), _lists(got["at"], got["pairs"], pa.int64()), _lists(got["at"], got["times"], pa.int32())],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(encoded: DataFrame, same: np.ndarray, nb: int) -> DataFrame:
    """(pair, n): in how many documents a linked pair occurs; `same` gives the B id of each A id's bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        foretold = np.zeros(len(same), np.int64)
        summed: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        held: list[np.ndarray] = []

        def sum_up() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([summed[0], *held]), return_inverse=True)
            weight = np.concatenate([summed[1], np.ones(sum(map(len, held)), np.int64)])
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, where, weight)
            held.clear()
            return keys, total

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

        for batch in batches:
            pairs = batch.column(0).flatten().to_numpy()
            a, b = pairs // nb, pairs % nb
            known = shared.value[a] == b
            foretold += np.bincount(a[known], minlength=len(foretold))
            held.append(pairs[~known])
            if sum(map(len, held)) > HELD:
                summed = sum_up()
                if len(summed[0]) > DISTINCT:
                    yield rows(*summed)
                    summed = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield rows(*sum_up())
        some = np.flatnonzero(foretold)
        yield rows(some * nb + shared.value[some], foretold[some])

    return encoded.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def best_matches(counts: DataFrame, nb: int) -> DataFrame:
    """(a, b, n): for each A id the B ids that most documents link it with, ties included."""
    split = counts.select(F.expr(f"pair div {nb}").alias("a"), F.expr(f"pair % {nb}").alias("b"), "n")
    most = split.groupBy(F.col("a").alias("of")).agg(F.max("n").alias("most"))
    # a row for each id of the vocabulary at most
    return split.join(F.broadcast(most), (F.col("a") == F.col("of")) & (F.col("n") == F.col("most"))).select("a", "b", "n")


def _cutoff(counts: DataFrame) -> int:
    """The least count from which on there are no more than BROADCAST_PAIRS pairs, a power of two; 0 if all are few enough."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("pairs")).orderBy(F.desc("k")).collect()
    total = 0
    for r in sizes:
        total += r.pairs
        if total > BROADCAST_PAIRS:
            return 1 << (r.k + 1)
    return 0


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A document's links are all pairs of an A and a B token that overlap in bytes; a
    pair's count is the number of documents that hold it linked. n_best counts the
    links whose count is the highest of their A id, ties included; count_sum is the
    sum of the links' counts. The digest is of the groups `a1,a2|b1;a3|b2,b3`.

    Odd texts are as in `encode_both`. Repeated rows and ids count as documents of
    their own; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        both = vocabularies(f.read(), g.read())
    nb, same = both.nb, both.same
    encoded = saved(encode_both(docs, a_path, b_path, id_col, text_col), "encoded")
    counts = saved(pair_counts(encoded, same, nb), "counts")

    highest = np.zeros(both.na, np.int64)
    foretold = highest.copy()
    # as many rows as the vocabulary has ids
    for r in counts.groupBy(F.expr(f"pair div {nb}").alias("a")).agg(F.max("n").alias("n")).toArrow().to_pylist():
        highest[r["a"]] = r["n"]
    cut = _cutoff(counts)
    often = counts.where(F.col("n") >= cut).orderBy("pair").toArrow()
    keys, n = (np.asarray(often.column(k)) for k in ("pair", "n"))
    known = same[keys // nb] == keys % nb
    foretold[keys[known] // nb] = n[known]
    tables = spark.sparkContext.broadcast((same, foretold, highest, keys[~known], n[~known]))
    del often, keys, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, foretold, highest, keys, n = tables.value
        for batch in (x.slice(k, 500) for x in batches for k in range(0, x.num_rows, 500)):
            lists = batch.column(1)
            at = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            pairs, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            a = pairs // nb
            count = np.where(same[a] == pairs % nb, foretold[a], 0)
            other = np.flatnonzero(count == 0)
            if len(keys) and len(other):
                place = np.minimum(np.searchsorted(keys, pairs[other]), len(keys) - 1)
                count[other] = np.where(keys[place] == pairs[other], n[place], 0)
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row, times * (count == highest[a]))
            np.add.at(sums[1], row, times * count)
            rare = count == 0
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[rare], minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1]), _lists(rest, pairs[rare], pa.int64()), _lists(rest, times[rare], pa.int32())], ["of", "n_best", "count_sum", "rest", "rest_times"])

    looked = encoded.select("row", "pairs", "times").mapInArrow(run, "of long, n_best long, count_sum long, rest array<long>, rest_times array<int>")
    if cut:
        looked = saved(looked, "looked")
        most = spark.createDataFrame([(i, int(x)) for i, x in enumerate(highest) if x], "a int, most long")
        some = looked.select("of", F.explode(F.arrays_zip("rest", "rest_times")).alias("p")).select("of", F.col("p.rest").alias("key"), F.col("p.rest_times").alias("times"))
        told = some.join(counts.where(F.col("n") < cut), F.col("key") == F.col("pair")).join(F.broadcast(most), F.expr(f"key div {nb}") == F.col("a"))
        more = told.groupBy(F.col("of").alias("on")).agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        looked = looked.join(more, F.col("of") == F.col("on"), "left").select("of", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))
    out = encoded.drop("pairs", "times").join(looked.select("of", "n_best", "count_sum"), F.col("row") == F.col("of"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
