"""Quality and toxicity scores: features inside tasks, positive-unlabelled learning on a bounded sample.

Only a sample of stated size is fitted; features, corpus counts and scores use
whole texts. Both classifiers are linear over binary features and learned by
`fit_nnpu` from trusted positives and unlabelled texts. The class prior is
estimated as the share of label 1 among the rows whose labels may be used.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.lang_id import _codes
from tripforge.llm.pu_learning import Rows, fit_nnpu, sigmoid
from tripforge.llm.textcore import chunks, filter_rows, mix64, utf8, words
from tripforge.work import bounded_batches, saved

#: Rows that a classifier is fitted on, at most about.
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 12_000

# ---- samples -------------------------------------------------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, trusted, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """(text, positive) rows of the fitting sample, and the estimated class prior.

    `trusted(column)` says which ids' labels may be used. Positives are trusted
    rows of label 1, unlabelled rows are texts of the same ids, whatever their
    label. Both are chosen by a hash of the id, so that about MAX_POSITIVE and
    MAX_UNLABELLED remain at any input size.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null").where(trusted(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    got = known.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0)).alias("p")).first()
    pool = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null").where(trusted(F.col("id")))
    total = pool.select("id").count()

    def drawn(seed: int, most: int, n: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, most / max(1, n)) * (1 << 30))

    # about MAX_POSITIVE ids: a side of bounded size
    positives = F.broadcast(known.where("y = 1").where(drawn(1, MAX_POSITIVE, got.p)).select(F.col("id").alias("of"), F.lit(True).alias("positive")))
    both = F.array_compact(F.array(F.when(F.col("positive"), True), F.when(drawn(2, MAX_UNLABELLED, total), False)))
    chosen = pool.join(positives, F.col("id") == F.col("of"), "left").where(F.col("positive") | drawn(2, MAX_UNLABELLED, total)).where("text is not null").select("text", F.explode(both).alias("positive"))
    return saved(chosen, "sample"), (got.p / got.n if got.n else 0.5)


# ---- toxicity: words and word beginnings ----------------------------------------------------------------------------

#: Letters of word beginnings that are features beside the whole word.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Features that the classifier weighs, at most; the least standard score of one, and the least share of label 1 among texts that have it, as estimated from the prior.
FEATURES, LEAST_SCORE, LEAST_PURITY = 2_048, 4.5, 0.6
_BINS = 1 << 20


def word_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and word beginnings, and for each its text's number; repeated ones are repeated."""
    points, at, _ = _codes(texts)
    letter = points > 0
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    of = np.searchsorted(at, starts, side="right") - 1
    # a word's letters, each weighed by its place, whatever the word's length; border marks weigh nothing
    place = np.arange(starts[0], len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points))))
    weighed = points[starts[0] :].astype(np.uint64) * (mix64(place.astype(np.uint64)) | np.uint64(1))
    out, owner = [mix64(np.add.reduceat(weighed, starts - starts[0]) ^ np.uint64(0xABCDEF))], [of]
    h, live = np.zeros(len(starts), np.uint64), np.arange(len(starts))
    padded = np.concatenate([points, np.zeros(max(PREFIXES), points.dtype)])
    for k in range(max(PREFIXES)):
        own = padded[starts[live] + k]
        live, own = live[own > 0], own[own > 0]
        h[live] = h[live] * np.uint64(0x110003) + own.astype(np.uint64)
        if k + 1 in PREFIXES:
            out.append(mix64(h[live] + np.uint64(k + 1)))
            owner.append(of[live])
    return np.concatenate(out), np.concatenate(owner)


def _unique_pairs(features: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((features, owner))
    f, o = features[order], owner[order]
    new = np.ones(len(f), bool)
    new[1:] = (f[1:] != f[:-1]) | (o[1:] != o[:-1])
    return f[new], o[new]


@dataclass
class WordModel:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.bins = np.full(_BINS, -1, np.int16)
        # several features may share a bin: each bin holds the first, the rest are looked up by search
        order = np.argsort(self.features)
        self.features, self.weights = self.features[order], self.weights[order]
        self.bins[(self.features & np.uint64(_BINS - 1)).astype(np.int64)] = 0

    def find(self, features: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the features that the model has, and their texts; one for each text."""
        maybe = np.flatnonzero(self.bins[(features & np.uint64(_BINS - 1)).astype(np.int64)] == 0)
        f, o = features[maybe], owner[maybe]
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.features, f), len(self.features) - 1)
        real = self.features[place] == f
        return _unique_pairs(place[real], o[real])

    def score(self, texts: list[str | None]) -> np.ndarray:
        place, owner = self.find(*word_features(texts))
        return sigmoid(self.bias + np.bincount(owner, self.weights[place], len(texts)))

    def score_column(self, column: pa.Array) -> np.ndarray:
        return self.score(column.to_pylist())


def fit_toxicity(docs: DataFrame, labels: DataFrame, trusted, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> WordModel:
    """Learns which words and word beginnings mark toxic texts.

    Executors count in how many positives and unlabelled texts of the sample a
    feature occurs. A feature's estimated purity is prior * P(feature | positive)
    / P(feature | unlabelled); of those that are pure enough, the FEATURES with
    the highest standard score are weighed, none below zero.
    """
    sample, prior = _sample(docs, labels, label_col, trusted, id_col, text_col)
    sizes = {r.positive: r.n for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return WordModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 0):
                f, o = _unique_pairs(*word_features(part.column(0).to_pylist()))
                positive = part.column(1).to_numpy(zero_copy_only=False)[o]
                own, place = np.unique(f, return_inverse=True)
                p = np.bincount(place[positive], minlength=len(own))
                u = np.bincount(place[~positive], minlength=len(own))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(p.astype(np.int64)), pa.array(u.astype(np.int64))], ["f", "p", "u"])

    counted = sample.mapInArrow(count, "f long, p long, u long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where("p >= 3")
    expected = F.col("u") * (n_p / n_u)
    top = counted.select("f", "p", "u", ((F.col("p") - expected) / F.sqrt(expected + 1)).alias("z")).where((F.col("z") >= LEAST_SCORE) & (F.lit(prior * n_u / n_p) * F.col("p") >= LEAST_PURITY * F.col("u"))).orderBy(F.desc("z"), "f").limit(FEATURES).toArrow()
    empty = WordModel(top.column(0).to_numpy().view(np.uint64), np.zeros(top.num_rows), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(empty)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 0):
                place, owner = shared.value.find(*word_features(part.column(0).to_pylist()))
                at = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.ListArray.from_arrays(pa.array(at), pa.array(place.astype(np.int16)))], ["positive", "has"])

    rows = sample.mapInArrow(find, "positive boolean, has array<smallint>").toArrow()
    flags = rows.column(0).to_numpy(zero_copy_only=False).astype(bool)
    has = [np.asarray(x.as_py(), np.int64) for x in rows.column(1)]
    p, u = Rows.of([x for x, y in zip(has, flags) if y]), Rows.of([x for x, y in zip(has, flags) if not y])
    w, b = fit_nnpu(p, u, len(empty.features), prior, least=0.0)
    return WordModel(empty.features, w, b)


# ---- quality: distributions of a text's shape -----------------------------------------------------------------------

#: Quantile bins of each measure.
MEASURE_BINS = 16
_classes: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    """0 other, 1 lower or caseless letter, 2 upper letter, 3 digit, 4 space, 5 line end, 6 sentence mark, 7 symbol."""
    if not _classes:
        t = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            k = unicodedata.category(chr(c))
            t[c] = 2 if k == "Lu" else 1 if k[0] == "L" else 3 if k[0] == "N" else 4 if k[0] == "Z" else 7 if k[0] in "SP" else 0
        t[[9, 32]] = 4
        t[[10, 13]] = 5
        t[[ord(x) for x in ".,;:?'\"-()"]] = 6
        _classes.append(t)
    return _classes[0]


def measures(column: pa.Array) -> np.ndarray:
    """Per text: sizes, shares of kinds of characters, word lengths, repetition. An empty text has zeros."""
    texts = [t or "" for t in column.to_pylist()]
    kinds = _class_table()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.array([len(t) for t in texts], np.int64)
    n = len(texts)
    by = np.bincount(np.repeat(np.arange(n) * 8, lengths) + kinds, minlength=8 * n).reshape(n, 8).astype(float)
    raw, at = utf8(column)
    h, starts, ends, of = words(raw, at)
    count = np.diff(of).astype(float)
    size = (ends - starts).astype(float)
    owner = np.repeat(np.arange(n), np.diff(of))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    second = np.zeros(len(h), bool)
    second[2:] = (h[2:] == h[:-2]) & (owner[2:] == owner[:-2])
    distinct = np.array([len(np.unique(h[of[i] : of[i + 1]])) for i in range(n)], float)
    last = kinds_of_bytes(raw[ends - 1]) if len(h) else np.zeros(0, bool)
    per = np.maximum(count, 1)
    letters, chars = np.maximum(by[:, 1] + by[:, 2], 1), np.maximum(lengths, 1)
    mean = np.bincount(owner, size, n) / per
    return np.stack(
        [
            np.log2(lengths + 1.0),
            np.log2(count + 1),
            by[:, 2] / letters,
            by[:, 3] / chars,
            by[:, 6] / chars,
            by[:, 7] / chars,
            by[:, 5] / per,
            by[:, 4] / chars,
            mean,
            np.sqrt(np.maximum(0, np.bincount(owner, size * size, n) / per - mean * mean)),
            np.bincount(owner, same, n) / per,
            np.bincount(owner, second, n) / per,
            distinct / per,
            distinct / np.sqrt(per),
            np.bincount(owner, last, n) / per,
            np.bincount(owner, size == 1, n) / per,
            np.bincount(owner, size <= 3, n) / per,
        ],
        axis=1,
    )


def kinds_of_bytes(last: np.ndarray) -> np.ndarray:
    """Whether a word's last byte is a symbol or an exclamation mark."""
    table = np.zeros(256, bool)
    table[[ord(c) for c in "!#$%&*+/<=>@\\^_`{|}~"]] = True
    return table[last]


@dataclass
class MeasureModel:
    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float

    def active(self, values: np.ndarray) -> np.ndarray:
        """Numbers of each row's bins, one for each measure."""
        return np.stack([np.searchsorted(e, values[:, k], side="right") + k * MEASURE_BINS for k, e in enumerate(self.edges)], axis=1)

    def score_column(self, column: pa.Array) -> np.ndarray:
        if not self.edges:
            return np.full(len(column), sigmoid(np.array(self.bias)))
        return sigmoid(self.bias + self.weights[self.active(measures(column))].sum(1))


def fit_quality(docs: DataFrame, labels: DataFrame, trusted, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> MeasureModel:
    """Learns an additive model over binned measures; the sample's measures, a few numbers a row, go to the driver."""
    sample, prior = _sample(docs, labels, label_col, trusted, id_col, text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 0):
                m = measures(part.column(0))
                at = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.ListArray.from_arrays(pa.array(at), pa.array(m.ravel()))], ["positive", "m"])

    rows = sample.mapInArrow(measure, "positive boolean, m array<double>").toArrow()
    flags = rows.column(0).to_numpy(zero_copy_only=False).astype(bool)
    if not flags.any() or flags.all():
        return MeasureModel([], np.zeros(0), float(np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))))
    values = np.array(rows.column(1).to_pylist())
    cuts = np.arange(1, MEASURE_BINS) / MEASURE_BINS
    edges = [np.unique(np.quantile(values[~flags, k], cuts)) for k in range(values.shape[1])]
    model = MeasureModel(edges, np.zeros(0), 0.0)
    bins = model.active(values)
    model.weights, model.bias = fit_nnpu(Rows.of(list(bins[flags])), Rows.of(list(bins[~flags])), MEASURE_BINS * len(edges), prior)
    return model


# ---- scores ---------------------------------------------------------------------------------------------------------


def score_documents(docs: DataFrame, model: WordModel | MeasureModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score in 0 to 1, higher when label 1 is likelier.

    Whole texts are scored; a null text counts as an empty one, which gets a
    score as well. Repeated rows come back repeated, null ids as null, other
    columns are ignored, an empty table gives an empty table. The model is of
    bounded size and is broadcast.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in chunks(batch, 1):
                score = own.score_column(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.asarray(score, float))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_below(docs: DataFrame, model: WordModel | MeasureModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, text_col, lambda column: shared.value.score_column(column) < threshold)
