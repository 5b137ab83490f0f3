"""Language identification with language-bitmask n-gram filters.

Each language's characteristic letter n-grams go into Bloom filters that are
stored bit-sliced: one machine word per filter position, one bit of it per
language. Looking up an n-gram ANDs the words at its hash positions and gives
the set of all languages that hold it at once. A text's n-grams are looked up
and counted per language; each count is corrected for that language's false
positives, and the largest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.textcore import chunks, filter_rows, mix64
from tripforge.work import bounded_batches, saved

#: Letters of an n-gram; a word's border counts as one.
SIZE = 3
#: Positions of the filters, and positions per n-gram.
POSITIONS, HASHES = 1 << 20, 3
#: Rows of text per language that the filters are learned from, at most about.
SAMPLE_PER_LANGUAGE = 4_000
#: N-grams per language, the most frequent first, at most.
GRAMS_PER_LANGUAGE = 40_000
#: An n-gram goes to a language if it is at least so frequent there against the language where it is most frequent.
SHARE = 0.2
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters' code points with every run of others as one 0, offsets of texts, and whether each has a letter."""
    joined = "\n".join(["\n" + (t or "").lower() for t in texts]) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len((t or "").lower()) + 2 for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(lengths)])
    at[-1] = len(points)
    is_letter = _letter_table()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[at[:-1]] = True  # a text's own border before its first word
    points = np.where(is_letter, points, 0)[keep]
    kept = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(is_letter)])
    return points, kept[at], np.diff(letters[at]) > 0


def _grams(points: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-grams, and each text's offsets into them. A 0 occurs at an n-gram's ends only."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    rolled = np.zeros(n, np.uint64)
    good = np.ones(n, bool)
    for k in range(size):
        own = points[k : n + k].astype(np.uint64)
        rolled = rolled * np.uint64(0x110001) + own
        if 0 < k < size - 1:
            good &= own > 0
    good &= (points[:n] > 0) | (points[size - 1 :] > 0)
    kept = np.concatenate([[0], np.cumsum(good)])
    return mix64(rolled[good]), kept[np.minimum(at, n)]


def _positions(grams: np.ndarray, k: int, positions: int) -> np.ndarray:
    step = (grams >> np.uint64(32)) | np.uint64(1)
    return ((grams + np.uint64(k) * step) & np.uint64(positions - 1)).astype(np.int64)


@dataclass
class LanguageFilters:
    languages: list[str]
    words: np.ndarray
    false_rates: np.ndarray
    common: str
    size: int = SIZE
    hashes: int = HASHES

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """The languages of each n-gram, as bits."""
        out = self.words[_positions(grams, 0, len(self.words))]
        for k in range(1, self.hashes):
            out = out & self.words[_positions(grams, k, len(self.words))]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.measure(texts)[:2]

    def measure(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text its language, its score, the share of its n-grams that the language's filter holds, corrected for false positives, and the number of its n-grams."""
        points, at, lettered = _codes(texts)
        grams, of = _grams(points, at, self.size)
        masks, n = self.masks(grams), np.diff(of).astype(np.float64)
        hits = np.zeros((len(self.languages), len(texts)))
        for k in range(len(self.languages)):
            total = np.concatenate([[0], np.cumsum((masks >> masks.dtype.type(k)) & masks.dtype.type(1), dtype=np.int64)])
            hits[k] = total[of[1:]] - total[of[:-1]]
        false = self.false_rates[:, None]
        fixed = np.maximum(0.0, (hits - n * false) / (1 - false))
        best = fixed.argmax(0) if len(self.languages) else np.zeros(len(texts), int)
        top, total = fixed.max(0, initial=0.0), fixed.sum(0)
        score = np.where(lettered & (total > 0), top / np.maximum(total, 1e-9), 0.0)
        names = [UNDETERMINED if not ok or not self.languages else self.languages[b] if t > 0 else self.common for ok, b, t in zip(lettered, best, top)]
        return names, np.clip(score, 0.0, 1.0), top / np.maximum(n, 1), n


def fit_language_filters(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> LanguageFilters:
    """Learns filters from rows with a language. Of each language about SAMPLE_PER_LANGUAGE rows, chosen by a hash of the key, are read whole, in one scan.

    The n-grams are counted on the executors; GRAMS_PER_LANGUAGE bounds what
    reaches the driver. More than 64 languages raise. No rows give no languages.
    Null texts count as empty ones.
    """
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(key_col).alias("key")).where("lang is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(65).collect()}
    if len(counts) > 64:
        raise ValueError("at most 64 languages fit the mask")
    bounded_batches(rows.sparkSession)
    languages = sorted(counts)
    if not languages:
        return LanguageFilters([], np.zeros(POSITIONS, np.uint8), np.zeros(0), UNDETERMINED)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, SAMPLE_PER_LANGUAGE / counts[lang])).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64(F.col("key"), F.lit(17)), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 0):
                points, at, _ = _codes(part.column(0).to_pylist())
                grams, of = _grams(points, at, SIZE)
                langs = part.column(1).to_pylist()
                codes = {lang: i for i, lang in enumerate(sorted(set(langs)))}
                of_gram = np.repeat(np.array([codes[x] for x in langs]), np.diff(of))
                for lang, i in codes.items():
                    own, n = np.unique(grams[of_gram == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = saved(sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sums = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, 1.0 / max(1, sums.get(lang, 0)))])
    # a gram's languages are at most 64, a language's grams are cut to the most frequent
    rated = counted.withColumn("r", F.col("n") * rate[F.col("lang")]).groupBy("gram").agg(F.max("r").alias("most"), F.collect_list(F.struct("lang", "r")).alias("by"))
    rated = rated.select("gram", "most", F.explode("by").alias("x")).select("gram", "x.lang", "x.r", "most").where(F.col("r") >= SHARE * F.col("most"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("r"), "gram"))
    top = rated.withColumn("place", place).where(F.col("place") <= GRAMS_PER_LANGUAGE).select("lang", "gram").toArrow()
    grams, by = top.column(1).to_numpy().view(np.uint64), np.array(top.column(0).to_pylist(), object)
    kept = {lang: grams[by == lang] for lang in languages}
    kind = np.dtype(f"u{next(b for b in (1, 2, 4, 8) if 8 * b >= len(languages))}")
    table = np.zeros(POSITIONS, kind)
    rates = []
    for i, lang in enumerate(languages):
        own = np.zeros(POSITIONS, bool)
        for k in range(HASHES):
            own[_positions(kept[lang], k, POSITIONS)] = True
        table[own] |= kind.type(1 << i)
        rates.append(float(own.mean()) ** HASHES)
    return LanguageFilters(languages, table, np.array(rates), max(languages, key=lambda x: (counts[x], x)))


def identify_languages(docs: DataFrame, filters: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score.

    Whole texts are looked up. lang_pred is a learned language, `und` for a null
    text or one without a letter; a text whose n-grams no filter holds gets the
    most frequent learned language with score 0. score is the winner's share of
    all corrected counts, 0 for `und`. Ties go to the first language by name.
    Repeated rows come back repeated, null ids as null, other columns are
    ignored. The filters (1 to 8 MB, whatever the data) are broadcast.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                names, score = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


#: A text stays from this score, and from this share of its n-grams in the filter of its language; one of fewer n-grams than FEW is too short to reject.
LEAST_SCORE, LEAST_COVERED, FEW = 0.2, 0.3, 6


def keep_identified(docs: DataFrame, filters: LanguageFilters, languages: tuple[str, ...] | None = None, least_score: float = LEAST_SCORE, least_covered: float = LEAST_COVERED, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, in one of `languages` (null: all that were learned).

    A text goes if it is null or has no letter; if its language is another one; or if
    its score is under `least_score` or its language's filter holds less than
    `least_covered` of its n-grams, as for a language or script that was not learned.
    Texts of fewer than FEW n-grams are not rejected for the last two. Whole texts are
    looked up, however long. Filters that learned no language reject no text with a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def keep(column: pa.Array) -> np.ndarray:
        texts = column.to_pylist()
        if not shared.value.languages:
            return _codes(texts)[2]
        names, score, covered, n = shared.value.measure(texts)
        wanted = np.array([x != UNDETERMINED and (languages is None or x in languages) for x in names], bool)
        return wanted & ((n < FEW) | (score >= least_score) & (covered >= least_covered))

    return filter_rows(docs, text_col, keep)


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))
