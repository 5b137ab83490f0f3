"""Benchmark decontamination: passages of documents within a word edit distance of a benchmark item.

1. Texts become sequences of lower-cased alphanumeric words, hashed.
2. An item may lose `max_share` of its words to e edits. Of any e + 1 disjoint
   runs of its words one stays intact, so an item is looked for by e + 1 runs,
   chosen to be rare (`choose_pieces`). Where a document has one, the item-sized
   window around it is looked at if, with e words more on both sides, it has
   enough of the item's words. No passage within the distance is missed by this.
   Windows of one document with equal contents are looked at once.
3. Window and item go through the same CGK random walks: at step j the walk
   emits the word under its pointer, which then moves on by a random bit of
   (j, word). Edits cost few Hamming differences of the walks' outputs. Each of
   `walks` repetitions compares sampled positions; one agreement makes the
   window a candidate. `plan_walks` derives the repetitions, for items of about
   the same length, from the agreement that edited copies of all of them show.
   Of lengths that would need more than MAX_WALKS, every window is a candidate.
4. Candidates are verified by exact edit distance of the whole item against the
   window with its surroundings, both ends free.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.textcore import chunks, filter_rows, mix64
from tripforge.work import bounded_batches

#: Sampled positions per repetition, and the probability to reach that a passage at the largest distance becomes a candidate.
SAMPLES, RECALL = 2, 0.995
#: Repetitions beyond which, and words of an item from which, walks cost more than they save; all such windows are verified.
MAX_WALKS, LONG_ITEM = 96, 512
#: Edited copies at least that the repetitions of a length are planned on.
PLANNED_ON = 64
#: Bytes of benchmark text that are broadcast at a time; larger benchmarks go in blocks.
BLOCK_BYTES = 8_000_000
#: Words of a run that an item is looked for by, at most.
PIECE = 6
#: Words of text by which the rareness of runs is judged that the benchmark has once.
UNSEEN = 1e8
#: Windows, and words of windows, that are held at a time.
MAX_WINDOWS, MAX_CELLS = 500_000, 2_000_000
_BINS = 1 << 21
_tables: list[np.ndarray] = []


def _alnum() -> np.ndarray:
    if not _tables:
        _tables.append(np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000))
        _tables.append(np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 0x110000, dtype=np.uint64))
    return _tables[0]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased alphanumeric words, and texts' offsets into them."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.cumsum([1, *(len(t) + 1 for t in lowered)])
    inside = _alnum()[points]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    kept = points[inside]
    lengths = ends - starts
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(kept)) - np.repeat(begin, lengths)
    values = _tables[1][kept] * (mix64(place.astype(np.uint64)) | np.uint64(1))
    return mix64(np.add.reduceat(values, begin) + lengths.astype(np.uint64)), np.searchsorted(starts, at)


def _runs(hashes: np.ndarray, q: int) -> np.ndarray:
    out = np.zeros(max(0, len(hashes) - q + 1), np.uint64)
    for k in range(q) if len(out) else ():
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - q + 1 + k]
    return mix64(out + np.uint64(q))


def allowed_edits(n: int, max_share: float) -> int:
    return int(n * max_share + 1e-9) if n >= 5 else 0


def choose_pieces(items: list[np.ndarray], edits: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word, words) of edits + 1 disjoint runs of each item; a passage within the distance holds one of them intact.

    Dynamic programming, over all items of one length at once, picks runs of up
    to PIECE words that cost least: as often as the benchmark has them, and what
    their words' shares make of UNSEEN words of text.
    """
    flat, lengths = np.concatenate(items), np.array([len(x) for x in items])
    begin = np.cumsum(lengths) - lengths
    left = np.repeat(begin + lengths, lengths) - np.arange(len(flat))
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    share, expected = (times / len(flat))[place], np.full(len(flat), UNSEEN)
    cost = np.full((PIECE + 1, len(flat)), np.inf)
    for q in range(1, PIECE + 1):
        whole = np.flatnonzero(left >= q)
        expected[whole] *= share[whole + q - 1]
        _, own, n = np.unique(_runs(flat, q)[whole], return_inverse=True, return_counts=True)
        cost[q, whole] = n[own] + expected[whole]
    found = []
    for n in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == n)
        need = edits[same[0]] + 1
        step = max(1, 20_000_000 // (n * need))
        for k in range(0, len(same), step):
            group = same[k : k + step]
            rows, end, open_ = np.arange(len(group)), np.full(len(group), n), np.full(len(group), need)
            best = [np.where(np.arange(need + 1) == 0, 0.0, np.inf) + np.zeros((len(group), 1))]
            taken = np.zeros((n + 1, len(group), need + 1), np.int8)
            for i in range(1, n + 1):
                now = best[-1].copy()
                for q in range(1, min(PIECE, i) + 1):
                    with_q = best[-q][:, :-1] + cost[q, begin[group] + i - q][:, None]
                    less = with_q < now[:, 1:]
                    now[:, 1:][less] = with_q[less]
                    taken[i, :, 1:][less] = q
                best = [*best[-PIECE + 1 :], now]
            while open_.any():
                q = taken[end, rows, open_].astype(np.int64)
                hit = (q > 0) & (open_ > 0)
                found.append(np.stack([group[hit], (end - q)[hit], q[hit]]))
                end = np.where(hit, end - q, np.maximum(end - 1, 0))
                open_ = open_ - hit
    return tuple(np.concatenate(found, axis=1))


def edit_distance(item: np.ndarray, segment: np.ndarray) -> tuple[int, int]:
    """Fewest word edits of `item` against any part of `segment`, and where the first such part ends."""
    steps = np.arange(len(segment) + 1)
    row = np.zeros(len(segment) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[1:] + 1, row[:-1] + (segment != word), out=new[1:])
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class Walks:
    """CGK walks: salts per repetition and step, and per repetition the sampled share of a walk's length."""

    salts: np.ndarray
    shares: np.ndarray

    @classmethod
    def drawn(cls, repetitions: int, steps: int, seed: int = 5) -> Walks:
        rng = np.random.Generator(np.random.PCG64(seed))
        return cls(rng.integers(0, 2**63, (repetitions, steps), dtype=np.uint64), rng.random((repetitions, SAMPLES)))

    def keys(self, windows: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Per window (a row of word hashes, n of them used) and repetition, the mix of the sampled symbols."""
        repetitions, steps = self.salts.shape
        out = np.zeros((len(windows), repetitions), np.uint64)
        padded = np.concatenate([windows, np.zeros((len(windows), 1), np.uint64)], axis=1)
        at_once = max(1, MAX_CELLS // (repetitions * steps))
        for k in range(0, len(windows), at_once):
            own, width = padded[k : k + at_once], n[k : k + at_once, None]
            # a walk of 2 n steps has read about the whole window
            wanted = np.minimum((self.shares[None] * 2 * width[..., None]).astype(np.int64), steps - 1)
            rows, pointer = np.arange(len(own))[:, None], np.zeros((len(own), repetitions), np.int64)
            walked = np.empty((int(wanted.max()) + 1, len(own), repetitions), np.uint64)
            for j in range(len(walked)):
                walked[j] = symbol = own[rows, pointer]
                pointer = np.minimum(pointer + (mix64(symbol ^ self.salts[None, :, j]) & np.uint64(1)).astype(np.int64), width)
            for s in range(SAMPLES):
                sampled = np.take_along_axis(walked, wanted[None, :, :, s], axis=0)[0]
                out[k : k + at_once] = out[k : k + at_once] * np.uint64(0x9E3779B97F4A7C15) + mix64(sampled + np.uint64(s + 1))
        return out


def _matrix(items: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(items), width), np.uint64)
    for i, x in enumerate(items):
        out[i, : min(len(x), width)] = x[:width]
    return out


def length_class(n: int) -> int:
    """Items of one class differ in length by less than a factor of about 1.4."""
    return int(2 * math.log2(n))


def plan_walks(items: list[np.ndarray], pieces: list[list[tuple[int, int]]], max_share: float, recall: float = RECALL, seed: int = 3) -> int | None:
    """Repetitions at which copies of the items with the most edits allowed, seen in the windows around their intact runs, reach `recall`; None where MAX_WALKS do not."""
    rng = np.random.Generator(np.random.PCG64(seed))
    chosen = [i for i, x in enumerate(items) if allowed_edits(len(x), max_share)]
    if not chosen:
        return 1
    width = max(len(items[i]) for i in chosen)
    if width >= LONG_ITEM:
        return None
    copy, of, windows = 0, [], []
    for i in chosen * math.ceil(PLANNED_ON / len(chosen)):
        x, y = items[i], items[i].tolist()
        for _ in range(allowed_edits(len(x), max_share)):
            kind, at = rng.integers(3), int(rng.integers(len(y)))
            if kind == 0:
                y[at] = int(rng.integers(1, 2**63))
            elif kind == 1 and len(y) > 1:
                del y[at]
            else:
                y.insert(at, int(rng.integers(1, 2**63)))
        text = np.concatenate([rng.integers(1, 2**63, len(x), dtype=np.uint64), np.array(y, np.uint64), rng.integers(1, 2**63, 2 * len(x), dtype=np.uint64)])
        starts = {int(p) - a for a, q in pieces[i] for p in np.flatnonzero(text == x[a]) if p + q <= len(text) and np.array_equal(text[p : p + q], x[a : a + q])}
        for s in starts:
            of.append((copy, i))
            windows.append(text[s : s + len(x)])
        copy += 1
    which, item = np.array(of).T
    walks = Walks.drawn(48, 2 * width, seed + 1)
    lengths = np.array([len(x) for x in items])
    own = walks.keys(_matrix(items, width), np.minimum(lengths, width))
    same = walks.keys(_matrix(windows, width), lengths[item]) == own[item]
    seen = np.zeros((copy, same.shape[1]), bool)
    np.logical_or.at(seen, which, same)
    agree = seen.mean(1)
    # an item misses all r repetitions with probability (1 - its own rate) to the r
    for r in range(1, MAX_WALKS + 1):
        if 1 - ((1 - agree) ** r).mean() >= recall:
            return r
    return None


@dataclass
class WalkedItems:
    """The items of a length class with their walks' keys; `at` gives an item's row."""

    width: int
    walks: Walks
    keys: np.ndarray
    at: np.ndarray


class ItemIndex:
    """Items' runs, walks and words; what the tasks get."""

    def __init__(self, ids: list[int], texts: list[str | None], max_share: float) -> None:
        h, of = word_hashes(texts)
        self.ids, self.items, self.edits = [], [], []
        for i, (a, b) in zip(ids, zip(of[:-1], of[1:])):
            if b > a and i is not None:
                self.ids.append(i)
                self.items.append(h[a:b])
                self.edits.append(allowed_edits(int(b - a), max_share))
        self.n, self.e = np.array([len(x) for x in self.items], np.int64), np.array(self.edits, np.int64)
        self.length_class = np.array([length_class(len(x)) for x in self.items], np.int64)
        #: of each class, its walks; None where every window is verified
        self.walked: dict[int, WalkedItems | None] = {}
        self.by_length: dict[int, tuple] = {}
        if not self.items:
            return
        item, offset, words = choose_pieces(self.items, self.edits)
        pieces: list[list[tuple[int, int]]] = [[] for _ in self.items]
        for i, a, q in zip(item.tolist(), offset.tolist(), words.tolist()):
            pieces[i].append((a, q))
        for c in np.unique(self.length_class).tolist():
            own = np.flatnonzero(self.length_class == c)
            items = [self.items[i] for i in own]
            repetitions, width = plan_walks(items, [pieces[i] for i in own], max_share), max(map(len, items))
            if repetitions is None:
                self.walked[c] = None
                continue
            walks, at = Walks.drawn(repetitions, 2 * width), np.zeros(len(self.items), np.int64)
            at[own] = np.arange(len(own))
            self.walked[c] = WalkedItems(width, walks, walks.keys(_matrix(items, width), self.n[own]), at)
        flat, begin = np.concatenate(self.items), np.cumsum(self.n) - self.n
        for q in np.unique(words).tolist():
            mine = words == q
            runs = _runs(flat, q)[begin[item[mine]] + offset[mine]]
            order = np.argsort(runs, kind="stable")
            values, first = np.unique(runs[order], return_index=True)
            bins = np.zeros(_BINS, bool)
            bins[(values & np.uint64(_BINS - 1)).astype(np.int64)] = True
            self.by_length[q] = values, np.append(first, len(runs)), item[mine][order], offset[mine][order], bins
        #: (item, word) pairs, one bit each; what is not there is no word of the item
        self.held = np.zeros(1 << max(16, int(8 * len(flat)).bit_length()), bool)
        self.salt = mix64(np.arange(len(self.items), dtype=np.uint64) + np.uint64(17))
        self.held[self._held_at(flat, np.repeat(self.salt, self.n))] = True

    def _held_at(self, words: np.ndarray, salts: np.ndarray) -> np.ndarray:
        return (((words ^ salts) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - len(self.held).bit_length() + 1)).astype(np.int64)

    def windows(self, h: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, item, first word, which may lie before the document) of every window around a run of its item, sorted; MAX_WINDOWS or so at a time."""
        pad = int(self.n.max())
        span = len(h) + 2 * pad

        def split(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            key = np.unique(np.concatenate(parts))
            return key // span // len(self.items), key // span % len(self.items), key % span - pad

        held, size = [], 0
        for q, (values, first, item, offset, bins) in self.by_length.items():
            runs = _runs(h, q)
            at = np.flatnonzero(bins[(runs & np.uint64(_BINS - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(values, runs[at]), len(values) - 1)
            real = values[place] == runs[at]
            at, place = at[real], place[real]
            doc = np.searchsorted(of, at, side="right") - 1
            whole = at + q <= of[doc + 1]
            at, place, doc = at[whole], place[whole], doc[whole]
            times = first[place + 1] - first[place]
            total = np.cumsum(times)
            i = 0
            while i < len(at):
                j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + MAX_WINDOWS, side="right")))
                t = times[i:j]
                pick = np.repeat(first[place[i:j]], t) + np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
                held.append((np.repeat(doc[i:j], t) * len(self.items) + item[pick]) * span + np.repeat(at[i:j], t) - offset[pick] + pad)
                size, i = size + len(pick), j
                if size >= MAX_WINDOWS:
                    yield split(held)
                    held, size = [], 0
        if size:
            yield split(held)

    def worth_walking(self, doc: np.ndarray, item: np.ndarray, start: np.ndarray, h: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Which windows have, with their surroundings, enough of the item's words, each content once per document and item."""
        reach = int((self.n[item] + 2 * self.e[item]).max())
        columns = np.arange(reach)[None, :]
        low = start - self.e[item]
        weights = mix64(np.arange(reach, dtype=np.uint64) + np.uint64(71)) | np.uint64(1)
        kept, step = [], max(1, MAX_CELLS // reach)
        for k in range(0, len(doc), step):
            d, i = doc[k : k + step], item[k : k + step]
            place = low[k : k + step, None] + columns
            inside = (place >= of[d][:, None]) & (place < of[d + 1][:, None]) & (columns < (self.n[i] + 2 * self.e[i])[:, None])
            words = np.where(inside, h[np.clip(place, 0, len(h) - 1)], np.uint64(0))
            shared = (self.held[self._held_at(words, self.salt[i][:, None])] & inside).sum(1)
            enough = np.flatnonzero(shared >= self.n[i] - self.e[i])
            content = (words[enough] * weights).sum(1) ^ mix64(d[enough].astype(np.uint64) * np.uint64(len(self.items)) + i[enough].astype(np.uint64))
            kept.append(k + enough[np.sort(np.unique(content, return_index=True)[1])])
        return np.concatenate(kept)

    def candidates(self, c: int, doc: np.ndarray, item: np.ndarray, start: np.ndarray, h: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Which windows of a length class agree with their item in a repetition of the walks."""
        own = self.walked[c]
        if own is None:
            return np.arange(len(doc))
        kept, step = [np.zeros(0, np.int64)], max(1, MAX_CELLS // own.width)
        columns = np.arange(own.width)[None, :]
        for k in range(0, len(doc), step):
            d, i, s = doc[k : k + step], item[k : k + step], start[k : k + step]
            place = s[:, None] + columns
            inside = (place >= of[d][:, None]) & (place < of[d + 1][:, None]) & (columns < self.n[i][:, None])
            rows = np.where(inside, h[np.clip(place, 0, len(h) - 1)], np.uint64(0))
            kept.append(k + np.flatnonzero((own.walks.keys(rows, self.n[i]) == own.keys[own.at[i]]).any(1)))
        return np.concatenate(kept)

    def parts(self, doc: np.ndarray, item: np.ndarray, start: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first word, end) of what to verify: windows with their surroundings, overlapping ones of a document and item as one."""
        low, high = np.maximum(start - self.e[item], of[doc]), np.minimum(start + self.n[item] + self.e[item], of[doc + 1])
        new = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0) | (low[1:] > high[:-1])) + 1
        first, last = np.append(0, new), np.append(new, len(doc)) - 1
        yield from zip(doc[first].tolist(), item[first].tolist(), low[first].tolist(), high[last].tolist())

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text's number, item's number, words, edits, first word) of each text and item within the distance, at its best place."""
        h, of = word_hashes(texts)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for doc, item, start in self.windows(h, of) if self.items and len(h) else ():
            for c in self.walked:
                own = np.flatnonzero(self.length_class[item] == c)
                for worth in (self.worth_walking, lambda *w: self.candidates(c, *w)):
                    own = own[worth(doc[own], item[own], start[own], h, of)] if len(own) else own
                for d, i, low, high in self.parts(doc[own], item[own], start[own], of) if len(own) else ():
                    edits, end = edit_distance(self.items[i], h[low:high])
                    if edits <= self.edits[i]:
                        got = edits, int(low + end - self.n[i] - of[d])
                        best[d, i] = min(best.get((d, i), got), got)
        return [(d, i, int(self.n[i]), e, max(0, s)) for (d, i), (e, s) in sorted(best.items())]


def _indexes(items: DataFrame, item_id_col: str, item_text_col: str, max_share: float) -> Iterator[Broadcast]:
    """The benchmark as indexes of about BLOCK_BYTES of text each; items with a null id or text are left out."""
    bench = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("item_text")).where("item_id is not null and item_text is not null")
    size = bench.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for b in range(blocks):
        own = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "item_text").toArrow()
        yield items.sparkSession.sparkContext.broadcast(ItemIndex(own.column(0).to_pylist(), own.column(1).to_pylist(), max_share))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", max_share: float = 0.2) -> DataFrame:
    """One row per document row and benchmark item that it holds: doc_id, item_id, n_words, edits, at_word.

    An item counts as held where its whole word sequence is within
    floor(max_share * n_words) word edits of a passage (items under five words:
    none). edits is the fewest found and at_word about where that passage
    begins. Null and wordless texts hold nothing and are held by nothing, null
    ids come back null, repeated rows give repeated results, other columns are
    ignored, empty tables give an empty table. Texts and items of any length
    are taken whole. The benchmark goes to the tasks in blocks of about
    BLOCK_BYTES of text, each held against all documents in a scan of its own.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, item_id long, n_words int, edits int, at_word int"
    out = None
    for shared in _indexes(items, item_id_col, item_text_col, max_share):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for part in chunks(batch, 1):
                    ids = part.column(0).to_pylist()
                    got = own.matches(part.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[x[0]] for x in got], pa.int64()), pa.array([own.ids[x[1]] for x in got], pa.int64()), *(pa.array([x[k] for x in got], pa.int32()) for k in (2, 3, 4))],
                        ["doc_id", "item_id", "n_words", "edits", "at_word"],
                    )

        one = slim.mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    return out


def keep_uncontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", max_share: float = 0.2) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no benchmark item in the sense of `contaminated`. Each row is judged by itself, whatever its id; null and wordless texts stay."""
    out = docs
    for shared in _indexes(items, item_id_col, item_text_col, max_share):

        def clean(texts: pa.Array, shared=shared) -> np.ndarray:
            keep = np.ones(len(texts), bool)
            keep[[d for d, *_ in shared.value.matches(texts.to_pylist())]] = False
            return keep

        out = filter_rows(out, text_col, clean)
    return out
