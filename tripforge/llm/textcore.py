"""Vectorised helpers over Arrow string columns, used inside Spark tasks.

Words are maximal runs of bytes other than space and 0x09-0x0D; because those
separators are ASCII, working on UTF-8 bytes splits exactly as on code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from tripforge.work import bounded_batches

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SEPARATOR] = 0
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(64, 1 << (n - 1).bit_length())
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))])
    return _powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def words(raw: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its hash, first byte and end; and the n + 1 offsets of documents into words."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(at), np.int64)
    inside = ~_SEPARATOR[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[(at > 0) & (at < len(raw))]
    begins[edges] = inside[edges]  # a document's first byte begins a word though the byte before it is of another one
    starts = np.flatnonzero(begins)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(at), np.int64)
    final = inside.copy()
    final[:-1] &= ~inside[1:]
    final[edges - 1] = inside[edges - 1]
    ends = np.flatnonzero(final) + 1
    spans = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
    lengths = ends - starts
    place = np.minimum(place, np.int64(lengths.max()))  # separators count nothing
    table = _power_table(int(lengths.max()) + 1)
    hashed = np.add.reduceat((_BYTE_LOWER if lower else _BYTE)[raw[starts[0] :]] * table[place], starts - starts[0])
    return mix64(hashed + lengths.astype(np.uint64)), starts, ends, np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-word shingles and documents' offsets into them; fewer words make one shingle, none make none."""
    count = np.diff(of)
    salts = mix64(np.arange(1, n + 1, dtype=np.uint64)) | U64(1)
    if len(hashes) >= n:
        rolled = hashes[: len(hashes) - n + 1] * salts[0]
        for k in range(1, n):
            rolled = rolled + hashes[k : len(hashes) - n + 1 + k] * salts[k]
        rolled = mix64(rolled)
    else:
        rolled = np.zeros(0, np.uint64)
    short = (count > 0) & (count < n)
    sizes = np.where(count >= n, count - n + 1, short.astype(np.int64))
    out_of = np.concatenate([[0], np.cumsum(sizes)])
    if not short.any() and (count == 0).sum() == 0:
        keep = np.ones(len(rolled), bool)
        for k in range(1, n):
            cut = of[1:-1] - k
            keep[cut[(cut >= 0) & (cut < len(keep))]] = False
        return rolled[keep], out_of
    out = np.zeros(out_of[-1], np.uint64)
    full = count >= n
    begin = np.repeat(of[:-1][full] - out_of[:-1][full], sizes[full])
    target = np.flatnonzero(np.repeat(full, sizes))
    out[target] = rolled[target + begin]
    for i in np.flatnonzero(short):
        own = hashes[of[i] : of[i + 1]]
        tag = np.array([len(own)], np.uint64) * U64(0xD6E8FEB86659FD93)
        out[out_of[i]] = mix64(tag + (own * salts[: len(own)]).sum())[0]
    return out, out_of


def digest128(sorted_set: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit integers that stand for a set given as a sorted array."""
    d = hashlib.blake2b(sorted_set.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def chunks(batch: pa.RecordBatch, text: int, limit: int = 1_000_000):
    """Slices of a batch with at most about `limit` bytes of text each, one row at least."""
    column = batch.column(text)
    lengths = np.nan_to_num(np.asarray(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.float64))
    total = np.cumsum(lengths)
    i = 0
    while i < batch.num_rows:
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(i, j - i)
        i = j


def filter_rows(docs: DataFrame, text_col: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of `docs`, all columns, for whose text `keep` says True. No shuffle; each row is judged by itself."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, at):
                yield part.filter(pa.array(np.asarray(keep(part.column(at)), bool)))

    return docs.mapInArrow(run, docs.schema)
