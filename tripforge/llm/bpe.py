"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a piece there is exactly one token that can end its
encoding. An automaton of all tokens that follows suffix links finds, at each end
position, the tokens that are suffixes of the prefix; a token fits when the last token stored for
the remaining prefix may stand before it. Following those last tokens back from
the full piece gives the ids that applying the merges by rank would give.

Two neighbouring tokens are compatible when no merge would have joined a part
on the right edge of the first with a part on the left edge of the second
before those parts went into larger parts of their own token.
"""

from __future__ import annotations

import json
import math
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.work import bounded_batches

#: White space as the normalizer takes it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
#: The steps that a vocabulary file must ask for; the pattern of pieces is read from the file.
NORMALIZERS, PRE_TOKENIZERS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]

#: Characters that str.split() takes for white space though they are none here.
_NOT_WHITE = regex.compile(r"[\x1c-\x1f]")
_WHITE_RUN = regex.compile(f"[{WHITE}]+")
#: Added to the code of a byte's character when it ends a word.
_FINAL = 0x400
#: Entries of a worker's memo of chunks and words; a full one is kept as the older generation until the next is full.
MEMO = 150_000


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself if visible in Latin-1, else the next code point from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


def _piece_pattern(spec: dict) -> str:
    """The pattern of pieces; a file that asks for other steps than those written here raises."""
    normal = (spec.get("normalizer") or {}).get("normalizers", [])
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [x["type"] for x in normal] != NORMALIZERS or normal[1]["pattern"] != {"Regex": r"\s+"} or normal[1]["content"] != " ":
        raise ValueError("the vocabulary's normalizer is not NFC, white space to one space, lower case")
    if [x["type"] for x in before] != PRE_TOKENIZERS or (before[0]["behavior"], before[0]["invert"]) != ("Removed", True) or before[1]["add_prefix_space"] or before[1].get("use_regex", True):
        raise ValueError("the vocabulary's pre-tokenizer does not take the pieces of a pattern as bytes")
    pattern = before[0]["pattern"]["Regex"]
    if regex.search(pattern, " "):
        raise ValueError("the vocabulary's pieces hold white space")
    return pattern


class WordBpe:
    """A vocabulary with word-end tokens, as read from a tokenizer file's JSON text.

    A file whose model, normalizer or pre-tokenizer is another one than the class
    implements, or whose vocabulary lacks a byte, raises.
    """

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""
        if not end or model.get("type") != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("a BPE vocabulary with a word-end suffix and nothing else is needed")
        self.names: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.names |= {i: t for t, i in self.specials.items()}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        if any(t.get(x) for t in spec.get("added_tokens", []) for x in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special tokens must match as they are")
        self._marks = {t[0] for t in self.specials if t}
        self._pattern = regex.compile(_piece_pattern(spec))

        def symbols(token: str) -> str:
            return token[: -len(end) - 1] + chr(ord(token[-len(end) - 1]) + _FINAL) if token.endswith(end) and len(token) > len(end) else token

        ids = model["vocab"]
        if lacking := [b for b, c in enumerate(_byte_characters()) if c not in ids or c + end not in ids]:
            raise ValueError(f"the vocabulary lacks bytes: {lacking[:5]}")
        self._parts: dict[int, tuple[int, int]] = {}
        self._rank: dict[tuple[int, int], int] = {}
        self._made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = ids[left], ids[right], ids[left + right]
            if (a, b) not in self._rank:
                self._rank[a, b] = rank
            if whole not in self._made:
                self._made[whole], self._parts[whole] = rank, (a, b)
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._strings: pa.Array | None = None
        self._fits: dict[int, bool] = {}
        self._whole: dict[str, int] = {}
        self._automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            # a vocabulary entry counts if its own symbols encode to it
            if self._stable(i):
                s = symbols(token)
                self._automaton.add_word(s, (i, len(s)))
                self._whole[s] = i
        self._automaton.make_automaton()
        self._bytes = _byte_characters()

    def _edge(self, token: int, side: int, top: float) -> list[tuple[int, float]]:
        """The parts on one edge of a token, outermost first, each with the rank at which it goes into the next."""
        out, until = [], top
        while True:
            out.append((token, until))
            if token not in self._parts:
                return out
            until = self._made[token]
            token = self._parts[token][side]

    def _joined(self, left: int, right: int, top: float) -> bool:
        """Whether a merge crosses the border between two tokens before rank `top`."""
        for a, until_a in self._edge(left, 1, top):
            for b, until_b in self._edge(right, 0, top):
                rank = self._rank.get((a, b))
                if rank is None:
                    continue
                at = max(rank, self._made.get(a, -1), self._made.get(b, -1))
                # of equal merges the leftmost goes first
                if at < until_a and (at <= until_b if until_b != top else at < top):
                    return True
        return False

    def _stable(self, token: int) -> bool:
        if token not in self._parts:
            return True
        return not self._joined(*self._parts[token], self._made[token])

    def fits(self, left: int, right: int) -> bool:
        key = left << 20 | right
        got = self._fits.get(key)
        if got is None:
            if len(self._fits) > 150_000:
                self._fits.clear()
            got = self._fits[key] = not self._joined(left, right, math.inf)
        return got

    def encode_piece(self, piece: str) -> list[int]:
        names = self._bytes
        s = "".join([names[b] for b in piece.encode("utf-8", "surrogatepass")])
        s = s[:-1] + chr(ord(s[-1]) + _FINAL)
        one = self._whole.get(s)
        if one is not None:
            return [one]
        n = len(s)
        last: list[int] = [-1] * (n + 1)
        size = [0] * (n + 1)
        fits = self._fits
        for at, (token, length) in self._automaton.iter(s):
            stop = at + 1
            if last[stop] >= 0:
                continue
            start = stop - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = fits.get(before << 20 | token)
                if ok is None:
                    ok = self.fits(before, token)
                if not ok:
                    continue
            last[stop], size[stop] = token, length
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _keep(self, chunk: str, got: bytes) -> bytes:
        if len(chunk) <= 64:
            self._memo[chunk] = got
        return got

    def _encode_word(self, piece: str) -> bytes:
        """Of one piece; a piece of letters encodes as a chunk of its own would."""
        got = self._memo.get(piece) or self._older.get(piece)
        if got is None:
            got = array("i", self.encode_piece(piece)).tobytes()
            if piece.isalpha():
                self._keep(piece, got)
        return got

    def _encode_chunk(self, chunk: str) -> bytes:
        """Ids, as bytes of int32, of a text without white space."""
        if got := self._older.get(chunk):
            return self._keep(chunk, got)
        normal = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if normal.isalpha():
            return self._keep(chunk, self._encode_word(normal))
        return self._keep(chunk, b"".join([self._encode_word(piece) for piece in self._pattern.findall(normal)]))

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a whole text, as bytes of int32."""
        if len(self._memo) >= MEMO:
            self._memo, self._older = {}, self._memo
        memo, chunked, ids = self._memo, self._encode_chunk, []
        for k, part in enumerate(self._special.split(text) if self._special and any(m in text for m in self._marks) else [text]):
            if k % 2:
                ids.append(np.int32(self.specials[part]).tobytes())
            else:
                ids += [memo.get(c) or chunked(c) for c in (part.split() if _NOT_WHITE.search(part) is None else filter(None, _WHITE_RUN.split(part)))]
        return b"".join(ids)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by one space, as for a vocabulary file without a decoder."""
        return " ".join([self.names[i] for i in ids])

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """Every list decoded, by one gather and one join."""
        if self._strings is None:
            self._strings = pa.array([self.names.get(i, "") for i in range(max(self.names) + 1)], pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self._strings.take(ids.values)), " ")


class Vocabulary:
    """A tokenizer file's JSON text, as it is broadcast. A worker builds its model once and keeps it, memo and all, as long as it keeps the broadcast, which ends with the next function that does not use it."""

    def __init__(self, source: str) -> None:
        self.source, self._model = source, None

    def __reduce__(self) -> tuple:
        return Vocabulary, (self.source,)

    def model(self) -> WordBpe:
        if self._model is None:
            self._model = WordBpe(self.source)
        return self._model


def bpe_encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array of int), decoded (string).

    `vocabulary` is the path of a tokenizer file on the driver; its text, whose
    size does not depend on the data, is broadcast, after it is held against what
    WordBpe needs. Whole texts are encoded, a
    null text as an empty one, without special tokens added; special tokens'
    strings in a text give their ids. Repeated rows come back repeated, a null
    id as null, other columns are ignored, an empty table gives an empty table.
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = f.read()
    WordBpe(source)
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.model()
        for batch in batches:
            i = 0
            while i < batch.num_rows:
                ids, begin, room = [], i, 2_000_000
                while i < batch.num_rows and room > 0:
                    ids.append(model.encode_bytes(batch.column(1)[i].as_py() or ""))
                    room -= len(ids[-1])
                    i += 1
                ends = pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i - begin), lists, model.decode_all(lists)], ["doc_id", "ids", "decoded"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
