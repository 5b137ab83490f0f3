"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tripforge.llm import spelling
from tripforge.llm.queries import QUERIES


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts: dict[str, int], ratio: int = 10) -> set:
    # candidates share a half, which one edit leaves as it is
    halves: dict = {}
    for w in counts:
        for h in {w[: len(w) // 2], w[: (len(w) - 1) // 2], w[: (len(w) + 1) // 2]}:
            halves.setdefault(("p", h), set()).add(w)
        for k in range((len(w) - 1) // 2, len(w) // 2 + 2):
            halves.setdefault(("s", w[k:]), set()).add(w)
    form, close = {}, {}
    for w, n in counts.items():
        found = set()
        for h in {w[: len(w) // 2], w[: (len(w) - 1) // 2], w[: (len(w) + 1) // 2]}:
            found |= halves[("p", h)]
        for k in range((len(w) - 1) // 2, len(w) // 2 + 2):
            found |= halves[("s", w[k:])]
        found = [x for x in found if near(w, x)]
        close[w] = len(found)
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, close[w], counts[form[w]] if form[w] else None) for w, n in counts.items()}


def got(df) -> set:
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


def test_random_words_over_small_blocks(spark, monkeypatch):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 9, 10, 100, 1000]) for _ in range(1500)}
    counts |= {"aaaaaaa": 5, "a" * 3000: 7, "a" * 3001: 70, "a" * 1500 + "b" + "a" * 1499: 700, "\U0001f600ab": 3, "\U0001f600b": 30}
    monkeypatch.setattr(spelling, "BLOCK", 60)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.spelling_variants(df)) == plain(counts)


def test_trie_nodes_are_one_per_prefix():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    nodes, at, count = spelling.trie_nodes(words)
    of: dict = {}
    for i, w in enumerate(words):
        for k in range(len(w)):
            assert of.setdefault(w[: k + 1], nodes[at[i] + k]) == nodes[at[i] + k]
    assert len(set(of.values())) == len(of) == count and set(of.values()) == set(range(count))


def test_chains_odd_rows_and_extra_columns(spark):
    rows = [("banane", 2), ("bananen", 20), ("bananena", 200), ("bananenas", 2000), (None, 5), ("", 9), ("zebra", None), ("alleine", 3)]
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in rows], "word string, n long, form string, id int")
    want = {w: n for w, n in rows if w and n}
    found = got(spelling.spelling_variants(df))
    assert found == plain(want)
    assert ("banane", "bananen", "bananenas", 2, 1, 20) in found
    assert got(spelling.spelling_variants(df.limit(0))) == set()
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, ratio=1)


def test_words_of_documents(spark):
    text = "Straßen Straßen ÉTUDES ÉTUDES x" + " Wörterbuch" * 3 + "÷×wörterbuch"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, "wörterbuch " * 2)], "doc_id long, text string")
    assert {tuple(r) for r in spelling.count_words(df).collect()} == {("straßen", 2), ("wörterbuch", 4)}  # × and ÷ are in the range, so the last run is another word


def damaged(rows) -> dict[str, int]:
    counts: Counter = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_query_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = got(QUERIES["op11_spelling"](spark, sf))
    assert found == plain(damaged(rows))
    assert any(x[1] for x in found)
