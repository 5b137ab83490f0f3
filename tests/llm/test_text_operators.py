"""Operators on documents against brute force, with odd rows: nulls, empty and very long texts, ties, repeated rows, clashing names, empty tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripforge.llm import ann, queries
from tripforge.llm.ann import nearest_neighbours
from tripforge.llm.bpe import WordBpe, bpe_encode_decode
from tripforge.llm.classifiers import fit_quality, fit_toxicity, score_documents
from tripforge.llm.decontaminate import allowed_edits, contaminated
from tripforge.llm.lang_id import fit_language_filters, fold, identify_languages
from tripforge.llm.near_dup import band_count, least_matches, near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, sig string, low string"
WORDS = [a + b for a in ("ka", "lo", "mi", "te", "ru", "so", "ve", "na") for b in ("ra", "li", "to", "me", "su", "ni", "do", "pe")]


def odd_rows():
    return [(9001, None), (9002, ""), (9003, " \t\r\n\x0b\x0c"), (9004, "one two"), (9005, "ONE two"), (9006, "é 中文 𝄞 ﬁ"), (None, "null id text here"), (9007, "x" * 100_000), (9008, "word " * 60_000)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "xx", "s", "clash", "clash") for i, t in rows], SCHEMA)


def sample(seed=1, groups=25):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [rng.choice(WORDS) for _ in range(rng.randint(2, 120))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


# ---- near duplicates ------------------------------------------------------------------------------------------------


def word_set(text, n):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(lower))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(rows, n, num, den):
    sets = {i: word_set(t, n) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("n, num", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, n, num):
    rows = sample() + odd_rows()
    got = near_duplicates(table(spark, rows), ngram=n, num=num).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute_components(rows, n, num, 100)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_near_duplicates_of_a_large_group(spark):
    """Many variants of one text, most of them not linked with the smallest id but with one another."""
    rng = random.Random(3)
    base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(80)]
    rows = []
    for k in range(300):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(80)] = f"new{rng.randrange(6)}"
        rows.append((k, " ".join(copy)))
    got = near_duplicates(table(spark, rows), ngram=3, num=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 3, 85, 100)


def test_near_duplicates_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "z")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(table(spark, rows), ngram=3, num=85).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert near_duplicates(table(spark, []), ngram=3, num=85).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark):
    """Every text of an id keeps its own links; the id's texts are one component; blank ones and null ids tie nothing."""
    rng = random.Random(21)
    a, b, c, d = ([rng.choice(WORDS) for _ in range(60)] for _ in range(4))
    near = lambda x: " ".join([*x[:-1], "changed"])
    rows = [(10, " ".join(a)), (10, " ".join(b)), (11, near(a)), (12, near(b)), (13, " ".join(c)), (13, " "), (14, None), (14, near(c)), (5, " ".join(d)), (None, near(d)), (6, near(d)), (None, None), (20, "")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(table(spark, rows)).collect()), key=str)
    whole = {10: 10, 11: 10, 12: 10, 13: 13, 14: 13, 5: 5, 6: 5, None: None, 20: 20}
    # the blank rows of 13 and 14 link with nothing, but are of their id
    expected = [(i, i if t is None or not t.strip() else whole[i]) for i, t in rows]
    assert [(i, c) for i, c, _ in got] == sorted(expected, key=str)
    assert all(k == (c is None or c == i) for i, c, k in got)


def test_near_duplicates_in_blocks_and_copies_of_hubs(spark, monkeypatch):
    from tripforge.llm import near_dup

    rows = sample(seed=5, groups=12)
    whole = {(r.doc_id, r.component_id) for r in near_duplicates(table(spark, rows), ngram=3, num=85).collect()}
    monkeypatch.setattr(near_dup, "BLOCK", 2)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 500)
    monkeypatch.setattr(near_dup, "PAIRS_PER_COPY", 1)
    assert {(r.doc_id, r.component_id) for r in near_duplicates(table(spark, rows), ngram=3, num=85).collect()} == whole


def test_bands_and_bounds():
    for t, rows in ((0.85, 6), (0.8, 5)):
        assert (1 - t**rows) ** band_count(t, rows) <= 1e-7
    least = least_matches(0.85)
    assert least == sorted(least) and 0.74 < least[-1] / 256 < 0.85


# ---- language -------------------------------------------------------------------------------------------------------


def test_language_accuracy_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op5_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97
    filters = fit_language_filters(docs.where(fold("doc_id", 4) != 2))
    assert filters.languages == sorted(r.lang for r in docs.select("lang").distinct().collect())
    rows = odd_rows() + [(5, "12 34 !?"), (5, "12 34 !?")]
    out = identify_languages(table(spark, rows), filters).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    und = {r.doc_id for r in out if r.lang_pred == "und"}
    assert und == {9001, 9002, 9003, 5}
    assert identify_languages(table(spark, []), filters).count() == 0


def test_language_filters_without_rows(spark):
    filters = fit_language_filters(table(spark, []))
    assert filters.languages == [] and [r.lang_pred for r in identify_languages(table(spark, [(1, "abc")]), filters).collect()] == ["und"]


def test_bloom_filters_hold_every_learned_gram(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(30)) if k % 2 else " ".join(rng.choice(["zyx", "qwk", "jvf"]) for _ in range(30)), "aa" if k % 2 else "bb") for k in range(60)]
    filters = fit_language_filters(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    names, score = filters.predict([r[1] for r in rows])
    assert names == [r[2] for r in rows] and min(score) > 0.9


# ---- BPE ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.word_bpe_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op6_bpe(spark, sf).collect()}
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_texts(spark, library):
    rng = random.Random(5)
    alphabet = "abceéèthing 'ssllrevetmd  .,!?\n\t0123ΣσİßÉ中文日<|>aaaa \x1c\x85٣½²"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["".join(rng.choice("abn") for _ in range(14)) for _ in range(1500)] + ["<|endoftext|>a<|startoftext|><|endoftext", "aaaa" * 500, "don't we'll 's"]
    rows = odd_rows() + list(enumerate(texts))
    got = bpe_encode_decode(table(spark, rows), queries.word_bpe_path()).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert list(by_id[i].ids) == ids, repr(t)[:60]
        assert by_id[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe_encode_decode(table(spark, []), queries.word_bpe_path()).count() == 0


def test_bpe_refuses_vocabularies_that_it_does_not_implement():
    import json

    with open(queries.word_bpe_path(), encoding="utf-8") as f:
        source = f.read()

    def refused(change, match):
        spec = json.loads(source)
        change(spec)
        with pytest.raises(ValueError, match=match):
            WordBpe(json.dumps(spec))

    refused(lambda s: s["model"]["vocab"].pop("z"), "lacks bytes")
    refused(lambda s: s.update(normalizer=None), "normalizer")
    refused(lambda s: s["pre_tokenizer"]["pretokenizers"][0].update(invert=False), "pre-tokenizer")
    refused(lambda s: s["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\s+|\S+"), "white space")
    refused(lambda s: s["model"].update(end_of_word_suffix=None), "word-end")
    refused(lambda s: s["added_tokens"][0].update(lstrip=True), "special tokens")
    spec = json.loads(source)
    spec["added_tokens"] = [{"id": 49406, "content": "[X]", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}]
    assert WordBpe(json.dumps(spec)).encode("a[X]")[1] == 49406


def test_every_token_is_its_own_encoding(library):
    model = WordBpe(open(queries.word_bpe_path(), encoding="utf-8").read())
    for word in ("internationalization", "the", "a", "aaaaaaa", "nananana"):
        assert model.encode(word) == library.encode(word, add_special_tokens=False).ids


# ---- classifiers ----------------------------------------------------------------------------------------------------


def test_bit_sliced_lookup_equals_plain_filters(spark):
    """A plain Python version: a set of positions per language, a look-up per n-gram, counts corrected one by one."""
    from tripforge.llm import lang_id

    rng = random.Random(4)
    alphabets = ("abcdeé", "bcdfgh", "中文字母表")
    make = lambda k: " ".join("".join(rng.choice(alphabets[k]) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 25)))
    rows = [(i, make(i % 3), "xyz"[i % 3]) for i in range(90)] + [(90, None, "x"), (91, "", "y"), (92, "a b", None)]
    filters = fit_language_filters(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def grams(text):
        word = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        return [f"\0{w}\0"[i : i + 3] for w in word for i in range(len(w)) if len(w) > 1]

    def places(gram):
        h = 0
        for c in gram:
            h = (h * 0x110001 + ord(c)) % 2**64
        h = int(lang_id.mix64(np.array([h], np.uint64))[0])
        step = h >> 32 | 1
        return [(h + k * step) % 2**64 % lang_id.POSITIONS for k in range(lang_id.HASHES)]

    held = [{p for p in np.flatnonzero(filters.words >> k & 1).tolist()} for k in range(3)]
    texts = [t for _, t, _ in rows] + ["zzz qqq", "aé中", "1 2 3", "a", "ab\ncd"]
    names, scores = filters.predict(texts)
    assert [(n, s) for t in texts for n, s in zip(*filters.predict([t]))] == list(zip(names, scores))
    for text, name, score in zip(texts, names, scores):
        found = grams(text)
        hits = [sum(all(p in held[k] for p in places(g)) for g in found) for k in range(3)]
        fixed = [max(0.0, (h - len(found) * r) / (1 - r)) for h, r in zip(hits, filters.false_rates)]
        if not any(c.isalpha() for c in text or ""):
            assert (name, score) == ("und", 0.0)
        elif max(fixed) > 0:
            assert name == "xyz"[fixed.index(max(fixed))] and abs(score - max(fixed) / sum(fixed)) < 1e-9
        else:
            assert (name, score) == (filters.common, 0.0)


def test_non_negative_risk_equals_a_plain_version():
    """Full-batch Adam on the clipped risk, with gradients by plain loops over dense rows."""
    import math

    from tripforge.llm.pu_learning import Rows, fit_nnpu

    rng = np.random.default_rng(3)
    n, prior, steps, rate = 6, 0.4, 60, 0.05
    lists = [[np.flatnonzero(rng.random(n) < 0.4) for _ in range(k)] for k in (9, 14)]
    w, _ = fit_nnpu(Rows.of(lists[0]), Rows.of(lists[1]), n, prior, steps=steps, rate=rate, decay=1e-5)
    weights, b, m, v = [0.0] * n, math.log(prior / (1 - prior)), [0.0] * (n + 1), [0.0] * (n + 1)
    sig, soft = (lambda z: 1 / (1 + math.exp(-z))), (lambda z: math.log1p(math.exp(-abs(z))) + max(z, 0))
    for t in range(1, steps + 1):
        z = [[b + sum(weights[j] for j in x) for x in side] for side in lists]
        negative = sum(map(soft, z[1])) / 14 - prior * sum(map(soft, z[0])) / 9
        g = [1e-5 * x for x in weights] + [0.0]
        for side, count in ((0, 9), (1, 14)):
            for x, own in zip(lists[side], z[side]):
                up = -prior * sig(-own) / 9 if side == 0 else 0.0
                down = (-prior if side == 0 else 1.0) * sig(own) / count
                d = up + down if negative >= 0 else -down
                for j in (*x.tolist(), n):
                    g[j] += d
        for j in range(n + 1):
            m[j], v[j] = 0.9 * m[j] + 0.1 * g[j], 0.999 * v[j] + 0.001 * g[j] ** 2
            step = rate * (m[j] / (1 - 0.9**t)) / (math.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
            if j < n:
                weights[j] -= step
            else:
                b -= step
    assert np.allclose(w, weights, atol=1e-9)


def labelled(spark, seed=1, n=600):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 80))]
        toxic, junk = rng.random() < 0.2, rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = "grumble" + rng.choice(["", "s", "d"])
        docs.append((k, " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words)))
        if k % 3:
            labels.append((k, int(not junk), int(toxic)))
    return table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {k: (q, t) for k, q, t in labels}


@pytest.mark.parametrize("fit, label, threshold", [(fit_quality, 0, 0.5), (fit_toxicity, 1, 0.3)])
def test_classifiers_on_held_out_rows(spark, fit, label, threshold):
    docs, labels, truth = labelled(spark)
    model = fit(docs, labels, lambda c: c % 4 != 2)
    got = {r.doc_id: r.score for r in score_documents(docs, model).collect()}
    held = [k for k in truth if k % 4 == 2]
    right = np.mean([(got[k] >= threshold) == bool(truth[k][label]) for k in held])
    assert right > 0.95
    odd = odd_rows() + [(9, "twice"), (9, "twice")]
    out = score_documents(table(spark, odd), model).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert score_documents(table(spark, []), model).count() == 0


def test_word_features_are_whole_words_and_their_beginnings():
    from tripforge.llm.classifiers import word_features

    long = "a" * 500
    f, o = word_features(["Hello, hello", None, "", "1 2", f"{long}b {long}c", "hell"])
    by = {k: set(f[o == k].tolist()) for k in range(6)}
    assert len(by[0]) == 4 and len(f[o == 0]) == 8 and not by[1] and not by[2] and not by[3]
    assert len(by[4]) == 2 + 6 and len(by[0] & by[5]) == 2 and len(by[5]) == 3
    assert all(set(word_features([t])[0].tolist()) == by[k] for k, t in ((0, "hello"), (5, "hell")))


@pytest.mark.parametrize("fit", [fit_quality, fit_toxicity])
def test_classifiers_without_labels(spark, fit):
    docs, labels, _ = labelled(spark, n=20)
    model = fit(docs, labels.where("false"), lambda c: c % 4 != 2)
    assert {0 <= r.score <= 1 for r in score_documents(docs, model).collect()} == {True}


# ---- decontamination ------------------------------------------------------------------------------------------------


def brute_matches(docs, items):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = {}
    for i, t in items:
        item = words(t)
        if not item:
            continue
        most = allowed_edits(len(item), 0.2)
        for d, text in docs:
            doc = words(text)
            row = [0] * (len(doc) + 1)
            for a, w in enumerate(item, 1):
                new = [a]
                for b, x in enumerate(doc, 1):
                    new.append(min(row[b] + 1, new[-1] + 1, row[b - 1] + (w != x)))
                row = new
            if min(row) <= most:
                found[d, i] = min(row)
    return found


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(6)
    long_words = [a + b for a in WORDS for b in WORDS[:20]]
    items = [(k, " ".join(rng.choice(long_words) for _ in range(rng.randint(2, 40)))) for k in range(30)] + [(100, None), (101, ""), (102, "?!")]
    docs = []
    for k in range(120):
        host = [rng.choice(long_words) for _ in range(rng.randint(0, 60))]
        passage = items[rng.randrange(30)][1].split()
        for _ in range(rng.choice([0, 0, 1, len(passage) // 5, len(passage) // 3])):
            kind, at = rng.randrange(3), rng.randrange(len(passage))
            if kind == 0:
                passage[at] = "edited"
            elif kind == 1 and len(passage) > 1:
                del passage[at]
            else:
                passage.insert(at, "added")
        at = rng.randint(0, len(host))
        docs.append((k, ", ".join(host[:at] + passage + host[at:]).upper() if k % 2 else " ".join(host[:at] + passage + host[at:])))
    odd = [r for r in odd_rows() if r[0] not in (9007, 9008)]
    got = contaminated(table(spark, docs + odd), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in got} == brute_matches(docs + odd, items)
    assert contaminated(table(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert contaminated(table(spark, docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("n_words", [300, 480, 1000])
def test_decontamination_of_long_items_beside_short_ones(n_words):
    from tripforge.llm.decontaminate import ItemIndex

    rng = random.Random(n_words)
    vocabulary = [a + b for a in WORDS for b in WORDS[:20]]
    written = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [written(rng.randint(20, 40)) for _ in range(220)] + [written(n_words) for _ in range(4)]
    texts = []
    for k in range(24):
        passage = list(items[220 + k % 4])
        for _ in range(n_words // 5):
            kind, at = rng.randrange(3), rng.randrange(len(passage))
            passage[at : at + (kind < 2)] = [] if kind == 1 else ["edited"]
        texts.append(" ".join(written(50) + passage + written(50)))
    index = ItemIndex(list(range(224)), [" ".join(x) for x in items], 0.2)
    got = index.matches(texts)
    assert [(d, i) for d, i, *_ in got] == [(k, 220 + k % 4) for k in range(24)]
    assert all(n == n_words and 0 < edits <= n_words // 5 for _, _, n, edits, _ in got)
    assert index.matches([" ".join(written(3 * n_words)), "", None]) == []


def test_decontamination_with_and_without_walks(monkeypatch):
    from tripforge.llm import decontaminate

    rng = random.Random(8)
    items = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(2, 90))) for _ in range(25)]
    texts = [" ".join([*(rng.choice(WORDS) for _ in range(rng.randint(0, 40))), *x.split()[: rng.randint(1, 90)], "end", *x.split()]) for x in items]
    walked = decontaminate.ItemIndex(list(range(25)), items, 0.2).matches(texts)
    monkeypatch.setattr(decontaminate, "LONG_ITEM", 0)
    assert [x[:4] for x in decontaminate.ItemIndex(list(range(25)), items, 0.2).matches(texts)] == [x[:4] for x in walked]


def test_decontamination_of_phrases_that_all_items_share():
    from tripforge.llm.decontaminate import ItemIndex

    rng = random.Random(12)
    vocabulary = [a + b for a in WORDS for b in WORDS[:20]]
    items = ["which of the following " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 30))) for _ in range(800)]
    index = ItemIndex(list(range(800)), items, 0.2)
    began = time.perf_counter()
    hot = "which of the following is " * 800
    assert index.matches([hot, hot + items[3], " ".join(x for x in items[5].split() if x != "following")]) == [(1, 3, len(items[3].split()), 0, 4000), (2, 5, len(items[5].split()), 1, 0)]
    assert time.perf_counter() - began < 10


def test_decontamination_of_items_that_differ_in_one_word():
    """Templates: a passage of one is near all others, and each says so; as often as a text repeats it."""
    from tripforge.llm.decontaminate import ItemIndex

    items = [f"what is the capital of the country {x}" for x in WORDS[:40]]
    index = ItemIndex(list(range(40)), items, 0.2)
    got = index.matches([f"{items[7]} and " * 200, "", None])
    assert [(d, i, e) for d, i, _, e, _ in got] == [(0, i, int(i != 7)) for i in range(40)]


def test_decontamination_of_very_long_items_and_texts(spark):
    rng = random.Random(13)
    vocabulary = [a + b for a in WORDS for b in WORDS]
    book = [rng.choice(vocabulary) for _ in range(8_000)]
    items = [(1, " ".join(book)), (2, "word word word word"), (3, " ".join(rng.choice(vocabulary) for _ in range(20)))]
    cut = [w for k, w in enumerate(book) if k % 6]
    docs = [(1, " ".join(book[5000:] + cut + book[:4000])), (2, " ".join(book[:6000])), *odd_rows()]
    got = {(r.doc_id, r.item_id): r.edits for r in contaminated(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1): len(book) - len(cut), (9008, 2): 0}
    from tripforge.llm.decontaminate import keep_uncontaminated

    kept = keep_uncontaminated(table(spark, [*docs, (None, "word word word word")]), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == table(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {1, 9008} and kept.where("doc_id is null").count() == 1


def test_pieces_are_disjoint_and_enough():
    from tripforge.llm.decontaminate import choose_pieces, word_hashes

    rng = random.Random(14)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    h, of = word_hashes(texts)
    items = [h[a:b] for a, b in itertools.pairwise(of)]
    edits = [allowed_edits(len(x), 0.2) for x in items]
    item, first, words = choose_pieces(items, edits)
    for i, x in enumerate(items):
        own = sorted((a, q) for a, q in zip(first[item == i].tolist(), words[item == i].tolist()))
        assert len(own) == edits[i] + 1 and own[0][0] >= 0 and own[-1][0] + own[-1][1] <= len(x)
        assert all(a + q <= b for (a, q), (b, _) in itertools.pairwise(own))


def test_decontamination_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 2000]
    got = {(r.doc_id, r.item_id): r.edits for r in queries.op4_decontamination(spark, sf).collect()}
    assert {k: v for k, v in got.items() if k[0] in dict(short)} == brute_matches(short, items)


def test_decontamination_in_blocks(spark, monkeypatch):
    from tripforge.llm import decontaminate

    items = [(k, f"alpha{k} beta{k} gamma{k} delta{k} end{k}") for k in range(12)]
    docs = [(k, f"x {t} y") for k, t in items]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    got = contaminated(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == {(k, k, 0) for k in range(12)}


# ---- neighbours -----------------------------------------------------------------------------------------------------


def test_neighbours_recall_order_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    rows = [(k, v.tolist(), "clash") for k, v in enumerate(x)]
    rows += [(2000, rows[100][1], ""), (2001, rows[100][1], ""), (2002, None, ""), (2003, [0.0] * 24, ""), (2004, [float("nan")] + [1.0] * 23, ""), (2005, [None] + [1.0] * 23, ""), (2006, [1.0] * 5, ""), (2100, [float("inf")] * 24, ""), (None, rows[0][1], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, list string")
    got = nearest_neighbours(df, lambda c: c % 100 == 0).toPandas()
    ids = np.array([*range(1500), 2000, 2001])
    full = np.concatenate([x, x[[100, 100]]]).astype(float)
    hit = 0
    queries_ = [i for i in ids if i % 100 == 0]
    for q in queries_:
        d = np.sqrt(((full - full[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert np.allclose(mine.score, [d[np.flatnonzero(ids == v)[0]] for v in mine.vec_id]) and list(mine.score) == sorted(mine.score)
        hit += len(set(best) & set(mine.vec_id))
    assert set(got.query_id) == set(queries_) and hit / (10 * len(queries_)) >= 0.9
    assert list(got[got.query_id == 100].sort_values("rank").vec_id[:2]) == [2000, 2001]


@pytest.mark.parametrize("n, alone", [(3_000, 65_536), (3_000, 100), (30_000, 65_536), (30_000, 100)])
def test_neighbours_recall_below_and_above_the_sample(spark, monkeypatch, n, alone):
    """Tables smaller and larger than what is sampled, fitted in one process and in tasks."""
    monkeypatch.setattr(ann, "ALONE", alone)
    assert (n > ann.SAMPLE) == (n == 30_000)
    rng = np.random.default_rng(n)
    v = (rng.standard_normal((60, 16))[rng.integers(0, 60, n)] * 2 + rng.standard_normal((n, 16))).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(v.ravel(), 16).cast(pa.list_(pa.float32()))})).repartition(5)
    got: dict = {}
    for r in ann.nearest_neighbours(df, lambda c: c % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = np.arange(0, n, 100)
    away = ((v[asked].astype(np.float64)[:, None, :] - v[None, :, :]) ** 2).sum(2) if n < 5_000 else np.stack([((v.astype(np.float64) - v[i]) ** 2).sum(1) for i in asked])
    away[np.arange(len(asked)), asked] = np.inf
    true = np.argpartition(away, 10, axis=1)[:, :10]
    assert np.mean([len(got[int(i)] & set(t.tolist())) / 10 for i, t in zip(asked, true)]) >= 0.9


def test_neighbours_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = nearest_neighbours(few, lambda c: c % 100 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 2), (0, 2, 1)]
    assert nearest_neighbours(few.where("false"), lambda c: c % 100 == 0).count() == 0


def test_equal_vectors_in_one_list(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0, 3.0]) for k in range(500)], "vec_id long, embedding array<float>")
    got = nearest_neighbours(same, lambda c: c % 100 == 0)
    assert [r.vec_id for r in got.where("query_id = 200").orderBy("rank").collect()] == list(range(10))
    assert got.agg(F.max("score")).first()[0] == 0.0


@pytest.mark.parametrize("kind, big", [("float", 1e30), ("double", 1e9)])
def test_neighbours_of_huge_and_of_close_components(spark, kind, big):
    """Squares beyond floats, and doubles that a float cannot tell apart; the largest ids repeat an id."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8)) * big if kind == "float" else big + rng.standard_normal((300, 8)) * 1e-3
    x = x.astype(np.float32).astype(float) if kind == "float" else x
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(299, x[0].tolist())]
    got = nearest_neighbours(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"), lambda c: c % 100 == 0).orderBy("query_id", "rank").collect()
    full, ids = np.concatenate([x, x[:1]]), np.append(np.arange(300), 299)
    hit = 0
    for q in (0, 100, 200):
        d = np.sqrt(((full - x[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        mine = [r for r in got if r.query_id == q]
        hit += len(set(np.lexsort((ids, d))[:10].tolist()) & {i for r in mine for i in np.flatnonzero(ids == r.vec_id)})
        assert len(mine) == 10 and all(np.isclose(r.score, d[ids == r.vec_id], rtol=1e-9).any() for r in mine)
    assert hit >= 27 and got[0].vec_id == 299 and got[0].score == 0


def test_neighbours_query_reaches_the_recall(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    got, hit, n = queries.op9_ann(spark, sf).toPandas(), 0, 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hit += len(set(ids[np.lexsort((ids, d))[:10]]) & set(got[got.query_id == ids[q]].vec_id))
        n += 10
    assert len(got) == n and hit / n >= 0.9


# ---- queries whose results are learned, on rows that they did not learn from ----------------------------------------


def test_language_query_on_held_out_rows(spark, sf):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op5_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in found) == sorted(rows) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    own = [r for r in found if r.held_out and rows[r.doc_id].lang is not None]
    assert len(own) > 20 and sum(r.lang_pred == rows[r.doc_id].lang for r in own) >= 0.97 * len(own)


@pytest.mark.parametrize("name, label, parts, out, threshold", [("op7_quality", "quality", 3, 1, 0.5), ("op10_toxicity", "toxic", 4, 2, 0.3)])
def test_scoring_queries_on_held_out_rows(spark, name, label, parts, out, threshold):
    sf = "/root/testdata/sf0.1"  # smaller tables have too few labels to learn from
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = queries.QUERIES[name](spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == out) and r.predicted == int(r.score >= threshold) and 0 <= r.score <= 1 for r in found)
    own = [(r.score, labels[r.doc_id], r.predicted) for r in found if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for s, y, _ in own if y == 1], [s for s, y, _ in own if y == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(good) > 50 and len(bad) > 50 and auc > 0.9 and np.mean([p == y for _, y, p in own]) > 0.95
