"""Alignment of tokenizers against the libraries and plain loops."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripforge.llm import alignment
from tripforge.llm.queries import QUERIES

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain(texts):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    byte = {chr(b) if b in visible else chr(next(rest)): b for b in range(256)}
    docs, counts, out = [], Counter(), []
    for text in texts:
        groups, links = [], []
        if text:
            raw = (" " + text).encode()
            a = [(i, bytes(byte[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for i in sp.encode(text):
                p = sp.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                spans = []
                for side in (a, b):
                    at, own = 0, []
                    for i, x in side:
                        own.append((i, at, at + len(x)))
                        at += len(x)
                    spans.append(own)
                at = [0, 0]
                for e in sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]}):
                    groups.append([[], []])
                    for k in (0, 1):
                        while at[k] < len(spans[k]) and spans[k][at[k]][2] <= e:
                            groups[-1][k].append(spans[k][at[k]][0])
                            at[k] += 1
                over = defaultdict(list)  # B tokens by the bytes that they cover
                for j, u, v in spans[1]:
                    for x in range(u, v):
                        over[x].append((j, u))
                links = [(i, j) for i, s, f in spans[0] for j, _ in sorted({y for x in range(s, f) for y in over[x]}, key=lambda y: y[1])]
        docs.append((groups, links))
        counts.update(set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    for groups, links in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def got(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


TEXTS = [
    None, "", " ", "a", "  two  spaces", "line\nbreaks\n\n\tand tabs\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "ﬁ ① é é ñandú", "▁low line", "日本語のテキスト 한국어 \U0001f600\U0001f468‍\U0001f469", "\x00\x01 control",
    "don't we'll they've 12345 67.89", "Supercalifragilisticexpialidocious " * 40, "x" * 3000, "the cat sat on the mat", "the cat sat on the mat", "lorem ipsum " * 2000,
]


@pytest.mark.parametrize("most", [2_000_000, 40, 0])
def test_against_plain_loops(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", most)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, row int, pair string")
    assert got(alignment.align_tokenizers(df, A, B)) == sorted((str(i), *x) for i, x in enumerate(plain(TEXTS)))


def test_repeated_and_null_ids_and_empty_tables(spark):
    rows = [(1, "one two"), (1, "one two"), (None, "one two three"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(alignment.align_tokenizers(df, A, B)) == sorted((str(i), *x) for (i, _), x in zip(rows, plain([t for _, t in rows])))
    assert got(alignment.align_tokenizers(df.limit(0), A, B)) == []


def test_counts_and_best_matches(spark):
    df = spark.createDataFrame([(1, "the cat"), (2, "the dog"), (3, "them")], "doc_id long, text string")
    both = alignment.vocabularies(open(A, "rb").read(), open(B, "rb").read())
    counts = alignment.pair_counts(alignment.encode_both(df, A, B), both.same, both.nb)
    the = both.encoder.encode_ordinary(" the")[0]
    assert both.b_bytes[both.same[the]] == b" the"
    assert {r.pair: r.n for r in counts.collect()}[the * both.nb + int(both.same[the])] == 2
    assert (the, int(both.same[the]), 2) in {tuple(r) for r in alignment.best_matches(counts, both.nb).collect()}


def test_query_equals_plain_loops(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = got(QUERIES["op12_token_alignment"](spark, sf))
    assert found == sorted((str(r.doc_id), *x) for r, x in zip(rows, plain([r.text for r in rows])))
