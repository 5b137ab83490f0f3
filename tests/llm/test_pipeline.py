"""The pipeline's stages against what they should keep."""

from __future__ import annotations

import gc
import re

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tripforge import work
from tripforge.llm.bpe import bpe_encode_decode
from tripforge.llm.lang_id import fit_language_filters, identify_languages, keep_identified
from tripforge.llm.queries import word_bpe_path
from tests.llm.test_text_operators import brute_components, brute_matches


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "MinHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    kept, current = [set(rows)], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        current = stage(spark, current, sf).cache()
        kept.append({r.doc_id for r in current.select("doc_id").collect()})
        if k < 4:
            assert current.columns == docs.columns
    lettered = {i for i, r in rows.items() if re.search(r"[^\W\d_]", r.text or "")}
    assert kept[1] == lettered
    clean = {i for i in kept[1] if labels.get(i) == 0}
    assert len(clean & kept[2]) / len(clean) > 0.95
    one = brute_components([(i, rows[i].text) for i in sorted(kept[2])], 5, 80, 100)
    assert kept[3] == {i for i, (_, c) in one.items() if c == i}
    held = {d for d, _ in brute_matches([(i, rows[i].text) for i in sorted(kept[3]) if len(rows[i].text) < 4000], items)}
    assert held.isdisjoint(kept[4]) and kept[4] <= kept[3]
    assert kept[5] == kept[4] and set(current.columns) >= {"doc_id", "n_tokens", "ids"}


def test_stages_take_odd_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "some words here", "en", "s", 1), (2, "some words there", None, None, None), (2, "some words there", None, None, None)], docs.schema)
    for table in (docs, odd):
        current = table
        for _, stage in corpus_pipeline.STAGES:
            current = stage(spark, current, sf).cache()
        assert current.count() == (0 if table is docs else 2)


def test_rows_with_null_and_repeated_ids_are_judged_like_any_other(spark, sf):
    """Clashing extra columns, a very long text, repeated rows; nothing clean is lost, nothing else stays."""
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    words = lambda seed, n: " ".join(f"{'abcdefghij'[(seed * k + k * k) % 10]}{'klmnopqrst'[(seed + k * 7) % 10]}ation{seed}" for k in range(n))
    a, b, c, long = words(1, 40), words(2, 40), words(3, 40), words(4, 120_000)
    rows = [(7, a, "x"), (7, b, "y"), (None, a, "z"), (None, c, "w"), (None, c, "w"), (8, c + " end", "v"), (None, f"{words(5, 30)} {item}", "u"), (9, long, "t"), (3, long + " end", "s"), (4, "", "r"), (5, None, "q")]
    table = spark.createDataFrame([(i, t, "xx", "s", 1, e, e) for i, t, e in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string, `__gone` string")
    current = table
    for name, stage in corpus_pipeline.STAGES[2:4]:
        current = stage(spark, current, sf).cache()
        assert current.columns == table.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0, r["component_id"]) for r in current.collect())
    assert kept == [(False, 3, "s"), (False, 4, "r"), (False, 5, "q"), (False, 7, "x"), (False, 7, "y"), (False, 8, "v")]
    encoded = corpus_pipeline.STAGES[4][1](spark, current, sf).collect()
    assert sorted(r.doc_id for r in encoded) == [3, 4, 5, 7, 7, 8]
    both = spark.createDataFrame([(7, a, "xx", "s", 1, "x", "x"), (None, "1 2 3", "xx", "s", 1, "y", "y")], table.schema)
    for _, stage in corpus_pipeline.STAGES[:2]:
        both = stage(spark, both, sf)
        assert both.columns == table.columns
    assert [r.doc_id for r in both.collect()] == [7]


def test_language_stage_rejects_what_was_not_learned(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    german = [r["text"] for r in rows if r["lang"] == "de" and len(r["text"]) > 400][:5]
    texts = ["Привет, мир, как дела сегодня", "これは日本語の文章です", "zzz qqq xxx wwq kkz qxq", "A.", "12 34", german[0], german[1] * 200, "Привет и пока " * 50 + german[2][:60]]
    more = spark.createDataFrame([(10_000_000 + i, t, None, "s", len(t)) for i, t in enumerate(texts)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs.unionByName(more), sf).select("doc_id").collect()}
    assert {i for i in kept if i >= 10_000_000} == {10_000_003, 10_000_005, 10_000_006}
    assert {r["doc_id"] for r in rows if re.search(r"[^\W\d_]", r["text"] or "")} <= kept
    filters = fit_language_filters(docs)
    only = {r.doc_id for r in keep_identified(docs, filters, languages=("de",)).collect()}
    told = {r.doc_id: r for r in identify_languages(docs, filters).collect()}
    assert only and only == {i for i, r in told.items() if r.lang_pred == "de"}
    high = {r.doc_id for r in keep_identified(docs, filters, least_score=0.6).collect()}
    assert {i for i, r in told.items() if r.score >= 0.6} <= high < {r["doc_id"] for r in rows}


def test_run_leaves_only_the_rows_of_stages(spark, sf):
    before = set(work._made)
    assert corpus_pipeline.run(spark, sf).count() > 0
    left = work._made - before
    assert len(left) == len(corpus_pipeline.STAGES) - 1


def test_workers_let_go_of_the_vocabulary(spark):
    """A worker that goes on to other work holds no model of an encoding that is done."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("some word "), F.col("id").cast("string")).alias("text")).repartition(8)
    assert bpe_encode_decode(docs, word_bpe_path()).agg(F.sum(F.size("ids"))).first()[0] > 0

    def held(batches):
        for _ in batches:
            pass
        gc.collect()
        yield pa.RecordBatch.from_pydict({"n": [sum(type(x).__name__ == "WordBpe" for x in gc.get_objects())]})

    assert {r.n for r in spark.range(80).repartition(8).mapInArrow(held, "n long").collect()} == {0}
