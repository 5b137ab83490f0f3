"""From documents to token ids: language, toxicity, near duplicates, benchmark leaks, BPE.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. The stages but the last return the columns of documents and drop rows;
the last returns each remaining document's ids and digests of ids and decoded text.

Rows with null or repeated ids are rows like any other: language, toxicity and
decontamination judge each by its text, near-dedup compares each by itself and
keeps, of a group, the row with the smallest id (null ids last, then the smallest
contents). Null and blank texts have no language and go in the first stage, as do
texts in a language or script that the documents' own languages do not explain.
Columns beside text and doc_id stay as they are, whatever their names. An empty
table gives an empty table.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm.bpe import bpe_encode_decode
from tripforge.llm.classifiers import fit_toxicity, keep_below
from tripforge.llm.decontaminate import keep_uncontaminated
from tripforge.llm.lang_id import fit_language_filters, fold, keep_identified
from tripforge.llm.near_dup import BROADCAST_IDS, near_duplicates
from tripforge.llm.queries import word_bpe_path
from tripforge.work import saved, saved_alone

#: A document from this toxicity score on goes.
TOXIC = 0.3


def _without(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of docs whose `key` is not the doc_id of any row of `ids`."""
    gone = saved(ids.select(F.col("doc_id").alias("__gone")), "gone")
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(key) == F.col("__gone"), "left_anti")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language learned from the documents themselves, by the score and the share of n-grams that `keep_identified` asks for. Others go: null texts, texts without a letter, other languages and scripts. Very long texts are judged whole; repeated rows are judged alike and all stay or go."""
    return keep_identified(docs, fit_language_filters(docs.where(fold("doc_id", 4) != 2)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score TOXIC or more. Rows are judged by their texts alone, null and repeated ids too; without labels nothing goes."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) != 2)
    return keep_below(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of near duplicates (five-word shingles, 0.8).

    Where ids are null or repeated, rows are numbered and compared as such; of a
    group stays the row with the smallest id, null ids last, then by contents.
    Rows of one id with different texts are different documents here.
    """
    if not docs.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count():
        return _without(docs, near_duplicates(docs).where(~F.col("kept")), "doc_id")
    rows = saved(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, "__row").select(F.col("doc_id").alias("__of"), F.col("component_id").alias("__group"))
    contents = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", contents.alias("contents"), "__row")
    first = rows.join(groups, F.col("__row") == F.col("__of")).groupBy("__group").agg(F.min(order).alias("r"))
    return rows.join(first.select(F.col("r.__row").alias("__first")), F.col("__row") == F.col("__first"), "left_semi").drop("__row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the decoded text, of every row; null and empty texts have no ids, repeated rows and null ids come back as they are."""
    both = bpe_encode_decode(docs, word_bpe_path())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify),
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: Learned models decide what stays, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. What a stage set down on its way is deleted once its rows are written; the rows themselves stay until `work.clean_up`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = saved_alone(functools.partial(stage, spark, docs, sf_dir), f"stage{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
