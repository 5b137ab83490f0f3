"""The opN queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm.alignment import align_tokenizers
from tripforge.llm.ann import nearest_neighbours
from tripforge.llm.bpe import bpe_encode_decode
from tripforge.llm.chat_format import as_records, digests, format_chats, gather_turns
from tripforge.llm.classifiers import fit_quality, fit_toxicity, score_documents
from tripforge.llm.cover_tree import near_vectors
from tripforge.llm.decontaminate import contaminated
from tripforge.llm.lang_id import fit_language_filters, fold, identify_languages
from tripforge.llm.near_dup import near_duplicates
from tripforge.llm.spelling import count_words, spelling_variants
from tripforge.llm.url_filters import filter_urls, host_of
from tripforge.llm.warc import page_records, read_pages, write_warc
from tripforge.work import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_bpe_path() -> str:
    return tokenizer_path("word_bpe_49k.json")


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries from the hosts of `pages`: some hosts join, leave and rejoin a block list, some sections are blocked or allowed for good."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    h = F.length("host") * 7 + F.ascii(F.col("host")) * 13 + F.ascii(F.substring("host", 3, 1)) * 31 + F.ascii(F.substring("host", -12, 1)) * 17
    hosts = hosts.withColumn("h", h)

    def entry(name: str, kind: str, pattern, action: str, day):
        return F.struct(F.lit(name).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"), F.lit(action).alias("action"), F.timestamp_seconds(F.lit(1704067200) + day * 86400).alias("since"))

    host, own = F.col("host"), F.col("h")
    several = F.array(entry("spam", "block", host, "add", own % 5), entry("spam", "block", host, "remove", 8 + own % 5), entry("spam", "block", host, "add", 18 + own % 5))
    section = F.array(entry("sections", "block", F.concat(host, F.lit("/en")), "add", own % 20))
    trusted = F.array(entry("trusted", "allow", F.concat(host, F.lit("/en")), "add", own % 25))
    none = F.filter(several, lambda x: F.lit(False))
    chosen = F.concat(F.when(own % 3 == 0, several).otherwise(none), F.when(own % 4 == 1, section).otherwise(none), F.when(own % 5 == 2, trusted).otherwise(none))
    return hosts.select(F.explode(chosen).alias("e")).select("e.*")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(2592000))).alias("fetched_at"))
    out = filter_urls(captures, dated_entries(pages), "page_id")
    return out.select(F.col("capture_id").alias("page_id"), "host", "blocked", "n_active", "pattern", F.array_join("lists", ",").alias("lists"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    write_warc(page_records(_table(spark, sf_dir, "pages")), path)
    return read_pages(spark, path)


#: A conversation whose texts look like control strings.
PLANTED = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text"))
    return digests(format_chats(as_records(gather_turns(rows.unionByName(planted)))))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    filters = fit_language_filters(docs.where(fold("doc_id", 4) != 2))
    return identify_languages(docs, filters).select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe_encode_decode(_table(spark, sf_dir, "documents"), word_bpe_path())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _scored(docs: DataFrame, model, parts: int, out: int, threshold: float) -> DataFrame:
    return score_documents(docs, model).select("doc_id", F.coalesce(fold("doc_id", parts) == out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"), lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(3)) != 1)
    return _scored(docs, model, 3, 1, 0.5)


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), ngram=3, num=85, den=100)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), lambda c: c % 100 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"), lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) != 2)
    return _scored(docs, model, 4, 2, 0.3)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(_table(spark, sf_dir, "documents"), damage=31), ratio=10)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_warc": op2_warc,
    "op3_chat_format": op3_chat_format,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_bpe": op6_bpe,
    "op7_quality": op7_quality,
    "op8_near_dup": op8_near_dup,
    "op9_ann": op9_ann,
    "op10_toxicity": op10_toxicity,
    "op11_spelling": op11_spelling,
    "op12_token_alignment": op12_token_alignment,
    "op13_embedding_dedup": op13_embedding_dedup,
}

SQL: dict[str, str] = {
    "op1_url_filters": r"""
        WITH c AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds(((page_id * 7919) % 2592000 + 2592000) % 2592000) AS ts,
                          nullif(lower(regexp_replace(regexp_replace(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '') AS host,
                          regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
             h AS (SELECT DISTINCT host, length(host) * 7 + ascii(host) * 13 + ascii(substr(host, 3, 1)) * 31 + ascii(substr(host, -12, 1)) * 17 AS h FROM c WHERE host IS NOT NULL),
             v AS (SELECT 'spam' AS list, 'block' AS kind, host AS pattern, h % 5 AS since, 8 + h % 5 AS until FROM h WHERE h % 3 = 0
                   UNION ALL SELECT 'spam', 'block', host, 18 + h % 5, NULL FROM h WHERE h % 3 = 0
                   UNION ALL SELECT 'sections', 'block', host || '/en', h % 20, NULL FROM h WHERE h % 4 = 1
                   UNION ALL SELECT 'trusted', 'allow', host || '/en', h % 25, NULL FROM h WHERE h % 5 = 2),
             w AS (SELECT list, kind, pattern, TIMESTAMP '2024-01-01' + to_days(since::INTEGER) AS since, TIMESTAMP '2024-01-01' + to_days(until::INTEGER) AS until FROM v),
             k AS (SELECT page_id, ts, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS key FROM c, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i)
                   UNION ALL SELECT page_id, ts, host || '/' || array_to_string(list_slice(s, 1, i), '/') FROM (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM c WHERE host IS NOT NULL), LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i)),
             j AS (SELECT page_id, count(*) AS n_active, max({'n': length(pattern), 'allow': kind = 'allow', 'pattern': pattern}) AS best, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
                   FROM k JOIN w ON lower(key) = pattern AND ts >= since AND (until IS NULL OR ts < until) GROUP BY page_id)
        SELECT c.page_id, host, coalesce(NOT best.allow, false) AS blocked, coalesce(n_active, 0) AS n_active, best.pattern AS pattern, coalesce(lists, '') AS lists
        FROM c LEFT JOIN j USING (page_id)""",
    "op3_chat_format": r"""
        WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
             g AS (SELECT conv_id, count(*) AS n_turns,
                          string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS flat,
                          coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
                          sum(16 + length(CASE WHEN regexp_full_match(role, '[A-Za-z0-9_-]*') THEN role ELSE 'x:' || hex(encode(role)) END)
                              + length(regexp_replace(text, '<(\\*)(turn |/turn>)', '<_\1\2', 'g')))::BIGINT AS formatted_chars
                   FROM r GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""",
    "op8_near_dup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
             s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM w),
             e AS (SELECT doc_id, hash(unnest(sh)) AS g FROM s),
             n AS (SELECT doc_id, len(sh) AS n FROM s),
             c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
             k AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
             u AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
             r AS (SELECT DISTINCT a, a AS b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
             m AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY 1)
        SELECT n.doc_id, n.n AS n_shingles, coalesce(m.least, n.doc_id) AS component_id, coalesce(m.least, n.doc_id) = n.doc_id AS kept FROM n LEFT JOIN m USING (doc_id)""",
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
             d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
             f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op13_embedding_dedup": """
        WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             k AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
             r AS (SELECT DISTINCT a, a AS b FROM k UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
             m AS (SELECT a AS vec_id, min(b) AS least FROM r GROUP BY 1),
             n AS (SELECT a AS vec_id, count(*) AS n_links FROM k GROUP BY 1)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN m USING (vec_id) LEFT JOIN n USING (vec_id)""",
}
