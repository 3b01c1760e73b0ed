"""The operators applied to the driver tables with production settings, and the SQL they agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import table
from panelkit.llm.decontamination import contaminated
from panelkit.llm.exact_dedup import exact_duplicates
from panelkit.llm.fingerprints import fingerprints
from panelkit.llm.html_text import extracted_pages
from panelkit.llm.language import predicted_languages
from panelkit.llm.line_dedup import without_recurring_lines
from panelkit.llm.packing import packed_documents
from panelkit.llm.ranked_search import ranked
from panelkit.llm.simhash import near_duplicates
from panelkit.llm.substring_dedup import without_repeats
from panelkit.llm.token_files import encoded_documents
from panelkit.llm.warc import archived_pages
from panelkit.llm.whitening import whitened

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = predicted_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), TOKENIZER, CAPACITY)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_id", "coverage", F.size("tiles").alias("n_tiles"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_pages(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_dropped")
    return found.select("doc_id", "n_dropped", F.sha2("text", 256).alias("kept_sha256"), F.octet_length("text").alias("n_bytes"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH found AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), sizes AS (SELECT doc_id, len(terms) AS n, terms FROM found WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sizes),
counts AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sizes) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts CROSS JOIN corpus GROUP BY term
), items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // total)))) AS BIGINT) AS score
    FROM items JOIN weights USING (term) JOIN counts USING (term) CROSS JOIN corpus GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_language, op3_best_fit_packing, op4_substring_dedup, op5_token_files,
        op6_warc, op7_simhash, op8_decontamination, op9_html_text, op10_line_dedup, op11_fingerprints, op12_ranked_search, op13_whitening,
    )
}
ORACLES = {"op1_exact_dedup": OP1_SQL, "op6_warc": OP6_SQL, "op12_ranked_search": OP12_SQL}
