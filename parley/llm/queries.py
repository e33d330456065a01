"""The queries of this package's operators over the synthetic tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe_codec, decontaminate, doc_fingerprint, html_extract, language_id, lexical_search, license_scan, line_dedup, ngram_join, periodic_runs, sentence_codec, suffix_dedup, token_count
from parley.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train(docs.where(~F.coalesce(held_out, F.lit(False))))
    return language_id.identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_decode(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op8_doc_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_fingerprint.compare_neighbours(table(spark, sf_dir, "documents"))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


def op13_sentence_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_codec.encode_decode(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_line_dedup, op2_language_id, op3_bpe_codec, op4_ngram_join, op5_html_extract, op6_license_scan, op7_suffix_dedup, op8_doc_fingerprint, op9_token_count,
            op10_decontaminate, op11_lexical_search, op12_periodic_runs, op13_sentence_codec,
        )
    }


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)
), reach(x, y) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, s.n AS n_shingles, min(r.y) AS component_id FROM sizes s JOIN reach r ON r.x = s.doc_id GROUP BY 1, 2
"""


PASSAGES_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), stretches AS (
  SELECT doc_id, i AS start, array_to_string(w[i + 1 : i + 50], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM words WHERE len(w) >= 50) x
), shared AS (
  SELECT s, min(doc_id) AS a, max(doc_id) AS b FROM stretches GROUP BY s HAVING min(doc_id) <> max(doc_id)
), hits AS (
  SELECT DISTINCT doc_id, start, CASE WHEN a = doc_id THEN b ELSE a END AS other FROM stretches JOIN shared USING (s)
), marked AS (
  SELECT *, CASE WHEN start > lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 50 THEN 1 ELSE 0 END AS fresh FROM hits
), runs AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING) AS run FROM marked
)
SELECT doc_id, CAST(min(start) AS INTEGER) AS start, CAST(max(start) + 50 AS INTEGER) AS stop, min(other) AS other, CAST(max(start) + 50 - min(start) AS INTEGER) AS n_words FROM runs GROUP BY doc_id, run
"""


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH_SQL = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM words WHERE len(w) > 0),
asked AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) x GROUP BY 1, 2),
postings AS (
  SELECT doc_id, term, n, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM words) x
  WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3
), weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, totals GROUP BY term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_words))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY 1, 2
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
) x WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_join": NGRAM_JOIN_SQL, "op7_suffix_dedup": PASSAGES_SQL, "op11_lexical_search": SEARCH_SQL}
