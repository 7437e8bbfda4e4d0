"""Registered queries of this subpackage, and the SQL each must equal where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codes, decontamination, exact_dedup, jaccard, langid, licenses, mixing, packing, pages, pii, quality, spelling, wordids
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


@query(
    "op1_ngram_jaccard",
    r"""WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        shingles AS MATERIALIZED (
          SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
          FROM words WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        near AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


@query("op2_pii")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


@query("op3_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_licenses", licenses.check_sql())
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


@query(
    "op5_exact_dedup",
    r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""",
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.resolve(table(spark, folder, "documents"))


@query(
    "op6_decontamination",
    r"""WITH item_words AS (
          SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
          FROM benchmark),
        item_windows AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                 lambda i: array_to_string(w[i:i + 9], ' '))) AS win
          FROM item_words WHERE len(w) > 0),
        doc_words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS o
          FROM documents),
        lowered AS (SELECT doc_id, list_transform(o, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM doc_words),
        doc_windows AS (
          SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS begin_at, unnest(list_transform(range(1, len(w) - n + 2),
                 lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
          FROM lowered, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n),
        found AS (SELECT doc_id, begin_at, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
        hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
                  SELECT doc_id, unnest(range(begin_at, begin_at + n)) AS pos FROM found) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
                  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM lowered LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


@query("op7_mixing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.scored(table(spark, folder, "documents"))


@query("op8_main_text")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(table(spark, folder, "pages"))


@query("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identified(table(spark, folder, "documents"))


@query("op11_word_bpe")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return wordids.digests(table(spark, folder, "documents"))


@query("op12_vector_codes", codes.check_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compressed(table(spark, folder, "embeddings"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))
