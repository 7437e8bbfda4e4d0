"""Chunking, keyword and vector search, fusion and context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import retrieval as r
from ..operators.keywords import KeywordIndex, single
from ..session import work_path
from ..sources.readers import spread
from ..sources.star import raw
from .base import query

# Parameters of the single-query entries: one stored vector and two words of middling frequency.
QUERY_VECTOR_ID = 7
QUERY_WORDS = "enein ensch"

TOKENS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"


def tokens_sql(column: str) -> str:
    return TOKENS.format(column)


def any_term_sql(column: str, words: str) -> str:
    terms = ", ".join(f"'{w}'" for w in words.split())
    return f"list_has_any({tokens_sql(column)}, [{terms}])"


DOCS_SQL = """docs AS (SELECT doc_id AS id, text AS content, CAST(embedding AS DOUBLE[]) AS embedding
  FROM documents LEFT JOIN embeddings ON doc_id = vec_id)"""
TEXTS_SQL = "texts AS (SELECT doc_id AS id, text AS content FROM documents)"
QV_SQL = f"qv AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = {QUERY_VECTOR_ID})"


def documents_with_vectors(spark: SparkSession, directory: str) -> DataFrame:
    texts = documents(spark, directory)
    vectors = raw(spark, directory, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return texts.join(vectors, "id", "left")


def all_texts(spark: SparkSession, directory: str) -> DataFrame:
    return spread(raw(spark, directory, "documents").select("doc_id", "text"))


def texts_only(spark: SparkSession, directory: str) -> DataFrame:
    return all_texts(spark, directory).select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return raw(spark, directory, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


_STORES: dict[tuple[str, str], tuple[KeywordIndex, str]] = {}


def search_store(spark: SparkSession, directory: str) -> tuple[KeywordIndex, DataFrame]:
    """The keyword index over ``documents``, and a table of ``id, embedding`` with a row for every document.

    Both are stored once per application and folder, as an ingest job does; the queries read them. The documents come in two
    ingests, one per kind of language, so that answers are put together from several segments.
    """
    key = (spark.sparkContext.applicationId, directory)
    if key not in _STORES:
        docs = raw(spark, directory, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang")
        index, vectors = KeywordIndex(spark, work_path(spark, "keywords")), work_path(spark, "vectors")
        english = F.col("lang").eqNullSafe("en")
        for name, part in (("english", english), ("other", ~english)):
            index.add(spread(docs.where(part)), name)
        documents_with_vectors(spark, directory).select("id", "embedding").write.parquet(vectors)
        _STORES[key] = index, vectors
    index, vectors = _STORES[key]
    return index, spark.read.parquet(vectors)


def query_vector(spark: SparkSession, directory: str) -> list[float]:
    row = raw(spark, directory, "embeddings").where(F.col("vec_id") == QUERY_VECTOR_ID).select("embedding").first()
    return list(row[0])


def label_queries(spark: SparkSession, directory: str) -> DataFrame:
    """One query per label: the mean of its vectors, and the benchmark text with the label's number."""
    spread = raw(spark, directory, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = spread.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vectors = means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("vector")
    )
    items = raw(spark, directory, "benchmark").select(F.col("item_id").alias("label"), F.col("text").alias("query"))
    return vectors.withColumn("label", F.col("label").cast("bigint")).join(items, "label").select(
        F.col("label").alias("query_id"), "query", "vector"
    )


LABEL_QUERIES_SQL = """means AS (
  SELECT label, pos, avg(x) AS m FROM (
    SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
  GROUP BY label, pos),
queries AS (
  SELECT CAST(v.label AS BIGINT) AS query_id, b.text AS query, v.vector FROM
    (SELECT label, list(m ORDER BY pos) AS vector FROM means GROUP BY label) v
    JOIN benchmark b ON b.item_id = v.label)"""

COSINE = """list_inner_product({a}, {b}) / nullif(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})), 0)"""


def cosine_sql(a: str, b: str) -> str:
    return COSINE.format(a=a, b=b)


def vector_list_sql(k: int) -> str:
    return f"""v AS (SELECT id, score AS vector_score, row_number() OVER (ORDER BY score DESC NULLS LAST, id) AS vector_rank
  FROM (SELECT id, {cosine_sql("embedding", "q")} AS score FROM docs, qv)
  ORDER BY score DESC NULLS LAST, id LIMIT {k})"""


def text_list_sql(k: int) -> str:
    return f"""t AS (SELECT id, 1.0 AS text_score, row_number() OVER (ORDER BY id) AS text_rank
  FROM docs WHERE {any_term_sql("content", QUERY_WORDS)} ORDER BY id LIMIT {k})"""


@query(
    "tx_1",
    """SELECT doc_id, CAST(i AS BIGINT) AS chunk_no, substring(text, CAST(i * 512 + 1 AS BIGINT), 512) AS content
    FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 511) // 512)) AS i FROM documents WHERE length(text) > 0)
    WHERE regexp_matches(substring(text, CAST(i * 512 + 1 AS BIGINT), 512), '\\S')""",
)
def tx_1(spark, directory):
    pieces = r.chunked(all_texts(spark, directory), "text", 512, ["doc_id"])
    return pieces.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


@query(
    "tx_2",
    f"""SELECT token, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({tokens_sql("text")}) AS token FROM documents)
    GROUP BY 1, 2""",
)
def tx_2(spark, directory):
    return search_store(spark, directory)[0].postings()


@query("tx_3", f"WITH {DOCS_SQL}, {text_list_sql(15)} SELECT id, CAST(text_score AS DOUBLE) AS text_score, text_rank FROM t")
def tx_3(spark, directory):
    return search_store(spark, directory)[0].first_matches(QUERY_WORDS, 15)


@query(
    "tx_4",
    f"""WITH d AS (SELECT doc_id, {tokens_sql("text")} AS t FROM documents),
    l AS (SELECT doc_id, len(t) AS length, len(list_filter(t, lambda x: x = 'enein')) AS tf0,
      len(list_filter(t, lambda x: x = 'ensch')) AS tf1 FROM d),
    s AS (SELECT count(*) AS n, avg(length) AS mean, count(*) FILTER (tf0 > 0) AS df0, count(*) FILTER (tf1 > 0) AS df1 FROM l)
    SELECT doc_id AS id, round(
      ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 * 2.2 / (tf0 + 1.2 * (0.25 + 0.75 * length / mean)) +
      ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * length / mean)), 6) AS score
    FROM l, s WHERE tf0 > 0 OR tf1 > 0""",
)
def tx_4(spark, directory):
    found = search_store(spark, directory)[0].bm25(single(spark, QUERY_WORDS))
    return found.select("id", F.round("score", 6).alias("score"))


BM25_SQL = f"""d AS (SELECT doc_id AS id, {tokens_sql("text")} AS t FROM documents),
    s AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM d),
    terms AS (SELECT DISTINCT query_id, unnest({tokens_sql("query")}) AS token FROM queries),
    tf AS (SELECT id, token, count(*) AS tf, any_value(length) AS length FROM
      (SELECT id, len(t) AS length, unnest(t) AS token FROM d) SEMI JOIN terms USING (token) GROUP BY id, token),
    df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
    scored AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 9) AS score
      FROM tf JOIN df USING (token) JOIN terms USING (token), s GROUP BY query_id, id)"""


@query(
    "tx_4_top",
    f"""WITH queries AS (SELECT 0 AS query_id, '{QUERY_WORDS}' AS query), {BM25_SQL}
    SELECT id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scored
    QUALIFY rank <= 10""",
)
def tx_4_top(spark, directory):
    found = search_store(spark, directory)[0].top_bm25(single(spark, QUERY_WORDS), 10)
    return found.select("id", F.round("score", 6).alias("score"), "rank")


@query(
    "tx_4_batch",
    f"""WITH {LABEL_QUERIES_SQL}, {BM25_SQL}
    SELECT query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM scored QUALIFY rank <= 10""",
)
def tx_4_batch(spark, directory):
    found = search_store(spark, directory)[0].top_bm25(label_queries(spark, directory), 10)
    return found.withColumn("score", F.round("score", 6))


@query(
    "tx_5",
    f"""SELECT count(*) AS total_docs, count(*) FILTER ({any_term_sql("text", QUERY_WORDS)}) AS matches FROM documents""",
)
def tx_5(spark, directory):
    return search_store(spark, directory)[0].search_counts(QUERY_WORDS)


@query(
    "vs_1",
    f"WITH {DOCS_SQL}, {QV_SQL}, {vector_list_sql(15)} SELECT id, round(vector_score, 6) AS vector_score, vector_rank FROM v",
)
def vs_1(spark, directory):
    docs = documents_with_vectors(spark, directory)
    return r.nearest(docs, query_vector(spark, directory), 15).withColumn("vector_score", F.round("vector_score", 6))


VECTOR_BATCH_SQL = """vb AS (SELECT * FROM (SELECT query_id, id, score AS vector_score,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, id) AS vector_rank
  FROM (SELECT query_id, id, {cosine} AS score FROM {docs}, queries)) WHERE vector_rank <= {k})"""


@query(
    "vs_2",
    f"""WITH {LABEL_QUERIES_SQL}, corpus AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings),
    {VECTOR_BATCH_SQL.format(cosine=cosine_sql("embedding", "vector"), docs="corpus", k=15)}
    SELECT query_id, id, round(vector_score, 6) AS vector_score, vector_rank FROM vb""",
)
def vs_2(spark, directory):
    corpus = raw(spark, directory, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    found = r.nearest_batch(corpus, label_queries(spark, directory), 15)
    return found.withColumn("vector_score", F.round("vector_score", 6))


FUSED = "0.5 / (60 + coalesce(vector_rank, 999)) + 0.5 / (60 + coalesce(text_rank, 999))"


@query(
    "tx_6",
    f"""WITH {DOCS_SQL}, {QV_SQL}, {vector_list_sql(15)}, {text_list_sql(15)},
    listed AS (SELECT id, vector_score AS near, NULL AS worded, vector_rank AS a, NULL AS b FROM v
      UNION ALL SELECT id, NULL, text_score, NULL, text_rank FROM t),
    fused AS (SELECT id, coalesce(max(near), 0) AS near, coalesce(max(worded), 0) AS worded,
      0.5 / (60 + coalesce(min(a), 999)) + 0.5 / (60 + coalesce(min(b), 999)) AS total FROM listed GROUP BY id)
    SELECT id, content, round(near, 6) AS vector_score, CAST(worded AS DOUBLE) AS text_score, round(total, 8) AS hybrid_score
    FROM fused JOIN docs USING (id) QUALIFY row_number() OVER (ORDER BY total DESC, id) <= 5""",
)
def tx_6(spark, directory):
    index, vectors = search_store(spark, directory)
    one = single(spark, QUERY_WORDS).withColumn("vector", F.array(*[F.lit(float(x)) for x in query_vector(spark, directory)]))
    found = r.indexed_search(vectors, index, documents(spark, directory), one, 5)
    return found.select(
        "id", "content", F.round("vector_score", 6).alias("vector_score"), "text_score", F.round("hybrid_score", 8).alias("hybrid_score")
    )


MATCHES_SQL = f"""terms AS (SELECT DISTINCT query_id, unnest({tokens_sql("query")}) AS token FROM queries),
doc_terms AS (SELECT DISTINCT id, unnest({tokens_sql("content")}) AS token FROM docs),
hits AS (SELECT DISTINCT query_id, id FROM doc_terms JOIN terms USING (token)),
tb AS (SELECT * FROM (SELECT query_id, id, 1.0 AS text_score,
  row_number() OVER (PARTITION BY query_id ORDER BY id) AS text_rank FROM hits) WHERE text_rank <= 9)"""


@query(
    "tx_7",
    f"""WITH {DOCS_SQL}, {LABEL_QUERIES_SQL}, {MATCHES_SQL},
    {VECTOR_BATCH_SQL.format(cosine=cosine_sql("embedding", "vector"), docs="docs", k=9)},
    f AS (SELECT coalesce(v.query_id, t.query_id) AS query_id, coalesce(v.id, t.id) AS id,
      coalesce(vector_score, 0) AS vector_score, coalesce(text_score, 0) AS text_score, {FUSED} AS hybrid_score
      FROM vb v FULL JOIN tb t ON v.query_id = t.query_id AND v.id = t.id),
    w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hybrid_score DESC, id) AS rank FROM f)
      WHERE rank <= 3),
    p AS (SELECT query_id, count(*) AS results, string_agg('[Source ' || rank || '] (Hybrid: ' ||
      printf('%.4f', CAST(hybrid_score AS DOUBLE)) || ', Vector: ' || printf('%.4f', CAST(vector_score AS DOUBLE)) ||
      ', BM25: ' || printf('%.2f', CAST(text_score AS DOUBLE)) || ')' || chr(10) || content || chr(10), '' ORDER BY rank) AS body
      FROM w JOIN docs ON docs.id = w.id GROUP BY query_id),
    m AS (SELECT q.query_id, count(h.id) AS matches FROM queries q LEFT JOIN hits h ON h.query_id = q.query_id GROUP BY 1)
    SELECT m.query_id, 'Search Statistics:' || chr(10) || '- Total documents: ' || (SELECT count(*) FROM docs) || chr(10) ||
      '- BM25 keyword matches: ' || matches || chr(10) || '- Final results after RRF: ' || results || chr(10) || chr(10) ||
      body AS context FROM m JOIN p ON p.query_id = m.query_id""",
)
def tx_7(spark, directory):
    index, vectors = search_store(spark, directory)
    return r.indexed_context(vectors, index, documents(spark, directory), label_queries(spark, directory), 3)


@query(
    "wn_3",
    f"""WITH {DOCS_SQL}, {LABEL_QUERIES_SQL}, {MATCHES_SQL},
    {VECTOR_BATCH_SQL.format(cosine=cosine_sql("embedding", "vector"), docs="docs", k=9)}
    SELECT coalesce(v.query_id, t.query_id) AS query_id, coalesce(v.id, t.id) AS id, vector_rank, text_rank
    FROM vb v FULL JOIN tb t ON v.query_id = t.query_id AND v.id = t.id""",
)
def wn_3(spark, directory):
    (index, stored), queries = search_store(spark, directory), label_queries(spark, directory)
    vectors = r.nearest_batch(stored, queries, 9).select("query_id", "id", "vector_rank")
    words = index.first_matches_batch(queries, 9).select("query_id", "id", "text_rank")
    return vectors.join(words, ["query_id", "id"], "full")
