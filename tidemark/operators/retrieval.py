"""Chunks, keyword index, exact vector search, rank fusion and answer context.

Frames follow one shape: documents are ``id, content, embedding``; query batches are ``query_id, query, vector``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.texts import chunks, match_any, not_blank, query_terms, term_count, token_count, tokens
from ..session import broadcast_if_small, checkpointed, work_path
from .ranking import head_per_group, ranked_head, top_k

# Weights, constants and texts that results must carry exactly.
VECTOR_WEIGHT = 0.5
TEXT_WEIGHT = 0.5
RANK_CONSTANT = 60
MISSING_RANK = 999
POOL = 3  # candidates per list are POOL * k
CHUNK_CHARACTERS = 512
STATISTICS_TEXT = (
    "Search Statistics:\n- Total documents: %d\n- BM25 keyword matches: %d\n- Final results after RRF: %d\n\n"
)
PASSAGE_TEXT = "[Source %d] (Hybrid: %.4f, Vector: %.4f, BM25: %.2f)\n%s\n"
NOTHING_FOUND_TEXT = (
    "No relevant information found.\n\nSearch Statistics:\n- Total documents: %d\n- BM25 matches: %d"
)

# A term, as functions.texts.tokens finds it.
TERM = re.compile("[a-z0-9]+")

# Okapi BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75

# Query vectors handled in one pass over the corpus; more are answered in further passes.
QUERY_BYTES_PER_PASS = 32 * 1024 * 1024
# Queries whose scores against one Arrow batch are held at once.
QUERY_TILE = 512

# Winners up to which their ids are named when texts are fetched.
NAMED_IDS = 2000


# -- chunking and embedding -------------------------------------------------------------------------------


def chunked(df: DataFrame, text: str, size: int = CHUNK_CHARACTERS, keep: list[str] | None = None) -> DataFrame:
    """One row per chunk that is not blank, with its position ``chunk_no`` in the text."""
    kept = keep if keep is not None else [c for c in df.columns if c != text]
    pieces = df.select(*kept, F.posexplode(chunks(text, size)).alias("chunk_no", "content"))
    return pieces.where(not_blank("content"))


def embedded(df: DataFrame, content: str, embed: Callable[[pd.Series], pd.Series], name: str = "embedding") -> DataFrame:
    """Add vectors from any vectorised ``embed`` (one Arrow batch of texts in, one of vectors out)."""
    return df.withColumn(name, F.pandas_udf(embed, "array<float>")(F.col(content)))


def bucket_counts(content: Column, dims: int = 64) -> Column:
    """How many terms of a text fall into each of ``dims`` buckets, by the first 32 bits of their md5; null for a null text.

    One pass over an Arrow batch of texts; a term that the batch repeats is hashed once.
    """

    @F.pandas_udf("array<int>")
    def counted(texts: pd.Series) -> pd.Series:
        known: dict[str, int] = {}

        def bucket(term: str) -> int:
            known[term] = found = int.from_bytes(hashlib.md5(term.encode()).digest()[:4], "big") % dims
            return found

        def counts(text: str | None) -> np.ndarray | None:
            if text is None:
                return None
            at = [known[t] if t in known else bucket(t) for t in TERM.findall(text.lower())]
            return np.bincount(np.array(at, np.int64), minlength=dims).astype(np.int32)

        return pd.Series([counts(t) for t in texts], dtype=object)

    return counted(content)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` or a function within it refers to it."""
    return F.transform(F.array(value), use)[0]


def unit_vector(counts: Column, length: int = 1) -> Column:
    """Counts scaled to a length, in double precision; all zero where every count is."""
    square = lambda every: F.aggregate(every, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint") * x)
    scaled = lambda every, own: F.transform(every, lambda x: F.when(own > 0, x * length / own).otherwise(0.0))
    return _once(counts, lambda every: _once(F.sqrt(square(every)), lambda own: scaled(every, own)))


def hashed_vector(content: Column, dims: int = 64) -> Column:
    """A vector without a model: term counts by bucket, scaled to length 1; all zero for a text without terms."""
    return unit_vector(bucket_counts(content, dims)).cast("array<float>")


# -- keyword index and matching ---------------------------------------------------------------------------


def inverted_index(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``token, doc_id, tf``. Grouped on both columns, so a frequent token is spread over all tasks."""
    terms = df.select(F.col(doc_id).alias("doc_id"), F.explode(tokens(text)).alias("token"))
    return terms.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("tf"))


def write_index(index: DataFrame, path: str, buckets: int = 64) -> None:
    """Store an index in token buckets, each sorted by token.

    A lookup opens one folder and skips row groups by token. The spread over ``doc_id`` keeps a frequent token from
    being written by one task.
    """
    bucket = F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int")
    (
        index.withColumn("bucket", bucket)
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "token", "doc_id")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(path)
    )


def lookup_index(spark, path: str, query: str, buckets: int = 64) -> DataFrame:
    """Index rows of the query's terms; the bucket list is a literal, so other folders are not listed."""
    terms = query_terms(query)
    wanted = spark.createDataFrame([(t,) for t in terms], "token string")
    hit = sorted({r[0] for r in wanted.select(F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int")).collect()})
    return spark.read.parquet(path).where(F.col("bucket").isin(hit) & F.col("token").isin(terms)).drop("bucket")


def keyword_candidates(docs: DataFrame, query: str, limit: int) -> DataFrame:
    """First ``limit`` matches by id, all with score 1: ``id, text_score, text_rank``."""
    matches = docs.where(match_any("content", query)).select("id")
    return ranked_head(matches, limit, [F.asc("id")], "text_rank").select(
        "id", F.lit(1.0).alias("text_score"), F.col("text_rank").cast("bigint").alias("text_rank")
    )


def _term_hits(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, id`` once per shared term.

    A batch of queries has few terms, which are counted and then broadcast, so the corpus' tokens are matched where
    they are. For more terms than that the join shuffles by token, and AQE splits the frequent ones.
    """
    terms = queries.select("query_id", F.explode(F.array_distinct(tokens("query"))).alias("token"))
    words = docs.select("id", F.explode(F.array_distinct(tokens("content"))).alias("token"))
    return words.join(broadcast_if_small(terms, terms.count()), "token").select("query_id", "id")


def keyword_candidates_batch(docs: DataFrame, queries: DataFrame, limit: int) -> DataFrame:
    """The same for every query of a batch: ``query_id, id, text_score, text_rank``.

    A document that holds several terms of a query appears several times; ``dense_rank`` gives those rows one
    rank, so they need no shuffle to be merged before the cut, and each task sends at most ``limit``
    documents per query.
    """
    found = _term_hits(docs, queries)
    window = Window.partitionBy("query_id").orderBy("id")
    ranked = found.select("query_id", "id", F.dense_rank().over(window).alias("text_rank"))
    return (
        ranked.where(F.col("text_rank") <= limit)
        .distinct()
        .select("query_id", "id", F.lit(1.0).alias("text_score"), F.col("text_rank").cast("bigint").alias("text_rank"))
    )


def match_counts(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Documents matched per query, 0 included: ``query_id, matches``.

    Grouped by (query, document) first, so no query's matches gather in one task.
    """
    found = _term_hits(docs, queries)
    counted = found.groupBy("query_id").agg(F.count_distinct("id").alias("matches"))
    return queries.select("query_id").join(counted, "query_id", "left").select(
        "query_id", F.coalesce("matches", F.lit(0)).alias("matches")
    )


def search_counts(docs: DataFrame, query: str) -> DataFrame:
    """One row: ``total_docs`` and ``matches`` of one query, from one scan."""
    return docs.agg(
        F.count(F.lit(1)).alias("total_docs"), F.count_if(match_any("content", query)).alias("matches")
    )


def bm25(docs: DataFrame, query: str, k: int | None = None) -> DataFrame:
    """BM25 scores of documents that hold a query term: ``id, score``.

    Term counts are computed inside each row. The corpus statistics (documents, mean length, document frequency per
    term) come from one scan as a one-row scalar subquery; only matching documents are counted for the scores.
    """
    terms = query_terms(query)
    if not terms:
        return docs.select("id", F.lit(0.0).alias("score")).where(F.lit(False))
    stats = docs.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg(token_count("content")).alias("mean"),
            *[F.count_if(match_any("content", term)).alias(f"df{i}") for i, term in enumerate(terms)],
        ).alias("s")
    ).scalar()
    counted = docs.where(match_any("content", query)).select(
        "id",
        token_count("content").alias("length"),
        *[term_count("content", term).alias(f"tf{i}") for i, term in enumerate(terms)],
        stats.alias("s"),
    )
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df_ = F.col(f"tf{i}"), F.col(f"s.df{i}")
        idf = F.log(F.lit(1.0) + (F.col("s.n") - df_ + 0.5) / (df_ + 0.5))
        norm = tf + BM25_K1 * (1.0 - BM25_B + BM25_B * F.col("length") / F.col("s.mean"))
        score = score + idf * (tf * (BM25_K1 + 1.0)) / norm
    ranked = counted.select("id", score.alias("score"))
    return top_k(ranked, k, F.desc("score"), F.asc("id")) if k else ranked


# -- exact vector search ----------------------------------------------------------------------------------


def _nearest_in_batches(query_ids: list, matrix: np.ndarray, k: int, out: pa.Schema):
    """Arrow batches of ``id, embedding`` to the best ``k`` ids per query of this task.

    Products run as one matrix multiplication per batch. Ties at the cut are ordered by id, and vectors without a
    direction come last with a null score, so the union of all tasks' answers holds the exact answer.
    """
    dims = matrix.shape[1]
    lengths = np.linalg.norm(matrix, axis=1)
    unit = np.divide(matrix, lengths[:, None], out=np.full_like(matrix, np.nan), where=lengths[:, None] > 0)

    def scores_of(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Scores of a batch against one tile of queries after another, with the first query of each."""
        usable = np.asarray(pa.compute.equal(pa.compute.list_value_length(vectors), dims).fill_null(False))
        rows = vectors.filter(pa.array(usable))
        block = rows.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(rows), dims)
        norm = np.linalg.norm(block, axis=1)
        for first in range(0, len(unit), QUERY_TILE):
            part = block @ unit[first : first + QUERY_TILE].T
            part = np.divide(part, norm[:, None], out=np.full_like(part, np.nan), where=norm[:, None] > 0)
            full = np.full((len(vectors), part.shape[1]), np.nan)
            full[usable] = part
            yield first, full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, dtype="int64"), np.empty(0))] * len(query_ids)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            columns = ((first + k, tile[:, k]) for first, tile in scores_of(batch.column(1)) for k in range(tile.shape[1]))
            for q, scores in columns:
                all_ids = np.concatenate([best[q][0], ids])
                keyed = np.concatenate([best[q][1], scores])
                descending = np.where(np.isnan(keyed), np.inf, -keyed)
                if len(keyed) > k:
                    edge = np.partition(descending, k - 1)[k - 1]
                    near = descending <= edge
                    all_ids, keyed, descending = all_ids[near], keyed[near], descending[near]
                order = np.lexsort((all_ids, descending))[:k]
                best[q] = (all_ids[order], keyed[order])
        for q, query_id in enumerate(query_ids):
            ids, found = best[q]
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query_id] * len(ids), out.field(0).type),
                        pa.array(ids, pa.int64()),
                        pa.array(found, pa.float64(), from_pandas=True),
                    ],
                    schema=out,
                )

    return run


def nearest_batch(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact cosine neighbours for every query: ``query_id, id, vector_score, vector_rank``.

    The corpus is scanned where it lies and never paired with the queries in a join: each task multiplies its
    batches with the query matrix and sends on ``k`` rows per query. The matrix is kept below
    ``QUERY_BYTES_PER_PASS``; a larger batch of queries is split by hash and answered in several passes, each written
    before the next begins, so that only one pass' queries are held at a time.
    """
    spark = docs.sparkSession
    held = queries.where(F.col("vector").isNotNull()).select(
        F.col("query_id").cast("bigint"), F.col("vector").cast("array<double>").alias("vector")
    )
    size = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).first()
    schema = "query_id bigint, id bigint, vector_score double"
    if not size["n"]:
        return spark.createDataFrame([], schema + ", vector_rank bigint")
    passes = -(-size["n"] * size["dims"] * 8 // QUERY_BYTES_PER_PASS)
    # Hash slices vary in size; twice as many keeps each of them below the bound.
    passes = 1 if passes == 1 else passes * 2
    corpus = docs.select(F.col("id").cast("bigint").alias("id"), "embedding")
    out = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("vector_score", pa.float64())])
    found = None
    for number in range(passes):
        part = held.where(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == number) if passes > 1 else held
        for width, rows in _by_width(part.collect()).items():
            matrix = np.array([r["vector"] for r in rows], dtype="float64").reshape(len(rows), width)
            run = _nearest_in_batches([r["query_id"] for r in rows], matrix, k, out)
            answer = corpus.mapInArrow(run, schema)
            if passes > 1:
                path = work_path(spark, "nearest")
                answer.write.parquet(path)
                answer = spark.read.schema(schema).parquet(path)
            found = answer if found is None else found.unionByName(answer)
    ranked = head_per_group(
        found, ["query_id"], k, [F.desc_nulls_last("vector_score"), F.asc("id")], "vector_rank"
    )
    return ranked.withColumn("vector_rank", F.col("vector_rank").cast("bigint"))


def _by_width(rows: list) -> dict[int, list]:
    groups: dict[int, list] = {}
    for row in rows:
        groups.setdefault(len(row["vector"]), []).append(row)
    return groups


def nearest(docs: DataFrame, vector: list[float], k: int) -> DataFrame:
    """Exact cosine neighbours of one vector: ``id, vector_score, vector_rank``."""
    matrix = np.array([vector], dtype="float64")
    out = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("vector_score", pa.float64())])
    found = docs.select(F.col("id").cast("bigint").alias("id"), "embedding").mapInArrow(
        _nearest_in_batches([0], matrix, k, out), "query_id bigint, id bigint, vector_score double"
    )
    order = [F.desc_nulls_last("vector_score"), F.asc("id")]
    return ranked_head(found, k, order, "vector_rank").select(
        "id", "vector_score", F.col("vector_rank").cast("bigint").alias("vector_rank")
    )


# -- fusion and context -----------------------------------------------------------------------------------


def fused_score(vector_rank: Column, text_rank: Column) -> Column:
    return F.lit(VECTOR_WEIGHT) / (F.lit(RANK_CONSTANT) + vector_rank) + F.lit(TEXT_WEIGHT) / (
        F.lit(RANK_CONSTANT) + text_rank
    )


def _fused(vectors: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    both = vectors.join(words, keys, "full")
    missing = F.lit(MISSING_RANK)
    return both.select(
        *keys,
        F.coalesce("vector_score", F.lit(0.0)).alias("vector_score"),
        F.coalesce("text_score", F.lit(0.0)).alias("text_score"),
        fused_score(F.coalesce("vector_rank", missing), F.coalesce("text_rank", missing)).alias("hybrid_score"),
    )


def hybrid_search(docs: DataFrame, vector: list[float], query: str, k: int = 5) -> DataFrame:
    """Weighted reciprocal rank fusion of vector and keyword candidates.

    ``id, content, vector_score, text_score, hybrid_score``. The lists carry ids only; texts are fetched for the ``k``
    winners.
    """
    fused = _fused(nearest(docs, vector, POOL * k), keyword_candidates(docs, query, POOL * k), ["id"])
    winners = top_k(fused, k, F.desc("hybrid_score"), F.asc("id"))
    return (
        docs.select("id", "content")
        .join(winners, "id")
        .select("id", "content", "vector_score", "text_score", "hybrid_score")
        .orderBy(F.desc("hybrid_score"), F.asc("id"))
    )


def hybrid_search_batch(docs: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The same for a batch of queries, with the position ``rank`` of each hit."""
    return _hybrid_batch(docs, checkpointed(docs.sparkSession, queries), k)


def texts_of(texts: DataFrame, winners: DataFrame, many: int) -> DataFrame:
    """``winners`` with their ``content``. A few ids are named in the filter, so that row groups without them stay unread."""
    rows = texts.select("id", "content")
    if many <= NAMED_IDS:
        rows = rows.where(F.col("id").isin([r[0] for r in winners.select("id").distinct().collect()]))
    return rows.join(broadcast_if_small(winners, many), "id")


def indexed_search(vectors: DataFrame, index, texts: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``hybrid_search_batch`` from a keyword index and a table of ``id, embedding``; only the winners' texts are read."""
    queries = checkpointed(vectors.sparkSession, queries)
    winners = checkpointed(vectors.sparkSession, _winners(vectors, queries, index.first_matches_batch(queries, POOL * k), k))
    return texts_of(texts, winners, k * queries.count()).select(
        "query_id", "rank", "id", "content", "vector_score", "text_score", "hybrid_score"
    )


def indexed_context(vectors: DataFrame, index, texts: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """``answer_context`` from the same; documents and matches are counted from the index."""
    queries = checkpointed(vectors.sparkSession, queries)
    hits = indexed_search(vectors, index, texts, queries, k)
    return _context(hits, index.match_counts(queries), F.lit(index.counts()[0]).cast("bigint"))


def _winners(vectors: DataFrame, queries: DataFrame, words: DataFrame, k: int) -> DataFrame:
    fused = _fused(nearest_batch(vectors, queries, POOL * k), words, ["query_id", "id"])
    return head_per_group(fused, ["query_id"], k, [F.desc("hybrid_score"), F.asc("id")], "rank")


def _hybrid_batch(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    winners = _winners(docs, queries, keyword_candidates_batch(docs, queries, POOL * k), k)
    # At most k winners per query.
    return docs.select("id", "content").join(broadcast_if_small(winners, k * queries.count()), "id").select(
        "query_id", "rank", "id", "content", "vector_score", "text_score", "hybrid_score"
    )


def answer_context(docs: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """The text handed to an answering step, per query: statistics, then numbered passages."""
    queries = checkpointed(docs.sparkSession, queries)
    total = docs.agg(F.count(F.lit(1)).alias("total")).scalar()
    return _context(_hybrid_batch(docs, queries, k), match_counts(docs, queries), total)


def _context(hits: DataFrame, counts: DataFrame, total: Column) -> DataFrame:
    passage = F.format_string(PASSAGE_TEXT, "rank", "hybrid_score", "vector_score", "text_score", "content")
    passages = hits.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", passage.alias("text")))).alias("parts"),
        F.count(F.lit(1)).alias("results"),
    )
    found = counts.join(passages, "query_id", "left").withColumn("total", total)
    header = F.format_string(STATISTICS_TEXT, "total", "matches", "results")
    empty = F.format_string(NOTHING_FOUND_TEXT, "total", "matches")
    body = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return found.select(
        "query_id", F.when(F.col("results").isNull(), empty).otherwise(F.concat(header, body)).alias("context")
    )
