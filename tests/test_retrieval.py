"""Chunking, matching, BM25, vector search and fusion against plain Python."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import texts, vectors
from tidemark.operators import retrieval as r

WORDS = ["red", "green", "blue", "lamp", "ship", "tree"]


def corpus_rows(n=60, dims=5):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        content = " ".join(rng.choice(WORDS, size=rng.integers(1, 9)))
        vector = [float(np.float32(x)) for x in rng.normal(size=dims)]
        rows.append((i, content, vector))
    rows[5] = (5, rows[5][1], [0.0] * dims)
    rows[6] = (6, rows[6][1], None)
    rows[7] = (7, rows[7][1], [1.0, 2.0])  # another width
    rows[9] = (9, rows[9][1], rows[8][2])  # a copy
    rows[10] = (10, None, rows[10][2])
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus_rows(), "id bigint, content string, embedding array<float>").repartition(4).cache()


def cosine(a, b):
    if a is None or len(a) != len(b) or not any(a) or not any(b):
        return None
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))


def nearest(vector, k):
    scored = [(cosine(v, vector), i) for i, _, v in corpus_rows()]
    scored.sort(key=lambda s: (-s[0] if s[0] is not None else math.inf, s[1]))
    return [(i, s) for s, i in scored[:k]]


def terms(text):
    return [t for t in re.split("[^a-z0-9]+", (text or "").lower()) if t]


def matches(query, k=None):
    wanted = set(terms(query))
    return [i for i, c, _ in corpus_rows() if wanted & set(terms(c))][:k]


def fused(vector, query, k):
    near = {i: (rank, s) for rank, (i, s) in enumerate(nearest(vector, 3 * k), 1)}
    words = {i: rank for rank, i in enumerate(matches(query, 3 * k), 1)}
    scores = {
        i: 0.5 / (60 + near.get(i, (999, 0))[0]) + 0.5 / (60 + words.get(i, 999)) for i in near.keys() | words.keys()
    }
    return sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]


QUERY, VECTOR = "Red LAMP!", [0.3, -1.0, 0.2, 0.9, 0.1]


def test_tokens_and_counts(spark):
    df = spark.createDataFrame([("  The Cat, the 2nd-cat ",), ("",), ("...",), (None,), ("end",)], "t string")
    found = df.select(texts.tokens("t").alias("a"), texts.token_count("t").alias("n"), texts.term_count("t", "cat").alias("c"))
    assert [r["a"] for r in found.collect()] == [["the", "cat", "the", "2nd", "cat"], [], [], None, ["end"]]
    assert [(r["n"], r["c"]) for r in found.collect()][:3] == [(5, 2), (0, 0), (0, 0)]


def test_match_any_needs_whole_terms(spark):
    df = spark.createDataFrame([("a cat",), ("concatenate",), ("CAT-like",), ("cats",), (None,)], "t string")
    assert [r[0] for r in df.select(texts.match_any("t", "dog cat")).collect()] == [True, False, True, False, False]
    assert df.where(texts.match_any("t", " ,")).count() == 0


@pytest.mark.parametrize("length, pieces", [(0, []), (1, [1]), (511, [511]), (512, [512]), (513, [512, 1]), (1024, [512, 512])])
def test_chunk_sizes(spark, length, pieces):
    df = spark.createDataFrame([(1, "é" * length)], "id int, text string")
    assert [len(x["content"]) for x in r.chunked(df, "text").orderBy("chunk_no").collect()] == pieces


def test_blank_chunks_and_lines(spark):
    text = "a" * 512 + " " * 512 + "\n" * 100 + "b\U0001f600c"
    df = spark.createDataFrame([(1, text), (2, "   "), (3, None)], "id int, text string")
    found = r.chunked(df, "text").orderBy("chunk_no").collect()
    assert [(x["id"], x["chunk_no"]) for x in found] == [(1, 0), (1, 2)]
    assert found[1]["content"].endswith("b\U0001f600c")


def test_cosine_expression(spark):
    df = spark.createDataFrame(corpus_rows(), "id bigint, content string, embedding array<float>")
    found = df.select("id", vectors.cosine_similarity("embedding", vectors.vector_literal(VECTOR)).alias("s")).collect()
    want = {i: cosine(v, VECTOR) for i, _, v in corpus_rows()}
    for row in found:
        assert (row["s"] is None) == (want[row["id"]] is None)
        assert row["s"] is None or abs(row["s"] - want[row["id"]]) < 1e-9


@pytest.mark.parametrize("k", [1, 4, 58, 100])
def test_nearest(docs, k):
    found = r.nearest(docs, VECTOR, k).orderBy("vector_rank").collect()
    want = nearest(VECTOR, k)
    assert [x["id"] for x in found] == [i for i, _ in want]
    assert all(a["vector_score"] is None if s is None else abs(a["vector_score"] - s) < 1e-9 for a, (_, s) in zip(found, want))


def queries_frame(spark, n=9):
    rng = np.random.default_rng(11)
    rows = [(q, " ".join(rng.choice(WORDS, 2)), [float(x) for x in rng.normal(size=5)]) for q in range(n)]
    rows.append((100, "nowhere", [0.0] * 5))
    rows.append((101, "", None))
    return rows, spark.createDataFrame(rows, "query_id bigint, query string, vector array<double>")


@pytest.mark.parametrize("limit", [r.QUERY_BYTES_PER_PASS, 100])
def test_nearest_batch_in_one_pass_and_in_many(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(r, "QUERY_BYTES_PER_PASS", limit)
    rows, queries = queries_frame(spark)
    found = {}
    for x in r.nearest_batch(docs, queries, 6).orderBy("query_id", "vector_rank").collect():
        found.setdefault(x["query_id"], []).append(x["id"])
    assert found == {q: [i for i, _ in nearest(v, 6)] for q, _, v in rows if v is not None}


def test_keyword_candidates(spark, docs):
    assert [x["id"] for x in r.keyword_candidates(docs, QUERY, 7).orderBy("text_rank").collect()] == matches(QUERY, 7)
    rows, queries = queries_frame(spark)
    found = {}
    for x in r.keyword_candidates_batch(docs, queries, 7).orderBy("query_id", "text_rank").collect():
        found.setdefault(x["query_id"], []).append(x["id"])
    assert found == {q: m for q, text, _ in rows if (m := matches(text, 7))}
    counts = {x["query_id"]: x["matches"] for x in r.match_counts(docs, queries).collect()}
    assert counts == {q: len(matches(text)) for q, text, _ in rows}


def test_index_lookup(spark, docs, work):
    index = r.inverted_index(docs, "id", "content")
    r.write_index(index, work + "/index", 8)
    found = r.lookup_index(spark, work + "/index", QUERY, 8).collect()
    want = {(t, i, terms(c).count(t)) for i, c, _ in corpus_rows() for t in ("red", "lamp") if t in terms(c)}
    assert {(x["token"], x["doc_id"], x["tf"]) for x in found} == want


def test_bm25(docs):
    contents = {i: terms(c) for i, c, _ in corpus_rows()}
    known = {i: t for i, t in contents.items() if i != 10}
    n, mean = len(contents), sum(map(len, known.values())) / len(known)
    want = {}
    for i, words in known.items():
        score = 0.0
        for term in ("red", "lamp"):
            df, tf = sum(term in w for w in known.values()), words.count(term)
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
        if score:
            want[i] = score
    found = {x["id"]: x["score"] for x in r.bm25(docs, QUERY).collect()}
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 1e-9 for i in want)
    top = [x["id"] for x in r.bm25(docs, QUERY, 3).collect()]
    assert top == sorted(want, key=lambda i: (-want[i], i))[:3]
    assert r.bm25(docs, "?").count() == 0


def test_hybrid_search(docs):
    found = r.hybrid_search(docs, VECTOR, QUERY, 5).collect()
    want = fused(VECTOR, QUERY, 5)
    assert [x["id"] for x in found] == [i for i, _ in want]
    assert all(abs(x["hybrid_score"] - s) < 1e-12 for x, (_, s) in zip(found, want))


def test_hybrid_batch_and_context(spark, docs):
    rows, queries = queries_frame(spark)
    found = {}
    for x in r.hybrid_search_batch(docs, queries, 3).orderBy("query_id", "rank").collect():
        found.setdefault(x["query_id"], []).append(x["id"])
    assert all(found[q] == [i for i, _ in fused(v, text, 3)] for q, text, v in rows if v is not None)
    context = {x["query_id"]: x["context"] for x in r.answer_context(docs, queries, 3).collect()}
    assert context[0].startswith("Search Statistics:\n- Total documents: 60\n- BM25 keyword matches: ")
    assert "- Final results after RRF: 3\n\n[Source 1] (Hybrid: 0.0" in context[0]
    assert context[101] == (
        "No relevant information found.\n\nSearch Statistics:\n- Total documents: 60\n- BM25 matches: 0"
    )


def test_embedding(spark):
    df = spark.createDataFrame([(1, "red lamp"), (2, "lamp RED"), (3, "tree"), (4, "!")], "id int, content string")
    found = {x["id"]: x["embedding"] for x in df.withColumn("embedding", r.hashed_vector(F.col("content"), 16)).collect()}
    assert found[1] == found[2] and len(found[3]) == 16 and not any(found[4])
    assert abs(sum(x * x for x in found[1]) - 1) < 1e-6


def test_parse_vector(spark):
    df = spark.createDataFrame([("[0.5,-1,2e-3]",), ("nope",)], "t string")
    assert [x[0] for x in df.select(F.transform(vectors.parse_vector("t"), lambda v: F.round(v, 4))).collect()] == [
        [0.5, -1.0, pytest.approx(0.002)],
        None,
    ]


def test_thousandths_are_rounded_from_doubles(spark, tmp_path):
    """A chunk of length 80: 7 of it are 87.5 thousandths, as a float a little less."""
    from tidemark.catalog import QUERIES

    counts = {"a": 79, "b": 10, "c": 7, "d": 3, "e": 1}
    text = " ".join(w for word, n in counts.items() for w in [word] * n)
    spark.createDataFrame([(1, text)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = QUERIES["tx_8"](spark, str(tmp_path)).first()
    found = [int(n) for n in row["counts"].split()]
    assert sorted(found, reverse=True)[:5] == [79, 10, 7, 3, 1] and sum(n * n for n in found) == 6400 and row["has_direction"]
    assert row["thousandths"].split() == [str(math.floor(1000 * n / 80 + 0.5)) for n in found]
