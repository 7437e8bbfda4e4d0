"""The segmented keyword index against plain Python."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import keywords
from tidemark.operators import retrieval as r
from tidemark.operators.keywords import KeywordIndex, single


def terms(text):
    return [t for t in re.split("[^a-z0-9]+", (text or "").lower()) if t]


def corpus(n=400, seed=5):
    """Texts of very different lengths over a skewed vocabulary, with a null, an empty text, a null id and equal texts."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(60)]
    share = 1 / np.arange(1, 61)
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(1, 12) ** 2, p=share / share.sum()))) for i in range(n)]
    rows[3], rows[4] = (3, None), (4, "")
    rows[10] = (10, rows[11][1])
    return rows


ROWS = corpus()
QUERIES = [(1, "w0"), (2, "w3 W7, w50"), (3, "w59 w58"), (4, "nowhere"), (5, ""), (6, "w1 w2 w20 w40 w41")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    made = KeywordIndex(spark, str(tmp_path_factory.mktemp("keywords")))
    docs = spark.createDataFrame(ROWS, "id bigint, content string").repartition(3)
    for name, part in (("a", F.col("id") < 150), ("b", F.col("id") >= 150)):
        made.add(docs.where(part), name)
    return made


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id bigint, query string")


def scores(query):
    known = {i: terms(t) for i, t in ROWS if t is not None}
    n, mean, out = len(ROWS), sum(map(len, known.values())) / len(known), {}
    for term in set(terms(query)):
        df = sum(term in w for w in known.values())
        for i, w in known.items():
            if tf := w.count(term):
                out[i] = out.get(i, 0) + math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
    return out


def best(query, k):
    return sorted(((i, round(s, 9)) for i, s in scores(query).items()), key=lambda x: (-x[1], x[0]))[:k]


def by_query(rows, *columns):
    found = {}
    for row in rows:
        found.setdefault(row["query_id"], []).append(tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]])
    return found


def test_postings(index):
    want = {(t, i, terms(text).count(t)) for i, text in ROWS for t in terms(text)}
    assert sorted(tuple(x) for x in index.postings().collect()) == sorted(want)
    known = [len(terms(t)) for _, t in ROWS if t is not None]
    assert index.counts() == (len(ROWS), sum(known) / len(known))


def test_blocks_cover_their_rows():
    rng = np.random.default_rng(0)
    rows = sorted((f"t{rng.integers(0, 9)}", int(rng.integers(5, 60)), int(i), int(rng.integers(1, 6))) for i in rng.permutation(6000))
    batch = lambda part: pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in part]), pa.array([x[2] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int32()), pa.array([x[3] for x in part], pa.int32())],
        ["token", "id", "length", "count"],
    )
    out = [b for made in keywords._blocks(batch(rows[k : k + 37]) for k in range(0, len(rows), 37)) for b in made.to_pylist()]
    assert [(b["token"], n, i, c) for b in out for i, c, n in zip(b["ids"], b["counts"], b["lengths"])] == rows
    for b in out:
        pairs = set(zip(b["counts"], b["lengths"]))
        assert set(zip(b["top_counts"], b["top_lengths"])) == {p for p in pairs if not any(q != p and q[0] >= p[0] and q[1] <= p[1] for q in pairs)}
        assert b["docs"] == len(b["ids"]) <= keywords.BLOCK_DOCS and b["least_id"] == min(b["ids"])
        assert (b["least_length"], b["most_length"]) == (min(b["lengths"]), max(b["lengths"]))


def test_matches_and_counts(index, queries):
    want = {q: [i for i, t in ROWS if set(terms(t)) & set(terms(text))] for q, text in QUERIES}
    assert by_query(index.match_counts(queries).collect(), "matches") == {q: [len(m)] for q, m in want.items()}
    found = by_query(index.first_matches_batch(queries, 7).orderBy("query_id", "text_rank").collect(), "id")
    assert found == {q: m[:7] for q, m in want.items() if m}
    row = index.search_counts("w3 w7")
    assert tuple(row.first()) == (len(ROWS), sum(bool({"w3", "w7"} & set(terms(t))) for _, t in ROWS))


def test_bm25_of_all(index, queries):
    found = {(x["query_id"], x["id"]): x["score"] for x in index.bm25(queries).collect()}
    want = {(q, i): s for q, text in QUERIES for i, s in scores(text).items()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_top_bm25_is_exact(index, queries, k):
    found = by_query(index.top_bm25(queries, k).orderBy("query_id", "rank").collect(), "id", "score")
    assert {q: [(i, round(s, 9)) for i, s in rows] for q, rows in found.items()} == {q: b for q, text in QUERIES if (b := best(text, k))}


def test_blocks_are_left_out(spark, tmp_path, monkeypatch):
    """Many documents, one word: only the blocks of the shortest texts and highest counts can hold the best."""
    docs = spark.range(20000).select("id", F.repeat(F.lit("red "), (F.col("id") % 3 + 1).cast("int")).alias("x"), (F.col("id") % 97).alias("n"))
    docs = docs.select("id", F.concat("x", F.repeat(F.lit("pad "), F.col("n").cast("int"))).alias("content"))
    index = KeywordIndex(spark, str(tmp_path))
    index.add(docs, "all")
    one = single(spark, "red")
    blocks = index.bounds(one, 10)
    total, kept = blocks.count(), blocks.where("kept").count()
    assert total >= 20000 / keywords.BLOCK_DOCS and kept < total / 10
    want = [x["id"] for x in r.bm25(docs, "red", 10).collect()]
    assert [x["id"] for x in index.top_bm25(one, 10).orderBy("rank").collect()] == want
    # 206 documents have the best score; a cut among them goes by id.
    assert want == sorted(want)


def test_no_text_is_read(index, queries):
    for df in (index.first_matches("w3", 5), index.match_counts(queries), index.top_bm25(queries, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "content" not in plan and "postings" in plan


def test_segments_are_added_replaced_and_merged(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in ROWS], "id bigint, content string")
    index, queries = KeywordIndex(spark, str(tmp_path)), spark.createDataFrame(QUERIES, "query_id bigint, query string")
    assert index.segments() == [] and index.counts() == (0, 0.0) and index.top_bm25(queries, 3).count() == 0
    files = lambda name: sorted((str(f), f.stat().st_mtime_ns) for f in (tmp_path / f"postings/segment={name}").rglob("*.parquet"))
    index.add(docs.where("id % 4 = 0"), "p0")
    first = files("p0")
    index.add(docs.where("id % 4 = 1"), "p1")
    index.add(docs.where("id % 4 = 1"), "p1")  # a replay
    assert index.segments() == ["p0", "p1"] and files("p0") == first
    index.add(docs.where("id % 4 = 2"), "p2")
    index.add(docs.where("id % 4 = 3"), "p3")
    before = sorted(tuple(x) for x in index.postings().collect())
    opened = index.top_bm25(queries, 5)
    merged = index.merge()
    assert len(merged) == 1 and merged[0].startswith("merged-") and index.merge() == merged
    assert sorted(tuple(x) for x in index.postings().collect()) == before and index.counts()[0] == len(ROWS)
    rounded = lambda df: sorted((x["query_id"], x["rank"], x["id"], round(x["score"], 9)) for x in df.collect())
    assert rounded(opened) == rounded(index.top_bm25(queries, 5))  # a reader of the old manifest goes on
    with pytest.raises(ValueError):
        index.add(docs, "merged-9")


def test_indexed_search_equals_search_over_texts(spark, index, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, t, [float(x) for x in rng.normal(size=4)] if i % 5 else None) for i, t in ROWS]
    docs = spark.createDataFrame(rows, "id bigint, content string, embedding array<float>").repartition(3).cache()
    batch = spark.createDataFrame([(q, t, [float(x) for x in rng.normal(size=4)]) for q, t in QUERIES], "query_id bigint, query string, vector array<double>")
    vectors, texts = docs.select("id", "embedding"), docs.select("id", "content")
    found = r.indexed_search(vectors, index, texts, batch, 4).orderBy("query_id", "rank").collect()
    assert found == r.hybrid_search_batch(docs, batch, 4).orderBy("query_id", "rank").select(*found[0].__fields__).collect()
    key = lambda df: {x["query_id"]: x["context"] for x in df.collect()}
    assert key(r.indexed_context(vectors, index, texts, batch, 3)) == key(r.answer_context(docs, batch, 3))


def test_long_queries_pass_their_blocks_once(spark, index):
    """Bounds of a block do not walk all the terms of a query, nor is a block shuffled; the answers stay exact."""
    words = " ".join(f"w{k}" for k in range(60))
    batch = spark.createDataFrame([(q, f"{words} x{q}") for q in range(3)], "query_id bigint, query string")
    made = index.top_bm25(batch, 10)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SortMergeJoin" not in plan
    found = by_query(made.orderBy("query_id", "rank").collect(), "id", "score")
    assert {q: [(i, round(s, 9)) for i, s in rows] for q, rows in found.items()} == {q: best(words, 10) for q in range(3)}


def test_documents_are_counted_in_place(spark, tmp_path, monkeypatch):
    """A row per document and token, with the tokens as ``functions.texts.tokens`` finds them, whatever the layout."""
    texts = [*[t for _, t in ROWS[:60]], "İstanbul KKK Straße 7a-b", "É", "AB ab aB"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "un named")], "id bigint, content string")
    want = docs.where("id IS NOT NULL").select("id", F.explode(keywords.tokens("content")).alias("token")).groupBy("token", "id").count().collect()
    for size in (1 << 20, 50, 3):  # one task, some buckets a task, several tasks a bucket
        monkeypatch.setattr(keywords, "TASK_POSTINGS", size)
        index = KeywordIndex(spark, str(tmp_path / str(size)))
        index.add(docs, "all")
        assert sorted(map(tuple, index.postings().select("token", "doc_id", "tf").collect())) == sorted(map(tuple, want))
        n = [len(x["t"]) for x in docs.select(keywords.tokens("content").alias("t")).where("t IS NOT NULL").collect()]
        assert index.counts() == (docs.count(), sum(n) / len(n))


def test_rows_are_sorted_by_one_number(spark, tmp_path, monkeypatch):
    """Laying out compares no rows, a lookup names its place, and tokens that share a place keep their own blocks."""
    docs = spark.createDataFrame(ROWS, "id bigint, content string")
    want = sorted((t, i, terms(text).count(t)) for i, text in ROWS for t in set(terms(text)))
    laid = []
    original = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, *a, **k: laid.append((task, self)) or original(self, task, *a, **k))
    index = KeywordIndex(spark, str(tmp_path / "a"))
    index.add(docs, "all")
    plan = next(df for task, df in laid if task is keywords._blocks)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Sort \[place#\d+L ASC NULLS FIRST\], false", plan)
    assert "mark" in index.first_matches("w3", 5)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(keywords, "_mark", lambda token: F.lit(7).cast("bigint"))
    one = KeywordIndex(spark, str(tmp_path / "b"))
    one.add(docs, "all")
    for made in (index, one):
        assert sorted(map(tuple, made.postings().collect())) == want
    found = by_query(one.top_bm25(spark.createDataFrame(QUERIES, "query_id bigint, query string"), 10).orderBy("query_id", "rank").collect(), "id")
    assert found == {q: [i for i, _ in b] for q, text in QUERIES if (b := best(text, 10))}
