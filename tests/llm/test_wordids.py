import hashlib

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm import wordids
from tokenizers import Tokenizer

PATH = wordids.default_tokenizer()
MADE = Tokenizer.from_file(PATH)
# Mixed scripts, marks that combine, other white space, contractions and strings of special tokens.
MARKED = ["a\x1cb \x1d c", "x<|endoftext|>y <|startoftext|>", "don't I'LL Á  ΟΔΟΣ Σ", "ͅ ́a", "It's we'll''s !'s a<|b 12x34 ÀÉß×÷ª² x_y", "É É ǅ İ ﬁ",
          "你好　世界 ok", " ", "\u0085  z", "é cole\n̸ x"]


def expected(text):
    ids = MADE.encode(text or "", add_special_tokens=False).ids
    return ids, MADE.decode(ids, skip_special_tokens=False)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in wordids.digests(docs).collect()}
    assert len(got) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        ids, text = expected(r.text)
        assert got[r.doc_id][1:] == (len(ids), digest(" ".join(map(str, ids))), digest(text))


def test_ids_and_texts(frame, odd_texts):
    rows = odd_texts + [(100 + k, t) for k, t in enumerate(MARKED)]
    got = sorted((str(r.doc_id), list(r.ids), r.text) for r in wordids.tokens(frame(rows)).collect())
    assert got == sorted((str(i), *expected(t)) for i, t in rows)


def test_small_blocks_give_the_same(frame):
    rows = [(k, f"one word{k % 7} in block {k} one") for k in range(40)] + [(40, None), (41, "")]
    docs = frame(rows)
    whole = sorted(wordids.digests(docs).collect())
    cut = wordids.blocks(docs, size=64)
    assert cut.count() > 8 and cut.selectExpr("sum(size(docs))").collect()[0][0] == len(rows)
    assert sorted(wordids.digests(docs, block_bytes=64).collect()) == whole


def test_each_distinct_word_once(spark, frame):
    cut = wordids.blocks(frame([(k, "Same words, again (same)! 你好," + " rare" * (k == 7)) for k in range(30)]), size=64)
    common = wordids.common_words(cut)
    assert {"(", ")!", ",", "again", "same", "words", "你好,"} <= set(common) <= {"(", ")!", ",", "again", "same", "words", "你好,", "rare"}
    assert len(wordids.common_words(cut, 3)) == 3
    kept = spark.createDataFrame([(w,) for w in ("same", ",")], "word string")
    rows = wordids.rare_ids(cut, kept, PATH).collect()
    places = {r.block: r.words for r in cut.collect()}
    assert sorted((r.block, r.at) for r in rows) == sorted((b, k) for b, words in places.items() for k, w in enumerate(words) if w not in ("same", ","))
    assert all(list(np.frombuffer(r.ids, "<u4")) == expected(places[r.block][r.at])[0] for r in rows)


@pytest.mark.parametrize("common", [0, 1, 5])
def test_what_is_common_changes_nothing(frame, odd_texts, common):
    docs = frame(odd_texts + [(100 + k, t) for k, t in enumerate(MARKED)])
    assert sorted(wordids.digests(docs, block_bytes=200, common=common).collect(), key=str) == sorted(wordids.digests(docs).collect(), key=str)


def test_words_across_batches_are_encoded_once():
    batches = [pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([0, 0, 0], pa.int32()), pa.array(w)], ["block", "at", "word"]) for w in (["a", "a", "bb"], ["bb", "bb", "c"], ["c", "c", "c"])]
    out = [r for b in wordids._encoder(PATH)(iter(batches)) for r in b.to_pylist()]
    assert [list(np.frombuffer(r["ids"], "<u4")) for r in out] == [expected(w)[0] for w in ["a", "a", "bb", "bb", "bb", "c", "c", "c", "c"]]


def test_other_tokenizers_are_refused(frame, tmp_path):
    import json

    made = json.load(open(PATH, encoding="utf-8"))
    made["normalizer"]["normalizers"].pop()
    (tmp_path / "other.json").write_text(json.dumps(made))
    with pytest.raises(ValueError, match="another way"):
        wordids.digests(frame([(1, "a")]), str(tmp_path / "other.json"))


def test_decode_through_pieces(spark):
    ids = {1: expected("one two <|endoftext|>")[0], 2: [], 3: None, 4: expected("spelling " * 5000)[0]}
    rows = spark.createDataFrame(list(ids.items()), "doc_id bigint, ids array<bigint>")
    got = {r.doc_id: r.text for r in wordids.decode(rows).collect()}
    assert got == {k: MADE.decode(v or [], skip_special_tokens=False) for k, v in ids.items()}


def test_other_columns(spark):
    docs = spark.createDataFrame([("a b", 7, "x", [1])], "body string, key int, text string, words array<int>")
    assert [tuple(r) for r in wordids.tokens(docs, doc_id="key", text="body").collect()] == [(7, *expected("a b"))]


@pytest.mark.parametrize("name", ["digests", "tokens"])
def test_no_rows(frame, name):
    assert getattr(wordids, name)(frame([])).count() == 0


def test_blocks_are_not_shuffled_again(spark, frame):
    docs = frame([(k, f"same words and rare{k} ones") for k in range(30)])
    found = wordids.digests(docs, block_bytes=64, common=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One shuffle brings ids back by block; the blocks with their places are read where they lie.
    assert plan.count("Exchange hashpartitioning(block") == 1 and "Bucketed: true" in plan
    assert found.count() == 30
