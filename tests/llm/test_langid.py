import zlib

import numpy as np
from tidemark.llm import langid

FOLDER = "/root/testdata/sf0.01"


def test_gradients_equal_differences():
    net = langid.Network.new(["a", "b", "c"])
    for w in net.weights:
        w[...] = w.astype(np.float32)
    net.inputs, net.gates, net.candidate, net.out, net.bias = (w.astype(np.float64) for w in net.weights)
    codes, sizes = langid._codes([b"ab", b"cabd", b"x"])
    lang, weight = np.array([0, 2, 1]), np.array([1.0, 0.5, 2.0])
    _, grads = langid.gradients(net, codes, sizes, lang, weight)
    for w, g in zip(net.weights, grads):
        spots = np.argsort(-np.abs(g).ravel())[:4]
        for spot in spots:
            flat, step = w.reshape(-1), 1e-3
            was = flat[spot]
            flat[spot] = was + step
            up = langid.gradients(net, codes, sizes, lang, weight)[0]
            flat[spot] = was - step
            down = langid.gradients(net, codes, sizes, lang, weight)[0]
            flat[spot] = was
            assert np.isclose((up - down) / (2 * step), g.reshape(-1)[spot], rtol=2e-2, atol=1e-4)


def test_labels_of_a_word_do_not_depend_on_its_neighbours():
    net = langid.Network.new(["a", "b"])
    words = [b"one", b"three", b"x" * 40]
    alone = np.concatenate([net.pooled([w]) for w in words])
    assert np.allclose(net.pooled(words), alone, atol=1e-5)


def test_held_out_accuracy_and_odd_rows(spark, frame, odd_texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    net = langid.fit(docs)
    rows = langid.identified(docs, net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    odd = langid.identified(frame(odd_texts + [(50, "12 34 !?")]), net).collect()
    assert len(odd) == len(odd_texts) + 1
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 50)) and 0 <= r.score <= 1 for r in odd)
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * len(rows)


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "words here", None), (None, None, None)], "doc_id bigint, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.identified(df).collect()} == {("und", 0.0)}
    assert langid.identified(df.limit(0)).count() == 0
