import numpy as np
from tidemark.llm import quality

FOLDER = "/root/testdata/sf0.01"


def test_trees_learn_and_flat_traversal_equals_walking():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 1)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.85
    for row in x[:50]:
        total = trees.start
        for at in trees.roots:
            while trees.feature[at] >= 0:
                at = trees.child[at] + int(row[trees.feature[at]] > trees.cut[at])
            total += trees.value[at]
        assert np.isclose(total, trees.margin(row[None])[0])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_folds(frame):
    import zlib

    rows = quality.measured(frame([(k, "x") for k in range(50)])).collect()
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode()) % 3 for r in rows)


def test_odd_rows(spark, frame, odd_texts):
    labels = spark.createDataFrame([(1, 0), (1, 1), (4, None), (None, 1), (6, 1)], "doc_id bigint, quality int")
    rows = quality.scored(frame(odd_texts), labels).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    none = quality.scored(frame(odd_texts), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.scored(frame([]), labels).count() == 0
