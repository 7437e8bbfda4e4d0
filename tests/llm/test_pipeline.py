import re
from collections import defaultdict

import corpus_pipeline
from corpus_pipeline import STAGES, run

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id: r.text for r in docs.collect()})

    before, after = kept["language identification"]
    assert all(any(c.isalpha() for c in t) for t in after.values()) and len(after) >= 0.98 * len(before)

    before, after = kept["exact dedup"]
    groups = defaultdict(list)
    for i, t in before.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    assert set(after) == {min(g)[1] for g in groups.values()}

    before, after = kept["n-gram Jaccard join"]
    sets = {}
    for i, t in before.items():
        w = WORD.findall(low(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert set(after) == {i for i in sets if least[i] == i}

    before, after = kept["benchmark decontamination"]
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = [x for x in SEPARATOR.split(low(r.text)) if x]
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    clean = set()
    for i, t in before.items():
        w = [x for x in SEPARATOR.split(low(t)) if x]
        if not any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            clean.add(i)
    assert set(after) == clean and clean

    pieces = STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(after)


def test_run_gives_the_last_stage(spark):
    rows = run(spark, FOLDER)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and rows.count() > 50
    assert corpus_pipeline.ORACLE_SQL is None


def test_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


#: Rows with columns whose names clash with those that stages make. Words are common ones of one language in the given tables.
def odd_documents(spark):
    given = [r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r.lang and r.text and 300 < len(r.text) < 3000][:12]
    text = [r.text for r in given]
    rows = [(100 + k, t, r.lang) for k, (t, r) in enumerate(zip(text, given))]
    rows += [(100, text[0], given[0].lang)] * 2  # a row read three times
    rows += [(101, text[2] + " extra", given[2].lang)]  # one id, another text: a near copy of 102
    rows += [(None, text[3], given[3].lang), (None, text[4][::-1], given[4].lang), (None, text[4][::-1], given[4].lang)]  # without an id
    rows += [(7, "", None), (8, None, None), (9, "12 34 !", None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, _row string, keep_id int, component_id int, `a.b` int"
    return text, spark.createDataFrame([(i, t, x, "web", len(t or ""), 1, "r", 2, 3, 4) for i, t, x in rows], schema)


def test_rows_not_ids_are_decided_on(spark, tmp_path):
    text, docs = odd_documents(spark)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "\u0001".join(text[5].split()[:12])), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    columns, docs = docs.columns, spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        seen.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=str))
    known, first, apart, clean = seen
    assert sum(i == 100 for i, _ in known) == 3 and sum(i is None for i, _ in known) == 3 and not {i for i, _ in known} & {7, 8, 9}
    assert [t for i, t in first if i == 100] == [text[0]]
    assert sorted(t for i, t in first if i == 101) == sorted([text[1], text[2] + " extra"])
    assert [t for i, t in first if i is None] == [text[4][::-1]] and (103, text[3]) in first
    assert [(i, t) for i, t in apart if t.startswith(text[2])] == [(101, text[2] + " extra")] and (101, text[1]) in apart
    assert (None, text[4][::-1]) in apart
    assert set(apart) - set(clean) == {(105, text[5])} and (None, text[4][::-1]) in clean
    pieces = run(spark, folder).collect()
    assert sorted(str(p.doc_id) for p in pieces if p.piece == 0) == sorted(str(i) for i, _ in clean)


def test_stages_hand_rows_to_python_in_small_batches(spark, monkeypatch):
    """Long texts came 10,000 at a time, so that batches grew with them."""
    key, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(i, "word " * 20_000) for i in range(200)], "doc_id bigint, text string").coalesce(1)

    def measured(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    def stage(spark, docs, sf_dir):
        sizes.extend(r["size"] for r in docs.mapInArrow(measured, "size bigint").collect())
        return docs

    corpus_pipeline._bounded(stage)(spark, docs, FOLDER)
    assert max(sizes) < 2 * corpus_pipeline.HANDED_BYTES < sum(sizes)
    assert spark.conf.get(key, None) == before
    assert all(hasattr(stage, "__wrapped__") for _, stage in STAGES)
