import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm import jaccard
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if sets[a] and 100 * k >= 80 * len(sets[a] | sets[b]) and sets[b]:
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, len(s), least[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n=260):
    """Copies, near copies from light to heavy, chains of copies of copies, and a passage in many documents."""
    rng = random.Random(seed)
    vocab = [f"W{k}" for k in range(3000)]
    passage = rng.choices(vocab, k=70)
    bases = [rng.choices(vocab, k=rng.randint(3, 160)) for _ in range(12)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.15:
            words = rng.choices(vocab, k=rng.randint(0, 90))
        elif kind < 0.3:
            words = rng.choices(vocab, k=rng.randint(1, 60)) + passage
        else:
            words = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            if kind > 0.9:
                bases.append(words)
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return [(3 * k + 7, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed,common,limit,block", [(1, 16, 256, 1 << 18), (2, 3, 256, 300), (3, 10**6, 2, 1000), (4, 4, 3, 100)])
def test_equals_brute_force(spark, frame, odd_texts, monkeypatch, seed, common, limit, block):
    monkeypatch.setattr(jaccard, "COMMON_SETS", common)
    monkeypatch.setattr(jaccard, "LIST_LIMIT", limit)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    rows = corpus(seed) + ([(i + 5000, t) for i, t in odd_texts if i is not None] if seed == 1 else [])
    got = jaccard.near_duplicates(frame(rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_edge_of_the_threshold(frame):
    words = [f"w{k}" for k in range(44)]  # 40 shingles
    at = words + ["x"] * 1 + [f"y{k}" for k in range(9)]  # 40 of 50: exactly 80
    below = words + ["x"] * 1 + [f"y{k}" for k in range(10)]  # 40 of 51
    rows = [(1, " ".join(words)), (2, " ".join(at)), (3, " ".join(f"q{k}" for k in range(44))), (4, " ".join([f"q{k}" for k in range(44)] + below[44:]))]
    assert sorted(tuple(r) for r in jaccard.near_duplicates(frame(rows)).collect()) == brute(rows)


def test_null_ids_and_no_rows(frame):
    rows = jaccard.near_duplicates(frame([(None, "a b c d e f"), (3, "A B c d e f"), (None, None)])).collect()
    assert sorted(map(str, rows)) == sorted(["Row(doc_id=None, n_shingles=2, component_id=3)", "Row(doc_id=3, n_shingles=2, component_id=3)",
                                             "Row(doc_id=None, n_shingles=0, component_id=None)"])
    assert jaccard.near_duplicates(frame([])).count() == 0


def test_words_of_any_length_and_alphabet():
    texts = ["ab é\U0001f600 " + "x" * 9000, None, "AB é\U0001f600 " + "x" * 9000, "ab é \U0001f600", "a b\x0bc\x0cd\re\x1cf\xa0g"]
    sets = list(jaccard.shingle_sets(pa.array(texts)))
    assert sets[0].tolist() == sets[2].tolist() != sets[3].tolist() and len(sets[1]) == 0
    assert len(sets[4]) == 1 and len(shingles(texts[4])) == 1


def test_blocks_link_only_through_open_sets():
    sets = [np.arange(0, 100), np.arange(5, 105), np.arange(500, 600), np.arange(503, 603)]
    raw = [s.astype(np.int64).tobytes() for s in sets]
    assert jaccard.block_links(raw, np.array([True, False, False, False])).tolist() == [0, 0, 2, 3]
    assert jaccard.block_links(raw, np.array([True, False, True, False])).tolist() == [0, 0, 2, 2]


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 3, 255, 256, 257, 900, 5000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(-(2**63), 2**63 - 1, n // 3 + 1)]))
        far = jaccard.apart(jaccard.sketch(a), jaccard.sketch(b))
        assert far <= len(np.setxor1d(a, b)) and jaccard.apart(jaccard.sketch(a), jaccard.sketch(a)) == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(900, 901)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(201)}, 900: 900, 901: 900}


def test_keep_one(frame):
    docs = frame([(5, "a b c"), (2, "A b C"), (9, "z"), (None, "z")])
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]
