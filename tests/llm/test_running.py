import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tidemark.llm import mixing, running

HELD = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0]


def coded(spark, docs, parts):
    rows = [(0, ids) for ids in docs]
    return spark.createDataFrame(rows, "group int, ids array<int>").repartition(parts)


def brute(tree, docs):
    """Zeros and ones of every context, named by what it is rather than by a hash."""
    counts = defaultdict(lambda: [0, 0])
    for ids in docs:
        for k, token in enumerate(ids):
            for context, turn in turns(tree, ids, k):
                for c in context:
                    counts[c][turn] += 1
    return counts


def turns(tree, ids, k):
    leaf = ids[k] if ids[k] >= 0 else tree.other
    for at in range(tree.start[leaf], tree.start[leaf + 1]):
        node = int(tree.node[at])
        before = [tuple(ids[k - j] if k >= j else None for j in range(1, n + 1)) for n in range(1, running.ORDERS + 1)]
        yield [("place", node), ("group", 0, node), *[(node, b) for b in before]], int(tree.turn[at])


def plain(model, counts, ids, k):
    """log10 of the probability of a token, one turn after another."""
    total = 0.0
    for depth, (context, turn) in enumerate(turns(model.tree, ids, k)):
        st = [math.log((counts[c][1] + 0.4) / (counts[c][0] + 0.4)) if c in counts else 0.0 for c in context]
        longest = max([n for n in range(1, running.ORDERS + 1) if context[1 + n] in counts], default=0)
        weights = model.weights[min(depth, running.DEPTHS - 1) * (running.ORDERS + 1) + longest]
        logit = max(-14.0, min(14.0, sum(w * s for w, s in zip(weights, st))))
        p = 1 / (1 + math.exp(-logit))
        step = min(max(round(logit * 2) + running.STEPS // 2, 0), running.STEPS - 1)
        zeros, ones = model.maps[:, step, min(context[0][1], running.PLACES - 1)]
        p = min(max((p + (ones + 4 * p) / (ones + zeros + 4)) / 2, 1e-6), 1 - 1e-6)
        total += math.log10(p if turn else 1 - p)
    return total


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(3)
    lines = [[int(x) for x in rng.integers(0, 30, 8)] for _ in range(6)]
    return [[t for k in rng.integers(0, 6, 4) for t in lines[k]] + [-7 - int(n)] for n in range(40)]


@pytest.fixture(scope="module")
def tree(docs):
    counts = np.bincount([max(t, -1) + 1 for ids in docs for t in ids], minlength=31)
    return running.Tree.of(np.append(counts[1:], counts[0]))


def test_a_mixer_in_plain_loops_agrees(spark, docs, tree):
    few = docs[:3]  # so few turns that every count is kept as it is
    model = running.train_text(coded(spark, few, 3), tree)
    counts = brute(tree, few)
    rng = np.random.default_rng(4)
    for ids in [docs[0], [int(x) for x in rng.integers(0, 30, 20)], [-5, 3, -5]]:
        got = model.costs(np.array(ids), np.arange(len(ids)), np.zeros(len(ids), np.int64))
        assert np.allclose(got, [plain(model, counts, ids, k) for k in range(len(ids))], atol=1e-3)


def test_leaves_of_a_token_sum_to_one(spark, docs, tree):
    model = running.train_text(coded(spark, docs, 2), tree)
    ends = [model.costs(np.array([4, 9, leaf]), np.arange(3), np.zeros(3, np.int64))[-1] for leaf in [*range(30), -1]]
    assert abs(sum(10**x for x in ends) - 1) < 1e-4


def test_parts_of_a_long_document_do_not_change_counts(spark, docs, tree, monkeypatch):
    one = running.train_text(coded(spark, docs, 1), tree).states
    monkeypatch.setattr(running, "LOT", 5)
    assert (running.train_text(coded(spark, docs, 4), tree).states == one).all()


def test_large_counts_keep_their_ratio():
    states = running._states(np.array([1, 100_000, 4_000_000_000, 0]), np.array([2, 300_000, 4_000_000_000, 1]))
    assert np.allclose(running.ODDS[states], [math.log(2.4 / 1.4), math.log(3), 0, math.log(1.4 / 0.4)], atol=0.1)
    assert np.allclose(running.ODDS_WITHOUT[1][states[3:]], 0) and states[3] == 1


def test_shuffled_words_score_lower(frame):
    rng = np.random.default_rng(5)
    lines = [" ".join(f"word{x}" for x in rng.integers(0, 60, 12)) for _ in range(12)]
    text = lambda: " ".join(lines[k] for k in rng.integers(0, 12, 6))
    own = text()
    mixed = " ".join(rng.permutation(own.split()))
    rows = [(k, text()) for k in range(400) if k not in HELD] + [(HELD[0], own), (HELD[1], mixed)]
    got = {r.doc_id: r for r in mixing.scored(frame(rows)).filter("held_out").collect()}
    assert abs(got[HELD[0]].base_score - got[HELD[1]].base_score) < 1e-9
    assert got[HELD[0]].score > got[HELD[1]].score + 20
