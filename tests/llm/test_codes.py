import hashlib
import math

import numpy as np
import pytest
from tidemark.llm import codes


def plain(rows, parts=8, entries=16, rounds=6):
    """vec_id -> (code, error, label_error), and the digest, by comparing every part with every entry."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = {i: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        groups = [[[] for _ in b] for b in books]
        for own in cut.values():
            for p, x in enumerate(own):
                groups[p][nearest(p, x)[1]].append(x)
        books = [[tuple(sum(c) // len(g) for c in zip(*g)) if g else e for g, e in zip(gs, b)] for gs, b in zip(groups, books)]
    found = {i: [nearest(p, x) for p, x in enumerate(own)] for i, own in cut.items()}
    error = {i: sum(d for d, _ in f) for i, f in found.items()}
    label = {i: n for i, _, n in kept}
    sums = {n: sum(error[i] for i in error if label[i] == n) for n in set(label.values())}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ("".join(f"{k:02x}" for _, k in f), error[i], sums[label[i]], digest) for i, f in found.items()}


def frame(spark, rows):
    wide = [(v, i, label, 1, "x", "y") for i, v, label in rows]
    return spark.createDataFrame(wide, "embedding array<double>, vec_id bigint, label int, part int, code string, ints string")


def got_of(df):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()}


def test_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(k * 3, rng.normal(0, 0.2, 16).round(3).tolist(), [1, 2, None][k % 3]) for k in range(150)]
    rows += [(1000 + k, rows[k % 5][1], 9) for k in range(60)]  # copies and ties
    rows += [(2000, None, 1), (2001, [None] + [0.1] * 15, 1), (2002, [math.nan] * 16, 1), (2003, [math.inf] + [0.0] * 15, 2), (2004, [0.0] * 16, None)]
    assert got_of(codes.compressed(frame(spark, rows))) == plain(rows)


def test_fewer_rows_than_entries(spark):
    rows = [(k, [float(k)] * 8, 1) for k in (5, 1, 3)]
    assert got_of(codes.compressed(frame(spark, rows))) == plain(rows)


def test_other_widths_keep_their_rows(spark):
    rows = [(1, [0.5] * 7, 1), (2, [0.5] * 16, 1), (3, [0.25] * 16, 1), (4, [0.5] * 24, 1), (5, [], 2), (None, [0.5] * 16, 2)]
    got = got_of(codes.compressed(frame(spark, rows)))
    assert {k for k, v in got.items() if v[0] is None} == {1, 4, 5} and set(got) == {1, 2, 3, 4, 5, None}
    assert got[1][1:3] == (None, got[2][1] + got[3][1]) and got[None][2] == got[None][1] == 0


def test_large_components(spark):
    rows = [(k, [(-1) ** k * 1e300] * 8, 1) for k in range(40)]
    got = got_of(codes.compressed(frame(spark, rows)))
    assert len(got) == 40 and all(v[1] == 0 for v in got.values())


@pytest.mark.parametrize("many", [1, 2, 16, 40])
def test_search_is_exact_and_skips(many):
    rng = np.random.default_rng(many)
    entries = rng.integers(-500, 500, (many, 6))
    entries[many // 2] = entries[0]  # equal entries: the first wins
    vectors = np.concatenate([rng.integers(-500, 500, (300, 6)), entries[rng.integers(0, many, 100)] + rng.integers(-3, 4, (100, 6))])
    best, distance, compared = codes.Codebook(entries).search(vectors)
    every = ((vectors[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert compared <= len(vectors) * many
    if many == 40:
        near = codes.Codebook(entries).search(vectors[300:])[2]
        assert near < 100 * many / 2


def test_no_rows(spark):
    assert codes.compressed(frame(spark, [])).count() == 0
    assert codes.compressed(frame(spark, [(1, None, 1)])).count() == 0
