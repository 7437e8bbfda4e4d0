import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from tidemark.llm import mixing

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    tokens = {k: [*(t or "").encode().translate(mixing._LOWER).split(), b""] for k, (_, t) in enumerate(rows)}
    held = {k: zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else True for k, (i, _) in enumerate(rows)}
    counts = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = []
    for k, (i, _) in enumerate(rows):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[k])
        out.append((str(i), held[k], len(tokens[k]), sum(counts[w] > 0 for w in tokens[k]), n, round(base, 6)))
    return sorted(out)


def test_counts_and_base_equal_brute_force(frame, odd_texts, monkeypatch):
    rows = [(k, f"the Cat {k % 7} sat\ton the\x0bmat É{k % 3} " * (k % 5)) for k in range(60)] + odd_texts
    for head in (1 << 18, 3):  # few frequent words: the others are joined
        monkeypatch.setattr(mixing, "HEAD_WORDS", head)
        got = mixing.scored(frame(rows)).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute(rows)
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_better_than_the_base_on_held_out_texts(spark):
    """The base gives every unseen word one and the same share, whichever it is; spelled with 27 equal letters it is a model."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = mixing.scored(docs).filter("held_out").collect()
    held = {r.doc_id for r in rows}
    texts = [(r.doc_id, mixing.words_of(r.text.encode())) for r in docs.collect()]
    known = {w for i, ws in texts if i not in held for w in ws}
    spelled = sum((len(w) + 1) * math.log10(27) for i, ws in texts if i in held for w in ws if w not in known)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) - spelled
    assert all(0 < r.bits_per_byte < 5 for r in rows)


def trained(words):
    model = mixing.Model.empty()
    for bit, value, seen, slot in mixing.Spelled.of(words).bits():
        at = slot + np.arange(mixing.CONTEXTS)[:, None] * mixing.SLOTS
        np.add.at(model.ones, at[:, value == 1].ravel(), np.uint16(1))
        np.add.at(model.zeros, at[:, value == 0].ravel(), np.uint16(1))
    return model


def test_spelling_is_a_distribution():
    words = [b"abc", b"abd", b"ab", b"ca", "é".encode()]
    model = trained(words)
    # all strings of one byte and a close, and all longer ones by their first two bytes, with any second byte
    total = 0.0
    for first in range(256):
        if first == mixing.CLOSE:
            continue
        total += 10 ** model.costs([bytes([first])])[0]
    total += 10 ** model.costs([b""])[0]
    assert 0 < total < 1
    assert model.costs([b"ab"])[0] > model.costs([b"zq"])[0]


def test_costs_do_not_depend_on_lots(monkeypatch):
    words = [b"abc", b"", b"x" * 700, b"abd"] * 3
    model = trained([b"abc", b"abx"])
    one = np.concatenate([model.costs([w]) for w in words])  # nothing is shared
    assert np.allclose(one, model.costs(words))
    assert np.allclose(model.costs(sorted(words)), one[np.argsort(np.array(words, object), kind="stable")])
    monkeypatch.setattr(mixing, "SPELL_BYTES", 8)
    assert np.allclose(one, model.costs(words)) and np.isfinite(one).all()


def test_nothing_to_learn_from(frame):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    row = mixing.scored(frame([(held, "a b")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score)
    assert mixing.scored(frame([])).count() == 0


def test_long_words_cost_their_spelling(spark, frame):
    """A word of 50,000 bytes costs as much as Model.costs says, and more than one of 1,000."""
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:2]
    rng = np.random.default_rng(0)
    long, short = ("".join(map(chr, rng.integers(0x4E00, 0x9FA0, n))) for n in (16667, 334))
    rows = [(k, f"the cat {k % 7} sat on the mat") for k in range(60) if k not in held]
    got = {r.doc_id: r for r in mixing.scored(frame([*rows, (held[0], long), (held[1], short)])).collect()}
    vocabulary = Counter(w for _, t in rows if zlib.crc32(str(_).encode()) % 10 for w in [*t.encode().split(), b""])
    model = mixing.train(spark.createDataFrame([(bytearray(w), n) for w, n in sorted(vocabulary.items())], "word binary, c bigint").coalesce(1))
    costs = model.costs([long.encode(), short.encode()])
    assert costs[0] < -10_000 and costs[1] < -300
    # the rest is the end, the share of unseen words, and the group's name
    assert abs(got[held[0]].score - costs[0]) < 10 + 0.01 * abs(costs[0])
    assert abs(got[held[1]].score - costs[1]) < 10 + 0.01 * abs(costs[1])
    assert got[held[0]].bits_per_byte > 0.9 * got[held[1]].bits_per_byte


def test_large_counts_keep_their_ratio():
    model = mixing.Model.empty()
    model.zeros[:], model.ones[:] = 100_000, 300_000
    slot = np.zeros((mixing.CONTEXTS, 2), np.int64)
    for own in (None, np.array([0, 1])):
        st, gate = model.odds(slot, own, 0)
        assert np.allclose(st, math.log(3), atol=1e-3) and (gate == mixing.CONTEXTS - 1).all()
    model.ones[:] = 100_000  # even, and still seen
    assert (model.odds(slot, None, 0)[1] == mixing.CONTEXTS - 1).all()


def test_sums_of_counts_are_not_clipped_one_by_one():
    width = 4
    one = np.array([[70_000, 1, 0, 3_000_000_000], [140_000, 2, 0, 1_500_000_000]], np.uint32)
    rows = pd.DataFrame({"chunk": [5, 5], "counts": [zlib.compress(one.tobytes())] * 2})
    got = mixing._summed(rows)
    zeros, ones = np.frombuffer(zlib.decompress(got["counts"][0]), np.uint32).reshape(2, width)
    assert zeros.tolist() == [140_000, 2, 0, 3_000_000_000] and ones.tolist() == [280_000, 4, 0, 1_500_000_000]


def test_counts_do_not_depend_on_the_layout(spark):
    words = sorted({f"{a}{b}{'xyz' * (k % 3)}".encode() for k, a in enumerate(("un", "under", "over")) for b in range(40)})
    vocabulary = spark.createDataFrame([(bytearray(w), 1) for w in words], "word binary, c bigint")
    one, many = (mixing.train(vocabulary.repartitionByRange(n, "word").sortWithinPartitions("word")) for n in (1, 7))
    assert (one.zeros == many.zeros).all() and (one.ones == many.ones).all()
    assert int(one.zeros.sum() + one.ones.sum()) == 8 * mixing.CONTEXTS * sum(len(w) + 1 for w in words)
