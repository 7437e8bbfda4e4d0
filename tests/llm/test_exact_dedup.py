import hashlib
import random
import re

import numpy as np
from tidemark.llm import exact_dedup


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        best = min(groups[norm(t)])[1]
        out.append((i, best, len(groups[norm(t)]), best == i, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


def test_equals_brute_force(frame, odd_texts):
    random.seed(3)
    rows = [(i, t) for i, t in odd_texts if i is not None]
    rows += [(100 + k, " ".join(random.choices("a b c".split(), k=random.randint(1, 6))) + " " * random.randint(0, 2)) for k in range(1500)]
    got = exact_dedup.resolve(frame(rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_null_id_is_never_kept(frame):
    rows = exact_dedup.resolve(frame([(None, "longer text wins not"), (4, "longertextwinsnot"), (None, "alone")])).collect()
    found = sorted(((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in rows), key=str)
    assert found == [("4", 4, 2, True), ("None", 4, 2, False), ("None", None, 1, False)]
    rows = exact_dedup.resolve(frame([(None, "same"), (4, "same"), (9, "same")])).collect()
    assert {r.keep_id for r in rows} == {4} and [r.doc_id for r in rows if r.kept] == [4]


def test_history_removes_repeats_and_groups_the_rest(frame):
    old = exact_dedup.winners(exact_dedup.digests(frame([(1, "seen before"), (2, "other")])))
    rows = {r.doc_id: r for r in exact_dedup.resolve(frame([(10, "seenbefore"), (11, "new"), (12, "n e w"), (13, "")]), old).collect()}
    assert (rows[10].keep_id, rows[10].kept) == (1, False)
    assert (rows[11].keep_id, rows[12].kept, rows[12].group_size) == (12, True, 2)
    assert rows[13].kept


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 256, 900):
        digest = np.frombuffer(rng.bytes(32 * n), np.uint8).reshape(n, 32)
        _, slots = exact_dedup.build_part(digest, -(-n // 3))
        assert sorted(slots.tolist()) == list(range(n))


def test_no_rows(frame):
    assert exact_dedup.resolve(frame([])).count() == 0


def test_keep_first_keeps_columns(frame):
    docs = frame([(1, "a b"), (2, "ab"), (3, "c")])
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
