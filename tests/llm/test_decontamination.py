import hashlib
import random
import re

from tidemark.llm import decontamination

SEP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SEP.split(low) if w]


def brute(docs, items):
    wins = []
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.append((w[k : k + 10], i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for win, i in wins:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    random.seed(5)
    pick = lambda n: " ".join(random.choices(["Ab", "cD", "é9", "x"], k=n))
    items = [(k, pick(random.choice([0, 3, 9, 10, 11, 14]))) for k in range(40)] + [(90, None), (91, "..."), (92, "x, é9! Ab")]
    docs = [(k, pick(random.randint(0, 60)).replace(" ", random.choice([" ", ", ", "\n"]))) for k in range(200)]
    docs += [(300 + k, "q " * k + (items[k][1] or "") + " q") for k in range(40)]
    return docs, items


def test_equals_brute_force(frame, odd_texts, monkeypatch):
    docs, items = cases()
    docs = docs + [(i, t) for i, t in odd_texts]
    bench = frame(items, "item_id")
    got = sorted([tuple(r)[:6] for r in decontamination.contamination(frame(docs), bench).collect()], key=str)
    assert got == brute(docs, items)
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", 500)  # several automata give the same
    assert sorted([tuple(r)[:6] for r in decontamination.contamination(frame(docs), bench).collect()], key=str) == got


def test_spans_are_places_of_the_original(frame):
    item = "one two three four five six seven eight nine ten"
    text = "\U0001f600 Before: ONE--two three, four five six seven eight nine ten! after"
    row = decontamination.contamination(frame([(1, text)]), frame([(7, item)], "item_id")).first()
    assert text[row.spans[0].start : row.spans[0].end] == "ONE--two three, four five six seven eight nine ten"


def test_empty_tables(frame):
    assert decontamination.contamination(frame([]), frame([(1, "a b")], "item_id")).count() == 0
    row = decontamination.contamination(frame([(1, "a b")]), frame([], "item_id")).first()
    assert (row.n_words, row.contaminated) == (2, False)


def test_keep_clean(frame):
    docs = frame([(1, "a b"), (2, "c d"), (None, "c d")])
    kept = decontamination.keep_clean(docs, frame([(1, "a b")], "item_id"))
    assert kept.columns == docs.columns and kept.count() == 2
