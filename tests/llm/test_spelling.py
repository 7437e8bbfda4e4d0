import re
import zlib
from collections import Counter

import pytest
from tidemark.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWERED = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain(rows):
    """word -> (form, root, n, n_near, form_n), comparing all words with all."""
    count = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWERED)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def got_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got_of(spelling.variants(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


WORDS = {"colour": 700, "color": 90, "colours": 120, "coloure": 30, "colouré": 6, "coloureé": 5, "kolour": 5, "cölour": 9, "international": 300,
         "internatonal": 7, "internationals": 40, "iinternational": 8, "ÀÉÏÕÜÝ": 5, "aaaaaa": 100, "aaaaaaa": 10, "aaaaaaaa": 5, "BCDEFG": 25, "bcdefh": 5,
         "bcdefi": 5, "acdefg": 25, "bcdegf": 30}


def test_brute_force(spark, frame):
    rows = [(k, " ".join([w] * 5)) for w, n in WORDS.items() for k in range(n // 5)] + [(None, "color, colour; BCDEFG's"), (3, None), (4, ""), (3, "colour colour")]
    docs = frame(rows)
    got = got_of(spelling.variants(docs))
    assert got == plain(rows)
    assert got["coloureé"][1] == "colour" and got["aaaaaaaa"][3] == 1 and got["aaaaaaa"][1] == "aaaaaa"


@pytest.mark.parametrize("crowded", [0, 4, 10**9])
def test_crowded_chunks_change_nothing(spark, crowded):
    # Many words share an ending or a beginning; with 0 every chunk is crowded, with the last none is.
    letters = "abcdefgh"
    words = {a + b + "tion" for a in letters for b in letters} | {"ther" + a + b for a in letters for b in letters}
    words |= {a + "xtion" + b for a in letters for b in letters} | {"ther" + a for a in letters} | {"tion", "ab", "x", "é" + "ation", "therab" + "é"}
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    got = [frozenset(r) for r in spelling.near_pairs(table, crowded).collect()]
    want = {frozenset((a, b)) for a in words for b in words if one_edit(a, b) and min(len(a), len(b)) > 1}
    assert len(got) == len(set(got)) and {p for p in got if all(len(w) > 1 for w in p)} == want


def test_crowded_words_meet_only_near_ones(spark):
    # One ending for all words: candidates stay in proportion to the words.
    words = [f"{a}{b}{c}ending" for a in "abcdefghij" for b in "abcdefghij" for c in "klmno"]
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    pairs = spelling.near_pairs(table)
    assert pairs.count() == len(words) * (9 + 9 + 4) // 2


def test_long_and_odd_texts(frame, odd_texts):
    rows = odd_texts + [(20, "abcdefg" * 5000), (21, "straße " * 9000)]
    assert got_of(spelling.variants(frame(rows))) == plain(rows)


def test_no_words(frame):
    assert spelling.variants(frame([])).count() == 0
    assert spelling.variants(frame([(1, None), (2, "few short ones")])).count() == 0
