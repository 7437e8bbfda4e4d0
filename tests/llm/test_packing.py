import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tidemark.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_the_tokenizer(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [None, "", "a\x1cb \x1d c", "x<|endoftext|>y <|startoftext|>", "don't I'LL Á  ΟΔΟΣ Σ", "ͅ ́a", "It's we'll''s !'s a<|b 12x34 ÀÉß×÷ª² x_y", "É É ǅ İ ﬁ"]
    plain = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in packing.Encoder(public_tokenizers.path("word_bpe_49k.json")).encode(texts)] == [x.ids for x in plain]


def test_encoder_forgets_and_stays_right():
    made = packing.Encoder(PATH, part_bytes=300)
    for text in ("one two three", "four five six seven", "one two", "", "seven"):
        assert list(made.encode([text]))[0].tolist() == ids_of(text)[:-1]
        assert len(made.parts) + len(made.older) <= 11
    assert list(made.encode([])) == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 100, 800)
    for documents, cost in ((100, 10000), (3, 10000), (100, 3000)):
        sequence, offset = packing.best_fit(np.minimum(lengths, 54), 100, documents, cost, rule)
        for s in set(sequence.tolist()):
            own = np.minimum(lengths, 54)[sequence == s]
            assert own.sum() <= 100 and len(own) <= documents and (own**2).sum() <= cost
            places = sorted(zip(offset[sequence == s].tolist(), own.tolist()))
            assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0


def test_few_sequences():
    lengths = np.random.default_rng(3).integers(1, 4097, 3000)
    sequence, _ = packing.best_fit(lengths, 4096, 4096, 4096**2)
    assert sequence.max() + 1 <= 1.03 * lengths.sum() / 4096


def test_pieces_of_whole_documents(frame, odd_texts):
    rows = [(i, t) for i, t in odd_texts if i is not None]
    got = packing.pack(frame(rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, t in rows:
        ids = np.array(ids_of(t), "<u4")
        parts = [ids[k : k + 4096] for k in range(0, len(ids), 4096)]
        want = {(k, k * 4096, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)}
        assert want <= {(r.piece, r.start, r.length, r.ids_crc32) for r in by[i]}
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(n for _, n in places) <= 4096


def test_null_ids_leave_other_ids_exact(frame):
    big = (1 << 60) + 1
    rows = packing.pack(frame([(None, "a"), (big, "b"), (None, None)])).collect()
    assert sorted(str(r.doc_id) for r in rows) == [str(big), "None", "None"]


def test_sequences_hold_the_ids(frame):
    docs = frame([(1, "a b c"), (2, "d e")])
    packed = packing.pack(docs)
    ids = [list(r.ids) for r in packing.sequences(docs, packed, PATH).collect()]
    assert ids in ([ids_of("a b c") + ids_of("d e")], [ids_of("d e") + ids_of("a b c")])


def test_no_rows(frame):
    assert packing.pack(frame([])).count() == 0


def test_parts_that_come_again_are_encoded_once():
    words = ["".join(chr(97 + (k // 26**d) % 26) for d in range(4)) for k in range(160_000)]
    made, asked = packing.Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    own = made.closed.ids
    made.closed = type("Counted", (), {"ids": staticmethod(lambda parts: asked.append(len(parts)) or own(parts))})
    lots = [" ".join(words[k : k + 40_000]) for k in range(0, len(words), 40_000)]
    ids = [next(iter(made.encode([lot]))).tolist() for lot in lots + lots[:1]]
    assert ids[0] == ids[4] and asked == [40_000] * 4 + [0]
    odd = f"{words[3]}, {words[3].upper()} ΑΣ {words[9]}'s"
    assert next(iter(made.encode([odd]))).tolist() == made.made.encode(odd, add_special_tokens=False).ids
    made.rest()
    assert not made.older


def test_lean_gives_the_same_pieces_and_keeps_nothing(frame, odd_texts):
    docs = frame([(i, t) for i, t in odd_texts if i is not None])
    placed = lambda df: sorted(tuple(r) for r in df.collect())
    assert placed(packing.pack(docs, lean=True)) == placed(packing.pack(docs))
    packing.tokenizer_of(PATH)
    batches = docs.select("doc_id", "text").toArrow().to_batches()
    assert sum(b.num_rows for b in packing._cutter(PATH, 4096, 1, lean=True)(iter(batches))) >= len(odd_texts) - 1
    assert PATH not in packing._TOKENIZERS
