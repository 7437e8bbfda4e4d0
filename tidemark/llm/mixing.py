"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a sequence of tokens: its words, then an end. Frequent words are predicted where they stand, turn by turn on a binary
tree, in contexts that reach over the words before (see ``running``). A token that is none of them costs the way to the leaf of
the others, and then its share among those: its discounted frequency, and for what that leaves, its spelling.

Spelling takes a token by its bytes and a closing space, a byte by eight bits. Several predictors, one per context (the last 1
to 5 bytes of the word; the last two and the place in the word), count zeros and ones in hashed tables of fixed size, are mixed
by a gate with weights learned online while each word leaves its own counts out, and are refined by an adaptive map. This
spells any word, also a new one; it is learned once per distinct word, since how often words come is learned from the texts.

Frequencies are counted once over all training documents and once for each of a few groups of documents with alike letters
(found by k-means over all of them). A text is scored under its group, which is a context of every turn too; naming the group
costs log10 of their number, so the score remains a probability of the text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import columns_of, crc_mod, slices, stored, tidy
from .running import CODED, Tree, lots, train_text

FOLDS, HELD_OUT = 10, 0
#: The most frequent words, which every task is sent and the tree holds; all others are joined. About 100 bytes each.
HEAD_WORDS = 1 << 17
#: Distinct words that a task counts before it hands them on.
COUNT_WORDS = 400_000
SLOTS = 1 << 19
CONTEXTS = 6
GATES = 8 * (CONTEXTS + 1)
STEPS = 33
GROUPS = 8
#: Rounds of k-means, each over all training documents.
ROUNDS = 4
CHUNKS = 64
#: Bytes of words that are read at once, and bytes of a word that are compared with the word before.
SPELL_BYTES = 1 << 18
SHARED = 32
#: Both counts of a slot are halved together above this, so that their ratio stays.
FULL = (1 << 32) - 1
END = b""
CLOSE = 0x20
LEARN = 0.02
LN10 = float(np.log(10))

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased; split() cuts at exactly the white space of ASCII."""
    return (text or b"").translate(_LOWER).split()


# Spelling ---------------------------------------------------------------------------------------------------------


@dataclass
class Spelled:
    """Bytes of many words, all or those that the word before does not share: word, place in it, and context hashes of each."""

    word: np.ndarray
    place: np.ndarray
    byte: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], whole: bool = False) -> Spelled:
        flat = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(flat)) - starts[word]
        new = np.arange(len(flat))
        if not whole:
            # the first SHARED bytes of each word beside those of the word before; bytes count as shared while all before them are
            padded = np.concatenate([flat, np.zeros(SHARED, np.uint8)])
            lead = padded[starts[:, None] + np.arange(SHARED)]
            inside = np.arange(SHARED) < sizes[:, None]
            same = np.zeros((len(words), SHARED), bool)
            same[1:] = (lead[1:] == lead[:-1]) & inside[1:] & inside[:-1]
            shared = np.logical_and.accumulate(same, axis=1).sum(axis=1)
            new = np.flatnonzero(place >= shared[word])
            word, place = word[new], place[new]
        hashes = np.zeros((CONTEXTS, len(new)), np.uint64)
        h = np.zeros(len(new), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(1, CONTEXTS):
                before = flat[np.maximum(new - k, 0)].astype(np.uint64) + np.uint64(1)
                before[place < k] = 0
                h = (h + before) * _A + np.uint64(k)
                hashes[k - 1] = h ^ (h >> np.uint64(29))
                if k == 2:
                    hashes[-1] = (h + np.minimum(place, 12).astype(np.uint64)) * _B
        return cls(word, place, flat[new].astype(np.int64), hashes)

    def sums(self, values: np.ndarray, n: int) -> np.ndarray:
        """The sum over all bytes of each of n words; a shared byte has the value it had where it was new."""
        early = self.place < SHARED
        table = np.zeros((n, SHARED))
        at = np.zeros((n, SHARED), np.int64)
        table[self.word[early], self.place[early]] = values[early]
        at[self.word[early], self.place[early]] = self.word[early]
        first = np.full(n, SHARED)
        np.minimum.at(first, self.word, self.place)
        shared = np.arange(SHARED) < first[:, None]
        source = np.maximum.accumulate(at, axis=0)  # a shared byte was new in the last word that has it anew
        own = np.take_along_axis(table, source, axis=0)
        return (own * shared).sum(axis=1) + np.bincount(self.word, values, n)

    def bits(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Bit number, its values, the bits before it with a leading one, and the slots (contexts x bytes)."""
        for bit in range(8):
            seen = (self.byte | 256) >> (8 - bit)
            with np.errstate(over="ignore"):
                mixed = (self.hashes + seen.astype(np.uint64) * _B) * _A
            slot = (mixed >> np.uint64(64 - 19)).astype(np.int64)
            yield bit, (self.byte >> (7 - bit)) & 1, seen, slot


_SHIFT = np.arange(CONTEXTS)[:, None] * SLOTS


def _log(counts: np.ndarray) -> np.ndarray:
    return np.log(counts.astype(np.float32) + np.float32(0.4))


@dataclass
class Model:
    """Counts of zeros and ones (contexts by slots, flat), weights of each gate, and the refining map's counts."""

    zeros: np.ndarray
    ones: np.ndarray
    weights: np.ndarray
    map_zeros: np.ndarray
    map_ones: np.ndarray

    @classmethod
    def empty(cls) -> Model:
        cells = CONTEXTS * SLOTS
        return cls(np.zeros(cells, np.uint32), np.zeros(cells, np.uint32), np.full((GATES, CONTEXTS), 0.3), np.zeros((STEPS, 256)), np.zeros((STEPS, 256)))

    def __getstate__(self) -> tuple:
        return zlib.compress(self.zeros.tobytes(), 1), zlib.compress(self.ones.tobytes(), 1), self.weights, self.map_zeros, self.map_ones

    def __setstate__(self, state: tuple) -> None:
        self.zeros, self.ones = (np.frombuffer(zlib.decompress(x), np.uint32) for x in state[:2])
        self.weights, self.map_zeros, self.map_ones = state[2:]

    def odds(self, slot: np.ndarray, own: np.ndarray | None, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of a one from every context, and the gate. ``own``: the bits' values, to be left out of the counts."""
        at = slot + _SHIFT
        if own is None:
            if not hasattr(self, "_odds"):
                self._odds, self._seen = _log(self.ones) - _log(self.zeros), (self.ones | self.zeros) > 0
            st, met = self._odds[at], self._seen[at]
        else:
            zeros, ones = self.zeros[at].astype(np.int64), self.ones[at].astype(np.int64)
            zeros, ones = np.maximum(zeros - (1 - own), 0), np.maximum(ones - own, 0)
            st, met = _log(ones) - _log(zeros), (ones | zeros) > 0
        longest = np.zeros(slot.shape[1], np.int64)  # of the plain contexts that were seen, 0 for none
        for k in range(CONTEXTS - 1):
            longest[met[k]] = k + 1
        return st, bit * (CONTEXTS + 1) + longest

    def refined(self, logit: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Probability of a one: the mean of the mixed one and of the map's."""
        step = _step(logit)
        p = 1 / (1 + np.exp(-logit))
        zeros, ones = self.map_zeros[step, seen], self.map_ones[step, seen]
        return np.clip((p + (ones + 4 * p) / (ones + zeros + 4)) / 2, 1e-6, 1 - 1e-6)

    def costs(self, words: list[bytes]) -> np.ndarray:
        """log10 of the probability that the spelling gives each word; fastest for words in order."""
        out = np.zeros(len(words))
        for lot, at in _lots(words):
            spelled = Spelled.of(lot)
            total = np.zeros(len(spelled.byte))
            for bit, value, seen, slot in spelled.bits():
                st, gate = self.odds(slot, None, bit)
                p = self.refined(_mix(self.weights, gate, st), seen)
                total += np.log(np.where(value == 1, p, 1 - p))
            out[at : at + len(lot)] = spelled.sums(total, len(lot)) / LN10
        return out


def _mix(weights: np.ndarray, gate: np.ndarray, st: np.ndarray) -> np.ndarray:
    logit = np.zeros(len(gate))
    for k in range(CONTEXTS):
        logit += weights[:, k][gate] * st[k]
    return logit.clip(-14, 14)


def _step(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.round(logit * 2) + STEPS // 2, 0, STEPS - 1).astype(np.int64)


def _lots(words: list[bytes]) -> Iterator[tuple[list[bytes], int]]:
    """Words in order, about SPELL_BYTES together; a longer word comes alone."""
    ends = np.cumsum([len(w) + 1 for w in words]) if words else np.zeros(0)
    start = 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SPELL_BYTES, side="right")))
        yield words[start:stop], start
        start = stop


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a task's words, in chunks of compressed bytes."""
    zeros, ones = np.zeros(CONTEXTS * SLOTS, np.uint32), np.zeros(CONTEXTS * SLOTS, np.uint32)
    for batch in batches:
        for lot, _ in _lots(batch.column("word").to_pylist()):
            for _, value, _, slot in Spelled.of(lot, whole=True).bits():
                at = slot + _SHIFT
                np.add.at(ones, at[:, value == 1].ravel(), np.uint32(1))
                np.add.at(zeros, at[:, value == 0].ravel(), np.uint32(1))
    width = CONTEXTS * SLOTS // CHUNKS
    both = [zlib.compress(zeros[k : k + width].tobytes() + ones[k : k + width].tobytes(), 1) for k in range(0, len(zeros), width)]
    yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array(both, pa.binary())], ["chunk", "counts"])


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64) for c in rows["counts"])
    both = total.reshape(2, -1)  # zeros, ones
    while (over := both.max(axis=0) > FULL).any():
        both = np.where(over, both >> np.uint64(1), both)
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "counts": [zlib.compress(both.astype(np.uint32).tobytes(), 1)]})


def _learner(model: Model) -> Callable:
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Online weights of a task, times their bits, and what the refining map counts: rows (cell, total, bits)."""
        weights, bits = np.full((GATES, CONTEXTS), 0.3), np.zeros(GATES)
        maps = np.zeros((2, STEPS * 256))
        for batch in batches:
            for lot, _ in _lots(batch.column("word").to_pylist()):
                for bit, value, seen, slot in Spelled.of(lot, whole=True).bits():
                    st, gate = model.odds(slot, value, bit)
                    for k in range(0, len(value), 4096):
                        part = slice(k, k + 4096)
                        x, g = st[:, part], gate[part]
                        logit = _mix(weights, g, x)
                        miss = value[part] - 1 / (1 + np.exp(-logit))
                        n = np.bincount(g, minlength=GATES)
                        step = LEARN / np.sqrt(1 + bits / 65536)
                        for c in range(CONTEXTS):
                            weights[:, c] += step * np.bincount(g, miss * x[c], GATES) / np.sqrt(np.maximum(n, 1))
                        bits += n
                        maps[1] += np.bincount(_step(logit) * 256 + seen[part], value[part], STEPS * 256)
                        maps[0] += np.bincount(_step(logit) * 256 + seen[part], 1 - value[part], STEPS * 256)
        totals = np.concatenate([(weights * bits[:, None]).ravel(), maps.ravel()])
        weight_of = np.concatenate([np.repeat(bits, CONTEXTS), np.zeros(maps.size)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(totals), pa.array(weight_of)], ["cell", "total", "bits"])

    return learn


def train(vocabulary: DataFrame) -> Model:
    """The model of the words counted in training. All words take part; tables are summed by Spark, a chunk at a time."""
    words = vocabulary.filter("c > 0").select("word")
    model = Model.empty()
    counts = words.mapInArrow(_counter, "chunk int, counts binary").groupBy("chunk").applyInPandas(_summed, "chunk int, counts binary")
    width = CONTEXTS * SLOTS // CHUNKS
    for row in counts.collect():  # CHUNKS rows, whatever the input
        both = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
        at = slice(row["chunk"] * width, (row["chunk"] + 1) * width)
        model.zeros[at], model.ones[at] = both[:width], both[width:]
    sent = words.sparkSession.sparkContext.broadcast(model)
    learned = words.mapInArrow(lambda batches: _learner(sent.value)(batches), "cell int, total double, bits double")
    flat, many = np.zeros(GATES * CONTEXTS + 2 * STEPS * 256), np.zeros(GATES * CONTEXTS + 2 * STEPS * 256)
    for row in learned.groupBy("cell").agg(F.sum("total").alias("total"), F.sum("bits").alias("bits")).collect():  # as many rows as cells
        flat[row["cell"]], many[row["cell"]] = row["total"], row["bits"]
    cut = GATES * CONTEXTS
    weights = np.where(many[:cut] > 0, flat[:cut] / np.maximum(many[:cut], 1), 0.3).reshape(GATES, CONTEXTS)
    maps = flat[cut:].reshape(2, STEPS, 256)
    return Model(model.zeros, model.ones, weights, maps[0], maps[1])


# Groups of documents ------------------------------------------------------------------------------------------------


def letters(text: bytes | None) -> np.ndarray:
    """Square roots of the shares of the bytes of a text, 256 numbers with a norm of one (all zero for an empty text)."""
    raw = (text or b"").translate(_LOWER)
    return np.sqrt(np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / max(len(raw), 1))


def group_of(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None] - 2 * points @ centres.T, axis=1)


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of each text in 256 bytes, for the rounds to read instead of texts."""
    for batch in slices(batches, "text", 4 << 20):
        yield pa.RecordBatch.from_arrays([pa.array([np.round(letters(t) * 255).astype(np.uint8).tobytes() for t in batch.column("text").to_pylist()])], ["point"])


def _gatherer(centres: np.ndarray) -> Callable:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, many = np.zeros((GROUPS, 256)), np.zeros(GROUPS)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.frombuffer(b"".join(batch.column("point").to_pylist()), np.uint8).reshape(-1, 256) / 255
            group = group_of(points, centres)
            for g in range(GROUPS):
                sums[g] += points[group == g].sum(axis=0)
            many += np.bincount(group, minlength=GROUPS)
        cells = np.concatenate([sums.ravel(), many])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], ["cell", "total"])

    return gather


def groups(train: DataFrame) -> np.ndarray:
    """Centres of the groups: far points of a few documents at first, then means over all documents."""
    points = stored(train.mapInArrow(_points, "point binary"), "points")
    few = [np.frombuffer(r["point"], np.uint8) / 255 for r in points.orderBy(F.xxhash64("point")).limit(256).collect()]
    centres = [few[0] if few else np.zeros(256)]
    while len(centres) < GROUPS:
        far = [min(((x - c) ** 2).sum() for c in centres) for x in few]
        centres.append(few[int(np.argmax(far))] if few else np.zeros(256))
    made = np.stack(centres)
    for _ in range(ROUNDS if few else 0):
        cells = np.zeros(GROUPS * 257)
        for row in points.mapInArrow(_gatherer(made), "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect():
            cells[row["cell"]] = row["total"]
        many = cells[GROUPS * 256 :]
        made = np.where(many[:, None] > 0, cells[: GROUPS * 256].reshape(GROUPS, 256) / np.maximum(many, 1)[:, None], made)
    return made


# Words of the corpus -----------------------------------------------------------------------------------------------


def _word_counter(centres: np.ndarray) -> Callable:
    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words with their training counts by group; words of held-out documents alone count nought."""
        trained: list[Counter[bytes]] = [Counter() for _ in range(GROUPS)]
        others: set[bytes] = set()

        def handed() -> Iterator[pa.RecordBatch]:
            known = set().union(*trained)
            for group, counts in enumerate([*trained, dict.fromkeys((w for w in others if w not in known), 0)]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*counts], pa.binary()), pa.array([group % GROUPS] * len(counts), pa.int32()), pa.array([*counts.values()], pa.int64())],
                    ["word", "group", "c"],
                )

        for batch in slices(batches, "text", 2 << 20):
            for text, held_out in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist()):
                into = others if held_out else trained[int(group_of(letters(text)[None], centres)[0])]
                into.update(words_of(text))
                into.update((END,))
            if sum(map(len, trained)) + len(others) > COUNT_WORDS:
                yield from handed()
                trained, others = [Counter() for _ in range(GROUPS)], set()
        yield from handed()

    return count_words


@dataclass
class Totals:
    tokens: int  # N
    types: int  # V
    once: int
    twice: int
    by_group: list[int]  # tokens
    types_of: list[int]

    @property
    def discount(self) -> float:
        return min(max(self.once / max(self.once + 2 * self.twice, 1), 0.1), 0.95)

    def without(self, tokens: int, types: int, by_group: list[int], types_of: list[int]) -> Totals:
        """What is left without some words; the discount stays that of all."""
        left = Totals(self.tokens - tokens, self.types - types, self.once, self.twice, *([a - b for a, b in zip(x, y)] for x, y in ((self.by_group, by_group), (self.types_of, types_of))))
        return left

    def base(self, c: Column) -> Column:
        return F.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def mixed(self, c: Column, spelled: Column, group: Column) -> Column:
        """log10 of the discounted frequency in the group, backed by the common one, backed by the spelling. Shares are added
        as logarithms, so that what a spelling costs counts in full, however little is left of it as a number."""
        if not self.tokens:
            return spelled
        d = self.discount

        def backed(count: Column, tokens: Column, left: Column, rest: Column) -> Column:
            rest = left + rest
            own = F.log10(count - d) - tokens  # d is below one
            more, less = F.greatest(own, rest), F.least(own, rest)
            return F.when(count > 0, more + F.log1p(F.pow(F.lit(10.0), less - more)) / LN10).otherwise(rest)

        def logs(tokens: int, types: int) -> tuple[float, float]:
            return (float(np.log10(tokens)), float(np.log10(d * types / tokens))) if tokens else (0.0, 0.0)

        common = backed(c, *map(F.lit, logs(self.tokens, self.types)), spelled)
        of_group = [F.get(F.array(*map(F.lit, x)), group) for x in zip(*map(logs, self.by_group, self.types_of))]
        own = backed(F.get(F.array(*[F.col(f"c{g}") for g in range(GROUPS)]), group), *of_group, common)
        return F.when(F.get(F.array(*map(F.lit, self.by_group)), group) > 0, own).otherwise(common)


def _speller(sent) -> Callable:
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = sent.value.costs(batch.column("word").to_pylist())
            yield batch.append_column("spelled", pa.array(costs, pa.float32()))

    return spell


def _encoder(sent, centres: np.ndarray) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as ids of their tokens in order, and their other words with counts. Ids below nought are other words'."""
        head = sent.value
        for batch in slices(batches, "text", 1 << 20):
            every, tails, sizes, groups_ = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                words.append(END)
                at = [head.get(w, -1) for w in words]
                other = [k for k, i in enumerate(at) if i < 0]
                for k in other:
                    at[k] = -1 - (zlib.crc32(words[k]) >> 1)
                every.append(pa.array(at, pa.int32()))
                tails.append(Counter(words[k] for k in other))
                sizes.append((len(words), len(text or b"")))
                groups_.append(int(group_of(letters(text)[None], centres)[0]))
            lists = lambda parts: pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
            found = pa.StructArray.from_arrays(
                [pa.array([w for t in tails for w in t], pa.binary()), pa.array([n for t in tails for n in t.values()], pa.int64())], ["word", "tf"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in sizes], pa.int64()),
                    pa.array([x[1] for x in sizes], pa.int64()), pa.array(groups_, pa.int32()),
                    pa.ListArray.from_arrays(lists(every), pa.concat_arrays(every)), pa.ListArray.from_arrays(lists(tails), found),
                ],
                ["key", "doc_id", "held_out", "n_tokens", "n_bytes", "group", "ids", "tails"],
            )

    return tidy(encode)


SUMS = "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_bytes bigint, n_known bigint, base double, model double"


def _scorer(sent) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document the sums over its tokens' leaves; what other words cost beyond theirs is added by a join."""
        model, base = sent.value
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((3, n))
            for ids, place, group, owner in lots(batch):
                own = owner >= 0
                frequent = own & (ids >= 0)
                sums[0] += np.bincount(owner[frequent], minlength=n)
                sums[1] += np.bincount(owner[frequent], base[ids[frequent]], n)
                sums[2] += np.bincount(owner[own], model.costs(ids, place, group)[own], n)
            named = [batch.column(c) for c in ("key", "doc_id", "held_out", "n_tokens", "n_bytes")]
            made = [pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2] - float(np.log10(GROUPS)))]
            yield pa.RecordBatch.from_arrays([*named, *made], [f.split()[0] for f in SUMS.split(", ")])

    return tidy(score)


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: fold, tokens, tokens known from training, the unigram baseline and the model's log10 probability.

    Training takes all documents of the other folds. A null or empty text is the end alone. A word of any length is spelled in
    full and costs what its spelling costs. Repeated rows are scored one by one; a null id is in fold 0,
    held out. Without any training document the base counts are nought and the untrained spelling stands alone.
    """
    own = columns_of(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"), (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    )
    centres = groups(own.filter("not held_out").select("text"))
    found = own.select("text", "held_out").mapInArrow(_word_counter(centres), "word binary, group int, c bigint")
    by_group = [F.coalesce(F.sum(F.when(F.col("group") == g, F.col("c"))), F.lit(0)).alias(f"c{g}") for g in range(GROUPS)]
    # In order, so that a task's words share their beginnings.
    counted = found.groupBy("word").agg(F.sum("c").alias("c"), *by_group).repartitionByRange("word").sortWithinPartitions("word")
    counted = stored(counted, "words", "zstd")
    n = counted.filter("c > 0").agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2),
        F.array(*[F.coalesce(F.sum(f"c{g}"), F.lit(0)) for g in range(GROUPS)]), F.array(*[F.count_if(F.col(f"c{g}") > 0) for g in range(GROUPS)]),
    ).first()
    totals = Totals(*n)
    context = own.sparkSession.sparkContext
    # Words seen once are left to the others: how often those come is how often new words are to be expected.
    top = counted.filter("c > 1").orderBy(F.desc("c"), "word").limit(HEAD_WORDS).toArrow()
    seen = np.asarray(top.column("c"))
    in_group = np.stack([np.asarray(top.column(f"c{g}")) for g in range(GROUPS)])
    other = totals.without(int(seen.sum()), len(seen), in_group.sum(axis=1).tolist(), (in_group > 0).sum(axis=1).tolist())
    sent = context.broadcast(train(counted.select("word", "c")))
    spelled = counted.filter("c < 2" if len(seen) < HEAD_WORDS else "true").mapInArrow(
        _speller(sent), ", ".join(["word binary", "c bigint", *[f"c{g} bigint" for g in range(GROUPS)], "spelled float"])
    )
    tail = stored(spelled, "values", "zstd")

    head = context.broadcast({w: k for k, w in enumerate(top.column("word").to_pylist())})
    coded = stored(own.withColumn("key", F.monotonically_increasing_id()).mapInArrow(_encoder(head, centres), CODED), "coded")
    model = train_text(coded.filter("not held_out"), Tree.of(np.append(seen, other.tokens)))
    base = np.log10((seen + 0.1) / (totals.tokens + 0.1 * (totals.types + 1)))
    rows = coded.drop("tails").mapInArrow(_scorer(context.broadcast((model, base))), SUMS)
    met = coded.select("key", "group", F.explode("tails").alias("t")).select("key", "group", "t.word", "t.tf").join(tail, "word").select(
        "key", F.when(F.col("c") > 0, F.col("tf")).otherwise(0).alias("n_known"),
        (F.col("tf") * totals.base(F.col("c"))).alias("base"),
        (F.col("tf") * other.mixed(F.col("c"), F.col("spelled").cast("double"), F.col("group"))).alias("model"),
    )
    summed = rows.unionByName(met, allowMissingColumns=True).groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_bytes")], *[F.sum(c).alias(c) for c in ("n_known", "base", "model")]
    )
    return summed.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), F.col("model").alias("score"),
        (-F.col("model") * (LN10 / float(np.log(2))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
