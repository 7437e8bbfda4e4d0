"""Logistic mixing over running text: bit predictors whose contexts reach over the ends of words.

A token is coded by the turns on its way through a binary tree: Huffman's, over the frequent words and one leaf for all the
others. Every turn is predicted in several contexts: the place in the tree alone, with the document's group, and with the one,
two and three words before. Each context counts zeros and ones in a table of fixed size, over every occurrence in the training
texts. Log odds are added with weights that a gate chooses by the depth and by the longest context seen; the weights are
learned online in small steps, while each turn leaves its own count out, and an adaptive map refines what was mixed.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import tidy

#: Contexts of a turn: place, group, and one to ORDERS words before.
ORDERS = 3
CONTEXTS = 2 + ORDERS
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
CHUNKS = 64
DEPTHS = 8
GATES = DEPTHS * (ORDERS + 1)
STEPS, PLACES = 33, 256
#: Tokens that are read at once, and turns between two steps of the weights.
LOT = 1 << 13
STRIDE = 1 << 14
LEARN = 0.02
START = 0.3
#: Counts below EXACT are kept as they are, larger ones by eighths of powers of two.
EXACT = 128
#: The smallest probability of a turn: Python's number, so that single precision stays single.
LEAST = 1e-6
LN10 = float(np.log(10))
CODED = "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_bytes bigint, group int, ids array<int>, tails array<struct<word: binary, tf: bigint>>"

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint32(0x9E3779B1)
_SIZES = np.where(np.arange(256) < EXACT, np.arange(256), EXACT * 2.0 ** ((np.arange(256) - EXACT) / 8))


def _states(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Both counts of a slot in 16 bits; counts too large for that are lowered together, so that their ratio stays."""
    both = np.stack([zeros, ones]).astype(np.float32)
    both *= np.minimum(1, _SIZES[-1] / np.maximum(both.max(axis=0), 1)).astype(np.float32)
    large = EXACT + np.round(8 * np.log2(np.maximum(both, EXACT) / EXACT))
    kept = np.where(both < EXACT, np.round(both), np.minimum(large, 255)).astype(np.uint16)
    return (kept[0] << np.uint16(8)) | kept[1]


def _odds_of(own: int | None) -> np.ndarray:
    """Log odds of a one for each state, without one zero (``own`` 0) or one one (1)."""
    zeros, ones = np.repeat(_SIZES, 256), np.tile(_SIZES, 256)
    zeros, ones = np.maximum(zeros - (own == 0), 0), np.maximum(ones - (own == 1), 0)
    return (np.log(ones + 0.4) - np.log(zeros + 0.4)).astype(np.float32)


ODDS, ODDS_WITHOUT = _odds_of(None), np.stack([_odds_of(0), _odds_of(1)])


@dataclass
class Tree:
    """Ways to the leaves, one after another: leaf k's are at ``start[k]`` to ``start[k + 1]``. The last leaf is for all other words."""

    start: np.ndarray
    node: np.ndarray
    turn: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Tree:
        n = len(counts)
        heap = [(int(c), k) for k, c in enumerate(counts)]
        heapq.heapify(heap)
        parent, side = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int8)
        for inner in range(n, 2 * n - 1):
            (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
            parent[left] = parent[right] = inner
            side[right] = 1
            heapq.heappush(heap, (a + b, inner))
        # The root is node 0, and frequent nodes have small numbers. All leaves go up together, a step at a time.
        root, depth = 2 * n - 2, np.zeros(2 * n, np.int64)
        for inner in range(root - 1, -1, -1):
            depth[inner] = depth[parent[inner]] + 1
        start = np.concatenate([[0], np.cumsum(depth[:n])])
        node, turn = np.zeros(start[-1], np.int32), np.zeros(start[-1], np.int8)
        leaf, at = np.arange(n), np.arange(n)
        while len(leaf := leaf[at != root]):
            at = at[at != root]
            place = start[leaf] + depth[at] - 1
            node[place], turn[place] = root - parent[at], side[at]
            at = parent[at]
        return cls(start, node, turn)

    @property
    def other(self) -> int:
        return len(self.start) - 2


@dataclass
class Turns:
    """All turns of some documents' tokens: token, depth, node, way taken, and the slots (contexts x turns)."""

    token: np.ndarray
    depth: np.ndarray
    node: np.ndarray
    turn: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, tree: Tree, ids: np.ndarray, place: np.ndarray, group: np.ndarray) -> Turns:
        """``place``: of a token in its document. ``ids`` below nought are other words, told apart as contexts."""
        leaf = np.where(ids < 0, tree.other, ids)
        first = tree.start[leaf]
        size = tree.start[leaf + 1] - first
        token = np.repeat(np.arange(len(ids), dtype=np.int32), size)
        begin = np.cumsum(size) - size
        at = np.arange(len(token)) + np.repeat(first - begin, size)
        depth = np.arange(len(token), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)
        node = tree.node[at]
        slots = np.empty((CONTEXTS, len(token)), np.int32)
        slots[0] = node & (SLOTS - 1)
        with np.errstate(over="ignore"):
            mark = node.astype(np.uint32) * _C
            _slot(group.astype(np.uint64) * _B, size, mark, slots[1])
            h = np.zeros(len(ids), np.uint64)
            own = ids.astype(np.int64).astype(np.uint64) + np.uint64(1 << 33)
            for k in range(1, ORDERS + 1):
                before = np.zeros(len(ids), np.uint64)
                before[k:] = own[:-k] if k < len(ids) else own[:0]
                before[place < k] = 0
                h = (h + before) * _A + np.uint64(k)
                h ^= h >> np.uint64(29)
                _slot(h, size, mark, slots[1 + k])
        return cls(token, depth, node, tree.turn[at], slots)


def _slot(h: np.ndarray, size: np.ndarray, mark: np.ndarray, into: np.ndarray) -> None:
    """Slots of the turns of tokens with these context hashes, each of ``size`` turns."""
    mixed = np.repeat((h * _B >> np.uint64(32)).astype(np.uint32), size)
    mixed += mark
    mixed ^= mixed >> np.uint32(15)
    mixed *= _C
    mixed >>= np.uint32(32 - SLOT_BITS)
    into[:] = mixed


@dataclass
class TextModel:
    tree: Tree
    states: np.ndarray  # contexts by slots
    weights: np.ndarray
    maps: np.ndarray  # zeros and ones, by step and place

    def inputs(self, turns: Turns, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of every context and the gate. ``own``: the turns are counted in the tables and are left out."""
        st = np.empty((CONTEXTS, len(turns.token)), np.float32)
        longest = np.zeros(len(turns.token), np.uint8)
        table, shift, alone = (ODDS_WITHOUT.ravel(), turns.turn.astype(np.int32) << 16, np.where(turns.turn == 1, 1, 256).astype(np.uint16)) if own else (ODDS, 0, np.uint16(0))
        for c in range(CONTEXTS):
            state = self.states[c].take(turns.slots[c])
            st[c] = table.take(state + shift) if own else table.take(state)
            if c > 1:
                np.maximum(longest, (state != alone).view(np.uint8) * np.uint8(c - 1), out=longest)
        return st, np.minimum(turns.depth, DEPTHS - 1) * (ORDERS + 1) + longest

    def refined(self, logit: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Probability of a one: the mean of the mixed one and of the map's."""
        p = 1 / (1 + np.exp(-logit))
        seen, ones = self._refining()
        at = _step(logit) * PLACES + np.minimum(node, PLACES - 1)
        return np.clip((p + (ones.take(at) + 4 * p) / seen.take(at)) / 2, LEAST, 1 - LEAST)

    def _refining(self) -> tuple[np.ndarray, np.ndarray]:
        """What the map saw at each step and place, plus 4, and how many were ones."""
        if not hasattr(self, "_map"):
            self._map = (self.maps.sum(axis=0) + 4).astype(np.float32).ravel(), self.maps[1].astype(np.float32).ravel()
        return self._map

    def costs(self, ids: np.ndarray, place: np.ndarray, group: np.ndarray) -> np.ndarray:
        """log10 of the probability of every token's leaf after the words before it."""
        turns = Turns.of(self.tree, ids, place, group)
        st, gate = self.inputs(turns, False)
        p = self.refined(_mix(self.weights, gate, st), turns.node)
        return np.bincount(turns.token, np.log(np.abs(p - (1 - turns.turn).astype(np.float32))), len(ids)) / LN10


def _mix(weights: np.ndarray, gate: np.ndarray, st: np.ndarray) -> np.ndarray:
    logit, of = np.zeros(len(gate), np.float32), weights.T.astype(np.float32)
    for c in range(CONTEXTS):
        logit += of[c].take(gate) * st[c]
    return logit.clip(-14, 14)


def _step(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.round(logit * 2) + STEPS // 2, 0, STEPS - 1).astype(np.int32)


def lots(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, places, groups and rows of the batch's tokens, about LOT together. A long document comes in parts, each after the
    ORDERS tokens before it, which have the row -1 and are contexts only."""
    group = np.asarray(batch.column("group"))
    ids = batch.column("ids")
    ends = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values.to_numpy().astype(np.int64)
    size = np.diff(ends)
    row = np.repeat(np.arange(len(size)), size)
    flat = flat[ends[0] : ends[-1]]
    place = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], size)
    for at in range(0, len(flat), LOT):
        part = slice(max(at - ORDERS, 0), at + LOT)
        owner = row[part].copy()
        owner[: at - part.start] = -1
        yield flat[part], place[part], group[row[part]], owner


def _own(turns: Turns, owner: np.ndarray) -> Turns:
    """Without the turns of tokens that are contexts only."""
    from_ = int(np.searchsorted(turns.token, int((owner < 0).sum())))
    return Turns(turns.token[from_:], turns.depth[from_:], turns.node[from_:], turns.turn[from_:], turns.slots[:, from_:])


def _packed(counts: np.ndarray) -> bytes:
    """Counts compressed byte by byte: the high ones are nearly all nought."""
    return zlib.compress(counts.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()


def _counter(sent) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of a task's turns, in chunks of compressed bytes."""
        both = np.zeros((CONTEXTS, 2 * SLOTS), np.uint32)
        for batch in batches:
            for ids, place, group, owner in lots(batch):
                turns = _own(Turns.of(sent.value, ids, place, group), owner)
                for c in range(CONTEXTS):
                    np.add.at(both[c], 2 * turns.slots[c] + turns.turn, np.uint32(1))
        flat, width = both.reshape(-1), both.size // CHUNKS
        for chunk in range(CHUNKS):
            packed = _packed(flat[chunk * width : (chunk + 1) * width])
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([packed], pa.binary())], ["chunk", "counts"])

    return tidy(count)


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """The states of a chunk's slots."""
    total = np.zeros(2 * CONTEXTS * SLOTS // CHUNKS, np.int64)
    for packed in rows["counts"]:
        total += _unpacked(packed)
    states = _states(total[0::2], total[1::2])
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "states": [zlib.compress(states.tobytes(), 1)]})


def _learner(sent) -> Callable:
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Online weights of a task, times their turns, and what the refining map counts: rows (cell, total, turns)."""
        model = sent.value
        weights, seen, maps = np.full((GATES, CONTEXTS), START), np.zeros(GATES), np.zeros((2, STEPS * PLACES))
        for batch in batches:
            for ids, place, group, owner in lots(batch):
                turns = _own(Turns.of(model.tree, ids, place, group), owner)
                st, gate = model.inputs(turns, True)
                for k in range(0, len(gate), STRIDE):
                    part = slice(k, k + STRIDE)
                    x, g, turn = st[:, part], gate[part], turns.turn[part]
                    logit = _mix(weights, g, x)
                    miss = turn - 1 / (1 + np.exp(-logit))
                    n = np.bincount(g, minlength=GATES)
                    step = LEARN / np.sqrt(1 + seen / 65536)
                    for c in range(CONTEXTS):
                        weights[:, c] += step * np.bincount(g, miss * x[c], GATES) / np.sqrt(np.maximum(n, 1))
                    seen += n
                    cell = _step(logit) * PLACES + np.minimum(turns.node[part], PLACES - 1)
                    ones = np.bincount(cell, turn, STEPS * PLACES)
                    maps[0] += np.bincount(cell, minlength=STEPS * PLACES) - ones
                    maps[1] += ones
        totals = np.concatenate([(weights * seen[:, None]).ravel(), maps.ravel()])
        weight_of = np.concatenate([np.repeat(seen, CONTEXTS), np.zeros(maps.size)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(totals), pa.array(weight_of)], ["cell", "total", "turns"])

    return tidy(learn)


def train_text(coded: DataFrame, tree: Tree) -> TextModel:
    """The model of running texts: every occurrence of every training token is counted and learned from.

    ``coded`` has ``group`` and ``ids`` of the training documents; tables are summed by Spark, a chunk at a time.
    """
    context, own = coded.sparkSession.sparkContext, coded.select("group", "ids")
    ways = context.broadcast(tree)
    counts = own.mapInArrow(_counter(ways), "chunk int, counts binary").groupBy("chunk").applyInPandas(_summed, "chunk int, states binary")
    states = np.zeros(CONTEXTS * SLOTS, np.uint16)
    width = len(states) // CHUNKS
    for row in counts.toLocalIterator():  # CHUNKS rows, whatever the input
        states[row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(zlib.decompress(row["states"]), np.uint16)
    model = TextModel(tree, states.reshape(CONTEXTS, SLOTS), np.full((GATES, CONTEXTS), START), np.zeros((2, STEPS, PLACES)))
    sent = context.broadcast(model)
    flat, many = np.zeros(GATES * CONTEXTS + 2 * STEPS * PLACES), np.zeros(GATES * CONTEXTS + 2 * STEPS * PLACES)
    learned = own.mapInArrow(_learner(sent), "cell int, total double, turns double")
    for row in learned.groupBy("cell").agg(F.sum("total").alias("total"), F.sum("turns").alias("turns")).collect():  # as many rows as cells
        flat[row["cell"]], many[row["cell"]] = row["total"], row["turns"]
    cut = GATES * CONTEXTS
    weights = np.where(many[:cut] > 0, flat[:cut] / np.maximum(many[:cut], 1), START).reshape(GATES, CONTEXTS)
    return TextModel(tree, model.states, weights, flat[cut:].reshape(2, STEPS, PLACES))
