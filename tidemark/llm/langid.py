"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word forwards and backwards and labels every byte; the labels of a text are pooled over all its words.
States begin anew at each word, so a word has the same labels wherever it stands, and a task reads a word again only when it was
put out of a memory of fixed size.
The network is trained in the driver by backpropagation through time, in numpy, on a bounded sample of labelled words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, crc_mod, numbered, rejected, slices, tidy

FOLDS, HELD_OUT = 4, 2
#: Labelled documents that training words are drawn from at most, by a hash of the id, and words drawn from each.
TRAIN_DOCS = 3000
DOC_WORDS = 24
UNITS = 16
#: Bytes that are read at a stretch; a longer word is read in such pieces.
STRETCH = 16
EPOCHS = 3
BATCH = 512
RATE = 0.01
#: Words whose pooled labels a task keeps, about 150 bytes each; beyond it, it starts anew.
CACHE_WORDS = 200_000
UNKNOWN = "und"
#: Documents below this score are rejected by ``accepted``.
LEAST_SCORE = 0.5

LETTER = re.compile(r"[^\W\d_]")
# A-Z lower-cased; what else is no letter in ASCII parts words.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Network:
    """Input weights by byte, recurrent weights and biases of both directions (update, reset, candidate), and the output layer."""

    langs: list[str]
    inputs: np.ndarray  # 2, 256, 3 units
    gates: np.ndarray  # 2, units, 2 units
    candidate: np.ndarray  # 2, units, units
    out: np.ndarray  # 2 units, langs
    bias: np.ndarray

    @classmethod
    def new(cls, langs: list[str], seed: int = 7) -> Network:
        rng, n = np.random.default_rng(seed), UNITS
        scale = lambda *shape: (rng.normal(size=shape) / np.sqrt(n)).astype(np.float32)
        return cls(langs, scale(2, 256, 3 * n), scale(2, n, 2 * n), scale(2, n, n), scale(2 * n, len(langs)), np.zeros(len(langs), np.float32))

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.candidate, self.out, self.bias]

    def run(self, side: int, codes: np.ndarray, live: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte of the rows of ``codes``, in reading order; rows that are not live keep their state."""
        n = UNITS
        h = np.zeros((len(codes), n), np.float32)
        states = np.zeros((codes.shape[1], len(codes), n), np.float32)
        for t in range(codes.shape[1]):
            x = self.inputs[side][codes[:, t]]
            zr = _sigmoid(x[:, : 2 * n] + h @ self.gates[side])
            z, r = zr[:, :n], zr[:, n:]
            c = np.tanh(x[:, 2 * n :] + (r * h) @ self.candidate[side])
            new = np.where(live[:, t, None], h + z * (c - h), h)
            if keep is not None:
                keep.append((h, z, r, c))
            h = states[t] = new
        return states

    def labels(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probabilities of each language at every byte: (steps, rows, langs); places beyond a row's size mean nothing."""
        live = np.arange(codes.shape[1])[None] < sizes[:, None]
        forth = self.run(0, codes, live)
        turned, at = _turned(codes, sizes)
        back = self.run(1, turned, live)
        back = back[at.T, np.arange(len(codes))[None]]
        logits = np.concatenate([forth, back], axis=2) @ self.out + self.bias
        return np.log(_softmax(logits) + 1e-9)

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Mean log probabilities over the bytes of each word."""
        pieces = [(k, w[a : a + STRETCH]) for k, w in enumerate(words) for a in range(0, len(w), STRETCH)]
        pieces.sort(key=lambda p: len(p[1]))
        total = np.zeros((len(words), len(self.langs)))
        for start in range(0, len(pieces), 4096):
            part = pieces[start : start + 4096]
            codes, sizes = _codes([p[1] for p in part])
            logs = self.labels(codes, sizes)
            logs[np.arange(codes.shape[1])[:, None] >= sizes[None]] = 0
            np.add.at(total, [p[0] for p in part], logs.sum(axis=0))
        return total / np.maximum([len(w) for w in words], 1)[:, None] if words else total


def _codes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in pieces])
    width = int(sizes.max())
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width), sizes


def _turned(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows read backwards, and for each place the step at which that reading meets it."""
    at = np.maximum(sizes[:, None] - 1 - np.arange(codes.shape[1])[None], 0)
    return np.take_along_axis(codes, at, axis=1), at


def gradients(net: Network, codes: np.ndarray, sizes: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss over all labelled bytes, and its gradients by backpropagation through time."""
    n, rows, steps = UNITS, len(codes), codes.shape[1]
    live = np.arange(steps)[None] < sizes[:, None]
    turned, at = _turned(codes, sizes)
    keeps: list[list] = [[], []]
    forth, back_read = net.run(0, codes, live, keeps[0]), net.run(1, turned, live, keeps[1])
    index = np.arange(rows)[None]
    both = np.concatenate([forth, back_read[at.T, index]], axis=2)
    p = _softmax(both @ net.out + net.bias)
    share = (weight / (sizes * weight.sum()))[None] * live.T
    loss = float(-(np.log(p[:, np.arange(rows), lang] + 1e-9) * share).sum())
    d = p.copy()
    d[:, np.arange(rows), lang] -= 1
    d *= share[:, :, None]
    d_out = np.tensordot(both, d, axes=([0, 1], [0, 1]))
    d_both = d @ net.out.T
    d_back = np.zeros_like(back_read)
    np.add.at(d_back, (at.T, np.broadcast_to(index, at.T.shape)), d_both[:, :, n:])
    grads = [np.zeros_like(w) for w in net.weights]
    grads[3], grads[4] = d_out.astype(np.float32), d.sum(axis=(0, 1)).astype(np.float32)
    for side, (read, d_states) in enumerate(((codes, d_both[:, :, :n]), (turned, d_back))):
        dh = np.zeros((rows, n), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, c = keeps[side][t]
            dh = dh + d_states[t]
            own = dh * live[:, t, None]
            dz, dc = own * (c - h) * z * (1 - z), own * z * (1 - c * c)
            drh = dc @ net.candidate[side].T
            dr = drh * h * r * (1 - r)
            dzr = np.concatenate([dz, dr], axis=1)
            grads[1][side] += h.T @ dzr
            grads[2][side] += (r * h).T @ dc
            np.add.at(grads[0][side], read[:, t], np.concatenate([dzr, dc], axis=1))
            dh = np.where(live[:, t, None], own * (1 - z) + drh * r + dzr @ net.gates[side].T, dh)
    return loss, grads


def train(words: list[bytes], langs: list[str]) -> Network:
    """Adam over words in a fixed random order; languages weigh alike, however many words they have."""
    names = sorted(set(langs))
    net = Network.new(names)
    pieces = [(w[:STRETCH], names.index(x)) for w, x in zip(words, langs) if w]
    if not pieces:
        return net
    lang = np.array([p[1] for p in pieces])
    weight = 1 / np.bincount(lang, minlength=len(names))[lang]
    rng = np.random.default_rng(11)
    first, second, count = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(pieces))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            codes, sizes = _codes([pieces[i][0] for i in rows])
            _, grads = gradients(net, codes, sizes, lang[rows], weight[rows])
            count += 1
            for w, g, a, b in zip(net.weights, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9**count)) / (np.sqrt(b / (1 - 0.999**count)) + 1e-8)
    return net


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        words, langs = [], []
        for text, lang, seed in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), batch.column("seed").to_pylist()):
            own = words_of(text)
            picked = np.random.default_rng(abs(seed)).choice(len(own), min(DOC_WORDS, len(own)), replace=False) if own else []
            words += [own[k] for k in picked]
            langs += [lang] * len(picked)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(langs, pa.string())], ["word", "lang"])


class Reader:
    """Predictions of one task. Words read before are kept in two arrays of fixed size, which go with the task."""

    def __init__(self, net: Network):
        self.net = net
        self.place: dict[bytes, int] = {}
        self.logs = np.zeros((CACHE_WORDS, len(net.langs)), np.float32)

    def read(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        split = [words_of(t) for t in texts] if self.net.langs else []
        unknown = list(set().union(*split) - self.place.keys())
        if len(self.place) + len(unknown) > len(self.logs):
            self.place = {}
            unknown = list(set().union(*split))
            # One text alone may have more words than are kept.
            self.logs = np.zeros((max(CACHE_WORDS, len(unknown)), len(self.net.langs)), np.float32)
        if unknown:
            start = len(self.place)
            self.logs[start : start + len(unknown)] = self.net.pooled(unknown)
            self.place.update(zip(unknown, range(start, start + len(unknown))))
        preds, scores = [], []
        for k, text in enumerate(texts):
            if text is None or not LETTER.search(text) or not self.net.langs:
                preds.append(UNKNOWN), scores.append(0.0)
                continue
            p = _softmax(self.logs[list(map(self.place.__getitem__, split[k]))].sum(axis=0, dtype=np.float64))
            preds.append(self.net.langs[int(np.argmax(p))]), scores.append(float(p.max()))
        return preds, scores


def _identifier(sent) -> Callable:
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in slices(batches, "text", 2 << 20):
            preds, scores = reader.read(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return identify


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """A network from labelled documents of the other folds: TRAIN_DOCS documents, DOC_WORDS words of each, at most."""
    own = columns_of(docs, doc_id=doc_id, text=text, lang=lang)
    known = own.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD_OUT))
    ids = known.select(F.xxhash64("doc_id").alias("seed"), "doc_id").orderBy("seed", "doc_id").limit(TRAIN_DOCS).agg(F.max("seed")).first()[0]
    chosen = known.select("text", "lang", F.xxhash64("doc_id").alias("seed")).filter(F.col("seed") <= (ids if ids is not None else 0))
    sample = chosen.mapInArrow(tidy(_sampler), "word binary, lang string").limit(TRAIN_DOCS * DOC_WORDS).toArrow()
    table = sorted(zip(sample.column("word").to_pylist(), sample.column("lang").to_pylist()))
    return train([w for w, _ in table], [x for _, x in table])


def identified(docs: DataFrame, net: Network | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: whether it is held out, the predicted language and its pooled probability.

    A text that is null or has no letter is ``und`` with score 0; so is every text when no labelled document is there.
    Repeated rows are labelled one by one. A null id is in fold 0. Ties go to the language that comes first by name.
    """
    net = fit(docs, doc_id, text, lang) if net is None else net
    own = columns_of(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text"
    )
    sent = own.sparkSession.sparkContext.broadcast(net)
    return own.mapInArrow(tidy(_identifier(sent)), "doc_id bigint, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is known with LEAST_SCORE or more, with all their columns.

    Each row is judged by its own text and dropped by a number of its own, so repeated rows, repeated ids and null ids need
    no care. Null texts and those without a letter go.
    """
    own, row = numbered(docs)
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def judge() -> Callable[[list], list[bool]]:
        reader = Reader(sent.value)
        return lambda texts: [p != UNKNOWN and s >= LEAST_SCORE for p, s in zip(*reader.read(texts))]

    return own.join(rejected(own, row, "text", judge), row, "left_anti").drop(row)
