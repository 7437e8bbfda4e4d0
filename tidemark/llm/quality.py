"""Text quality by gradient-boosted trees over document statistics, flattened into arrays."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, crc_mod, slices, stored

#: Labelled rows that the trees are fitted on at most, chosen by a hash of the id. The driver holds so many rows of statistics.
TRAIN_ROWS = 40_000
TREES = 40
DEPTH = 4
BINS = 64
RATE = 0.2
RIDGE = 1.0
LEAST_ROWS = 5
FOLDS, HELD_OUT = 3, 1

# Byte classes of the statistics: lower, upper, digit, space, line feed, beyond ASCII, sentence ends, commas, other marks.
CLASSES = np.full(256, 8, np.int64)
CLASSES[list(range(0x61, 0x7B))] = 0
CLASSES[list(range(0x41, 0x5B))] = 1
CLASSES[list(range(0x30, 0x3A))] = 2
CLASSES[[0x20, 0x09, 0x0D]] = 3
CLASSES[0x0A] = 4
CLASSES[0x80:] = 5
CLASSES[list(b".!?")] = 6
CLASSES[list(b",;:'\"-()")] = 7
N_CLASSES = 9

NAMES = [
    "log_bytes", "lower", "upper", "digit", "space", "line", "beyond", "ends", "commas", "marks",
    "log_words", "word_bytes", "distinct_words", "top_word", "repeated_next", "short_words", "word_end_marks", "all_upper",
    "log_lines", "distinct_lines", "line_bytes", "words_per_end", "compressed", "byte_entropy",
]
ENDS = tuple("#$%&*|!~^=+_<>@")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of NAMES; an empty text has zeros."""
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = np.bincount(CLASSES, weights=counts, minlength=N_CLASSES) / n
    p = counts[counts > 0] / n
    words = text.split()
    m = max(len(words), 1)
    often = Counter(words)
    same = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    return [
        np.log1p(n), *share.tolist(),
        np.log1p(len(words)), sum(map(len, words)) / m, len(often) / m, max(often.values(), default=0) / m, same / m,
        sum(len(w) <= 2 for w in often) / max(len(often), 1), sum(c for w, c in often.items() if w.endswith(ENDS)) / m,
        sum(c for w, c in often.items() if w.isupper()) / m,
        np.log1p(len(lines)), len(set(lines)) / len(lines), n / len(lines), m / (share[6] * n + 1),
        len(zlib.compress(raw, 1)) / n, float(-(p * np.log2(p)).sum()),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        rows = [statistics(t) for t in batch.column("text").to_pylist()]
        flat = pa.array(np.asarray(rows, np.float64).ravel())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("fold"), pa.FixedSizeListArray.from_arrays(flat, len(NAMES)).cast(pa.list_(pa.float64()))],
            ["doc_id", "fold", "stats"],
        )


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fold and the statistics of every document."""
    own = columns_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return own.select("doc_id", crc_mod("doc_id", FOLDS).alias("fold"), "text").mapInArrow(
        _measure, "doc_id bigint, fold bigint, stats array<double>"
    )


@dataclass
class Trees:
    """All trees in shared arrays: node k tests ``feature[k]`` against ``cut[k]`` and goes to ``child[k]`` or the next; a leaf
    is its own child, so that every row takes the same number of steps."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                leaf = self.feature[at] < 0
                right = x[rows, np.maximum(self.feature[at], 0)] > self.cut[at]
                at = np.where(leaf, at, self.child[at] + right)
            total += self.value[at]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees with logistic loss. Values are binned once by quantiles; a node's gains come from histograms of gradients."""
    n, d = x.shape
    if not n:
        empty = np.zeros(0, np.int64)
        return Trees(empty, empty, np.zeros(0), empty, np.zeros(0), 0.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(n, start)
    roots, feature, cut, child, value = [], [], [], [], []

    def node() -> int:
        feature.append(-1), cut.append(0.0), child.append(0), value.append(0.0)
        return len(feature) - 1

    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        roots.append(node())
        level = [(roots[-1], np.arange(n))]
        for depth in range(DEPTH + 1):
            following = []
            for at, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                value[at] = RATE * gs / (hs + RIDGE)
                best = (1e-6, -1, 0)
                if depth < DEPTH and len(rows) >= 2 * LEAST_ROWS:
                    code = (binned[rows] + np.arange(d) * BINS).ravel()
                    hist = lambda w: np.bincount(code, weights=w, minlength=d * BINS).reshape(d, BINS).cumsum(axis=1)  # noqa: E731, B023
                    gl, hl, cl = hist(np.repeat(g[rows], d)), hist(np.repeat(h[rows], d)), hist(np.ones(len(code)))
                    gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
                    gain[(cl < LEAST_ROWS) | (cl > len(rows) - LEAST_ROWS)] = -1
                    j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                    if gain[j, b] > best[0] and b < len(edges[j]):
                        best = (gain[j, b], int(j), int(b))
                if best[1] < 0:
                    margin[rows] += value[at]
                    continue
                feature[at], cut[at] = best[1], float(edges[best[1]][best[2]])
                left = binned[rows, best[1]] <= best[2]
                child[at] = node()
                node()
                following += [(child[at], rows[left]), (child[at] + 1, rows[~left])]
            level = following
    as_int = lambda a: np.asarray(a, np.int64)
    return Trees(as_int(roots), as_int(feature), np.asarray(cut), as_int(child), np.asarray(value), start)


def _scorer(trees: Trees) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("stats").flatten()).reshape(batch.num_rows, len(NAMES))
            s = trees.score(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.asarray(batch.column("fold")) == HELD_OUT), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return score


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Per document: whether it is held out, the score that its quality is 1, and the prediction at a half.

    Trees learn from labelled rows of the other folds, TRAIN_ROWS at most; a document with several labels has their majority,
    null labels count as none. Without any label every score is a half. A null or empty text has zeros for statistics and is
    scored like any other. Repeated rows are scored one by one. A null id belongs to fold 0 and has no label.
    """
    stats = stored(measured(docs, doc_id, text), "stats")
    known = columns_of(labels, doc_id=doc_id, label=label).filter("doc_id is not null and label is not null")
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    chosen = stats.filter(F.col("fold") != HELD_OUT).join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    sample = chosen.select("stats", "label").toArrow()
    x = np.asarray(sample.column("stats").combine_chunks().flatten()).reshape(-1, len(NAMES)) if sample.num_rows else np.zeros((0, len(NAMES)))
    trees = fit(x, np.asarray(sample.column("label"), float))
    return stats.mapInArrow(_scorer(trees), "doc_id bigint, held_out boolean, score double, predicted int")
