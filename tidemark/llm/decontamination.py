"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, one scan of each text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, numbered, rejected, slices, stored, tidy

WINDOW_WORDS = 10
#: Bytes of windows and item ids that one automaton holds. A larger benchmark is dealt over several automata, by window, and
#: the texts pass them one after another, so neither the driver nor a task ever holds more than this.
AUTOMATON_BYTES = 8 << 20

# Words are runs of 0-9, a-z (after lower-casing A-Z) and everything beyond ASCII; the rest of ASCII separates.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)

STATE = "n_words bigint, hits array<int>, items array<bigint>"
RESULT = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "spans array<struct<start:int,end:int>>"
)
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def windows(bench: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows of the items: ``pattern`` (its words, a space around each) and the ids of the items that have it."""
    own = columns_of(bench, item_id=item_id, text=text).filter("item_id is not null")
    plain = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(plain, SEPARATORS), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW_WORDS + 1, F.lit(1)))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("words", i, WINDOW_WORDS), " "))
    listed = own.select(F.col("item_id").cast("bigint").alias("item_id"), words.alias("words")).filter(F.size("words") > 0)
    flat = listed.select("item_id", F.explode(F.array_distinct(cut)).alias("window"))
    return flat.groupBy(F.concat(F.lit(" "), "window", F.lit(" ")).alias("pattern")).agg(
        F.sort_array(F.collect_set("item_id")).alias("items")
    )


def automata(bench: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[str, list[int]]]]:
    """The windows in lots of about AUTOMATON_BYTES, one lot at a time in the driver."""
    found = stored(windows(bench, item_id, text), "windows")
    size = found.agg(F.sum(F.octet_length("pattern") + 8 * F.size("items"))).first()[0] or 0
    lots = max(1, -(-size // AUTOMATON_BYTES))
    for lot in range(lots):
        rows = found.filter(F.pmod(F.xxhash64("pattern"), F.lit(lots)) == lot) if lots > 1 else found
        yield [(r["pattern"], list(r["items"])) for r in rows.collect()]


def _automaton(patterns: list[tuple[str, list[int]]]) -> ahocorasick.Automaton | None:
    made = ahocorasick.Automaton()
    for pattern, items in patterns:
        made.add_word(pattern, (len(pattern), items))
    if not patterns:
        return None
    made.make_automaton()
    return made


def find(made: ahocorasick.Automaton | None, text: str) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Words of the text, the runs of hit words as (first, one past the last), and the items found."""
    words = text.encode("utf-8", "replace").translate(FOLD).split()
    if made is None or not words:
        return len(words), [], set()
    line = f" {(b' '.join(words)).decode()} "
    found = [(end + 1 - length, end, items) for end, (length, items) in made.iter(line)]
    if not found:
        return len(words), [], set()
    gaps = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 0x20)
    runs: list[tuple[int, int]] = []
    for a, b in sorted(zip(np.searchsorted(gaps, [f[0] for f in found]).tolist(), np.searchsorted(gaps, [f[1] for f in found]).tolist())):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return len(words), runs, set().union(*(f[2] for f in found))


def _scanner(patterns: list[tuple[str, list[int]]], first: bool, last: bool) -> Callable:
    """A pass over the texts with one automaton; between passes the hit words and items so far travel with the text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _automaton(patterns)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            rows = []
            for k, text in enumerate(texts):
                n, runs, items = find(made, text or "")
                if not first:
                    flat = batch.column("hits")[k].as_py()
                    runs, items = _merged(runs + list(zip(flat[::2], flat[1::2]))), items | set(batch.column("items")[k].as_py())
                rows.append((n, runs, sorted(items, key=str)))
            yield _finished(batch, texts, rows) if last else pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[x for run in r[1] for x in run] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                ],
                ["doc_id", "text", "n_words", "hits", "items"],
            )

    return scan


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _finished(batch: pa.RecordBatch, texts: list, rows: list) -> pa.RecordBatch:
    spans = []
    for text, (_, runs, _) in zip(texts, rows):
        at = [m.span() for m in WORD.finditer(text)] if runs else []
        spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in runs])
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([sum(b - a for a, b in r[1]) for r in rows], pa.int64()),
            pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(",".join(map(str, r[2])).encode()).hexdigest() for r in rows]),
            pa.array([bool(r[1]) for r in rows]),
            pa.array(spans, SPANS),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
    )


def contamination(
    docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per document: words, words inside a test window, items found, and the hit spans in code points of the original text.

    A window is WINDOW_WORDS consecutive words of an item; a shorter item is one window. Null and empty texts have no words
    and no hits; a null or empty item has no window; an empty benchmark marks nothing. Rows are taken one by one, so repeated
    rows and ids give repeated results. Items that share a window are all reported.
    """
    own = columns_of(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    lots = automata(bench, item_id, item_text)
    lot, first = next(lots), True
    for following in lots:
        own = stored(own.mapInArrow(tidy(_scanner(lot, first, False)), f"doc_id bigint, text string, {STATE}"), "scanned")
        lot, first = following, False
    return own.mapInArrow(tidy(_scanner(lot, first, True)), RESULT)


def _cleaner(patterns: list[tuple[str, list[int]]]) -> Callable:
    def judge() -> Callable[[list], list[bool]]:
        made = _automaton(patterns)
        return lambda texts: [not find(made, t or "")[1] for t in texts]

    return judge


def keep_clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents without any test window, with all their columns.

    Each row is judged by its own text and dropped by a number of its own, so repeated rows, repeated ids and null ids need
    no care; a null or empty text has no windows and stays. A benchmark of several automata drops what any of them finds.
    """
    own, row = numbered(docs)
    for lot in automata(bench, "item_id", "text"):
        own = own.join(rejected(own, row, "text", _cleaner(lot)), row, "left_anti")
    return own.drop(row)
