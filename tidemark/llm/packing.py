"""Packing documents into sequences: vector best-fit over residual tokens, document counts and attention cost."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, slices, stored, tidy

SEQUENCE_TOKENS = 4096
END_ID = 1
#: Pieces that are packed together. More pieces fill sequences no better by more than one sequence a lot.
LOT_PIECES = 16384
#: Parts of words whose ids a task keeps, in bytes; beyond it, those not met of late are dropped. Between tasks a worker keeps half.
PART_BYTES = 60 << 20
#: Texts that are encoded together, in bytes.
TEXT_BYTES = 8 << 20
#: Both where a task is to take little memory (``lean``), for about a third more time in encoding; nothing is kept between tasks.
LEAN_PART_BYTES, LEAN_TEXT_BYTES = 16 << 20, 2 << 20

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, spread bigint"
# A null among integers would turn them into floats in pandas; the flag keeps null ids apart.
PACKED = "doc_id bigint, unnamed boolean, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


_TOKENIZERS: dict = {}


def tokenizer_of(path: str) -> tuple:
    """One tokenizer per worker process, and its reader of parts; their size is that of the file."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation(), made.no_padding()
        _TOKENIZERS[path] = made, Parts(made)
    return _TOKENIZERS[path]


class Parts:
    """Ids of many parts of words at once. A part is one word to the tokenizer, so it ends with the only piece that closes a
    word: parts are encoded as lines of JOINED parts between spaces, and the ids are cut behind those pieces."""

    JOINED = 256

    def __init__(self, made):
        self.made = made
        vocabulary = made.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def ids(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, four bytes each."""
        groups = [parts[k : k + self.JOINED] for k in range(0, len(parts), self.JOINED)]
        out: list[bytes] = []
        for k in range(0, len(groups), 64):
            some = groups[k : k + 64]
            for group, made in zip(some, self.made.encode_batch_fast([" ".join(g) for g in some], add_special_tokens=False)):
                ids = np.asarray(made.ids, "<u4")
                ends = ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
                if len(ends) != len(group):
                    raise ValueError("a part is more than one word to the tokenizer")
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0] + ends[:-1], ends)]
        return out


class Encoder:
    """Token ids of whole texts. The tokenizer never joins across white space, so the ids of a text are those of its words
    one after another, and the distinct words of a lot of texts are encoded once. Nor does it join letters, digits and marks:
    a word of plain characters is made of parts that are looked up, whatever its case and the marks around it. The parts seen
    are kept up to PART_BYTES: in two halves, of which the older is dropped when the younger is full, so that parts that keep
    coming stay."""

    # Characters that normalisation leaves alone but for their case; the parts that the tokenizer cuts such
    # words into; the beginning of a special token.
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
    SPECIAL = "<|"

    def __init__(self, path: str, part_bytes: int = PART_BYTES):
        self.made, self.closed = tokenizer_of(path)
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held, self.limit = 0, part_bytes // 2

    def _raw(self, texts: list[str]) -> Iterator[bytes]:
        for k in range(0, len(texts), 4096):
            for x in self.made.encode_batch_fast(texts[k : k + 4096], add_special_tokens=False):
                yield np.asarray(x.ids, "<u4").tobytes()

    def rest(self) -> None:
        """Drop what a worker need not hold until its next task."""
        self.older = {}
        if self.held > self.limit:
            self.parts, self.held = {}, 0

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, four bytes each."""
        # A word that is kept as a part is that part alone.
        cut, plain, known = self.PART.findall, self.PLAIN.fullmatch, self.parts
        split = [(w,) if w in known else cut(w.lower()) if plain(w) and self.SPECIAL not in w else None for w in words]
        other = self._raw([w for w, p in zip(words, split) if p is None])
        needed = set(chain.from_iterable(filter(None, split)))
        if self.held > self.limit:
            self.older, self.parts, self.held = self.parts, {}, 0
        absent = needed - self.parts.keys()
        again = absent & self.older.keys()
        new = list(absent - again)
        self.parts.update((part, self.older[part]) for part in again)
        self.parts.update(zip(new, self.closed.ids(new)))
        # A part costs about 150 bytes besides its letters and ids.
        self.held += sum(map(len, absent)) + 170 * len(absent)
        get = self.parts.__getitem__
        return [next(other) if p is None else get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for p in split]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        places = np.asarray(coded.indices)
        words = coded.dictionary.to_pylist()
        raw = [x for k in range(0, len(words), 1 << 16) for x in self._words(words[k : k + (1 << 16)])]
        ends = np.cumsum(np.asarray(lists.value_lengths(), np.int64)).tolist()
        for a, b in zip([0] + ends[:-1], ends):
            yield np.frombuffer(b"".join(map(raw.__getitem__, places[a:b].tolist())), "<u4")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process, PART_BYTES and a tokenizer in size."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _cutter(path: str, width: int, end_id: int, lean: bool = False) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Encoder(path, LEAN_PART_BYTES) if lean else encoder(path), 0
        encode = own.encode
        for batch in slices(batches, "text", LEAN_TEXT_BYTES if lean else TEXT_BYTES):
            out = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), width)):
                    part = ids[start : start + width]
                    out.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), seen))
                seen += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int32() if k == 1 else pa.int64()) for k in range(6)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "spread"],
            )
        if lean:
            _TOKENIZERS.pop(path, None)
        else:
            own.rest()

    return cut


def best_fit(lengths: np.ndarray, tokens: int, documents: int, cost: int, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, longest pieces first.

    A sequence has three capacities: ``tokens``, ``documents`` pieces, and ``cost``, the sum of squared lengths. A piece goes
    to an open sequence that has room in all three: by ``norm``, the one whose weighted residual after it is least; by
    ``dot``, the one with the largest weighted product of what the piece takes and what is left. Otherwise it opens one.
    """
    n = len(lengths)
    # int32 places hold what one lot opens; a closed sequence has no room for the shortest piece and is not looked at again.
    free = np.zeros((3, max(n, 1)))
    ids, used = np.zeros(max(n, 1), np.int64), np.zeros(max(n, 1), np.int64)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    limits = np.array([tokens, documents, cost], float)
    weight = 1.0 / limits**2
    opened = active = 0
    least = float(lengths.min()) if n else 0
    for k in np.argsort(-lengths, kind="stable"):
        length = float(lengths[k])
        need = np.array([length, 1.0, length * length])
        room = free[:, :active]
        fits = (room[0] >= need[0]) & (room[1] >= need[1]) & (room[2] >= need[2])
        at = np.flatnonzero(fits)
        if len(at):
            some = room[:, at]
            if rule == "dot":
                at = at[np.argmax(weight @ (some * need[:, None]))]
            else:
                at = at[np.argmin(weight @ (some - need[:, None]) ** 2)]
        else:
            at = active
            free[:, at], ids[at], used[at] = limits, opened, 0
            opened, active = opened + 1, active + 1
        sequence[k], offset[k] = ids[at], used[at]
        free[:, at] -= need
        used[at] += lengths[k]
        if free[0, at] < least or free[1, at] < 1 or free[2, at] < least * least:
            active -= 1  # the last open one takes its place
            free[:, at], ids[at], used[at] = free[:, active], ids[active], used[active]
    return sequence, offset


def _packer(tokens: int, documents: int, cost: int, rule: str) -> Callable:
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "spread"], ascending=[False, True, True, True])
        sequence, offset = best_fit(rows["length"].to_numpy(), tokens, documents, cost, rule)
        rows["sequence_id"], rows["offset"] = (rows["lot"].to_numpy() << 32) | sequence, offset
        return rows[["doc_id", "unnamed", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return pack


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    tokens: int = SEQUENCE_TOKENS,
    documents: int | None = None,
    cost: int | None = None,
    end_id: int = END_ID,
    rule: str = "norm",
    lean: bool = False,
) -> DataFrame:
    """One row per piece of a document: where its tokens begin, how many they are, and its sequence and offset there.

    A document is its ids and ``end_id``; one longer than ``tokens`` is cut into pieces of that size. ``documents`` and
    ``cost`` bound the pieces of a sequence and its sum of squared lengths; by default neither binds. ``cost`` is at least
    ``tokens`` squared, since a full piece must fit. Pieces are dealt into lots by a hash of document and place, so lots are
    alike in size and mixture; each lot is packed by itself and ends with at most a few sequences that are not full.

    A null or empty text is the end id alone. Repeated rows are packed as often as they occur. No rows give no rows. ``lean``
    changes what a task holds, not what comes out.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    documents = tokens if documents is None else documents
    cost = max(tokens * tokens, cost or 0)
    own = columns_of(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = stored(own.mapInArrow(tidy(_cutter(tokenizer, tokens, end_id, lean)), PIECES), "pieces")
    lots = max(1, -(-pieces.count() // LOT_PIECES))
    lot = F.pmod(F.xxhash64("doc_id", "piece", "spread"), F.lit(lots)).cast("bigint")
    named = pieces.withColumns({"lot": lot, "unnamed": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})
    packed = named.groupBy("lot").applyInPandas(_packer(tokens, documents, cost, rule), PACKED)
    return packed.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id"))).drop("unnamed")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """The sequences themselves: sequence_id and token ids, for documents with distinct ids."""
    own = columns_of(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in slices(batches, "text", TEXT_BYTES):
            docs_, piece, parts = [], [], []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype(np.int64)
                for k, start in enumerate(range(0, len(ids), tokens)):
                    docs_.append(doc), piece.append(k), parts.append(ids[start : start + tokens])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(piece, pa.int32()), pa.array(parts, pa.list_(pa.int64()))], ["doc_id", "piece", "ids"]
            )

    ids = own.mapInArrow(tidy(cut), "doc_id bigint, piece int, ids array<bigint>")
    placed = packed.join(ids, ["doc_id", "piece"])
    # A sequence holds at most `tokens` ids, so collecting one is bounded.
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
