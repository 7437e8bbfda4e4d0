"""Exact n-gram Jaccard join that uses relations between sets.

Equal sets are one class. Shingles have one global order, rare ones first; two classes can only link if they share a shingle
among the first fifth of each (the prefix). Two relations cut the work:

* Index level. The list of a shingle is ordered by set size and then by position in the set. Walking down a list, a probe
  stops at the first block of sizes that can no longer reach it, and within reach skips positions that leave too few shingles.
* Answer level. Classes whose prefix reaches into common shingles are variants of each other, and form a family. All members
  are compared with one pivot. Those that link with it have the pivot's answers for their component, so no pair among
  them is looked at; only the rest is compared, block by block, with each other and with the former.

Candidate pairs of the lists are sieved by sketches before their sets are brought together: a sketch bounds the overlap from
above, so no link is lost. Links that a family's block finds are thinned to a spanning forest, since only reachability counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, numbered, slices, stored, text_blob, tidy
from .components import components

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles that are counted together before their counts are shuffled; bounds a task's memory.
COUNT_BLOCK = 4_000_000
#: A shingle is common when this many distinct sets of the counted blocks repeat it. It only orders shingles.
COMMON_SETS = 4
#: Common shingles that tasks are sent at most (16 bytes each). Others keep their place among the rare ones.
COMMON_LIMIT = 1 << 18
#: Longer lists of rare shingles are handled as families.
LIST_LIMIT = 128
#: Shingles in one block of a family.
BLOCK_SHINGLES = 1 << 18
#: Bits of the filter that tells which documents' sets are needed; a full filter only lets more through.
FILTER_BITS = 1 << 23

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACES = np.random.Generator(np.random.PCG64(20260101)).integers(0, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_STEPS = np.random.Generator(np.random.PCG64(20260102)).integers(0, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _places(longest: int) -> np.ndarray:
    global _PLACES
    if longest > len(_PLACES):
        rng = np.random.Generator(np.random.PCG64(20260101))
        _PLACES = rng.integers(0, 1 << 63, 2 * longest, dtype=np.uint64) | np.uint64(1)
    return _PLACES


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, and the row of each. Words are runs free of ASCII white space, A-Z lower-cased."""
    blob, begins = text_blob(texts)
    raw = np.frombuffer(blob.translate(_LOWER), np.uint8)
    inside = (raw != 0x20) & ((raw < 9) | (raw > 13))
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.flatnonzero(edge == -1) - starts  # every text ends with a line feed, so every word ends
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    terms = (raw[inside].astype(np.uint64) + np.uint64(1)) * _places(int(lengths.max()))[place]
    return _mixed(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64)), np.searchsorted(begins, starts, side="right") - 1


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text; a text of fewer words is one shingle, one without words has none."""
    with np.errstate(over="ignore"):
        words, rows = word_hashes(texts)
        bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
        full = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for k in range(WORDS):
            full += words[k : k + len(full)] * _STEPS[k]
        full = _mixed(full).view(np.int64)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(full[a : b - WORDS + 1])
            elif b > a:
                yield _mixed(np.array([(words[a:b] * _STEPS[: b - a]).sum() + np.uint64(b - a)], np.uint64)).view(np.int64)
            else:
                yield full[:0]


def class_of(s: np.ndarray) -> int:
    """The id of a set: 63 bits of a digest of its members."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little") >> 1


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (doc_id, n, cls) and, per block, of shingles that several distinct sets of it have (shingle, sets)."""
    kept, seen, held = [], set(), 0

    def counted() -> pa.RecordBatch:
        shingles, sets = np.unique(np.concatenate(kept or [np.zeros(0, np.int64)]), return_counts=True)
        shingles, sets = shingles[sets > 1], sets[sets > 1]
        none = pa.nulls(len(shingles), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(shingles), pa.array(sets)], ["doc_id", "n", "cls", "shingle", "sets"])

    for batch in slices(batches, "text", 1 << 20):
        n, cls = [], []
        for s in shingle_sets(batch.column("text")):
            n.append(len(s))
            cls.append(class_of(s) if len(s) else None)
            if len(s) and cls[-1] not in seen:
                seen.add(cls[-1])
                kept.append(s)
                held += len(s)
        none = pa.nulls(batch.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), none, none], ["doc_id", "n", "cls", "shingle", "sets"]
        )
        if held > COUNT_BLOCK:
            yield counted()
            kept, seen, held = [], set(), 0
    yield counted()


def prefix_size(n: int) -> int:
    """Shingles of a set of n of which a linked set must have one: all but the least overlap, and one more."""
    return n - -(-PERCENT * n // 100) + 1


def _indexer(common: np.ndarray, rank: np.ndarray) -> Callable:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Prefix entries (key shingle, cls, meta = size and position), and one row for each class whose prefix reaches common ones."""
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            if len(seen) > 1_000_000:
                seen = set()
            keys, classes, metas, reach = [], [], [], []
            for s in shingle_sets(batch.column("text")):
                if not len(s) or (cls := class_of(s)) in seen:
                    continue
                seen.add(cls)
                at = np.minimum(np.searchsorted(common, s), max(len(common) - 1, 0))
                often = common[at] == s if len(common) else np.zeros(len(s), bool)
                rare = s[~often]
                size = prefix_size(len(s))
                own = rare[:size]
                keys.append(own)
                classes.append(np.full(len(own), cls))
                metas.append((len(s) << 32) + np.arange(len(own)))
                if len(own) < size:
                    lead = np.sort(rank[at[often]])[: size - len(own)]
                    reach.append((cls, (len(s) << 32) + int(often.sum()), lead.astype(">i4").tobytes()))
            n = sum(map(len, keys))
            flat = lambda parts, more: pa.array(np.concatenate([*parts, np.asarray(more, np.int64)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    flat(keys, [r[0] for r in reach]), flat(classes, [r[0] for r in reach]), flat(metas, [r[1] for r in reach]),
                    pa.array([None] * n + [r[2] for r in reach], pa.binary()),
                ],
                ["key", "cls", "meta", "reach"],
            )

    return index


def pairs_of_lists(key: np.ndarray, cls: np.ndarray, size: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of rows that are ordered by key, size and place. Row i meets row i + 1, i + 2, ... of its list until the
    sizes are out of reach; places that leave too few shingles for the overlap are skipped."""
    left, right = [], []
    alive = np.arange(len(key) - 1)
    step = 1
    while len(alive):
        alive = alive[alive + step < len(key)]
        other = alive + step
        near = (key[alive] == key[other]) & (100 * size[alive] >= PERCENT * size[other])
        alive, other = alive[near], other[near]
        least = -(-PERCENT * (size[alive] + size[other]) // (100 + PERCENT))
        rest = np.minimum(size[alive] - place[alive], size[other] - place[other])
        good = (rest >= least) & (cls[alive] != cls[other])
        left.append(cls[alive[good]])
        right.append(cls[other[good]])
        step += 1
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b)


LISTED = "a bigint, b bigint, n bigint, common bigint, reach binary, long_key bigint"


def _lister(limit: int) -> Callable:
    def list_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows ordered by key and meta: candidate pairs of each list, rows of families passed on, members of long lists."""

        def out(a=(), b=(), n=(), common=(), reach=(), long_key=()) -> pa.RecordBatch:
            size = max(len(a), 0)
            column = lambda x, kind: pa.array(x, kind) if len(x) else pa.nulls(size, kind)
            return pa.RecordBatch.from_arrays(
                [column(x, pa.int64()) for x in (a, b, n, common)] + [column(reach, pa.binary()), column(long_key, pa.int64())],
                ["a", "b", "n", "common", "reach", "long_key"],
            )

        held = [np.zeros(0, np.int64)] * 3
        open_key = None  # of a list that has become long

        def lists(key, cls, meta):
            nonlocal open_key
            if not len(key):
                return
            first = np.ones(len(key), bool)  # copies of a set in other tasks give equal rows, side by side
            first[1:] = (key[1:] != key[:-1]) | (meta[1:] != meta[:-1]) | (cls[1:] != cls[:-1])
            key, cls, meta = key[first], cls[first], meta[first]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.append(starts, len(key)))
            big = np.repeat((counts > limit) | ((key[starts] == open_key) if open_key is not None else False), counts)
            several = np.repeat(counts > 1, counts) & ~big
            if big.any():
                yield out(a=cls[big], n=meta[big] >> 32, long_key=key[big])
            k, c, m = key[several], cls[several], meta[several]
            a, b = pairs_of_lists(k, c, m >> 32, m & 0xFFFFFFFF)
            if len(a):
                pairs = np.unique(np.stack([a, b]), axis=1)
                yield out(a=pairs[0], b=pairs[1])

        for batch in batches:
            family = np.asarray(batch.column("reach").is_valid())
            if family.any():
                some = batch.filter(pa.array(family))
                meta = np.asarray(some.column("meta"))
                yield out(a=np.asarray(some.column("cls")), n=meta >> 32, common=meta & 0xFFFFFFFF, reach=some.column("reach"))
            fresh = [np.asarray(batch.column(c))[~family] for c in ("key", "cls", "meta")]
            key, cls, meta = (np.concatenate(x) for x in zip(held, fresh))
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            yield from lists(key[:last], cls[:last], meta[:last])
            held = [key[last:], cls[last:], meta[last:]]
            if len(held[0]) > 4 * limit:  # it is long whatever follows: hand its members on, remember the key
                open_key = int(held[0][0])
                yield from lists(*held)
                held = [np.zeros(0, np.int64)] * 3
        yield from lists(*held)

    return list_pairs


def _wanted_sets(bits: np.ndarray) -> Callable:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = np.asarray(batch.column("spot"))
            batch = batch.filter(pa.array(((bits[spot >> 6] >> (spot & 63)) & 1) == 1))
            for part in slices([batch], "text", 2 << 20):
                made = list(shingle_sets(part.column("text")))
                made = {class_of(s): s for s in made if len(s)}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(made), pa.int64()),
                        pa.array([len(s) for s in made.values()], pa.int64()),
                        pa.array([sketch(s) for s in made.values()], pa.binary()),
                        pa.array([s.tobytes() for s in made.values()], pa.binary()),
                    ],
                    ["cls", "n", "sketch", "members"],
                )

    return sets


def sketch(s: np.ndarray) -> bytes:
    """A bit for each slot that an odd number of the members fall on; about as many slots as members."""
    slots = 1 << max(8, (len(s) - 1).bit_length())
    return np.packbits(np.bincount(s & (slots - 1), minlength=slots) & 1).tobytes()


def apart(x: bytes, y: bytes) -> int:
    """A number that the symmetric difference of two sets is never below: each differing slot has a member of it."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    width = min(len(a), len(b))  # slots are a power of two, so those of the larger fold onto the smaller's
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, width), axis=0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches leave room for a link."""
    for batch in batches:
        n, m = np.asarray(batch.column("n")), np.asarray(batch.column("m"))
        least = -(-PERCENT * (n + m) // (100 + PERCENT))
        far = np.array([apart(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())], np.int64)
        yield batch.filter(pa.array(far <= n + m - 2 * least)).select(["a", "b"])


def _overlap(x: bytes, y: bytes) -> tuple[int, int]:
    """Sizes of the intersection and of the union."""
    a, b = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both, len(a) + len(b) - both


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices([batch], "x", 16 << 20):
            found = [_overlap(x, y) for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist())]
            linked = pa.array([100 * i >= PERCENT * u for i, u in found], pa.bool_())
            yield part.drop_columns(["x", "y"]).append_column("linked", linked)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of n nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def block_links(members: list[bytes], open_: np.ndarray) -> np.ndarray:
    """Label of each set by links that have an open set at one end; overlaps come from products of 0/1 matrices."""
    sizes = np.array([len(m) // 8 for m in members])
    flat = np.frombuffer(b"".join(members), np.int64)
    _, code, often = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(members)), sizes)
    shared = often[code] > 1
    names, code = np.unique(code[shared], return_inverse=True)
    row = row[shared]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    open_rows = np.flatnonzero(open_)
    a, b = [], []
    width = 1024
    cuts = np.searchsorted(code, np.arange(0, len(names) + width, width))
    for begin in range(0, len(open_rows), 512):
        own = open_rows[begin : begin + 512]
        both = np.zeros((len(own), len(members)), np.float32)
        for k in range(len(cuts) - 1):
            every = np.zeros((len(members), width), np.float32)
            every[row[cuts[k] : cuts[k + 1]], code[cuts[k] : cuts[k + 1]] - k * width] = 1
            both += every[own] @ every.T
        union = sizes[own][:, None] + sizes[None, :] - both
        i, j = np.nonzero(100 * both.astype(np.int64) >= PERCENT * union.astype(np.int64))
        a.append(own[i])
        b.append(j)
    return forest(np.concatenate(a or [open_rows]), np.concatenate(b or [open_rows]), len(members))


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop_duplicates("cls")
    cls = rows["cls"].to_numpy()
    label = block_links(rows["members"].tolist(), rows["open"].to_numpy(bool))
    other = label != np.arange(len(label))
    return pd.DataFrame({"a": cls[label[other]], "b": cls[other]})


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over hashed ids."""
    words = ids.groupBy((F.col("spot") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("spot") % 64).cast("int"))).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for batch in words.toArrow().to_batches():
        bits[np.asarray(batch.column("w"))] = np.asarray(batch.column("bits"))
    return bits


def _spot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("bigint")


def _family_links(family: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within families (fam, cls, n, share): to the pivot first, then of what the pivot does not link."""
    pivots = family.groupBy("fam").agg(F.max_by("cls", F.struct("share", "cls")).alias("pivot"))
    beside = (
        family.join(pivots, "fam")
        .join(sets.select("cls", F.col("members").alias("x")), "cls")
        .join(sets.select(F.col("cls").alias("pivot"), F.col("members").alias("y")), "pivot")
        .select("fam", "cls", "n", "pivot", "x", "y")
    )
    checked = stored(beside.mapInArrow(tidy(_verify), "fam bigint, cls bigint, n bigint, pivot bigint, linked boolean"), "pivots")
    to_pivot = checked.filter("linked and cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b"))
    sizes = checked.groupBy("fam").agg(
        F.greatest(F.ceil(F.sum(F.when(~F.col("linked"), F.col("n"))) / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("opens"),
        F.greatest(F.ceil(F.sum(F.when(F.col("linked"), F.col("n"))) / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("closed"),
        F.count(F.when(~F.col("linked"), 1)).alias("n_open"),
    )
    every = checked.join(sizes.filter("n_open > 0"), "fam")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    own = F.pmod(F.xxhash64("cls"), F.when(F.col("linked"), F.col("closed")).otherwise(F.col("opens"))).cast("int")
    group = lambda i, kind, j: F.struct(i.alias("i"), F.lit(kind).alias("kind"), j.alias("j"))
    groups = F.when(F.col("linked"), F.transform(upto(F.col("opens")), lambda i: group(i, "closed", own))).otherwise(
        F.concat(
            F.transform(upto(F.col("opens")), lambda j: group(F.least(own, j), "open", F.greatest(own, j))),
            F.transform(upto(F.col("closed")), lambda j: group(own, "closed", j)),
        )
    )
    dealt = every.select("fam", "cls", (~F.col("linked")).alias("open"), F.explode(groups).alias("g"))
    dealt = dealt.select("fam", "cls", "open", "g.i", "g.kind", "g.j").join(sets.select("cls", "members"), "cls")
    among = dealt.groupBy("fam", "i", "kind", "j").applyInPandas(_block, "a bigint, b bigint")
    return to_pivot.unionByName(among)


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, cls: the class of equal sets, null for none), and links (a, b) between classes.

    The links join exactly the classes that reach each other over pairs of PERCENT and more.
    """
    own = columns_of(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    measured = stored(own.mapInArrow(tidy(_measure), "doc_id bigint, n bigint, cls bigint, shingle bigint, sets bigint"), "measured")
    members = measured.filter("shingle is null").select("doc_id", "n", "cls")

    often = measured.filter("shingle is not null").groupBy("shingle").agg(F.sum("sets").alias("sets"))
    often = often.filter(F.col("sets") >= COMMON_SETS).orderBy(F.desc("sets"), "shingle").limit(COMMON_LIMIT).toArrow()
    shingle, sets = np.asarray(often.column("shingle")), np.asarray(often.column("sets"))
    by_count = np.lexsort((shingle, sets))
    rank = np.empty(len(shingle), np.int64)
    rank[by_count] = np.arange(len(shingle))
    order = np.argsort(shingle)

    entries = own.select("text").mapInArrow(tidy(_indexer(shingle[order], rank[order])), "key bigint, cls bigint, meta bigint, reach binary")
    listed = entries.repartition("key").sortWithinPartitions("key", "meta", "cls").mapInArrow(tidy(_lister(LIST_LIMIT)), LISTED)
    listed = stored(listed, "lists")
    pairs = listed.filter("b is not null").select("a", "b").distinct()
    families = _families(listed)

    needed = pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(families.select("cls")).distinct()
    standing = members.groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    bits = _filter_bits(standing.join(needed, "cls", "left_semi").select(_spot("doc_id").alias("spot")))
    found = own.select(_spot("doc_id").alias("spot"), "text").mapInArrow(tidy(_wanted_sets(bits)), "cls bigint, n bigint, sketch binary, members binary")
    sets = stored(found.join(needed, "cls", "left_semi").dropDuplicates(["cls"]), "sets")

    left = sets.select(F.col("cls").alias("a"), "n", F.col("sketch").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    possible = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(tidy(_sieve), "a bigint, b bigint")
    pairs = stored(possible, "pairs")
    beside = pairs.join(sets.select(F.col("cls").alias("b"), F.col("members").alias("y")), "b").join(
        sets.select(F.col("cls").alias("a"), F.col("members").alias("x")), "a"
    )
    near = beside.select("a", "b", "x", "y").mapInArrow(tidy(_verify), "a bigint, b bigint, linked boolean").filter("linked")
    return members, stored(near.select("a", "b").unionByName(_family_links(families, sets)), "links")


def _families(listed: DataFrame) -> DataFrame:
    """(fam, cls, n, share of common shingles): classes whose prefixes meet in common shingles, and members of long lists."""
    reached = listed.filter("reach is not null").select("a", "n", "common", "reach")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The common shingles of a prefix are linked one to the next."""
        for batch in batches:
            lead = [np.frombuffer(r, ">i4").astype(np.int64) for r in batch.column("reach").to_pylist()]
            a = np.concatenate([x[:1].repeat(len(x)) for x in lead] or [np.zeros(0, np.int64)])
            links_ = np.unique(np.stack([a, np.concatenate(lead or [a])]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(links_[0]), pa.array(links_[1])], ["a", "b"])

    joined = components(reached.select("reach").mapInArrow(tidy(chained), "a bigint, b bigint").distinct())
    # Nodes are common shingles, COMMON_LIMIT at most.
    first = F.conv(F.hex(F.substring("reach", 1, 4)), 16, 10).cast("bigint")
    by_common = reached.withColumn("node", first).join(joined, "node").select(
        F.col("label").alias("fam"), F.col("a").alias("cls"), "n", (F.col("common") / F.col("n")).alias("share")
    )
    by_list = listed.filter("long_key is not null").select(
        (-F.abs("long_key") - 1).alias("fam"), F.col("a").alias("cls"), "n", F.lit(0.0).alias("share")
    )
    return stored(by_common.unionByName(by_list).dropDuplicates(["fam", "cls"]), "families")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the size of its set, and component_id, the smallest id that links reach, its own included.

    A null, empty or blank text has no shingles and links with nothing, not even its like. Equal sets link. Repeated rows
    count as documents; a null id is reached by links but never a component's id while another is there. No rows give none.
    """
    members, linked = links(docs, doc_id, text)
    labels = components(linked)
    standing = members.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    placed = standing.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = placed.join(least, "label").select("cls", "component_id")
    joined = members.join(classes, "cls", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group that links join, with all its columns: the one with the smallest id, then the first row.

    Rows are told apart by a number of their own. Of a row that is there twice one stays, unless its text has no words, since
    such texts link with nothing; rows of one id with different texts are in the groups of their texts. A row without an id is
    never the one of a group that has ids, and always stays. Columns of any name pass through. No rows give no rows.
    """
    own, row = numbered(docs)
    placed = near_duplicates(own, doc_id=row).select(F.col("doc_id").alias("row"), "component_id")
    rows = stored(placed.join(columns_of(own, row=row, own="doc_id"), "row"), "placed")
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("own").isNull(), "own", "row"))["row"].alias("first"))
    gone = stored(rows.join(first, "component_id").filter("row <> first AND own IS NOT NULL").select(F.col("row").alias(row)), "gone")
    return own.join(gone, row, "left_anti").drop(row)
