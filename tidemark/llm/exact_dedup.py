"""Exact duplicates by a minimal perfect hash over the distinct digests of a history.

A history is a table of distinct digests, each with the row that stays for it (the winner) and the number of its rows.
It is dealt into parts by digest; each part gets a minimal perfect hash: digests go to small buckets, and a bucket's seed is
chosen so that its digests fall on free slots, exactly one digest per slot. A slot holds the full digest and the winner's
locator, so that a lookup costs two array reads and is certain, because the bytes are compared: a digest that is not in the
history also falls on some slot, and is told by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import columns_of, numbered, stored

#: Digests in a part of the index on average. A part is one row of about 50 bytes a digest, so this bounds the row.
PART_DIGESTS = 256
#: Digests in a bucket on average; fewer are placed sooner, more need fewer seeds.
BUCKET_DIGESTS = 3
DIGEST_BYTES = 32
MAX_SEED = 1 << 24
#: Stands in a slot for the winner of rows that have no id.
NO_ID = -(1 << 63)

INDEX_SCHEMA = (
    "part bigint, n_slots bigint, n_buckets bigint, seeds array<int>, digests binary, keep_ids array<bigint>, sizes array<bigint>"
)


def normalised(text: Column) -> Column:
    """The text without white space of ASCII; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for space in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **more: str) -> DataFrame:
    """doc_id, the sha-256 of the normalised text in hex, and the code points of the original; and ``more`` columns as they are."""
    rows = columns_of(docs, doc_id=doc_id, text=text, **more)
    return rows.select(
        "doc_id",
        *more,
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_points"),
    )


def winners(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: the longest row that has an id, then the smallest id, and the group's size.

    The maximum is taken in each task before the shuffle, so a group of any size sends one row per task.
    """
    best = F.max(F.when(F.col("doc_id").isNotNull(), F.struct(F.col("n_points"), (-F.col("doc_id")).alias("_back"))))
    return rows.groupBy("text_sha256").agg(
        (-best["_back"]).alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def _words(digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 31-bit hashes of the digests, from their own bytes 8-11 and 12-15."""
    four = digest[:, 8:16].astype(np.int64)
    pick = lambda k: ((four[:, k] << 24) | (four[:, k + 1] << 16) | (four[:, k + 2] << 8) | four[:, k + 3]) & 0x7FFFFFFF
    return pick(0), pick(4)


def slot_of(first, second, seed, n):
    """The slot that a seed gives. Written with + * % only, so that numpy and a column expression agree."""
    return (first + second * seed) % 2147483647 % n


def build_part(digest: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the buckets, and the slot of each digest: all different, from 0 to n - 1."""
    first, second = _words(digest)
    n = len(digest)
    bucket = (first + second) % n_buckets
    seeds, slots, taken = np.zeros(n_buckets, np.int32), np.full(n, -1, np.int64), np.zeros(n, bool)
    tried = np.arange(256, dtype=np.int64)
    order = np.argsort(bucket, kind="stable")
    for members in sorted(np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1), key=len, reverse=True):
        for base in range(0, MAX_SEED, len(tried)):
            seed = base + tried
            where = slot_of(first[members, None], second[members, None], seed[None, :], n)
            fits = ~taken[where].any(axis=0)
            if len(members) > 1:
                fits &= (np.diff(np.sort(where, axis=0), axis=0) > 0).all(axis=0)
            if fits.any():
                k = int(np.argmax(fits))
                seeds[bucket[members[0]]], slots[members], taken[where[:, k]] = seed[k], where[:, k], True
                break
        else:
            raise ValueError("no seed found: two digests agree in bytes 8 to 15")
    return seeds, slots


def _build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in parts:
        out = []
        for part, hexes, keeps, sizes in zip(rows["part"], rows["hexes"], rows["keeps"], rows["sizes"]):
            digest = np.frombuffer(bytes.fromhex("".join(hexes)), np.uint8).reshape(-1, DIGEST_BYTES)
            n_buckets = -(-len(digest) // BUCKET_DIGESTS)
            seeds, slots = build_part(digest, n_buckets)
            at = np.argsort(slots)
            out.append((part, len(digest), n_buckets, seeds, digest[at].tobytes(), np.asarray(keeps, np.int64)[at], np.asarray(sizes, np.int64)[at]))
        yield pd.DataFrame(out, columns=["part", "n_slots", "n_buckets", "seeds", "digests", "keep_ids", "sizes"])


def _part(digest: Column, n_parts: int) -> Column:
    return F.conv(F.substring(digest, 1, 14), 16, 10).cast("bigint") % n_parts


def build_index(distinct: DataFrame, n_distinct: int) -> DataFrame:
    """The index over ``distinct`` (text_sha256, keep_id, group_size); one row per part of about PART_DIGESTS digests.

    The number of parts follows the number of digests. Digests are uniform, so no part grows beyond a few times the mean.
    """
    n_parts = max(1, n_distinct // PART_DIGESTS)
    grouped = distinct.groupBy(_part(F.col("text_sha256"), n_parts).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("text_sha256", "keep_id", "group_size"))).alias("_rows")
    )
    packed = grouped.select(
        "part",
        F.col("_rows.text_sha256").alias("hexes"),
        F.transform("_rows", lambda r: F.coalesce(r["keep_id"], F.lit(NO_ID))).alias("keeps"),
        F.col("_rows.group_size").alias("sizes"),
    )
    return packed.mapInPandas(_build, INDEX_SCHEMA).withColumn("n_parts", F.lit(n_parts).cast("bigint"))


def lookup(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with keep_id and group_size of the history's winner; group_size is null where the history has no such digest.

    A part meets its rows in a plain join, which may be split where a digest holds many of the rows.
    """
    n_parts = index.select("n_parts").first()
    if n_parts is None:
        return rows.withColumns({"keep_id": F.lit(None).cast("bigint"), "group_size": F.lit(None).cast("bigint")})
    keyed = rows.withColumn("part", _part(F.col("text_sha256"), n_parts[0]))
    joined = keyed.join(index.drop("n_parts"), "part", "left")
    word = lambda at: F.conv(F.substring("text_sha256", at, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF))
    first, second = word(17), word(25)
    seed = F.get("seeds", ((first + second) % F.col("n_buckets")).cast("int")).cast("bigint")
    slot = slot_of(first, second, seed, F.col("n_slots")).cast("int")
    found = F.substring("digests", slot * DIGEST_BYTES + 1, F.lit(DIGEST_BYTES)) == F.unhex("text_sha256")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        F.when(found, F.nullif(F.get("keep_ids", slot), F.lit(NO_ID))).alias("keep_id"),
        F.when(found, F.get("sizes", slot)).alias("group_size"),
    )


def resolve(docs: DataFrame, history: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with the row that stays for its text.

    Returns doc_id, keep_id, group_size, kept, text_sha256. Without ``history`` the documents are their own history:
    the winners of all of them are indexed, and each row is looked up. With a ``history`` (columns text_sha256,
    keep_id, group_size) documents whose digest it has are repeats of the winner there; the others are grouped among
    themselves, in the same way, and keep one row per group.

    A null or empty text, and one of white space only, is the empty text; such rows form one group. Repeated rows with one
    id count as rows; the smallest id wins ties. A null id is never preferred to another and never kept. No rows give no rows.
    """
    rows = stored(digests(docs, doc_id, text), "digests")
    if history is None:
        return _finish(_within(rows))
    known = stored(lookup(rows, build_index(history, history.count())), "known")
    fresh = known.filter("group_size is null").select(*rows.columns)
    repeats = known.filter("group_size is not null")
    return _finish(repeats.unionByName(_within(fresh)))


def _within(rows: DataFrame) -> DataFrame:
    distinct = stored(winners(rows), "winners")
    index = stored(build_index(distinct, distinct.count()), "index")
    return lookup(rows, index)


def _finish(rows: DataFrame) -> DataFrame:
    kept = F.coalesce(F.col("keep_id") == F.col("doc_id"), F.lit(False))
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, with all its columns: the longest, then the smallest id, then the first row.

    Rows are told apart by a number of their own. Of a row that is there twice one stays; rows of one id with different texts
    are judged each by its text; a null id comes after all others, and stays where its group has no other. A null text is
    empty, and empty texts are one group. Columns of any name pass through. No rows give no rows.
    """
    own, row = numbered(docs)
    rows = stored(digests(own, row, own="doc_id"), "digests")
    first = F.min(F.struct(-F.col("n_points"), F.col("own").isNull(), "own", "doc_id"))["doc_id"]
    distinct = stored(rows.groupBy("text_sha256").agg(first.alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "winners")
    found = lookup(rows, stored(build_index(distinct, distinct.count()), "index"))
    gone = stored(found.filter("keep_id <> doc_id").select(F.col("doc_id").alias(row)), "gone")
    return own.join(gone, row, "left_anti").drop(row)
