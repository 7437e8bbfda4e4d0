"""Compressed vectors: a codebook per part of the vector, its nearest entries found by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Integers beyond this are held at it (components beyond 16384), so that squares and sums are exact in 64 bits.
LARGEST = 1 << 26
LONGEST = (1 << 63) - 1


class Codebook:
    """The entries of one part (rows of integers) and, for each, all others sorted by their distance from it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        apart = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(axis=2)
        n = len(entries)
        order = np.argsort(apart, axis=1, kind="stable")
        self.lists = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        # Searches start at the entry whose component sum is next to that of the vector.
        sums = self.entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.between = (sums[self.by_sum][1:] + sums[self.by_sum][:-1]) / 2

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry of each vector (the first of equals), its squared distance, and how many entries were compared.

        A vector walks the list of its best entry so far. An entry met for the first time is marked and compared; a better
        one (or an equal one of a lower index) becomes the best, and its list is walked from the start. The walk ends where
        list entries lie more than twice the present distance from the best entry: by the triangle inequality they, and all
        that follow, are farther from the vector than the best.
        """
        n, many = len(vectors), len(self.entries)
        best = self.by_sum[np.searchsorted(self.between, vectors.sum(axis=1))]
        distance = ((vectors - self.entries[best]) ** 2).sum(axis=1)
        seen = np.zeros((n, many), bool)
        seen[np.arange(n), best] = True
        at, going, compared = np.zeros(n, np.int64), np.arange(n), n
        while many > 1 and len(going):
            # Twice the distance is four times its square.
            going = going[self.apart[best[going], at[going]] <= 4 * distance[going]]
            other = self.lists[best[going], at[going]]
            at[going] += 1
            new = ~seen[going, other]
            rows, met = going[new], other[new]
            seen[rows, met] = True
            compared += len(rows)
            far = ((vectors[rows] - self.entries[met]) ** 2).sum(axis=1)
            better = (far < distance[rows]) | ((far == distance[rows]) & (met < best[rows]))
            rows = rows[better]
            best[rows], distance[rows], at[rows] = met[better], far[better], 0
            going = going[at[going] < many - 1]
        return best, distance, compared


def integers(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, size and the components' integers (little-endian, 32 bits each) of the rows that are kept."""
    own = columns_of(vectors, vec_id=vec_id, vector=vector, label=label).withColumn("vector", F.col("vector").cast("array<double>"))
    usable = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kinds = {f.name: f.dataType.simpleString() for f in own.schema.fields}

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), float)
            limit = LARGEST / SCALE
            ints = np.floor(np.clip(flat, -limit, limit) * SCALE).astype("<i4")
            ends = np.cumsum(np.asarray(lists.value_lengths(), np.int64))
            raw = [ints[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(np.diff(ends, prepend=0).astype(np.int32)), pa.array(raw, pa.binary())],
                ["vec_id", "label", "size", "ints"],
            )

    return own.filter(usable).mapInArrow(floors, f"vec_id {kinds['vec_id']}, label {kinds['label']}, size int, ints binary")


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def _parts(matrix: np.ndarray, books: np.ndarray) -> Iterator[tuple[np.ndarray, Codebook]]:
    parts, _, width = books.shape
    for part in range(parts):
        yield matrix[:, part * width : (part + 1) * width], Codebook(books[part])


def _sums(books: np.ndarray) -> Callable:
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for part, (vectors, book) in enumerate(_parts(_matrix(batch, parts * width), books)):
                found = book.search(vectors)[0]
                np.add.at(total[part], found, vectors)
                count[part] += np.bincount(found, minlength=entries)
        place = np.indices(books.shape).reshape(3, -1)
        used = np.repeat(count.reshape(-1), width)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x[used > 0], pa.int32()) for x in place), pa.array(total.reshape(-1)[used > 0]), pa.array(used[used > 0])],
            ["part", "entry", "place", "total", "used"],
        )

    return add


def fit(vectors: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, place) of ``integers`` rows of ``size`` components.

    They start as the parts of the rows with the smallest ids (ties by the integers, null ids last), as many as there are.
    A round assigns every row and replaces each entry by the floor of its mean; an entry without rows stays. Tasks send one
    sum per entry and component, so what reaches the driver has the size of the codebooks whatever the number of rows.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    start = np.array([np.frombuffer(r.ints, "<i4") for r in first]).reshape(len(first), parts, size // parts)
    books = start.transpose(1, 0, 2).astype(np.int64)
    for _ in range(rounds):
        sums = vectors.select("ints").mapInArrow(_sums(books), "part int, entry int, place int, total bigint, used bigint")
        books = books.copy()
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("used").alias("used")).collect():
            books[r.part, r.entry, r.place] = r.total // r.used
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of ``integers`` rows of the codebooks' size; code and error are null for other sizes."""
    parts, _, width = books.shape
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.asarray(batch.column("size")) == parts * width
            own = batch.filter(pa.array(fits))
            found = np.zeros((own.num_rows, parts), np.uint8)
            error = np.zeros(own.num_rows, np.int64)
            for part, (rows, book) in enumerate(_parts(_matrix(own, parts * width), books)):
                found[:, part], distance, _ = book.search(rows)
                error += distance
            codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            codes[fits], errors[fits] = [f.tobytes().hex() for f in found], error
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return vectors.mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def compressed(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row whose vector is there and finite throughout.

    Rows with a null vector, or one with null or non-finite components, are left out. The codebooks have the width of the
    kept row with the smallest id whose width is a positive multiple of ``parts``; rows of another width have a null code and
    error and add nothing to their label's. Equal ids are rows of their own, null ids come last. ``label_error`` adds the
    errors of equal labels, nulls together; a sum beyond a long is the largest long. No rows give no rows.
    """
    if entries > 256:
        raise ValueError("a code has one byte for each part")
    kept = stored(integers(vectors, vec_id, vector, label), "integers")
    sized = kept.filter((F.col("size") > 0) & (F.col("size") % parts == 0))
    head = sized.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("size").limit(1).collect()
    size = head[0]["size"] if head else parts
    rows = kept.filter(F.col("size") == size)
    books = fit(rows, size, parts, entries, rounds) if head else np.zeros((parts, 1, 1), np.int64)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = stored(encode(kept, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint")
    sums = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    met = coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def check_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB: each round is one more pair of common tables."""
    steps = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
             FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cut AS MATERIALIZED (SELECT vec_id, part, v[part * w + 1 : part * w + w] AS s
             FROM (SELECT vec_id, v, len(v) // {parts} AS w, unnest(range({parts})) AS part FROM kept))""",
        f"""book0 AS MATERIALIZED (SELECT part, entry, s AS c FROM cut JOIN
             (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id))""",
    ]
    nearest = """SELECT vec_id, part, min((d, entry)) AS best FROM (
             SELECT vec_id, cut.part, entry, list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
             FROM cut JOIN book{k} b ON b.part = cut.part) GROUP BY vec_id, part"""
    for k in range(rounds):
        steps += [
            f"near{k} AS MATERIALIZED ({nearest.format(k=k)})",
            f"""mean{k} AS (SELECT part, entry, list(CAST(m AS BIGINT) ORDER BY pos) AS c FROM (
                 SELECT part, entry, pos, (total - (total % used + used) % used) // used AS m FROM (
                  SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS total, count(*) AS used FROM (
                   SELECT cut.part, best[2] AS entry, unnest(s) AS x, unnest(range(len(s))) AS pos FROM near{k} JOIN cut USING (vec_id, part))
                  GROUP BY part, entry, pos)) GROUP BY part, entry)""",
            f"book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (part, entry))",
        ]
    return f"""WITH {", ".join(steps)},
        last AS MATERIALIZED ({nearest.format(k=rounds)}),
        coded AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM last GROUP BY vec_id),
        digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id), digest"""
