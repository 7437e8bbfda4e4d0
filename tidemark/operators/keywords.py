"""A stored keyword index in immutable segments, and answers that read it instead of texts.

An ingest adds one segment. A segment holds postings in blocks, dealt into buckets by token: a block is up to
``BLOCK_DOCS`` documents of one token that are alike in length, with their ids, counts and lengths, and with what the answers
need to leave a block unread: its smallest id, its range of lengths, and the outline of its (count, length) pairs, from which
the highest score in it follows for any corpus statistics. Segments of like size are merged from their own postings; which
segments count is said by the newest manifest, written last.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.texts import query_terms, token_count, tokens
from ..session import broadcast_if_small, checkpointed
from .ranking import head_per_group

BM25_K1 = 1.2
BM25_B = 0.75
BLOCK_DOCS = 128
BUCKETS = 64
#: Segments of one size class that are merged into one; a class is this many times larger than the one below.
FAN = 4
#: Terms up to which a lookup names its buckets and tokens, so that folders and row groups are left out.
NAMED_TERMS = 256
#: Lengths are told apart by half powers of two where other terms' best counts are kept.
LENGTH_BINS = 64
#: Postings that a task lays out, about, and characters of text that make one posting; both only set the layout.
TASK_POSTINGS = 1 << 20
POSTING_CHARACTERS = 8
#: Postings that a task holds before it hands them on.
HELD_POSTINGS = 100_000
#: Bits of the number by which rows are sorted that tell the length; the others tell the token, by its hash.
LENGTH_BITS = 24
# A term, as functions.texts.tokens finds it.
TERM = re.compile("[a-z0-9]+")

POSTINGS = (
    "token string, least_id bigint, docs int, least_length int, most_length int, top_counts array<int>, "
    "top_lengths array<int>, ids array<bigint>, counts array<int>, lengths array<int>"
)
POSTING_NAMES = [field.split()[0] for field in POSTINGS.split(", ")]
STATS = "docs bigint, texts bigint, tokens bigint, postings bigint"


def _bucket(token: Column | str) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _mark(token: Column | str) -> Column:
    """A number by which blocks are sorted, so that a lookup leaves out what lies elsewhere; not quite every token has its own."""
    return F.shiftrightunsigned(F.xxhash64(token, F.lit(2)), LENGTH_BITS + 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, content`` to one row per document and distinct token. A document's tokens are counted where its text lies."""
    ids, found, counts, lengths = [], [], [], []

    def handed() -> pa.RecordBatch:
        arrays = [pa.array(found, pa.string()), pa.array(ids, pa.int64()), pa.array(lengths, pa.int32()), pa.array(counts, pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, ["token", "id", "length", "count"])

    for batch in batches:
        for doc, text in zip(batch.column("id"), batch.column("content")):
            every = TERM.findall(text.as_py().lower())
            own = Counter(every)
            found += own.keys()
            counts += own.values()
            ids += [doc.as_py()] * len(own)
            lengths += [len(every)] * len(own)
            if len(found) > HELD_POSTINGS:
                yield handed()
                ids, found, counts, lengths = [], [], [], []
    yield handed()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to blocks; those of a token lie together by length. Where two tokens are mixed, blocks are smaller. What is left of a batch is carried into the next, so it is at most a block."""
    rest: pa.Table | None = None
    for one in batches:
        rows = pa.Table.from_batches([one])
        made, rest = _cut(pa.concat_tables([rest, rows]) if rest is not None else rows, False)
        if made.num_rows:
            yield made
    if rest is not None:
        yield _cut(rest, True)[0]


def _cut(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table | None]:
    """Blocks of the rows, and the rows of the last block where more may follow."""
    token = rows.column("token").combine_chunks()
    codes = np.asarray(token.dictionary_encode().indices, np.int64)
    at = np.arange(len(codes))
    run = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1]) if len(codes) else at
    starts = np.flatnonzero((at - run[np.searchsorted(run, at, side="right") - 1]) % BLOCK_DOCS == 0) if len(codes) else at
    ends = np.append(starts[1:], len(codes)) if len(codes) else at
    end, rest = len(codes), None
    if len(starts) and not last and ends[-1] - starts[-1] < BLOCK_DOCS:
        end, rest = int(starts[-1]), rows.slice(int(starts[-1]))
        starts, ends = starts[:-1], ends[:-1]
    ids, counts, lengths = (rows.column(c).to_numpy()[:end] for c in ("id", "count", "length"))
    # The outline of a block: pairs that no other pair beats in both, a higher count and no greater length.
    block = np.repeat(np.arange(len(starts)), ends - starts)
    order = np.lexsort((-counts, lengths, block))
    best = np.maximum.accumulate((block << 32) + counts[order]) if end else block
    top = order[np.concatenate([[True], best[1:] > best[:-1]])] if end else order
    tops = np.concatenate([[0], np.cumsum(np.bincount(block[top], minlength=len(starts)))])
    whole = np.append(starts, end)

    def lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

    made = [
        token.take(pa.array(starts)), pa.array(np.minimum.reduceat(ids, starts) if end else ids, pa.int64()), pa.array(ends - starts, pa.int32()),
        pa.array(lengths[starts], pa.int32()), pa.array(lengths[ends - 1], pa.int32()), lists(tops, counts[top], pa.int32()), lists(tops, lengths[top], pa.int32()),
        lists(whole, ids, pa.int64()), lists(whole, counts, pa.int32()), lists(whole, lengths, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(made, POSTING_NAMES), rest


class KeywordIndex:
    """Postings of ``id, content`` documents below one folder. One writer at a time; readers keep the manifest they opened."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- writing ------------------------------------------------------------------------------------------

    def add(self, docs: DataFrame, name: str, doc_id: str = "id", content: str = "content") -> None:
        """Store one ingest as the segment ``name``. Adding a name again replaces that segment, so a replay changes nothing.

        An id belongs to one ingest. A null text counts as a document without a length; so does a null id's, whose words are
        not indexed. Earlier segments are neither read nor rewritten.
        """
        if name.startswith("merged-"):
            raise ValueError("names that begin with 'merged-' are kept for merges")
        own = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(content).alias("content"))
        size = own.agg(F.count(F.lit(1)).alias("docs"), F.count("content").alias("texts"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("n")).first()
        counted = own.where("id IS NOT NULL AND content IS NOT NULL").mapInArrow(_counted, "token string, id bigint, length int, count int")
        self._write(counted, name, size["n"] // POSTING_CHARACTERS)
        # Tokens of documents with an id are those of the postings just written.
        stored = self._postings([name]).select(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c).alias("n"))
        unnamed = own.where("id IS NULL").select(token_count("content").cast("bigint").alias("n"))
        number = lambda n: F.lit(n).cast("bigint")
        sums = stored.unionByName(unnamed).agg(
            number(size["docs"]).alias("docs"), number(size["texts"]).alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("tokens")
        )
        self._seal(sums, name)
        self._publish([s for s in self.segments() if s != name] + [name])

    def merge(self) -> list[str]:
        """Merge size classes that hold FAN segments or more, and name the segments that now count.

        The new segment is made of the old ones' postings; no text is read. Old folders stay for readers that opened them.
        """
        while True:
            classes: dict[int, list[str]] = {}
            for r in self._stats().select("segment", "postings").collect():
                classes.setdefault(int(np.log(max(r["postings"], 1)) / np.log(FAN)), []).append(r["segment"])
            full = [sorted(s) for s in classes.values() if len(s) >= FAN]
            if not full:
                return self.segments()
            for group in full:
                name = f"merged-{self._version() + 1}"
                many = self._stats(group).agg(F.sum("postings")).first()[0]
                self._write(self._rows(self._postings(group)), name, many)
                sums = self._stats(group).agg(*[F.sum(c).alias(c) for c in ("docs", "texts", "tokens")])
                self._seal(sums, name)
                self._publish([s for s in self.segments() if s not in group] + [name])

    def _write(self, rows: DataFrame, name: str, many: int) -> None:
        """Lay out about ``many`` postings: a task takes some buckets or, where there are many, a share of one.

        Shares are dealt by token and class of length, so that a frequent token is spread over tasks and its blocks stay alike.
        """
        tasks = max(-(-many // TASK_POSTINGS), 1)
        bucket, shares = F.col("bucket"), -(-tasks // BUCKETS)
        share = F.pmod(F.xxhash64("token", _bin(F.col("length")), F.lit(1)), F.lit(shares))
        task = (bucket * tasks / BUCKETS if tasks < BUCKETS else bucket * shares + share).cast("int")
        dealt = rows.withColumn("bucket", _bucket("token")).repartitionById(tasks if tasks < BUCKETS else BUCKETS * shares, task)
        # By one number, which is sorted without comparing rows.
        place = F.shiftleft(_mark("token"), LENGTH_BITS) + F.least("length", F.lit((1 << LENGTH_BITS) - 1))
        laid = dealt.withColumn("place", place).sortWithinPartitions("place").select("token", "id", "length", "count")
        blocks = laid.mapInArrow(_blocks, POSTINGS)
        blocks.withColumn("mark", _mark("token")).withColumn("bucket", _bucket("token")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/postings/segment={name}")

    def _seal(self, sums: DataFrame, name: str) -> None:
        postings = self._postings([name]).agg(F.coalesce(F.sum("docs"), F.lit(0)).cast("bigint").alias("postings"))
        sums.withColumn("postings", postings.scalar()).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/stats/segment={name}")

    def _publish(self, names: list[str]) -> None:
        row = [(self._version() + 1, sorted(names))]
        self.spark.createDataFrame(row, "version bigint, segments array<string>").coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    # -- reading ------------------------------------------------------------------------------------------

    def _manifest(self) -> list:
        from pyspark.errors import AnalysisException

        try:
            rows = self.spark.read.schema("version bigint, segments array<string>").parquet(f"{self.root}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return rows.orderBy(F.desc("version")).limit(1).collect()

    def _version(self) -> int:
        return next((r["version"] for r in self._manifest()), 0)

    def segments(self) -> list[str]:
        return list(next((r["segments"] for r in self._manifest()), []))

    def _postings(self, names: list[str]) -> DataFrame:
        """Blocks of the named segments with ``segment`` and ``bucket``."""
        schema = POSTINGS + ", mark bigint, bucket int, segment string"
        paths = [f"{self.root}/postings/segment={n}" for n in names]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/postings").parquet(*paths)
        return found.where(F.col("segment").isin(names))

    def _stats(self, names: list[str] | None = None) -> DataFrame:
        names = self.segments() if names is None else names
        schema = STATS + ", segment string"
        if not names:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/stats/segment={n}" for n in names]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/stats").parquet(*paths)

    @staticmethod
    def _rows(blocks: DataFrame, *keep: str) -> DataFrame:
        zipped = F.explode(F.arrays_zip("ids", "counts", "lengths")).alias("x")
        return blocks.select("token", *keep, zipped).select("token", *keep, F.col("x.ids").alias("id"), F.col("x.counts").alias("count"), F.col("x.lengths").alias("length"))

    def postings(self) -> DataFrame:
        """``token, doc_id, tf`` of all segments."""
        return self._rows(self._postings(self.segments())).select("token", F.col("id").alias("doc_id"), F.col("count").cast("bigint").alias("tf"))

    def _blocks_of(self, terms: DataFrame, many: int, names: list[str] | None) -> DataFrame:
        """Blocks of the terms. Few terms are named in the filter: other buckets are not listed, other row groups not read."""
        every = self._postings(self.segments())
        if names is None:
            return every.join(broadcast_if_small(terms.select("token").distinct(), many), "token", "left_semi")
        wanted = self.spark.createDataFrame([(t,) for t in names], "token string")
        places = wanted.select(_bucket("token"), _mark("token")).collect()
        buckets, marks = (sorted(set(x)) for x in zip(*places)) if places else ([], [])
        return every.where(F.col("bucket").isin(buckets) & F.col("mark").isin(marks) & F.col("token").isin(names))

    def counts(self) -> tuple[int, float]:
        """Documents, and the mean number of tokens of those that have a text."""
        row = self._stats().agg(F.sum("docs").alias("docs"), (F.sum("tokens") / F.sum("texts")).alias("mean")).first()
        return row["docs"] or 0, row["mean"] or 0.0

    # -- answers ------------------------------------------------------------------------------------------

    def _terms(self, queries: DataFrame) -> tuple[DataFrame, int, list[str] | None]:
        """``query_id, token``, their number, and the distinct tokens if they are few enough to be named."""
        terms = queries.select("query_id", F.explode(F.array_distinct(tokens("query"))).alias("token"))
        names = [r[0] for r in terms.select("token").distinct().limit(NAMED_TERMS + 1).collect()]
        return terms, terms.count(), names if len(names) <= NAMED_TERMS else None

    def _first(self, blocks: DataFrame, limit: int) -> DataFrame:
        """``token, id`` of at least the ``limit`` smallest ids of each token.

        Of the blocks of a token only the ``limit`` with the smallest ids can hold any of them.
        """
        heads = head_per_group(blocks.select("token", "least_id", "ids"), ["token"], limit, [F.asc("least_id")], "_place")
        return heads.select("token", F.explode("ids").alias("id"))

    def first_matches(self, query: str, limit: int) -> DataFrame:
        """First ``limit`` matches by id, all with score 1: ``id, text_score, text_rank``."""
        one = self.spark.createDataFrame([(0, query)], "query_id bigint, query string")
        return self.first_matches_batch(one, limit).drop("query_id")

    def first_matches_batch(self, queries: DataFrame, limit: int) -> DataFrame:
        """The same for every query of a batch: ``query_id, id, text_score, text_rank``."""
        terms, many, names = self._terms(queries)
        found = self._first(self._blocks_of(terms, many, names), limit).join(broadcast_if_small(terms, many), "token")
        ranked = head_per_group(found.select("query_id", "id").distinct(), ["query_id"], limit, [F.asc("id")], "text_rank")
        return ranked.select("query_id", "id", F.lit(1.0).alias("text_score"), F.col("text_rank").cast("bigint").alias("text_rank"))

    def match_counts(self, queries: DataFrame) -> DataFrame:
        """Documents matched per query, 0 included: ``query_id, matches``."""
        terms, many, names = self._terms(queries)
        found = self._blocks_of(terms, many, names).select("token", F.explode("ids").alias("id")).join(broadcast_if_small(terms, many), "token")
        counted = found.groupBy("query_id").agg(F.count_distinct("id").alias("matches"))
        return queries.select("query_id").join(counted, "query_id", "left").select("query_id", F.coalesce("matches", F.lit(0)).alias("matches"))

    def search_counts(self, query: str) -> DataFrame:
        """One row: ``total_docs`` and ``matches`` of one query."""
        one = self.spark.createDataFrame([(0, query)], "query_id bigint, query string")
        return self.match_counts(one).select(F.lit(self.counts()[0]).cast("bigint").alias("total_docs"), "matches")

    def _weighed(self, queries: DataFrame) -> tuple[DataFrame, DataFrame, int, float]:
        """Blocks; ``query_id, token, idf`` and how many they are; and the mean length."""
        n, mean = self.counts()
        terms, many, names = self._terms(queries)
        blocks = self._blocks_of(terms, many, names)
        known = blocks.groupBy("token").agg(F.sum("docs").alias("df"))
        idf = F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = terms.join(known, "token").select("query_id", "token", idf.alias("idf"))
        return blocks, weights, many, mean

    def bm25(self, queries: DataFrame) -> DataFrame:
        """BM25 scores of all documents that hold a term of the query: ``query_id, id, score``."""
        blocks, weights, many, mean = self._weighed(queries)
        rows = self._rows(blocks).join(broadcast_if_small(weights, many), "token")
        return rows.groupBy("query_id", "id").agg(F.sum(F.col("idf") * _share(F.col("count"), F.col("length"), mean)).alias("score"))

    def _bounded(self, queries: DataFrame, k: int) -> tuple[DataFrame, float]:
        """Blocks of each query, lists included, with ``best``, ``bound`` and ``kept`` as ``bounds`` tells them; and the mean length.

        What the bounds need of other blocks is made into small tables first, a row per token and class of length, so that
        the blocks themselves are passed once and never shuffled.
        """
        blocks, weights, many, mean = self._weighed(queries)
        weights = broadcast_if_small(checkpointed(self.spark, weights), many)
        heads = blocks.join(weights, "token").withColumns(
            {
                "best": F.col("idf") * F.array_max(F.zip_with("top_counts", "top_lengths", lambda c, n: _share(c, n, mean))),
                "low": _bin(F.col("least_length")),
                "high": _bin(F.col("most_length")),
            }
        )
        keys = ["segment", "token", "least_id", "least_length"]
        leaders = head_per_group(heads.select("query_id", *keys, "idf", "best"), ["query_id"], k, [F.desc("best")], "_place")
        seen = self._rows(blocks.join(broadcast_if_small(leaders.select("query_id", *keys, "idf"), k * many), keys), "query_id", "idf")
        partial = seen.groupBy("query_id", "id").agg(F.sum(F.col("idf") * _share(F.col("count"), F.col("length"), mean)).alias("score"))
        floors = head_per_group(partial, ["query_id"], k, [F.desc("score")], "_place").where(F.col("_place") == k)

        # The highest count of each token in each class of length; then in each span of classes that some block has.
        spans = blocks.select("token", _bin(F.col("least_length")).alias("low"), _bin(F.col("most_length")).alias("high"), F.array_max("top_counts").alias("most"))
        spans = checkpointed(self.spark, spans.groupBy("token", "low", "high").agg(F.max("most").alias("most")))
        classes = spans.select("token", F.explode(F.sequence("low", "high")).alias("bin"), "most").groupBy("token", "bin").agg(F.max("most").alias("most"))
        asked = spans.select("low", "high").distinct().select("low", "high", F.explode(F.sequence("low", "high")).alias("bin"))
        profile = classes.join(F.broadcast(asked), "bin").groupBy("token", "low", "high").agg(F.max("most").alias("most"))
        # A class may hold shorter documents than the block, so the count is taken at the least length of the class.
        gives = F.col("idf") * _share(F.col("most"), F.pow(F.lit(2.0), F.col("low") / 2), mean)
        reach = profile.join(weights, "token").select("query_id", "token", "low", "high", gives.alias("gives"))
        whole = F.sum("gives").over(Window.partitionBy("query_id", "low", "high"))
        slack = reach.withColumn("others", whole - F.col("gives")).drop("gives")
        slack = checkpointed(self.spark, slack.join(floors.select("query_id", F.col("score").alias("floor")), "query_id", "left"))
        here = heads.join(broadcast_if_small(slack, slack.count()), ["query_id", "token", "low", "high"])
        bound = F.col("best") + F.col("others")
        # Sums may differ in the last digits with their order.
        kept = F.coalesce(F.col("bound") >= F.col("floor") * (1 - 1e-9), F.lit(True))
        return here.withColumn("bound", bound).withColumn("kept", kept), mean

    def bounds(self, queries: DataFrame, k: int) -> DataFrame:
        """Blocks of each query with ``best`` (highest score that the block's token gives in it), ``bound`` (no document in it
        scores more in all), and ``kept``: whether it can still hold one of the ``k`` best.

        The floor of a query is the k-th best score found in the k blocks of the highest ``best``: what documents have from
        those blocks alone, so their true scores are no less. A block whose bound is below the floor cannot hold a
        document of the answer; one that equals it can, and is kept, so ties are not lost. For the other terms of the query
        the bound takes their highest counts among documents at least as short as the block's class allows: blocks hold
        documents of like length, and length is most of what tells scores apart.
        """
        made, _ = self._bounded(queries, k)
        return made.select("query_id", "segment", "token", "least_id", "least_length", "docs", "idf", "best", "bound", "kept")

    def top_bm25(self, queries: DataFrame, k: int) -> DataFrame:
        """The ``k`` best documents of each query by BM25, ties by id: ``query_id, id, score, rank``.

        Only documents of blocks that can still reach the answer are scored (see ``bounds``); every document of the answer has
        all its terms in such blocks, so its score is whole.
        """
        made, mean = self._bounded(queries, k)
        rows = self._rows(made.where("kept"), "query_id", "idf")
        scored = rows.groupBy("query_id", "id").agg(F.sum(F.col("idf") * _share(F.col("count"), F.col("length"), mean)).alias("score"))
        # Equal scores must be equal numbers, whatever the order of their sums.
        ranked = head_per_group(scored, ["query_id"], k, [F.desc(F.round("score", 9)), F.asc("id")], "rank")
        return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def _share(count: Column, length: Column, mean: float) -> Column:
    """What a term's count gives before its weight; it grows with the count and falls with the length."""
    return count * (BM25_K1 + 1.0) / (count + BM25_K1 * (1.0 - BM25_B + BM25_B * length / F.lit(mean or 1.0)))


def _bin(length: Column) -> Column:
    return F.least(F.floor(2 * F.log2(F.greatest(length, F.lit(1)))), F.lit(LENGTH_BINS)).cast("int")


def single(spark: SparkSession, query: str) -> DataFrame:
    """A batch of one query."""
    return spark.createDataFrame([(0, " ".join(query_terms(query)))], "query_id bigint, query string")
