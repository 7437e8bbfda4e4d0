"""Token ids of whole texts by a table of distinct words, and texts of token ids by a table of pieces.

The table has two parts. Words that most blocks share are encoded in the driver and sent to every task; their number has a
fixed bound. All other words are dealt out by word with the places where they stand, encoded where equal ones lie together,
and sent back to their blocks. Which words are common is read from a few blocks; it changes what travels, not what results.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import columns_of, slices, stored_by, tidy
from .packing import Encoder, tokenizer_of

#: Texts whose words are numbered together, in bytes; a longer text is numbered alone.
BLOCK_BYTES = 20 << 20
#: Words that are sent to every task at most, and blocks that they are read from.
COMMON_WORDS = 131_072
SAMPLE_BLOCKS = 16
#: Words handed to the tokenizer at once.
ENCODED_AT_ONCE = 4096


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# How the tokenizers meant here prepare a text and cut it into words.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def checked(tokenizer: str) -> dict:
    """The tokenizer's file, if it cuts words in the way that ``words_of`` knows and joins pieces by spaces when decoding."""
    with open(tokenizer, encoding="utf-8") as file:
        made = json.load(file)
    cuts = [t.get("pattern", {}).get("Regex") for t in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if [t["type"] for t in (made["normalizer"] or {}).get("normalizers", [])] != NORMALIZERS or cuts[:1] != [PATTERN] or made.get("decoder"):
        raise ValueError(f"{tokenizer} cuts words or joins pieces in another way")
    return made


def words_of(run: str) -> list[str]:
    """The words of a run without ASCII white space. Runs of plain characters are cut as the tokenizer cuts them, in lower
    case; any other run stays whole, for the tokenizer to cut."""
    return Encoder.PART.findall(run.lower()) if Encoder.PLAIN.fullmatch(run) and Encoder.SPECIAL not in run else [run]


def _zipped(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=5).compress(raw, asbytes=True)


def _unzipped(zipped: bytes) -> bytes:
    size = int.from_bytes(zipped[:8], "little")
    return pa.decompress(zipped[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _packed(places: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, compressed: the higher planes are nearly empty."""
    planes = places.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _zipped(planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_unzipped(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _splitter(size: int) -> Callable:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks: their distinct words, the most frequent first, and each text as the places of its words in that order. The
        words are there twice: as rows to be dealt out, and listed in one compressed piece that travels with the block.

        Texts are cut at ASCII white space, and the distinct runs between into words. The tokenizer cuts at all these places
        and joins nothing across them, so the ids of a text are those of its words one after another.
        """
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", size):
            lists = pc.ascii_split_whitespace(part.column("text").fill_null("").cast(pa.large_string()))
            runs = lists.flatten().dictionary_encode()
            place: dict[str, int] = {}
            numbers, ends = array("i"), array("i", [0])  # the words of each run, one run behind the other
            for k in range(0, len(runs.dictionary), 1 << 14):
                for run in runs.dictionary.slice(k, 1 << 14).to_pylist():
                    for w in words_of(run) if run else ():
                        numbers.append(place.setdefault(w, len(place)))
                    ends.append(len(numbers))
            flat, first = np.frombuffer(numbers, np.int32), np.frombuffer(ends, np.int32)
            at = np.asarray(runs.indices)
            own = np.diff(first)[at]
            upto = np.cumsum(own, dtype=np.int32)
            places = flat[np.repeat(first[at] - (upto - own), own) + np.arange(upto[-1] if len(upto) else 0, dtype=np.int32)]
            ends = np.concatenate([[0], upto])[np.cumsum(np.asarray(lists.value_lengths(), np.int64))]
            # Frequent words get the small numbers, whose higher bytes are zero.
            order = np.argsort(-np.bincount(places, minlength=len(place)), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            words = list(place)
            words = [words[k] for k in order.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(ends, prepend=0)], pa.list_(pa.int64())),
                    pa.array([_packed(rank[places])], pa.binary()),
                    pa.array([_zipped("\n".join(words).encode())], pa.binary()),
                    pa.array([words], pa.list_(pa.string())),
                ],
                ["block", "docs", "counts", "places", "listed", "words"],
            )
            number += 1

    return split


BLOCKS = "block bigint, docs array<bigint>, counts array<bigint>, places binary, listed binary, words array<string>"


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """The documents as a stored table of blocks (see ``_splitter``); repeated rows and null ids keep a place of their own.

    They are bucketed by block, so that they stay where they are when the ids of their words come back."""
    own = columns_of(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored_by(own.mapInArrow(tidy(_splitter(size)), BLOCKS), "block", "blocks", compression="zstd")


def _ids_of(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from words to their ids, four bytes each. Plain words are parts of runs, which are encoded many at a time."""
    made, closed = tokenizer_of(path)

    def ids(words: list[str]) -> list[bytes]:
        plain = [bool(Encoder.PLAIN.fullmatch(w)) and Encoder.SPECIAL not in w for w in words]
        other = [w for w, p in zip(words, plain) if not p]
        parts = (other[k : k + ENCODED_AT_ONCE] for k in range(0, len(other), ENCODED_AT_ONCE))
        whole = (np.asarray(x.ids, "<u4").tobytes() for p in parts for x in made.encode_batch_fast(p, add_special_tokens=False))
        cut = iter(closed.ids([w for w, p in zip(words, plain) if p]))
        return [next(cut) if p else next(whole) for p in plain]

    return ids


def common_words(cut: DataFrame, limit: int = COMMON_WORDS) -> list[str]:
    """The words that most of SAMPLE_BLOCKS blocks have, ``limit`` at most."""
    chosen = [r["block"] for r in cut.select("block").orderBy(F.xxhash64("block"), "block").limit(SAMPLE_BLOCKS).collect()]
    seen = cut.where(F.col("block").isin(chosen)).select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in seen.orderBy(F.desc("n"), "word").limit(limit).collect()]


def _encoder(path: str) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, before, kept = _ids_of(path), None, b""
        for part in slices(batches, "word", 4 << 20):
            # Equal words lie together, so each is encoded once; one that a batch began is carried into the next.
            coded = part.column("word").dictionary_encode()
            words = coded.dictionary.to_pylist()
            again = bool(words) and words[0] == before
            ids = ([kept] if again else []) + ids_of(words[again:])
            if words:
                before, kept = words[-1], ids[-1]
            found = pa.array(ids, pa.binary()).take(coded.indices)
            yield pa.RecordBatch.from_arrays([part.column("block"), part.column("at"), found], ["block", "at", "ids"])

    return encode


def rare_ids(cut: DataFrame, common: DataFrame, tokenizer: str) -> DataFrame:
    """block, at, ids: the words of the blocks that are not ``common`` (a table of COMMON_WORDS rows at most), each encoded once."""
    each = cut.select("block", F.posexplode("words").alias("at", "word")).join(F.broadcast(common), "word", "left_anti")
    together = each.repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(tidy(_encoder(tokenizer)), "block bigint, at int, ids binary")


def pieces(spark: SparkSession, tokenizer: str) -> DataFrame:
    """id, piece: the vocabulary with its added tokens. Its size is that of the tokenizer, whatever the input."""
    made = checked(tokenizer)
    table = dict((i, p) for p, i in made["model"]["vocab"].items())
    table.update((t["id"], t["content"]) for t in made["added_tokens"])
    return spark.createDataFrame(sorted(table.items()), "id int, piece string")


def decoded(table: DataFrame, key: str, vocabulary: DataFrame) -> DataFrame:
    """``key``, text: the pieces of the column ``ids`` by a join on the id, in order, joined by single spaces.

    Rows of one key must be one row. An unknown id adds no piece; null or empty ids give no row.
    """
    each = table.select(key, F.posexplode("ids").alias("place", "id"))
    # The vocabulary is bounded by the tokenizer, so it goes to every task; pieces of a key are gathered before the shuffle.
    joined = each.join(F.broadcast(vocabulary), "id").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", "piece"))).alias("x"))
    return joined.select(key, F.array_join(F.transform("x", lambda x: x["piece"]), " ").alias("text"))


TOKENS = "doc_id bigint, ids array<int>, text string"


def _assembler(sent, digests: bool) -> Callable:
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from _texts(batch.slice(row, 1), *sent.value, digests)

    return assemble


def _texts(block: pa.RecordBatch, common: dict[str, bytes], table: list[str], digests: bool) -> Iterator[pa.RecordBatch]:
    """The documents of one block from the ids of its words, taken by their places, and the pieces of the ids."""
    listed = _unzipped(block.column("listed")[0].as_py()).decode()
    raw = list(map(common.get, listed.split("\n"))) if listed else []
    found = block.column("found").flatten()
    for at, ids in zip(np.asarray(found.field("at")).tolist(), found.field("ids").to_pylist()):
        raw[at] = ids
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    text = [" ".join(map(table.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in raw]
    spaced = [" ".join(map(str, np.frombuffer(x, "<u4").tolist())) for x in raw] if digests else []
    counts = block.column("counts")[0].as_py()
    places = _unpacked(block.column("places")[0].as_py())
    names = [("doc_id", pa.int64())] + (
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digests else [("ids", pa.list_(pa.int32())), ("text", pa.string())]
    )
    rows: list[tuple] = []
    start = held = 0
    for doc, count in zip(block.column("docs")[0].as_py(), counts):
        own = places[start : start + count]
        start += count
        listed = own.tolist()
        whole = " ".join([t for t in map(text.__getitem__, listed) if t])
        if digests:
            joined = " ".join([x for x in map(spaced.__getitem__, listed) if x])
            rows.append((doc, int(sizes[own].sum()), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(whole.encode()).hexdigest()))
        else:
            rows.append((doc, np.frombuffer(b"".join(map(raw.__getitem__, listed)), "<u4").astype(np.int32), whole))
            held += len(whole)
        if held > 4 << 20:
            yield _batch(rows, names)
            rows, held = [], 0
    if rows:
        yield _batch(rows, names)


def _batch(rows: list[tuple], names: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(names)], [n for n, _ in names])


def _round_trip(docs: DataFrame, tokenizer: str | None, doc_id: str, text: str, size: int, limit: int, digests: bool, schema: str) -> DataFrame:
    spark, tokenizer = docs.sparkSession, tokenizer or default_tokenizer()
    table = pieces(spark, tokenizer)
    cut = blocks(docs, doc_id, text, size)
    common = common_words(cut, limit)
    rare = rare_ids(cut, spark.createDataFrame([(w,) for w in common], "word string"), tokenizer)
    # A block gets back what it sent, so a group is no larger than its words.
    back = rare.groupBy("block").agg(F.collect_list(F.struct("at", "ids")).alias("found"))
    none = F.array().cast("array<struct<at:int,ids:binary>>")
    whole = cut.drop("words").join(back, "block", "left").withColumn("found", F.coalesce("found", none))
    # The id-to-piece table goes to the tasks as a list that ids point into; it has the size of the vocabulary.
    listed = [""] * (table.agg(F.max("id")).first()[0] + 1)
    for r in table.collect():
        listed[r["id"]] = r["piece"]
    sent = spark.sparkContext.broadcast((dict(zip(common, _ids_of(tokenizer)(common))), listed))
    return whole.mapInArrow(tidy(_assembler(sent, digests)), schema)


def tokens(
    docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, common: int = COMMON_WORDS
) -> DataFrame:
    """doc_id, ids, text: the token ids of every whole text, and what they decode to.

    Texts are split into words in tasks, each distinct word of the corpus is encoded once, and the ids are joined back by the
    words' places; the text comes from the ids by a look into the table of pieces. Ids equal those of the tokenizer without
    special tokens, truncation or padding; strings of special tokens in a text become those tokens, as there. A null, empty or
    blank text has no ids and decodes to an empty text. Rows without an id and repeated rows stay, each with its own result;
    no rows give no rows. Only ``doc_id`` and ``text`` are read.
    """
    return _round_trip(docs, tokenizer, doc_id, text, block_bytes, common, False, TOKENS)


def digests(
    docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, common: int = COMMON_WORDS
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``tokens``: of decimal ids joined by one space, and of the text."""
    return _round_trip(docs, tokenizer, doc_id, text, block_bytes, common, True, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, tokenizer: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, text of each row's token ids, by a join with the table of pieces; a row without ids has an empty text.

    Keys are distinct and not null. Long lists are cut into stretches of 4096 ids, so no group holds more.
    """
    tokenizer, width = tokenizer or default_tokenizer(), 4096
    own = rows.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("ids") - 1, F.lit(0)), F.lit(width))
    parts = own.select("key", F.posexplode(F.transform(starts, lambda s: F.slice("ids", s + 1, width))).alias("part", "ids")).withColumn("at", F.struct("key", "part"))
    joined = parts.select("at").join(decoded(parts, "at", pieces(rows.sparkSession, tokenizer)), "at", "left")
    whole = joined.groupBy(F.col("at.key").alias(key)).agg(F.sort_array(F.collect_list(F.struct("at.part", "text"))).alias("x"))
    return whole.select(key, F.array_join(F.transform("x", lambda x: x["text"]), " ").alias("text"))
