"""Spelling variants: words one edit apart, found by chunks of one word among the positional grams of the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import columns_of, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
#: A run whose checksum this divides loses one code point.
SLIP_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A word's form is at least so many times as frequent as the word.
FORM_RATIO = 5
#: Chunks that would meet in more pairs than this are joined by the rest of the word as well. It changes cost, not results.
CROWDED = 1024


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """word, n (long): the words of whole texts with at least ``length`` code points and ``count`` occurrences.

    Words are runs of Latin letters, A-Z in lower case. One occurrence in ``SLIP_EVERY`` loses a code point, as its checksum
    with the document's id says. A null text has no words; a null id counts as an empty one; a row read twice counts twice.
    """
    own = columns_of(docs, doc_id=doc_id, text=text)
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    # Shorter runs can never become words, with or without a slip.
    runs = F.regexp_extract_all(lowered, F.lit(RUN.replace("+", f"{{{length},}}")), F.lit(0))
    each = own.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    each = each.withColumn("sum", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("sum") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    each = each.select(F.when(F.col("sum") % SLIP_EVERY == 0, slipped).otherwise(F.col("run")).alias("word"))
    return each.filter(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= count)


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _chunks(table: DataFrame) -> DataFrame:
    """The two disjoint chunks of each word, as the shorter (or first) one of a pair: size, which, chunk, rest, word."""
    size, half = F.length("word"), _half(F.length("word"))
    front, back = F.substring("word", F.lit(1), half), F.substring("word", half + 1, size)
    both = F.array(
        F.struct(F.lit(0).alias("which"), front.alias("chunk"), back.alias("rest")),
        F.struct(F.lit(1).alias("which"), back.alias("chunk"), front.alias("rest")),
    )
    return table.select("word", size.alias("size"), F.explode(both).alias("x")).select("size", "x.which", "x.chunk", "x.rest", "word")


def _grams(table: DataFrame) -> DataFrame:
    """Positional grams of each word, as the longer (or second) one of a pair, for chunks of words of its size and of one less.

    Of all its grams those are kept that can be a chunk within shift one after a single edit: the front chunk stays at its
    place unless the edit is in it, and the back chunk moves by the difference of the sizes.
    """
    own = F.length("word")
    sized = table.select("word", own.alias("own"), F.explode(F.array(own, own - 1)).alias("size")).filter("size >= 2")
    half = _half(F.col("size"))
    kept = F.col("own") - (F.col("size") - half)  # code points before the back chunk
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.substring("word", F.lit(1), half).alias("chunk"), F.substring("word", half + 1, F.col("own")).alias("rest")),
        F.struct(F.lit(1).alias("which"), F.substring("word", kept + 1, F.col("own")).alias("chunk"), F.substring("word", F.lit(1), kept).alias("rest")),
    )
    return sized.withColumn("x", F.explode(both)).select("size", "x.which", "x.chunk", "x.rest", "word", "own")


KEY = ["size", "which", "chunk"]


def near_pairs(table: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """a, b: every pair of words that differ by one inserted, deleted or replaced code point; each pair once.

    One edit leaves a chunk of the shorter word whole, so the pair meets in that chunk. A chunk that many words share (an
    ending, say) is not joined as it is: there the rest of both words, less one code point, must be equal too, which only
    words that are near can satisfy. So no group of words is ever paired with itself as a whole.
    """
    left, right = stored(_chunks(table), "chunks"), stored(_grams(table), "grams")
    sides = left.select(*KEY, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*KEY, F.lit(0).alias("l"), F.lit(1).alias("r")))
    many = stored(sides.groupBy(*KEY).agg(F.sum("l").alias("l"), F.sum("r").alias("r")).filter(F.col("l") * F.col("r") > crowded).select(*KEY), "many")

    # Two words of one size meet in the order of letters; a pair found by the front chunk is not taken by the back one again.
    one_way = (F.col("own") > F.col("size")) | (F.col("a") < F.col("b"))
    half = _half(F.col("size"))
    once = (F.col("which") == 0) | (F.substring("a", F.lit(1), half) != F.substring("b", F.lit(1), half))
    few_l, few_r = left.join(many, KEY, "left_anti"), right.join(many, KEY, "left_anti")
    met = few_l.withColumnRenamed("word", "a").drop("rest").join(few_r.withColumnRenamed("word", "b").drop("rest"), KEY)

    def without_one(rest: Column) -> Column:
        places = F.when(F.length(rest) > 0, F.sequence(F.lit(1), F.length(rest))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.concat(F.substring(rest, F.lit(1), i - 1), F.substring(rest, i + 1, F.length(rest))).alias("part")))

    # A replaced code point: the rests agree when both lose it. An added one: the longer rest loses it and is the shorter.
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col("rest").alias("part")))
    crowd_l = left.join(many, KEY, "left_semi").withColumn("x", F.explode(F.concat(without_one(F.col("rest")), whole)))
    added = F.transform(F.array_distinct(F.transform(without_one(F.col("rest")), lambda x: x["part"])), lambda p: F.struct(F.lit(0).alias("at"), p.alias("part")))
    lost = F.when(F.col("own") == F.col("size"), without_one(F.col("rest"))).otherwise(added)
    crowd_r = right.join(many, KEY, "left_semi").withColumn("x", F.explode(lost))
    close = crowd_l.select(*KEY, "x.at", "x.part", F.col("word").alias("a")).join(
        crowd_r.select(*KEY, "x.at", "x.part", F.col("word").alias("b"), "own"), [*KEY, "at", "part"]
    )
    found = met.select(*KEY, "a", "b", "own").unionByName(close.select(*KEY, "a", "b", "own"))
    return found.filter(one_way & once & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) lead. Counts grow fivefold with each form, so there are no rings; every round
    doubles the steps that a row has behind it."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return reached


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH, count: int = LEAST_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (see ``words``).

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (of equal ones the first in code-point
    order) if it is at least ``ratio`` times as frequent as the word, else null; ``root`` is the last of the forms that follow
    one another from the word, the word itself without any. Null, empty and blank texts add no words; a text of any length is
    read whole; no rows give no rows; only ``doc_id`` and ``text`` are read, whatever other columns are called.
    """
    table = stored(words(docs, doc_id, text, length, count), "words")
    pairs = stored(near_pairs(table), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(table.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    # The least of (-n, word): largest count, then first in the order of bytes, which in UTF-8 is that of code points.
    best = counted.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("b").alias("near"))).alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    known = stored(
        table.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
