"""Personal data in texts: patterns propose spans, checksums confirm them, context words move the score.

Column expressions only. Java's matcher gives the matched strings and what lies between them, in step; summing their lengths
gives places in code points. Repeated groups are possessive where nothing follows that could need a character back: such
groups are matched in a loop, so a text of any length needs no deep stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import columns_of

# The kinds of the contract and their patterns, in order. A look-behind only skips starts within a run
# whose beginning has failed for the same reason.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Kinds that the method adds: account numbers with a mod-97 check, and social security numbers, which have none and
# therefore need a context word.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

#: Code points on each side of a span in which a context word counts.
CONTEXT = 40
#: Spans of added kinds below this score are left out.
LEAST_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needed: str  # a cheap pattern, or a literal, without which the kind cannot occur
    score: float  # of a confirmed span without a context word
    words: str  # context words, as a pattern on lower-case text
    base: bool = True


KINDS = [
    Kind("email", EMAIL, "@", 0.9, r"\b(?:e-?mail|mail|contact|write)\b"),
    Kind("ip", IP, ".", 0.6, r"\b(?:ip|address|host|server)\b"),
    Kind("card", CARD, "[0-9]", 0.7, r"\b(?:card|credit|debit|visa|mastercard|payment)\b"),
    Kind("phone", PHONE, "+", 0.6, r"\b(?:phone|tel|telephone|call|mobile|fax)\b"),
    Kind("iban", IBAN, "[0-9]", 0.8, r"\b(?:iban|account|bank|konto|compte|cuenta)\b", base=False),
    Kind("ssn", SSN, "-", 0.3, r"\b(?:ssn|social|security)\b", base=False),
]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Whether the account number, its first four characters moved to the end and letters as numbers, leaves 1 modulo 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    value = lambda c: F.when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda a, c: (a * F.when(c <= "9", 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """Whether a match passes the checks of its kind."""
    if kind == "ip":
        return match.rlike(rf"^{IP_PART}\.{IP_PART}\.{IP_PART}\.{IP_PART}$")
    if kind == "card":
        return F.length(_digits(match)).between(14, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & _mod97(match)
    return F.lit(True)


def _spans(kind: Kind, order: int) -> Column:
    """Confirmed spans of one kind: array of (start, order, end, kind, score)."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    pairs = F.arrays_zip(F.transform(between, lambda g: F.length(g)).alias("gap"), matches.alias("hit"))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("found"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.coalesce(F.length(pair["hit"]), F.lit(0))
        kept = F.when(
            pair["hit"].isNotNull(),
            F.concat(state["found"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit")))),
        ).otherwise(state["found"])
        return F.struct(end.alias("at"), kept.alias("found"))

    placed = F.filter(F.aggregate(pairs, first, step)["found"], lambda m: confirmed(kind.name, m["hit"]))

    def scored(m: Column) -> Column:
        begin = F.greatest(m["start"] - CONTEXT, F.lit(0))
        near = F.concat_ws(" ", F.substring(text, begin + 1, m["start"] - begin), F.substring(text, m["end"] + 1, F.lit(CONTEXT)))
        bonus = F.when(F.lower(near).rlike(kind.words), 1.0 - kind.score).otherwise(0.0) * 0.75
        return F.struct(
            m["start"].alias("start"), F.lit(order).alias("rank"), m["end"].alias("end"), F.lit(kind.name).alias("kind"),
            F.round(F.lit(kind.score) + bonus, 3).alias("score"),
        )

    spans = F.transform(placed, scored)
    if not kind.base:
        spans = F.filter(spans, lambda m: m["score"] >= LEAST_SCORE)
    possible = text.rlike(kind.needed) if kind.needed.startswith("[") else F.contains(text, F.lit(kind.needed))
    return F.when(possible, spans).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>"))


def _digest_line(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ","
    )


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, text, and ``found``, the spans by start, then by kind, with their scores.

    Spans of one kind do not overlap; spans of different kinds may. A null or empty text has none. Rows are taken one by
    one, so repeated rows and ids give repeated results.
    """
    own = columns_of(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    every = own.withColumns({f"_{kind.name}": _spans(kind, order) for order, kind in enumerate(KINDS)})
    found = F.sort_array(F.concat(*[F.col(f"_{kind.name}") for kind in KINDS]))
    return every.select("doc_id", "text", found.alias("found"))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as one line with their scores."""
    found = spans(docs, doc_id, text)
    of = lambda name: F.size(F.filter("found", lambda m: m["kind"] == name)).cast("bigint").alias(f"n_{name}")
    base = F.filter("found", lambda m: m["rank"] < sum(kind.base for kind in KINDS))
    return found.select(
        "doc_id",
        *[of(kind.name) for kind in KINDS],
        F.sha2(_digest_line(base), 256).alias("base_sha256"),
        _digest_line(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda m: m["score"].cast("string")), ",").alias("scores"),
    )


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    found = spans(docs, doc_id, text)
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))

    def step(state: Column, m: Column) -> Column:
        begin = F.greatest(m["start"], state["at"])
        made = F.concat(state["made"], F.substring("text", state["at"] + 1, begin - state["at"]), F.lit("<"), m["kind"], F.lit(">"))
        return F.when(m["start"] >= state["at"], F.struct(m["end"].alias("at"), made.alias("made"))).otherwise(state)

    done = F.aggregate("found", first, step)
    rest = F.substring(F.col("text"), done["at"] + 1, F.length("text"))
    return found.select("doc_id", F.concat(done["made"], rest).alias("text"))
