"""Tokens, matching and chunking."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

TERM_BREAK = "[^a-z0-9]+"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tokens(text) -> Column:
    """Lower-cased runs of letters and digits, in text order, repeats kept."""
    return F.array_remove(F.split(F.lower(_col(text)), TERM_BREAK), "")


def query_terms(query: str) -> list[str]:
    """Distinct terms of a query string, by the same rule as :func:`tokens`."""
    return sorted({t for t in re.split(TERM_BREAK, query.lower()) if t})


def token_count(text) -> Column:
    """Number of tokens, without building the list twice: a split leaves empty pieces only at its ends."""
    pieces = F.split(F.lower(_col(text)), TERM_BREAK)
    edges = (pieces[0] == "").cast("int") + ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")
    return F.size(pieces) - edges


def _whole(terms: list[str]) -> str:
    """Pattern of any of the terms, standing between characters that belong to no term."""
    return f"(?<![a-z0-9])(?:{'|'.join(terms)})(?![a-z0-9])"


def match_any(text, query: str) -> Column:
    """True when the text holds at least one term of the query.

    A plain search for the letters comes first; only texts that contain them meet the pattern.
    """
    terms = query_terms(query)
    if not terms:
        return F.lit(False)
    lowered = F.lower(_col(text))
    letters = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(t)) for t in terms])
    return F.coalesce(letters & lowered.rlike(_whole(terms)), F.lit(False))


def term_count(text, term: str) -> Column:
    """How often one term occurs."""
    lowered = F.lower(_col(text))
    return F.when(F.contains(lowered, F.lit(term)), F.regexp_count(lowered, F.lit(_whole([term])))).otherwise(0)


def not_blank(text) -> Column:
    """True when something other than white space is left."""
    return F.coalesce(_col(text).rlike(r"(?U)\S"), F.lit(False))


def chunks(text, size: int = 512) -> Column:
    """Consecutive pieces of at most ``size`` characters; one pass over the text, whatever its length."""
    return F.regexp_extract_all(_col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
