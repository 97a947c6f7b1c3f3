"""Company-name keys. Each must be applied to both sides of a comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import col

# The words each key ignores.
FILER_WORDS = ("INC|INCORPORATED|LLC|LP|LTD|CORP|CORPORATION|CO|COMPANY|THE|"
               "HOLDINGS|HOLDING|GROUP|MANAGEMENT|CAPITAL|PARTNERS|ADVISORS|ADVISERS")
ISSUER_WORDS = ("INCORPORATED|INC|CORPORATION|CORP|COMPANY|COMPANIES|COS|CO|LIMITED|LTD|"
                "PLC|LLC|LP|HOLDINGS|HOLDING|GROUP|THE|AND|OF|CLASS [A-C]|COM|NEW|SA|NV")

# Ordered (pattern, replacement) steps of each key.
FILER_STEPS = (
    (r"[.'’]", ""),
    (r"[^A-Z0-9 ]", " "),
    (rf"\b({FILER_WORDS})\b", " "),
    (r"\s+", " "),
)
ISSUER_STEPS = (
    (r"&", " AND "),
    (r"[/\\]THE\b", " "),
    (r"[/\\][A-Z]{2,3}\b[/\\]?", " "),
    (r"\.COM\b", " "),
    (r"['.’]", ""),
    (r"[^A-Z0-9 ]", " "),
    (rf"\b({ISSUER_WORDS})\b", " "),
    (r"\s+", " "),
)
LISTED_STEPS = (
    (r"\s*\([^)]*\)\s*", " "),
    (r"[.,]", ""),
    (r"^THE\s+", ""),
    (r"\s*&\s*", " AND "),
    (r"\s+", " "),
)


def _apply(steps, c: Column) -> Column:
    return F.trim(reduce(lambda acc, s: F.regexp_replace(acc, s[0], s[1]), steps, c))


def filer_key(c: str | Column) -> Column:
    """Loose key that lines up the same filer across passive and active schedules."""
    return _apply(FILER_STEPS, F.upper(F.coalesce(col(c), F.lit(""))))


def issuer_key(c: str | Column) -> Column:
    """Key for matching fund holdings to registrant titles."""
    return _apply(ISSUER_STEPS, F.upper(F.coalesce(col(c), F.lit(""))))


def listed_key(c: str | Column) -> Column:
    """Key for matching rated companies to exchange listings; blank becomes NULL."""
    key = _apply(LISTED_STEPS, F.trim(F.upper(col(c))))
    return F.when(key != "", key)


def sorted_tokens(key: Column) -> Column:
    """Word-order independent form of a key."""
    return F.array_join(F.array_sort(F.split(key, " ")), " ")


def no_spaces(key: Column) -> Column:
    return F.replace(key, F.lit(" "), F.lit(""))
