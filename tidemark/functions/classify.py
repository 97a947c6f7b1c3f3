"""Keyword screens over headlines and filing text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import col

# Rating-action classes, first match wins.
ACTION_PATTERNS = (
    ("issuer_not_cooperating", r"issuer non-?cooperating|issuer not cooperating"),
    ("downgrade", r"downgrad"),
    ("upgrade", r"upgrad"),
    ("watch", r"\bwatch\b"),
    ("migrated", r"migrat"),
    ("withdrawn", r"withdraw"),
    ("reaffirmed", r"reaffirm"),
    ("assigned", r"assign"),
)

# Item 4 purpose flags.
PURPOSE_PATTERNS = {
    "seeks_sale_or_merger": r"strategic alternatives|sale of the (company|issuer)|"
                            r"merger|acquisition of the issuer|business combination|"
                            r"take[- ]private|tender offer",
    "board_representation": r"nominat\w+|board of directors|board seat|"
                            r"director candidate|proxy contest|consent solicitation",
    "engage_management": r"engage\w* (?:in )?(?:discussions|dialogue)|"
                         r"communicat\w+ with (?:the )?(?:issuer|management)|"
                         r"discussions with (?:the )?(?:issuer|management|board)",
    "capital_return": r"share repurchase|buyback|special dividend|return of capital",
    "opposes_transaction": r"oppose|vote against|inadequate|undervalue\w*",
    "control_intent": r"acquire control|controlling interest|majority of the",
}


def action_class(heading: str | Column, other: str = "other") -> Column:
    low = F.lower(F.coalesce(col(heading), F.lit("")))
    (name, pattern), *rest = ACTION_PATTERNS
    out = F.when(low.rlike(pattern), name)
    for name, pattern in rest:
        out = out.when(low.rlike(pattern), name)
    return out.otherwise(other)


def purpose_flags(item4: str | Column) -> dict[str, Column]:
    low = F.lower(F.coalesce(col(item4), F.lit("")))
    return {name: low.rlike(pattern) for name, pattern in PURPOSE_PATTERNS.items()}
