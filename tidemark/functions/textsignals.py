"""Column helpers for transcripts and descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import col

# Chapter lines, sponsor passages, anchor spacing.
CHAPTER = r"(?m)^\s*((?:\d{1,2}:)?\d{1,2}:\d{2})\s+(.{2,90})$"
SPONSOR = (
    r"(?i)(use|with) (my |the )?(promo |discount )?code [A-Z0-9']{3,15}[^.]{0,80}\.",
    r"(?i)link in the (description|bio)[^.]{0,60}\.",
    r"(?i)thank you (so much )?to [A-Z][\w .]{2,30} for sponsoring[^.]{0,60}\.",
)
ANCHOR_SECONDS = 30


def clock_seconds(stamp: Column) -> Column:
    """h:mm:ss or m:ss as seconds."""
    return F.aggregate(F.split(stamp, ":"), F.lit(0), lambda acc, x: acc * 60 + x.cast("int"))


def _trim_dashes(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(c), r"^[-–—]+|[-–—]+$", ""))


def chapters(description: str | Column) -> Column:
    """Array of struct(sec, label): chapter lines whose times increase; NULL-free, and empty
    when fewer than two remain. A time that does not pass the last kept one is prose."""
    d = F.coalesce(col(description), F.lit(""))
    pairs = F.arrays_zip(F.regexp_extract_all(d, F.lit(CHAPTER), F.lit(1)).alias("t"), F.regexp_extract_all(d, F.lit(CHAPTER), F.lit(2)).alias("l"))
    items = F.transform(pairs, lambda p: F.struct(clock_seconds(p["t"]).alias("sec"), _trim_dashes(p["l"]).alias("label")))
    low = lambda x: F.lower(x["label"])
    items = F.filter(items, lambda x: (x["label"] != "") & ~F.startswith(low(x), F.lit("http")) & ~F.startswith(x["label"], F.lit("▶")))
    start = F.struct(F.lit(-1).alias("last"), F.array().cast("array<struct<sec:int,label:string>>").alias("kept"))
    kept = F.aggregate(items, start, lambda acc, x: F.when(
        x["sec"] > acc["last"], F.struct(x["sec"].alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc), lambda acc: acc["kept"])
    return F.when(F.size(kept) >= 2, kept).otherwise(F.array().cast("array<struct<sec:int,label:string>>"))


def strip_sponsors(text: str | Column) -> Column:
    """Text without read-out codes, link pointers and sponsor thanks."""
    out = reduce(lambda acc, p: F.regexp_replace(acc, p, " "), SPONSOR, col(text))
    return F.regexp_replace(out, r"\s{3,}", "  ")


def clock(seconds: Column) -> Column:
    """Stamp of a position: m:ss, or h:mm:ss from one hour on."""
    s = F.floor(seconds).cast("int")
    h, m, r = F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int"), s % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), two(m), F.lit(":"), two(r))).otherwise(F.concat(m.cast("string"), F.lit(":"), two(r)))


def transcript_piece(start: Column, text: Column, stamped: Column) -> Column:
    """What one segment adds to a transcript: its text on one line, behind a stamp on a new line where it gets one."""
    body = F.concat(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit(" "))
    return F.when(stamped, F.concat(F.lit("\n["), clock(start), F.lit("] "), body)).otherwise(body)


def clean_ticker(ticker: str | Column, company: str | Column) -> Column:
    """Ticker in capitals; empty when it echoes the company or is not ticker shaped."""
    t = F.upper(F.trim(F.coalesce(col(ticker), F.lit(""))))
    root = F.substring_index(t, ".", 1)
    ok = (t != "") & (t != F.upper(F.trim(col(company)))) & root.rlike(r"^[A-Z0-9]{1,6}$")
    return F.when(ok, t).otherwise("")
