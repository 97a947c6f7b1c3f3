"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text (16 bytes deep, two bits a byte). A chunk ends where the hash is the largest
within ``REACH`` bytes to either side, so ends depend on nearby bytes alone and an insertion shifts only the chunks it
touches; chunks have 16 bytes at least but at the ends of a text, about 32 on average, and ``LONGEST`` at most. Ends never fall inside a character.

Chunks are named by a 128-bit digest. A digest belongs to the smallest document id that has it, there to its first place; every
other occurrence is a repeat. Runs of repeats of ``SHORTEST`` bytes or more are removed: a passage of over 50 words
loses a chunk at either end at most and stays well above that, chance repeats of single chunks stay below.

The digests' owners come from one aggregation of two longs, combined on the map side. Chunks are then found again, and
only those that a bit table of repeated digests lets through (of fixed size; it may let others through) are joined with
their owners. Null texts are empty. Rows without an id lose what documents with one have. Rows of equal id and text share one result.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common as c, cuts

REACH = 15
LONGEST = 256
SHORTEST = 128
FILTER_BITS = 26
GAP = 32
PAD = 0xFF
NO_ID = (1 << 63) - 1

GEAR = (c.mixed(np.arange(501, 757, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
GEAR[PAD] = 0  # no byte of UTF-8; stands between texts


def chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, where each text begins, where chunks begin, and the text of each chunk."""
    data, at = c.bytes_of(texts)
    sizes = np.diff(at)
    n = len(sizes)
    padded = np.full(len(data) + GAP * (n + 1), PAD, np.uint8)
    shift = GAP * np.arange(1, n + 1)
    where = c.ranges(at[:-1] + shift, sizes)
    padded[where] = data
    h = GEAR[padded]
    for k in (1, 2, 4, 8):
        h[k:] += h[:-k] << np.uint32(2 * k)
    h[padded == PAD] = 0
    following = np.r_[padded[1:], PAD]
    h[(following & 0xC0) == 0x80] = 0  # the next byte goes on with a character
    largest = h.copy()
    for k in (1, 2, 4, 8):  # largest of the next 16
        np.maximum(largest[:-k], largest[k:], out=largest[:-k])
    end = (h > 0) & (h == largest)
    end[1:] &= h[1:] > np.r_[np.zeros(15, np.uint32), largest[:-1]][:len(h) - 1][:len(h)]  # and larger than the 15 before
    begins = np.zeros(len(padded) + 1, bool)
    begins[1:] = end
    begins[(at[:-1] + shift)[sizes > 0]] = True
    first = np.flatnonzero(begins[:-1][where])
    owner = np.searchsorted(at, first, "right") - 1
    stop = np.r_[first[1:], len(data)]
    if (long := np.flatnonzero(stop - first > LONGEST)).size:
        extra = []
        for a, b in zip(first[long].tolist(), stop[long].tolist()):
            for p in range(a + LONGEST, b, LONGEST):
                while p < b and data[p] & 0xC0 == 0x80:
                    p += 1
                if p < b:
                    extra.append(p)
        first = np.union1d(first, np.array(extra, np.int64))
        owner = np.searchsorted(at, first, "right") - 1
    return data, at, first, owner


def digests(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit halves of each chunk's digest (n x 2), its text, and where it starts and how long it is there."""
    data, at, first, owner = chunks(texts)
    raw = data.tobytes()
    stops = np.r_[first[1:], len(data)]
    both = b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), stops.tolist())])
    return np.frombuffer(both, "<i8").reshape(-1, 2), owner, first - at[owner], stops - first


def repeats_inside(d: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which chunks occurred before in their own text."""
    order = np.lexsort((d[:, 1], d[:, 0], owner))
    same = (d[order][1:] == d[order][:-1]).all(1) & (owner[order][1:] == owner[order][:-1])
    out = np.zeros(len(d), bool)
    out[order[1:]] = same
    return out


def owners(rows: DataFrame) -> DataFrame:
    """(d1, d2, owner) of every digest that more than one document has; rows have doc and text."""
    def run(batches):
        for batch in batches:
            for part in c.slices(batch, "text"):
                d, owner, _, _ = digests(c.text_array(part.column(2)))
                own = ~repeats_inside(d, owner)
                doc = np.asarray(part.column(0), np.int64)[owner[own]]
                yield pa.RecordBatch.from_arrays([pa.array(d[own, 0]), pa.array(d[own, 1]), pa.array(doc)], ["d1", "d2", "doc"])

    found = rows.mapInArrow(c.frugal(run), "d1 long, d2 long, doc long")
    return (found.groupBy("d1", "d2").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
            .where("owner < last").select("d1", "d2", "owner"))


def bit_table(repeated: DataFrame) -> np.ndarray:
    """Bits set at the first digits of the repeated digests: 8 MB at any size of the corpus."""
    place = F.shiftrightunsigned("d1", 64 - FILTER_BITS)
    words = (repeated.select(F.shiftright(place, 6).alias("w"), place.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("bits"))).toArrow()
    table = np.zeros(1 << FILTER_BITS - 6, np.int64)
    table[np.asarray(words["w"], np.int64)] = np.asarray(words["bits"], np.int64)
    return np.unpackbits(table.view(np.uint8), bitorder="little")


def spans(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text_key, spans): the repeated chunks of every text that has any."""
    rows = df.select(F.coalesce(F.col(doc).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_key"),
                     F.col(text).alias("text"))
    repeated = c.stored(owners(rows), "digests")
    packed = df.sparkSession.sparkContext.broadcast(np.packbits(bit_table(repeated)))

    def run(batches):
        bits = packed.value
        for batch in batches:
            for part in c.slices(batch, "text"):
                d, owner, start, size = digests(c.text_array(part.column(2)))
                inside = repeats_inside(d, owner)
                place = (d[:, 0].view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                keep = inside | ((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1)
                take = pa.array(owner[keep])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d[keep, 0]), pa.array(d[keep, 1]), part.column(0).take(take), part.column(1).take(take),
                     pa.array(start[keep]), pa.array(size[keep]), pa.array(inside[keep])],
                    ["d1", "d2", "doc", "text_key", "start", "size", "inside"])

    found = rows.mapInArrow(c.frugal(run), "d1 long, d2 long, doc long, text_key long, start long, size long, inside boolean")
    found = found.join(repeated, ["d1", "d2"], "left").where("inside or owner < doc")
    # a list per document, of no more chunks than its own text has
    return found.groupBy("doc", "text_key").agg(F.collect_set(F.struct("start", "size")).alias("spans"))


def without_repeats(df: DataFrame, doc: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``df`` with kept (binary), n_bytes, n_removed and n_spans: runs of repeated chunks are cut out."""
    return cuts.cut_found(df, spans(df, doc, text), doc, text, shortest)
