"""SimHash near-duplicates of 64-bit fingerprints, with pivot distance tables.

A fingerprint has a bit set where over half of the hashes of a text's 3-word shingles have it set.
Fingerprints link at ``RADIUS`` or fewer differing bits; groups are what links reach.

Pairs are proposed, discarded, and verified:

1. Of ``BLOCKS`` groups of bits, two fingerprints within the radius share at least ``BLOCKS - RADIUS`` whole ones. The distances
   to the reference fingerprints that have a single bit of such groups set, less the distance to the zero reference, are those bits;
   rows whose coordinates agree on one choice of groups meet in one bucket.
2. The table of Hamming distances to ``PIVOTS`` reference fingerprints is computed once per fingerprint. By the triangle
   inequality a pair whose largest coordinate difference exceeds the radius is discarded.
3. Survivors are compared bit by bit.

Pivot distances alone can't propose pairs here: between 64-bit codes they lie within a few units of 32.

Copies share a fingerprint and are one row from the start. Buckets are cut into blocks of about ``BLOCK`` rows, and pairs of blocks
are compared in separate tasks; a task returns a spanning forest of its links, never all pairs.
Null and wordless texts have fingerprint zero and link like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import xxhash

from tidemark.llm import common as c

RADIUS = 3
BLOCKS = 5
PIVOTS = 16
BLOCK = 2000
SEED = 42
FLUSH = 1 << 19
#: Pairs looked at in one step inside a task.
PAIRS = 1 << 19

EDGES = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
#: Reference fingerprints: fixed, far from each other.
REFERENCES = c.mixed(np.arange(1001, 1001 + PIVOTS, dtype=np.uint64))


def shingle_hashes(text: str | None, n: int = 3) -> list[int]:
    """XXH64 of every run of n words; of all words where there are fewer, of none where there is none."""
    words = (text or "").encode().lower().split()
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(n))))]


def fingerprints(texts: list[str | None], words: int = 3) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text, of shingles of ``words`` words. Hashes are counted in flat arrays of about ``FLUSH``."""
    ones = np.zeros((len(texts), 64), np.int64)
    total = np.zeros(len(texts), np.int64)
    held: list[int] = []
    rows: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        if held:
            h = np.array(held, np.uint64)
            starts = np.cumsum(sizes) - sizes
            for b in range(64):
                bit = ((h >> np.uint64(b)) & np.uint64(1)).astype(np.int32)
                ones[rows, b] += np.add.reduceat(bit, starts)
            held.clear(), rows.clear(), sizes.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, words)
        total[i] = len(hashes)
        for k in range(0, len(hashes), FLUSH):
            part = hashes[k:k + FLUSH]
            held += part
            rows.append(i)
            sizes.append(len(part))
            if len(held) >= FLUSH:
                flush()
    flush()
    bits = (2 * ones > total[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "simhash", words: int = 3) -> DataFrame:
    """``df`` with the fingerprint of each text as a long (the same 64 bits)."""
    return c.with_columns(df, text, [(out, "long", pa.int64())],
                          lambda: lambda column: [pa.array(fingerprints(column.to_pylist(), words).view(np.int64))])


def bucket_keys(out: str) -> F.Column:
    """A struct for each choice of groups of bits: which choice, and the bits of the fingerprint in it."""
    masks = []
    for chosen in combinations(range(BLOCKS), BLOCKS - RADIUS):
        mask = 0
        for k in chosen:
            mask |= (1 << EDGES[k + 1]) - (1 << EDGES[k])
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.struct(F.lit(k).alias("choice"), F.col(out).bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(masks)])


def distances(prints: np.ndarray) -> np.ndarray:
    """The pivot table: a row of ``PIVOTS`` Hamming distances for each fingerprint."""
    return np.bitwise_count(prints[:, None] ^ REFERENCES[None, :]).astype(np.int8)


def linked(prints: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the radius of each row i and the rows first[i] .. last[i] - 1."""
    table = distances(prints)
    counts = np.maximum(last - first, 0)
    total = np.cumsum(counts)
    start = 0
    while start < len(prints):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + PAIRS, "right")))
        n = counts[start:stop]
        i, j = np.repeat(np.arange(start, start + len(n)), n), c.ranges(first[start:stop], n)
        for p in range(PIVOTS):
            keep = np.abs(table[i, p] - table[j, p]) <= RADIUS
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(prints[i] ^ prints[j]) <= RADIUS
        yield i[keep], j[keep]
        start = stop


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the links of each batch; rows (choice, bits, low, high, side, print) come sorted, so tasks are runs.

    The last run of a batch waits for the rest of its rows; a run has at most a few blocks.
    """
    def edges(part: np.ndarray) -> pa.RecordBatch:
        n = part.shape[1]
        new = np.r_[True, (part[:4, 1:] != part[:4, :-1]).any(0)] if n else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], n]
        run = np.cumsum(new) - 1
        crossing = part[2] != part[3]
        second = starts + np.add.reduceat((part[4] == 0).astype(np.int64), starts) if n else starts
        first = np.where(crossing, second[run], np.arange(n) + 1)
        last = np.where(crossing & (part[4] == 1), 0, ends[run])
        forest = c.Forest()
        names = part[5].tolist()
        for i, j in linked(part[5].view(np.uint64), first, last):
            for x, y in zip(i.tolist(), j.tolist()):
                forest.link(names[x], names[y])
        a, b = forest.edges()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rest = np.zeros((6, 0), np.int64)
    for batch in batches:
        part = np.concatenate([rest, np.stack([np.asarray(x, np.int64) for x in batch.columns])], 1)
        change = np.flatnonzero((part[:4, 1:] != part[:4, :-1]).any(0))
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield edges(part[:, :cut])
        rest = part[:, cut:]
    yield edges(rest)


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between different values of ``simhash``: a spanning forest of the links that each task finds."""
    rows = prints.select("simhash").distinct().select("simhash", F.explode(bucket_keys("simhash")).alias("key"))
    rows = rows.select("simhash", F.col("key.choice").alias("choice"), F.col("key.bits").alias("bits"))
    sizes = rows.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["choice", "bits"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("simhash"), F.col("blocks")))
    # rows of block k meet those of block m in task (min, max), and each other in task (k, k)
    tasks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda m: F.struct(
        F.least(m, F.col("block")).alias("low"), F.greatest(m, F.col("block")).alias("high"),
        (m < F.col("block")).cast("long").alias("side")))
    rows = (rows.select("choice", "bits", F.explode(tasks).alias("task"), "simhash")
            .select(F.col("choice").cast("long").alias("choice"), "bits", "task.low", "task.high", "task.side", "simhash"))
    keys = ["choice", "bits", "low", "high"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(compared, c.EDGE)


def grouped(prints: DataFrame) -> DataFrame:
    """doc_id, simhash and component_id of rows (doc_id, simhash)."""
    each = prints.groupBy("simhash").agg(F.min("doc_id").alias("least"))
    roots = c.components(links(prints))
    each = each.join(roots, each["simhash"] == roots["node"], "left").select(
        "simhash", F.coalesce("root", "simhash").alias("root"), "least")
    least = each.groupBy("root").agg(F.min("least").alias("component_id"))
    each = each.join(least, "root").select(F.col("simhash").alias("print"), "component_id")
    return prints.join(each, prints["simhash"] == each["print"]).select("doc_id", "simhash", "component_id")


def components(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, simhash and component_id (the smallest document reachable by links of fingerprints) of every row.

    Rows without a document id get the component of their fingerprint and never name one.
    """
    rows = df.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return grouped(c.stored(with_fingerprint(rows).select("doc_id", "simhash"), "simhash"))


def kept(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the document of smallest id of each group only; rows without an id stay."""
    groups = components(df, doc, text).where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    return df.join(groups, df[doc] == groups["_kept"], "left_semi").unionByName(df.where(df[doc].isNull()))
