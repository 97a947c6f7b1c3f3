"""Near-duplicates by shared word shingles: every pair of texts whose sets of ``WORDS``-word shingles have a Jaccard similarity of
``SIMILARITY`` or more links, and groups are what links reach. Nothing is estimated, so no such pair is missed.

The fingerprints of ``simhash``, over shingles of the same length, propose the first pairs through its pivot tables. Alone they would miss
most: at similarity 0.8 two fingerprints differ in about 10 bits of 64, and a radius that reaches most of them leaves pigeonhole keys of a
few bits. Prefixes of the sets propose the rest, and whole sets decide about every pair:

1. Shingles have one order for all texts: those frequent in a sample of texts last, else by hash. Of n shingles the first
   n - ceil(s n) + 1 are a text's prefix; two texts of similarity s share a shingle of their prefixes.
2. Every text has a fingerprint, whether or not it shares a shingle. Texts whose fingerprints are linked are compared as whole sets, as many pairs
   as the spanning forests of ``simhash.links`` have, and one for each copy of a fingerprint.
3. Each shingle that several texts have names one of them, its hub; a text is compared, as a whole set, with the hub that most of its shingles
   name. This links the texts of a template or a copied page with one pair each.
4. Where more than ``FEW`` texts meet at a shingle, each is compared with the one whose sketch is most like its own, in rounds between the groups that
   links have made so far. A sketch is the parity of a set's hashes in each of 256 bins; it differs in no more bins than sets differ in shingles.
5. Texts that share prefix shingles meet in blocks of about ``BLOCK``, pairs of blocks in separate tasks; two that are linked already are
   no pair. Another pair is let through where its sizes and its number of shared prefix shingles allow the similarity: all shared shingles up
   to the end of the shorter prefix were counted, and what lies beyond it is bounded by the rest of that text. Where more than ``FEW`` texts meet, sketches must allow it too.
6. Pairs that are left are compared as whole sets, in rounds. While they are more than the texts, each group that links have made so far takes one
   pair, and pairs within a group are dropped after the round. When they are few, or a round has linked nothing, all that are left are compared.

Equal texts are one node from the start; null and wordless texts are one node too. Texts and shingles are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common as c, simhash

WORDS = 5
SIMILARITY = 0.8
BLOCK = 2000
#: One text in ``SAMPLE`` is looked at for frequent shingles; they are in ``FREQUENT`` of these texts or more. The order needs no exact counts.
SAMPLE = 64
FREQUENT = 8
FREQUENT_MOST = 1_000_000
#: Pairs looked at in one step inside a task.
PAIRS = 1 << 20
#: Texts that may meet at a shingle without their sketches.
FEW = 16
#: Another round of nearest texts is made where one in so many pairs of a round has the similarity.
USEFUL = 8
SKETCH = ["m0", "m1", "m2", "m3"]


def node(text: Column) -> Column:
    """64-bit name of a text; 0 for texts without a word."""
    return F.when(text.rlike(r"[^\x09-\x0D ]"), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of shingle hashes of a text, sorted."""
    return np.unique(np.array(simhash.shingle_hashes(text, words), np.uint64))


def prefixes(texts: DataFrame, words: int, similarity: Fraction | None, frequent=None) -> DataFrame:
    """(h, node, n): prefix shingles of each text of (node, text), and the size of its set. No similarity: all shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value if frequent is not None else np.zeros(0, np.uint64)
        for batch in batches:
            for part in c.slices(batch, "text", 1 << 20):
                out, sizes = [], []
                for text in part.column(1).to_pylist():
                    own = shingles(text, words)
                    sizes.append(len(own))
                    if similarity is not None and len(own):
                        if len(last):
                            late = last[np.minimum(np.searchsorted(last, own), len(last) - 1)] == own
                            own = np.concatenate([own[~late], own[late]])
                        own = own[:len(own) - -(-similarity.numerator * len(own) // similarity.denominator) + 1]
                    out.append(own)
                taken = [len(x) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(np.asarray(part.column(0), np.int64), taken)),
                     pa.array(np.repeat(np.array(sizes, np.int32), taken))], ["h", "node", "n"])

    return texts.mapInArrow(c.frugal(run), "h long, node long, n int")


def sketch(own: np.ndarray) -> np.ndarray:
    """256 bits: whether an odd number of hashes falls into each bin."""
    return np.packbits(np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=256) & 1).view(np.int64)


def signatures(texts: DataFrame, words: int) -> DataFrame:
    """(node, simhash, m0 .. m3) of each text of (node, text): its fingerprint and the sketch of its set."""
    def work(column: pa.Array) -> list[pa.Array]:
        held = column.to_pylist()
        bits = np.stack([sketch(shingles(t, words)) for t in held])
        return [pa.array(simhash.fingerprints(held, words).view(np.int64)), *[pa.array(bits[:, k]) for k in range(len(SKETCH))]]

    return c.with_columns(texts.select("node", "text"), "text", [(x, "long", pa.int64()) for x in ["simhash", *SKETCH]], lambda: work).drop("text")


def frequent_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes of at most ``FREQUENT_MOST`` shingles that many texts of a sample have."""
    sample = prefixes(texts.where(F.pmod("node", F.lit(SAMPLE)) == 0).dropDuplicates(["node"]), words, None)
    found = (sample.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= FREQUENT)
             .orderBy(F.desc("c"), "h").limit(FREQUENT_MOST).select("h").toArrow())
    return np.sort(np.asarray(found["h"], np.int64).view(np.uint64))


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, node, n, size, hub, hub_n) of the shingles that more than one node has; rows (h, node, n) come sorted. The hub is the smallest node."""
    def shared(part: np.ndarray) -> pa.RecordBatch:
        first = np.r_[True, (part[:2, 1:] != part[:2, :-1]).any(0)] if part.shape[1] else np.zeros(0, bool)
        part = part[:, first]
        new = np.flatnonzero(np.r_[True, part[0, 1:] != part[0, :-1]]) if part.shape[1] else np.zeros(0, np.int64)
        size = np.diff(np.r_[new, part.shape[1]])
        each, hub = np.repeat(size, size), np.repeat(part[1:, new], size, axis=1)
        several = each > 1
        part, hub = part[:, several], hub[:, several]
        return pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1]), pa.array(part[2].astype(np.int32)), pa.array(each[several]), pa.array(hub[0]),
                                           pa.array(hub[1].astype(np.int32))], ["h", "node", "n", "size", "hub", "hub_n"])

    rest = np.zeros((3, 0), np.int64)
    for batch in batches:
        part = np.concatenate([rest, np.stack([np.asarray(x, np.int64) for x in batch.columns])], 1)
        change = np.flatnonzero(part[0, 1:] != part[0, :-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield shared(part[:, :cut])
        rest = part[:, cut:]
    yield shared(rest)


def meeting(similarity: Fraction, nearest: bool = False):
    """Pairs (a, b, na, nb) of rows (h, low, high, side, node, n, root, m0 .. m3) that meet, have two roots and sizes and sketches that allow the
    similarity, with how often they met (k). ``nearest``: of each row only the pair of most equal sketches, whose equal bits are k."""
    p, q = similarity.numerator, similarity.denominator

    def pairs(part: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = part.shape[1]
        if not n:
            return
        starts = np.flatnonzero(np.r_[True, (part[:3, 1:] != part[:3, :-1]).any(0)])
        ends = np.r_[starts[1:], n]
        run = np.repeat(np.arange(len(starts)), ends - starts)
        crossing = part[1] != part[2]
        second = starts + np.add.reduceat((part[3] == 0).astype(np.int64), starts)
        first = np.where(crossing, second[run], np.arange(n) + 1)
        counts = np.maximum(np.where(crossing & (part[3] == 1), 0, ends[run]) - first, 0)
        total = np.cumsum(counts)
        start = 0
        while start < n:
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + PAIRS, "right")))
            k = counts[start:stop]
            i, j = np.repeat(np.arange(start, start + len(k)), k), c.ranges(first[start:stop], k)
            ni, nj = part[5][i], part[5][j]
            keep = (q * np.minimum(ni, nj) >= p * np.maximum(ni, nj)) & (part[6][i] != part[6][j])
            i, j = i[keep], j[keep]
            # sets of the similarity differ in at most (q - p) / (q + p) of their sizes
            differ = sum(np.bitwise_count((part[m][i] ^ part[m][j]).view(np.uint64)).astype(np.int64) for m in range(7, 11))
            keep = differ * (p + q) <= (part[5][i] + part[5][j]) * (q - p)
            i, j = i[keep], j[keep]
            if nearest:
                order = np.lexsort((differ[keep], i))
                own = order[np.r_[True, i[order][1:] != i[order][:-1]]] if len(i) else order
                i, j, equal = i[own], j[own], 256 - differ[keep][own]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part[4][i], part[4][j], part[5][i], part[5][j], equal)], ["a", "b", "na", "nb", "k"])
                start = stop
                continue
            i, j = np.where(part[4][i] < part[4][j], i, j), np.where(part[4][i] < part[4][j], j, i)
            order = np.lexsort((part[4][j], part[4][i]))
            i, j = i[order], j[order]
            new = np.flatnonzero(np.r_[True, (part[4][i][1:] != part[4][i][:-1]) | (part[4][j][1:] != part[4][j][:-1])]) if len(i) else i
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[4][i[new]]), pa.array(part[4][j[new]]), pa.array(part[5][i[new]]), pa.array(part[5][j[new]]),
                 pa.array(np.diff(np.r_[new, len(i)]))], ["a", "b", "na", "nb", "k"])
            start = stop

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((7 + len(SKETCH), 0), np.int64)
        for batch in batches:
            part = np.concatenate([rest, np.stack([np.asarray(x, np.int64) for x in batch.columns])], 1)
            change = np.flatnonzero((part[:3, 1:] != part[:3, :-1]).any(0))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield from pairs(part[:, :cut])
            rest = part[:, cut:]
        yield from pairs(rest)
    return work


def shared_shingles(texts: DataFrame, words: int, similarity: Fraction) -> DataFrame:
    """(h, node, n, size, hub, hub_n): prefix shingles that several nodes have, stored."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, words))
    rows = prefixes(texts, words, similarity, shared).repartition("h").sortWithinPartitions("h", "node")
    return c.stored(rows.mapInArrow(c.frugal(repeated), "h long, node long, n int, size long, hub long, hub_n int"), "shingles")


def hub_pairs(rows: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b) of each node and the hub that most of its shingles name, of those whose size allows the similarity."""
    p, q = similarity.numerator, similarity.denominator
    fits = F.least("n", "hub_n") * q >= F.greatest("n", "hub_n") * p
    named = rows.where((F.col("node") != F.col("hub")) & fits).select("node", "hub").repartition("node").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("k"))
    best = named.groupBy("node").agg(F.max_by("hub", "k").alias("hub"))
    return best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def fingerprint_pairs(marked: DataFrame) -> DataFrame:
    """(a, b) of nodes whose fingerprints are linked: the forests of ``simhash.links`` between fingerprints, and each copy of one with its smallest node."""
    each = marked.groupBy("simhash").agg(F.min("node").alias("least"))
    name = lambda x: each.select(F.col("simhash").alias(x), F.col("least").alias(f"node_{x}"))
    between = simhash.links(marked.select("simhash")).distinct().join(name("a"), "a").join(name("b"), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    copies = marked.select("node", "simhash").join(each, "simhash").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    return between.unionByName(copies).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def dealt(rows: DataFrame, roots: DataFrame, marked: DataFrame) -> DataFrame:
    """(h, low, high, side, node, n, root, m0 .. m3): the rows that meet at a shingle, by tasks of at most two blocks."""
    roots = roots.select(F.col("node").alias("linked"), "root")
    rows = rows.join(roots, rows["node"] == roots["linked"], "left").withColumn("root", F.coalesce("root", "node"))
    marked = marked.select(F.col("node").alias("linked_too"), *SKETCH)
    many = rows.where(F.col("size") > FEW)
    many = many.join(marked, many["node"] == marked["linked_too"]).select("h", "node", "n", "size", "root", *SKETCH)
    few = rows.where(F.col("size") <= FEW).select("h", "node", "n", "size", "root", *[F.lit(0).cast("long").alias(m) for m in SKETCH])
    rows = many.unionByName(few)
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # rows of block k meet those of block m in task (min, max), and each other in task (k, k)
    tasks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda m: F.struct(
        F.least(m, F.col("block")).alias("low"), F.greatest(m, F.col("block")).alias("high"), (m < F.col("block")).cast("long").alias("side")))
    rows = rows.select("h", F.explode(tasks).alias("task"), "node", "n", "root", *SKETCH).select("h", "task.low", "task.high", "task.side", "node", "n", "root", *SKETCH)
    return rows.repartition("h", "low", "high").sortWithinPartitions("h", "low", "high", "side")


def nearest_pairs(rows: DataFrame, roots: DataFrame, marked: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b): for each node that meets many, one of another root and the most equal sketch."""
    named = dealt(rows.where(F.col("size") > FEW), roots, marked).mapInArrow(c.frugal(meeting(similarity, True)), "a long, b long, na long, nb long, k long")
    best = named.groupBy("a").agg(F.max_by("b", "k").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def candidates(rows: DataFrame, roots: DataFrame, marked: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs (a, b) of nodes, a < b, that may have the similarity and are not of one root, and how many prefix shingles they share (k)."""
    p, q = similarity.numerator, similarity.denominator
    met = (dealt(rows, roots, marked).mapInArrow(c.frugal(meeting(similarity)), "a long, b long, na long, nb long, k long")
           .groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("k").alias("k")))
    beyond = lambda n: F.ceil(F.col(n) * F.lit(p) / F.lit(q)) - 1
    # (p + q) shared >= p (na + nb), and shared is at most what was counted and the rest of one text
    return met.where((F.col("k") + F.greatest(beyond("na"), beyond("nb")) + 1) * (p + q) >= (F.col("na") + F.col("nb")) * p).select("a", "b", "k")


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets have the similarity."""
    p, q = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in c.slices(batch, "one"):
                keep = []
                for x, y in zip(part.column("one"), part.column("other")):
                    x, y = shingles(x.as_py(), words), shingles(y.as_py(), words)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both * q >= p * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # both sides rename both columns, so that Spark knows one shuffle of the texts serves both
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "one", "other").mapInArrow(c.frugal(run), c.EDGE)


def between_groups(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b, k) of two groups, with the larger root of the two (y)."""
    root = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    pairs = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left").withColumns(
        {"root_a": F.coalesce("root_a", "a"), "root_b": F.coalesce("root_b", "b")})
    return pairs.where("root_a <> root_b").select("a", "b", "k", F.greatest("root_a", "root_b").alias("y"))


def links(texts: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) between nodes of (node, text) that connect every group of texts of the similarity."""
    share = Fraction(str(similarity))
    texts = texts.where("node <> 0")
    rows = shared_shingles(texts, words, share)
    marked = c.stored(signatures(texts, words).dropDuplicates(["node"]), "signatures")
    first = c.stored(hub_pairs(rows, share).unionByName(fingerprint_pairs(marked)).distinct(), "first")
    met = rows.select("node").unionByName(first.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    needed = c.stored(texts.join(met, "node", "left_semi").dropDuplicates(["node"]), "texts")
    near = c.stored(verified(first, needed, words, share), "near")
    roots, linked = c.components(near), True
    while linked:
        close = c.stored(nearest_pairs(rows, roots, marked, share), "close")
        new = c.stored(verified(close, needed, words, share), "near")
        linked = new.count() * USEFUL > close.count()
        near = near.unionByName(new)
        roots = c.components(near) if linked else roots
    most = needed.count()
    found = c.stored(candidates(rows, roots, marked, share).withColumn("y", F.col("b")), "candidates")
    left, linked = found.count(), True
    while left > most and linked:
        best = c.stored(found.groupBy("y").agg(F.max(F.struct("k", "a", "b")).alias("best")).select("best.a", "best.b"), "best")
        new = c.stored(verified(best, needed, words, share), "near")
        near = near.unionByName(new)
        linked = not new.isEmpty()
        untried = found.drop("y").join(best, ["a", "b"], "left_anti")
        found = c.stored(between_groups(untried, c.components(near)), "open")
        left = found.count()
    return near.unionByName(c.stored(verified(found.select("a", "b"), needed, words, share), "near"))


def kept(df: DataFrame, doc: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``df`` with the document of smallest id of each group only; rows without an id stay."""
    rows = df.select(F.col(doc).alias("doc_id"), node(F.col(text)).alias("node"), F.col(text).alias("text"))
    roots = c.components(links(rows.select("node", "text"), words, similarity)).select("node", "root")
    each = rows.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left")
    each = c.stored(each.select(F.col("node").alias("_node"), F.coalesce("root", "node").alias("_root"), "least"), "groups")
    first = each.groupBy("_root").agg(F.min("least").alias("_first"))
    owners = each.join(first, "_root").where("least = _first").select("_node", "_first")
    named = df.join(owners, (df[doc] == owners["_first"]) & (node(df[text]) == owners["_node"]), "left_semi")
    return named.unionByName(df.where(df[doc].isNull()))
