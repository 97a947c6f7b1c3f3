"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become sequences of word hashes (lower case; words are runs of ASCII letters, ASCII digits and
all other non-ASCII characters). A mask picks some of the next words and ignores the others; the hash of the picked
ones is a seed. Seeds of all documents meet those of the items, and around each hit the two sequences are laid side by side: a document
leaks an item when a window of ``WINDOW`` words agrees in all but ``SUBSTITUTIONS``. The two masks together
hit every such window, wherever the substitutions fall. Items of ``SHORTEST`` to ``WINDOW`` - 1 words
must occur whole and unchanged; shorter ones say nothing and match nothing.

The item side travels to the tasks in blocks of about ``BLOCK_WORDS`` words, checked by count. One block is one pass over the documents, which
are not shuffled. With several, the documents are written once with a row number, each block makes a pass of its own that writes the
leaks it finds and is then given up, and the leaks are joined to the documents at the end: a larger benchmark takes more passes, no more memory.

Null and empty texts leak nothing. Equal items are all reported.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common as c

MASKS = ("11101011", "11001111")
WINDOW = 13
SUBSTITUTIONS = 2
SHORTEST = 8
BLOCK_WORDS = 4_000_000
PAIRS = 1 << 16

LEAK = "array<struct<item_id: bigint, first_word: int, last_word: int, agreeing: int>>"
LEAK_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int32()), ("last_word", pa.int32()), ("agreeing", pa.int32())]))


def word_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the first word of each text (one more than texts)."""
    data, at = c.bytes_of(pc.utf8_lower(texts))
    starts, ends, first = c.words(data, at, c.ALNUM)
    return c.word_hashes(data, starts, ends), first


def seeds(words: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash under a mask at every place from which the mask fits into its text, and those places."""
    span = len(mask)
    places = c.ranges(first[:-1], np.maximum(np.diff(first) - span + 1, 0))
    h = np.full(len(places), span, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h = h * np.uint64(c.BASE) + words[places + k]
    return c.mixed(h), places


class Items:
    """Seeds and words of a block of benchmark items."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> None:
        self.ids, self.words, self.sizes = ids, words, sizes
        self.first = np.r_[0, np.cumsum(sizes)]
        self.of = np.repeat(np.arange(len(ids)), sizes)
        self.tables = []
        groups = [(m, sizes >= WINDOW) for m in MASKS] if len(ids) else []
        groups += [("1" * n, sizes == n) for n in range(SHORTEST, WINDOW) if (sizes == n).any()]
        for mask, wanted in groups:
            h, places = seeds(words, self.first, mask)
            chosen = wanted[self.of[places]] if len(places) else np.zeros(0, bool)
            order = np.argsort(h[chosen], kind="stable")
            h, places = h[chosen][order], places[chosen][order]
            if not len(h):
                continue
            bits = max(16, min(26, int(len(h) * 32).bit_length()))
            filled = np.zeros(1 << bits, bool)
            filled[h >> np.uint64(64 - bits)] = True
            self.tables.append((mask, bits, filled, h, places))

    def leaks(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, first word, last word, agreeing words) of each leak, by text and item."""
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        found: list[np.ndarray] = []
        for mask, bits, filled, table, item_places in self.tables:
            h, places = seeds(words, first, mask)
            maybe = filled[h >> np.uint64(64 - bits)]
            h, places = h[maybe], places[maybe]
            low, high = np.searchsorted(table, h, "left"), np.searchsorted(table, h, "right")
            hit = high > low
            low, n, places = low[hit], (high - low)[hit], places[hit]
            cuts = np.flatnonzero(np.diff(np.cumsum(n) // PAIRS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(n)]):
                if b > a:
                    found.append(self.verified(words, first, owner, np.repeat(places[a:b], n[a:b]),
                                               item_places[c.ranges(low[a:b], n[a:b])], len(mask)))
        if not found:
            return (np.zeros(0, np.int64),) * 5
        text, item, start, stop, score = np.concatenate(found, 1)
        order = np.lexsort((start, item, text))
        text, item, start, stop, score = text[order], item[order], start[order], stop[order], score[order]
        if not len(text):
            return text, item, start, stop, score
        new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])])
        return (text[new], item[new], np.minimum.reduceat(start, new), np.maximum.reduceat(stop, new),
                np.maximum.reduceat(score, new))

    def verified(self, words, first, owner, place, item_place, span: int) -> np.ndarray:
        """Hits whose neighbourhood holds a window that agrees well enough, with the words it covers in the text."""
        text, item = owner[place], self.of[item_place]
        short = self.sizes[item] < WINDOW
        reach = np.arange(-(WINDOW - 1), span + WINDOW - 1)
        x, y = place[:, None] + reach, item_place[:, None] + reach
        inside = ((x >= first[text][:, None]) & (x < first[text + 1][:, None])
                  & (y >= self.first[item][:, None]) & (y < self.first[item + 1][:, None]))
        same = np.zeros(x.shape, np.int32)
        same[inside] = words[x[inside]] == self.words[y[inside]]
        sums = np.cumsum(np.pad(same, ((0, 0), (1, 0))), 1)
        window = sums[:, WINDOW:] - sums[:, :-WINDOW]
        good = window >= WINDOW - SUBSTITUTIONS
        begin = np.where(short, place, place + reach[0] + good.argmax(1))
        end = np.where(short, place + span, place + reach[0] + good.shape[1] - good[:, ::-1].argmax(1) - 1 + WINDOW)
        whole = same[:, WINDOW - 1:WINDOW - 1 + span].all(1)
        keep = np.where(short, whole & (self.sizes[item] == span), good.any(1))
        best = np.where(short, span, window.max(1))
        start = first[text]
        return np.stack([text, item, np.maximum(begin - start, 0), np.minimum(end, first[text + 1]) - 1 - start, best])[:, keep].astype(np.int64)


def item_blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> tuple[int, Iterator[Items]]:
    """How many blocks of about ``block_words`` words the items make, and the blocks, brought to the driver one by one."""
    def hashed(batches):
        for batch in batches:
            words, first = word_arrays(c.text_array(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), c.lists(words.view(np.int64), np.diff(first), pa.int64())], ["item_id", "words"])

    rows = c.stored(benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
                    .mapInArrow(c.frugal(hashed), "item_id long, words array<long>").where(F.size("words") >= SHORTEST), "items")
    total = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))

    def block(k: int) -> Items:
        part = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k).toArrow().combine_chunks()
        lists = part["words"].combine_chunks()
        ids = part["item_id"].combine_chunks()
        return Items(np.asarray(ids.fill_null(-1), np.int64), np.asarray(pc.list_flatten(lists), np.int64).view(np.uint64),
                     np.asarray(pc.list_value_length(lists), np.int64))

    return blocks, (block(k) for k in range(blocks))


def block_leaks(df: DataFrame, shared: Broadcast, text: str, out: str) -> DataFrame:
    """``df`` with the leaks of one block of items."""
    def make():
        block = shared.value

        def work(column: pa.Array) -> list[pa.Array]:
            words, first = word_arrays(c.text_array(column))
            owner, which, start, stop, score = block.leaks(words, first)
            rows = pa.StructArray.from_arrays([pa.array(block.ids[which]), pa.array(start, pa.int32()), pa.array(stop, pa.int32()),
                                               pa.array(score, pa.int32())], fields=list(LEAK_ARROW.value_type))
            at = np.searchsorted(owner, np.arange(len(column) + 1)).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(at), rows)]
        return work

    return c.with_columns(df, text, [(out, LEAK, LEAK_ARROW)], make)


def with_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
               out: str = "leaks", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``df`` with the items that each text leaks: item_id, first and last word of the text concerned, words agreeing in the best window.

    The list is empty for clean texts. Items without an id are reported as -1.
    """
    blocks, items = item_blocks(benchmark, item, item_text, block_words)
    share = df.sparkSession.sparkContext.broadcast
    found = c.fresh("_leaks", df)
    kept = [F.col(f"`{x}`") for x in df.columns if x != out]
    if blocks == 1:
        return block_leaks(df, share(next(items)), text, found).select(*kept, F.col(found).alias(out))
    row, parts = c.fresh("_row", df), []
    docs = c.stored(df.withColumn(row, F.monotonically_increasing_id()), "documents")
    texts = docs.select(row, F.col(f"`{text}`").alias("text"))
    for k, block in enumerate(items):
        shared = share(block)
        leaks = block_leaks(texts, shared, "text", found).where(F.size(found) > 0).select(row, F.lit(k).alias("block"), found)
        parts.append(c.stored(leaks, "leaks"))
        shared.destroy()
    by_block = F.array_sort(F.collect_list(F.struct("block", found)))
    one = reduce(DataFrame.unionByName, parts).groupBy(row).agg(F.flatten(F.transform(by_block, lambda x: x[found])).alias(found))
    return docs.join(one, row, "left").select(*kept, F.coalesce(F.col(found), F.array().cast(LEAK)).alias(out))


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``df`` that leak no item, with their own columns."""
    leaks = c.fresh("_leaks", df)
    return with_leaks(df, benchmark, text, out=leaks).where(F.size(leaks) == 0).select(*[F.col(f"`{x}`") for x in df.columns])
