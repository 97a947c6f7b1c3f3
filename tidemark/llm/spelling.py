"""Spelling variants of words, found through an index of variable-length grams.

1. Gram dictionary: every gram of ``SHORTEST`` characters, and a longer one, up to ``LONGEST``, only where the gram without its last character
   is frequent (in more than a bound of distinct words). The bound grows with the corpus, so that at most ``FREQUENT`` grams of a length
   are frequent; only those are broadcast.
2. Every position of a word starts one gram, the longest of the dictionary. Which gram that is depends on its own characters only, so an
   edit affects the grams that contain it (and, at the end of a word, those that the end cut short).
3. Two words that differ by one edit share all grams that the edit does not affect, at equal places from the start before it and from
   the end after it. For each edit of a word the lists of its unaffected grams are merged: the index key is the
   set of them with their places, and only words in all these lists meet. A set leaves open at most the edited character and the
   ``LONGEST - 1`` before it, so the words at a key are bounded by the alphabet and not by the corpus.
4. Words that meet are verified. A pair is reported at one edit only: the place where two words of a length differ, or the first of the
   equal letters that one word has one more of. So no pair is found twice and counts add up.

A key is a sum of 64-bit hashes. Words beyond ``CARRIED`` characters travel as hashes and are joined with their texts before they are
verified. The best near word and the number of near words are combined before they are shuffled; roots are found by pointer doubling.

Null and empty texts have no runs; a null id counts as the empty text where a run is hashed; repeated rows count each; an
empty table gives an empty table; a run may be as long as its text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common as c

SHORTEST, LONGEST = 2, 4
#: Most frequent grams of one length, and the fewest words that make a gram frequent.
FREQUENT = 1 << 16
WORDS = 64
CARRIED = 64
#: Characters of words that one step indexes.
PART = 1 << 18
#: Pairs looked at in one step.
PAIRS = 1 << 18
ALPHABET = "A-Za-z\\u00C0-\\u00FF"

KEYED = "key long, gap boolean, place int, base int, n long, id long, word string"
NEAR = "id long, word string, other_id long, other string, n long, other_n long"


def runs(df: DataFrame, key: str, text: str, shortest: int, every: int) -> DataFrame:
    """(word): the lower-cased runs of letters of whole texts, one character deleted where ``every`` divides the run's hash."""
    lower = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lower, F.lit(f"[{ALPHABET}]{{{shortest},}}"), F.lit(0))  # a deletion makes no run longer
    rows = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(found).alias("run"))
    h = F.crc32(F.concat("k", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))


def words(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of distinct words of at least ``shortest`` characters and ``least`` occurrences."""
    return (runs(df, key, text, shortest, every).where(F.length("word") >= shortest)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the words in a row, one byte each, and where words begin; letters up to U+00FF only."""
    raw = [w.encode("latin-1") for w in column.to_pylist()]
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(w) for w in raw], out=at[1:])
    return np.frombuffer(b"".join(raw), np.uint8), at


def codes(data: np.ndarray, size: int) -> np.ndarray:
    """The gram of ``size`` characters at every place, as one number."""
    out = np.zeros(max(len(data) - size + 1, 0), np.uint32)
    for k in range(size):
        out = (out << np.uint32(8)) | data[k:len(data) - size + 1 + k]
    return out


def parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from c.slices(batch, column, PART, 1 << 16)


def frequent_grams(table: DataFrame) -> list[np.ndarray]:
    """Of each length but the longest the sorted grams that more distinct words have than the bound; ``FREQUENT`` at most."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, "word"):
            data, at = letters(part.column(0))
            for size in range(SHORTEST, LONGEST):
                lengths = np.maximum(np.diff(at) - size + 1, 0)
                of = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths) << np.uint64(32)
                own = np.unique(of | codes(data, size)[c.ranges(at[:-1], lengths)]) if lengths.sum() else of
                gram, n = np.unique(own.astype(np.uint32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), size, np.int32)), pa.array(gram.astype(np.int64)), pa.array(n)], ["size", "gram", "n"])

    total = table.agg(F.sum(F.length("word"))).first()[0] or 0
    bound = max(WORDS, total // FREQUENT)  # a length has at most `total` places of grams
    found = (table.select("word").mapInArrow(local, "size int, gram long, n long").groupBy("size", "gram").agg(F.sum("n").alias("n"))
             .where(F.col("n") > bound).select("size", "gram").toArrow())
    size, gram = np.asarray(found["size"], np.int32), np.asarray(found["gram"], np.int64).astype(np.uint32)
    return [np.sort(gram[size == s]) for s in range(SHORTEST, LONGEST)]


def member(grams: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(grams):
        return np.zeros(len(of), bool)
    return grams[np.minimum(np.searchsorted(grams, of), len(grams) - 1)] == of


def decomposed(data: np.ndarray, at: np.ndarray, frequent: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places that start a gram, the sizes and codes of their grams, and whether the end of the word cut them short."""
    own = np.repeat(np.arange(len(at) - 1), np.diff(at))
    places = np.arange(len(data))
    rest = at[1:][own] - places
    places = places[rest >= SHORTEST]
    rest = rest[places]
    sizes = np.full(len(places), SHORTEST, np.int64)
    growing = np.ones(len(places), bool)
    cut = np.zeros(len(places), bool)
    for size, grams in zip(range(SHORTEST, LONGEST), frequent):
        here = np.flatnonzero(growing)
        more = member(grams, codes(data, size)[places[here]])
        cut[here[more & (rest[here] == size)]] = True
        growing[here] = more & (rest[here] > size)
        sizes[growing] = size + 1
    padded = np.r_[data, np.zeros(LONGEST, np.uint8)].astype(np.uint64)
    code = sizes.astype(np.uint64)
    for k in range(LONGEST):
        code = (code << np.uint64(8)) | np.where(k < sizes, padded[places + k], np.uint64(0))
    return places, sizes, code, cut


def index_keys(data: np.ndarray, at: np.ndarray, frequent: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(word, key, gap, place, base) for each edit of each word: a character changed or lost at ``place``, or one put in before it (gap).

    ``base`` is the length without the edited character.
    """
    places, sizes, code, cut = decomposed(data, at, frequent)
    own = np.repeat(np.arange(len(at) - 1), np.diff(at))
    length = np.diff(at)
    first = places - at[:-1][own[places]]
    before = c.mixed(c.mixed(code) + first.astype(np.uint64))
    after = c.mixed(c.mixed(code ^ np.uint64(1 << 63)) + (length[own[places]] - first).astype(np.uint64))
    # sums over a whole part; a word's share is a difference, since sums are modulo 2 ** 64
    ends, starts, short = (np.zeros(len(data) + 1, np.uint64) for _ in range(3))
    np.add.at(ends, places + sizes, before)  # grams that end before a place
    starts[places] = after
    np.add.at(short, (places + sizes)[cut], before[cut])
    ended, started = np.cumsum(ends), np.r_[np.uint64(0), np.cumsum(starts)]
    begin, end = at[:-1], at[1:]

    changed = np.arange(len(data))
    keys_changed = (ended[changed] - ended[begin][own]) + (started[end][own] - started[changed + 1])
    gaps = c.ranges(begin, length + 1)
    own_gaps = np.repeat(np.arange(len(length)), length + 1)
    # grams cut short by the end are affected by a character put there
    left = ended[gaps] - ended[begin][own_gaps] - np.where(gaps == end[own_gaps], short[gaps], np.uint64(0))
    keys_gaps = left + (started[end][own_gaps] - started[gaps])
    word = np.r_[own, own_gaps]
    base = np.r_[length[own] - 1, length[own_gaps]]
    key = c.mixed(np.r_[keys_changed, keys_gaps] + c.mixed(base.astype(np.uint64)))
    return word, key, np.r_[np.zeros(len(own), bool), np.ones(len(own_gaps), bool)], np.r_[changed - begin[own], gaps - begin[own_gaps]], base


def indexed(table: DataFrame, frequent) -> DataFrame:
    """The index: a row for each edit of each word of (word, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = frequent.value
        for part in parts(batches, "word"):
            data, at = letters(part.column(0))
            word, key, gap, place, base = index_keys(data, at, grams)
            carried = pa.array([w if len(w) <= CARRIED else None for w in part.column(0).to_pylist()], pa.string())
            for k in range(0, len(word), 1 << 20):
                own = pa.array(word[k:k + (1 << 20)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[k:k + (1 << 20)].view(np.int64)), pa.array(gap[k:k + (1 << 20)]), pa.array(place[k:k + (1 << 20)].astype(np.int32)),
                     pa.array(base[k:k + (1 << 20)].astype(np.int32)), part.column(1).take(own), part.column(2).take(own), carried.take(own)],
                    ["key", "gap", "place", "base", "n", "id", "word"])

    return table.select("word", "n", F.xxhash64("word").alias("id")).mapInArrow(run, KEYED)


def near(a: str, b: str, place: int) -> bool:
    """Whether ``a`` becomes ``b`` by the edit at ``place``: another character there, or none and the one before it is another."""
    if a[:place] != b[:place] or a == b:
        return False
    if len(a) == len(b):
        return a[place + 1:] == b[place + 1:]
    return a[place + 1:] == b[place:] and (place == 0 or a[place - 1] != a[place])


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of one key, sorted by key and gap: verified if both words are carried, else with their places for a join."""
    def pairs(part: list[np.ndarray], texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        key, gap, place, base, n, ids = part
        size = len(key)
        if not size:
            return
        group = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (base[1:] != base[:-1])])
        end = np.repeat(np.r_[group[1:], size], np.diff(np.r_[group, size]))
        # a changed character meets the later rows of its key, changed or gap
        counts = np.where(gap == 0, end - np.arange(size) - 1, 0)
        total, start = np.cumsum(counts), 0
        while start < size:
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, "right")))
            i = np.repeat(np.arange(start, stop), counts[start:stop])
            j = c.ranges(np.arange(start, stop) + 1, counts[start:stop])
            same = (place[i] == place[j]) & (ids[i] != ids[j])
            out: list[list] = [[], [], [], [], []]
            for x, y in zip(i[same].tolist(), j[same].tolist()):
                a, b = texts[x], texts[y]
                if a is None or b is None or near(a, b, int(place[x])):
                    for column, value in zip(out, (x, y, a, b, None if a is not None and b is not None else int(place[x]))):
                        column.append(value)
            x, y = np.array(out[0], np.int64), np.array(out[1], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[x]), pa.array(out[2], pa.string()), pa.array(ids[y]), pa.array(out[3], pa.string()), pa.array(n[x]), pa.array(n[y]),
                 pa.array(out[4], pa.int32())], ["id", "word", "other_id", "other", "n", "other_n", "place"])
            start = stop

    rest: list[np.ndarray] = [np.zeros(0, np.int64)] * 6
    held: list[str | None] = []
    for batch in batches:
        columns = [np.concatenate([old, np.asarray(batch.column(k).cast(pa.int64()), np.int64)]) for k, old in enumerate(rest)]
        texts = held + batch.column(6).to_pylist()
        change = np.flatnonzero(columns[0][1:] != columns[0][:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        yield from pairs([x[:cut] for x in columns], texts[:cut])
        rest, held = [x[cut:] for x in columns], texts[cut:]
    yield from pairs(rest, held)


def pairs(table: DataFrame) -> DataFrame:
    """(word, other, n, other_n): every pair of words of (word, n) that differ by one edit, once."""
    frequent = table.sparkSession.sparkContext.broadcast(frequent_grams(table))
    rows = indexed(table, frequent).repartition("key").sortWithinPartitions("key", "base", "gap")
    found = c.stored(rows.mapInArrow(met, NEAR + ", place int"), "spelling")
    short = found.where("place is null").select("word", "other", "n", "other_n")
    named = table.select("word", F.xxhash64("word").alias("id"))
    long = (found.where("place is not null").select("id", "other_id", "n", "other_n", "place")
            .join(named, "id").join(named.select(F.col("id").alias("other_id"), F.col("word").alias("other")), "other_id"))
    return short.unionByName(long.where(is_near(F.col("word"), F.col("other"), F.col("place"))).select("word", "other", "n", "other_n"))


def is_near(a: Column, b: Column, place: Column) -> Column:
    """``near`` as an expression."""
    rest = lambda x, p: F.substring(x, p + 1, F.length(x))
    same = (F.length(a) == F.length(b)) & (rest(a, place + 1) == rest(b, place + 1)) & (a != b)
    lost = (F.length(a) == F.length(b) + 1) & (rest(a, place + 1) == rest(b, place)) & ((place == 0) | (F.substring(a, place, F.lit(1)) != F.substring(a, place + 1, F.lit(1))))
    return (F.substring(a, F.lit(1), place) == F.substring(b, F.lit(1), place)) & (same | lost)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. Forms are ten times as frequent, so no path is a circle or long."""
    ways = c.stored(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("via"), F.col("root").alias("further"))
        after = c.stored(ways.join(onward, ways["root"] == onward["via"], "left")
                         .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = after.select("word", "root")
        if not after.where("moved").limit(1).count():
            return ways


def variants(df: DataFrame, key: str = "doc_id", text: str = "text", factor: int = 10, **parameters: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; ``form`` is the most frequent near word if ``factor`` times as frequent."""
    table = c.stored(words(df, key, text, **parameters), "words")
    both = pairs(table)
    both = both.unionByName(both.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("other_n").alias("n"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"))
    best = best.select(F.col("word").alias("w"), "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))
    much = F.col("best_n") >= factor * F.col("n")
    every = c.stored(table.join(best, table["word"] == best["w"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(much, F.col("best")).alias("form"),
        F.when(much, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(every.where("form is not null")).select(F.col("word").alias("w"), "root")
    return every.join(ends, every["word"] == ends["w"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
