"""Language model scores by Katz backoff over word pairs.

With c a count over the training texts, N all their tokens, r a count up to ``CUT`` and d_r its Good-Turing discount:

    P(w)     = d c(w) / N;            all unknown words together get what the discounts leave
    P(w | h) = d c(h, w) / c(h)       where the pair was seen
             = alpha(h) P(w)          where it was not, with alpha(h) = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over seen w)
             = P(w)                   where h was not seen

so every distribution sums to 1 over all known words and the unknown one. A history whose pairs are all above the cut leaves nothing:
its pairs count c(h, w) / (c(h) + 1). Where counts of counts give no discount between 0 and 1, absolute
discounting with n1 / (n1 + 2 n2) takes its place. Histories begin with a start mark; each text ends with an end token.

Tables, all in the shared folder: word counts; and, partitioned by share and marked by kind, pair counts, history sums, partial sums
of texts and backed-off tokens. Pairs are dealt by history; a history with more than a fraction of all tokens is dealt by pair. A pair with
more than that fraction is counted before, in an aggregation that tasks begin: its tokens are evaluated where their text is and none is dealt. A
chunk sends a pair once a text, with its number, and with each share the texts that share touches, so what is dealt grows with the
tokens alone. A task counts the training pairs of its share and at once evaluates all tokens of the share, as sums that don't depend
on the discounts. Histories then get their weights, and backed-off tokens join them by history.

Word counts up to ``VOCABULARY`` words travel to the tasks; beyond that each text gets the counts of its own words by a join.
Words are known by a 64-bit hash. Null texts are empty and score their end token. Rows are scored one by one, whatever their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common as c

CUT = 5
#: Words whose counts are broadcast at most (12 bytes each).
VOCABULARY = 16_000_000
#: Tokens of a chunk that a map task codes at once, and of a share.
CHUNK = 500_000
SHARE = 1_500_000
#: Pairs in one row of the table of pair counts.
PIECE = 1 << 16
END = np.uint64(0x5EED0E4D5EED0E4D)


def discounts(n: list[int]) -> list[float]:
    """Factors of the counts 1 .. CUT from the numbers n[0] .. n[CUT] of things counted 1 .. CUT + 1 times."""
    absolute = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    if all(n):
        common = (CUT + 1) * n[CUT] / n[0]
        good = [((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common) if common != 1 else 0 for r in range(1, CUT + 1)]
        if all(0 < d < 1 for d in good):
            return good
    return [(r - absolute) / r for r in range(1, CUT + 1)]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and end tokens in a row, and the number of tokens of each text."""
    data, at = c.bytes_of(texts)
    starts, ends, first = c.words(data, at, ~c.SPACES)
    counts = np.diff(first)
    return np.insert(c.word_hashes(data, starts, ends), first[1:], END), counts + 1


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) over the texts of ``training``; summed in each task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "c"])
        for batch in batches:
            for part in c.slices(batch, "text", 1 << 20, 1 << 14):
                new, n = np.unique(tokens(c.text_array(part.column(0)))[0], return_counts=True)
                words, back = np.unique(np.concatenate([words, new]), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate([counts, n]), minlength=len(words)).astype(np.int64)
                if len(words) > 1 << 20:
                    yield out()
                    words, counts = words[:0], counts[:0]
        yield out()

    return training.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Words:
    """Counts of known words; looked up by hash. Ids are places in the sorted table, or the hashes themselves."""

    def __init__(self, words: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]

    def count_of(self, ids: np.ndarray, start: int) -> np.ndarray:
        """Counts of ids; unknown words are one id above the last and count 0, the start mark is the largest id."""
        known = ids < len(self.words)
        out = np.where(ids == np.iinfo(ids.dtype).max, start, 0)
        out[known] = self.counts[ids[known]]
        return out

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, count) of each hash; count 0: unknown."""
        each, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, each), max(len(self.words) - 1, 0))
        known = self.words[at] == each if len(self.words) else np.zeros(len(each), bool)
        count = np.where(known, self.counts[at] if len(self.words) else 0, 0)
        return at[back], count[back]


class Totals:
    """What every task needs to know of the training texts."""

    def __init__(self, n: int, v: int, texts: int, of_counts: list[int], shares: int) -> None:
        self.n, self.v, self.texts, self.shares = n, v, texts, shares
        self.factor = discounts(of_counts)
        self.unknown = sum((1 - d) * r * k for r, (d, k) in enumerate(zip(self.factor, of_counts), 1)) / n if n else 1.0
        self.scale = np.r_[0.0, self.factor]
        #: Training tokens of a history beyond which it is dealt by pair, and of a pair beyond which it is not dealt.
        self.many = n // (4 * shares)
        self.hot_many = max(self.many, CUT + 1)
        self.hot, self.hot_count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def keep_hot(self, key: np.ndarray, count: np.ndarray) -> None:
        """Takes the pairs that are not dealt; fewer than four a share, as each holds a part of all tokens."""
        order = np.argsort(key)
        self.hot, self.hot_count = key[order], count[order]

    def hot_counts(self, history: np.ndarray, word: np.ndarray, history_count: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Training count of each pair that is not dealt, else 0."""
        out = np.zeros(len(word), np.int64)
        maybe = np.flatnonzero((history_count > self.hot_many) & (count > self.hot_many)) if len(self.hot) else out[:0]
        if len(maybe):
            key = pair_key(history[maybe], word[maybe])
            at = np.minimum(np.searchsorted(self.hot, key), len(self.hot) - 1)
            out[maybe] = np.where(self.hot[at] == key, self.hot_count[at], 0)
        return out

    def probability(self, count: np.ndarray) -> np.ndarray:
        low = np.minimum(count, CUT)
        return np.where(count == 0, self.unknown, np.where(count <= CUT, self.scale[low], 1.0) * count / max(self.n, 1))


def pair_key(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for a pair: both ids side by side, or a hash of two hashes."""
    if history.dtype == np.uint32:
        return (history.astype(np.uint64) << np.uint64(32)) | word
    return c.mixed(history) + word


def histories(word: np.ndarray, count: np.ndarray, n_tokens: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word, and its count; each text begins with the start mark."""
    first = np.cumsum(n_tokens) - n_tokens
    history, history_count = np.empty_like(word), np.empty_like(count)
    history[1:], history_count[1:] = word[:-1], count[:-1]
    history[first], history_count[first] = np.iinfo(word.dtype).max, texts
    return history, history_count


EVENTS = ("share int, first long, row binary, doc_id binary, held binary, n_tokens binary, n_known binary, base binary, x binary, "
          "history binary, history_count binary, run binary, word binary, word_count binary, of binary, times binary")
FIELDS = [f.split()[0] for f in EVENTS.split(", ")]
ARROW = pa.schema([("share", pa.int32()), ("first", pa.int64())] + [(f, pa.binary()) for f in FIELDS[2:]])


def grouped(first: np.ndarray, second: np.ndarray, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by two columns, and the starts and sizes of equal rows in it; ``within`` rises already and parts them further."""
    small = first.dtype == second.dtype == np.uint32
    order = np.argsort(pair_key(first, second), kind="stable") if small else np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = False
    for column in (first, second, within):
        if column is not None:
            new[1:] |= column[order[1:]] != column[order[:-1]]
    start = np.flatnonzero(new)
    return order, start, np.diff(np.r_[start, len(order)])


def chunk_rows(held: list[tuple], totals: Totals, seed: int) -> Iterator[dict]:
    """One row for the texts of a chunk, and one per share with its pairs sorted by history and word."""
    row, doc, out, n_tokens = (np.concatenate([h[k] for h in held]) for k in range(4))
    word, count = (np.concatenate([h[k] for h in held]) for k in (4, 5))
    of = np.repeat(np.arange(len(row), dtype=np.uint32), n_tokens)
    history, history_count = histories(word, count, n_tokens, totals.texts)
    add = lambda x: np.bincount(of, weights=x, minlength=len(row))
    base = add(np.log10((count + 1) / (totals.n + totals.v + 1)))
    known = history_count > 0
    pair_count = totals.hot_counts(history, word, history_count, count)
    hot = pair_count > 0
    x = add(np.where(known, 0.0, np.log10(totals.probability(count))))
    x += np.bincount(of[hot], weights=np.log10(pair_count[hot]) - np.log10(history_count[hot]), minlength=len(row))
    order, start, times = grouped(history[hot], of[hot])
    empty = {f: None for f in FIELDS}
    yield empty | {"share": seed % totals.shares, "row": row.tobytes(), "doc_id": doc.tobytes(), "held": out.tobytes(),
                   "n_tokens": n_tokens.tobytes(), "n_known": add(count > 0).astype(np.int64).tobytes(), "base": base.tobytes(), "x": x.tobytes(),
                   "history": history[hot][order[start]].tobytes(), "of": of[hot][order[start]].tobytes(), "times": times.astype(np.uint32).tobytes()}
    dealt = known & ~hot
    of, word, count, history, history_count = of[dealt], word[dealt], count[dealt], history[dealt], history_count[dealt]
    spread = np.where(history_count > totals.many, c.mixed(word.astype(np.uint64) + np.uint64(1)), np.uint64(0))
    share = (c.mixed(history.astype(np.uint64) ^ spread) % np.uint64(totals.shares)).astype(np.uint16 if totals.shares <= 1 << 16 else np.uint32)
    by_share = np.argsort(share, kind="stable")
    cuts = np.flatnonzero(np.r_[True, share[by_share][1:] != share[by_share][:-1], True]) if len(share) else [0]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        mine = by_share[lo:hi]
        order, start, times = grouped(history[mine], word[mine], of[mine])
        mine = mine[order[start]]
        new = np.flatnonzero(np.r_[True, history[mine][1:] != history[mine][:-1]])
        texts = np.flatnonzero(np.bincount(of[mine], minlength=len(row)))
        place = np.zeros(len(row), np.uint32)
        place[texts] = np.arange(len(texts))
        ids, first = row[texts], int(row[texts].min())
        near = ids.max() - first < 1 << 32
        yield empty | {"share": int(share[mine[0]]), "first": first, "row": (ids - first).astype(np.uint32 if near else np.int64).tobytes(), "held": out[texts].tobytes(),
                       "history": history[mine[new]].tobytes(), "history_count": history_count[mine[new]].tobytes(),
                       "run": np.diff(np.r_[new, len(mine)]).astype(np.uint32).tobytes(),
                       "word": word[mine].tobytes(), "word_count": None if word.dtype == np.uint32 else count[mine].tobytes(),
                       "of": place[of[mine]].astype(np.uint16 if len(texts) <= 1 << 16 else np.uint32).tobytes(),
                       "times": None if times.max() == 1 else times.astype(np.uint32).tobytes()}


def coded(batches: Iterator[pa.RecordBatch], table: Words | None) -> Iterator[tuple]:
    """(row, doc_id, held, tokens, word, count) of slices of rows; without a table the rows bring the counts of their words."""
    for batch in batches:
        for part in c.slices(batch, "text", 1 << 20, 1 << 14):
            hashes, counts = tokens(c.text_array(part.column(3)))
            if table is not None:
                place, count = table.find(hashes)
                word = np.where(count > 0, place, len(table.words)).astype(np.uint32)
            else:
                word = hashes
                own = Words(*(np.asarray(part.column(i).flatten(), np.int64) for i in (4, 5)))
                own.words = own.words.view(np.uint64)
                order = np.argsort(own.words)
                own.words, own.counts = own.words[order], own.counts[order]
                count = own.find(hashes)[1]
            yield (np.asarray(part.column(0), np.int64), np.asarray(part.column(1).fill_null(c_null), np.int64),
                   np.asarray(part.column(2).cast(pa.int8()), np.int8), counts, word, count)


def hot_pairs(rows: DataFrame, totals: Totals, words) -> pa.Table:
    """(history, word, n, history_count, word_count) of the pairs with more training tokens than a share's part.

    Tasks count pairs of two words that are frequent enough each; fewer than four pairs a share are left.
    """
    many = totals.hot_many

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, out, n_tokens, word, count in coded(batches, words.value if words is not None else None):
            history, history_count = histories(word, count, n_tokens, totals.texts)
            pick = np.repeat(out == 0, n_tokens) & (history_count > many) & (count > many)
            h, w, ch, cw = (x[pick] for x in (history, word, history_count, count))
            order, start, n = grouped(h, w)
            one = order[start]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (h[one], w[one], n, ch[one], cw[one])], ["history", "word", "n", "history_count", "word_count"])

    counted = rows.where("not held").mapInArrow(c.frugal(run), "history long, word long, n long, history_count long, word_count long")
    return (counted.groupBy("history", "word").agg(F.sum("n").alias("n"), F.max("history_count").alias("history_count"), F.max("word_count").alias("word_count"))
            .where(F.col("n") > many).toArrow())


def hot_rows(found: pa.Table, totals: Totals, kind: type) -> pa.Table:
    """What the tables hold of the pairs that are not dealt: their part of their histories, and their counts (of 64 bits)."""
    h, w, n, ch, cw = (np.asarray(x.combine_chunks(), np.int64) for x in found.columns)
    zero = np.zeros(len(h), np.int64)
    pairs = {"words": [np.stack([h.astype(kind), w.astype(kind)]).tobytes()], "counts": [n.tobytes()], "history": [int(h[0])]}
    return pa.Table.from_batches([kind_batch("history", len(h), history=h, c=ch, x=totals.probability(cw), **{f"n{r}": zero for r in range(1, CUT + 1)}),
                                  kind_batch("hot pairs", 1, **pairs)])


def events(rows: DataFrame, totals: Totals, words) -> DataFrame:
    """Rows (row, doc_id, held, text) as chunks of coded tokens dealt to shares. ``words``: a broadcast, or None where rows bring theirs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words.value if words is not None else None
        held, size, k = [], 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            for row in chunk_rows(held, totals, int(held[0][0][0])):
                yield pa.RecordBatch.from_pylist([row], schema=ARROW)

        for one in coded(batches, table):
            held.append(one)
            size += len(one[4])
            if size >= CHUNK:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return rows.mapInArrow(c.frugal(run), EVENTS)


c_null = np.iinfo(np.int64).min

KINDS = "kind string, row long, doc_id long, held boolean, n_tokens long, n_known long, base double, history long, c long, " \
        + ", ".join(f"n{r} long" for r in range(1, CUT + 2)) + ", x double, unseen long, seen long, words binary, counts binary"
KIND_FIELDS = {f.split()[0]: {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}[f.split()[1]]
               for f in KINDS.split(", ")}


def kind_batch(kind: str, n: int, **columns) -> pa.RecordBatch:
    made = {"kind": pa.array([kind] * n), **{k: pa.array(v, KIND_FIELDS[k]) for k, v in columns.items()}}
    return pa.RecordBatch.from_arrays([made.get(f, pa.nulls(n, t)) for f, t in KIND_FIELDS.items()], list(KIND_FIELDS))


def share_of(rows: list[dict], totals: Totals, table: Words | None) -> Iterator[pa.RecordBatch]:
    """Counts and evaluates the pairs of one share."""
    wide = table is None
    kind = np.uint64 if wide else np.uint32
    parts = []
    docs: list[np.ndarray] = []
    trains: list[np.ndarray] = []
    before = 0
    for r in rows:
        held = np.frombuffer(r["held"], np.int8)
        row = r["first"] + np.frombuffer(r["row"], np.int64 if len(r["row"]) == 8 * len(held) else np.uint32).astype(np.int64)
        run = np.frombuffer(r["run"], np.uint32)
        of = np.frombuffer(r["of"], np.uint16 if len(row) <= 1 << 16 else np.uint32).astype(np.int32) + np.int32(before)
        times = np.ones(len(of), np.int32) if r["times"] is None else np.frombuffer(r["times"], np.uint32).astype(np.int32)
        parts.append((np.repeat(np.frombuffer(r["history"], kind), run), np.frombuffer(r["word"], kind), of, times,
                      np.repeat(np.frombuffer(r["history_count"], np.int64), run) if wide else None,
                      np.frombuffer(r["word_count"], np.int64) if wide else None))
        docs.append(row)
        trains.append(held == 0)
        before += len(row)
    row, train = np.concatenate(docs), np.concatenate(trains)
    history, word, of, times = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 2, 3))
    if wide:
        order = np.lexsort((word, history))
        history, word, of, times = history[order], word[order], of[order], times[order]
    else:
        key = (history.astype(np.uint64) << np.uint64(32)) | word
        order = np.argsort(key, kind="stable")
        key, of, times = key[order], of[order], times[order]
        history, word = (key >> np.uint64(32)).astype(np.uint32), key.astype(np.uint32)
        del key
    new = np.r_[True, (history[1:] != history[:-1]) | (word[1:] != word[:-1])]
    first = np.flatnonzero(new)
    count = np.add.reduceat(np.where(train[of], times, 0), first, dtype=np.int64)
    pair = np.cumsum(new, dtype=np.int32) - np.int32(1)
    h, w = history[first], word[first]
    if wide:
        ch, c_word = (np.concatenate([p[k] for p in parts])[order][first] for k in (4, 5))
    else:
        ch, c_word = table.count_of(h, totals.texts), table.count_of(w, 0)
    del parts, history, word, order, new
    p_word = totals.probability(c_word)
    # sums per history over its pairs seen
    h_new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    of_h = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
    low = [np.add.reduceat((count == r).astype(np.int64), h_new) for r in range(1, CUT + 1)]
    mass = np.add.reduceat(np.where(count > 0, p_word, 0.0), h_new)
    yield kind_batch("history", len(h_new), history=h[h_new].astype(np.int64), c=ch[h_new], x=mass, **{f"n{r}": n for r, n in enumerate(low, 1)})
    yield kind_batch("counts", 1, **{f"n{r}": [int((count == r).sum())] for r in range(1, CUT + 2)})
    seen_pairs = count > 0
    for k in range(0, len(h), PIECE):
        own = seen_pairs[k:k + PIECE]
        yield kind_batch("pairs", 1, history=[int(h[k])], words=[np.stack([h[k:k + PIECE][own], w[k:k + PIECE][own]]).tobytes()],
                         counts=[count[k:k + PIECE][own].astype(np.uint32).tobytes()])
    whole = ch <= totals.many  # all pairs of the history are in this share
    bare = (sum(low) == 0)[of_h]
    r = count[pair]
    log_seen = np.where(count > CUT, np.log10(np.maximum(count, 1)), 0.0) - np.log10(ch + (whole & bare))
    x = np.bincount(of, weights=np.where(count > 0, log_seen, np.log10(p_word))[pair] * times, minlength=len(row))
    ks = [np.bincount(of[r == k], weights=times[r == k], minlength=len(row)).astype(np.int64) for k in range(1, CUT + 1)]
    touched = np.flatnonzero(np.bincount(of, minlength=len(row)))
    yield kind_batch("texts", len(touched), row=row[touched], x=x[touched], **{f"n{k}": n[touched] for k, n in enumerate(ks, 1)})
    seen = r > 0
    wait = ~seen | (~whole & bare)[pair]
    if wait.any():
        key = of_h[pair[wait]].astype(np.int64) * len(row) + of[wait]
        each, back = np.unique(key, return_inverse=True)
        unseen = np.bincount(back, weights=np.where(seen[wait], 0, times[wait]), minlength=len(each)).astype(np.int64)
        total = np.bincount(back, weights=times[wait], minlength=len(each)).astype(np.int64)
        yield kind_batch("waiting", len(each), history=h[h_new][each // len(row)].astype(np.int64), row=row[each % len(row)], unseen=unseen, seen=total - unseen)


def tables(dealt: DataFrame, totals: Totals, words) -> DataFrame:
    """All rows of the tables, by kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words.value if words is not None else None
        mine: list[dict] = []
        for batch in batches:
            for k in range(len(batch)):
                r = batch.slice(k, 1).to_pylist()[0]
                if r["doc_id"] is not None:
                    n = len(r["row"]) // 8
                    doc = np.frombuffer(r["doc_id"], np.int64)
                    f = lambda x, t: np.frombuffer(r[x], t)
                    yield kind_batch("texts", n, row=f("row", np.int64), doc_id=pa.array(doc, mask=doc == c_null), held=f("held", np.int8) == 1,
                                     n_tokens=f("n_tokens", np.int64), n_known=f("n_known", np.int64), base=f("base", np.float64), x=f("x", np.float64))
                    history, of, times = f("history", np.uint32 if table is not None else np.uint64).astype(np.int64), f("of", np.uint32), f("times", np.uint32)
                    if len(of):
                        yield kind_batch("waiting", len(of), history=history, row=f("row", np.int64)[of], unseen=np.zeros(len(of), np.int64), seen=times.astype(np.int64))
                    continue
                if mine and mine[0]["share"] != r["share"]:
                    yield from share_of(mine, totals, table)
                    mine = []
                mine.append(r)
        if mine:
            yield from share_of(mine, totals, table)

    return dealt.repartition(totals.shares, "share").sortWithinPartitions("share").mapInArrow(run, KINDS)


def log_factor(factor: list[float]) -> Column:
    return sum((F.coalesce(F.sum(f"n{r}"), F.lit(0)) * F.lit(float(np.log10(d * r))) for r, d in enumerate(factor, 1)), F.lit(0.0))


def scores(df: DataFrame, held: Column, doc: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, share: int = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; rows that are not ``held`` are learnt from."""
    spark = df.sparkSession
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(doc).cast("long").alias("doc_id"),
                     F.coalesce(held, F.lit(False)).alias("held"), F.col(text).alias("text"))
    counts = c.stored(word_counts(rows.where("not held")), "words")
    sums = [F.sum((F.col("c") == r).cast("long")).alias(f"n{r}") for r in range(1, CUT + 2)]
    t = counts.agg(F.sum("c").alias("n"), F.count("c").alias("v"), F.sum(F.when(F.col("word") == int(END.view(np.int64)), F.col("c"))).alias("texts"), *sums).first()
    totals = Totals(t["n"] or 0, t["v"], t["texts"] or 0, [t[f"n{r}"] or 0 for r in range(1, CUT + 2)], max(1, -(-(t["n"] or 0) // share)))
    if totals.v <= vocabulary:
        table = counts.toArrow().combine_chunks()
        words = spark.sparkContext.broadcast(Words(np.asarray(table["word"], np.int64).view(np.uint64), np.asarray(table["c"], np.int64)))
    else:
        # Numbers of rows are looked at twice; a repeated task would number them anew.
        words, rows = None, with_own_counts(c.stored(rows, "rows"), counts)
    kind = np.uint32 if words is not None else np.uint64
    found = hot_pairs(rows, totals, words)
    pairs = [np.asarray(x.combine_chunks(), np.int64) for x in found.columns]
    totals.keep_hot(pair_key(pairs[0].astype(kind), pairs[1].astype(kind)), pairs[2])
    folder = f"{c.shared_folder(spark)}/llm/katz-{c.uuid.uuid4().hex}"
    tables(events(rows, totals, words), totals, words).write.parquet(folder)
    if found.num_rows:
        spark.createDataFrame(hot_rows(found, totals, kind)).write.mode("append").parquet(folder)
    c.release(spark)
    kind = lambda name: spark.read.schema(KINDS).parquet(folder).where(F.col("kind") == name)
    n = kind("counts").agg(*[F.sum(f"n{r}").alias(f"n{r}") for r in range(1, CUT + 2)]).first()
    factor = discounts([n[f"n{r}"] or 0 for r in range(1, CUT + 2)])
    left = sum((F.sum(f"n{r}") * F.lit((1 - d) * r) for r, d in enumerate(factor, 1)), F.lit(0.0))
    weights = kind("history").groupBy("history").agg(F.max("c").alias("c"), sum((F.sum(f"n{r}") for r in range(1, CUT + 1)), F.lit(0)).alias("low"),
                                                     left.alias("left"), F.sum("x").alias("mass"))
    weights = weights.select("history", F.log10(F.when(F.col("low") == 0, 1 / (F.col("c") + 1)).otherwise(F.col("left") / F.col("c"))
                                                / (1 - F.col("mass"))).alias("alpha"),
                             F.when(F.col("low") == 0, F.log10(F.col("c") / (F.col("c") + 1))).otherwise(0.0).alias("bare"))
    late = (kind("waiting").join(weights, "history").groupBy("row")
            .agg(F.sum(F.col("unseen") * F.col("alpha") + F.col("seen") * F.col("bare")).alias("late")))
    texts = kind("texts").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), (log_factor(factor) + F.sum("x")).alias("sum"))
    return texts.join(late, "row", "left").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.n).cast("long").alias("train_tokens"), "base_score",
        (F.col("sum") + F.coalesce("late", F.lit(0.0))).alias("score"))


def with_own_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with the known words of each text and their counts, for vocabularies too large to send to every task."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in c.slices(batch, "text"):
                hashes, n = tokens(c.text_array(part.column(1)))
                row = np.repeat(np.asarray(part.column(0), np.int64), n)
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                new = np.r_[True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(row[new]), pa.array(hashes[new].view(np.int64))], ["row", "word"])

    own = rows.select("row", "text").mapInArrow(distinct, "row long, word long").join(counts, "word")
    own = own.groupBy("row").agg(F.collect_list(F.struct("word", "c")).alias("own")).select(F.col("row").alias("_row"), "own")
    return (rows.join(own, F.col("row") == F.col("_row"), "left")
            .select("row", "doc_id", "held", "text", F.coalesce(F.col("own.word"), F.array().cast("array<long>")).alias("words"),
                    F.coalesce(F.col("own.c"), F.array().cast("array<long>")).alias("counts")))
