"""Byte-level BPE: ranked merges folded by Spark's higher-order functions over the byte arrays of distinct words.

A word is a string with one character for each token, at first one for each byte. Merging a pair of tokens replaces two characters by
one. Every piece of the vocabulary has one pair that makes it, and all pieces inside a piece rank lower; so the merges of a word are the
pieces that occur in it, in the order of their ranks, each applied once to all its places from the left. ``aggregate`` folds that list
over the word, and a literal map of ranks, an array, gives each rank its pair and its character.

Each slice of documents becomes one row: its documents with the places of their words, and its distinct words with their merges, found by
walking all places of all words down a tree of the pieces together. Words then become ids by place. Where the pattern is ``SPACED``, texts are cut
before words, in white space and between ASCII letters, digits and marks first, and only distinct pieces of other characters are matched; other
patterns are matched on whole texts. Nothing is shuffled, a lost task repeats its own slices only, and a word is merged once a slice however
often it occurs. Decoding concatenates pieces of a literal vocabulary, as hexadecimal digits.

Null and empty texts have no ids. A null array of ids, or one with an id of no piece, decodes to null. Repeated rows are encoded each for
itself, an empty table gives an empty table, a word may be as long as its text. Columns named like a result are replaced. A vocabulary
whose pieces are not made by lower ranks in this way is refused.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import common as c

#: Character of rank 0; characters of more than 16 bits are never halves of one another.
FIRST = 1 << 16
#: Ranks that have a character.
RANKS = 1 << 20
#: White space of the Unicode property, which ``\s`` stands for in the tokenizers' patterns.
SPACE = "".join(map(regex.escape, map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])))
#: The pattern of which is known that no match but white space goes beyond one blank and what is no white space behind it.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A text with white space of more than a byte is matched whole.
WIDE_SPACE = f"[{''.join(x for x in map(chr, [133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))}]"
#: Letters, digits and marks of ASCII; 0 for white space and what is not ASCII.
KIND = np.array([0 if b > 127 or c.SPACES[b] else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(256)], np.uint8)
SLICE_BYTES = 4 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by piece; the file holds a piece in base64 and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with ``\\s`` and ``\\S`` as the white space property."""
    inside = regex.sub(r"\[(\^?)((?:[^\]\\]|\\.)*)\]", lambda m: f"[{m[1]}{m[2].replace(chr(92) + 's', SPACE)}]", pattern)
    return regex.compile(inside.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


def maker(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The pair that lower ranks leave of a piece; None if they leave anything else."""
    parts, limit = [piece[k:k + 1] for k in range(len(piece))], ranks[piece]
    while len(parts) > 2:
        rank, k = min((ranks.get(parts[k] + parts[k + 1], limit), k) for k in range(len(parts) - 1))
        if rank >= limit:
            return None
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    first, second = ranks[parts[0]], ranks[parts[1]]
    return (first, second) if first < limit and second < limit else None


class Table:
    """The ranks of one vocabulary, for tasks and as literals."""

    def __init__(self, path: str) -> None:
        self.ranks = load_ranks(path)
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("some byte has no rank")
        if len(set(self.ranks.values())) < len(self.ranks) or not all(0 <= r < RANKS for r in self.ranks.values()):
            raise ValueError(f"ranks must be distinct and below {RANKS}")
        chars = "".join(chr(FIRST + self.ranks[bytes([b])]) for b in range(256))
        self.bytes = np.frombuffer(chars.encode(), np.uint8).reshape(256, 4)

    def plant(self) -> None:
        """The tree of the pieces as a double array: byte b leads from a state s to ``base[s] + b`` if ``up`` of that is s; the bytes are states themselves.

        ``made`` is the rank of a state that is a piece of two bytes or more, or -1.
        """
        below: dict[bytes, set[int]] = {bytes([b]): set() for b in range(256)}
        for piece in self.ranks:
            for k in range(len(piece) - 1, 0, -1):
                kids = below.setdefault(piece[:k], set())
                if piece[k] in kids:
                    break
                kids.add(piece[k])
        free, low, begins = np.ones(1 << 16, bool), 512, {}  # of each prefix, the base of its children
        free[:low] = False
        for prefix, kids in sorted(below.items(), key=lambda x: -len(x[1])):
            kids = np.array(sorted(kids), np.int64)
            while len(kids) > 1 and prefix not in begins:
                if low + 1024 > len(free):
                    free = np.append(free, np.ones(len(free), bool))
                some = low + np.flatnonzero(free[low:low + 512]) - kids[0]
                if len(fit := np.flatnonzero(free[some[:, None] + kids].all(1))):
                    begins[prefix] = int(some[fit[0]])
                    free[begins[prefix] + kids] = False
                else:
                    low += 128  # full enough
        single = [(prefix, kid) for prefix, kids in below.items() if len(kids) == 1 for kid in kids]
        free = np.append(free, np.ones(len(single), bool))
        begins |= {prefix: place - kid for (prefix, kid), place in zip(single, np.flatnonzero(free)[:len(single)].tolist())}
        state = lambda piece: piece[0] if len(piece) == 1 else begins[piece[:-1]] + piece[-1]
        self.made, self.base = np.full(len(free), -1, np.int32), np.zeros(len(free), np.int32)
        self.up = np.full(len(free) + 512, -1, np.int32)
        for prefix, begin in begins.items():
            self.base[state(prefix)] = begin
            self.up[[begin + b for b in below[prefix]]] = state(prefix)
        for piece, rank in self.ranks.items():
            if len(piece) > 1:
                self.made[state(piece)] = rank

    def inside(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the pieces of two bytes or more that occur in each word, ascending, and their number; ``at`` bounds the words in ``data``."""
        sizes = np.diff(at)
        word, following = np.repeat(np.arange(len(sizes)), sizes), np.full(len(data) + 1, 256, np.int32)
        following[:-1] = data
        following[at] = 256  # no byte: nothing goes on into the next word
        start, state, depth, found = np.arange(len(data), dtype=np.int32), data.astype(np.int32), 0, [np.zeros(0, np.int64)]
        while len(start):
            depth += 1
            there = self.base[state] + following[start + depth]
            on = np.flatnonzero(self.up[there] == state)
            start, state = start[on], there[on]
            rank = self.made[state]
            ends = np.flatnonzero(rank >= 0)
            found.append(word[start[ends]] * RANKS + rank[ends])
        pairs = np.sort(np.concatenate(found))
        pairs = pairs[np.diff(pairs, prepend=-1) > 0]
        return (pairs % RANKS).astype(np.int32), np.bincount(pairs // RANKS, minlength=len(sizes))

    def merges(self) -> tuple[Column, Column]:
        """The literal map: of each rank the two characters that make it, and its character; null where there is none."""
        pairs: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        own: list[str | None] = list(pairs)
        for piece, rank in self.ranks.items():
            own[rank] = chr(FIRST + rank)
            if len(piece) > 1:
                pair = maker(piece, self.ranks)
                if pair is None:
                    raise ValueError(f"lower ranks don't make the piece {piece!r} of rank {rank}")
                pairs[rank] = chr(FIRST + pair[0]) + chr(FIRST + pair[1])
        return numbers(pairs, "string"), numbers(own, "string")

    def pieces(self) -> Column:
        """The pieces by rank in hexadecimal digits, a literal array; null for a rank of no piece."""
        digits: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            digits[rank] = piece.hex()
        return numbers(digits, "string")


def numbers(values: list[int | str | None], kind: str) -> Column:
    """A literal array, folded once from its text."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), f"array<{kind}>")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(symbols: Column, merges: Column, pairs: Column, own: Column) -> Column:
    """Ids of a word given as one character a byte, after the merges of the given ranks."""
    last = F.aggregate(merges, symbols, lambda word, rank: F.replace(word, F.get(pairs, rank), F.get(own, rank)))
    return F.transform(F.regexp_extract_all(last, F.lit("(?s)."), F.lit(0)), lambda x: F.ascii(x) - FIRST)


def cuts(data: np.ndarray, at: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where pieces begin that ``SPACED`` matches by themselves: at texts, in white space, before what follows it, and where ASCII letters, digits
    and marks meet, but not behind an apostrophe; a ``whole`` text is one piece."""
    begins, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    kinds = KIND[data]
    begins[1:-1] = (kinds[1:] != kinds[:-1]) & (kinds[1:] > 0) & (kinds[:-1] > 0) & (data[:-1] != 39)
    begins[at] = last[at] = True
    starts, ends, _ = c.words(data, at, c.SPACES)
    inner = ends[~last[ends]]
    begins[starts] = begins[inner - 1] = True
    begins[inner[data[inner - 1] != 32]] = True
    for k in np.flatnonzero(whole):
        begins[at[k] + 1:at[k + 1]] = False
    return np.flatnonzero(begins[:-1])


def split(texts: pa.Array, find, spaced: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a large string array, the places of all words among them, and the number of words of each text.

    Pieces of ASCII without an apostrophe are words as they are; of others, the distinct ones are matched, texts with wide white space one by one.
    """
    def whole(some: pa.Array) -> np.ndarray:
        return np.asarray(pc.match_substring_regex(some, WIDE_SPACE).to_numpy(zero_copy_only=False), bool) if spaced else np.ones(len(some), bool)

    data, at = c.bytes_of(texts)
    begins = cuts(data, at, whole(texts))
    coded = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)).dictionary_encode()
    pieces, codes = coded.dictionary, np.asarray(coded.indices)
    letters, bounds = c.bytes_of(pieces)
    hard = np.diff(np.concatenate([[0], np.cumsum((letters > 127) | (letters == 39))])[bounds]) > 0
    alone = whole(pieces)
    easy, joint, single = np.flatnonzero(~hard & ~alone), np.flatnonzero(hard & ~alone), np.flatnonzero(alone)
    counts, words = np.ones(len(pieces), np.int64), [pieces.take(pa.array(easy))]
    if len(joint):  # a line feed between two pieces is a match of its own
        lines = "\n".join(pieces.take(pa.array(joint)).to_pylist())
        found = pa.array(find(lines), pa.large_string())
        inside = pc.not_equal(found, "\n")
        ends = np.flatnonzero(~inside.to_numpy(zero_copy_only=False))
        counts[joint] = np.diff(np.concatenate([[-1], ends, [len(found)]])) - 1
        words.append(found.filter(inside))
    for k in single:
        words.append(pa.array(find(pieces[k].as_py()), pa.large_string()))
        counts[k] = len(words[-1])
    order, first = np.concatenate([easy, joint, single]), np.zeros(len(pieces), np.int64)
    first[order] = np.cumsum(counts[order]) - counts[order]
    distinct = pa.concat_arrays(words).dictionary_encode()
    width = counts[codes]
    places = np.asarray(distinct.indices, np.int32)[c.ranges(first[codes], width)]
    return distinct.dictionary, places, np.diff(np.concatenate([[0], np.cumsum(width)])[np.searchsorted(begins, at)])


def packed(df: DataFrame, table: Table, pattern: str, text: str, names: list[str]) -> DataFrame:
    """One row per slice: ``docs`` (the columns as c0, c1, ... and the places of the words), ``words`` (distinct, with their merges)."""
    rows = df.select(*[F.col(f"`{x}`").alias(f"c{k}") for k, x in enumerate(names)], F.col(f"`{text}`").alias("t"))
    inner = ", ".join([f"c{k}: {rows.schema[k].dataType.simpleString()}" for k in range(len(names))] + ["places: array<int>"])
    table.plant()
    shared = df.sparkSession.sparkContext.broadcast((table, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pattern = shared.value
        find = splitter(pattern).findall
        for batch in batches:
            for part in c.slices(batch, "t", SLICE_BYTES, 1 << 30):
                distinct, at, counts = split(c.text_array(part.column(len(names))), find, pattern == SPACED)
                places = c.lists(at, counts, pa.int32())
                data, at = c.bytes_of(distinct)
                symbols = pa.LargeStringArray.from_buffers(len(distinct), pa.py_buffer(at * 4), pa.py_buffer(known.bytes[data].ravel())).cast(pa.string())
                merges = c.lists(*known.inside(data, at), pa.int32())
                docs = pa.StructArray.from_arrays([*part.columns[:-1], places], [*[f"c{k}" for k in range(len(names))], "places"])
                words = pa.StructArray.from_arrays([symbols, merges], ["symbols", "merges"])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (docs, words)], ["docs", "words"])

    return rows.mapInArrow(c.frugal(run), f"docs array<struct<{inner}>>, words array<struct<symbols: string, merges: array<int>>>")


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ids (array of int), the tokens of each whole text without special tokens.

    ``path`` holds the ranks, ``pattern`` is the splitting pattern; every match is encoded by itself.
    """
    table = Table(path)
    names = [x for x in df.columns if x != "ids"]
    rows = packed(df, table, pattern, text, names)
    pairs, own = table.merges()
    words = let(pairs, lambda p: let(own, lambda o: F.transform("words", lambda w: fold(w["symbols"], w["merges"], p, o))))
    rows = rows.select("docs", words.alias("words"))
    each = F.transform("docs", lambda d: F.struct(
        *[d[f"c{k}"].alias(f"c{k}") for k in range(len(names))],
        F.flatten(F.transform(d["places"], lambda p: F.get(F.col("words"), p))).alias("ids")))
    rows = rows.select(F.inline(each))
    return rows.select(*[F.col(f"c{k}").alias(x) for k, x in enumerate(names)], "ids")


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with decoded (binary): the pieces of the ids, concatenated as digits, so that none has to be text."""
    pieces = Table(path).pieces()
    digits = let(pieces, lambda p: F.array_join(F.transform(F.col(f"`{ids}`"), lambda i: F.get(p, i)), "", "?"))  # no digit: unhex gives null
    return df.withColumn("decoded", F.unhex(digits))


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes."""
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))
