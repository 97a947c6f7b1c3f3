"""Encoding and decoding with a BPE model of the sentencepiece library, by vectorised merge rounds.

A text becomes segments: a run of spaces with the word behind it. No piece of such a model has a space after
another character, so merges never cross segments. The distinct segments of a slice are laid out in one flat array
of symbols; in each round every segment finds the smallest rank among its adjacent pairs and merges it, all segments
at once, and the array is compacted, until no pair of the vocabulary remains.

A round merges every occurrence of the pair (leftmost first, without overlap) when no piece built from the merged
one ranks before it; else only the leftmost, which is the order in which a priority queue would take them.

Null text: no ids. Ids outside the model raise. Null ids decode to an empty text.
"""

from __future__ import annotations

import codecs
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common as c

SPACE = "▁"
NO_RANK = np.int32(np.iinfo(np.int32).max)
#: Segments kept in a task's table of known ones before it starts anew.
KNOWN = 400_000
#: Symbols of one segment beyond which it is merged with a queue; its rounds could be as many as its symbols.
LONG = 4096

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """Tables read from a model file: pieces, ranks of pairs, bytes of pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.GetPieceSize()
        names = [sp.IdToPiece(i) for i in range(n)]
        plain = {names[i]: i for i in range(n) if not (sp.IsControl(i) or sp.IsByte(i) or sp.IsUnknown(i) or sp.IsUnused(i))}
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if sp.IsByte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
        scores = np.array([sp.GetScore(i) for i in plain.values()])
        order = {s: r for r, s in enumerate(sorted(set(scores.tolist()), reverse=True))}
        rank = {p: order[float(s)] for p, s in zip(plain, scores)}
        tied = {r for r, k in zip(*np.unique(list(rank.values()), return_counts=True)) if k > 1}
        self.merged: dict[tuple[int, int], int] = {}
        late: set[str] = set()
        for p, i in plain.items():
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if a in plain and b in plain:
                    self.merged[plain[a], plain[b]] = i
                    late.update(q for q in (a, b) if len(q) > 1 and rank[q] >= rank[p])
        self.width = np.int64(1 << 32)
        keys = np.array([a * int(self.width) + b for a, b in self.merged], np.int64)
        at = np.argsort(keys)
        self.keys, self.into = keys[at], np.array(list(self.merged.values()), np.int32)[at]
        self.rank = np.full(n, NO_RANK, np.int32)
        self.rank[list(plain.values())] = list(rank.values())
        self.single = np.zeros(n, bool)  # pieces of which one occurrence is merged in a round
        self.single[[plain[p] for p in plain if p in late or rank[p] in tied]] = True
        self.of_char = np.full(0x110000, -1, np.int64)
        for p, i in plain.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        inner = {x for p in plain if len(p) > 1 for x in p}
        if any(SPACE in p.strip(SPACE) or (p.endswith(SPACE) and p.strip(SPACE)) for p in plain):
            raise ValueError("a piece has a space behind another character; segments can't be merged apart")
        self.segment = re.compile(r" *[^ ]+| +" if "\n" in inner else r" *[^ \n]+| +|\n")
        shown = [b"" if sp.IsControl(i) else bytes([int(names[i][3:5], 16)]) if sp.IsByte(i) else b" \xe2\x81\x87 "
                 if sp.IsUnknown(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_len = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_len) - self.shown_len
        self.spaced = np.array([names[i].startswith(SPACE) and names[i] in plain for i in range(n)])
        self.size = n

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged piece of each pair, or -1."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.into[at], np.int32(-1))

    def symbols(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of all segments in a row, and their number per segment. Unknown characters are size + code."""
        code = np.frombuffer("".join(segments).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        counts = np.array([len(s) for s in segments], np.int64)
        known = self.of_char[code]
        sym = np.where(known >= 0, known, code + self.size)
        owner = np.repeat(np.arange(len(segments)), counts)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if (long := np.flatnonzero(counts > LONG)).size:
            slow = np.isin(owner, long)
            for i in long:
                out = self.queued(sym[owner == i].tolist())
                done.append((np.full(len(out), i), np.array(out, np.int64)))
            sym, owner = sym[~slow], owner[~slow]
        into = np.full(len(sym), -1, np.int32)
        fresh = np.arange(len(sym))
        while len(sym):
            # pairs that begin at a changed symbol; a pair never reaches into the next segment
            fresh = fresh[fresh < len(sym) - 1]
            into[fresh] = np.where(owner[fresh] == owner[fresh + 1], self.pairs(sym[fresh], sym[fresh + 1]), -1)
            into[-1] = -1
            rank = np.where(into >= 0, self.rank[into], NO_RANK)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(sym)])
            if (best == NO_RANK).any():
                over = np.repeat(best == NO_RANK, sizes)
                done.append((owner[over], sym[over]))
                sym, owner, into, rank = sym[~over], owner[~over], into[~over], rank[~over]
                if not len(sym):
                    break
                alive = best != NO_RANK
                best, sizes = best[alive], sizes[alive]
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            begins = np.r_[True, owner[hit][1:] != owner[hit][:-1]]
            hit_first = begins | ~self.single[into[hit]]
            hit = hit[hit_first]
            # of touching hits (the same symbol again and again) every second one
            run = np.r_[True, (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])]
            at = np.arange(len(hit))
            hit = hit[(at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0]
            sym[hit] = into[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            sym, owner, into = sym[keep], owner[keep], into[keep]
            changed = np.zeros(len(sym), bool)
            changed[moved[hit]] = changed[np.maximum(moved[hit] - 1, 0)] = True
            fresh = np.flatnonzero(changed)
        owners = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owners, kind="stable")
        return np.concatenate([d[1] for d in done])[order] if done else owners, np.bincount(owners, minlength=len(segments))

    def queued(self, sym: list[int]) -> list[int]:
        """One long segment merged pair by pair from a queue of (rank, place)."""
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < n and (m := self.merged.get((sym[i], sym[after[i]]))) is not None:
                heapq.heappush(queue, (int(self.rank[m]), i, sym[i], sym[after[i]]))

        for i in range(n):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = self.merged[a, b], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in sym if s >= 0]

    def ids(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in a row, unknown characters as the ids of their bytes, and their number per segment."""
        sym, counts = self.symbols(segments)
        odd = np.flatnonzero(sym >= self.size)
        if not len(odd):
            return sym.astype(np.int32), counts
        tail = [chr(x - self.size).encode() for x in sym[odd].tolist()]
        width = np.ones(len(sym), np.int64)
        width[odd] = [len(t) for t in tail]
        out = np.repeat(sym, width)
        out[np.repeat(sym >= self.size, width)] = self.byte_ids[np.frombuffer(b"".join(tail), np.uint8)]
        owner = np.repeat(np.arange(len(segments)), counts)
        return out.astype(np.int32), np.bincount(owner, weights=width, minlength=len(segments)).astype(np.int64)


class Encoder:
    """Ids of texts, with the segments met so far in a table of bounded size."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        find, known = self.pieces.segment.findall, self.known
        segments: list[str] = []
        per_text = []
        for text in column.to_pylist():
            found = find(" " + text.replace(SPACE, " ")) if text else []
            per_text.append(len(found))
            segments += found
        index = [known.get(s, -1) for s in segments]
        new = list(dict.fromkeys(s for s, i in zip(segments, index) if i < 0))
        if new:
            if len(known) + len(new) > KNOWN:
                self.clear()
                known, new = self.known, list(dict.fromkeys(segments))
            flat, count = self.pieces.ids(new)
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, flat])
            base = len(known)
            known.update(zip(new, range(base, base + len(new))))
            index = [known[s] for s in segments]
        index = np.array(index, np.int64)
        counts = self.count[index]
        values = self.flat[c.ranges(self.at[index], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(per_text)] if per_text else np.zeros(0, np.int64)
        return [c.lists(values, np.diff(np.r_[0, ends]), pa.int32())]


class Decoder:
    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)

    def text(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        p = self.pieces
        if len(ids) and (ids.min() < 0 or ids.max() >= p.size):
            raise ValueError("an id is outside the model")
        skip = np.zeros(len(ids), np.int64)
        first = (np.cumsum(counts) - counts)[counts > 0]
        skip[first] = p.spaced[ids[first]]  # the space that encoding put before the text
        width = p.shown_len[ids] - skip
        data = p.shown[c.ranges(p.shown_at[ids] + skip, width)]
        owner = np.repeat(np.arange(len(counts)), counts)
        at = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(np.bincount(owner, weights=width, minlength=len(counts)).astype(np.int64), out=at[1:])
        out = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(at), pa.py_buffer(data.tobytes()))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            raw = data.tobytes()
            out = pa.array([raw[a:b].decode("utf-8", "each_byte") for a, b in zip(at[:-1], at[1:])], pa.large_string())
        return out.cast(pa.string())


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text: no begin or end ids, no sampling. Null texts get an empty list."""
    return c.with_columns(df, text, [(ids, "array<int>", pa.list_(pa.int32()))], lambda: Encoder(model), 1 << 20)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for. Null lists give an empty text."""
    kept = df.select(*[F.col(f"`{x}`") for x in df.columns if x != text or x == ids])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"`{text}` string"])

    def run(batches):
        decoder = Decoder(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (2 << 20))) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                part = lists.slice(a, b - a)
                new = decoder.text(np.asarray(part.flatten(), np.int64), sizes[a:b])
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, new], [*batch.schema.names, text])

    return kept.mapInArrow(c.frugal(run), schema)


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids (decimal, joined by commas) and of the decoded text."""
    return df.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
