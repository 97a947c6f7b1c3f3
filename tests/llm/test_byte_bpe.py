"""Byte-level BPE against the library."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from tidemark.llm import byte_bpe, common as c, queries

SF = "/root/testdata/sf0.001"


def library(name):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path(name)), special_tokens={})


def test_every_code_point_is_split_as_the_library_does():
    enc, find = library("byte_bpe_50k.tiktoken"), byte_bpe.splitter(P.PATTERN).findall
    for point in [*range(0xD800), *range(0xE000, 0x30000, 7)]:
        text = f"a{chr(point) * 2}1 {chr(point)}b"
        assert sum((enc._core_bpe.encode_single_piece(w.encode()) for w in find(text)), []) == enc.encode_ordinary(text), hex(point)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_equal_the_library(spark, name):
    rng = random.Random(4)
    texts = ["".join(rng.choice("  aabcdeehilnoorstt\n'ÄéñЖ日本😀.!0129_\t​\u0085") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["a" * k for k in range(30)] + ["ababab" * 50, "na" * 3000, " " * 500, "<|endoftext|>", "I'll we've 'Tis", "x" * 50_000]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(4000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    out = byte_bpe.decode(byte_bpe.encode(df, P.path(name), P.PATTERN), P.path(name)).collect()
    enc = library(name)
    assert len(out) == len(texts)
    for r in out:
        assert r.ids == enc.encode_ordinary(r.text) and bytes(r.decoded) == r.text.encode()


def test_small_slices_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE_BYTES", 10)
    df = spark.createDataFrame([(k, "some words that come again " * k) for k in range(8)], "doc_id long, text string")
    enc = library("byte_bpe_50k.tiktoken")
    assert all(r.ids == enc.encode_ordinary(r.text) for r in byte_bpe.encode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect())


def test_odd_rows(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    rows = [(1, None, "x", 1, "a"), (2, "", None, 2, "b"), (None, "no id", "z", 3, "c"), (5, "twice", "z", 4, None), (5, "twice", "z", 4, None), (6, "long words " * 30_000, "z", 5, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, docs int, `t.c0` string")
    out = byte_bpe.encode(df, path, P.PATTERN)
    assert out.columns == ["doc_id", "text", "docs", "t.c0", "ids"]
    enc = library("byte_bpe_50k.tiktoken")
    assert sorted((r.doc_id or 0, r.docs, len(r.ids)) for r in out.collect()) == sorted((r[0] or 0, r[3], len(enc.encode_ordinary(r[1] or ""))) for r in rows)
    assert byte_bpe.encode(df.where("false"), path, P.PATTERN).count() == 0
    ids = spark.createDataFrame([(1, None), (2, []), (3, [50255, 262]), (4, [50256]), (5, [-1]), (6, [None])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in byte_bpe.decode(ids, path).collect()}
    assert got[1] is None and bytes(got[2]) == b"" and bytes(got[3]) == enc.decode_bytes([50255, 262]) and got[4] is got[5] is got[6] is None


def test_a_vocabulary_of_another_kind_is_refused(tmp_path):
    lines = [(bytes([b]), b) for b in range(256)]
    path = tmp_path / "ranks"
    write = lambda rows: path.write_text("\n".join(f"{base64.b64encode(p).decode()} {r}" for p, r in rows))
    write([*lines, (b"abc", 300)])  # neither ab nor bc is a piece
    with pytest.raises(ValueError, match="don't make"):
        byte_bpe.Table(str(path)).merges()
    write(lines[1:])
    with pytest.raises(ValueError, match="byte"):
        byte_bpe.Table(str(path))
    write([*lines[:-1], (b"\xff", 3)])
    with pytest.raises(ValueError, match="distinct"):
        byte_bpe.Table(str(path))


def test_query(spark):
    enc = library("byte_bpe_50k.tiktoken")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for r in docs:
        ids = enc.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha(enc.decode_bytes(ids))))
    got = queries.QUERIES["op13_byte_bpe"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and {tuple(r) for r in got.collect()} == want


def test_pieces_and_words_are_those_of_the_pattern():
    find, rng = byte_bpe.splitter(P.PATTERN).findall, random.Random(3)
    letters = "  \n\t \rab'sll1.!é日 \u0085\x1c"
    texts = ["".join(rng.choice(letters[:rng.choice([8, 14, 19, 22])]) for _ in range(rng.randint(0, 14))) for _ in range(9000)]
    for some, spaced in [(texts[k:k + 50], True) for k in range(0, 9000, 50)] + [(texts, True), (texts, False), ([], True), (["", ""], True), ([" ", "", "\n"], True)]:
        words, places, counts = byte_bpe.split(pa.array(some, pa.large_string()), find, spaced)
        words, ends = words.to_pylist(), np.cumsum(counts)
        assert [[words[k] for k in places[e - n:e]] for e, n in zip(ends, counts)] == [find(x) for x in some]


def test_only_distinct_pieces_beyond_ascii_are_matched():
    find, seen = byte_bpe.splitter(P.PATTERN).findall, []
    words, places, _ = byte_bpe.split(pa.array(["plain words, 12 and it's été  \n"] * 500, pa.large_string()), lambda x: seen.append(x) or find(x), True)
    assert seen == ["'s\n été"] and len(words) == 9 and len(places) == 9 * 500


def test_merges_are_the_pieces_inside_each_word():
    table, rng = byte_bpe.Table(P.path("byte_bpe_50k.tiktoken")), random.Random(5)
    table.plant()
    words = ["", "a", " the", "information" * 3, "x" * 300] + ["".join(rng.choice("etaoin é日") for _ in range(rng.randint(1, 20))) for _ in range(500)]
    ranks, counts = table.inside(*c.bytes_of(pa.array(words, pa.large_string())))
    ends = np.cumsum(counts)
    for word, end, n in zip(words, ends, counts):
        raw = word.encode()
        assert ranks[end - n:end].tolist() == sorted({table.ranks[raw[i:j]] for i in range(len(raw)) for j in range(i + 2, len(raw) + 1) if raw[i:j] in table.ranks})


def test_another_pattern(spark):
    pattern, path = r"\p{L}+|\d{1,2}|\s|[^\s\p{L}\d]", P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    df = spark.createDataFrame([(1, "it's  été 12345, yes no"), (2, None), (3, "it's a test")], "doc_id long, text string")
    assert all(r.ids == enc.encode_ordinary(r.text or "") for r in byte_bpe.encode(df, path, pattern).collect())
