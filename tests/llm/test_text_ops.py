"""Operators on texts against the libraries, brute force or round trips."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

from tidemark.llm import chunk_dedup, cuts, decontamination, katz, language_id, licenses, sentence_pieces, suffix_dedup, token_files

ODD = [(1, None, "x"), (2, "", "x"), (3, " ", "x"), (4, "same text here", "y"), (5, "same text here", "y"), (5, "same text here", None),
       (None, "no id", "z"), (6, "long " * 60_000, "z"), (7, "ÄÖÜ ñandú 日本 ́ ", "z"), (8, "<s> </s> ▁ a", "z")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with those of the operators."""
    rows = [(d, t, s, [9], "d", 1) for d, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, ids array<int>, decoded string, spans int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def mess(seed, n, alphabet="  ab\tcdeéñ\n▁ aaaeht日本ﬁ́😀.!0_   "):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_sentence_pieces_equal_the_library():
    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = mess(1, 3000) + ["a" * k for k in range(40)] + [" " * k for k in range(40)] + ["the" * 2000 + " " * 5000 + "ana" * 2000]
    encoder, decoder = sentence_pieces.Encoder(model), sentence_pieces.Decoder(model)
    ids = encoder(pa.array(texts))[0]
    want = [sp.encode(t) for t in texts]
    assert ids.to_pylist() == want
    back = decoder.text(np.asarray(ids.flatten(), np.int64), np.asarray(ids.value_lengths(), np.int64))
    assert back.to_pylist() == [sp.decode(i) for i in want]


def test_decoding_of_any_bytes_equals_the_library():
    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(5)
    ids = [[rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 8))] for _ in range(800)]
    got = sentence_pieces.Decoder(model).text(np.array(sum(ids, []), np.int64), np.array([len(i) for i in ids]))
    assert got.to_pylist() == [sp.decode(i) for i in ids]


def test_sentence_pieces_of_odd_rows(spark, odd, none):
    model = P.path("piece_bpe_32k.model")
    out = sentence_pieces.decode(sentence_pieces.encode(odd, model), model)
    rows = out.collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    assert len(rows) == len(ODD) and all(r.ids == sp.encode(r.text or "") for r in rows)
    assert all(r.decoded == sp.decode(r.ids) and r.spans == 1 for r in rows)
    assert sentence_pieces.decode(sentence_pieces.encode(none, model), model).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert sentence_pieces.decode(nulls, model).first().decoded == ""


def test_token_files_round_trip(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    extra = [(100 + i, t, "m", [1], "", 0) for i, t in enumerate(mess(2, 300, "abÀß'\",.!? \n\t 12²ΣİÅ　<|endoftext|>"))]
    df = odd.unionByName(spark.createDataFrame(extra, odd.schema)).where("doc_id is not null")
    token_files.write(df, path, str(tmp_path / "t"), end=1, shards=3)
    got = sorted(tuple(r) for r in token_files.read_documents(spark, str(tmp_path / "t")).collect())
    want, start = [], 0
    for d, t in sorted(((r.doc_id, r.text or "") for r in df.collect())):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted(x[2:] for x in got) == sorted(x[2:] for x in want)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    token_files.write(odd, path, str(tmp_path / "n"), end=1, shards=2)
    with_null = token_files.read_documents(spark, str(tmp_path / "n")).collect()
    assert len(with_null) == len(ODD) and [r.start for r in with_null if r.doc_id is None] == [0]
    token_files.write(none, path, str(tmp_path / "e"), end=1)
    assert token_files.read_documents(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 9, 1000], list(range(0, 3000, 7)), [10 ** 9] * 300])
def test_elias_fano(values):
    coded = token_files.EliasFano.of(np.array(values, np.uint64))
    again = token_files.EliasFano(*coded.parts())
    assert again.all().tolist() == values and [again.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        again.select(len(values))


def test_language_id(spark, odd, none):
    words = {"en": "the of and to house tree water", "de": "der die und zu haus baum wasser", "fr": "le la et de maison arbre eau", "es": "el la y de casa árbol agua"}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words[lang].split()) for _ in range(40)), lang) for i, lang in enumerate(list(words) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.trained(docs.where(~language_id.held_out()))
    out = language_id.identify(docs, model).where(language_id.held_out()).collect()
    assert out and all(r.lang == r.lang_pred and 0 <= r.lang_score <= 1 for r in out)
    strange = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert strange[1].lang_pred == strange[2].lang_pred == strange[3].lang_pred == "und" and strange[1].lang_score == 0
    assert strange[7].lang_pred != "und"
    assert language_id.identify(none, model).count() == 0
    nothing = language_id.trained(docs.where("false"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_one_language_only(spark):
    docs = spark.createDataFrame([(1, "abc", "xx"), (2, "def", "xx")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id.identify(docs, language_id.trained(docs)).collect()} == {"xx"}


MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_licenses(spark, odd, none):
    rows = [(1, MIT), (2, "Foo.\nReleased under the MIT License.\nbar"), (3, "Licensed under CC BY-NC 4.0. All rights reserved."), (4, None), (5, ""),
            (6, MIT.split("\n\n")[2] + "\n\n" + MIT.split("\n\n")[1]), (7, "a license to laugh")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licenses == "MIT" and got[1].sentence_ids == "mit-grant,mit-notice,mit-warranty"
    assert got[2].licenses == "MIT" and got[3].licenses == "CC-BY-NC-4.0,LicenseRef-proprietary"
    assert got[6].sentence_ids == "mit-notice,mit-grant" and got[6].licenses == ""  # out of order
    assert all(got[k].licenses == "" for k in (4, 5, 7))
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(none).count() == 0


def test_every_known_sentence_has_a_trigger_and_is_normal():
    for s in licenses.SENTENCES:
        assert re.search(licenses.TRIGGER, s) or licenses.SENTENCES[s] in ("apache-2-copy",) and "license" in s
        assert re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s)


WORDS = [f"w{i}" for i in range(200)]


def sentence(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def test_masks_hit_every_window():
    from itertools import combinations

    for bad in combinations(range(decontamination.WINDOW), decontamination.SUBSTITUTIONS):
        assert any(all(o + k not in bad for k, b in enumerate(m) if b == "1") for m in decontamination.MASKS
                   for o in range(decontamination.WINDOW - len(m) + 1))


@pytest.mark.parametrize("block_words", [4_000_000, 100])
def test_decontamination(spark, odd, none, block_words):
    rng = random.Random(7)
    items = [(i, " ".join(sentence(rng, n))) for i, n in enumerate([30, 13, 14, 20, 9, 5, 0, 40])] + [(None, " ".join(sentence(rng, 20))), (50, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs, want = [], set()
    for d in range(60):
        words = sentence(rng, rng.randint(0, 60))
        if d % 3 == 0:
            i = rng.choice([0, 1, 2, 3, 4, 7])
            item = items[i][1].split()
            if len(item) >= 13:
                k = rng.randint(0, len(item) - 13)
                item = item[k:k + 13]
                for p in rng.sample(range(13), d // 3 % 4):
                    item[p] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = item
        docs.append((d, " , ".join(words).upper()))
    for d, text in docs:
        w = text.lower().replace(",", " ").split()
        for i, t in items:
            v = (t or "").split()
            if len(v) >= 13:
                hit = any(sum(a == b for a, b in zip(w[x:x + 13], v[y:y + 13])) >= 11 for x in range(len(w) - 12) for y in range(len(v) - 12))
            else:
                hit = len(v) >= 8 and any(w[x:x + len(v)] == v for x in range(len(w)))
            if hit:
                want.add((d, -1 if i is None else i))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = decontamination.with_leaks(df, bench, block_words=block_words).collect()
    assert {(r.doc_id, x.item_id) for r in out for x in r.leaks} == want and want
    clean = decontamination.clean(df, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want} and clean.columns == df.columns
    assert decontamination.clean(odd, bench).count() == len(ODD)
    assert decontamination.clean(none, bench).count() == 0 and decontamination.clean(df, bench.where("false")).count() == 60


def removed(rows, span):
    """Brute force of the suffix operator: (n_bytes, n_removed, n_spans, kept) per row."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - span + 1):
            first[b[i:i + span]] = min(d, first.get(b[i:i + span], d))
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if first[b[i:i + span]] < d:
                gone[i:i + span] = True
        yield len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()


def planted(seed):
    rng = random.Random(seed)
    line = "the common line of words that everybody has"
    rows = [(i, rng.choice([None, "", "a" * rng.randint(0, 300), "ab" * rng.randint(0, 200)])) for i in range(20)]
    return rows + [(100 + i, "".join(rng.choice("aé") for _ in range(rng.randint(0, 80))) + line * rng.randint(0, 2)
                    + "x" * rng.randint(0, 60) + str(i % 3) * 30) for i in range(150)]


@pytest.mark.parametrize("hot, share", [(1_000_000, 1 << 24), (40, 3000)])
def test_suffix_dedup(spark, odd, none, monkeypatch, hot, share):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARE", share)
    rows = planted(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.without_repeats(df).collect()}
    assert got == dict(zip((d for d, _ in rows), removed(rows, 50)))
    assert suffix_dedup.without_repeats(odd).count() == len(ODD) and suffix_dedup.without_repeats(none).count() == 0


def test_many_shares_of_the_suffix_operator_are_few_tasks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARE", 20)
    monkeypatch.setattr(suffix_dedup, "FILTER_MOST", 28)
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", 28)
    rows = [(None if d == 120 else d, t) for d, t in planted(5)]
    bits = suffix_dedup.share_bits(sum(len((t or "").encode()) for _, t in rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tasks, stored = [], suffix_dedup.c.stored

    def seen(table, label):
        tasks.append(table.rdd.getNumPartitions())
        return stored(table, label)

    monkeypatch.setattr(suffix_dedup.c, "stored", seen)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.without_repeats(df).collect()}
    last = [((1 << 63) - 1 if d is None else d, t) for d, t in rows]
    assert got == dict(zip((d for d, _ in rows), removed(last, 50)))
    assert bits >= 10 and max(tasks) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_merged_transforms_order_and_common_prefixes():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 99, n).astype(np.uint8) for n in (300, 1, 90)]
    shard, place, common = suffix_dedup.merged(texts)
    heads = [np.tile(texts[s], 60)[p:p + 50].tobytes() for s, p in zip(shard, place)]
    assert heads == sorted(heads) and len(heads) == 391
    for a, b, n in zip(heads, heads[1:], common[1:].tolist()):
        same = next((k for k in range(50) if a[k] != b[k]), 50)
        assert n == (50 if same == 50 else same // 2 * 2)


def test_chunks_follow_content():
    rng = random.Random(2)
    text = "".join(rng.choice("abc deé日\n") for _ in range(20_000))
    arr = lambda *t: pa.array(t, pa.large_string())
    whole, _, start, size = chunk_dedup.digests(arr(text))
    assert start.tolist() == np.r_[0, np.cumsum(size)[:-1]].tolist() and size.sum() == len(text.encode()) and size.max() <= 260
    raw = text.encode()
    for a, n in zip(start.tolist(), size.tolist()):
        raw[a:a + n].decode()
    moved = chunk_dedup.digests(arr("zz" + text[3000:9000]))[0]
    known = set(map(tuple, whole.tolist()))
    assert sum(tuple(x) in known for x in moved.tolist()) >= len(moved) - 6
    assert len(chunk_dedup.digests(arr("", "")) [0]) == 0


def test_chunk_dedup(spark, odd, none):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    rows = [(1, text(50) + passage + text(50)), (2, text(30) + " x " + passage + " " + text(10)), (3, text(300)), (4, None), (5, ""), (6, text(80))]
    rows += [(7, rows[2][1]), (8, "short line " + text(5))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in chunk_dedup.without_repeats(df).collect()}
    assert got[1].n_removed == 0 and got[3].n_removed == got[6].n_removed == 0
    assert len(passage) - 140 <= got[2].n_removed <= len(passage) + 2 and got[2].n_spans == 1
    assert got[7].n_removed == got[7].n_bytes > 0 and bytes(got[7].kept) == b""
    for r in got.values():
        bytes(r.kept).decode()
    assert chunk_dedup.without_repeats(odd).count() == len(ODD) and chunk_dedup.without_repeats(none).count() == 0


def test_chunk_dedup_equals_brute_force(spark):
    rows = planted(8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    digests = {d: chunk_dedup.digests(pa.array([t or ""], pa.large_string())) for d, t in rows}
    owner = {}
    for d, (names, _, _, _) in digests.items():
        for x in map(tuple, names.tolist()):
            owner[x] = min(d, owner.get(x, d))
    want = {}
    for d, (names, _, start, size) in digests.items():
        seen, spans = set(), []
        for x, a, n in zip(map(tuple, names.tolist()), start.tolist(), size.tolist()):
            if owner[x] < d or x in seen:
                spans.append((a, n))
            seen.add(x)
        a, b = cuts.merged(*(np.array(v, np.int64) for v in (zip(*spans) if spans else ((), ()))))
        want[d] = int((b - a)[b - a >= chunk_dedup.SHORTEST].sum())
    assert {r.doc_id: r.n_removed for r in chunk_dedup.without_repeats(df).collect()} == want and any(want.values())


def katz_chunk(texts: list[np.ndarray], shares: int, hot: dict[tuple[int, int], int]) -> list[dict]:
    """The rows of a chunk of texts given as word ids, each with the count 1,000."""
    totals = katz.Totals(40_000, 50, len(texts), [5, 4, 3, 2, 1, 1], shares)
    pairs = np.array(list(hot), np.uint32).reshape(-1, 2)
    totals.keep_hot(katz.pair_key(pairs[:, 0], pairs[:, 1]), np.array(list(hot.values()), np.int64))
    word, n = np.concatenate(texts).astype(np.uint32), np.array([len(t) for t in texts])
    row = np.arange(len(texts)) + (7 << 33)
    return list(katz.chunk_rows([(row, row, np.zeros(len(texts), np.int8), n, word, np.full(len(word), 1000))], totals, 0))


def test_katz_chunks_deal_bytes_by_tokens_not_by_shares():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 3000, 40) for _ in range(1500)]
    size = {k: sum(len(r[f]) for r in katz_chunk(texts, k, {})[1:] for f in ("row", "held")) for k in (50, 200, 800, 3200)}
    assert all(x <= 5 * 1500 * 40 for x in size.values()) and size[3200] < 1.1 * size[800]


def test_katz_chunks_send_a_pair_once_a_text_and_no_hot_pair():
    long, short = np.zeros(20_000, int), np.array([1, 0, 0, 2])
    sent = lambda rows: {(int(np.repeat(np.frombuffer(r["history"], np.uint32), np.frombuffer(r["run"], np.uint32))[k]), int(w), r["first"] - (7 << 33) + int(np.frombuffer(r["row"], np.uint32)[np.frombuffer(r["of"], np.uint16)[k]])):
                         int(np.frombuffer(r["times"], np.uint32)[k]) if r["times"] else 1 for r in rows[1:] for k, w in enumerate(np.frombuffer(r["word"], np.uint32))}
    start = 2 ** 32 - 1
    want = {(start, 0, 0): 1, (0, 0, 0): 19_999, (start, 1, 1): 1, (1, 0, 1): 1, (0, 0, 1): 1, (0, 2, 1): 1}
    for shares in (1, 100):
        assert sent(katz_chunk([long, short], shares, {})) == want
    rows = katz_chunk([long, short], 100, {(0, 0): 900})
    assert sent(rows) == {k: n for k, n in want.items() if k[:2] != (0, 0)}
    f = lambda x, t: np.frombuffer(rows[0][x], t)
    assert list(zip(f("history", np.uint32), f("of", np.uint32), f("times", np.uint32))) == [(0, 0, 19_999), (0, 1, 1)]
    assert f("x", np.float64) == pytest.approx([19_999 * np.log10(0.9), np.log10(0.9)])


@pytest.mark.parametrize("options", [{}, {"share": 300}, {"share": 60}, {"vocabulary": 3, "share": 60}])
def test_katz_scores(spark, odd, none, options, monkeypatch):
    import math
    from collections import Counter, defaultdict
    from pyspark.sql import functions as F

    rng = random.Random(11)
    names = ["The", "of", "dog", "cat", "ran", "x,", "É"] + [f"n{i}" for i in range(40)]
    rows = [(d, " ".join(names[min(int(rng.expovariate(0.15)), len(names) - 1)] for _ in range(rng.randint(0, 60)))) for d in range(60)]
    rows += [(60, None), (61, "zzz yyy"), (62, "dog cat\x1f")]
    rows += [(63, "of the " * 40), (64, "dog " * 70), (65, "hot hot " * 30), (66, "of the dog " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    lower = lambda t: "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or "")
    texts = {d: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for d, t in rows}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    one, two = Counter(), Counter()
    for d, t in texts.items():
        if not out[d]:
            one.update(t)
            two.update(zip(["<"] + t, t))
    n, v = sum(one.values()), len(one)
    factors = lambda c: katz.discounts([Counter(c.values())[r] for r in range(1, katz.CUT + 2)])
    f1, f2 = factors(one), factors(two)
    unknown = sum((1 - f1[c - 1]) * c for c in one.values() if c <= katz.CUT) / n
    p1 = lambda w: unknown if one[w] == 0 else (f1[one[w] - 1] if one[w] <= katz.CUT else 1) * one[w] / n
    after = defaultdict(dict)
    for (h, w), c in two.items():
        after[h][w] = c

    def p2(h, w):
        if h not in after:
            return p1(w)
        total = sum(after[h].values()) + (min(after[h].values()) > katz.CUT)
        p = {x: (f2[c - 1] if c <= katz.CUT else 1) * c / total for x, c in after[h].items()}
        return p[w] if w in p else (1 - sum(p.values())) / (1 - sum(map(p1, p))) * p1(w)

    for h in list(after)[:5]:
        assert sum(p2(h, w) for w in one) + p2(h, "unknown") == pytest.approx(1)
    hot, found = [], katz.hot_pairs
    monkeypatch.setattr(katz, "hot_pairs", lambda *a: hot.append(found(*a)) or hot[-1])
    got = {r.doc_id: r for r in katz.scores(df, held, **options).collect()}
    assert len(got) == len(rows)
    shares = -(-n // options.get("share", katz.SHARE))
    many = max(n // (4 * shares), katz.CUT + 1)
    assert sorted(hot[0]["n"].to_pylist()) == sorted(x for x in two.values() if x > many)
    assert options.get("share") != 60 or hot[0].num_rows >= 4
    for d, t in texts.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[d], len(t), sum(one[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t))
        assert r.score == pytest.approx(sum(math.log10(p2(h, w)) for h, w in zip(["<"] + t, t)))
    assert katz.scores(odd, held, **options).count() == len(ODD) and katz.scores(none, held, **options).count() == 0
