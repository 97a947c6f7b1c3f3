"""Spelling variants against brute force over all pairs of words."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def found(rows, shortest=7, every=31):
    counts = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += len(run) >= shortest
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[k + 1:] == (b[k + 1:] if len(a) == len(b) else b[k:])


def by_hand(rows, **parameters):
    words = found(rows, **parameters)
    masks = collections.defaultdict(set)  # only to keep the brute force quick: near words share one of these, checked below
    for w in words:
        for k in range(len(w) + 1):
            masks[w[:k] + w[k + 1:]].add(w)
        masks[w].add(w)
    out = {}
    for w, n in words.items():
        others = {x for k in range(len(w) + 1) for x in masks[w[:k] + w[k + 1:]]} | masks[w]
        close = [x for x in others if one_edit(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        out[w] = (n, len(close), best if best is not None and words[best] >= 10 * n else None)
    result = set()
    for w, (n, close, form) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        result.add((w, form, root, n, close, None if form is None else words[form]))
    return result


def test_masks_lose_nothing():
    rng = random.Random(1)
    some = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(120)]
    words = {w: 2 for w in some}
    got = {r[0]: r[4] for r in by_hand([(None, " ".join([w] * 2)) for w in words], shortest=1, every=1 << 40)}
    assert got == {w: sum(one_edit(w, x) for x in words) for w in words}


def texts(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(["ab", "ba", "an", "éo", "t", "aa", "ÿ", "st"]) for _ in range(rng.randint(3, 7))) for _ in range(25)]
    rows = []
    for k in range(n):
        own = []
        for _ in range(40):
            w = rng.choice(stems[:5] if rng.random() < 0.7 else stems)
            if rng.random() < 0.12:
                i, x = rng.randrange(len(w) + 1), rng.choice("abtéÿs")
                w = rng.choice([w[:i] + x + w[i:], w[:i] + w[i + 1:], w[:i] + x + w[i + 1:]])
            own.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((k, rng.choice([" ", "-", "1 ", "\n", "日"]).join(own)))
    return rows


@pytest.mark.parametrize(("words", "carried"), [(64, 64), (3, 64), (0, 9), (64, 0)])
def test_against_brute_force(spark, monkeypatch, words, carried):
    monkeypatch.setattr(spelling, "WORDS", words)
    monkeypatch.setattr(spelling, "CARRIED", carried)
    monkeypatch.setattr(spelling, "PAIRS", 50)
    rows = texts(words + carried, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = spelling.variants(df).collect()
    want = by_hand(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r.form is not None for r in got) > 10


def test_an_edit_keeps_the_unaffected_grams():
    """The lists that an edit leaves, merged, always hold the edited word, whatever grams are frequent."""
    rng = np.random.default_rng(3)
    for trial in range(60):
        word = "".join(rng.choice(list("abé"), rng.integers(7, 12)))
        frequent = [np.unique(rng.choice(spelling.codes(np.frombuffer(("ab\xe9" * 9 + word).encode("latin-1"), np.uint8), s), 6)) for s in (2, 3)]
        others = [word[:i] + x + word[i + 1:] for i in range(len(word)) for x in "abé"] + [word[:i] + x + word[i:] for i in range(len(word) + 1) for x in "abé"]
        data, at = spelling.letters(pa.array([word, *others]))
        of, key, gap, place, base = spelling.index_keys(data, at, frequent)
        rows = collections.defaultdict(set)
        for k in range(len(of)):
            rows[of[k]].add((key[k], place[k], base[k], gap[k]))
        for k, other in enumerate(others, 1):
            if other != word:
                assert any((x, p, b, False) in rows[0] or (x, p, b, True) in rows[0] for x, p, b, g in rows[k] if not g), (word, other)


def test_roots_follow_forms(spark):
    often = {"letters": 5000, "lettersx": 300, "lettersxy": 25, "lettersxyz": 2, "lattersxyz": 2}
    rows = [(k, " ".join([w] * 5)) for w, n in often.items() for k in range(n // 5 + 1)]
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {tuple(r) for r in got.values()} == by_hand(rows) and got["lettersxy"].form == "lettersx" and got["lettersxy"].root == "letters"


def test_odd_rows(spark):
    long = "q" + "ab" * 20_000
    rows = [(1, None), (2, ""), (None, "without an id: without"), (3, "equally equally"), (3, "equally equally"), (4, f"{long} {long} {long}x {long}x"), (5, "1234567 日本日本日本日本"),
            (6, "straße Straße STRASSEN strassen éÉÉÉÉÉÉ éÉÉÉÉÉÉ ×××××××÷÷÷÷÷÷÷ ×××××××÷÷÷÷÷÷÷")]
    df = spark.createDataFrame([(d, t, 1, "z", 2) for d, t in rows], "doc_id long, text string, word int, n string, id int")
    assert {tuple(r) for r in spelling.variants(df).collect()} == by_hand(rows)
    assert spelling.variants(df.where("false")).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op12_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and {tuple(r) for r in got.collect()} == by_hand(rows)
