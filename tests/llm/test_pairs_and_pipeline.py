"""Grouping operators against brute force, the queries' columns, and the pipeline."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
xxhash = pytest.importorskip("xxhash")

from tidemark.llm import common, embedding_dedup, simhash

SF = "/root/testdata/sf0.001"


def roots(n, links):
    forest = common.Forest()
    for a, b in links:
        forest.link(int(a), int(b))
    return [forest.root(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(500, k) for k in range(501, 540)] + [(7, 7)]
    want = common.Forest()
    for a, b in edges:
        want.link(a, b)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {n: want.root(n) for n in {x for a, b in edges if a != b for x in (a, b)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [None, "", " \t", "One", "one Two", "a b c", "a b c a b c a b c", "É é X Y z " * 40, "w " * 3000]
    assert simhash.fingerprints(texts).tolist() == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("block", [2000, 7])
def test_fingerprint_groups(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = []
    for c in centres:
        for _ in range(25):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(b)
            prints.append(x)
    prints += [0, 0, 1, 1 << 63]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    n = len(prints)
    ids = rng.permutation(n).tolist()
    arr = np.array(prints, np.uint64)
    links = [(a, b) for a in range(n) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 3]
    root = roots(n, links)
    least = {}
    for i, r in zip(ids, root):
        least[r] = min(i, least.get(r, i))
    df = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, simhash long").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.grouped(df).collect()}
    assert got == {i: least[r] for i, r in zip(ids, root)} and len(arr) == n


def test_simhash_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (9, "q " * 5000)]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, simhash int")
    got = simhash.components(df).collect()
    assert len(got) == 6 and {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3), (None, 3), (9, 9)}
    kept = simhash.kept(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 3, 9]
    assert simhash.components(df.where("false")).count() == 0


@pytest.mark.parametrize("block", [2048, 10])
def test_embedding_groups(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = []
    for k in range(12):
        centre = rng.standard_normal(16)
        for _ in range(12):
            rows.append(((centre + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.14, 0.2])).tolist(), int(k % 3)))
    rows += [(None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([1.0, None] + [0.0] * 14, 1), ([float("inf")] + [0.0] * 15, 1), (rows[0][0], None), (rows[0][0], 2),
             ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([], 1)]
    n = len(rows)
    ids = rng.permutation(n).tolist()
    good = [x is not None and lab is not None and None not in x and np.isfinite(np.array(x, float)).all() and np.any(np.array(x, float)) for x, lab in rows]
    links = []
    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and rows[a][1] == rows[b][1] and len(rows[a][0]) == len(rows[b][0]):
                x, y = np.array(rows[a][0]), np.array(rows[b][0])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((a, b))
    degree = np.bincount(np.array(links).ravel(), minlength=n)
    root = roots(n, links)
    least = {}
    for i, r in zip(ids, root):
        least[r] = min(i, least.get(r, i))
    df = spark.createDataFrame([(i, x, lab, "extra") for i, (x, lab) in zip(ids, rows)], "vec_id long, embedding array<double>, label int, row string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.groups(df.repartition(4)).collect()}
    assert got == {i: (degree[k], least[root[k]], i == least[root[k]]) for k, i in enumerate(ids)} and len(links) > 50
    assert embedding_dedup.groups(df.where("false")).count() == 0


COLUMNS = {
    "op3_simhash_groups": {"doc_id", "fingerprint", "component_id"},
    "op4_sentence_pieces": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op5_katz_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op6_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op7_embedding_groups": {"vec_id", "n_links", "component_id", "kept"},
    "op8_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op9_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
}


def test_queries_and_pipeline(spark):
    import corpus_pipeline
    from tidemark.llm import queries

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))
    for name, columns in COLUMNS.items():
        assert columns <= set(queries.QUERIES[name](spark, SF).columns)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, docs, SF), f"test-stage{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = out
    kept = {r.doc_id for r in docs.collect()}
    alone = {}
    for d, t in sorted(text.items()):
        alone.setdefault(t, d)
    assert kept <= set(alone.values())  # one of exact copies at most, the first
    assert corpus_pipeline.run(spark, SF).count() == len(kept)


def test_stages_on_odd_rows(spark):
    import corpus_pipeline

    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "only words here", "en", None, 15), (3, "only words here", "en", None, 15), (None, "no id at all", None, "s", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0
        assert stage(spark, docs, SF).count() >= 3
