"""The pipeline's near-duplicate stage against brute force over all pairs."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("xxhash")

from tidemark.llm import near_words


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def corpus(seed):
    """Originals, copies with some words replaced, texts that share a passage only, short and odd texts."""
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randint(0, 3000)}" for _ in range(n)]
    passage = words(60)
    texts = []
    for _ in range(30):
        own = words(rng.randint(6, 400)) + (passage if rng.random() < 0.5 else [])
        texts.append(own)
        for rate in (0.002, 0.01, 0.02, 0.03, 0.05):
            texts.append([f"x{rng.randint(0, 999)}" if rng.random() < rate else w for w in own])
        texts.append(own[:-max(1, len(own) // 5)])
    texts = [" ".join(t) for t in texts] + ["a b c", "A  b c", "a b d", None, "", " \t", " ".join(texts[0]).upper()]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return dict(zip(order, texts))


@pytest.mark.parametrize("block,sample,frequent", [(2000, 64, 8), (4, 1, 3)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block, sample, frequent):
    import corpus_pipeline

    for name, value in {"BLOCK": block, "SAMPLE": sample, "FREQUENT": frequent, "PAIRS": 50}.items():
        monkeypatch.setattr(near_words, name, value)
    texts = corpus(3)
    sets = {d: shingles(t) for d, t in texts.items()}
    up = {d: d for d in texts}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    near = 0
    for a in sorted(texts):
        for b in range(a):
            x, y = sets[a], sets[b]
            if (not x and not y) or 5 * len(x & y) >= 4 * len(x | y):
                near += texts[a] != texts[b]
                lo, hi = sorted((root(a), root(b)))
                up[hi] = lo
    rows = [(d, t, None, None, None) for d, t in texts.items()] + [(None, texts[0], None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted({root(d) for d in texts}) and near > 60
    assert sum(r.doc_id is None for r in got) == 1
    assert near_words.kept(df.where("false")).count() == 0


def test_texts_of_a_template_are_linked_by_few_pairs(spark, monkeypatch):
    rng = random.Random(8)
    fixed = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
    rows = [(k, " ".join([*fixed[:150], f"own{k}", *fixed[150:], f"end{k % 3}"])) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    count, stored = {}, near_words.c.stored

    def counted(table, label):
        out = stored(table, label)
        count[label] = count.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(near_words.c, "stored", counted)
    assert [r.doc_id for r in near_words.kept(df).collect()] == [0]
    assert count["candidates"] + count["near"] < 3 * len(rows)


def near_copies(seed, n=400, words=150):
    """Copies of one text, each with own words in one or two places: most pairs have the similarity, others have not."""
    rng = random.Random(seed)
    fixed = [f"w{rng.randint(0, 9999)}" for _ in range(words)]
    rows = []
    for k in range(n):
        own = list(fixed)
        for at in rng.sample(range(words), 1 + k % 2):
            own[at] = f"own{k}"
        rows.append((k, " ".join(own)))
    return rows


def test_a_large_group_of_near_copies_stores_few_pairs(spark, monkeypatch):
    rows = near_copies(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    count, stored = {}, near_words.c.stored

    def counted(table, label):
        out = stored(table, label)
        count[label] = count.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(near_words.c, "stored", counted)
    sets = {d: shingles(t) for d, t in rows}
    near = [(a, b) for b in sets for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    up = list(range(len(rows)))

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for a, b in near:
        lo, hi = sorted((root(a), root(b)))
        up[hi] = lo
    assert sorted(r.doc_id for r in near_words.kept(df).collect()) == sorted({root(d) for d in up})
    assert len(near) > 20 * len(rows) and count["candidates"] + count["near"] < 5 * len(rows)


def test_the_stage_takes_pairs_of_linked_fingerprints(spark, monkeypatch):
    """Pairs come from the pivot tables of simhash over five-word shingles, not from the sets alone."""
    asked, links = [], near_words.simhash.links

    def seen(prints):
        asked.append(prints.count())
        return links(prints)

    monkeypatch.setattr(near_words.simhash, "links", seen)
    rows = near_copies(2, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    near_words.kept(df).collect()
    assert asked == [40]
    marked = near_words.signatures(df.withColumnRenamed("doc_id", "node"), 5)
    held = {r.node: r for r in marked.collect()}
    for k in (0, 17):
        assert held[k].simhash % 2 ** 64 == int(near_words.simhash.fingerprints([rows[k][1]], 5)[0])
    for a, b in ((0, 1), (5, 30)):
        differ = sum(bin((held[a][m] ^ held[b][m]) % 2 ** 64).count("1") for m in near_words.SKETCH)
        assert 0 < differ <= len(shingles(rows[a][1]) ^ shingles(rows[b][1]))


def test_every_different_text_has_a_fingerprint(spark, monkeypatch):
    """A text that shares no shingle is no less in the pivot tables; whatever linked fingerprints propose is compared as whole sets."""
    lone = [(100 + k, f"lone{k} " + " ".join(f"l{k}x{j}" for j in range(30))) for k in range(20)]
    asked, compared, links, verified = [], [], near_words.simhash.links, near_words.verified
    ends = near_words.simhash.fingerprints([t for _, t in lone[:2]], 5).view(np.int64).tolist()

    def seen(prints):
        asked.append(prints.count())
        return links(prints).unionByName(spark.createDataFrame([tuple(ends)], "a long, b long"))

    def tried(pairs, texts, words, similarity):
        compared.append((pairs.count(), pairs.join(texts.selectExpr("node AS a"), "a").join(texts.selectExpr("node AS b"), "b").count()))
        return verified(pairs, texts, words, similarity)

    monkeypatch.setattr(near_words.simhash, "links", seen)
    monkeypatch.setattr(near_words, "verified", tried)
    rows = near_copies(2, 40) + lone
    df = spark.createDataFrame(rows + [(900, lone[0][1]), (901, ""), (902, None)], "doc_id long, text string")
    got = sorted(r.doc_id for r in near_words.kept(df).collect())
    assert asked == [60] and compared[0][0] > 0 and all(wanted == there for wanted, there in compared)
    assert {d for d, _ in lone} | {901} <= set(got) and not {900, 902} & set(got)
