"""Parts of runs in token files, and what a worker keeps of them."""

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from tidemark.llm import token_files

PATH = P.path("word_bpe_49k.json")
LETTERS = "abzÀÖ×ØÞß÷øÿ'\",.!?~ \n\t 129²ΣİÅ　\u0085\x1c\xa0<|>日😀"


def test_runs_differ_by_case_and_marks_only_once():
    parts, codes, ends, words = token_files.parted(pa.array(["Été, été ÉTÉ!", "", "it's 1a a1 ...", "(été)"], pa.large_string()))
    parts = parts.to_pylist()
    assert [parts[k] for k in codes] == ["été", ",", "été", "été", "!", "it's", "1a", "a1", "...", "(été)"]
    assert ends.tolist() == [5, 5, 9, 10] and [p for p, w in zip(parts, words) if w] == ["été"]


def test_ids_equal_the_library_in_any_slices(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [None, "", " ", "<|endoftext|>", "word " * 5000]
    for known in (token_files.KNOWN, 100):
        monkeypatch.setattr(token_files, "KNOWN", known)
        encoder = token_files.WordEncoder(PATH)
        for k in range(0, len(texts), 700):
            some, begin = texts[k:k + 700], 0
            values, ends = encoder(pa.array(some, pa.string()), 1)
            for text, end in zip(some, ends):
                assert values[begin:end].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [1], text
                begin = end
    values, ends = encoder(pa.array([], pa.string()), 1)
    assert len(values) == len(ends) == 0


def test_words_that_can_not_be_told_apart_go_alone():
    encoder = token_files.WordEncoder(PATH)
    encoder.joint = False
    values, ends = encoder(pa.array(["some words, here", "and some more"]), None)
    assert np.split(values, ends[:1])[1].tolist() == encoder.tokenizer.encode("and some more", add_special_tokens=False).ids


def test_a_worker_keeps_its_encoder_for_one_job():
    assert token_files.encoder_of(PATH, "a") is token_files.encoder_of(PATH, "a")
    assert token_files.encoder_of(PATH, "a") is not token_files.encoder_of(PATH, "b")
