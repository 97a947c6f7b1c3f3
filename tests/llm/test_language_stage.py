"""The pipeline's language stage keeps texts with a letter, with and without labels."""

import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("xxhash")


@pytest.mark.parametrize("lang", [None, "en"])
def test_texts_with_a_letter_stay(spark, lang):
    import corpus_pipeline

    texts = ["some words", "日本", "é 1", None, "", " \t", "12 - 3!"]
    df = spark.createDataFrame([(d, t, lang, None, None) for d, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.language(spark, df, "")
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [0, 1, 2]
