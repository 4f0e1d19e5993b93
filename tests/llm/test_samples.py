"""Samples that models learn from count texts, not their copies."""

import os

import public_tokenizers

from basketlake.llm import common, language, packing, quality, toxicity


def test_copies_do_not_fill_the_language_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "Model", lambda rows: seen.append(len(rows)))
    texts = [(f"some text number {i} in words", lang) for lang in ("en", "de") for i in range(40)]
    df = spark.createDataFrame(texts, "text string, lang string")
    h = df.selectExpr("text", "xxhash64(text) h").orderBy("h").first()
    copies = spark.createDataFrame([(h.text, lang) for lang in ("en", "de")] * 500, "text string, lang string")
    language.fitted(df.union(copies), 40)
    assert seen == [40]


def test_rows_of_one_doc_id_are_bounded(spark):
    texts = [(1, "same") for _ in range(300)] + [(2, f"text {i}") for i in range(300)] + [(i, None) for i in (3, 3, 4)]
    picked = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    whole = common.labelled_rows(docs, picked, 1000).collect()
    assert len(whole) == 302 and sum(r.doc_id == 1 for r in whole) == 1 and sum(r.doc_id == 3 for r in whole) == 1
    assert common.labelled_rows(docs, picked, 50).count() == 50


def test_samples_of_both_models_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity.Machine, "fit", lambda self, rows, labels: seen.append(len(rows)))
    monkeypatch.setattr(quality, "_best_cut", lambda good, bad: seen.append(len(good) + len(bad)) or 0.0)
    docs = spark.createDataFrame([(i % 2, f"a text number {i % 400}") for i in range(1200)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0)], "doc_id long, toxic int, quality int")
    toxicity.fitted(docs, labels, 100)
    quality.fitted(docs, labels, 100)
    assert seen == [100, 100]


def test_short_texts_load_one_tokenizer():
    """Texts of usual length need `tiktoken` only; the other library is loaded for the first long one."""
    folder = os.path.dirname(public_tokenizers.path(f"{packing.VOCABULARY}.json"))
    packing._whole_text_encoder.cache_clear()
    short = packing.token_ids("two words", folder)
    assert packing._whole_text_encoder.cache_info().currsize == 0
    assert list(packing._whole_text_encoder(folder, packing.VOCABULARY).encode("two words", add_special_tokens=False).ids) == list(short)
