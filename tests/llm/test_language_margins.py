"""Margins learned per language, letters by Unicode category, and stages of the pipeline on columns with their helpers' names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tremorloom.llm import language_id

WORDS = {
    "en": "the cat and dog walked along river while children were playing with their friends near old house".split(),
    "de": "die katze und der hund gingen am fluss entlang während kinder mit ihren freunden beim alten haus spielten".split(),
}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(4, 60))), lang) for i, lang in enumerate(["en", "de"] * 150)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_few_labelled_rows_lie_below_the_learned_margins(labelled):
    dictionaries = language_id.learn_dictionaries(labelled, sample_docs=50)
    margins = language_id.learn_margins(labelled, dictionaries, skip_docs=50)
    assert set(margins) == {"en", "de"}
    found = language_id.language_id(labelled, dictionaries, margins=margins)
    assert found.where("rejected").count() <= 0.03 * 300
    strict = language_id.learn_margins(labelled, dictionaries, false_rejection=0.5, skip_docs=50)
    assert all(strict[lang] > margins[lang] for lang in margins)
    assert language_id.learn_margins(labelled, dictionaries, skip_docs=1000) == {}
    assert language_id.learn_margins(labelled.limit(0), {}) == {}


def test_numeric_signs_are_no_letters(spark, labelled):
    dictionaries = language_id.learn_dictionaries(labelled)
    odd = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ Ⅸ"), (3, "12 %"), (4, None), (5, "ª"), (6, "the old house")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(odd, dictionaries, margins={}).collect()}
    assert [d for d in found if found[d] == "und"] == [1, 2, 3, 4]


def test_columns_named_like_helpers_stay(spark, labelled, tmp_path):
    spark.createDataFrame([("b1", "no such passage stands in any of these documents at all today")], "item_id string, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    docs = labelled.limit(40).withColumn("row", F.lit("mine")).withColumn("row_key", F.lit("mine")).withColumn("Row_Key_", F.lit(7))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.where("row <> 'mine' OR row_key <> 'mine' OR Row_Key_ <> 7").isEmpty()
