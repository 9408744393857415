"""Margins are learned from every labelled row outside the dictionaries."""

from __future__ import annotations

import random
from math import sqrt

import numpy as np

from tests.llm.test_language_margins import WORDS
from tremorloom.llm import language_id


def test_margins_are_quantiles_of_all_labelled_rows(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(1, 30))), lang) for i, lang in enumerate(["en", "de"] * 700)]
    rows += [(None, text, lang) for _, text, lang in rows[:20]] + [(5000, None, "en"), (5001, "no language", None), (5002, "", "de")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    dictionaries = language_id.learn_dictionaries(labelled, sample_docs=40)
    used = {(r["id"], r["text"]) for r in language_id._first_rows(labelled, 40, 8192, "doc_id").collect()}
    made, margins = language_id.compressors(dictionaries, language_id.LEVEL), {"en": [], "de": []}
    for doc_id, text, lang in rows:
        if text and lang and (doc_id, text) not in used:
            ranked, compared = language_id.sizes(text, made)
            if ranked[0][1] == lang:
                margins[lang].append((ranked[1][0] - ranked[0][0]) / sqrt(compared))
    for share in (0.0, 0.01, 0.37, 1.0):
        got = language_id.learn_margins(labelled, dictionaries, share, skip_docs=40)
        assert set(got) == set(margins)
        for lang, least in got.items():
            assert abs(least - np.quantile(margins[lang], share)) < 1e-12
