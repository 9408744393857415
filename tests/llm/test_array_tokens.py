"""Tokens hashed, sorted and looked up as arrays."""

from __future__ import annotations

from struct import pack

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tremorloom.llm import lm_scoring, token_counts
from tremorloom.llm.common import space_words

TEXTS = [
    b"", b"  ", b"foo", b"bar", b" a B\x0b\xff\xc3\x89 ", b"\ta\x00b\x0c\x1cx\x85y", b"a\x00 a", b"A" * 8 + b" " + b"a" * 9,
    b" ".join(b"x" * n for n in (7, 8, 9, 16, 17, 63, 64, 65, 200, 201)), b"x",
]


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
@pytest.mark.parametrize("start", [0, 1, 3, 9, 10])
def test_a_hash_for_each_word_and_end(kind, start):
    words = [[*space_words(t), lm_scoring.END] for t in TEXTS[start:]]
    hashes, sizes = lm_scoring._tokens(pa.array(TEXTS, kind).slice(start))
    assert sizes.tolist() == [len(w) for w in words]
    pairs = set(zip([w for ws in words for w in ws], hashes.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_order_sorts_keys_that_differ_in_low_bits_only(n):
    keys = np.random.default_rng(n).integers(0, 40, n, dtype=np.uint64) | np.uint64(1 << 63)
    order = lm_scoring._order(keys)
    assert sorted(order.tolist()) == list(range(n))
    assert (keys[order] == np.sort(keys)).all()


def test_planes_are_compressed():
    numbers = np.arange(100_000, dtype=np.int64)
    data = lm_scoring._planes(numbers)
    assert len(data) < 200_000
    assert (lm_scoring._from_planes(data, np.int64) == numbers).all()


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_hashes_come_back_from_their_differences(n):
    random = np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64)
    keys = np.sort(np.concatenate([random, np.array([0, 0, 1, 1 << 32, 1 << 40, (1 << 64) - 1, (1 << 64) - 1][: 3 * n], np.uint64)]))
    assert (lm_scoring._unpacked(lm_scoring._packed(keys)) == keys).all()
    assert lm_scoring._packed(random[:1])[4 : 4 + 4 * min(1, n)] == (random[:1] & np.uint64((1 << 32) - 1)).astype("<u4").tobytes()


def test_the_model_is_stored_as_arrays_with_its_hot_entries_apart(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FLUSH_NGRAMS", 50)
    random = np.random.default_rng(5).integers(-(1 << 63), 1 << 63, 300, dtype=np.int64).tolist()
    entries = {k: (k, i % 7, float(i), -0.5 * i) for i, k in enumerate(random)}
    model = spark.createDataFrame(list(entries.values()), "key long, n long, base double, value double").repartition(3)
    got = []
    for r in lm_scoring.packed_model(model, 4, 5).collect():
        keys = lm_scoring._unpacked(r["keys"])
        assert (np.diff(keys.astype(object)) > 0).all() and (r["bucket"] < 0 or set((keys >> np.uint64(60)).tolist()) == {r["bucket"]})
        values = (lm_scoring._from_planes(r[c], np.float64).tolist() for c in ("base", "value"))
        got += [(k, r["bucket"] < 0, *x) for k, *x in zip(keys.view(np.int64).tolist(), *values, strict=True)]
    assert sorted(got) == sorted((k, n >= 5, base, value) for k, n, base, value in entries.values())


def test_the_models_joins_hash_the_side_of_single_keys(spark, monkeypatch):
    plans, settled = {}, lm_scoring._settled

    def seen(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return settled(df, name)

    monkeypatch.setattr(lm_scoring, "_settled", seen)
    table = spark.createDataFrame([(i, "a b c d e") for i in range(3)], "doc_id long, text string")
    assert lm_scoring.lm_scoring(table, F.lit(True)).count() == 3
    for name in ("lower", "contexts", "probabilities", "model"):
        assert "ShuffledHashJoin" in plans[name] and "SortMergeJoin" not in plans[name]
    assert "MapInArrow" in plans["model"]


def test_sums_come_back_to_their_rows_whatever_the_slices(spark, monkeypatch):
    """Few bytes a slice and several tasks, NULL ids and repeated rows: each row gets the sums of its own n-grams."""
    texts = ["a b c d", "a b c e", "", None, "q r s", "a b c d", "c d x y z " * 30]
    table = spark.createDataFrame([(None if i % 5 == 3 else i, texts[i % len(texts)]) for i in range(120)], "doc_id long, text string")
    whole = lm_scoring.lm_scoring(table.coalesce(1), F.lit(True), share=1.0).collect()
    parts = lm_scoring.lm_scoring(table.repartition(7), F.lit(True), share=1.0).collect()
    assert len(whole) == len(parts) == 120

    def key(r):
        return (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))

    assert sorted(map(key, whole)) == sorted(map(key, parts))
    by_text = {}
    for r in parts:
        if r["doc_id"] is not None:
            by_text.setdefault(texts[r["doc_id"] % len(texts)] or "", set()).add((r["n_tokens"], r["n_known"], round(r["score"], 6)))
    assert all(len(found) == 1 for found in by_text.values())


def test_words_of_an_array_without_scalars():
    words = pa.array(["", "é", "ab", "c" * 300])
    assert token_counts.as_bytes(words) == [b"", "é".encode(), b"ab", b"c" * 300]
    assert token_counts.as_bytes(words.slice(2)) == [b"ab", b"c" * 300]
    assert token_counts.as_bytes(pa.array([], pa.string())) == []


def test_lookups_are_the_librarys():
    path = token_counts.vocabulary_path()
    words = ["word", "word,", "word!?", "word.).", "x1,", ",", "école.", "naïve", "9.5", "<|a|>,", "Ünder;", "word"]
    encode = token_counts.encoder(path).encode
    cache = token_counts.PretokenCache(path, lambda ids: pack(f"<{len(ids)}I", *ids), entries=6)
    for some in (words[:5], words[5:], words):
        known = cache.lookup([[w.encode() for w in some]])
        for w in some:
            assert known[w.encode()] == np.array(encode(w, add_special_tokens=False).ids, "<u4").tobytes()
