"""Collocations: texts are read as often however many candidates there are; runs of words and the tries that count in them."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.test_bpe_codes_collocations import phrase_rows, plain_collocations
from tremorloom.llm import collocations


def test_texts_are_read_as_often_whatever_the_number_of_shards(spark):
    rows, read = phrase_rows(seed=3), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(2).mapInArrow(seen, "lang string, text string")
    for shard in (1_000_000, 20):
        before = read.value
        got = collocations.collocations(docs, 3, 10, 2000, shard_phrases=shard).collect()
        assert sorted(tuple(r) for r in got) == plain_collocations(rows, 3, 10, 2000, 50)
        assert read.value - before == 4 * len(rows)  # for words, two words, three words and their counts


def all_runs(pieces, longest):
    """Of the pieces of a language: from every position the longest run of 2 to ``longest`` words."""
    return Counter((lang, " ".join(p[i : i + longest])) for lang, p in pieces for i in range(len(p) - 1))


def test_runs_and_their_tries_are_exact_at_any_length():
    rng = random.Random(5)
    pieces = [(rng.choice(["en", "de"]), [rng.choice(["a", "b", "c", "dd", "e" * 9]) for _ in range(rng.randrange(40))]) for _ in range(200)]
    part = pa.record_batch({"lang": pa.array([lang for lang, _ in pieces]), "text": pa.array([" ".join(p).encode() for _, p in pieces], pa.binary())})
    for longest in (2, 3, 30):  # numbers of 30 words don't fit 64 bits at once
        runs = collocations.Words(part).runs([np.full(8, 255, np.uint8)] * longest)
        assert Counter(dict(zip(zip(runs.column("lang").to_pylist(), runs.column("run").to_pylist()), runs.column("n").to_pylist()))) == all_runs(pieces, longest)
        twice = collocations.added_up([runs, runs.slice(0, 50)])
        assert twice.num_rows == runs.num_rows and sum(twice.column("n").to_pylist()) == sum(runs.column("n").to_pylist()) + sum(runs.column("n").to_pylist()[:50])
        ranges = list(collocations.packed_runs(runs, 7))
        again = collocations.added_up([collocations.unpacked_runs(part) for part in ranges])
        assert sorted(again.to_pylist(), key=str) == sorted(runs.drop_columns(["pair"]).to_pylist(), key=str)
        trie = collocations.PhraseTrie(runs)
        f = trie.count(runs.column("n").to_numpy())
        found = {(runs.column("lang")[trie.rows[i]].as_py(), phrase): f[i] for _, hit, phrases in trie.phrases(f > 0) for i, phrase in zip(hit, phrases.to_pylist())}
        assert found == Counter((lang, " ".join(p[i : i + k])) for lang, p in pieces for k in range(2, longest + 1) for i in range(len(p) - k + 1))


def test_runs_of_no_words():
    none = pa.record_batch({"lang": pa.array(["en", "de"]), "text": pa.array([b"", b"one. two"], pa.binary())})
    assert collocations.Words(none).runs([np.full(8, 255, np.uint8)] * 3).num_rows == 0
    assert collocations.Words(none.slice(0, 0)).runs([np.full(8, 255, np.uint8)] * 3).num_rows == 0
