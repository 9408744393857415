"""Near copies of one text that fall into many components, with ids in random order, against brute force."""

from __future__ import annotations

import itertools
import random

import pytest

from tremorloom.llm import ngram_join


def copies(n: int, words: int, edits: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def components(sets: dict[int, set], percent: int) -> dict[int, int]:
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("rounds", [0, ngram_join.PIVOT_ROUNDS])
def test_one_group_of_500_near_copies(spark, monkeypatch, rounds):
    texts = copies(500, 400, 9, 5)
    ids = random.Random(6).sample(range(10**9), len(texts))
    made: dict[str, int] = {}
    stash = ngram_join.stash

    def counted(df, name, *more):
        out = stash(df, name, *more)
        made[name] = out.count() if "pairs" in name else 0
        return out

    monkeypatch.setattr(ngram_join, "stash", counted)
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", rounds)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_join(docs, 5, 80).collect()}
    words = {i: t.split() for i, t in zip(ids, texts)}
    expected = components({i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in words.items()}, 80)
    assert found == expected
    assert 10 < len(set(expected.values())) < len(ids)
    assert max((n for name, n in made.items() if name.startswith("pivot-pairs")), default=0) <= len(ids)
    if rounds:
        assert made["cross-pairs"] < 20 * len(ids)
