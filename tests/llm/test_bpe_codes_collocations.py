"""BPE, vector codes and collocations against the library and brute force, with NULLs, ties, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import SCHEMA, made
from tremorloom.llm import bpe, collocations, queries, vector_codes


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


# --- op11 -----------------------------------------------------------------------------------------------------


def test_bpe_of_odd_texts_is_the_librarys(tokenizer):
    rng = random.Random(11)
    letters = "abcdeABCDE'stremvld <|>endoftext́̀é½²٣  \x1f\x85​中文\U0001f600ΣσΩ.,!?0123456789\n\t가ᅡ"
    odd = ["", " ", "A<|ENDOFTEXT|>b <|endoftext|> x<|startoftext|><|endoftext|>y", "'s't're've'll'd's", "e<|endoftext|>́e", "a" * 3000, "ab" * 2500 + "!" * 99]
    odd += ["".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(8000)]
    model = bpe.BpeModel(bpe.vocabulary_path())
    ids, starts = model.encode(pa.array([t.encode() for t in odd], pa.binary()))
    texts = model.decode(ids, starts).to_pylist()
    for i, want in enumerate(tokenizer.encode_batch(odd, add_special_tokens=False)):
        assert ids[starts[i] : starts[i + 1]].tolist() == want.ids, odd[i]
        assert texts[i].decode() == tokenizer.decode(want.ids, skip_special_tokens=False)


def plain_merges(model: bpe.BpeModel, piece: bytes) -> list[int]:
    """Merge the leftmost pair of the lowest rank until there is none, by looking at all pairs each time."""
    symbols = [int(model.inner[b]) for b in piece[:-1]] + [int(model.last[piece[-1]])]
    while len(symbols) > 1:
        ranks = model.pair_ranks(np.array(symbols[:-1]), np.array(symbols[1:]))
        at = int(ranks.argmin())
        if ranks[at] == bpe._NONE:
            break
        symbols[at : at + 2] = [int(model.merged[ranks[at]])]
    return symbols


def test_segment_trees_merge_as_plain_search_does():
    model, rng = bpe.BpeModel(bpe.vocabulary_path()), random.Random(2)
    pieces = [bytes(rng.choices(b"abcdeinrst", k=n)) for n in [1, 1, 2, 2, 3, 4, 5, 8, 9, 16, 17, 33, 64, 65, 200] * 5]
    assert [ids.tolist() for ids in model.merge(pieces)] == [plain_merges(model, p) for p in pieces]
    assert model.merge([]) == []


def test_bpe_caches_stay_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_RUNS", 5)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    model = bpe.BpeModel(bpe.vocabulary_path())
    for text in ("one two three four", "five. six. seven. eight. nine.", "one five. ten", "É é ÉÉ two"):
        ids, _ = model.encode(pa.array([text.encode()], pa.binary()))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bpe_query_over_all_kinds_of_rows(spark, tokenizer, tmp_path):
    rows = made()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op11_bpe(spark, str(tmp_path)).collect())
    want = []
    for doc, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc is None, doc or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.bpe_decode(bpe.bpe_encode(spark.createDataFrame([], SCHEMA))).count() == 0


# --- op12 -----------------------------------------------------------------------------------------------------


def plain_lloyd(rows, parts, entries, rounds):
    kept = [(v, [int(np.floor(256 * np.float64(np.float32(x)))) for x in vec], label) for v, vec, label in rows if vec is not None and all(x is not None and np.isfinite(x) for x in vec)]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = lambda vec, p: vec[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1], p) for r in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda part, book: min((far(part, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own: dict = {}
            for _, vec, _ in kept:
                own.setdefault(near(cut(vec, p), books[p])[1], []).append(cut(vec, p))
            books[p] = [[sum(c) // len(own[i]) for c in zip(*own[i])] if i in own else e for i, e in enumerate(books[p])]
    out = []
    for v, vec, label in kept:
        found = [near(cut(vec, p), books[p]) for p in range(parts)]
        out.append((v, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
    return out, books


VECTORS = "vec_id long, embedding array<float>, label int, row long, entry string, pos int"


def vector_rows(n=150, dim=32, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist(), int(i % 4) if i % 7 else None) for i in range(n)]
    hot = rng.normal(size=dim).astype(np.float32).tolist()
    rows += [(n + i, hot, 1) for i in range(n // 2)]  # a third of all rows are one vector
    rows += [rows[3], rows[3], (None, rows[5][1], 2), (900, None, 1), (901, [None] + rows[0][1][1:], 1), (902, [float("nan")] + rows[0][1][1:], 1), (903, [float("inf")] * dim, 3)]
    return rows


@pytest.mark.parametrize("parts, entries, rounds, buckets", [(16, 64, 2, None), (8, 5, 3, 7), (2, 300 // 2, 1, 16), (4, 6, 0, None)])
def test_codes_equal_plain_lloyd(spark, parts, entries, rounds, buckets):
    rows = vector_rows()
    vectors = spark.createDataFrame([(*r, 9, "clash", 1) for r in rows], VECTORS).repartition(4)
    coded = vector_codes.vector_codes(vectors, parts, entries, rounds, buckets=buckets)
    want, books = plain_lloyd(rows, parts, entries, rounds)
    got = vector_codes.with_label_error(coded.rows).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted(((r["id"], r["code"], r["error"], r["label"]) for r in got), key=key) == sorted(want, key=key)
    assert [b.tolist() for b in coded.codebooks] == books
    sums = Counter()
    for _, _, error, label in want:
        sums[label] += error
    assert all(r["label_error"] == sums[r["label"]] for r in got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("members_")]


def test_codes_of_few_and_no_vectors(spark):
    rows = vector_rows()[:3]
    vectors = lambda some: spark.createDataFrame([(*r, 9, "clash", 1) for r in some], VECTORS)
    coded = vector_codes.vector_codes(vectors(rows))
    assert len(coded.codebooks[0]) == 3 and coded.rows.agg(F.sum("error")).first()[0] == 0
    nothing = vector_codes.vector_codes(vectors([(1, None, 1)]))
    assert nothing.rows.count() == 0 and nothing.codebooks == [] and vector_codes.with_label_error(nothing.rows).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(vectors([(1, [1.0] * 16, 1), (2, [1.0] * 32, 1)]))


def test_members_stay_with_their_owner_and_only_movers_are_shuffled(spark, monkeypatch):
    plans = []
    write = vector_codes.Members.write

    def keep_plan(self, rows, table):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(self, rows, table)

    sums = vector_codes.Members.sums

    def keep_sums(self):
        found = sums(self)
        plans.append("sums " + found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(vector_codes.Members, "write", keep_plan)
    monkeypatch.setattr(vector_codes.Members, "sums", keep_sums)
    vectors = spark.createDataFrame([(*r, 9, "c", 1) for r in vector_rows()], VECTORS)
    vector_codes.vector_codes(vectors, 4, 8, 3, buckets=4)
    owners = [p for p in plans if "FlatMapGroupsInArrow" in p]
    movers = [p for p in plans if "entry" in p and "NOT (entry" in p.replace("isnotnull", "")]
    assert len(owners) == 2 and all("Exchange" not in p and "Bucketed: true" in p for p in owners)
    assert len(movers) == 2 and all(p.count("Exchange") == 1 for p in movers)
    summed = [p for p in plans if p.startswith("sums")]
    assert len(summed) == 3 and all(p.count("Exchange hashpartitioning(pos") == 1 for p in summed)  # of a few rows an owner


# --- op13 -----------------------------------------------------------------------------------------------------


def plain_collocations(rows, longest, min_count, top, inside):
    import re

    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= inside * found.get((lang, words[i : i + k]), 1 << 60):
                    gone.add((lang, words[i : i + k]))
    out = []
    for lang in n:
        scored = []
        for (of, words), a in found.items():
            if of == lang and (of, words) not in gone:
                score, cut = min((1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
                scored.append((-score, -a, " ".join(words).encode(), f[lang, words[:cut]], f[lang, words[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(seed=7):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "Straße", "ñandú", "x\x0by", "a" * 40, "q", "r\x00s", "中文字", "b" * 8, "c" * 16, "d" * 17]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice(words[: 3 + i % 13]) + rng.choice([" ", "  ", "\t", ". ", ",", " ", " ", "\n"])
        rows.append((rng.choice(["en", "de", None, "und", ""]), text))
    return rows + [("en", None), ("fr", ""), ("en", "new york city " * 3000), rows[0], rows[0]]


@pytest.mark.parametrize("longest, min_count, top, shard, bits", [(3, 10, 2000, 1_000_000, 1 << 29), (4, 3, 15, 40, 64), (2, 1, 50, 1000, 1 << 12)])
def test_collocations_equal_plain_counts(spark, longest, min_count, top, shard, bits):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "lang string, text string, phrase string, n long, f long").repartition(5)
    got = collocations.collocations(docs, longest, min_count, top, shard_phrases=shard, max_bits=bits).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, longest, min_count, top, 50)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "too few words"), (None, None)], "lang string, text string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = 3_000_000_000
    schema = "lang string, phrase string, k int, f long"
    phrases = spark.createDataFrame([("en", "x y", 2, a)], schema)
    words = spark.createDataFrame([("en", "x", a + 7), ("en", "y", a + 11)], "lang string, word string, f long")
    totals = spark.createDataFrame([("en", 10 * a)], "lang string, n long")
    row = collocations.ranked(phrases, words, totals, 3, 10, 50).first()
    assert row["score"] == 1_000_000 * a * a // ((a + 7) * (a + 11))


def test_double_array_holds_exactly_its_paths():
    rng = np.random.default_rng(1)
    paths = np.unique(rng.integers(0, 256, (4000, 3)).astype(np.uint8) // rng.choice([1, 1, 40], (4000, 1)).astype(np.uint8), axis=0)
    lengths = np.where(np.arange(len(paths)) % 5 == 0, 2, 3)
    short = {}
    keep = [i for i, (p, n) in enumerate(zip(paths.tolist(), lengths)) if not (n == 2 and short.setdefault(tuple(p[:2]), i) != i)]
    paths, lengths = paths[keep], lengths[keep]
    trie = collocations.DoubleArray(paths, lengths)
    wanted = {tuple(p[:n]): i for i, (p, n) in enumerate(zip(paths.tolist(), lengths.tolist()))}
    for path in itertools.chain(wanted, map(tuple, rng.integers(0, 256, (500, 3)).tolist())):
        state = np.array([trie.root], np.int32)
        for digit in path:
            state = trie.step(state, np.array([digit], np.int32))
        assert (int(trie.accept[state[0]]) if state[0] else -1) == wanted.get(tuple(path), -1)
