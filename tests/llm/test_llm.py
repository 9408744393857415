"""The training-data operators against brute force on small tables with NULLs, ties, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tremorloom.llm import common, decontaminate, exact_dedup, language_id, license_scan, line_dedup, lm_scoring, ngram_join, packing, queries, simple8b
from tremorloom.llm import token_counts as counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, n_tokens long"


def made(seed: int = 1) -> list[tuple]:
    """Rows with copies, near copies, shared lines, NULLs, repeated rows and a very long text."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Straße", "ñandú", "don't", "x.", "MIT", "License"]
    base = [" ".join(rng.choices(words, k=n)) for n in (3, 9, 40, 120, 300)]
    texts = [None, "", " \n\t", "Only three words", "%%% ###", *base, *[t.upper() for t in base]]
    for t in base[2:] * 3:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    line = "This line stands in many documents of the table."
    texts += [f"{line}\n{rng.choice(words)} {i}\n {line.upper()} " for i in range(5)]
    texts += ["MIT license and Apache-License; the GNU General Public License", "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause */"]
    texts.append(" ".join(rng.choices(words, k=30_000)))
    rows = [(i, t, "en" if i % 3 else None, "s", None, 7, "clash", -1) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, "no id at all here", "en", None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Results by id, in sorted order within an id."""
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def words_of(text):
    return (text or "").encode().lower().split()


def test_token_counts_are_the_librarys(docs, rows, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(counts.vocabulary_path())
    got = by_id(counts.token_counts(docs, limit=50, table_size=20))
    for doc, text, *_ in rows:
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        for r in got[doc]:
            assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((text or "").encode()), n > 50)
    assert counts.token_counts(empty).count() == 0


def test_pretoken_cache_with_odd_texts_and_little_room():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(counts.vocabulary_path())
    cache = counts.PretokenCache(counts.vocabulary_path(), lambda ids: tuple(ids), entries=4)
    for text in ["a\x0bb c", "A<|ENDOFTEXT|>b <|endoftext|> x", "H̱x É", "don't. x's, 'S.", "re.### *. a-b", "÷ x÷y Ñ", "12ab3 ab1.", "​ab…. c", "ΑΣ"]:
        words = counts.pretokens(text.encode())
        table = cache.lookup([words])
        assert list(itertools.chain.from_iterable(table[w] for w in words)) == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 50)])
def test_ngram_join_finds_every_link(docs, rows, empty, words, percent):
    def shingles(text):
        w = words_of(text)
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()

    sets = {doc: shingles(text) for doc, text, *_ in rows if doc is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    for doc, found in by_id(ngram_join.ngram_join(docs, words, percent)).items():
        for r in found:
            assert r["component_id"] == (None if doc is None else find(doc))
            assert doc is None or r["n_shingles"] == len(sets[doc])
    assert ngram_join.ngram_join(empty).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_signatures_of_sets_at_the_limit_meet(percent):
    rng = np.random.default_rng(3)
    for n in (1, 5, 6, 7, 20, 100, 700):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            most = n * (100 - percent) // 100 + 1
            gone = int(rng.integers(0, most))
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, int(rng.integers(0, most))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                frequent = np.sort(rng.choice(a, n // 2, replace=False))
                assert len(np.intersect1d(ngram_join.signatures(a, percent, frequent), ngram_join.signatures(b, percent, frequent)))


def test_sketches_of_unequal_length_compare_by_folding(spark):
    rng = np.random.default_rng(5)
    items = np.unique(rng.integers(0, 2**63, ngram_join.SHORT_SET + 100).astype(np.uint64))
    other = np.unique(rng.integers(0, 2**63, ngram_join.SHORT_SET - 50).astype(np.uint64))

    def about(s):
        return (len(s), ngram_join.odd_sketch(s).tolist())

    near = items[: ngram_join.SHORT_SET - 50]
    assert len(about(items)[1]) == 4 * len(about(near)[1])
    rows = [(0, about(items), about(near)), (1, about(near), about(items)), (2, about(items), about(other)), (3, about(items), about(items))]
    side = "struct<n:long,sketch:array<long>>"
    pairs = spark.createDataFrame(rows, f"i int, x {side}, y {side}")
    found = {r["i"]: r["room"] for r in pairs.select("i", ngram_join._possible(80).alias("room")).collect()}
    assert found == {0: True, 1: True, 2: False, 3: True}


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {r["id"]: r["component"] for r in ngram_join.connected(chain).collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_license_scan_against_a_plain_search(docs, rows, empty):
    got = by_id(license_scan.license_scan(docs))
    for doc, text, *_ in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        places = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        for r in got[doc]:
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
            assert r["base_labels"] == ",".join(sorted({x for _, x in places})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
            assert 0 <= r["score"] <= 1
    tagged = next(r for found in got.values() for r in found if r["expressions"])
    assert tagged["labels"] == "apache,bsd,mit" and tagged["permitted"] and tagged["score"] == 1
    assert license_scan.license_scan(empty).count() == 0


def test_licence_expressions():
    ev = license_scan.evaluate
    assert ev("MIT") == (frozenset({"mit"}), True)
    assert ev("GPL-2.0-only OR MIT")[1] and not ev("GPL-2.0-only AND MIT")[1]
    assert ev("MIT OR GPL-3.0 AND GPL-2.0")[1] and not ev("(MIT OR Apache-2.0) AND GPL-2.0")[1]
    assert ev("GPL-2.0 WITH Classpath-exception-2.0")[1] and not ev("GPL-2.0 WITH other-exception")[1]
    assert ev("MIT and some words behind it"[:4])[1]
    for bad in ("", "AND MIT", "(MIT", "MIT OR", ")"):
        with pytest.raises(ValueError):
            license_scan.postfix(bad)


def test_lm_scoring_against_plain_formulas(spark, docs, rows, empty):
    train = [text for doc, text, *_ in rows if doc is not None and doc % 4]
    c = Counter(w for t in train for w in [*words_of(t), b"<end>"])
    total, distinct = sum(c.values()), len(c)
    got = by_id(lm_scoring.lm_scoring(docs, F.col("doc_id") % 4 != 0))
    for doc, text, *_ in rows:
        tokens = [*words_of(text), b"<end>"]
        base = sum(log10((c[t] + 1) / (total + distinct + 1)) for t in tokens)
        for r in got[doc]:
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(c[t] > 0 for t in tokens), total)
            assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert lm_scoring.lm_scoring(empty, F.lit(True)).count() == 0
    none = lm_scoring.lm_scoring(docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == 0 for r in none)


def automaton_of(texts):
    """The automaton of all tokens and of the n-grams seen twice, by plain counts."""
    base, ends = lm_scoring._BASE, [[*words_of(t), lm_scoring.END] for t in texts]
    c = Counter(w for t in ends for w in t)
    bi = Counter(g for t in ends for g in zip(t, t[1:]))
    tri = Counter(g for t in ends for g in zip(t, t[1:], t[2:]))
    frequent = sorted(c.items(), key=lambda x: (-x[1], x[0]))
    ids = {w: i for i, (w, _) in enumerate(frequent, 1)}
    two = sorted((ids[a] * base + ids[b], n, (a, b)) for (a, b), n in bi.items() if n > 1)
    at = {g: i for i, (_, _, g) in enumerate(two)}
    three = sorted((at[g[:2]] * base + ids[g[2]], n) for g, n in tri.items() if n > 1)
    orders = [(np.array([k for k, *_ in part], np.int64), np.array([n for _, n, *_ in part], np.int64)) for part in (two, three)]
    total = sum(c.values())
    made = lm_scoring.build_automaton(frequent, total, len(c), orders)
    rest = log10(total + len(c) + 1)
    return lambda text: made.score([ids.get(w, 0) for w in [*words_of(text), lm_scoring.END]]) - rest * sum(w not in ids for w in words_of(text))


@pytest.mark.parametrize("share", [lm_scoring.SHARE, 0.01, 1.0])
def test_lm_scores_are_the_automatons_whatever_is_broadcast(docs, rows, share):
    score = automaton_of([text for doc, text, *_ in rows if doc is not None and doc % 4])
    got = by_id(lm_scoring.lm_scoring(docs, F.col("doc_id") % 4 != 0, share=share))
    for doc, text, *_ in rows:
        assert all(r["score"] == pytest.approx(score(text)) for r in got[doc])


def test_an_ngram_seen_twice_counts_in_a_large_corpus(spark):
    texts = ["a b c d"] * 2 + ["x y " * 800_000]
    table = spark.createDataFrame(list(enumerate([*texts, "a b c d", "b a d c"])), "doc_id long, text string")
    score = automaton_of(texts)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.lm_scoring(table, F.col("doc_id") < 3).collect()}
    assert got[3] == pytest.approx(score("a b c d")) and got[4] == pytest.approx(score("b a d c")) and got[3] > got[4] + 5


def test_the_automatons_probabilities_sum_to_one():
    text = [1, 2, 1, 2, 3, 1, 2, 3, 1, 1]
    frequent = [(b"a", 5), (b"b", 3), (b"c", 2)]
    bi = Counter((a, b) for a, b in zip(text, text[1:]))
    tri = Counter(zip(text, text[1:], text[2:]))
    base = lm_scoring._BASE
    keys2 = sorted(a * base + b for (a, b), n in bi.items() if n > 1)
    n2 = [bi[(k // base, k % base)] for k in keys2]
    keys3 = sorted(keys2.index(a * base + b) * base + c for (a, b, c), n in tri.items() if n > 1)
    n3 = [tri[(keys2[k // base] // base, keys2[k // base] % base, k % base)] for k in keys3]
    made = lm_scoring.build_automaton(frequent, 10, 3, [(np.array(keys2), np.array(n2)), (np.array(keys3), np.array(n3))])
    unseen = 1 - sum((n + 1) / 14 for _, n in frequent)
    for context in ([], [1], [2], [1, 2], [2, 3], [3, 1]):
        start = made.score(context)
        left = made.score([*context, 0]) - start  # all failure weights down to the root
        assert sum(10 ** (made.score([*context, t]) - start) for t in (1, 2, 3)) + unseen * 10**left == pytest.approx(1)


def test_line_dedup_against_a_plain_version(docs, rows, empty):
    holders: dict = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    for doc, text, *_ in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 20:
                    holders.setdefault(key(line), set()).add(doc)
    keeper = {k: max(d) for k, d in holders.items() if len(d) >= 3}
    got = by_id(line_dedup.line_dedup(docs))
    assert sum(map(len, got.values())) == len(rows) and keeper
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or doc >= keeper.get(key(x), doc)]
        for r in got[doc]:
            assert (r["n_lines"], r["n_dropped"], r["text"]) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert line_dedup.line_dedup(empty).count() == 0


def test_language_id_on_held_out_rows(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    dictionaries = language_id.learn_dictionaries(table.where(train))
    rated = language_id.language_id(table.where(~train), dictionaries).join(table, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rated) >= 0.95 * len(rated) and not any(r["rejected"] for r in rated)
    odd = language_id.language_id(docs, dictionaries).where("lang_pred = 'und'").join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    assert odd and all(r["rejected"] and r["score"] == 0 and not re.search(r"[^\W\d_]", r["text"] or "") for r in odd)
    assert language_id.language_id(empty, dictionaries).count() == 0
    assert {r["lang_pred"] for r in language_id.language_id(docs, language_id.learn_dictionaries(empty)).collect()} == {"und"}


def test_language_id_rejects_ties_unlearned_languages_and_mixtures(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    held = [r for r in table.where(~train).collect() if len((r["text"] or "").split()) >= 60]
    dictionaries = language_id.learn_dictionaries(table.where(train))

    def rejected(texts, known):
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = language_id.language_id(frame, known, margin_share=language_id.MARGIN_SHARE).collect()
        assert len(found) == len(texts) > 0
        return sum(r["rejected"] for r in found) / len(texts)

    start = lambda r, n: " ".join(r["text"].split()[:n])
    one = next(iter(dictionaries.values()))
    assert rejected([start(r, n) for r in held for n in (6, 60)], {"a": one, "b": one}) == 1
    assert rejected([start(r, 12) for r in held], dictionaries) <= 0.2
    for gone in dictionaries:
        others = {k: v for k, v in dictionaries.items() if k != gone}
        own = [r for r in held if r["lang"] == gone]
        assert rejected([r["text"] for r in own], others) >= 0.9
        assert rejected([start(r, 12) for r in own], others) >= 0.5
    pairs = [(a, b) for a, b in itertools.combinations(held, 2) if a["lang"] != b["lang"]]
    turns = [" ".join(itertools.chain.from_iterable(zip(a["text"].split()[:200], b["text"].split()[:200]))) for a, b in pairs[::5]]
    assert rejected(turns, dictionaries) >= 3 * rejected([r["text"] for r in held], dictionaries) and rejected(turns, dictionaries) >= 0.2


def test_a_long_labelled_text_is_learned_from(spark):
    long = spark.createDataFrame([(1, "mira " * 4000, "xx"), (2, "", "yy"), (3, None, "zz")], "doc_id long, text string, lang string")
    learned = language_id.learn_dictionaries(long)
    assert list(learned) == ["xx"] and 8000 < len(learned["xx"]) <= 8192


def test_optimal_buckets_and_batches(spark, docs, empty):
    rng = random.Random(5)
    for _ in range(20):
        histogram = {k: rng.randrange(1, 9) for k in rng.sample(range(40), 7)}
        cost = lambda bounds: sum(n * (min(b for b in bounds if b >= k) - k) for k, n in histogram.items())
        top = max(histogram)
        best = min(cost([*c, top]) for r in range(3) for c in itertools.combinations(sorted(histogram)[:-1], r))
        bounds = packing.bucket_bounds(histogram, 3)
        assert len(bounds) <= 3 and cost(bounds) == best
    lengths = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("length"))
    packed = packing.pack(lengths, n_buckets=4, token_budget=1000, max_len=500, length_col="length").collect()
    want = Counter((r["doc_id"], r["length"]) for r in lengths.collect())
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["n_tokens"]
    assert total == Counter({d: s for d in {d for d, _ in want} if (s := sum(n * c for (x, n), c in want.items() if x == d))}) or all(
        total[d] == sum(n * c for (x, n), c in want.items() if x == d) for d, _ in want
    )
    batches = Counter((r["bucket"], r["batch"]) for r in packed)
    sizes = {r["bucket"]: r["bucket_len"] for r in packed}
    for (bucket, batch), n in batches.items():
        full = max(1, 1000 // max(1, sizes[bucket]))
        last = max(b for k, b in batches if k == bucket)
        assert n == full if batch < last else n <= full
    assert len({(r["bucket"], r["batch"], r["place"]) for r in packed}) == len(packed)
    assert packing.pack(empty).count() == 0


def test_packing_is_in_the_tokenizers_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(9)
    table = [(1, "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/", k=12_000))), (2, "don't stop, it's well-known."), (3, None), (None, "x y")]
    frame = spark.createDataFrame(table, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    plain = Tokenizer.from_file(counts.vocabulary_path())
    want = {doc: len(plain.encode(text or "", add_special_tokens=False).ids) for doc, text in table}
    assert want[1] > 2048
    for packed in (queries.op7_packing(spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, frame, str(tmp_path))):
        got = by_id(packed)
        assert {doc: sum(r["n_tokens"] for r in found) for doc, found in got.items()} == want
        assert len(got[1]) == -(-want[1] // 2048) and all(r["n_tokens"] <= 2048 for r in got[1])
        assert all(r["bucket_len"] * (1 + max(p["place"] for found in got.values() for p in found)) <= 65_536 for r in got[1])


def test_simple8b_round_trips():
    rng = np.random.default_rng(1)
    for k in range(60):
        n, bits, block = int(rng.integers(0, 2000)), int(rng.integers(1, 65)), int(rng.choice([1, 7, 64, 512]))
        v = rng.integers(0, 2**bits if bits < 64 else 2**64 - 1, n, dtype=np.uint64)
        v[rng.random(n) < 0.3] = 0
        v[rng.random(n) < (0.02 if k % 3 == 0 else 0)] = 2**64 - 1
        assert np.array_equal(simple8b.decode(simple8b.encode(v, block)), v)
    with pytest.raises(ValueError):
        simple8b.decode(simple8b.encode(np.arange(100))[:-8])


def test_token_files_hold_every_document_in_order(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(counts.vocabulary_path())
    folder = common.new_path(spark, "test-ids")
    simple8b.write_token_ids(docs, folder)
    got = sorted(simple8b.read_token_ids(spark, folder).collect(), key=lambda r: r["start"])
    start = 0
    for r, (doc, text, *_) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc, start, len(ids))
        assert zlib.crc32(r["ids"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    simple8b.write_token_ids(empty, f"{folder}-empty")
    assert simple8b.read_token_ids(spark, f"{folder}-empty").count() == 0


def test_exact_dedup_in_batches(spark, docs, rows, empty):
    folder = common.new_path(spark, "test-index")
    got = exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex(spark, folder, 4)).collect()
    digest = lambda t: hashlib.sha256((t or "").encode().lower()).digest()
    groups: dict = {}
    for doc, text, *_ in rows:
        groups.setdefault(digest(text), []).append(doc)
    assert len(got) == len(rows)
    for r in got:
        own = groups[bytes(r["digest"])]
        assert (r["group_size"], r["keep_id"]) == (len(own), max((x for x in own if x is not None), default=None))
    assert sum(r["kept"] for r in got) == len(groups)
    # a second session meets the same index: only new texts stay
    again = exact_dedup.DigestIndex(spark, folder, 4)
    more = spark.createDataFrame([(900, rows[8][1]), (901, "a new text"), (902, "A NEW TEXT")], "doc_id long, text string")
    assert {r["doc_id"]: (r["kept"], r["keep_id"]) for r in exact_dedup.exact_dedup(more, again).collect()} == {
        900: (False, max(x for x in groups[digest(rows[8][1])])), 901: (False, 902), 902: (True, 902),
    }
    assert exact_dedup.exact_dedup(empty, again).count() == 0


def test_decontamination_against_a_plain_scan(spark, docs, rows, empty):
    items = [("7", rows[8][1][200:420]), ("10", "Only three WORDS"), ("x", None), ("y", " ... "), ("z", rows[7][1]), (None, "no id at all here")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = {i: {tuple(w[k : k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)} for i, t in items if i and (w := split(t))}
    got = by_id(decontaminate.decontaminate(docs, bench))
    for doc, text, *_ in rows:
        w = split(text)
        hit, found = set(), set()
        for i, own in windows.items():
            for m in {len(x) for x in own}:
                for k in range(len(w) - m + 1):
                    if tuple(w[k : k + m]) in own:
                        hit |= set(range(k, k + m))
                        found.add(i)
        for r in got[doc]:
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(found))
            assert {x for s in r["spans"] for x in range(s["first"], s["last"] + 1)} == hit
    assert any(r["n_hit"] for found in got.values() for r in found)
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("false")).where("n_hit > 0").count() == 0


def test_pipeline_stages_keep_columns_and_take_effect(spark, docs, tmp_path):
    spark.createDataFrame([("1", "Only three words")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    held, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.stash(stage(spark, held, str(tmp_path)), name)
        assert after.columns == docs.columns and after.join(held, "doc_id", "left_anti").where("doc_id IS NOT NULL").isEmpty()
        held = after
        sizes.append(held.count())
    assert docs.count() > sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    assert held.where("text = 'Only three words' OR text IS NULL").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == held.select("doc_id").distinct().count()


def test_pipeline_stages_decide_rows_without_or_with_shared_ids(spark, tmp_path):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(400)]
    a, b, c = (" ".join(rng.choices(words, k=60)) for _ in range(3))
    item = " ".join(rng.choices(words, k=12))
    spark.createDataFrame([("1", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = lambda table: spark.createDataFrame(table, "doc_id long, text string, lang string")

    def kept(stage, table):
        return Counter((r["doc_id"], r["text"]) for r in stage(spark, frame([(*r, "en") for r in table]), str(tmp_path)).collect())

    language = [(None, "%%% 12"), (None, a), (5, "123"), (5, b), (6, None)]
    assert kept(corpus_pipeline.language_stage, language) == Counter([(None, a), (5, b)])

    exact = [(None, a), (None, a), (None, a.upper()), (7, b), (7, b.upper()), (7, b), (3, b), (None, b), (8, c), (8, a[:50]), (9, c)]
    left = kept(corpus_pipeline.exact_stage, exact)
    best: dict = {}
    for doc, text in exact:  # the largest id of each text, NULL least
        best[text.lower()] = max(best.get(text.lower(), -1), -1 if doc is None else doc)
    assert Counter((text.lower(), -1 if doc is None else doc) for doc, text in left.elements()) == Counter(best.items())
    assert set(left) <= set(exact)

    near = [(None, a), (4, a + " more"), (2, a + " other"), (2, b), (None, c), (None, c + " end")]
    left = kept(corpus_pipeline.near_stage, near)
    assert {k: left[k] for k in near[:4]} == {near[0]: 0, near[1]: 0, near[2]: 1, near[3]: 1}
    assert left[near[4]] + left[near[5]] == 1

    hit = f"{a} {item} {b}"
    dirty = [(None, hit), (None, a), (1, hit), (1, c), (2, b), (2, b)]
    assert kept(corpus_pipeline.decontamination_stage, dirty) == Counter([(None, a), (1, c), (2, b), (2, b)])
