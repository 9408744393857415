"""Exact dedup of a whole table in batches against one filled index."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tremorloom.llm import common, exact_dedup

SCHEMA = "doc_id long, text string, digest string, keep_id long"


def made() -> list[tuple]:
    """Texts with copies all over the ids, repeated rows, NULL and shared ids, columns named like results."""
    rng = random.Random(3)
    texts = [None, "", "A", "a", "Straße", "STRASSE", *(f"Text {i}" for i in range(30)), "long " * 50_000]
    rows = [(i, texts[min(rng.randrange(45), len(texts) - 1)], "clash", -1) for i in range(300)]
    rows += [(None, "only without an id", "x", 0)] * 2 + [(None, "Text 3", "x", 0), (77, "one", "x", 0), (77, "two", "x", 0)]
    return rows + [(250, "text 5", "again", 0)] * 23


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected(rows: list[tuple]) -> Counter:
    groups: dict[str, list] = {}
    for doc, text, *_ in rows:
        groups.setdefault(lower(text), []).append(doc)
    out: Counter = Counter()
    for text, ids in groups.items():
        stays = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).digest()
        for nth, doc in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)):
            out[doc, stays, len(ids), nth == 0, digest] += 1
    return out


def found(df) -> Counter:
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in df.collect())


@pytest.mark.parametrize("batches", [1, 2, 4, 9])
def test_any_number_of_batches_gives_the_same_rows(spark, monkeypatch, batches):
    monkeypatch.setattr(exact_dedup, "BLOCK", 7)  # the repeated row takes several blocks
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = exact_dedup.DigestIndex(spark, common.new_path(spark, "test-index"), 4)
    got = exact_dedup.exact_dedup(docs, index, batches=batches)
    known = index.rows().count()
    index.close()
    assert found(got) == expected(rows)
    assert known == len({lower(t) for _, t, *_ in rows})
    assert not spark.catalog.tableExists(index.table)


def test_ids_that_are_all_null_or_one_and_an_empty_table(spark):
    for rows in ([(None, "a", "", 0), (None, "A", "", 0)], [(5, "a", "", 0), (5, "b", "", 0)], []):
        index = exact_dedup.DigestIndex(spark, common.new_path(spark, "test-index"), 4)
        got = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), index, batches=4)
        assert found(got) == expected(rows)


def test_later_batches_meet_a_filled_index_without_moving_it(spark):
    index = exact_dedup.DigestIndex(spark, common.new_path(spark, "test-index"), 4)
    docs = spark.createDataFrame([(i, f"text {i % 50}", "", 0) for i in range(200)], SCHEMA)
    exact_dedup.exact_dedup(docs, index, batches=2)
    assert index.rows().count() == 50
    batch = common.stash(docs.select(F.sha2("text", 256).cast("binary").alias("digest")).distinct(), "batch")
    plan = index.unknown(batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's side


def test_buckets_grow_with_the_input():
    assert exact_dedup.buckets_for(0) == exact_dedup.buckets_for(10**6) == exact_dedup.BUCKETS
    assert exact_dedup.buckets_for(10**10) == 2500
    assert exact_dedup.buckets_for(10, 300) == 300
