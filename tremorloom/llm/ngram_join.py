"""N-gram Jaccard join (operator 2) by PartEnum signatures.

A text is the set of its distinct word shingles. Sets whose sizes lie in the same band differ in at most ``k`` elements if
their similarity reaches the threshold. The feature domain (64-bit hashes) is dealt into ``k + 1 + z`` parts, so two such sets
agree in full on ``z + 1`` parts at least: a signature stands for one part and what the set has there (subsets of size
one; deeper enumeration is not needed once the parts hold several elements each). Parts are ordered by what they hold: by
the number of elements besides very frequent shingles, then by hash. Each set leaves out its ``z`` lowest parts. The highest
of the ``z + 1`` parts that two sets agree on has ``z`` others below it in both, so both send it: no pair is lost, whatever
shingles are called frequent. A set takes part in its own band and, if a partner may be larger, in the next.

Signatures travel packed by hash range. A task first looks among its own: of the sets with one signature only the
least id goes on, so a signature carried by a third of all rows costs each task one row. Sets that share a
signature form a group; a group's members are compared with its least id, not with each other. While a group still lies in
several components, its members outside the largest one are compared with a pivot of that one, a few rounds long and each
linear in the group. Only sets that are in different components after that are compared with each other, if their sketches
leave room for a link. Every link is verified on whole shingle sets.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.llm.common import id_and_bytes, mix, space_words, stash, texts_of

BAND_STEPS = 2
FREQUENT_SHARE = 0.001
FREQUENT_LEAST = 8
SKETCH_WORDS = 16
#: the largest set with the shortest sketch; each further sketch is four times as long and serves sets four times as large
SHORT_SET = 96 * SKETCH_WORDS
FLUSH_SIGNATURES = 4_000_000
#: rounds with a pivot per mixed group; what they leave is compared in full, so the number decides on speed alone
PIVOT_ROUNDS = 3
PIVOT_ORDERS = 8
#: ids of a semi-join that are broadcast (16 MB); more are shuffled
BROADCAST_IDS = 1_000_000


@lru_cache(maxsize=8)
def bands(percent: int, largest: int = 1 << 40) -> tuple[list[int], list[int]]:
    """First and last set size of each band; a partner of a set lies in its band or a neighbour."""
    first, last, at = [], [], 1
    while at <= largest:
        first.append(at)
        last.append(max(at, at * 100**BAND_STEPS // percent**BAND_STEPS))
        at = last[-1] + 1
    return first, last


def parts_of(band: int, percent: int) -> tuple[int, int]:
    """``(parts, z)``: number of parts of a band and how many of its lowest parts a set leaves out."""
    k = (100 - percent) * 2 * bands(percent)[1][band] // (100 + percent)
    z = 0 if k == 0 else 2 + k // 2
    return k + 1 + z, z


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles; a text with fewer words is one shingle of its own."""
    split = [space_words(t) for t in texts]
    counts = [len(w) for w in split]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(split)), np.uint64, sum(counts))
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def chained(columns, seed: int) -> np.ndarray:
        h = np.full(len(columns[0]), np.uint64(seed))
        for c in columns:
            h = mix(h + np.uint64(0x9E3779B97F4A7C15)) ^ c
        return mix(h)

    rolled = chained([hashes[i : len(hashes) - words + 1 + i] for i in range(words)], words) if len(hashes) >= words else hashes[:0]
    out = []
    for i, n in enumerate(counts):
        if n >= words:
            out.append(np.unique(rolled[at[i] : at[i + 1] - words + 1]))
        elif n:
            out.append(chained([hashes[at[i] + j : at[i] + j + 1] for j in range(n)], n))
        else:
            out.append(hashes[:0])
    return out


def frequent_shingles(rows: DataFrame, words: int, share: float = FREQUENT_SHARE) -> np.ndarray:
    """Shingles in at least ``share`` of the texts, sorted; at most the mean set size / ``share`` of them.

    A task reports those that reach the share among its own texts, so rows that are summed are bounded in the same way.
    The list may miss a shingle near the limit; it decides which signatures are worth sending, never a link.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        sets, n = [], 0
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def fold():
            values, inverse = np.unique(np.concatenate([known, *sets]), return_inverse=True)
            ones = np.concatenate([counts, np.ones(len(inverse) - len(counts), np.int64)])
            summed = np.bincount(inverse, weights=ones, minlength=len(values)).astype(np.int64)
            keep = summed > share * n / 4
            return values[keep], summed[keep]

        held = 0
        for _, texts in texts_of(batches):
            own = shingle_sets(texts, words)
            sets += own
            n += len(own)
            held += sum(map(len, own))
            if held > FLUSH_SIGNATURES:
                known, counts = fold()
                sets, held = [], 0
        known, counts = fold() if n else (known, counts)
        top = (counts >= share * n) & (counts > 1)
        yield pa.record_batch(
            {
                "shingle": pa.array(_signed(known[top]), pa.int64()),
                "n": pa.array(counts[top], pa.int64()),
                "texts": pa.nulls(int(top.sum()), pa.int64()),
            }
        )
        yield pa.record_batch({"shingle": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()), "texts": pa.array([n], pa.int64())})

    found = rows.mapInArrow(run, "shingle long, n long, texts long").groupBy("shingle").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    found = stash(found, "frequent-shingles")
    total = found.agg(F.sum("texts")).first()[0] or 0
    top = found.where((F.col("n") >= share * total) & (F.col("n") >= FREQUENT_LEAST)).select("shingle").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def signatures(items: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    """The signatures of a set of hashes, for its band and perhaps the next one."""
    n = len(items)
    if not n:
        return items
    rare = np.ones(n, bool)
    if len(frequent):
        rare = frequent[np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)] != items
    last = bands(percent)[1]
    own = bisect_left(last, n)
    out = []
    for band in [own, own + 1] if n * 100 // percent > last[own] else [own]:
        parts, z = parts_of(band, percent)
        spread = mix(items + np.uint64((band + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        part = ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        body = mix(spread + np.uint64(1))
        low = np.bincount(part, (body & np.uint64(0xFFFFFFFF)).astype(float), parts)
        high = np.bincount(part, (body >> np.uint64(32)).astype(float), parts)
        held = np.bincount(part[rare], minlength=parts)
        sums = low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))
        sign = mix(sums ^ mix(np.arange(parts, dtype=np.uint64) + np.uint64(band + 1) * np.uint64(1 << 32)))
        out.append(sign[np.lexsort((sign, held))[z:]])
    return np.concatenate(out)


def odd_sketch(items: np.ndarray) -> np.ndarray:
    """Parities of 1024 counters, or 4096, 16384, ... for large sets; two sets differ in as many elements at least as their
    sketches of equal length in bits. The four quarters of a sketch together (exclusive or) are the next shorter one."""
    size, largest = SKETCH_WORDS, SHORT_SET
    while largest < len(items):
        size, largest = 4 * size, 4 * largest
    slot = (mix(items + np.uint64(7)) & np.uint64(64 * size - 1)).astype(np.int64)
    odd = (np.bincount(slot, minlength=64 * size) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of equal runs."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.zeros(0, np.int64)


def _sort_groups(signs: np.ndarray, ids: np.ndarray):
    """Sorted by signature and id; start and length of each group."""
    order = np.lexsort((ids, signs))
    signs, ids = signs[order], ids[order]
    starts = _runs(signs)
    return signs, ids, starts, np.diff(np.append(starts, len(signs)))


def describe(rows: DataFrame, words: int, percent: int, buckets: int, frequent) -> DataFrame:
    """One pass over the texts; rows of three kinds: 0 a document, 1 packed signatures of a bucket, 2 a local group's member."""

    def table(kind, height, **columns):
        types = {"id": pa.int64(), "n": pa.int64(), "digest": pa.binary(), "sketch": pa.list_(pa.int64()), "sign": pa.int64(), "bucket": pa.int32(), "signs": pa.binary(), "ids": pa.binary()}
        arrays = {"kind": pa.array(np.full(height, kind, np.int32))}
        arrays |= {c: pa.array(columns[c], t) if c in columns else pa.nulls(height, t) for c, t in types.items()}
        return pa.record_batch(arrays)

    def packed(signs: list, ids: list):
        if not signs:
            return
        sizes = [len(s) for s in signs]
        all_signs = _signed(np.concatenate(signs))
        all_ids = np.repeat(np.array(ids, np.int64), sizes)
        s, d, starts, lengths = _sort_groups(all_signs, all_ids)
        if (many := np.repeat(lengths > 1, lengths)).any():
            yield table(2, int(many.sum()), id=d[many], sign=s[many])
        s, d = s[starts], d[starts]  # the least id of each signature goes on
        bucket = ((s.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        s, d, bucket = s[order], d[order], bucket[order]
        at = _runs(bucket)
        stop = np.append(at[1:], len(bucket))
        yield table(
            1, len(at), bucket=bucket[at].astype(np.int32),
            signs=[s[a:b].tobytes() for a, b in zip(at, stop)], ids=[d[a:b].tobytes() for a, b in zip(at, stop)],
        )

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, owners, size = [], [], 0
        for ids, texts in texts_of(batches):
            docs = ids.to_pylist()
            sets = shingle_sets(texts, words)
            digests = [_digest(s) for s in sets]
            sketches = [odd_sketch(s) for s in sets]
            yield table(0, len(docs), id=docs, n=[len(s) for s in sets], digest=digests, sketch=sketches)
            for doc, items in zip(docs, sets):
                if doc is None or not len(items):
                    continue
                own = signatures(items, percent, frequent.value)
                held.append(own)
                owners.append(doc)
                size += len(own)
            if size > FLUSH_SIGNATURES:
                yield from packed(held, owners)
                held, owners, size = [], [], 0
        yield from packed(held, owners)

    return rows.mapInArrow(
        run, "kind int, id long, n long, digest binary, sketch array<long>, sign long, bucket int, signs binary, ids binary"
    )


def _meet(table):
    """Signatures of one bucket that came from several tasks."""
    signs = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("signs").to_pylist()])
    ids = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("ids").to_pylist()])
    s, d, _, lengths = _sort_groups(signs, ids)
    many = np.repeat(lengths > 1, lengths)
    return pa.table({"sign": pa.array(s[many]), "id": pa.array(d[many])})


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """``id, component`` of all ends of ``a, b`` links: the least id that links reach.

    Each round maps every vertex to its least neighbour, follows that map four times, and contracts the links.
    """
    edges = stash(links.select("a", "b").where("a <> b").distinct(), f"{name}-links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stash(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).select(F.col("a").alias("v"), "to"), f"{name}-least")
        jump = least
        for _ in range(2):
            there = jump.select(F.col("v").alias("to"), F.col("to").alias("further"))
            jump = stash(jump.join(there, "to", "left").select("v", F.coalesce("further", "to").alias("to")), f"{name}-jump")
        if labels is None:
            labels = jump.select(F.col("v").alias("id"), F.col("to").alias("component"))
        else:
            moved = jump.select(F.col("v").alias("component"), "to")
            known = labels.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
            labels = stash(known, f"{name}-labels")
        # the map itself must stay connected too, for a vertex may have moved to one that moves on
        step = jump.select(F.col("v").alias("a"), F.col("to").alias("b"))
        old = edges.unionByName(least.select(F.col("v").alias("a"), F.col("to").alias("b"))).unionByName(step)
        left, right = (jump.select(F.col("v").alias(c), F.col("to").alias(f"{c}2")) for c in ("a", "b"))
        fresh = old.join(left, "a").join(right, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        edges = stash(fresh.where("a <> b").distinct(), f"{name}-links")
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def _sets_of(rows: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, items`` (whole shingle sets) of the given distinct ids; of rows with one id the set with the least digest."""

    def run(batches):
        for ids, texts in texts_of(batches):
            sets = shingle_sets(texts, words)
            yield pa.record_batch(
                {"id": ids, "digest": pa.array([_digest(s) for s in sets], pa.binary()), "items": pa.array([_signed(s) for s in sets], pa.list_(pa.int64()))}
            )

    few = ids.count() <= BROADCAST_IDS
    found = rows.join(F.broadcast(ids) if few else ids, "id", "left_semi").mapInArrow(run, "id long, digest binary, items array<long>")
    return found.groupBy("id").agg(F.min(F.struct("digest", "items")).alias("s")).select("id", "s.items")


def _verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """``a, b`` of the pairs that link, compared on whole sets."""
    ids = stash(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), f"{name}-ids")
    sets = stash(_sets_of(rows, ids, words), f"{name}-sets")
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    linked = joined.where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common")))
    return stash(linked.select("a", "b"), f"{name}-links")


def _xor(p, q):
    return F.zip_with(p, q, lambda u, v: u.bitwiseXOR(v))


def _folded(sketch):
    """The next shorter sketch."""
    length = F.floor(F.size(sketch) / 4).cast("int")
    first, second, third, fourth = (F.slice(sketch, i * length + 1, length) for i in range(4))
    return _xor(_xor(first, second), _xor(third, fourth))


def _differ(p, q):
    """Bits in which two sketches of equal length differ."""
    return F.aggregate(_xor(p, q), F.lit(0), lambda total, d: total + F.bit_count(d))


def _possible(percent: int):
    """Whether sizes and sketches of ``x`` and ``y`` (structs of n, sketch) leave room for a link."""
    a, b = F.col("x.sketch"), F.col("y.sketch")
    n, m = F.col("x.n"), F.col("y.n")
    def words_apart(count: int):
        return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(count)), F.lit(0))

    def fits(apart):
        return apart * (100 + percent) <= (100 - percent) * (n + m)

    # half of a longer sketch first: it turns most pairs down without the slower fold over all words
    room = (
        F.when(F.size(a) > F.size(b), fits(_differ(_folded(a), b)))
        .when(F.size(a) < F.size(b), fits(_differ(a, _folded(b))))
        .when(F.size(a) == SKETCH_WORDS, fits(words_apart(SKETCH_WORDS)))
        .otherwise(F.when(fits(words_apart(2 * SKETCH_WORDS)), fits(_differ(a, b))).otherwise(False))
    )
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & room


def _mixed(placed: DataFrame, name: str) -> DataFrame:
    """``sign, id, component`` of the groups that lie in several components; of groups with the same members one."""
    sums = [F.bit_xor(F.xxhash64("id", F.lit(seed))).alias(f"x{seed}") for seed in range(2)]
    groups = placed.groupBy("sign").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), *sums)
    mixed = groups.where("lo < hi").groupBy("n", "x0", "x1").agg(F.min("sign").alias("sign")).select("sign")
    return stash(placed.select("sign", "id", "component").join(mixed, "sign", "left_semi"), name)


def _pivot_pairs(placed: DataFrame, about: DataFrame, percent: int, turn: int) -> DataFrame:
    """``a, b, from, to``: a group's members outside its largest component, each with a pivot of that one.

    The pivot is the member least by a hash, one of ``PIVOT_ORDERS`` in each turn, so that the groups of a member offer a few
    pivots, not one for each group. Of several in one component it takes the nearest by sketch.
    """
    order = F.xxhash64("id", F.lit(turn), F.pmod(F.xxhash64("sign"), F.lit(PIVOT_ORDERS)))
    parts = placed.groupBy("sign", "component").agg(F.count("*").alias("n"), F.min(F.struct(order.alias("h"), "id")).alias("p"))
    best = parts.groupBy("sign").agg(F.max(F.struct("n", "component", "p.id")).alias("s"))
    best = best.select("sign", F.col("s.id").alias("a"), F.col("s.component").alias("from"))
    pairs = placed.join(best, "sign").where(F.col("component") != F.col("from"))
    pairs = pairs.select("a", F.col("id").alias("b"), "from", F.col("component").alias("to")).distinct()
    x, y = (about.select(F.col("id").alias(c), F.col("about").alias(z)) for c, z in ("ax", "by"))
    near = F.when(F.size("x.sketch") == F.size("y.sketch"), _differ(F.col("x.sketch"), F.col("y.sketch"))).otherwise(F.abs(F.col("x.n") - F.col("y.n")))
    pairs = pairs.join(x, "a").join(y, "b").where(_possible(percent)).select("a", "b", "from", "to", near.alias("near"))
    nearest = pairs.groupBy("b", "from", "to").agg(F.min(F.struct("near", "a")).alias("s"))
    return stash(nearest.select("s.a", "b", "from", "to"), f"pivot-pairs{turn}")


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the least id reachable by links of ``percent`` similarity.

    NULL and empty texts have no shingles and link with nothing. A NULL id has a NULL component and links with nothing.
    Rows that share an id are one document; if their texts differ, the set with the least digest stands for it, while
    ``n_shingles`` is each row's own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = id_and_bytes(docs, id_col, text_col)
    buckets = max(64, 4 * rows.rdd.getNumPartitions())
    frequent = spark.sparkContext.broadcast(frequent_shingles(rows, words))
    seen = stash(describe(rows, words, percent, buckets, frequent), "signatures")
    documents = seen.where("kind = 0").select("id", "n", "digest", "sketch")
    own = documents.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("digest", "n", "sketch")).alias("s"))
    own = stash(own.select("id", "s.digest", F.struct("s.n", "s.sketch").alias("about")).where("about.n > 0"), "documents")
    # equal sets are one: their least id stands for all
    classes = stash(own.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    about = own.join(classes.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "about")
    local = seen.where("kind = 2").select("sign", "id")
    far = seen.where("kind = 1").select("bucket", "signs", "ids").groupBy("bucket").applyInArrow(_meet, "sign long, id long")
    members = stash(local.unionByName(far).distinct().join(about, "id", "left_semi"), "members")
    least = members.groupBy("sign").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("sign", "a")
    star = members.join(least, "sign").where("a < id").select("a", F.col("id").alias("b")).distinct()
    x, y = (about.select(F.col("id").alias(c), F.col("about").alias(z)) for c, z in ("ax", "by"))
    star = stash(star.join(x, "a").join(y, "b").where(_possible(percent)).select("a", "b"), "star-pairs")
    links = _verified(star, rows, words, percent, "star")
    labels = connected(links, "star")
    placed = _mixed(members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "mixed")
    first, tested = links, star
    for turn in range(PIVOT_ROUNDS):
        if placed.isEmpty():
            break
        tries = _pivot_pairs(placed, about, percent, turn)
        found = _verified(tries.select("a", "b"), rows, words, percent, f"pivot{turn}")
        tested = tested.unionByName(tries.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        if found.isEmpty():
            break
        links = links.unionByName(found)
        joined = connected(tries.join(found, ["a", "b"], "left_semi").select(F.col("from").alias("a"), F.col("to").alias("b")), f"pivot{turn}")
        joined = joined.select(F.col("id").alias("component"), F.col("component").alias("now"))
        placed = _mixed(placed.join(joined, "component", "left").select("sign", "id", F.coalesce("now", "component").alias("component")), f"mixed{turn}")
    # what a group still has in several components is compared across them, if sizes and sketches leave room for a link
    placed = placed.join(about, "id")
    # short sketches travel as plain columns, which are compared at far less cost than nested arrays; only sets that may meet
    # a longer sketch carry theirs as an array too
    def side(name: str, sign: str, id_name: str, component: str) -> DataFrame:
        short = F.size("about.sketch") == SKETCH_WORDS
        return placed.select(
            F.col("sign").alias(sign), F.col("id").alias(id_name), F.col("component").alias(component), F.col("about.n").alias(f"n{name}"),
            short.alias(f"short_{name}"), F.when(100 * F.col("about.n") >= percent * SHORT_SET, F.col("about")).alias(name),
            *[F.col("about.sketch")[i].alias(f"{name}{i}") for i in range(SKETCH_WORDS)],
        )

    apart = (F.col("sign") == F.col("same")) & (F.col("a") < F.col("b")) & (F.col("from") != F.col("to"))
    size_fits = (100 * F.col("nx") >= percent * F.col("ny")) & (100 * F.col("ny") >= percent * F.col("nx"))
    differ = sum((F.bit_count(F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}"))) for i in range(SKETCH_WORDS)), F.lit(0))
    short_fits = F.col("short_x") & F.col("short_y") & (differ * (100 + percent) <= (100 - percent) * (F.col("nx") + F.col("ny")))
    long_fits = ~(F.col("short_x") & F.col("short_y")) & _possible(percent)
    pairs = side("x", "sign", "a", "from").join(side("y", "same", "b", "to"), apart & size_fits & (short_fits | long_fits))
    cross = pairs.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
    more = _verified(stash(cross, "cross-pairs"), rows, words, percent, "cross")
    if links is not first or not more.isEmpty():
        labels = connected(links.unionByName(more), "all")
    reached = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    placed = own.select("id", "digest").join(reached, "digest").select("id", "component_id")
    return documents.join(placed, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
