"""LM scoring (operator 4): a weighted backoff model of word n-grams, counted and held as a distributed table.

Counts. Every n-gram of all training texts up to ``order`` is counted; all tokens and every longer n-gram seen ``LEAST`` times are
kept, whatever the size of the corpus, so the table grows with it. An n-gram is known by a 64-bit hash, linear in the hashes of
its tokens, so those of the n-grams one token shorter follow from it (two of a billion n-grams share a hash with odds of 3 %). Tasks
count before they send, and hashes travel packed by range. An n-gram is counted only if a bitmap says that both n-grams
one token shorter may be kept; the bitmap may say so wrongly, never the reverse.

Model. A kept n-gram has the discounted probability ``(count - DISCOUNT) / count(context)``; a context without the wanted
continuation backs off to the context without its first token, with the weight that makes probabilities sum to one. Tokens have
the add-one unigram ``(c + 1) / (N + V + 1)``, unseen ones as well. In an automaton (``build_automaton`` makes it on one
machine, tests compare) a text's score is the sum of the arcs and failures it passes. Here each kept n-gram gets the difference that
it makes against the model without it, failures included, so that sum is one over all n-grams of a text in any order.

Scoring. The hot part of the table (entries with at least ``share`` of the tokens, at most ``1 / share`` an order) is broadcast;
the other n-grams of a text that the bitmap lets through meet the table by hash range, and their sums come back by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorloom.llm.common import discard, id_and_bytes, mix, slices, stash

END = b""
DISCOUNT = 0.5
#: how often an n-gram of two tokens or more has to occur
LEAST = 2
#: share of the tokens from which on an entry is broadcast
SHARE = 2e-6
FLUSH_NGRAMS = 2_000_000
#: log2 of the most bits of a bitmap, 32 MB, and the bits of each key below that
BITMAP = 28
BITS_PER_KEY = 32
_BASE = 1 << 21  # above the largest token id of an automaton
_STEP = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))
_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
SIDE_BY_SIDE = 64
_END = np.uint64(xxhash.xxh3_64_intdigest(END))
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BY_SIZE = mix(np.arange(1, SIDE_BY_SIDE + 2, dtype=np.uint64))


class Automaton:
    """The model on one machine. ``arcs``: (state, token) -> (log10 probability, next state); ``fail``: state -> (next state, log10 weight)."""

    def __init__(self, ids: dict[bytes, int], arcs: dict[int, tuple[float, int]], fail: list[tuple[int, float]]):
        self.ids, self.arcs, self.fail = ids, arcs, fail

    def score(self, tokens: list[int]) -> float:
        """log10 probability of the tokens that have ids, with all failure weights; id 0 stands for others."""
        arc, fail, state, total = self.arcs.get, self.fail, 0, 0.0
        for token in tokens:
            found = arc(state * _BASE + token)
            while found is None and state:
                state, weight = fail[state]
                total += weight
                found = arc(state * _BASE + token)
            if found is not None:
                total += found[0]
                state = found[1]
        return total


def _settled(df: DataFrame, name: str) -> DataFrame:
    """``stash``, after which the shuffle files of the job go, as nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return stash(df, name)
    finally:
        conf.set(key, before)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts after lower-casing A-Z, an end behind each text, and the number by text.

    A word goes eight bytes a time through ``mix``, all words side by side; those of more than ``SIDE_BY_SIDE`` bytes one by one.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_binary(texts.type) else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    bounds, n = offsets - offsets[0], len(data)
    raw = np.zeros(n + 8, np.uint8)
    raw[:n] = data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))  # bytes below a bound wrap round to large ones
    inside = (data - np.uint8(9) > 4) & (data != 32)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = np.diff(bounds) > 0
    begins, ends = bounds[:-1][full], bounds[1:][full] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    eights = np.ndarray(n + 1, "<u8", raw, 0, (1,))
    hashes = mix((eights[starts] & _BYTES[np.minimum(sizes, 8)]) ^ _BY_SIZE[np.minimum(sizes, SIDE_BY_SIDE)])
    at = np.flatnonzero(sizes > 8)
    for done in range(8, SIDE_BY_SIDE, 8):
        hashes[at] = mix(hashes[at] * np.uint64(_STEP) + (eights[starts[at] + done] & _BYTES[np.minimum(sizes[at] - done, 8)]))
        at = at[sizes[at] > done + 8]
    for i in at.tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : starts[i] + sizes[i]].tobytes())
    before = np.searchsorted(starts, bounds)
    return np.insert(hashes, before[1:], _END), np.diff(before) + 1


def _grams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``order`` tokens: hashes of the n-grams that begin at each token, and which of them lie within one text."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(tokens))  # tokens of the text from here on
    keys = tokens
    for n in range(1, order + 1):
        if n > 1:
            keys = keys[: max(0, len(tokens) - n + 1)] * np.uint64(_STEP) + tokens[n - 1 :]
        yield keys, left[: len(keys)] >= n


def _planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on, compressed, as upper bytes hold few values."""
    return _COMPRESSOR.compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes())


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_DECOMPRESSOR.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences: the lower five bytes as they are, as nothing compresses them, then planes of the upper ones."""
    steps = np.diff(keys, prepend=np.uint64(0))
    upper = _planes((steps >> np.uint64(40)).astype(np.uint32))
    return b"".join([len(keys).to_bytes(4, "little"), steps.astype(np.uint32), (steps >> np.uint64(32)).astype(np.uint8), upper])


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    steps = _from_planes(data[4 + 5 * n :], np.uint32).astype(np.uint64) << np.uint64(8)
    steps |= np.frombuffer(data, np.uint8, n, 4 + 4 * n)
    steps <<= np.uint64(32)
    steps |= np.frombuffer(data, np.uint32, n, 4)
    return np.cumsum(steps, dtype=np.uint64)


def _spans(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """``bucket, begin, end`` of the hash ranges that sorted hashes have members of."""
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.diff(buckets, prepend=-1))
    return zip(buckets[at].tolist(), at.tolist(), [*at[1:].tolist(), len(keys)])


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``argsort`` gives, and the keys in that order: places sorted along with the upper bits of the keys, which is faster, then what these bits leave open."""
    low = np.uint64((1 << (len(keys) - 1).bit_length()) - 1 if len(keys) else 0)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    held = keys[order]
    if (held[1:] < held[:-1]).any():
        again = np.argsort(held, kind="stable")
        order, held = order[again], held[again]
    return order, held


def _order(keys: np.ndarray) -> np.ndarray:
    return _sorted(keys)[0]


def _merged(keys: np.ndarray, times: np.ndarray | None, first: np.ndarray, last: np.ndarray):
    """Distinct hashes in order, with their sums (without ``times`` each is one) and their first and last token, if any are given."""
    if times is None and not len(last):
        order, keys = None, np.sort(keys)
    else:
        order, keys = _sorted(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = np.diff(at, append=len(keys)) if times is None else np.add.reduceat(times[order], at)
    return keys[at], sums, *(x[order[at]] if len(x) else x for x in (first, last))


def _maybe(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - len(bitmap).bit_length() - 5)  # 64 bits a word, a power of two words
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def bitmap_of(table: DataFrame) -> np.ndarray:
    """A bit for each range of ``key``: whether the table has one there. ``BITS_PER_KEY`` bits a key, at most ``2 ** BITMAP``.

    Tables that lie by hash range send each word about once.
    """
    power = min(BITMAP, max(16, (table.count() * BITS_PER_KEY).bit_length()))

    def run(batches) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            found.append(np.unique(batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - power)))
        if not found:
            return
        bits = np.unique(np.concatenate(found))
        if not len(bits):
            return
        words = (bits >> np.uint64(6)).astype(np.int32)
        at = np.flatnonzero(np.diff(words, prepend=-1))
        masks = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), at)
        yield pa.record_batch({"words": pa.array([words[at].tobytes()], pa.binary()), "masks": pa.array([masks.tobytes()], pa.binary())})

    out = np.zeros(1 << (power - 6), np.uint64)
    for row in table.select("key").mapInArrow(run, "words binary, masks binary").toLocalIterator():
        words = np.frombuffer(row["words"], np.int32)
        out[words] |= np.frombuffer(row["masks"], np.uint64)
    return out


def ngram_counts(train: DataFrame, n: int, least: int, bits: int, lower: np.ndarray | None) -> DataFrame:
    """``key, prefix, suffix, n`` of the n-grams of ``n`` tokens that occur ``least`` times; ``lower``: bitmap of those one shorter."""
    held = train.sparkSession.sparkContext.broadcast(lower)
    lead = np.uint64(pow(_STEP, n - 1, 1 << 64))

    def run(batches) -> Iterator[pa.RecordBatch]:
        bitmap = held.value
        chunks, size = [], 0

        def out():
            columns = [np.concatenate(c) for c in zip(*chunks)]
            chunks.clear()
            keys, times, first, last = _merged(columns[0], None, columns[1], columns[-1])
            spans = list(_spans(keys, bits))
            return pa.record_batch(
                {
                    "bucket": pa.array([b for b, _, _ in spans], pa.int64()),
                    "keys": pa.array([_packed(keys[i:j]) for _, i, j in spans], pa.binary()),
                    "times": pa.array([times[i:j].astype(np.int32).tobytes() for _, i, j in spans], pa.binary()),
                    "first": pa.array([first[i:j].tobytes() if n > 2 else b"" for _, i, j in spans], pa.binary()),
                    "last": pa.array([last[i:j].tobytes() if n > 1 else b"" for _, i, j in spans], pa.binary()),
                }
            )

        for part in (part for batch in batches for part in slices(batch)):
            tokens, sizes = _tokens(part.column("text"))
            shorter = None
            for m, (keys, good) in enumerate(_grams(tokens, sizes, n), 1):
                if m == n - 1:
                    shorter = keys
            if bitmap is not None and len(keys):
                may = _maybe(bitmap, shorter)
                good = good & may[:-1] & may[1:]
            at = np.flatnonzero(good)
            if len(at):
                # what isn't sent isn't held
                chunks.append((keys[at], tokens[at if n > 2 else at[:0]], tokens[at + n - 1 if n > 1 else at[:0]]))
                size += len(at)
            if size > FLUSH_NGRAMS:
                yield out()
                size = 0
        if chunks:
            yield out()

    def total(table: pa.Table) -> pa.Table:
        column = {c: table.column(c).to_pylist() for c in ("keys", "times", "first", "last")}
        keys = np.concatenate([_unpacked(x) for x in column["keys"]])
        times = np.concatenate([np.frombuffer(x, np.int32) for x in column["times"]]).astype(np.int64)
        last = np.concatenate([np.frombuffer(x, np.uint64) for x in column["last"]]) if n > 1 else keys
        if n > 2:
            first = np.concatenate([np.frombuffer(x, np.uint64) for x in column["first"]])
        else:
            first = (keys - last) * _BACK
        keys, times, first, last = _merged(keys, times, first, last)
        kept = times >= least
        keys, times, first, last = keys[kept], times[kept], first[kept], last[kept]
        return pa.table({"key": keys.view(np.int64), "prefix": ((keys - last) * _BACK).view(np.int64), "suffix": (keys - lead * first).view(np.int64), "n": times})

    sent = train.mapInArrow(run, "bucket long, keys binary, times binary, first binary, last binary")
    counts = _settled(sent.groupBy("bucket").applyInArrow(total, "key long, prefix long, suffix long, n long"), f"ngrams-{n}")
    held.destroy()
    return counts


def packed_model(model: DataFrame, bits: int, least: int) -> DataFrame:
    """``bucket, keys, base, value``: the model as sorted arrays by hash range; entries with a count of ``least`` are the bucket -1."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        chunks, size = [], 0

        def out():
            hot, keys, base, value = (np.concatenate(c) for c in zip(*chunks))
            chunks.clear()
            by_key, keys = _sorted(keys)
            hot, base, value = hot[by_key], base[by_key], value[by_key]
            rows = [(-1, keys[hot], base[hot], value[hot])] if hot.any() else []
            keys, base, value = keys[~hot], base[~hot], value[~hot]
            rows += [(b, keys[i:j], base[i:j], value[i:j]) for b, i, j in _spans(keys, bits)]
            columns = [[r[0] for r in rows], [_packed(r[1]) for r in rows], [_planes(r[2]) for r in rows], [_planes(r[3]) for r in rows]]
            types = [pa.int64()] + [pa.binary()] * 3
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "keys", "base", "value"])

        for batch in batches:
            keys, n, base, value = (batch.column(c).to_numpy() for c in ("key", "n", "base", "value"))
            chunks.append((n >= least, keys.view(np.uint64), base, value))
            size += batch.num_rows
            if size > FLUSH_NGRAMS:
                yield out()
                size = 0
        if size:
            yield out()

    return model.select("key", "n", "base", "value").mapInArrow(run, "bucket long, keys binary, base binary, value binary")


def backoff_values(levels: list[DataFrame], norm: int, bits: int, least: int) -> DataFrame:
    """``packed_model`` of all kept n-grams, from their counts by order, whose files go as soon as they are read.

    ``base``: log10 of count + 1 for tokens, else 0. ``value``: what the n-gram adds to the score wherever it occurs: its log10
    probability less that of its suffix and the failure weight of its prefix, which it replaces, and its own failure weight,
    which the next token replaces if it has an arc. The joins hash the side that has each key once, which spares sorts; keys that
    many n-grams share are on the other side, which they split.
    """
    columns = ["key", "n", "base", "value"]
    p, base = ((F.col("n") + 1) / F.lit(float(norm))).alias("p"), F.log10(F.col("n") + 1)
    below, made, steps = levels[0].select("key", "n", p, base.alias("base"), base.alias("value")), [], [levels[0]]
    for nth, level in enumerate(levels[1:], 2):
        low = below.where(F.col("n") >= LEAST).select(F.col("key").alias("suffix"), F.col("p").alias("low"))
        with_low = _settled(level.join(low.hint("shuffle_hash"), "suffix").select("key", "prefix", "n", "low"), "lower")
        discard(level)
        left = with_low.groupBy(F.col("prefix").alias("key")).agg(F.sum("n").alias("going"), F.count("*").alias("kinds"), F.sum("low").alias("lower"))
        # 1 - sum of (n - DISCOUNT) / c over the continuations of a context that occurs c times
        rest = (F.col("n") - F.col("going") + DISCOUNT * F.col("kinds")) / F.col("n")
        weight = F.log10(F.greatest(F.lit(1e-12), rest) / F.greatest(F.lit(1e-12), 1 - F.col("lower")))
        weighted = below.join(left.hint("shuffle_hash"), "key", "left").select("key", "n", "base", "value", weight.alias("weight"))
        contexts = _settled(weighted, "contexts")
        made.append(contexts.select("key", "n", "base", (F.col("value") + F.coalesce("weight", F.lit(0.0))).alias("value")))
        for step in steps:
            discard(step)
        to_prefix = contexts.where(F.col("weight").isNotNull()).select(F.col("key").alias("prefix"), F.col("n").alias("c"), "weight")
        p = (F.col("n") - DISCOUNT) / F.col("c")
        gain = F.log10(p) - F.log10("low") - F.col("weight")
        below = with_low.join(to_prefix.hint("shuffle_hash"), "prefix").select("key", "n", p.alias("p"), F.lit(0.0).alias("base"), gain.alias("value"))
        steps = [with_low]
        if nth < len(levels):
            below = _settled(below, "probabilities")
            discard(with_low)
            steps = [below]
    model = below.select(columns)
    for part in made:
        model = model.unionByName(part)
    model = _settled(packed_model(model, bits, least), "model")
    for step in [*steps, *made]:
        discard(step)
    return model


def build_automaton(frequent: list[tuple[bytes, int]], total: int, distinct: int, orders: list[tuple[np.ndarray, np.ndarray]]) -> Automaton:
    """``frequent``: tokens with ids 1, 2, ... and their counts; ``orders``: kept n-grams and counts, order 2 first."""
    ids = {w: i for i, (w, _) in enumerate(frequent, 1)}
    norm = total + distinct + 1
    base = np.array([1.0] + [(n + 1) / norm for _, n in frequent])
    counts = np.array([0] + [n for _, n in frequent], np.int64)
    end = ids.get(END, 0)
    arcs = {t: (log10(base[t]), 0 if t == end else t) for t in range(1, len(base))}
    fail: list[tuple[int, float]] = [(0, 0.0)] * len(base)  # root and one state per token
    # state of each context; probabilities of kept continuations by context; counts of the contexts of this order
    contexts = {(t,): t for t in range(1, len(base))}
    names: list[tuple] = []
    below = {(): {t: float(base[t]) for t in range(1, len(base))}}
    context_count = {(t,): int(counts[t]) for t in range(1, len(base))}
    for nth, (keys, n) in enumerate(orders, 1):
        grams = [(names[k // _BASE] if nth > 1 else (int(k // _BASE),)) + (int(k % _BASE),) for k in keys]
        following: dict[tuple, dict[int, float]] = {}
        for gram, c in zip(grams, n):
            following.setdefault(gram[:-1], {})[gram[-1]] = (int(c) - DISCOUNT) / context_count[gram[:-1]]
        for gram in grams if nth < len(orders) else ():
            if gram[-1] != end:
                contexts[gram] = len(fail)
                fail.append((contexts[gram[1:]], 0.0))
        for context, own in following.items():
            state = contexts[context]
            lower = sum(_probability(below, fail, contexts, context[1:], t) for t in own)
            weight = max(1e-12, 1.0 - sum(own.values())) / max(1e-12, 1.0 - lower)
            fail[state] = (contexts.get(context[1:], 0), log10(weight))
            for t, p in own.items():
                reached = context + (t,) if t != end else ()
                while reached and reached not in contexts:
                    reached = reached[1:]
                arcs[state * _BASE + t] = (log10(p), contexts.get(reached, 0))
        below.update(following)
        context_count = {g: int(c) for g, c in zip(grams, n)}
        names = grams
    return Automaton(ids, arcs, fail)


def _probability(below: dict, fail: list, contexts: dict, context: tuple, token: int) -> float:
    """The probability one order below, by backoff."""
    weight = 0.0
    while context:
        if token in below.get(context, ()):
            return 10**weight * below[context][token]
        weight += fail[contexts[context]][1]
        context = context[1:]
    return 10**weight * below[()][token]


def lm_scoring(
    docs: DataFrame, training, order: int = 3, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row; ``training``: a condition on the rows of ``docs``.

    ``share`` decides what is broadcast, not what is learned. NULL and empty texts are the end token alone. Rows where
    ``training`` is NULL aren't learned from. Repeated rows are learned from and scored as often as they stand there; a NULL id
    stays NULL. Without training rows, N and V are 0 and every token is unseen. An empty table gives no rows.
    """
    rows = id_and_bytes(docs, id_col, text_col)
    train = id_and_bytes(docs.where(training), id_col, text_col)
    spark = rows.sparkSession
    bits = max(6, (4 * rows.rdd.getNumPartitions() - 1).bit_length())  # hash ranges grow with the input
    levels, lower = [], None
    for n in range(1, order + 1):
        levels.append(ngram_counts(train, n, 1 if n == 1 else LEAST, bits, lower))
        if n < order:
            lower = bitmap_of(levels[-1].where(F.col("n") >= LEAST))
    total, distinct = (x or 0 for x in levels[0].agg(F.sum("n"), F.count("*")).first())
    norm = total + distinct + 1
    bits -= 1  # a text asks in as many ranges at most, and each answers it with a row of sums
    least = max(2, -(-int(share * total * 1e9) // 10**9))
    kept = levels[0].select("key")
    for level in levels[1:]:
        kept = kept.unionByName(level.select("key"))
    bitmap = bitmap_of(kept)
    model = backoff_values(levels, norm, bits, least)
    top = model.where(F.col("bucket") < 0).toArrow()  # at most 1 / share entries an order
    hot = [np.concatenate([np.zeros(0, np.uint64), *map(_unpacked, top.column("keys").to_pylist())])]
    hot += [np.concatenate([np.zeros(0), *(_from_planes(x, np.float64) for x in top.column(c).to_pylist())]) for c in ("base", "value")]
    by_key = np.argsort(hot[0])
    held = spark.sparkContext.broadcast((tuple(x[by_key] for x in hot), bitmap))

    def run(batches) -> Iterator[pa.RecordBatch]:
        (hot_keys, hot_base, hot_value), bitmap = held.value
        task, at = TaskContext.get().partitionId(), 0
        for part in (part for batch in batches for part in slices(batch)):
            tokens, sizes = _tokens(part.column("text"))
            n = part.num_rows
            owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
            keys, of, shorter = [], [], None
            for grams, good in _grams(tokens, sizes, order):
                if shorter is not None:  # in the table only with both n-grams one token shorter
                    good &= shorter[: len(good)] & shorter[1 : len(good) + 1]
                may = np.flatnonzero(good)
                may = may[_maybe(bitmap, grams[may])]
                shorter = np.zeros(len(good), bool)
                shorter[may] = True
                keys.append(grams[may])
                of.append(owner[may])
            by_key, keys = _sorted(np.concatenate(keys))
            of = np.concatenate(of)[by_key]
            own = (np.zeros(n),) * 3
            if len(hot_keys):
                place = np.minimum(np.searchsorted(hot_keys, keys), len(hot_keys) - 1)
                met = hot_keys[place] == keys
                place, rows_met = place[met], of[met]
                own = [np.bincount(rows_met, x, n) for x in (hot_base[place] > 0, hot_base[place], hot_value[place])]
                keys, of = keys[~met], of[~met]
            spans = list(_spans(keys, bits))
            void = [None] * len(spans)
            columns = [
                [task] * (len(spans) + 1),
                [at] * (len(spans) + 1),
                [task & ((1 << bits) - 1), *[b for b, _, _ in spans]],
                [None, *[_packed(keys[i:j]) for _, i, j in spans]],
                [_planes(np.diff(np.arange(n, dtype=np.int32), prepend=np.int32(0))), *[_planes(of[i:j]) for _, i, j in spans]],
                [part.column("id").to_pylist(), *void],
                [sizes.tolist(), *void],
                [_planes(own[0].astype(np.int32)), *void],
                *[[_planes(x), *void] for x in own[1:]],
            ]
            types = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 3
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["task", "at", "bucket", "keys", *names[2:]])
            at += n

    def meet(sent: pa.Table, table: pa.Table) -> pa.Table:
        """What texts found in the hot part, as it came, and the sums of what asked n-grams found here, a row for each task that asked."""
        asking = pc.is_valid(sent.column("keys"))
        own, asked = sent.filter(pc.invert(asking)).select(names), sent.filter(asking)
        if not asked.num_rows or not table.num_rows:
            return own
        keys = np.concatenate([_unpacked(x) for x in asked.column("keys").to_pylist()])
        places = [(t << 32) + a for t, a in zip(asked.column("task").to_pylist(), asked.column("at").to_pylist())]
        rows_of = np.concatenate([_from_planes(x, np.int32) + np.int64(r) for r, x in zip(places, asked.column("rows").to_pylist())])
        known = np.concatenate([_unpacked(x) for x in table.column("keys").to_pylist()])
        base, value = (np.concatenate([_from_planes(x, np.float64) for x in table.column(c).to_pylist()]) for c in ("base", "value"))
        by_key, known = _sorted(known)
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        met = np.flatnonzero(known[place] == keys)
        if not len(met):
            return own
        met = met[_order(rows_of[met].view(np.uint64))]
        place, rows_met = by_key[place[met]], rows_of[met]
        begin = np.flatnonzero(np.diff(rows_met, prepend=-1))
        base, value, rows_met = base[place], value[place], rows_met[begin]
        sums = [np.add.reduceat(x, begin) for x in ((base > 0).astype(np.int32), base, value)]
        tasks = rows_met >> 32
        begin = np.flatnonzero(np.diff(tasks, prepend=-1))
        steps = np.diff(rows_met, prepend=0)
        steps[begin] = rows_met[begin] & 0x7FFFFFFF  # rows begin anew in each task
        found = [steps.astype(np.int32), sums[0].astype(np.int32), *sums[1:]]
        end, void = [*begin[1:].tolist(), len(tasks)], [None] * len(begin)
        rows, *sums = ([_planes(x[i:j]) for i, j in zip(begin.tolist(), end)] for x in found)
        columns = [tasks[begin].tolist(), [0] * len(begin), rows, void, void, *sums]
        return pa.concat_tables([own, pa.table([pa.array(c, own.schema.field(i).type) for i, c in enumerate(columns)], names)])

    def summed(parts: pa.Table) -> pa.Table:
        """The rows of one task of the texts, each with its sums."""
        at, rows = parts.column("at").to_pylist(), parts.column("rows").to_pylist()
        of = np.concatenate([np.cumsum(_from_planes(x, np.int32)) + a for a, x in zip(at, rows)])
        ids = parts.filter(pc.is_valid(parts.column("doc_id"))).sort_by("at")
        columns = {c: pc.list_flatten(ids.column(c)) for c in ("doc_id", "n_tokens")}
        for c, kind in (("known", np.int32), ("base", np.float64), ("value", np.float64)):
            given = np.concatenate([_from_planes(x, kind) for x in parts.column(c).to_pylist()])
            columns[c] = pa.array(np.bincount(of, given, len(columns["doc_id"])).astype(np.int64 if c == "known" else np.float64))
        return pa.table(columns)

    names = ["task", "at", "rows", "doc_id", "n_tokens", "known", "base", "value"]
    shape = "rows binary, doc_id array<long>, n_tokens array<long>, known binary, base binary, value binary"
    cold = model.where(F.col("bucket") >= 0)
    sent = rows.mapInArrow(run, f"task long, at long, bucket long, keys binary, {shape}")
    found = _settled(sent.groupBy("bucket").cogroup(cold.groupBy("bucket")).applyInArrow(meet, f"task long, at long, {shape}"), "found")
    discard(model)
    held.destroy()
    scored = found.groupBy("task").applyInArrow(summed, "doc_id long, n_tokens long, known long, base double, value double")
    unseen = F.col("n_tokens") * F.lit(-log10(norm))
    return scored.select(
        "doc_id",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (unseen + F.col("base")).alias("base_score"),
        (unseen + F.col("value")).alias("score"),
    )
