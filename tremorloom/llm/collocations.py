"""Phrase collocation mining (operator 13): counts from double-array tries of Apriori-safe candidates.

1. Words are counted per language; all strings, one row a word and slice before the shuffle.
2. Level by level, phrases are counted by a 64-bit hash of (language, words), by sorting in blocks, only where both shorter phrases inside are
   frequent (a bitmap has every frequent hash, so nothing frequent is lost). Equal hashes can only
   add up, so every phrase with ``min_count`` occurrences is among the hashes with as many: the candidates are safe.
3. From every position the longest phrase of two and more words that the bitmaps have is a run. Every candidate begins the
   runs from all its positions. Distinct runs of many slices go once, with their count, to a shard that has all runs with
   the same first two words; they are packed as one row a block, language and range of shards' hashes.
4. A shard's candidates, what its runs begin with, become a double-array trie over digits of word numbers. All runs step
   through it together, word by word and digit by digit; the accepting states add up the runs' counts. These are the exact
   counts.
5. Scores, the drop rule and the ranking are joins and aggregates in Spark; products are decimals of 38 digits.

Texts are read once for words, once a level, and once for the runs, however many candidates there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorloom.llm.common import found_by_workers, mix, slices, stash

SHARD_PHRASES = 1_000_000
SLICE = 2 << 20
#: hashes that a task counts at once, at least, and ranges of hashes a partition or shard
BLOCK_HASHES, RANGES_EACH = 2 << 20, 8
#: bytes of words or runs that a task adds up before they are shuffled, and rows that a shard adds up at once, at least
BLOCK, SHARD_ROWS = 16 << 20, 1 << 18
#: the bitmap of frequent hashes: bits for each hash, and the most bits (64 MB); beyond them it only lets more through
BITS_EACH, MAX_BITS = 32, 1 << 29
DIGIT = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)

_BETWEEN, _BREAKS = b" \t", b".,;:!?\x0a\x0b\x0c\x0d"
_KIND = bytes(1 if b in _BETWEEN else 2 if b in _BREAKS else 0 for b in range(256))  # 0: in a word, 1: between words, 2: between pieces
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of a binary array, eight bytes of every word at a time."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    held = words.buffers()[2]
    data = np.concatenate([np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    at, left = offsets[:-1], np.diff(offsets)
    out = mix(left.astype(np.uint64) + _ODD)
    todo = np.flatnonzero(left > 0)
    while len(todo):
        n = np.minimum(left[todo], 8)
        part = eight[at[todo]] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - n) * 8).astype(np.uint64))
        out[todo] = mix(out[todo] * _ODD + part)
        at, left = at + 8, left - 8
        todo = todo[left[todo] > 0]
    return out


class Words:
    """The words of a slice of texts: distinct ones, their order of occurrence, languages and pieces."""

    def __init__(self, part: pa.RecordBatch):
        text = part.column("text")
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        held = text.buffers()[2]
        raw = bytes(memoryview(held)[offsets[0] : offsets[-1]]) if held else b""
        starts_at = offsets[:-1] - offsets[0]
        kind = np.frombuffer(raw.translate(_KIND), np.uint8)
        inside = np.zeros(len(raw) + 1, bool)
        np.equal(kind, 0, out=inside[:-1])
        first, last = inside[:-1].copy(), inside[:-1].copy()
        first[1:] &= ~inside[:-2]
        last &= ~inside[1:]
        begins = starts_at[starts_at < len(raw)]  # no word and no piece goes on in the next text
        first[begins] = inside[begins]
        begins = begins[begins > 0]
        last[begins - 1] = inside[begins - 1]
        start = np.flatnonzero(first)
        ends = np.zeros(len(start) + 1, np.int32)
        np.cumsum(np.flatnonzero(last) - start + 1, out=ends[1:])
        data = raw.translate(_LOWER, _BETWEEN + _BREAKS)
        plain = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = plain.dictionary_encode()
        self.distinct, self.index = coded.dictionary, coded.indices.to_numpy()
        firsts = np.searchsorted(start, starts_at)  # a text's first word, or the next text's
        langs = part.column("lang").dictionary_encode()
        self.langs, self.lang = langs.dictionary, np.repeat(langs.indices.to_numpy(), np.diff(np.append(firsts, len(start))))
        on = np.ones(len(start) + 1, bool)
        on[np.searchsorted(start, np.flatnonzero(kind == 2))] = False
        on[firsts] = False
        self.goes_on = on[1 : max(1, len(start))]  # the next word is in the same piece

    def unigrams(self) -> pa.RecordBatch:
        """``lang, word, n``; the row without a word has the number of words of a language."""
        key, n = np.unique(self.lang.astype(np.int64) * max(1, len(self.distinct)) + self.index, return_counts=True)
        total = np.bincount(self.lang, minlength=len(self.langs))
        words = self.distinct.take(pa.array(key % max(1, len(self.distinct))))
        lang = np.concatenate([key // max(1, len(self.distinct)), np.arange(len(self.langs))])
        word = pa.concat_arrays([words.cast(pa.string()), pa.nulls(len(self.langs), pa.string())])
        return pa.record_batch({"lang": self.langs.take(pa.array(lang)), "word": word, "n": pa.array(np.concatenate([n, total]), pa.int64())})

    def grams(self, frequent: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(words, first positions, hashes)`` level by level, up to ``longest`` words; a level with a bitmap in
        ``frequent`` gives only what the bitmap has, and the next level is built from pairs of these."""
        own = hashes(self.distinct)[self.index]
        h = mix(own + hashes(self.langs.cast(pa.binary()))[self.lang] * _ODD)
        at = np.arange(len(own))
        for k in range(1, longest + 1):
            if k > 1:
                known = np.zeros(len(own) + 1, bool)
                known[at] = True
                both = known[at + 1]  # the phrase that starts one word later is frequent too
                at, h = at[both], h[both]
                if k == 2:
                    on = self.goes_on[at]
                    at, h = at[on], h[on]
                h = mix(h * _ODD + own[at + k - 1])
            if k <= len(frequent):
                keep = has(frequent[k - 1], h)
                at, h = at[keep], h[keep]
            yield k, at, h

    def runs(self, frequent: list[np.ndarray]) -> pa.RecordBatch:
        """``lang, run, n, pair``: from every position the longest phrase of two and more words that the bitmaps have, distinct
        ones with their counts and the hash of their first two words. Every phrase that they have begins the runs from all
        its positions."""
        length = np.zeros(len(self.index), np.int64)
        for k, at, h in self.grams(frequent, len(frequent)):
            if k > 1:
                length[at] = k
            if k == 2:
                pair = h  # from the positions that have a length
        at = np.flatnonzero(length)
        wide = len(self.distinct) + 1
        code, most = self.lang[at].astype(np.int64) * wide + self.index[at], len(self.langs) * wide
        for k in range(2, len(frequent) + 1):
            if most * wide >= 1 << 63:
                found, code = np.unique(code, return_inverse=True)
                most = len(found)
            there = length[at] >= k
            code *= wide
            code[there] += self.index[at[there] + k - 1] + 1
            most *= wide
        _, nth, n = np.unique(code, return_index=True, return_counts=True)
        at, pair = at[nth], pair[nth]
        lang, runs, times, pairs = [], [], [], []
        for k in range(2, len(frequent) + 1):
            of = np.flatnonzero(length[at] == k)
            lang.append(self.lang[at[of]])
            runs.append(self.phrases(at[of], k))
            times.append(n[of])
            pairs.append(pair[of])
        lang, n, pair = (np.concatenate(x) for x in (lang, times, pairs))
        return pa.record_batch({"lang": self.langs.take(pa.array(lang)), "run": pa.concat_arrays(runs), "n": pa.array(n, pa.int64()), "pair": hash_array(pair)})

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        words = [self.distinct.take(pa.array(self.index[at + i])).cast(pa.string()) for i in range(k)]
        return words[0] if k == 1 else pc.binary_join_element_wise(*words, " ")


def has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent_bitmap(rows: DataFrame, count: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of the column ``h``: a power of two of at least ``BITS_EACH`` for each hash, ``max_bits`` at most."""
    bits = 64
    while bits < count * BITS_EACH and bits < max_bits:
        bits *= 2
    bit = F.col("h").bitwiseAND(F.lit(bits - 1))
    cells = rows.groupBy(F.shiftright(bit, 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, int(h & 63))")).alias("set"))
    found = cells.toArrow()  # at most max_bits / 64 rows
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[found.column("cell").to_numpy()] = found.column("set").to_numpy()
    return bitmap.view(np.uint8)


def added_up(parts: list[pa.RecordBatch], key: str = "run") -> pa.RecordBatch:
    """Distinct ``lang`` and ``key`` of the parts with the sums of their ``n``, and ``pair`` if they have it."""
    table = pa.Table.from_batches(parts)
    (langs, lang), (keys, at) = (
        (coded.dictionary, coded.indices.to_numpy().astype(np.int64))
        for coded in (pa.concat_arrays(table.column(c).chunks).dictionary_encode(null_encoding="encode") for c in ("lang", key))
    )
    both, inverse = np.unique(lang * len(keys) + at, return_inverse=True)
    n = np.zeros(len(both), np.int64)
    np.add.at(n, inverse, table.column("n").to_numpy())
    out = {"lang": langs.take(pa.array(both // len(keys))), key: keys.take(pa.array(both % len(keys))), "n": pa.array(n)}
    if "pair" in table.column_names:
        pair = np.empty(len(both), np.int64)
        pair[inverse] = table.column("pair").to_numpy()  # a run's own
        out["pair"] = pa.array(pair)
    return pa.record_batch(out)


def parted(rows: pa.RecordBatch, most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for first in range(0, rows.num_rows, most):
        yield rows.slice(first, most)


def cells(x: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of x between each two cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32)), pa.py_buffer(x)])


def joined(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def packed_runs(rows: pa.RecordBatch, ranges: int) -> Iterator[pa.RecordBatch]:
    """``range, lang, runs, lengths, n``: a row for each language and range of ``pair``."""
    coded = rows.column("lang").dictionary_encode()
    pair = rows.column("pair").to_numpy().view(np.uint64)
    code = coded.indices.to_numpy().astype(np.int64) * ranges + ((pair >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(code, kind="stable")
    code = code[order]
    cuts = np.append(np.flatnonzero(np.append(True, code[1:] != code[:-1])), len(code))
    runs, code = rows.column("run").take(pa.array(order)), code[cuts[:-1]]
    ends = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1]
    text = pa.Array.from_buffers(pa.binary(), len(code), [None, pa.py_buffer(ends[cuts]), runs.buffers()[2]])
    n = rows.column("n").to_numpy()[order].astype(np.int32)  # of a block
    lang = coded.dictionary.take(pa.array(code // ranges))
    row = {"range": pa.array(code % ranges, pa.int32()), "lang": lang, "runs": text, "lengths": cells(np.diff(ends), cuts), "n": cells(n, cuts)}
    yield from parted(pa.record_batch(row), 256)


def unpacked_runs(rows: pa.RecordBatch) -> pa.RecordBatch:
    """``lang, run, n`` again."""
    lengths, n = joined(rows.column("lengths"), np.int32), joined(rows.column("n"), np.int32).astype(np.int64)
    ends = np.zeros(len(n) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    run = pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(rows.column("runs").to_pylist()))])
    lang = np.repeat(np.arange(rows.num_rows), pc.binary_length(rows.column("n")).to_numpy() // 4)
    return pa.record_batch({"lang": rows.column("lang").take(pa.array(lang)), "run": run, "n": pa.array(n)})


def over_slices(texts: DataFrame, rows_of, key: str, sent, schema: str) -> DataFrame:
    """``rows_of(words)`` for the words of every slice of bounded size, added up over blocks of slices and given on by ``sent``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                held += [rows] if (rows := rows_of(Words(part))).num_rows else []
                if sum(rows.nbytes for rows in held) >= BLOCK:
                    yield from sent(added_up(held, key))
                    held = []
        if held:
            yield from sent(added_up(held, key))

    return texts.mapInArrow(run, schema)


def hash_array(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def often(texts: DataFrame, of_slice, min_count: int) -> DataFrame:
    """``h``: the hashes that ``of_slice(words)`` of all slices gives ``min_count`` times. They are counted by sorting, in
    blocks of slices and then by range of hashes; a block goes to a range as one row."""
    ranges = RANGES_EACH * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.append(np.searchsorted(h, np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)), len(h))
        own = np.flatnonzero(np.diff(cuts))
        cuts = np.append(cuts[own], len(h))
        return pa.record_batch({"range": pa.array(own, pa.int32()), "h": cells(h, cuts), "n": cells(n.astype(np.int32), cuts)})

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                held.append(of_slice(Words(part)))
                if sum(map(len, held)) >= BLOCK_HASHES:
                    yield packed(held)
                    held = []
        if sum(map(len, held)):
            yield packed(held)

    def total(rows: pa.Table) -> pa.Table:
        h, n = joined(rows.column("h"), np.uint64), joined(rows.column("n"), np.int32)
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        return pa.table({"h": hash_array(h[first][np.add.reduceat(n[order].astype(np.int64), first) >= min_count])})

    return texts.mapInArrow(run, "range int, h binary, n binary").groupBy("range").applyInArrow(total, "h long")


def frequent_bitmaps(texts: DataFrame, words: DataFrame, longest: int, min_count: int, max_bits: int = MAX_BITS) -> tuple[list[np.ndarray], int]:
    """Bitmaps of 1 to ``longest`` words that have the hash of every phrase with ``min_count`` occurrences, and how many
    hashes of two and more words they were made from."""
    spark = texts.sparkSession

    def of_words(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = mix(hashes(batch.column("word").cast(pa.binary())) + hashes(batch.column("lang").cast(pa.binary())) * _ODD)
            yield pa.record_batch({"h": hash_array(h)})

    level = stash(words.select("lang", "word").mapInArrow(of_words, "h long"), "frequent-words")
    bitmaps, n_phrases = [frequent_bitmap(level, level.count(), max_bits)], 0
    for k in range(2, longest + 1):
        known = spark.sparkContext.broadcast(list(bitmaps))

        def of_slice(slice_words: Words, k=k, known=known) -> np.ndarray:
            *_, (_, _, h) = slice_words.grams(known.value, k)
            return h

        level = stash(often(texts, of_slice, min_count), f"frequent-{k}")
        n = level.count()
        n_phrases += n
        bitmaps.append(frequent_bitmap(level, n, max_bits))
    return bitmaps, n_phrases


class DoubleArray:
    """Double-array trie over sequences of digits: the child of state s by digit c is t = base[s] + c if check[t] == s.

    State 0 is dead, its children and those of leaves are free cells. ``accept[t]`` is the number of the sequence that
    ends in t, or -1.
    """

    def __init__(self, paths: np.ndarray, lengths: np.ndarray):
        """``paths``: digits of each sequence, one row each, distinct; ``lengths``: how many of them count."""
        n, width = paths.shape
        node = np.zeros(n, np.int64)  # of each sequence, level by level; 0 is the root
        parents, digits, ends, made = [], [], np.zeros(n, np.int64), 1
        for level in range(width):
            rows = np.flatnonzero(lengths > level)
            key, inverse = np.unique(node[rows] * DIGIT + paths[rows, level], return_inverse=True)
            parents.append(key // DIGIT)
            digits.append(key % DIGIT)
            node[rows] = made + inverse
            made += len(key)
            done = rows[lengths[rows] == level + 1]
            ends[done] = node[done]
        parent, digit = np.concatenate([*parents, np.zeros(0, np.int64)]), np.concatenate([*digits, np.zeros(0, np.int64)])
        base_of, slot_of, cells = self._place(parent, digit, made)
        self.base, self.check, self.accept = np.zeros(cells, np.int32), np.full(cells, -1, np.int32), np.full(cells, -1, np.int32)
        self.root = int(slot_of[0])
        self.base[slot_of] = base_of
        self.check[slot_of[1:]] = slot_of[parent]
        self.accept[slot_of[ends[lengths > 0]]] = np.flatnonzero(lengths > 0)

    @staticmethod
    def _place(parent: np.ndarray, digit: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Base and cell of every node. Children of a node are contiguous in ``parent``, edge e leads to node e + 1.

        Nodes with many children get a block of their own; those with a few try random places, all of a size class at
        once, the largest first into an empty zone; those with one child fill what is free.
        """
        first, size = np.searchsorted(parent, np.arange(nodes)), np.bincount(parent, minlength=nodes)
        base, taken = np.zeros(nodes, np.int64), DIGIT  # cells below DIGIT stay free: base 0 leads nowhere
        large = np.flatnonzero(size >= 32)
        base[large] = taken + DIGIT * np.arange(len(large))
        zone = taken + DIGIT * len(large)
        some = np.flatnonzero((size > 1) & (size < 32))
        singles = np.flatnonzero(size == 1)
        cells = zone + 4 * int(size[some].sum()) + 2 * DIGIT
        used = np.zeros(cells, bool)

        def edges(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Edge numbers of nodes, and which of ``of`` each belongs to."""
            which = np.repeat(np.arange(len(of)), size[of])
            return np.arange(len(which)) - np.repeat(np.cumsum(size[of]) - size[of], size[of]) + first[of][which], which

        e, which = edges(large)
        used[base[large][which] + digit[e]] = True
        rng, claim = np.random.default_rng(0), np.empty(cells, np.int64)
        for low in (16, 8, 4, 2):
            todo = some[(size[some] >= low) & (size[some] < 2 * low)]
            tries = 0
            while len(todo):
                tries += 1
                if tries % 64 == 0:  # full by chance: more room
                    used = np.concatenate([used, np.zeros(len(used) // 2, bool)])
                    claim = np.empty(len(used), np.int64)
                at = rng.integers(zone, len(used) - DIGIT, len(todo))
                e, which = edges(todo)
                cell = at[which] + digit[e]
                claim[cell] = which  # of two nodes that want a cell now, one sees the other's number
                bad = np.zeros(len(todo), bool)
                bad[which[used[cell] | (claim[cell] != which)]] = True
                good = ~bad
                base[todo[good]] = at[good]
                used[cell[good[which]]] = True
                todo = todo[bad]
        free = np.flatnonzero(~used[DIGIT:]) + DIGIT
        if len(free) < len(singles) + 1:
            extra = len(singles) + 1 - len(free)
            free = np.concatenate([free, len(used) + np.arange(extra)])
            used = np.concatenate([used, np.zeros(extra, bool)])
        root, places = int(free[-1]), free[: len(singles)]
        base[singles] = places - digit[first[singles]]
        slot = np.empty(nodes, np.int64)
        slot[0] = root
        slot[1:] = base[parent] + digit
        return base, slot, max(len(used), root + 1) + DIGIT

    def step(self, states: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Children of all states at once; 0 where there is none."""
        to = self.base[states] + digits
        return np.where(self.check[to] == states, to, 0)


class PhraseTrie:
    """The beginnings, of two words and more, of distinct runs of words as a trie: a language's number, then the numbers of
    the words, each as the same count of digits."""

    def __init__(self, runs: pa.RecordBatch):
        words = pc.split_pattern(runs.column("run"), " ")
        flat = words.flatten().dictionary_encode()
        self.lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(-np.bincount(flat.indices.to_numpy(), minlength=len(flat.dictionary)), kind="stable")
        number = np.empty(len(order), np.int64)  # frequent words first: their digits are dense
        number[order] = np.arange(len(order))
        self.vocabulary = flat.dictionary.take(pa.array(order))
        coded = runs.column("lang").dictionary_encode()
        self.width = 1
        while DIGIT**self.width < max(len(order), len(coded.dictionary)):
            self.width += 1
        self.longest = int(self.lengths.max(initial=0))
        self.numbers = np.zeros((runs.num_rows, 1 + self.longest), np.int64)
        self.numbers[:, 0] = coded.indices.to_numpy()
        row = np.repeat(np.arange(runs.num_rows), self.lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths) + 1
        self.numbers[row, column] = number[flat.indices.to_numpy()]
        known = self.numbers[:, 0] * max(1, len(order)) + self.numbers[:, 1]
        rows, ks = [], []  # of each candidate: a run that begins with it, its words
        for k in range(2, self.longest + 1):
            known = np.unique(known, return_inverse=True)[1] * (len(order) + 1) + np.where(self.lengths >= k, self.numbers[:, k] + 1, 0)
            _, nth = np.unique(known, return_index=True)
            nth = nth[self.lengths[nth] >= k]
            rows.append(nth)
            ks.append(np.full(len(nth), k, np.int64))
        self.rows, self.ks = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (rows, ks))
        paths = np.stack([d.astype(np.uint8) for i in range(1 + self.longest) for d in self.digits(self.numbers[self.rows, i])], axis=1)
        self.array = DoubleArray(paths, (1 + self.ks) * self.width)

    def digits(self, numbers: np.ndarray) -> list[np.ndarray]:
        return [numbers // DIGIT**i % DIGIT for i in range(self.width - 1, -1, -1)]

    def count(self, times: np.ndarray) -> np.ndarray:
        """Occurrences of each candidate in the runs, each of which occurs so many ``times``: the states of all runs move on
        together, one word a level."""
        out = np.zeros(len(self.rows), np.int64)
        at = np.arange(len(self.numbers))
        state = self._through(np.full(len(at), self.array.root, np.int32), self.numbers[:, 0])
        for k in range(1, self.longest + 1):
            on = self.lengths[at] >= k
            at = at[on]
            state = self._through(state[on], self.numbers[at, k])
            ended = self.array.accept[state]
            np.add.at(out, ended[ended >= 0], times[at[ended >= 0]])
        return out

    def phrases(self, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
        """``(words, candidates, phrases)`` of the candidates that are ``wanted``."""
        for k in range(2, self.longest + 1):
            hit = np.flatnonzero(wanted & (self.ks == k))
            if len(hit):
                words = [self.vocabulary.take(pa.array(self.numbers[self.rows[hit], 1 + i])) for i in range(k)]
                yield k, hit, pc.binary_join_element_wise(*words, " ")

    def _through(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        for digit in self.digits(number):
            state = self.array.step(state, digit.astype(np.int32))
        return state


def count_phrases(texts: DataFrame, bitmaps: list[np.ndarray], n_shards: int, min_count: int) -> DataFrame:
    """``lang, phrase, k, f``: the phrases of two and more words that the bitmaps have and that occur ``min_count`` times, with
    their exact occurrences, from a trie a shard.

    Runs that begin with the same two words share a shard, so it has all runs that its phrases begin.
    """
    known, ranges = texts.sparkSession.sparkContext.broadcast(bitmaps), RANGES_EACH * n_shards

    def shard(batches) -> Iterator[pa.RecordBatch]:
        held, rows, distinct = [], 0, 0
        for batch in batches:
            held.append(unpacked_runs(batch))
            rows += held[-1].num_rows
            if rows >= 2 * distinct + SHARD_ROWS:
                held = [added_up(held)]
                rows = distinct = held[0].num_rows
        if rows:
            own = added_up(held)
            trie = PhraseTrie(own)
            f = trie.count(own.column("n").to_numpy())
            for k, hit, phrases in trie.phrases(f >= min_count):
                lang = own.column("lang").take(pa.array(trie.rows[hit]))
                yield from parted(pa.record_batch({"lang": lang, "phrase": phrases, "k": pa.array(np.full(len(hit), k, np.int32)), "f": pa.array(f[hit])}))

    packed = "range int, lang string, runs binary, lengths binary, n binary"
    runs = over_slices(texts, lambda words: words.runs(known.value), "run", lambda rows: packed_runs(rows, ranges), packed)
    return runs.repartition(n_shards, "range").mapInArrow(shard, "lang string, phrase string, k int, f long")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    min_count: int = 10,
    top: int = 2000,
    inside_percent: int = 50,
    lang_col: str = "lang",
    text_col: str = "text",
    shard_phrases: int = SHARD_PHRASES,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to ``longest`` words of each language.

    ``a``, ``l``, ``r`` count the phrase and its two parts at the cut with the lowest floor(1000000*a*a/(l*r)), ``n`` all
    words of the language. Phrases inside a longer candidate with ``inside_percent`` of their count go.

    There are as many shards as shuffle partitions, more if one had over ``shard_phrases`` frequent hashes on average.

    NULL texts count as empty, a NULL language is ``und``; repeated rows count as often as they occur; an empty table, or
    one without a phrase of ``min_count`` occurrences, gives no rows; other columns are not looked at, whatever their
    names. Texts are read whole, in slices of bounded size or one text. Ties go by the phrase's bytes.
    """
    found_by_workers(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
    )
    counted = over_slices(texts, Words.unigrams, "word", parted, "lang string, word string, n long")
    words = stash(
        counted.groupBy("lang", "word").agg(F.sum("n").alias("f")).where((F.col("f") >= min_count) | F.col("word").isNull()), "words"
    )
    frequent = words.where(F.col("word").isNotNull())
    bitmaps, n_phrases = frequent_bitmaps(texts, frequent, longest, min_count, max_bits)
    n_shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_phrases // shard_phrases))
    phrases = stash(count_phrases(texts, bitmaps, n_shards, min_count), "phrases")
    return ranked(phrases, frequent, words.where(F.col("word").isNull()).select("lang", F.col("f").alias("n")), longest, top, inside_percent)


def ranked(phrases: DataFrame, words: DataFrame, totals: DataFrame, longest: int, top: int, inside_percent: int) -> DataFrame:
    """Scores, drop rule and ranking of counted candidates ``lang, phrase, k, f``."""
    parts = phrases.select("lang", "phrase", "f").unionByName(words.select("lang", F.col("word").alias("phrase"), "f"))
    split = phrases.withColumn("w", F.split("phrase", " "))
    spoken = lambda start, length: F.concat_ws(" ", F.slice("w", start, length))
    cuts = split.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut", spoken(F.lit(1), F.col("cut")).alias("head"), spoken(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail")
    )
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("above", (F.lit(1_000_000).cast("decimal(7,0)") * (exact("a") * exact("a"))).cast("decimal(38,0)"))
        .withColumn("below", (exact("l") * exact("r")).cast("decimal(38,0)"))
        .withColumn("score", F.expr("above div below"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.score", "best.l", "best.r")
    )
    inner = (
        split.where(F.col("k") > 2)
        .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("length") + 1)))
        .select("lang", spoken(F.col("start"), F.col("length")).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each hash class first: a language's candidates never meet in one task, only classes' best do
    shares = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    in_share = Window.partitionBy("lang", "share").orderBy(*order)
    best = shares.withColumn("nth", F.row_number().over(in_share)).where(F.col("nth") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (
        best.withColumn("rank", rank.cast("long"))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
