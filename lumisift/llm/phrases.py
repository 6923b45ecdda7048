"""Phrase collocations: Apriori-safe candidates, handed once to the double-array tries that count them.

Everything is per language. Texts are split as bytes into normalised pieces (`byte_words`), where a run of words is the
very string of its phrase.

1. *Bounds.* For 1, 2, ... words, every task counts its runs under a key of `KEY_BITS` bits. Keys travel sorted, as
   compressed differences, to the task that adds the counts of their range; keys that reach the least count are set in a
   bit table of fixed size. Two different phrases may share a key, so a sum is an upper bound. A run is counted only if
   the tables hold its words and its first and its last words but one (Apriori: no part of a frequent phrase is rarer),
   which keeps most positions out of the exchange.
2. *Candidates.* The words and phrases whose keys reach the least count. They contain every one that is frequent enough.
   In one pass over the texts every task counts the candidates at all its positions and hands them on, equal ones as one,
   to the part that the key belongs to. Equal keys only propose that runs are equal, their bytes decide.
3. *Counts.* The candidates of a part, about `PHRASES` of them, are built into a double-array trie over bytes by a Spark
   task. The tries are broadcast, one at a time, to what was handed to their part, and only that: numpy moves the states
   of all runs ahead byte by byte, the numbers they end in are counted with `bincount`, and Spark adds the tasks' counts.
   These counts are exact whatever the keys did, and what does not reach the least count leaves.

What is broadcast is bounded by constants. The texts are read once for each number of words and once for the candidates,
however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.llm import byte_words
from lumisift.llm.byte_pieces import small
from lumisift.llm.byte_words import Keys, Words
from lumisift.llm.stored import stored
from lumisift.llm.workers import hold
from lumisift.operators.topk import top_n_per_group
from lumisift.session import shared_folder

#: Bits of a key, bits of a table of keys, phrases of a trie.
KEY_BITS, BITS, PHRASES = 48, 1 << 27, 500_000
#: Bytes of text for which a task adds counts, and keys a task holds before it hands on what it counted; bound memory only.
SHARE, HELD = 16_000_000, 800_000
#: What `Sums` hands on.
COUNTED = "share bigint, many bigint, keys binary, counts binary"
#: Files of what is handed to a part.
SPREAD = 8
#: Copies of a word's count.
SALTS = 16
#: The language of texts whose language is null.
UNDETERMINED = "und"
#: Separators, fixed values: what ends a piece, and what lies between words.
PIECE_ENDS, SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
#: Between a language and a phrase in a trie; no phrase holds it.
AFTER_LANG = b"\n"
_KIND = byte_words.kinds(SPACES, PIECE_ENDS)


@cache
def _keys(seed: int = 5) -> Keys:
    return Keys(seed)


@dataclass
class Trie:
    """A double array: the child of state `s` by byte `c` is `base[s] + c` if `check` there is `s`; `accept` is the
    number of the phrase that ends in a state, or -1."""

    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    phrases: int

    @classmethod
    def of(cls, phrases: list[bytes]) -> Trie:
        """The trie of distinct phrases; a phrase's number is its place in the list."""
        order = sorted(range(len(phrases)), key=phrases.__getitem__)
        size = np.array([len(phrases[i]) for i in order], np.int64)
        raw = np.frombuffer(b"".join(phrases[i] for i in order), np.uint8)
        begin = np.cumsum(size) - size
        node = np.zeros(len(order), np.int64)  # the state of each phrase's prefix so far
        free = _Free(2 * len(order))
        free.take(np.zeros(1, np.int64))
        base, check = free.array(0), free.array(-1)
        accept = free.array(-1)
        for depth in range(int(size.max(initial=0)) + 1):
            done = size == depth
            accept = free.fit(accept, -1)
            accept[node[done]] = np.array(order, np.int64)[done]
            live = np.flatnonzero(size > depth)
            if not len(live):
                break
            byte, parent = raw[begin[live] + depth].astype(np.int64), node[live]
            first = np.append(True, (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1]))  # prefixes lie side by side
            child_byte, child_parent = byte[first], parent[first]
            own = np.append(True, child_parent[1:] != child_parent[:-1])
            at = np.flatnonzero(own)
            many = np.diff(np.append(at, len(own)))
            bases, one = np.empty(len(at), np.int64), many == 1
            bases[~one] = free.place(child_byte[np.repeat(~one, many)], many[~one])
            bases[one] = free.next(int(one.sum())) - child_byte[at[one]]
            base, check = free.fit(base, 0), free.fit(check, -1)
            base[child_parent[at]] = bases
            slot = np.repeat(bases, many) + child_byte
            check[slot] = child_parent
            node[live] = slot[np.cumsum(first) - 1]
        top = free.top + 512
        return cls(*(free.fit(x, fill)[:top].copy() for x, fill in ((base, 0), (check, -1), (accept, -1))), len(phrases))

    def state(self, prefix: bytes) -> int:
        """The state after a prefix, or -1."""
        at = 0
        for c in prefix:
            slot = int(self.base[at]) + c
            if not 0 <= slot < len(self.check) or self.check[slot] != at:
                return -1
            at = slot
        return at

    def numbers(self, text: np.ndarray, start: np.ndarray, state: int) -> np.ndarray:
        """Numbers of the phrases that begin at `start` and end before the next `LAST`, or -1, from the state of their
        language; all move ahead together, byte by byte."""
        out, live = np.full(len(start), -1, np.int64), np.arange(len(start) if state >= 0 else 0)
        at, state = start[live], np.full(len(live), state, np.int32)
        while len(live):
            byte = text[at]
            over = byte == byte_words.LAST
            out[live[over]] = self.accept[state[over]]
            slot = self.base[state] + byte
            on = (self.check[slot] == state) & ~over
            at, state, live = at[on] + 1, slot[on], live[on]
        return out


class _Free:
    """Free places of a double array that is being built. Places below 256 stay empty, so that no base is negative."""

    def __init__(self, size: int):
        self.used = np.zeros(1024 + size, bool)
        self.low, self.top = 256, 256

    def array(self, fill: int) -> np.ndarray:
        return np.full(len(self.used), fill, np.int32)

    def fit(self, array: np.ndarray, fill: int) -> np.ndarray:
        more = len(self.used) - len(array)
        return np.concatenate([array, np.full(more, fill, np.int32)]) if more > 0 else array

    def _reach(self, n: int) -> None:
        if n + 512 > len(self.used):
            self.used = np.concatenate([self.used, np.zeros(n + 512 - len(self.used) + len(self.used) // 2, bool)])

    def take(self, slots: np.ndarray) -> None:
        self.used[slots] = True
        self.top = max(self.top, int(slots.max()) + 1)

    def next(self, n: int) -> np.ndarray:
        """The next `n` free places, taken."""
        if not n:
            return np.zeros(0, np.int64)
        reach = 2 * n + 1024
        while True:
            self._reach(self.low + reach)
            slots = self.low + np.flatnonzero(~self.used[self.low : self.low + reach])[:n]
            if len(slots) == n:
                break
            reach *= 2
        self.take(slots)
        self.low = int(slots[-1]) + 1
        return slots

    def place(self, children: np.ndarray, many: np.ndarray, rounds: int = 6) -> np.ndarray:
        """Bases at which the places of all children are free, taken; `many` children belong to each base.

        All bases are proposed together, from the free places on; those that meet a taken place or an earlier proposal
        try again, and what is left after some rounds gets a stretch of its own behind everything."""
        bases, left = np.zeros(len(many), np.int64), np.arange(len(many))
        first = np.cumsum(many) - many
        for turn in range(rounds if len(many) else 0):
            at = np.repeat(first[left] - np.append(0, np.cumsum(many[left])[:-1]), many[left]) + np.arange(many[left].sum())
            reach = 2 * len(at) + 1024
            self._reach(max(self.low + reach, self.top))
            begin = self.low + np.flatnonzero(~self.used[self.low : self.low + reach])
            begin = begin[(np.arange(len(left)) * len(begin) // len(left) + turn) % len(begin)] if len(begin) else np.full(len(left), self.top)
            base = begin - children[first[left]]
            slot = np.repeat(base, many[left]) + children[at]
            fresh = np.zeros(len(slot), bool)
            fresh[np.unique(slot, return_index=True)[1]] = True
            start = np.append(0, np.cumsum(many[left])[:-1])
            good = np.logical_and.reduceat(fresh & ~self.used[slot], start)
            bases[left[good]] = base[good]
            if good.any():
                self.take(slot[np.repeat(good, many[left])])
            left = left[~good]
            if not len(left):
                return bases
        span = children[first[left] + many[left] - 1] - children[first[left]] + 1
        begin = self.top + np.cumsum(span) - span
        bases[left] = begin - children[first[left]]
        at = np.repeat(first[left] - np.append(0, np.cumsum(many[left])[:-1]), many[left]) + np.arange(many[left].sum())
        if len(left):
            self._reach(int(begin[-1] + span[-1]))
            self.take(np.repeat(bases[left], many[left]) + children[at])
        return bases


class Tables:
    """Bit tables of the keys that reach the least count, by number of words."""

    def __init__(self, tables: list[Broadcast]):
        self.tables = [t.value for t in tables]

    def holds(self, n: int, keys: np.ndarray) -> np.ndarray:
        table, out = self.tables[n - 1], None
        for place in _places(keys, 64 * len(table)):
            bit = (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
            out = bit if out is None else out & bit
        return out.astype(bool)


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a key."""
    again = byte_words.mixed(keys * np.uint64(0x9E3779B97F4A7C15))
    return again % np.uint64(bits), (again >> np.uint64(32)) % np.uint64(bits)


def _salted(batch: pa.RecordBatch) -> tuple[pa.Array, list[str], np.ndarray, np.ndarray]:
    """Texts, the batch's languages, the place of each row's language among them, and a salt for its keys."""
    lang = batch.column(0).fill_null(UNDETERMINED).dictionary_encode()
    langs = lang.dictionary.to_pylist()
    of = lang.indices.to_numpy(zero_copy_only=False)
    salts = _keys(7).of([x.encode("utf-8", "surrogatepass") for x in langs])
    return batch.column(1), langs, of, salts


def _runs(found: Words, longest: int, salt: np.ndarray, tables: Tables) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For 1 to `longest` words, the words at which runs begin that the tables of shorter runs do not rule out, and the
    runs' keys."""
    running, held = _keys().running(found.text), None
    for n in range(1, longest + 1):
        at = found.linked(n)
        if n > 1:
            at = at[held[at] & held[at + 1]]
        raw = _keys().spans(running, found.start[at], found.end[at + n - 1])
        keys = byte_words.mixed(raw + salt[at]) >> np.uint64(64 - KEY_BITS)
        yield n, at, keys
        if n < longest:
            held = np.zeros(len(found.start), bool)
            held[at] = tables.holds(n, keys)


def _packed(keys: np.ndarray) -> bytes:
    """Ascending keys as compressed differences, byte by byte of all of them."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return pa.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


class Sums:
    """Counts by key, up to the least count that matters; handed on when many are held."""

    def __init__(self, least: int, shares: int, bits: int = KEY_BITS):
        self.least, self.share = least, np.uint64(-(-(1 << bits) // shares))
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        """More keys, which count one each if not told otherwise."""
        if counts is None:
            kept, counts = _added(np.sort(keys), np.ones(len(keys), np.int32))
        else:
            order = np.argsort(keys)
            kept, counts = _added(keys[order], counts[order])
        self.keys.append(kept)
        self.counts.append(counts)
        self.held += len(kept)
        if self.held >= HELD:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([np.zeros(0, np.uint64), *self.keys])
        order = np.argsort(keys)
        keys, counts = _added(keys[order], np.concatenate([np.zeros(0, np.int32), *self.counts])[order])
        self.keys, self.counts, self.held = [keys], [np.minimum(counts, self.least)], len(keys)

    def hand_on(self, all_of_it: bool = False) -> Iterator[pa.RecordBatch]:
        """What was counted, a row for each share of the keys, if it is too much to go on with or there is no more."""
        if all_of_it:
            self.merge()
        elif self.held < HELD // 2 or len(self.keys) > 1:
            return
        keys, counts = self.keys[0], self.counts[0]
        share = keys // self.share
        begin = _changes(share)
        out = []
        for low, high in zip(begin.tolist(), [*begin.tolist()[1:], len(keys)], strict=False):
            out.append((int(share[low]), high - low, _packed(keys[low:high]), _compressed(counts[low:high])))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], ["share", "many", "keys", "counts"])
        self.keys, self.counts, self.held = [], [], 0


def _changes(ordered: np.ndarray) -> np.ndarray:
    """Places of the first of equal neighbours."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of ascending keys and the sums of their counts."""
    begin = _changes(keys)
    return keys[begin], np.minimum(np.add.reduceat(counts, begin, dtype=np.int64), 1 << 30).astype(np.int32) if len(begin) else counts


def _compressed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype("<i4").tobytes(), "zstd", asbytes=True)


def _counts(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 4 * n, "zstd", asbytes=True), "<i4")


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("text is not null")


def bit_table(counted: DataFrame, least: int, bits: int) -> tuple[np.ndarray, int]:
    """A table of so many bits with the two bits of every key whose counts, as `Sums` hands them on, add up to the least, and
    about how many of the different keys it lets through."""

    def add(part: pa.Table) -> pa.Table:
        many = part["many"].to_pylist()
        keys = np.concatenate([_unpacked(x, m) for x, m in zip(part["keys"].to_pylist(), many, strict=True)])
        counts = np.concatenate([_counts(x, m) for x, m in zip(part["counts"].to_pylist(), many, strict=True)])
        order = np.argsort(keys)
        keys, counts = _added(keys[order], counts[order])
        met, keys = len(keys), keys[counts >= least]
        place = np.concatenate(_places(keys, bits))
        word, code = np.unique(place >> np.uint64(6), return_inverse=True)
        held = np.zeros(len(word), np.uint64)
        np.bitwise_or.at(held, code, np.uint64(1) << (place & np.uint64(63)))
        share = part["share"][0].as_py()  # below zero, how many keys the share has and how many of them are frequent
        word, held = np.append(word.view(np.int64), [-2 * share - 2, -2 * share - 1]), np.append(held.view(np.int64), [met, len(keys)])
        return pa.Table.from_arrays([pa.array(word), pa.array(held)], ["word", "bits"])

    words = counted.groupBy("share").applyInArrow(add, "word bigint, bits bigint")
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most bits / 64 rows and two a share
    word, held = words["word"].to_numpy(), words["bits"].to_numpy()
    table = np.zeros(bits // 64, np.uint64)
    table[word[word >= 0]] = held[word >= 0].view(np.uint64)
    met, frequent = (int(held[(word < 0) & (word % 2 == odd)].sum()) for odd in (0, 1))
    return table, frequent + int((met - frequent) * (int(np.bitwise_count(table).sum()) / bits) ** 2)


def _bit_table(texts: DataFrame, n: int, tables: list[Broadcast], least: int, shares: int) -> tuple[np.ndarray, int]:
    """A table of `BITS` bits with the two bits of every key of runs of `n` words whose counts add up to the least, and
    about how many different phrases it lets through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("phrases", _keys.cache_clear)
        held, sums = Tables(tables), Sums(least, shares)
        for batch in small(batches):
            column, _, of, salts = _salted(batch)
            for found in byte_words.words(column, _KIND):
                *_, (_, _, keys) = _runs(found, n, salts[of[found.row]], held)
                sums.add(keys)
                yield from sums.hand_on()
        yield from sums.hand_on(all_of_it=True)

    return bit_table(texts.mapInArrow(count, COUNTED), least, BITS)


def _strings(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Spans of a text as binary values, each with `LAST` behind it."""
    size = end - start + 1
    offsets = np.append(0, np.cumsum(size))
    data = text[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    data[offsets[1:] - 1] = byte_words.LAST
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _alike(one: pa.Array, rows: np.ndarray, other: pa.Array, its: np.ndarray) -> np.ndarray:
    return pc.equal(one.take(pa.array(rows)), other.take(pa.array(its))).to_numpy(zero_copy_only=False).astype(bool)


def _distinct(keys: np.ndarray, lang: np.ndarray, phrases: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of each different phrase of a language, by ascending keys, and how often it is there. Of different phrases of
    one key, the first is counted and each other row stays."""
    order = np.argsort(keys)
    begin = _changes(keys[order])
    first = np.repeat(order[begin], np.diff(np.append(begin, len(keys))))
    same, again = order == first, np.flatnonzero(order != first)
    same[again] = _alike(phrases, order[again], phrases, first[again]) & (lang[order[again]] == lang[first[again]])
    counts, own = np.ones(len(keys), np.int64), ~same
    counts[begin] = np.add.reduceat(same, begin, dtype=np.int64) if len(begin) else 0
    own[begin] = True
    return order[own], counts[own]


class _Met:
    """A language's candidates that a task met, with their counts: ascending keys, and the row of each key's phrase; other
    phrases of the same keys are kept beside them."""

    def __init__(self):
        self.keys, self.rows, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.phrases, self.apart = pa.array([], pa.binary()), []

    def add(self, keys: np.ndarray, counts: np.ndarray, phrases: pa.Array) -> None:
        """More candidates, by ascending keys."""
        place = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        rows = np.flatnonzero(known)
        same = _alike(phrases, rows, self.phrases, self.rows[place[rows]])
        np.add.at(self.counts, place[rows[same]], counts[rows[same]])
        fresh = np.flatnonzero(~known)
        first = np.append(True, keys[fresh[1:]] != keys[fresh[:-1]])[: len(fresh)]
        other = np.append(rows[~same], fresh[~first])
        if len(other):
            self.apart.append((keys[other], counts[other], phrases.take(pa.array(other))))
        fresh = fresh[first]
        self.keys, self.counts = np.insert(self.keys, place[fresh], keys[fresh]), np.insert(self.counts, place[fresh], counts[fresh])
        self.rows = np.insert(self.rows, place[fresh], len(self.phrases) + np.arange(len(fresh)))
        self.phrases = pa.concat_arrays([self.phrases, phrases.take(pa.array(fresh))])

    def handed_on(self, parts: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
        """By part: number and bytes of the phrases, the phrases, and their counts."""
        keys, counts, phrases = (list(x) for x in zip((self.keys, self.counts, self.phrases.take(pa.array(self.rows))), *self.apart, strict=True))
        keys, counts, phrases = np.concatenate(keys), np.concatenate(counts), pa.concat_arrays(phrases)
        part = (keys % np.uint64(parts)).astype(np.int64)
        begins = np.zeros(len(keys), np.uint64)  # neighbours that begin alike are compressed well
        offsets, text = (np.frombuffer(x, kind) for x, kind in zip(phrases.buffers()[1:], (np.int32, np.uint8), strict=True))
        for k in range(8):
            begins = begins << np.uint64(8) | text[np.minimum(offsets[:-1] + k, offsets[1:] - 1)]
        order = np.argsort(begins)
        order = order[np.argsort(part[order], kind="stable")]
        phrases, part, counts = phrases.take(pa.array(order)), part[order], counts[order]
        offsets, text = np.frombuffer(phrases.buffers()[1], np.int32), phrases.buffers()[2]
        edges = [*_changes(part).tolist(), len(part)]
        for low, high in zip(edges, edges[1:], strict=False):
            begin, end = int(offsets[low]), int(offsets[high])
            yield int(part[low]), high - low, end - begin, pa.compress(text.slice(begin, end - begin), "zstd", asbytes=True), _compressed(counts[low:high])


_HANDED = "part bigint, lang string, many bigint, bytes bigint, phrases binary, counts binary"


def _candidates(texts: DataFrame, longest: int, tables: list[Broadcast], parts: int) -> DataFrame:
    """What the tasks hand to the parts, candidates of a language with their counts in a row, and for every language rows
    of a part -1 that sum its words in `many`."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = dict(zip(("part", "lang", "many", "bytes", "phrases", "counts"), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("phrases", _keys.cache_clear)
        held, met, total = Tables(tables), {}, {}
        handed = lambda: batch_of([(part, lang, *row) for lang, own in met.items() for part, *row in own.handed_on(parts)])
        for batch in small(batches):
            column, langs, of, salts = _salted(batch)
            for found in byte_words.words(column, _KIND):
                lang = of[found.row]
                for code, many in enumerate(np.bincount(lang, minlength=len(langs)).tolist()):
                    total[langs[code]] = total.get(langs[code], 0) + many
                runs = []
                for n, at, keys in _runs(found, longest, salts[lang], held):
                    on = held.holds(n, keys)
                    runs.append((keys[on], at[on], at[on] + n - 1))
                keys, first, last = (np.concatenate(x) for x in zip(*runs, strict=True))
                phrases = _strings(found.text, found.start[first], found.end[last])
                rows, counts = _distinct(keys, lang[first], phrases)
                for code in np.unique(lang[first[rows]]).tolist():
                    own = lang[first[rows]] == code
                    met.setdefault(langs[code], _Met()).add(keys[rows[own]], counts[own], phrases.take(pa.array(rows[own])))
                if sum(len(x.keys) + x.phrases.nbytes // 40 for x in met.values()) >= HELD:
                    yield handed()
                    met.clear()
        yield handed()
        yield batch_of([(-1, lang, many, 0, None, None) for lang, many in total.items()])

    return texts.mapInArrow(run, _HANDED)


def _by_part(handed: DataFrame) -> DataFrame:
    """Stored in folders of their own by part, so that the pass of a part reads nothing else."""
    path = shared_folder(handed.sparkSession, "handed")
    salt = F.pmod(F.xxhash64("phrases"), F.lit(SPREAD))
    handed.repartition("part", salt).write.partitionBy("part").parquet(path)
    return handed.sparkSession.read.schema(handed.schema).parquet(path)


def _phrases(handed: DataFrame) -> DataFrame:
    """The different candidates of every part, numbered in order (`part, number, lang, phrase, words`)."""

    def distinct(part: pa.Table) -> pa.Table:
        held = {}
        for lang, size, packed in zip(*(part[x].to_pylist() for x in ("lang", "bytes", "phrases")), strict=True):
            held.setdefault(lang, set()).update(pa.decompress(packed, size, "zstd", asbytes=True).split(bytes([byte_words.LAST]))[:-1])
        rows = [(lang, phrase) for lang in sorted(held) for phrase in sorted(held[lang])]
        lang, phrase = pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.binary())
        words = pa.array([x.count(byte_words.INSIDE) + 1 for _, x in rows], pa.int64())
        return pa.Table.from_arrays([pa.array(np.full(len(rows), part["part"][0].as_py())), pa.array(np.arange(len(rows))), lang, phrase, words], ["part", "number", "lang", "phrase", "words"])

    return handed.select("part", "lang", "bytes", "phrases").groupBy("part").applyInArrow(distinct, "part bigint, number bigint, lang string, phrase binary, words bigint")


def _tries(phrases: DataFrame) -> DataFrame:
    """A row for each part's trie, built by the tasks: its arrays as bytes."""

    def build(part: pa.Table) -> pa.Table:
        number = part["part"][:1]
        part = part.sort_by("number")
        keys = pc.binary_join_element_wise(part["lang"].cast(pa.binary()), part["phrase"].cast(pa.binary()), AFTER_LANG)
        trie = Trie.of(keys.to_pylist())
        arrays = [pa.array([x.tobytes()], pa.binary()) for x in (trie.base, trie.check, trie.accept)]
        return pa.Table.from_arrays([number, *arrays, pa.array([trie.phrases])], ["part", "base", "check", "accept", "phrases"])

    return phrases.groupBy("part").applyInArrow(build, "part bigint, base binary, check binary, accept binary, phrases bigint")


def _counted(handed: DataFrame, part: int, trie: Trie) -> DataFrame:
    """Occurrences by part and number of a phrase, from what was handed to the part."""
    shared = handed.sparkSession.sparkContext.broadcast(trie)  # about PHRASES phrases

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(own.phrases, np.int64)
        for batch in batches:
            for lang, many, size, packed, counts in zip(*(batch.column(x).to_pylist() for x in ("lang", "many", "bytes", "phrases", "counts")), strict=True):
                text = np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), np.uint8)
                start = np.append(0, np.flatnonzero(text == byte_words.LAST)[:-1] + 1)
                found = own.numbers(text, start, own.state(lang.encode("utf-8", "surrogatepass") + AFTER_LANG))
                total += np.bincount(found, _counts(counts, many), len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part)), pa.array(at), pa.array(total[at])], ["part", "number", "f"])

    counts = handed.where(F.col("part") == part).mapInArrow(run, "part bigint, number bigint, f bigint").groupBy("part", "number").agg(F.sum("f").alias("f"))
    out = stored(counts, "counts")
    shared.destroy()
    return out


def phrase_counts(docs: DataFrame, least: int, longest: int, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Exact counts of all words and phrases of up to `longest` words that occur `least` times or more in a language
    (`lang, phrase, words, f`), and the words of each language (`lang, n`)."""
    spark, texts, tables, through = docs.sparkSession, _texts(docs, lang_col, text_col), [], 0
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = min(-(-size // SHARE) or 1, 1 << (KEY_BITS - 1))
    for n in range(1, longest + 1):
        table, many = _bit_table(texts, n, tables, least, shares)
        tables.append(spark.sparkContext.broadcast(table))  # BITS bits
        through += many
    parts = max(1, -(-through * 9 // (8 * PHRASES)))  # by a hash: a part is an eighth below the bound on average
    handed = _by_part(_candidates(texts, longest, tables, parts))
    for table in tables:
        table.destroy()
    totals = handed.where("part < 0").groupBy("lang").agg(F.sum("many").alias("n"))
    handed = handed.where("part >= 0")
    found = stored(_phrases(handed), "phrases")
    tries, counts = stored(_tries(found), "tries"), None
    for part in range(parts):
        for row in tries.where(F.col("part") == part).toArrow().to_batches():
            arrays = (np.frombuffer(row[x][0].as_buffer(), np.int32) for x in ("base", "check", "accept"))
            counted = _counted(handed, part, Trie(*arrays, row["phrases"][0].as_py()))
            counts = counted if counts is None else counts.unionByName(counted)
    if counts is None:
        counts = found.select("part", "number", F.col("words").alias("f")).where("false")
    frequent = found.join(counts, ["part", "number"]).where(F.col("f") >= least)
    return stored(frequent.select("lang", F.col("phrase").cast("string").alias("phrase"), "words", "f"), "frequent"), totals


def _words_of(first: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.col("ws"), first, size), " ")


def collocations(
    docs: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, overlap: int = 50, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """Each language's best phrases of 2 to `longest` words: `lang, rank, phrase, a, l, r, n, score`.

    `a` counts a phrase, `l` and `r` the two parts of its cut with the lowest score `floor(1000000 * a * a / (l * r))`, of
    equal ones the first; `n` the language's words. A phrase inside a longer one that occurs at least `overlap` percent
    as often is left out. Null texts are empty, null languages `und`; repeated rows count each. Texts of any length are
    counted whole; a table without frequent phrases gives no rows. Other columns are left out, whatever their names.
    """
    counts, totals = phrase_counts(docs, least, longest, lang_col, text_col)
    phrases = counts.where("words > 1").withColumn("ws", F.split("phrase", " "))
    # inside a longer phrase
    spans = F.explode(F.expr(
        "flatten(transform(sequence(2, size(ws) - 1), k -> transform(sequence(1, size(ws) - k + 1), i -> array_join(slice(ws, i, k), ' '))))"
    ))
    longer = phrases.where("words > 2").select("lang", "f", spans.alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    phrases = phrases.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < overlap * F.col("f"), F.lit(True)))
    # the lowest cut; single words, which may be part of many phrases, are spread over copies of their counts
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), "ws", F.explode(F.expr("sequence(1, size(ws) - 1)")).alias("k"))
    salt = lambda alone: F.when(alone, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    cut = cut.select(
        "lang", "phrase", "a", "k", _words_of(F.lit(1), F.col("k")).alias("left"), _words_of(F.col("k") + 1, F.size("ws")).alias("right"),
        salt(F.col("k") == 1).alias("left_salt"), salt(F.col("k") == F.size("ws") - 1).alias("right_salt"),
    )
    part = counts.select("lang", "phrase", "f", F.explode(F.expr(f"sequence(0, if(words = 1, {SALTS - 1}, 0))")).alias("salt"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(part.select("lang", F.col("salt").alias(f"{side}_salt"), F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", f"{side}_salt", side])
    wide = lambda c: f"cast({c} as decimal(13, 0))"
    score = F.expr(f"cast(1000000 as decimal(7, 0)) * ({wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    cut = cut.withColumn("score", score)
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = top_n_per_group(
        best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), ["lang"],
        [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top, ["phrase"],
    )
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
