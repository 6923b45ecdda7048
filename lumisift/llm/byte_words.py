"""Words of whole batches of texts as numpy arrays over their UTF-8 bytes, without a Python step for each word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time. A longer text is cut where no word and no piece is cut.
CHUNK = 400_000
WORD, SPACE, BREAK = 0, 1, 2
#: The separators of normalised text: between two words of a piece, and behind the last word of a piece.
INSIDE, LAST = 0x20, 0x0A
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = bytes(range(256)).lower()  # of bytes: A to Z only


def kinds(spaces: bytes, breaks: bytes) -> np.ndarray:
    """The kind of every byte: one of a word, a space between words, or the end of a piece."""
    out = np.full(256, WORD, np.uint8)
    out[list(spaces)] = SPACE
    out[list(breaks)] = BREAK
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings, and where each value begins and the last one ends; nulls are empty."""
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of a chunk of texts, lower-cased (A to Z only), in normalised text `text`, where every word is followed by
    `INSIDE` or, at the end of its piece, by `LAST`."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def linked(self, n: int) -> np.ndarray:
        """The words with which a run of `n` words of one piece begins, as indexes."""
        inside = self.text[self.end] == INSIDE
        at = np.flatnonzero(inside[: max(0, len(inside) - n + 1)]) if n > 1 else np.arange(len(self.end))
        for k in range(1, n - 1):
            at = at[inside[at + k]]
        return at


def _cuts(raw: np.ndarray, at: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks as the places of their texts' beginnings (with the chunk's end) and those texts' rows."""
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1
        if last > first:
            yield at[first : last + 1], np.arange(first, last)
            first = last
            continue
        start, stop = int(at[first]), int(at[first + 1])
        sought = BREAK if (kind == BREAK).any() else SPACE
        while start < stop:
            cut, reach = stop, start + CHUNK
            while reach < stop:
                ends = np.flatnonzero(kind[raw[start:reach]] == sought)
                if len(ends):
                    cut = start + int(ends[-1]) + 1
                    break
                reach += CHUNK
            yield np.array([start, cut]), np.array([first])
            start = cut
        first += 1


def words(column: pa.Array, kind: np.ndarray) -> Iterator[Words]:
    """The words of all texts of a column, chunk by chunk."""
    raw, at = flat(column)
    whole, table = memoryview(np.ascontiguousarray(raw)), kind.tobytes()
    for bounds, rows in _cuts(raw, at, kind):
        edges = bounds.tolist()
        joined = b"\n".join([*(whole[a:b] for a, b in zip(edges, edges[1:], strict=False)), b""])  # one more byte behind each text
        lower = joined.translate(_LOWER)
        part, of = np.frombuffer(lower, np.uint8), np.frombuffer(bytearray(lower.translate(table)), np.uint8)
        behind = bounds[1:] - bounds[0] + np.arange(len(rows))  # where those bytes lie
        of[behind] = np.maximum(of[behind], SPACE)
        held = of == WORD
        keep = held.copy()
        keep[1:] |= held[:-1]  # words, and the first byte behind each of them
        first = np.flatnonzero(keep & ~held)
        if not len(first):
            continue
        at_all = np.flatnonzero(keep)
        text = part.take(at_all)
        end = np.flatnonzero(of.take(at_all) != WORD)
        row = rows[np.searchsorted(behind, first)]
        # does the piece end before the next word? Most gaps have one byte or two
        apart, open_gap = of.take(first) == BREAK, np.flatnonzero(of.take(first + 1, mode="clip") != WORD)
        if len(open_gap) * 3 < len(first):
            gap, k = first[open_gap], 1
            while len(open_gap) and k < 8:
                kinds_there = of.take(gap + k, mode="clip")
                apart[open_gap[kinds_there == BREAK]] = True
                on = (kinds_there != WORD) & (gap + k < len(of))
                open_gap, gap, k = open_gap[on], gap[on], k + 1
        if len(open_gap):  # the greatest kind up to the end of the next word
            apart |= np.maximum.reduceat(of, first) == BREAK
        apart[:-1] |= row[1:] != row[:-1]
        apart[-1] = True
        text[end] = np.where(apart, LAST, INSIDE)
        yield Words(text, np.append(0, end[:-1] + 1), end, row)


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = keys ^ (keys >> np.uint64(31))
    keys = keys * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(29))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """The first `n` powers of the base and of its inverse, remembered up to the size of a chunk."""
    if len(_powers[0]) >= n:
        return _powers
    n = max(n, CHUNK * 5 // 4)
    made = [np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64))) for x in (_BASE, _INVERSE)]
    if n <= CHUNK * 2:
        _powers[:] = made
    return made


class Keys:
    """64-bit keys of spans of a text, from one running sum: a polynomial in an odd base modulo 2^64 over random values
    of the bytes. Equal strings have equal keys; the reverse is not certain, so whoever counts checks or counts again."""

    def __init__(self, seed: int = 5):
        self.value = np.random.default_rng(seed).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def running(self, text: np.ndarray) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.uint64)
        raw = self.value[text]
        raw *= _power(len(text) + 1)[0][: len(text)]
        np.cumsum(raw, out=out[1:])
        return out

    def spans(self, running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (running[end] - running[start]) * _power(len(running))[1][start]
        return mixed(raw + (end - start).astype(np.uint64))

    def of(self, strings: list[bytes]) -> np.ndarray:
        """Keys of strings by themselves."""
        out = np.zeros(len(strings), np.uint64)
        for i, s in enumerate(strings):
            running = self.running(np.frombuffer(s, np.uint8))
            out[i] = self.spans(running, np.array([0]), np.array([len(s)]))[0]
        return out
