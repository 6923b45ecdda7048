"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding of a prefix ends in exactly one token, and what stands before that token is the encoding of a
shorter prefix. So one pass over a piece finds, for each of its prefixes, the last token and the count: the token `t`
that ends there is right if the merges would never join anything across the border between `t` and the last token of
the prefix before it. In a text's table of prefixes a budget question is then a lookup.

Texts are split into pieces first and merges never cross them, so a document's table is the running sum over its
pieces. Only the last entry of a piece's table, its count, is kept per worker, which is all that totals need. No table
of prefixes is stored: `truncated` builds one for each text, and counts again at every prefix of white space after white
space and of a piece that begins with an apostrophe, since these are split otherwise when cut.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, pre_tokenizers

from lumisift.llm.byte_pieces import all_chars, byte_chars, chunks, groups, small, splitter
from lumisift.llm.workers import hold

#: Pieces a worker remembers before it starts afresh; bounds its memory (about 150 bytes each), never the result.
REMEMBERED = 300_000


@functools.cache
def pieces():
    """The splitter with the library's own idea of letters and numbers."""
    of = lambda prop: "".join(
        run for run, _ in pre_tokenizers.Split(Regex(rf"\p{{{prop}}}+"), "removed", invert=True).pre_tokenize_str(all_chars())
    )
    return splitter(of("L"), of("N"))


class PrefixCounter:
    """Counts tokens of a byte-level vocabulary in the format of the `tokenizers` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {c: b for b, c in enumerate(byte_chars())}
        raw = lambda s: bytes(back[c] for c in s)
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = {raw(k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.special = sorted(special, key=len, reverse=True)
        # a token's rank: bytes first, then in the order of the merges that make them
        self.token = {b: i for i, b in enumerate(k for k in vocab if len(k) == 1)}
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(len(self.token))]
        self.joined: dict[tuple[int, int], int] = {}
        for pair in spec["model"]["merges"]:
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            pair = self.token[left], self.token[right]
            if left + right not in self.token:
                self.token[left + right] = len(self.halves)
                self.halves.append(pair)
            self.joined.setdefault(pair, self.token[left + right])
        self.longest = max(map(len, self.token))
        self.pieces = pieces()
        self.whole: dict[str, int] = {}
        self.parted: dict[str, int] = {}
        self.borders: dict[tuple[int, int], bool] = {}

    def _border(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between two neighbouring tokens alone."""
        key = left, right
        limit = len(self.halves) + 1
        while True:
            if self.joined.get((left, right), limit) < limit:
                good = False
                break
            # undo the later of the two merges; one made on the right side at an equal rank comes after
            if left > right:
                limit, inner = left, self.halves[left][1]
                if inner != left:
                    left = inner
                    continue
                limit, inner = right + 1, self.halves[right][0]
                if inner == right:
                    good = True
                    break
                right = inner
            else:
                limit, inner = right + 1, self.halves[right][0]
                if inner != right:
                    right = inner
                    continue
                limit, inner = left, self.halves[left][1]
                if inner == left:
                    good = True
                    break
                left = inner
        if len(self.borders) > 2_000_000:
            self.borders.clear()
        self.borders[key] = good
        return good

    def table(self, piece: bytes, known: tuple[list[int], list[int]] | None = None) -> list[int]:
        """Tokens in each prefix of a piece, by length in bytes; the first entry is the empty prefix. `known` has the
        entries and last tokens of some prefixes and is completed."""
        counts, last = known or ([0], [-1])
        token, borders, longest = self.token, self.borders, self.longest
        for end in range(len(counts), len(piece) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                t = token.get(piece[start:end])
                if t is None:
                    continue
                if start:
                    before = last[start]
                    good = borders.get((before, t))
                    if good is None:
                        good = self._border(before, t)
                    if not good:
                        continue
                counts.append(counts[start] + 1)
                last.append(t)
                break
        return counts

    def learn(self, new: set[str]) -> None:
        """Remember the counts of pieces; neighbours in sorted order share the tables of their common prefixes."""
        whole = self.whole
        counts, last, before = [0], [-1], b""
        for text in sorted(new):
            piece, same = text.encode(), 0
            for a, b in zip(piece, before, strict=False):
                if a != b:
                    break
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            whole[text] = self.table(piece, (counts, last))[-1]
            before = piece

    def forget(self) -> None:
        for kept in (self.whole, self.parted):
            if len(kept) > REMEMBERED:
                kept.clear()

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """Pieces and special strings of a text with their token counts, in order."""
        if not any(s in text for s in self.special):
            todo: list[tuple[str, bool]] = [(text, False)]
        else:
            todo = []
            rest = text
            while rest:
                at = min(((i, -len(s), s) for s in self.special if (i := rest.find(s)) >= 0), default=None)
                if at is None:
                    todo.append((rest, False))
                    break
                todo += [(rest[: at[0]], False), (at[2], True)]
                rest = rest[at[0] + len(at[2]) :]
        for part, special in todo:
            if special:
                yield part, 1
            else:
                found = self.pieces(part)
                self.learn({p for p in found if p not in self.whole})
                yield from ((p, self.whole[p]) for p in found)

    def count(self, text: str) -> int:
        self.forget()
        return sum(n for _, n in self.parts(text))

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out = []
        for group in groups(texts):
            cut = [None if any(s in text for s in self.special) else chunks(text) for text in group]
            parts = self.parted
            self.forget()
            new = set().union(*(c[1:] for c in cut if c)).difference(parts)
            split = {c: self.pieces(" " + c) for c in new}
            split |= {(c[0],): self.pieces(c[0]) for c in cut if c}
            self.learn(set().union(*split.values()).difference(self.whole))
            whole = self.whole
            first = {}
            for c, found in split.items():
                (first if isinstance(c, tuple) else parts)[c] = sum(map(whole.__getitem__, found))
            for text, c in zip(group, cut, strict=True):
                out.append(sum(n for _, n in self.parts(text)) if c is None else first[(c[0],)] + sum(map(parts.__getitem__, c[1:])))
        return out

    def prefixes(self, text: str) -> list[int]:
        """Tokens of `text[:i]` for every i from 0 to the text's length."""
        out, before, tail = [0], 0, ""
        for piece, n in self.parts(text):
            # until a special string is complete it is ordinary text after what stands before it, and a cut behind
            # white space joins it to the run before
            if piece in self.special:
                out += [before + self.count(tail + piece[:i]) for i in range(1, len(piece))]
                before, tail = before + (self.count(tail) if tail else 0) + n, ""
                out.append(before)
                continue
            if tail:
                if not (tail.isspace() and piece[0].isspace()):
                    before, tail = before + self.count(tail), ""
            if tail:
                out += [before + self.count(tail + piece[:i]) for i in range(1, len(piece) + 1)]
                before, tail = before + self.count(tail), piece
            elif piece[0] == "'":  # the beginning of a contraction is split otherwise
                out += [before + self.count(piece[:i]) for i in range(1, len(piece) + 1)]
                tail = piece
            else:
                table = self.table(piece.encode())
                width = itertools.accumulate(len(c.encode()) for c in piece)
                out += [before + table[w] for w in width]
                tail = piece
        return out


@functools.cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def fits(prefixes: list[int], budget: int) -> int:
    """Length of the longest prefix with at most `budget` tokens, from a table of `PrefixCounter.prefixes`."""
    return next(i for i in range(len(prefixes) - 1, -1, -1) if prefixes[i] <= budget)


def token_counts(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether they are over a limit.

    Nulls count as empty texts: no bytes, no tokens. Rows are kept as they come, repeated ids included, and other
    columns are left out, whatever their names. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("token_counts", counter.cache_clear)
        count = counter(path).count_all
        for batch in small(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            tokens, sizes = count(texts), [len(text.encode()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


def truncated(df: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The longest prefix of every text within a token budget, answered from the table of its prefixes (`id, text,
    n_tokens`). Nulls count as empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("token_counts", counter.cache_clear)
        own = counter(path)
        for batch in batches:
            cut, tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                table = own.prefixes(text)
                n = fits(table, budget)
                cut.append(text[:n])
                tokens.append(table[n])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.string()), pa.array(tokens, pa.int64())], ["id", "text", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, text string, n_tokens bigint").withColumnRenamed("id", id_col)
