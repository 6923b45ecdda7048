"""Splitting text for byte-level vocabularies, shared by the token counter and the byte-pair encoder.

Engines that know Unicode classes are slow at splitting; the standard one is several times faster once the classes are
spelt out as ranges. Which characters are letters and numbers depends on the Unicode version of the library to agree
with, so each caller asks its library. Texts with characters outside the basic plane take the same pattern with the
ranges of those planes added.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa

#: White space as the Unicode property has it (the standard engine also counts four separators).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def all_chars() -> str:
    """Every character of the planes that hold letters or numbers in any version of Unicode."""
    return "".join(map(chr, (c for c in range(0x40000) if not 0xD800 <= c <= 0xDFFF)))


def _ranges(chars: str) -> str:
    """Sorted characters as the inside of a character class."""
    out, first, last = [], None, -2
    for code in [*map(ord, chars), -2]:
        if code != last + 1:
            if first is not None:
                out.append(f"\\U{first:08x}-\\U{last:08x}")
            first = code
        last = code
    return "".join(out)


def splitter(letters: str, numbers: str) -> Callable[[str], list[str]]:
    """A function giving the matches of the tokenizers' splitting pattern, in order; together they are the text."""

    def build(last: str) -> re.Pattern:
        letter, number = (_ranges("".join(c for c in x if c <= last)) for x in (letters, numbers))
        return re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        )

    basic, full, beyond = build("\uffff"), build("\U0010ffff"), re.compile("[\\U00010000-\\U0010ffff]")
    return lambda text: (full if beyond.search(text) else basic).findall(text)


#: White space behind a space: only there can a piece hold a space that is not its first character.
_JOINED = re.compile(f" (?=[{SPACE}]|$)")


def chunks(text: str) -> list[str] | None:
    """Parts of a text between single spaces, or None if it has other runs with spaces.

    A space before a word always begins a piece, so every part but the first can be split on its own once its space is
    put back, and frequent parts need to be split only once.
    """
    return None if _JOINED.search(text) else text.split(" ")


def groups(texts: list[str], chars: int = 2_000_000):
    """Consecutive texts in groups of about `chars` characters (a longer text is a group by itself), so that what is
    held for a group stays small however many texts a batch has."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that what is made of a batch stays small next to the batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@functools.cache
def byte_chars() -> list[str]:
    """The printable stand-in of every byte: itself if it is printable, else the next free character from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]
