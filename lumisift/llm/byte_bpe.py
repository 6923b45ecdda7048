"""Byte-level byte-pair encoding and decoding through a sentencepiece model written from the vocabulary.

A rank file lists byte strings by the rank of the merge that makes them. Written as a model of the `bpe` type with each
byte mapped to a printable character, the pieces in rank order with minus the rank as score, and identity
normalisation, sentencepiece performs the same merges: it joins the neighbouring pair whose union is the best-scored
piece, leftmost first. Texts are split into pre-tokens before, since merges must not cross them, and ids are mapped
back to bytes by the inverse of the piece table.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame

from lumisift.llm.byte_pieces import all_chars, byte_chars, chunks, groups, small, splitter
from lumisift.llm.workers import hold

#: Parts a worker remembers before it starts afresh; bounds its memory (about 200 bytes each), never the result.
REMEMBERED = 200_000


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file in rank order; ranks must be 0, 1, 2 and so on."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be consecutive from 0")
    return [ranks[i] for i in range(len(ranks))]


def _field(number: int, wire: int, payload: bytes) -> bytes:
    """A protocol-buffer field; wire type 2 is length-delimited, 0 a varint, 5 four bytes."""
    return _varint(number << 3 | wire) + (_varint(len(payload)) if wire == 2 else b"") + payload


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece model of these tokens: ids are ranks, the unknown piece comes last."""
    chars = byte_chars()
    piece = lambda text, score, kind: _field(
        1, 2, _field(1, 2, text.encode()) + _field(2, 5, struct.pack("<f", score)) + _field(3, 0, _varint(kind))
    )
    normal, unknown = 1, 2
    pieces = [piece("".join(chars[b] for b in token), -rank, normal) for rank, token in enumerate(tokens)]
    trainer = _field(3, 0, _varint(2)) + _field(40, 0, _varint(len(tokens)))  # model_type BPE, unk_id
    trainer += b"".join(_field(n, 0, _varint(-1 & (1 << 64) - 1)) for n in (41, 42, 43))  # no begin, end or padding piece
    normaliser = _field(1, 2, b"identity") + b"".join(_field(n, 0, _varint(0)) for n in (3, 4, 5))
    return b"".join(pieces) + piece("<unk>", 0.0, unknown) + _field(2, 2, trainer) + _field(3, 2, normaliser)


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str):
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(self.tokens))
        self.ids = {token: i for i, token in enumerate(self.tokens)}
        self.mapped = str.maketrans({chr(b): c for b, c in enumerate(byte_chars())})
        bytes_only = {bytes([b]): b for b in range(256)}
        every = all_chars()

        def of(prop: str) -> str:  # what the library takes for letters and numbers: it skips all else
            probe = tiktoken.Encoding("probe", pat_str=rf"\p{{{prop}}}+", mergeable_ranks=bytes_only, special_tokens={})
            return probe.decode_bytes(probe.encode_ordinary(every)).decode()

        self.pieces = splitter(of("L"), of("N"))
        self.packed: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens. One that is itself a token is that token, as rank encoders have it."""
        raw = [piece.encode() for piece in new]
        rest = [b.decode("latin-1").translate(self.mapped) for b in raw if b not in self.ids]
        split = iter(self.model.encode(rest, num_threads=1) if rest else [])
        return {
            piece: struct.pack("<I", self.ids[b]) if b in self.ids else _pack(next(split)) for piece, b in zip(new, raw, strict=True)
        }

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for group in groups(texts):
            known = self.packed
            if len(known) > REMEMBERED:
                known.clear()
            cut = [chunks(text) for text in group]
            new = set().union(*(c[1:] for c in cut if c)).difference(known)
            split = {c: self.pieces(" " + c) for c in new}
            split |= {(c[0],): self.pieces(c[0]) for c in cut if c}
            split |= {(i, text): self.pieces(text) for i, (text, c) in enumerate(zip(group, cut, strict=True)) if c is None}
            ids = self._learn(sorted(set().union(*split.values())))
            first = {}
            for c, found in split.items():
                (first if isinstance(c, tuple) else known)[c] = b"".join(map(ids.__getitem__, found))
            for i, (text, c) in enumerate(zip(group, cut, strict=True)):
                yield first[i, text] if c is None else first[c[0],] + b"".join(map(known.__getitem__, c[1:]))

    def encode(self, text: str) -> list[int]:
        return list(memoryview(next(self.encode_all([text]))).cast("I")) if text else []

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; an id outside the vocabulary raises."""
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I")))


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.cache
def coder(path: str) -> ByteBpe:
    return ByteBpe(path)


def _mapped(df: DataFrame, id_col: str, text_col: str, path: str, schema: str, columns) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("byte_bpe", coder.cache_clear)
        own = coder(path)
        for batch in small(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            rows = [columns(own, packed) for packed in own.encode_all(texts)]
            made = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names)

    kinds = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    names = ["id", *(c.split()[0] for c in schema.split(", "))]
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def encoded(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text, packed as little-endian unsigned 32-bit integers in `ids`, and their number `n_tokens`.

    Nulls count as empty texts: no ids. Repeated rows stay, other columns are left out whatever their names, and an
    empty table gives no rows.
    """
    return _mapped(df, id_col, text_col, path, "n_tokens bigint, ids binary", lambda own, ids: (len(ids) // 4, ids))


def decoded(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of packed ids, the inverse of `encoded`; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("byte_bpe", coder.cache_clear)
        own = coder(path)
        for batch in batches:
            texts = [None if ids is None else own.decode(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of tokens and digests of the packed ids and of the bytes they decode to. Nulls count as empty texts."""

    def columns(own: ByteBpe, ids: bytes) -> tuple[int, str, str]:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

    return _mapped(df, id_col, text_col, path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", columns)


def coded(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed ids with their number, and the digest of the bytes they decode to. Nulls count as empty texts."""

    def columns(own: ByteBpe, ids: bytes) -> tuple[int, bytes, str]:
        return len(ids) // 4, ids, hashlib.sha256(own.decode(ids)).hexdigest()

    return _mapped(df, id_col, text_col, path, "n_tokens bigint, ids binary, decoded_sha256 string", columns)
