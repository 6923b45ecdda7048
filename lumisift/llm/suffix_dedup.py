"""Exact substring de-duplication by merging Burrows-Wheeler transforms of shards.

A byte is removed if it lies in a string of `WINDOW` bytes that also starts in a document with a smaller id. Windows
that can be equal are brought together by content: every window has a key, the least hash of the grams in it, so equal
windows have equal keys, and neighbouring windows mostly share one. Windows of a text that follow each other and have one
key are a segment. The job has three passes:

1. Segments meet by key, as hashes. A key that texts of one content have is dropped; identical texts count as one. Of equal
   segments the first document's stays and the others are removed, whatever else holds them.
2. What stays is cut out of the texts if its key has other segments too: windows that are in one segment only have no equal
   ones. Each task sorts the suffixes of its segments, bucket by bucket, and sends the Burrows-Wheeler transform of each
   bucket's segments, a shard.
3. A bucket merges its shards by refining their interleaving: rows ordered by their first h bytes, taken stably by the `STEP`
   bytes before each, are ordered by h + `STEP` bytes, and a boundary appears where the bytes change or the rows came from
   different groups. The round in which a boundary appears bounds a common prefix; rows without a boundary after
   `WINDOW` bytes are repeated intervals. Only rows with `WINDOW` bytes before them in their segment begin, and groups
   of one row are dropped on the way, so rounds get shorter. No suffix is sorted again.

Bytes of a bucket are bounded by the number of buckets, which follows the size of the input; a frequent
passage sends its hashes there once for each document, its bytes once for each different segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisift.llm.stored import stored
from lumisift.llm.workers import hold

#: Bytes of a repeated string and of the grams whose hashes make keys.
WINDOW, GRAM = 50, 24
#: Windows of a segment at most, bytes of text handled at a time, and bytes of text for each bucket.
RUN, PART, BUCKET_BYTES = 64, 3_000_000, 6_000_000
#: Bytes that a round of the merge looks at.
STEP = 5


def window_keys(data: np.ndarray) -> np.ndarray:
    """The key of each window of a byte array that is at least `WINDOW` long."""
    word = lambda at: np.ndarray(len(data) - GRAM + 1, np.uint64, data, at, (1,)) * np.uint64(0x9E3779B97F4A7C15 + 2 * at)
    h = word(0)
    for at in range(8, GRAM, 8):
        h ^= h >> np.uint64(29)
        h += word(at)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(30)
    width, have = WINDOW - GRAM + 1, 1
    while have < width:
        by = min(have, width - have)
        h = np.minimum(h[: len(h) - by], h[by:])
        have += by
    # multiplied, since least hashes are small; six bytes are enough to tell keys of a bucket apart; what they confuse is compared later
    return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of windows with one key, and the key of each; the last start is the number of windows."""
    if len(data) < WINDOW:
        return np.zeros(1, np.int64), np.zeros(0, np.uint64)
    key = window_keys(data)
    at = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    if (np.diff(at) > RUN).any():  # long runs are cut, wherever: every part has the same key
        at = np.unique(np.concatenate([at, *(np.arange(a, b, RUN) for a, b in zip(at[:-1], at[1:], strict=True) if b - a > RUN)]))
    return at, key[at[:-1]]


def named_runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a text, and the name of each one's segment: six bytes of the digest of all that its windows cover."""
    at, key = runs(np.frombuffer(text, np.uint8))
    ends = (at[1:] + (WINDOW - 1)).tolist()
    name = np.fromiter((xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(at[:-1].tolist(), ends, strict=True)), np.uint64, len(key))
    return at, key, name >> np.uint64(16)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys."""
    return ((key >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def tags(key: np.ndarray, name: np.ndarray) -> np.ndarray:
    """What a segment is known by among those of a document; the last bit is free."""
    return (key << np.uint64(16) ^ name) & ~np.uint64(1)


def places(number: np.ndarray) -> np.ndarray:
    """The stable order of unsigned numbers: they are sorted as one word with their places, which is fast, if both fit."""
    if not len(number):
        return np.zeros(0, np.int64)
    number, bits = number - number.min(), len(number).bit_length()
    if int(number.max()).bit_length() + bits > 64:
        return np.argsort(number, kind="stable")
    word = number << np.uint64(bits) | np.arange(len(number), dtype=np.uint64)
    word.sort()
    return (word & np.uint64((1 << bits) - 1)).astype(np.int64)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column:
        yield (text.as_py() or "").encode()


def _planes(number: np.ndarray) -> bytes:
    """Numbers of six bytes, bytes of equal significance together: the leading ones of sorted numbers compress well."""
    return np.ascontiguousarray(number.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _numbers(planes: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(planes, np.uint8).reshape(6, -1).T
    return out.view(np.uint64).ravel()


def repeated_segments(docs: DataFrame, buckets: int) -> DataFrame:
    """The segments of each document whose key is in a text of other content (`id, segment`): their tags, with 0 as the last bit
    if a document with a smaller id has an equal one, else 1. The latter are left out if no other segment has their key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("suffix_dedup", int)

        def flush() -> pa.RecordBatch:
            key, name, doc = np.concatenate(keys), np.concatenate(names), np.repeat(np.arange(len(ids), dtype=np.int32), [len(k) for k in keys])
            order = places(key >> np.uint64(8))
            key, name, doc = key[order], name[order], doc[order]
            bucket = bucket_of(key, buckets)
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(key) else []
            rows = []
            for a, b in zip(at, [*at[1:], len(key)], strict=True):
                held = np.zeros(len(ids), bool)
                held[doc[a:b]] = True
                used, local = np.flatnonzero(held), (np.cumsum(held) - 1)[doc[a:b]]
                rows.append((int(bucket[a]), _planes(key[a:b]), _planes(name[a:b]), local.astype(np.uint16).tobytes(), [ids[i] for i in used], [content[i] for i in used]))
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(made, ["bucket", "keys", "names", "docs", "ids", "content"])

        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        keys, names, ids, content, size = [], [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
                _, key, name = named_runs(text)
                other = np.ones(len(key), bool)
                other[1:] = (name[1:] != name[:-1]) | (key[1:] != key[:-1])  # parts of a long run may be equal
                keys.append(key[other])
                names.append(name[other])
                ids.append(doc)
                content.append(xxhash.xxh3_64_intdigest(text) - (1 << 63))
                size += len(text)
                if size > 4 * PART or len(ids) == 1 << 16:
                    yield flush()
                    keys, names, ids, content, size = [], [], [], [], 0
        if ids:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        keys, names, contents, owners = [], [], [], []
        for _, key, name, doc, ids, content in zip(*table.columns, strict=True):
            local = np.frombuffer(doc.as_py(), np.uint16)
            keys.append(_numbers(key.as_py(), len(local)))
            names.append(_numbers(name.as_py(), len(local)))
            contents.append(content.values.to_numpy()[local])
            owners.append(ids.values.to_numpy()[local])
        key, name, content, owner = map(np.concatenate, (keys, names, contents, owners))
        order = places(key)
        key, content = key[order], content[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.minimum.reduceat(content, at) != np.maximum.reduceat(content, at)
        keep = np.repeat(many, np.diff(at, append=len(key)))
        key, name, owner = key[keep], name[order[keep]], owner[order[keep]]
        order = np.lexsort((owner, name, key))
        key, name, owner = key[order], name[order], owner[order]
        new = np.ones((2, len(key)), bool)  # a key's first row, and an equal segment's, which has the least document
        new[0, 1:] = key[1:] != key[:-1]
        new[1, 1:] = new[0, 1:] | (name[1:] != name[:-1])
        group = np.cumsum(new, axis=1) - 1
        first = owner == owner[new[1]][group[1]]
        alone = np.bincount(group[0][new[1]])[group[0]] == 1 if len(key) else first
        keep = ~(first & alone)
        segment = (tags(key, name) | first.astype(np.uint64))[keep].view(np.int64)
        return pa.table({"id": pa.array(owner[keep], pa.int64()), "segment": pa.array(segment, pa.int64())})

    parts = docs.mapInArrow(cut, "bucket bigint, keys binary, names binary, docs binary, ids array<bigint>, content array<bigint>")
    return parts.groupBy("bucket").applyInArrow(meet, "id bigint, segment bigint")


class Shards:
    """Segments gathered in a task, ready to be sent as Burrows-Wheeler transforms by bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.first: dict[bytes, list] = {}  # segment -> [document, starts, key]
        self.size = 0

    def add(self, doc: int, text: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, covered: dict[int, list]) -> None:
        """Take a document's segments. What an earlier document's equal segment settles goes to `covered`."""
        for a, b, key in zip(starts.tolist(), ends.tolist(), keys.tolist(), strict=True):
            segment = text[a : b + WINDOW - 1]
            had = self.first.get(segment)
            if had is None:
                self.first[segment] = [doc, [a], key]
                self.size += len(segment)
            elif had[0] == doc:
                had[1].append(a)
            elif had[0] < doc:
                covered.setdefault(doc, []).append((a, b + WINDOW - 1))
            else:
                covered.setdefault(had[0], []).extend((x, x + len(segment)) for x in had[1])
                had[0], had[1] = doc, [a]

    def rows(self) -> Iterator[dict]:
        """One shard for each bucket: the transform over all suffixes of its segments, a segment's last row standing for
        its end, and what belongs to each segment."""
        if not self.first:
            return
        bucket = bucket_of(np.array([v[2] for v in self.first.values()], np.uint64), self.buckets)
        by = np.argsort(bucket, kind="stable")
        bucket, segments, values = bucket[by], list(self.first), list(self.first.values())
        segments, values = [segments[i] for i in by], [values[i] for i in by]
        length = np.array([len(s) for s in segments])
        text = np.frombuffer(b"".join(segments), np.uint8)
        end = np.cumsum(length)
        left = (np.repeat(end, length) - np.arange(len(text))).astype(np.int32)  # bytes from a suffix's start to its segment's end
        new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        order = suffix_order(text, left, np.repeat(np.cumsum(new) - 1, length))
        at = np.flatnonzero(new)
        # rows of the ends come first, in segment order; the byte before a suffix, 0 with a flag at a segment's start
        start = np.zeros(len(text), bool)
        start[end - length] = True
        start, before = start[order], text[order - 1]
        before[start] = 0
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(segments)], strict=True):
            x, y = end[a] - length[a], end[b - 1]
            yield {
                "bucket": int(bucket[a]), "bwt": zstandard.compress(text[end[a:b] - 1].tobytes() + before[x:y].tobytes(), 3),
                "heads": (np.flatnonzero(start[x:y]) + (b - a)).astype(np.int32).tobytes(),
                "digests": b"".join(map(xxhash.xxh3_64_digest, segments[a:b])), "docs": [v[0] for v in values[a:b]], "starts": [v[1] for v in values[a:b]],
            }


def suffix_order(text: np.ndarray, left: np.ndarray, part: np.ndarray | None = None) -> np.ndarray:
    """Positions sorted by part, if given, and their suffixes, which are `left` bytes long, one less at each position up to a
    string's end; a suffix that ends is before its continuations, and equal suffixes stay in order of position. A few bytes
    come first; those that share them go by the rank of what follows, which doubles the bytes each time."""
    n = len(text)
    codes = np.zeros(256, np.uint64)
    codes[np.bincount(text, minlength=256) > 0] = 1
    codes = np.cumsum(codes, dtype=np.uint64) * codes  # 0 is what is behind an end
    bits = int(codes.max()).bit_length()
    top = 0 if part is None else int(part.max(initial=0)).bit_length()
    depth, key, code = 1, codes[text], codes[text]
    while depth < 8 and top + bits * (depth + 1) + n.bit_length() <= 64:
        key <<= np.uint64(bits)
        key[:-depth] |= np.where(left[:-depth] > depth, code[depth:], np.uint64(0))
        depth += 1
    if part is not None:
        key |= part.astype(np.uint64) << np.uint64(bits * depth)
    order = places(key)
    key = key[order]
    slots, rank = np.arange(n), np.empty(n, np.int32)  # slots are places in the order that are not settled
    at = order
    while len(slots):
        new = np.ones(len(slots) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        group = np.cumsum(new[:-1])
        rank[at] = slots[np.flatnonzero(new[:-1])][group - 1]
        tied = ~(new[:-1] & new[1:])
        tied &= left[at] >= depth  # those that ended before are equal
        slots, at, group = slots[tied], at[tied], group[tied]
        rest = left[at] > depth
        key = np.zeros(len(at), np.uint64)
        key[rest] = rank[at[rest] + depth] + 1
        key |= group.astype(np.uint64) << np.uint64(n.bit_length())
        by = places(key)
        key, at = key[by], at[by]
        order[slots] = at
        depth *= 2
    return order


class Merge:
    """Shards of a bucket as one set of rows: the byte before each row, and the row of the suffix one byte longer."""

    def __init__(self, shards: list[dict]):
        before, longer, head, base = [], [], [], 0
        self.docs, self.starts = [], []
        digests = []
        for shard in shards:
            bwt = np.frombuffer(zstandard.decompress(shard["bwt"]), np.uint8).astype(np.int16) + 1
            heads = np.frombuffer(shard["heads"], np.int32)
            bwt[heads] = 0  # nothing before a segment's start
            n = len(shard["docs"])
            # the k-th row with a byte before it leads to the k-th row that starts with the byte; ends are the first rows
            lf = np.full(len(bwt), -1, np.int32)
            inner = np.flatnonzero(bwt)
            lf[inner[np.argsort(bwt[inner], kind="stable")]] = np.arange(n, len(bwt))
            before.append(bwt)
            longer.append(np.where(lf >= 0, lf + np.int32(base), np.int32(-1)))
            head.append(np.arange(n) + base)
            base += len(bwt)
            digests += [shard["digests"][8 * i : 8 * i + 8] for i in range(n)]
            self.docs += shard["docs"]
            self.starts += shard["starts"]
        self.before, self.longer = np.concatenate(before), np.concatenate(longer)
        self.ends = np.concatenate(head)
        first: dict[bytes, int] = {}
        self.same = np.array([first.setdefault(d, i) for i, d in enumerate(digests)])  # equal segments of several shards

    def walk(self) -> tuple[np.ndarray, np.ndarray]:
        """The segment of each row and the bytes from the row's suffix to the segment's end."""
        segment = np.full(len(self.before), -1, np.int32)
        left = np.zeros(len(self.before), np.int32)
        row, own, k = self.ends, np.arange(len(self.ends)), 0
        while len(row):
            segment[row], left[row] = own, k
            row, k = self.longer[row], k + 1
            own, row = own[row >= 0], row[row >= 0]
        return segment, left

    def begun(self) -> np.ndarray:
        """Rows that the refinement begins with: of one of each set of equal segments, those with `WINDOW` bytes before them,
        one for each window. The others would come to their segment's start before the last round."""
        self.segment, self.left = self.walk()
        self.length = np.zeros(len(self.docs), np.int64)
        start = self.before == 0
        self.length[self.segment[start]] = self.left[start]
        lone = self.same[self.segment] == self.segment
        return np.flatnonzero(lone & (self.length[self.segment] - self.left >= WINDOW)).astype(np.int32)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row the `STEP` bytes before it as a number, and the row of the suffix that is longer by them. Rows with
        fewer bytes before them get some number; the refinement does not come to them."""
        codes = np.zeros(257, np.uint64)
        codes[np.bincount(self.before, minlength=257) > 0] = 1
        codes = np.cumsum(codes, dtype=np.uint64) - 1
        byte = codes[self.before]
        word, longer = byte, self.longer
        for n in range(1, STEP):
            word = word | byte[longer] << np.uint64(n * int(codes[-1]).bit_length())
            longer = self.longer[longer]
        return word, longer

    def intervals(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of suffixes that share their first `WINDOW` bytes with another row, and the interval of each."""
        rows = self.begun()
        word, longer = self.words()
        group = np.zeros(len(rows), np.int32)
        for _ in range(0, WINDOW, STEP):
            byte = word[rows]
            order = places(byte)
            byte, came, rows = byte[order], group[order], longer[rows[order]]
            new = np.ones(len(rows) + 1, bool)  # a boundary before each row, and one at the end
            new[1:-1] = (byte[1:] != byte[:-1]) | (came[1:] != came[:-1])
            shared = ~(new[:-1] & new[1:])
            rows, group = rows[shared], (np.cumsum(new[:-1], dtype=np.int32) - 1)[shared]
        return rows, group

    def covered(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Document, starts and ends of the windows that also start in a document with a smaller id."""
        docs = np.array(self.docs, np.int64)
        least = docs.copy()
        np.minimum.at(least, self.same, docs)
        rows, group = self.intervals()
        length = self.length
        # the least document of each window of a segment: its own class's, or that of its interval
        offset = length[self.segment[rows]] - self.left[rows]
        own = self.segment[rows]
        if len(rows):
            best = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(best, group, least[own])
            order = np.lexsort((offset, own))
            own, offset, best = own[order], offset[order], best[group[order]]
        else:
            best = np.zeros(0, np.int64)
        at = np.searchsorted(own, np.arange(len(docs) + 1))
        some = np.bincount(own[best < least[own]], minlength=len(docs)) > 0
        earlier = least[self.same] < docs  # an equal segment of an earlier document
        for i in np.flatnonzero(some[self.same] | earlier).tolist():
            doc, lone = int(docs[i]), int(self.same[i])
            if earlier[i]:
                spans = [(0, int(length[i]))]
            else:
                a, b = at[lone], at[lone + 1]
                hit = offset[a:b][best[a:b] < doc]
                new = np.concatenate([[True], hit[1:] - hit[:-1] > WINDOW])
                spans = list(zip(hit[new].tolist(), (hit[np.concatenate([new[1:], [True]])] + WINDOW).tolist(), strict=True))
            yield doc, [s + x for s in self.starts[i] for x, _ in spans], [s + y for s in self.starts[i] for _, y in spans]


def _spans(found: Iterator[tuple[int, list, list]]) -> pa.Table:
    ids, starts, ends = [], [], []
    for doc, a, b in found:
        ids.append(doc)
        starts.append(a)
        ends.append(b)
    return pa.table({"id": pa.array(ids, pa.int64()), "starts": pa.array(starts, pa.list_(pa.int32())), "ends": pa.array(ends, pa.list_(pa.int32()))})


def repeated_spans(texts: DataFrame, buckets: int) -> DataFrame:
    """Spans `id, starts, ends`, in several rows, of documents `id, text, segments` covered by windows of earlier ones."""
    shard = "bucket bigint, bwt binary, heads binary, digests binary, docs array<bigint>, starts array<array<int>>, ends array<array<int>>"
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.int32()))]
    names = [c.split()[0] for c in shard.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            rows = list(shards.rows())
            for n, part in enumerate(np.array_split(np.array(list(covered), np.int64), max(1, len(covered) // 1000))):
                if len(part):  # spans that are settled already pass through the buckets
                    rows.append({"bucket": (int(part[0]) + n) % buckets, "docs": part.tolist(),
                                 "starts": [[a for a, _ in covered[d]] for d in part.tolist()], "ends": [[b for _, b in covered[d]] for d in part.tolist()]})
            return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], kind) for k, kind in zip(names, kinds, strict=True)], names)

        shards, covered, settled = Shards(buckets), {}, 0
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True)):
                at, key, name = named_runs(text)
                have = np.sort(batch.column(2)[i].values.to_numpy().view(np.uint64))
                tag = tags(key, name)
                found = have[np.minimum(np.searchsorted(have, tag), len(have) - 1)] ^ tag
                start, end = at[:-1], at[1:]
                wanted, gone = found == 1, found == 0
                shards.add(doc, text, start[wanted], end[wanted], key[wanted], covered)
                if gone.any():
                    a, b = start[gone], end[gone] + (WINDOW - 1)
                    new = np.concatenate([[True], a[1:] > b[:-1]])
                    settled += int(new.sum())
                    covered.setdefault(doc, []).extend(zip(a[new].tolist(), b[np.concatenate([new[1:], [True]])].tolist(), strict=True))
                if shards.size > PART or settled > PART:
                    yield flush()
                    shards, covered, settled = Shards(buckets), {}, 0
        yield flush()

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        settled = ((d, a, b) for r in rows if r["bwt"] is None for d, a, b in zip(r["docs"], r["starts"], r["ends"], strict=True))
        shards = [r for r in rows if r["bwt"] is not None]
        return _spans(x for part in (settled, Merge(shards).covered() if shards else ()) for x in part)

    return texts.mapInArrow(cut, shard).groupBy("bucket").applyInArrow(merge, "id bigint, starts array<int>, ends array<int>")


def _joined(starts: list, ends: list) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every document its bytes, the removed ones, the maximal removed runs and what is left: id, n_bytes, n_removed,
    n_spans, kept_sha256, kept (binary, may cut characters).

    Null texts count as empty; texts shorter than a window keep everything. Ids are integers. Rows with one id are one
    document if their texts are equal; otherwise they do not remove each other's bytes. A row with a null id keeps its
    text and removes nothing. Other columns are left out, and an empty table gives no rows.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    known = docs.where("id is not null")
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = max(8, int(size // BUCKET_BYTES) + 1)
    shared = stored(repeated_segments(known.where(F.octet_length("text") >= WINDOW), buckets), "shared")
    heads = known.select(F.sha2("text", 256).alias("digest"), "id").groupBy("digest").agg(F.min("id").alias("head"))
    heads = stored(known.select(F.sha2("text", 256).alias("digest"), "id").join(heads, "digest").select("id", "digest", (F.col("id") == F.col("head")).alias("first")).distinct(), "heads")
    dealt = docs.repartition(partitions, "id")  # both uses below read this exchange
    first = heads.where("first").select("id").distinct()
    segments = shared.groupBy("id").agg(F.collect_list("segment").alias("segments")).join(first, "id", "left_semi")  # a document's own
    # a left join, since an inner one tests the ids before the exchange and makes it another
    spans = repeated_spans(dealt.join(segments, "id", "left").select("id", "text", "segments"), buckets)
    spans = spans.groupBy("id").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))  # its own spans
    copies = heads.groupBy("id").agg(F.bool_and("first").alias("first"))
    whole = dealt.join(copies, "id", "left").join(spans, "id", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, first, starts, ends in zip(_texts(batch.column(1)), *(c.to_pylist() for c in batch.columns[2:]), strict=True):
                gone = [(0, len(text))] if first is False and len(text) >= WINDOW else _joined(starts or [], ends or [])
                kept, at = [], 0
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                left = b"".join(kept)
                rows.append((len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = whole.select("id", "text", "first", "starts", "ends").mapInArrow(
        finish, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )
    return out.withColumnRenamed("id", id_col)
