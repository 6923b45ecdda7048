"""Images that share hashes, found in tiles of two blocks of images.

Rows are dealt to blocks by a hash of their id, and every two blocks meet in one group, a tile. In it a bucket of a bundle
is a stretch of sorted hashes, so candidates are made, judged and forgotten a strip of images at a time; what leaves a tile
is near pairs, links or best hits, never candidates. A row is sent to as many tiles as there are blocks: `LEAST` for small
tables, one for every `TILE` rows of large ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumisift.functions.pairwise import paired, scores

TILE = 40_000
"""Images of a block."""
LEAST = 8
"""Blocks of small tables."""
MOST = 2_000_000
"""Candidates of a strip; a strip has one image at least."""
JUDGED = 4_000_000
"""Numbers of the vectors that are judged at a time."""
CROWD = 64
"""Images of a bucket in a tile above which they are compared with its first one before."""


def _blocks(rows: DataFrame, tile: int) -> DataFrame:
    """One row: the number of blocks."""
    wanted = F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int")
    return F.broadcast(rows.agg(F.greatest(F.lit(LEAST), wanted).alias("blocks")))


def _dealt(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    return rows.crossJoin(blocks).withColumn("side", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))


def _tiled(rows: DataFrame, tile: int, earlier: DataFrame | None = None) -> DataFrame:
    """``rows`` in every tile their block takes part in. Vectors of different lengths never meet. With ``earlier`` rows, whose
    blocks have negative numbers, only pairs with a row of ``rows`` meet."""
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    placed = _dealt(rows, "head", _blocks(rows, tile))
    tiles = placed.withColumn("other", every(F.col("blocks")))
    if earlier is not None:
        own, old = F.broadcast(_blocks(rows, tile)), F.broadcast(_blocks(earlier, tile).withColumnRenamed("blocks", "old"))
        met = placed.crossJoin(old).withColumn("other", F.explode(F.sequence(-F.col("old"), F.lit(-1)))).drop("old")
        before = _dealt(earlier, "head", _blocks(earlier, tile)).drop("blocks").crossJoin(own)
        before = before.withColumn("side", -1 - F.col("side")).withColumn("other", every(F.col("blocks")))
        tiles = tiles.unionByName(met).unionByName(before)
    return tiles.drop("blocks").withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other"), "dim": F.size("vec")}).drop("other")


def _table(batches: Iterator[pa.RecordBatch] | list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(list(batches)).combine_chunks()


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    """An array column of equally long arrays as rows."""
    if not len(table):
        return np.zeros((0, 0), np.int64)
    return np.asarray(table[name].chunk(0).flatten()).reshape(len(table), -1 if len(table[name][0]) else 0)


def _ranges(h: np.ndarray, of: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For hashes ``of`` the stretch of equal ones among the sorted ``h``: order, first, number. If both are the same rows a
    stretch begins after the row itself."""
    order = np.argsort(h, kind="stable")
    place = h[order]
    last = np.searchsorted(place, of, "right")
    if same:
        first = np.empty(len(h), np.int64)
        first[order] = np.arange(1, len(h) + 1)
    else:
        first = np.searchsorted(place, of, "left")
    yield order.astype(np.int32), first.astype(np.int32), (last - first).astype(np.int32)


def _apart(h: np.ndarray, of: np.ndarray, root: np.ndarray, of_root: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `_ranges`, of equal hashes with another root only; if both are the same rows, with a larger one."""
    names, number = np.unique(h, return_inverse=True)
    step = int(max(root.max(initial=0), of_root.max(initial=0))) + 1
    code = number * step + root
    order = np.argsort(code, kind="stable")
    code = code[order]
    own = np.minimum(np.searchsorted(names, of), len(names) - 1)
    found, base = names[own] == of, own * step
    after, last = np.searchsorted(code, base + of_root, "right"), np.searchsorted(code, base + step - 1, "right")
    yield order.astype(np.int32), after.astype(np.int32), np.where(found, last - after, 0).astype(np.int32)
    if not same:
        first, before = np.searchsorted(code, base, "left"), np.searchsorted(code, base + of_root, "left")
        yield order.astype(np.int32), first.astype(np.int32), np.where(found, before - first, 0).astype(np.int32)


def _strips(ranges: list, n: int, width: int, times: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(i, j, shared)`` of all pairs in the ranges, for a strip of the ``n`` asking rows at a time; ``times`` are weights of a
    range's askers, ``owners`` of ranges that have an asker more than once come with them."""
    owners = [np.arange(n)] * len(ranges) if times is None else [o for o, _ in times]
    total = np.zeros(n, np.int64)
    for (_, _, size), owner in zip(ranges, owners, strict=True):
        total += np.bincount(owner, size, n).astype(np.int64)
    ends, row = np.cumsum(total), 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + MOST, "right")))
        keys, weights = [], []
        for k, ((order, first, size), owner) in enumerate(zip(ranges, owners, strict=True)):
            a, b = np.searchsorted(owner, (row, end))
            of = size[a:b].astype(np.int64)
            if many := int(of.sum()):
                at = np.arange(many) + np.repeat(first[a:b] - (np.cumsum(of) - of), of)
                keys.append(np.repeat(owner[a:b] - row, of) * width + order[at])
                if times is not None:
                    weights.append(np.repeat(times[k][1][a:b], of))
        if keys:
            keys, cells = np.concatenate(keys), (end - row) * width
            weights = np.concatenate(weights) if weights else None
            if len(keys) * 4 > cells:
                shared = np.bincount(keys, weights, cells)
                keys = np.flatnonzero(shared)
                shared = shared[keys].astype(np.int64)
            elif weights is None:
                keys, shared = np.unique(keys, return_counts=True)
            else:
                keys, back = np.unique(keys, return_inverse=True)
                shared = np.bincount(back, weights).astype(np.int64)
            yield row + keys // width, keys % width, shared
        row = end


def distances(metric: str, a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    step = max(1, JUDGED // max(1, a.shape[1]))
    parts = [paired(metric, a[i[k : k + step]], b[j[k : k + step]]) for k in range(0, len(i), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


class _Tile:
    """The rows of a tile and the numbers of those of either side."""

    def __init__(self, key: tuple, batches: Iterator[pa.RecordBatch], metric: str, threshold: float, min_shared: int):
        _, low, high = (k.as_py() for k in key)
        self.table = _table(batches)
        side = self.table["side"].to_numpy()
        self.same = low == high
        self.a = np.flatnonzero(side == low)
        self.b = self.a if self.same else np.flatnonzero(side == high)
        self.ids = self.table["head"].to_numpy()
        self.sig, self.vec = _matrix(self.table, "sig"), _matrix(self.table, "vec")
        self.metric, self.threshold, self.min_shared = metric, threshold, max(1, min_shared)

    def near(self, root: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``(i, j, shared, distance)`` of linked rows, one of either side; with ``root`` only of different ones. Roots that are
        joined meanwhile are seen from the next strip on."""
        if not (len(self.a) and len(self.b)):
            return
        ranges = []
        for k in range(self.sig.shape[1]):
            h, of = self.sig[self.b, k], self.sig[self.a, k]
            ranges += _ranges(h, of, self.same) if root is None else _apart(h, of, root[self.b], root[self.a], self.same)
        for i, j, shared in _strips(ranges, len(self.a), len(self.b)):
            enough = shared >= self.min_shared
            i, j, shared = self.a[i[enough]], self.b[j[enough]], shared[enough]
            if root is not None:
                open_ = root[i] != root[j]
                i, j, shared = i[open_], j[open_], shared[open_]
            yield self._judged(i, j, shared)

    def _judged(self, i: np.ndarray, j: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        apart = distances(self.metric, self.vec, i, self.vec, j)
        with np.errstate(invalid="ignore"):
            near = apart <= self.threshold
        return i[near], j[near], shared[near], apart[near]

    def roots(self, crowd: int) -> np.ndarray:
        """For each row the first one that links of this tile connect it with."""
        root = np.arange(len(self.ids))
        for k in range(self.sig.shape[1]):
            order = np.argsort(self.sig[:, k], kind="stable")
            place = self.sig[order, k]
            begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            sizes = np.diff(np.concatenate([begins, [len(place)]]))
            first = np.repeat(order[begins], np.where(sizes > crowd, sizes, 0))
            rows = order[np.repeat(sizes > crowd, sizes)]
            open_ = root[rows] != root[first]
            for at in np.array_split(np.flatnonzero(open_), max(1, int(open_.sum()) * self.sig.shape[1] // JUDGED)):
                i, j = rows[at], first[at]
                shared = (self.sig[i] == self.sig[j]).sum(1)
                enough = shared >= self.min_shared
                i, j, _, _ = self._judged(i[enough], j[enough], shared[enough])
                join(root, i, j)
        for i, j, _, _ in self.near(root):
            join(root, i, j)
        return root


def join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of rows that are linked; a set is named by its first row."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _with_sig(images: DataFrame) -> DataFrame:
    return images.filter(F.col("sig").isNotNull())


def near_pairs(images: DataFrame, metric: str, threshold: float, min_shared: int, tile: int = TILE, earlier: DataFrame | None = None) -> DataFrame:
    """``(a, b, shared, distance)``, ``a < b``: images ``(head, vec, sig)`` that share at least ``min_shared`` hashes in place and
    are within the threshold; with ``earlier`` images also those of one of either table. A row that comes twice pairs twice."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Tile(key, batches, metric, threshold, min_shared)
        for i, j, shared, apart in of.near():
            a, b = of.ids[i], of.ids[j]
            keep = a != b
            a, b = np.minimum(a, b)[keep], np.maximum(a, b)[keep]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, shared[keep], apart[keep])], ["a", "b", "shared", "distance"])

    own = lambda rows: _with_sig(rows.select("head", "vec", "sig"))
    tiles = _tiled(own(images), tile, None if earlier is None else own(earlier))
    return tiles.groupBy("dim", "low", "high").applyInArrow(run, "a bigint, b bigint, shared bigint, distance double")


def connections(images: DataFrame, metric: str, threshold: float, min_shared: int, tile: int = TILE, crowd: int = CROWD) -> DataFrame:
    """``(a, b)``: links of images ``(head, vec, sig)``, in each tile as few as connect what its links connect."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Tile(key, batches, metric, threshold, min_shared)
        root = of.roots(crowd)
        a, b = of.ids, of.ids[root]
        yield pa.RecordBatch.from_arrays([pa.array(c[a != b]) for c in (a, b)], ["a", "b"])

    return _tiled(_with_sig(images.select("head", "vec", "sig")), tile).groupBy("dim", "low", "high").applyInArrow(run, "a bigint, b bigint")


def link_counts(images: DataFrame, metric: str, threshold: float, min_shared: int, tile: int = TILE) -> DataFrame:
    """``(head, links)``: with how many documents an image ``(head, vec, sig, copies)`` is linked, its own copies apart."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Tile(key, batches, metric, threshold, min_shared)
        copies, links = of.table["copies"].to_numpy(), np.zeros(len(of.ids), np.int64)
        for i, j, _, _ in of.near():
            for x, y in ((i, j), (j, i)):
                links += np.bincount(x, copies[y], len(links)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c[links > 0]) for c in (of.ids, links)], ["head", "links"])

    tiles = _tiled(_with_sig(images.select("head", "vec", "sig", "copies")), tile)
    found = tiles.groupBy("dim", "low", "high").applyInArrow(run, "head bigint, links bigint")
    return found.groupBy("head").agg(F.sum("links").alias("links"))


# --- queries against documents -------------------------------------------------------------------


def _postings(table: pa.Table, form: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each bundle ``(row, h, times)``, by row. ``places``: hashes in place; ``near``: several of a bundle; ``distinct`` and
    ``counted``: one bundle for all, a row's hash once, or with how often it has it."""
    n = len(table)
    if form == "near":
        held = table["near"].to_pylist()
        out = []
        for k in range(max(map(len, held), default=0)):
            rows = np.repeat(np.arange(n), [len(x[k]) for x in held])
            out.append((rows, np.array([h for x in held for h in x[k]], np.int64), np.ones(len(rows), np.int64)))
        return out
    sig = _matrix(table, "sig")
    if form == "places":
        return [(np.arange(n), sig[:, k], np.ones(n, np.int64)) for k in range(sig.shape[1])]
    both = np.stack([np.repeat(np.arange(n), sig.shape[1]), sig.reshape(-1)], 1)
    both, times = np.unique(both, axis=0, return_counts=True)
    return [(both[:, 0], both[:, 1], np.ones(len(both), np.int64) if form == "distinct" else times)]


def _first(group: np.ndarray, order: list[np.ndarray], n: int) -> np.ndarray:
    """The first ``n`` rows of each group."""
    at = np.lexsort([*order[::-1], group])
    begins = np.searchsorted(group[at], group[at], "left")
    return at[np.arange(len(at)) - begins < n]


def best_hits(documents: DataFrame, queries: DataFrame, k: int, bundle_aware: bool, metric: str, tile: int = TILE) -> DataFrame:
    """``(asked, head, distance, score)`` of candidates among documents ``(head, vec, sig)`` of queries ``(asked, vec, sig)``, or
    with other hashes to ask as ``near``: of each tile a query's ``k`` best scores, equal ones by ``head``, so the best of all are
    to be taken of them."""
    column = "near" if "near" in queries.columns else "sig"
    form = ("places", "near" if column == "near" else "places") if bundle_aware else ("distinct", "counted")
    own = _with_sig(documents.select("head", "sig", "vec"))
    asking = queries.select("asked", column, "vec").filter(F.col(column).isNotNull())
    both = own.select(F.lit(1).alias("d"), F.lit(0).alias("q")).unionByName(asking.select(F.lit(0).alias("d"), F.lit(1).alias("q")))
    number = lambda name, least: F.greatest(F.lit(least), F.ceil(F.coalesce(F.sum(name), F.lit(0)) / F.lit(tile))).cast("int").alias(f"{name}_blocks")
    blocks = F.broadcast(both.agg(number("d", LEAST), number("q", 1)))  # one row

    def dealt(rows: DataFrame, key: str, side: str, other: str) -> DataFrame:
        placed = rows.crossJoin(blocks).withColumn(side, F.pmod(F.xxhash64(key), F.col(f"{side}_blocks")).cast("int"))
        return placed.withColumns({other: F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)), "dim": F.size("vec")}).drop("d_blocks", "q_blocks")

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        out = []
        if len(left) and len(right):
            ids, asked = left["head"].to_numpy(), right["asked"].to_numpy()
            vecs = [_matrix(t, "vec") for t in (left, right)]
            ranges, times = [], []
            for (rows, h, _), (owner, of, weight) in zip(_postings(left, form[0]), _postings(right, form[1]), strict=False):
                (order, first, size) = next(_ranges(h, of, False))
                ranges.append((rows[order], first, size))
                times.append((owner, weight))
            for q, d, _ in _strips(ranges, len(asked), len(ids), times):
                apart = distances(metric, vecs[0], d, vecs[1], q)
                score = scores(apart)
                q, d, apart, score = (x[~np.isnan(score)] for x in (q, d, apart, score))
                keep = _first(q, [-score, ids[d]], k)
                out.append([asked[q[keep]], ids[d[keep]], apart[keep], score[keep]])
        kinds = {"asked": pa.int64(), "head": pa.int64(), "distance": pa.float64(), "score": pa.float64()}
        columns = [pa.array(np.concatenate([part[c] for part in out]) if out else [], kind) for c, kind in enumerate(kinds.values())]
        return pa.table(columns, list(kinds))

    docs, asks = dealt(own, "head", "d", "q"), dealt(asking, "asked", "q", "d")
    asks = asks.select([F.col(c).alias(c) for c in asks.columns])  # columns of its own, where both come from one table
    return docs.groupBy("dim", "d", "q").cogroup(asks.groupBy("dim", "d", "q")).applyInArrow(run, "asked bigint, head bigint, distance double, score double")
