"""Ranked lexical search by presence masks: a set of query items ranked against all documents.

1. *Vectors.* One map over the documents finds the items' terms in whole texts (as bytes, `byte_words`) and stores for
   every document its length and the frequencies of those terms: a small part of the text.
2. *Statistics.* Document frequencies, the number of documents and of their terms, summed by Spark.
3. *Masks.* In blocks of documents, and for each item, the presence of the item's terms is packed into a bit mask for
   each document, and documents are grouped by it. A mask's greatest score is the sum of what its terms can add at most
   in the block. Masks are evaluated from the greatest on, until the next one cannot reach the item's last place; a task
   carries each item's best documents from block to block, so later blocks finish sooner. What a task hands on is `top`
   rows an item, and Spark ranks those.

Scores are whole numbers, so bounds and ties are exact. Items come in parts of at most `PART_ITEMS` items and, unless a
single item has more, `PART_TERMS` different terms, each with a pass over the vectors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.llm import byte_words
from lumisift.llm.byte_pieces import small
from lumisift.llm.byte_words import Keys
from lumisift.llm.stored import stored
from lumisift.llm.workers import hold
from lumisift.operators.topk import top_n_per_group

#: Items and different terms of a part, and cells (terms x documents) of a block.
PART_ITEMS, PART_TERMS, CELLS = 5_000, 50_000, 4_000_000
#: Weights: thousandths of a logarithm; shares of a term's frequency: billionths. Fixed values of the score.
WEIGHT, SHARE, SATURATION, LENGTH_PART = 1000, 1_000_000_000, 1000, 75
#: Bytes that separate terms: all ASCII but digits and letters.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_KIND = byte_words.kinds(SEPARATORS, b"")


@cache
def _keys(seed: int) -> Keys:
    return Keys(seed)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    column = pa.array([text], pa.string())
    return [t for found in byte_words.words(column, _KIND) for t in found.text.tobytes().replace(b"\n", b" ").split()]


class Part:
    """Items of a part: of each its id, and its terms as numbers of the part's vocabulary with their repeats."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        names = sorted({t for _, terms in items for t in terms})
        number = {t: i for i, t in enumerate(names)}
        self.names, self.items = names, []
        for item, terms in items:
            counts = Counter(number[t] for t in terms)
            self.items.append((item, np.array(list(counts), np.int64), np.array(list(counts.values()), np.int64)))
        keys = _keys(5).of(names)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.check = keys[self.order], _keys(6).of(names)[self.order]

    def numbers(self, keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The vocabulary's numbers of terms given by two keys (128 bits), -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        out = np.where((self.keys[at] == keys) & (self.check[at] == check), self.order[at], -1)
        return out


def parts(items: DataFrame, id_col: str, text_col: str) -> Iterator[Part]:
    """The items in parts, one after the other. Items without terms match nothing and are left out; equal ids are items
    of their own."""
    held, names = [], set()
    for item, text in items.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        terms = terms_of(text)
        if held and (len(held) == PART_ITEMS or len(names | set(terms)) > PART_TERMS):
            yield Part(held)
            held, names = [], set()
        if terms:
            held.append((item, terms))
            names |= set(terms)
    if held:
        yield Part(held)


def vectors(docs: DataFrame, part: Part, id_col: str, text_col: str) -> DataFrame:
    """`id, n, term, tf`: a document's terms with repeats, and the frequencies of the part's terms in it."""
    shared = docs.sparkSession.sparkContext.broadcast(part)  # at most PART_TERMS terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lexical", _keys.cache_clear)
        own = shared.value
        width = max(1, len(own.names))
        for batch in small(batches):
            rows = batch.num_rows
            n, pairs = np.zeros(rows, np.int64), []
            for found in byte_words.words(batch.column(1), _KIND):
                n += np.bincount(found.row, minlength=rows)
                key, check = (k.spans(k.running(found.text), found.start, found.end) for k in (_keys(5), _keys(6)))
                number = own.numbers(key, check)
                known = number >= 0
                pairs.append(np.unique(found.row[known] * width + number[known], return_counts=True))
            cell, code = np.unique(np.concatenate([np.zeros(0, np.int64), *(p for p, _ in pairs)]), return_inverse=True)
            tf = np.zeros(len(cell), np.int64)
            np.add.at(tf, code, np.concatenate([np.zeros(0, np.int64), *(c for _, c in pairs)]))
            begin = pa.array(np.searchsorted(cell // width, np.arange(rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(begin, pa.array(x, t)) for x, t in ((cell % width, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], ["id", "n", "term", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n bigint, term array<int>, tf array<bigint>")


class Ranker:
    """The best documents of each item among the blocks seen so far."""

    def __init__(self, part: Part, weight: np.ndarray, documents: int, length: int, top: int):
        self.part, self.weight, self.documents, self.length, self.top = part, weight, documents, length, top
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in part.items]  # scores, ids; best first
        self.evaluated = self.matched = 0
        self.groups = []  # items that meet a block together, with the terms they have
        held, names = [], set()
        for i, (_, terms, _) in enumerate(part.items):
            if held and len(names | set(terms.tolist())) > 4096:
                self.groups.append((held, np.array(sorted(names))))
                held, names = [], set()
            held.append(i)
            names |= set(terms.tolist())
        if held:
            self.groups.append((held, np.array(sorted(names))))

    def add(self, ids: np.ndarray, n: np.ndarray, begin: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """A batch of document vectors; those of document i lie from `begin[i]` to `begin[i + 1]`."""
        norm = 8 * (100 - LENGTH_PART + LENGTH_PART * n * self.documents // max(1, self.length))
        for held, names in self.groups:
            rows = max(64, CELLS // len(names))
            for low in range(0, len(ids), rows):
                high = min(low + rows, len(ids))
                part = slice(begin[low], begin[high])
                row = np.repeat(np.arange(high - low), np.diff(begin[low : high + 1]))
                at = np.minimum(np.searchsorted(names, term[part]), len(names) - 1)
                own = names[at] == term[part]
                dense = np.zeros((len(names), high - low), np.int64)
                share = SHARE * tf[part] // (SATURATION * tf[part] + norm[low:high][row])
                dense[at[own], row[own]] = share[own]
                self._block(held, names, ids[low:high], dense)

    def _block(self, held: list[int], names: np.ndarray, ids: np.ndarray, dense: np.ndarray) -> None:
        present, most = dense > 0, dense.max(1, initial=0)
        for i in held:
            _, terms, repeats = self.part.items[i]
            at = np.searchsorted(names, terms)
            at, gain = at[most[at] > 0], (repeats * self.weight[terms])[most[at] > 0]
            if not len(at):
                continue
            # documents by the mask of the item's terms they hold
            packed = np.packbits(present[at], axis=0)
            mask = np.zeros(len(ids), np.int64)
            for byte in packed:
                mask = np.unique(mask * 256 + byte, return_inverse=True)[1]
            _, first, group = np.unique(mask, return_index=True, return_inverse=True)
            reach = (gain * most[at]) @ present[at][:, first]
            order = np.argsort(-reach, kind="stable")
            members = np.argsort(group, kind="stable")
            begin = np.append(0, np.cumsum(np.bincount(group)))
            self.matched += int((reach[group] > 0).sum())
            place, take = 0, 1
            while place < len(order):
                scores, _ = self.best[i]
                least = max(1, int(scores[-1])) if len(scores) == self.top else 1
                now = order[place : place + take]
                now = now[reach[now] >= least]  # an equal score may still win by its id
                if not len(now):
                    break
                rows = np.concatenate([members[begin[g] : begin[g + 1]] for g in now])
                self._keep(i, ids[rows], gain @ dense[at][:, rows])
                self.evaluated += len(rows)
                place, take = place + take, take * 2

    def _keep(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.best[i][0], scores]), np.concatenate([self.best[i][1], ids])
        scores, ids = scores[scores > 0], ids[scores > 0]
        order = np.lexsort((ids, -scores))[: self.top]
        self.best[i] = scores[order], ids[order]


def _ranked(found: DataFrame, part: Part, weight: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """The best documents of each task for every item of the part, as `item` (its number), `doc`, `score`."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast((part, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lexical", _keys.cache_clear)
        own, weights = shared.value
        ranker = Ranker(own, weights, documents, length, top)
        for batch in batches:
            term, tf = batch.column(2), batch.column(3)
            begin = np.asarray(term.offsets)
            ranker.add(batch.column(0).to_numpy(), batch.column(1).to_numpy(), begin - begin[0], np.asarray(term.flatten()), np.asarray(tf.flatten()))
        item = np.repeat(np.arange(len(own.items)), [len(scores) for scores, _ in ranker.best])
        score, doc = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*ranker.best, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc), pa.array(score)], ["item", "doc", "score"])

    return found.where("n > 0 and id is not null").select(F.col("id").cast("bigint"), "n", "term", "tf").mapInArrow(run, "item bigint, doc bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """`item, rank, doc, score`: each item's `top` documents with a score above 0, equal scores by ascending id.

    Ids of documents are whole numbers; rows without one count in the statistics but are not returned. Null and empty
    texts have no terms. Repeated rows are documents, and items, of their own. Texts of any length count whole. An empty
    table on either side gives no rows. Other columns are left out, whatever their names.
    """
    spark, out = docs.sparkSession, None
    for part in parts(items, item_col, query_col):
        found = stored(vectors(docs, part, id_col, text_col), "vectors")
        total = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
        documents, length = total["documents"], total["length"] or 0
        frequency = np.zeros(len(part.names), np.int64)
        for row in found.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():  # at most PART_TERMS
            frequency[row[0]] = row[1]
        weight = np.array([math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
        ranked = top_n_per_group(_ranked(found, part, weight, documents, length, top), ["item"], [F.col("score").desc(), F.col("doc")], top, ["doc"])
        names = _names(spark, items, part, item_col)
        ranked = ranked.join(F.broadcast(names), "item").select(item_col, F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = items.select(item_col).where("false").select(item_col, F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias(id_col), F.lit(0).cast("bigint").alias("score"))
    return out


def _names(spark: SparkSession, items: DataFrame, part: Part, item_col: str) -> DataFrame:
    """The ids of a part's items by number; at most PART_ITEMS rows."""
    kind = items.schema[item_col].dataType.simpleString()
    return spark.createDataFrame([(i, item) for i, (item, _, _) in enumerate(part.items)], f"item bigint, {item_col} {kind}")
