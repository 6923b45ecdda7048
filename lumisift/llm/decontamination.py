"""Benchmark decontamination: every training document asks a BM25 index of test items, and what it finds is verified.

A document asks with the words of all its passages together, so it does not matter where in it the parts of an item
stand. An item's threshold is the least score of a document that holds four fifths of its word shingles. Missing so many
shingles costs at most as many words: around a shingle that is there, a missing word first met to the right ends a
missing shingle of its own, one only met to the left starts one. So the threshold is the item's own score less its
heaviest terms. Weights are divided by it, and everything from 1 on is retrieved; nothing that verification would accept
is lost.

As in block-max WAND, terms whose weights cannot lift an item to its threshold start no search (for each item its
commonest terms), and a block of items is scored only if the sum of its terms' block maxima reaches the threshold.
A retrieved item is verified by its shingles: it counts as leaked into a document if the whole document holds `OVERLAP`
of them, in one place or in many; the shares of its question and of its answer are reported.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Words of a shingle, share of an item's shingles that makes a leak, items of a block.
SHINGLE, OVERLAP, BLOCK = 5, 0.8, 32
#: BM25 parameters.
K1, B = 1.2, 0.75
#: Items of one index. Larger benchmarks take as many passes over the training texts as they have parts of this size.
INDEX_ITEMS = 50_000
_WORD = re.compile(r"\w+")

LEAK = "array<struct<item_id:bigint,score:double,overlap:double,question_overlap:double,answer_overlap:double>>"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(SHINGLE)), strict=False))


def split_answer(text: str) -> tuple[str, str]:
    """Question and answer of an item given as one text: its last sentence is the answer."""
    ends = [m.end() for m in re.finditer(r"[.!?]\s+", text.rstrip())]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


class BlockMaxIndex:
    """Test items with BM25 weights relative to each item's threshold."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.weights, texts = [], [], []  # (id, shingles, question's, answer's); of each item's terms; its words
        for item, text in items:
            words = words_of(text or "")
            whole = shingles(words)
            if not whole:  # shorter than a shingle: not to be told from ordinary text
                continue
            n_question = len(words_of(split_answer(text)[0]))
            answer = shingles(words[max(0, n_question - SHINGLE + 1) :]) if n_question < len(words) else set()
            self.items.append((item, whole, shingles(words[:n_question]), answer))
            texts.append(words)
        frequency = Counter(t for words in texts for t in set(words))
        mean = sum(map(len, texts)) / max(1, len(texts))
        idf = {t: math.log(1 + (len(texts) - n + 0.5) / (n + 0.5)) for t, n in frequency.items()}
        self.start: dict[str, list[int]] = defaultdict(list)
        self.block_max: dict[str, dict[int, float]] = defaultdict(dict)
        for at, words in enumerate(texts):
            norm = K1 * (1 - B + B * len(words) / mean)
            weight = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in Counter(words).items()}
            missing = math.floor((1 - OVERLAP) * len(self.items[at][1]) + 1e-9)
            least = sum(sorted(weight.values())[: max(1, len(weight) - missing)]) * (1 - 1e-9)
            weight, left = {t: w / least for t, w in weight.items()}, 1.0
            for t in sorted(weight, key=lambda t: (-frequency[t], t)):  # the commonest together stay below the threshold
                left -= weight[t]
                if left <= 0:
                    self.start[t].append(at)
            for t, w in weight.items():
                self.block_max[t][at // BLOCK] = max(w, self.block_max[t].get(at // BLOCK, 0.0))
            self.weights.append(weight)
        self.start, self.block_max = dict(self.start), dict(self.block_max)

    def retrieve(self, terms: set[str], starting: list[str]) -> Iterator[tuple[int, float]]:
        """Items that a document's terms lift to their threshold, with their scores; `starting`: those of its terms that
        start a search."""
        blocks = defaultdict(set)
        for t in starting:
            for i in self.start[t]:
                blocks[i // BLOCK].add(i)
        known = [m for t in terms if (m := self.block_max.get(t))] if blocks else []
        for block, found in blocks.items():
            if len(found) > 1 and sum(m[block] for m in known if block in m) < 1:
                continue
            for i in found:
                score = sum(w for t, w in self.weights[i].items() if t in terms)
                if score >= 1:
                    yield i, score

    def leaks(self, text: str) -> list[dict]:
        """Items leaked into a text."""
        words = words_of(text)
        start = self.start
        if start.keys().isdisjoint(words):
            return []
        terms, own, out = set(words), None, []
        for i, score in self.retrieve(terms, [t for t in terms if t in start]):
            own = own or shingles(words)
            item_id, whole, question, answer = self.items[i]
            hit = whole & own
            if len(hit) >= OVERLAP * len(whole) - 1e-9:
                share = lambda of: len(hit & of) / len(of) if of else None  # noqa: E731, B023
                out.append({"item_id": item_id, "score": score, "overlap": len(hit) / len(whole), "question_overlap": share(question), "answer_overlap": share(answer)})
        return sorted(out, key=lambda x: x["item_id"])


def leaks_column(index: BlockMaxIndex, spark, text: Column) -> Column:
    """Leaked items of a text as an array of structs; a null text has none."""
    shared = spark.sparkContext.broadcast(index)  # at most INDEX_ITEMS items

    @pandas_udf(LEAK)
    def leaks(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.leaks(text) if text else [] for text in texts], dtype=object)

    return leaks(text)


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[BlockMaxIndex]:
    """The benchmark in indexes of at most `INDEX_ITEMS` items, one after the other. Items without text are left out;
    equal ids with different texts are items of their own."""
    part = []
    for row in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        part.append((row[0], row[1]))
        if len(part) == INDEX_ITEMS:
            yield BlockMaxIndex(part)
            part = []
    if part:
        yield BlockMaxIndex(part)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document and item leaked into it: id, item_id, score, overlap, question_overlap, answer_overlap.

    Null and empty texts have no leaks, nor has anything if the benchmark is empty; repeated rows are reported each.
    Items with fewer words than a shingle are not searched for. Other columns are left out.
    """
    out = None
    for index in indexes(benchmark):
        found = docs.select(id_col, F.explode(leaks_column(index, docs.sparkSession, F.col(text_col))).alias("leak")).select(id_col, "leak.*")
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = f"leak {LEAK[6:-1]}"
        empty = docs.sparkSession.createDataFrame([], schema).select("leak.*")
        out = docs.select(id_col).where("false").crossJoin(empty)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents into which no item leaked, with all their columns."""
    for index in indexes(benchmark):
        docs = docs.where(F.size(leaks_column(index, docs.sparkSession, F.col(text_col))) == 0)
    return docs
