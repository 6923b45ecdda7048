"""Lexical search against brute force, edge cases, and the query against its SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lumisift.checks.compare import differences, oracle_connection
from lumisift.llm import byte_words, lexical, queries

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(docs, items, top):
    held = [(i, terms(t)) for i, t in docs]
    count, length = sum(bool(ts) for _, ts in held), sum(len(ts) for _, ts in held)
    df = Counter(t for _, ts in held for t in set(ts))
    out = []
    for item, text in items:
        scores = []
        for doc, ts in held:
            if doc is None:
                continue
            tf, m, score = Counter(ts), 25 + (75 * len(ts) * count) // max(1, length), 0
            for t in terms(text):
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def found(spark, docs, items, top=10):
    docs = spark.createDataFrame([(i, t, i, 1) for i, t in docs], "doc_id bigint, text string, item_id bigint, score int")
    items = spark.createDataFrame([(i, t, i) for i, t in items], "item_id bigint, text string, doc_id bigint")
    return sorted(tuple(r) for r in lexical.search(docs, items, top).collect())


def texts(rng, n, most):
    words = "a B c é 日本 x1 don't foo|bar 42 the the the".split()
    return ["".join(rng.choice(words) + rng.choice([" ", "\n", ", ", "-"]) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_search_agrees_with_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("PART_ITEMS", 3), ("PART_TERMS", 8), ("CELLS", 40)):
            monkeypatch.setattr(lexical, name, value)
        monkeypatch.setattr(byte_words, "CHUNK", 50)
    rng = random.Random(7)
    docs, items = list(enumerate(texts(rng, 300, 30))), list(enumerate(texts(rng, 11, 12)))
    assert found(spark, docs, items, 5) == brute(docs, items, 5)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "same words"), (4, "same words"), (None, "same words here"), (5, "Same words"), (6, "words " * 400_000)]
    items = [(1, None), (2, ""), (3, "same"), (3, "same words same"), (4, "absent"), (5, "?!")]
    assert found(spark, docs, items) == brute(docs, [x for x in items if x[1]], 10)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_an_item_with_many_terms(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 400)}"
    docs = [(i, " ".join(word() for _ in range(rng.randint(1, 200)))) for i in range(120)]
    items = [(0, " ".join(f"w{i}" for i in range(300))), (1, "w1 w2")]
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_masks_that_cannot_win_are_not_evaluated():
    part = lexical.Part([(0, [b"rare", b"common"])])
    ranker = lexical.Ranker(part, np.array([10, 5000])[[part.names.index(t) for t in (b"common", b"rare")]], 1000, 2000, 3)
    n = 500
    rare = np.arange(n) < 10
    term = np.concatenate([[0, 1] if r else [0] for r in rare])
    ranker.add(np.arange(n), np.full(n, 2), np.append(0, np.cumsum(np.where(rare, 2, 1))), term, np.ones(len(term), np.int64))
    assert ranker.matched == n and ranker.evaluated == 10
    assert ranker.best[0][1].tolist() == [0, 1, 2]


def test_query_agrees_with_sql(spark):
    mine = queries.QUERIES["op13_lexical_search"](spark, SMALL).toPandas()
    other = oracle_connection(SMALL).execute(queries.ORACLES["op13_lexical_search"]).df()
    assert len(mine) and differences(mine, other) == []
