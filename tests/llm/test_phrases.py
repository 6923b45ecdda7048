"""Phrases: tries and counts against brute force, edge cases, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lumisift.checks.compare import differences, oracle_connection
from lumisift.llm import byte_words, phrases, queries

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))]


def brute(rows, least, longest, top, overlap=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = {p: c for p, c in counts.items() if c >= least}
        scored = []
        for p, a in kept.items():
            if len(p) < 2:
                continue
            inside = (c for q, c in kept.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * c >= overlap * a for c in inside):
                continue
            score, _, left, right = min((1000000 * a * a // (kept[p[:k]] * kept[p[k:]]), k, kept[p[:k]], kept[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(rows)], "doc_id bigint, lang string, text string, phrase string")
    return sorted(tuple(r) for r in phrases.collocations(docs, **how).collect())


def test_splitting_agrees_with_expressions(monkeypatch):
    rng, kind = random.Random(1), byte_words.kinds(phrases.SPACES, phrases.PIECE_ENDS)
    for chunk in (7, 20, 1_000_000):
        monkeypatch.setattr(byte_words, "CHUNK", chunk)
        for _ in range(100):
            texts = [None if rng.random() < 0.1 else "".join(rng.choice("aBÉ .,\n\t日") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
            own = [(r, p) for w in byte_words.words(pa.array(texts, pa.string()), kind) for r, p in zip(w.row[w.text[w.end] == byte_words.LAST].tolist(), w.text.tobytes().decode().split("\n"), strict=False)]
            assert own == [(i, " ".join(ws)) for i, t in enumerate(texts) for ws in pieces(t) if ws]


def test_a_trie_accepts_its_phrases_and_nothing_else():
    rng = random.Random(2)
    for _ in range(50):
        words = list({b"".join(rng.choice([b"a", b"b", b"cc", b" ", b"\xe3"]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 60))})
        held, absent = words[: len(words) // 2 + 1], words[len(words) // 2 + 1 :]
        trie = phrases.Trie.of(held)
        assert [int(trie.accept[trie.state(p)]) for p in held] == list(range(len(held)))
        assert all(trie.state(p) < 0 or trie.accept[trie.state(p)] < 0 for p in absent)


@pytest.mark.parametrize("small", [False, True])
def test_collocations_agree_with_brute_force(spark, monkeypatch, small):
    if small:  # several tries and passes, counts handed on early
        for name, value in (("PHRASES", 30), ("SHARE", 500), ("HELD", 40)):
            monkeypatch.setattr(phrases, name, value)
    rng = random.Random(4)
    words = "a b c De ES en é 日本 x1 | foo".split()
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".\n"]) for _ in range(rng.randint(0, 60)))
    rows = [(rng.choice(["en", "es", "und", None, ""]), text()) for _ in range(80)]
    assert found(spark, rows, least=4, longest=3, top=30) == brute(rows, 4, 3, 30)
    assert found(spark, rows, least=3, longest=4, top=500, overlap=70) == brute(rows, 3, 4, 500, 70)


def test_edge_cases(spark):
    nothing = [("en", None), ("en", ""), (None, " \t.,"), ("en", "one two three")]
    assert found(spark, nothing) == []
    assert found(spark, []) == []
    long = "the cat sat, " * 40_000  # one long text, and ties
    rows = [("en", long), ("en", "Foo Bar. " * 10), ("en", "bar baz. " * 10), ("en", "foo bar. "), ("en", "y" * 2_000_000)]
    assert found(spark, rows) == brute(rows, 10, 3, 2000)


def test_query_agrees_with_sql(spark):
    mine = queries.QUERIES["op12_phrase_collocations"](spark, SMALL).toPandas()
    other = oracle_connection(SMALL).execute(queries.ORACLES["op12_phrase_collocations"]).df()
    assert len(mine) and differences(mine, other) == []


def test_texts_are_read_as_often_however_many_phrases_there_are(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("en", " ".join(f"w{rng.randint(0, 9)}" for _ in range(100))) for _ in range(20)]
    want = Counter(" ".join(ws[i : i + k]) for _, t in rows for ws in pieces(t) for k in (1, 2, 3) for i in range(len(ws) - k + 1))
    for size in (30, 500_000):
        monkeypatch.setattr(phrases, "PHRASES", size)
        read = spark.sparkContext.accumulator(0)

        def noted(batches, read=read):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        docs = spark.createDataFrame(rows, "lang string, text string").mapInArrow(noted, "lang string, text string")
        counts, totals = phrases.phrase_counts(docs, least=2, longest=3)
        assert {r.phrase: r.f for r in counts.collect()} == {p: f for p, f in want.items() if f >= 2}
        assert [tuple(r) for r in totals.collect()] == [("en", 2000)]
        assert read.value == 20 * (1 + 3 + 1)  # sizes, bounds, candidates


def test_phrases_of_one_key_are_told_apart():
    rng = random.Random(7)
    met, want = {}, Counter()
    for _ in range(6):
        rows = [(rng.choice("de"), "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))) for _ in range(60)]
        want.update(rows)
        keys, lang = np.array([len(p) for _, p in rows], np.uint64), np.array(["de".index(x) for x, _ in rows])
        held = pa.array([p.encode() + b"\n" for _, p in rows], pa.binary())
        some, counts = phrases._distinct(keys, lang, held)
        for code, name in enumerate("de"):
            own = lang[some] == code
            met.setdefault(name, phrases._Met()).add(keys[some[own]], counts[own], held.take(pa.array(some[own])))
    got = Counter()
    for name, own in met.items():
        for part, many, size, packed, counts in own.handed_on(2):
            found = pa.decompress(packed, size, "zstd", asbytes=True).decode().split("\n")[:-1]
            assert len(found) == many and {len(p) % 2 for p in found} == {part}
            for phrase, f in zip(found, phrases._counts(counts, many).tolist(), strict=True):
                got[name, phrase] += f
    assert got == want
