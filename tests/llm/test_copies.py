"""Copies, repeated strings and lines, leaked test items, the pipeline: against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from lumisift.llm import decontamination, line_dedup, near_dedup, suffix_dedup
from lumisift.llm.components import components

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeégh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(seed, n=60):
    """Texts with exact and near copies, shared lines and passages."""
    rng = random.Random(seed)
    shared = [prose(rng, 14) for _ in range(4)] + ["short one", "x"]
    rows = []
    for i in range(n):
        lines = [prose(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 6))]
        for _ in range(rng.randint(0, 3)):
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared))
        text = "\n".join(lines)
        if i > 5 and rng.random() < 0.4:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            text = " ".join(words)
        rows.append((i * 3, text))
    rows += [(500, None), (501, ""), (502, rows[3][1]), (503, "!" * 700 + "tail"), (504, "!" * 90), (505, "\n \n\t\n"), (506, "one"), (507, "One")]
    rng.shuffle(rows)
    return rows


def brute_substrings(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        own = [data[i : i + 50] for i in range(len(data) - 49)]
        gone = {i + k for i, w in enumerate(own) if w in seen for k in range(50)}
        seen.update(own)
        spans = sum(i - 1 not in gone for i in gone)
        out[doc] = (doc, len(data), len(gone), spans, hashlib.sha256(bytes(b for i, b in enumerate(data) if i not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("seed,part", [(1, 4_000_000), (2, 900)])
def test_substrings(spark, monkeypatch, seed, part):
    """`part` makes many shards of one table."""
    monkeypatch.setattr(suffix_dedup, "PART", part)
    rows = corpus(seed)
    docs = frame(spark, [(*r, "x") for r in rows], "doc_id bigint, text string, kept string").repartition(3)
    got = suffix_dedup.removed(docs).drop("kept").collect()
    want = brute_substrings([(d, t) for d, t in rows])
    assert {r.doc_id: tuple(r) for r in got} == want


def test_substring_cases(spark):
    long = "".join(random.Random(4).choice("abc") for _ in range(300))
    rows = [(1, long), (1, long), (2, long), (None, long), (3, long[:49]), (4, long[:50])]
    got = Counter((r.doc_id, r.n_removed) for r in suffix_dedup.removed(frame(spark, rows)).collect())
    assert got == Counter([(1, 0), (1, 0), (2, 300), (None, 0), (3, 0), (4, 50)])
    assert suffix_dedup.removed(frame(spark, [])).count() == 0


def test_suffix_order():
    import numpy as np

    rng = random.Random(2)
    parts = ["".join(rng.choice("ab\0") for _ in range(rng.randint(1, 30))).encode() for _ in range(40)]
    text = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.repeat(np.cumsum([len(p) for p in parts]), [len(p) for p in parts])
    left = ends - np.arange(len(text))
    want = sorted(range(len(text)), key=lambda i: (bytes(text[i : i + left[i]]), i))
    assert suffix_dedup.suffix_order(text, left).tolist() == want


def brute_classes(rows, width, percent=80):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (d, len(sets[d]), find(d), find(d) == d) for d in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rows = corpus(7, 90)
    docs = frame(spark, [(*r, "x") for r in rows], "doc_id bigint, text string, component_id string")
    got = {r.doc_id: tuple(r) for r in near_dedup.near_duplicates(docs, width=width).collect()}
    assert got == brute_classes(rows, width)


def test_chains_across_buckets_are_found(spark):
    """Each text replaces a little more of the one before: neighbours are alike, ends are not."""
    rng = random.Random(9)
    words = prose(rng, 120).split()
    rows = []
    for i in range(30):
        rows.append((i, " ".join(words)))
        words[(4 * i) % 120 : (4 * i) % 120 + 4] = prose(rng, 4).split()
    got = {r.doc_id: tuple(r) for r in near_dedup.near_duplicates(frame(spark, rows), width=2).collect()}
    assert got == brute_classes(rows, 2)


def test_lone_keys_reach_no_table(spark):
    """Of M * M tables a document takes part only in those whose two keys other documents have as well."""
    m = near_dedup.M
    rows = [(i, list(range(100 * i, 100 * i + m)), list(range(100 * i + m, 100 * i + 2 * m))) for i in range(50)]
    rows[7] = (7, [300, *rows[7][1][1:]], [300 + m, *rows[7][2][1:]])  # one key of each collection is document 3's
    heads = spark.createDataFrame(rows, "id bigint, first array<bigint>, second array<bigint>")
    got = near_dedup._tables(heads).collect()
    assert sorted(r.id for r in got) == [3, 7] and len({r.bucket for r in got}) == 1


def test_texts_are_thinned_before_they_are_shuffled(spark):
    docs = frame(spark, [(i, "x") for i in range(-2000, 2000)]).withColumnRenamed("doc_id", "id")
    asked = docs.where("id % 50 = 0").select("id")
    got = [r.id for r in near_dedup._among(docs, asked).collect()]
    assert set(range(-2000, 2000, 50)) <= set(got) and len(got) == len(set(got)) < 100
    assert near_dedup._among(docs, asked.limit(0)).count() == 0
    joined = near_dedup._among(docs, asked).join(asked, "id")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and plan.index("id#") < plan.index("bitmap_construct_agg") and plan.count("Join Inner") == 2
    assert {r.id for r in joined.collect()} == set(range(-2000, 2000, 50)) and joined.count() == 80


def test_near_duplicate_cases(spark):
    rows = [(2, "a b c"), (2, "a b c"), (None, "a b c"), (1, "a B c"), (3, None), (4, "")]
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows), width=2).collect())
    assert got[2, 1, False] == 2 and got[1, 1, True] == 1 and got[3, 3, True] == 1 and got[4, 4, True] == 1 and sum(got.values()) == 6
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7), (1, 2)]
    got = {r.node: r.root for r in components(frame(spark, edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100}


def brute_lines(rows, least):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        lines = (text or "").split("\n")
        used = [i for i, line in enumerate(lines) if line.encode().strip()]
        own, gone = [lines[i] for i in used], set()
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                if tuple(own[i:j]) in seen and sum(len(x.encode().split()) for x in own[i:j]) >= least:
                    gone.update(used[i:j])
            for j in range(i + 1, len(own) + 1):
                seen.add(tuple(own[i:j]))
        out[doc] = None if text is None else "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("least", [1, 10, 13])
def test_lines(spark, least):
    rng = random.Random(least)
    pool = ["a b c", "d e f g", "h", "i j k l m n o p q r s", " ", "t\tu"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.8 else prose(rng, 3) for _ in range(rng.randint(0, 12)))) for i in range(40)] + [(99, None)]
    docs = frame(spark, [(*r, "x", 5) for r in rows], "doc_id bigint, text string, n_lines string, gone int")
    out = line_dedup.without_repeats(docs, least)
    assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows, least)
    assert set(out.columns) == {"doc_id", "text", "n_lines", "gone", "n_removed"}


def test_line_cases(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(2, line), (2, line), (None, line), (1, f"{line}\n{line}\nrest"), (3, "")]
    got = Counter((r.doc_id, r.text) for r in line_dedup.without_repeats(frame(spark, rows)).collect())
    assert got == Counter([(2, ""), (2, ""), (None, line), (1, f"{line}\nrest"), (3, "")])
    assert line_dedup.without_repeats(frame(spark, [])).count() == 0


def test_what_is_left_is_put_together_without_python(spark):
    """Batches of whole texts in workers and Arrow buffers, beside the join, took an executor's memory."""
    out = line_dedup.without_repeats(frame(spark, corpus(5)))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "ArrowEvalPython" not in plan


def test_rest_of_a_text(spark):
    """Places count lines with a word; white space is that of ASCII, other blanks are words."""
    rng = random.Random(12)
    pool = ["a b", "", " ", "\t\r\x0b\x0c", "\x1c", "\u00a0", "\u2028x", "é\0", "c"]
    rows = [(0, None, [0]), (1, "", None), (2, "\n \n", None), (3, "a\nb\n", [1, 0]), (4, None, None)]
    for i in range(5, 200):
        text = "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 30)))
        n = len(line_dedup.split_lines(text)[1])
        rows.append((i, text, rng.sample(range(n), rng.randint(1, n)) if n else None))
    got = frame(spark, rows, "doc_id bigint, text string, gone array<int>")
    got = {r.doc_id: r.left for r in got.select("doc_id", line_dedup.rest(got.text, got.gone).alias("left")).collect()}
    want = {}
    for i, text, gone in rows:
        lines, used = line_dedup.split_lines(text)
        drop = {used[k] for k in gone or [] if text is not None}
        want[i] = None if text is None else "\n".join(line for k, line in enumerate(lines) if k not in drop)
    assert got == want


def test_lines_are_made_a_part_at_a_time(spark, monkeypatch):
    rows = corpus(3)
    docs = frame(spark, rows).withColumnRenamed("doc_id", "id").coalesce(1)
    whole = sorted(map(tuple, line_dedup.line_table(docs, 10).collect()))
    monkeypatch.setattr(line_dedup, "STRIDE", 7)
    assert sorted(map(tuple, line_dedup.line_table(docs, 10).collect())) == whole
    assert Counter(r[0] for r in whole) == Counter({d: n for d, t in rows if (n := len(line_dedup.split_lines(t)[1]))})


def brute_leaks(docs, items):
    out = set()
    for item, text in items:
        own = decontamination.shingles(decontamination.words_of(text or ""))
        for doc, body in docs:
            words = decontamination.words_of(body or "")
            spans = [set(decontamination.shingles(words[i : i + 128])) for i in range(0, max(1, len(words)), 64)]
            if own and any(len(own & s) >= 0.8 * len(own) for s in spans):
                out.add((doc, item))
    return out


def test_leaks(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(5, 50)) + ". " + prose(rng, 4) + ".") for i in range(30)] + [(50, None), (51, "too short"), (52, "")]
    docs = []
    for i in range(120):
        text = prose(rng, rng.randint(0, 300))
        if i % 3 == 0:
            words = rng.choice(items[:30])[1].split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = "changed"
            text = f"{text} {' '.join(words).upper()}\n{prose(rng, 90)}"
        docs.append((i, text))
    docs += [(200, None), (201, ""), (202, docs[0][1]), (202, docs[0][1])]
    table, bench = frame(spark, [(*d, "x") for d in docs], "doc_id bigint, text string, score string"), frame(spark, items, "item_id bigint, text string")
    got = [(r.doc_id, r.item_id) for r in decontamination.leaks(table, bench).collect()]
    want = brute_leaks(docs, items)
    assert set(got) == want and len(want) > 10
    assert sorted(i for d, i in got if d == 202) == sorted([i for d, i in got if d == 0] * 2)
    clean = decontamination.clean(table, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want} and clean.columns == table.columns
    assert decontamination.leaks(table, bench.limit(0)).count() == 0 and decontamination.leaks(table.limit(0), bench).count() == 0


def test_long_items_are_cut_and_found_whole(spark):
    rng = random.Random(2)
    item = prose(rng, 400)
    docs = [(1, prose(rng, 77) + " " + item + " " + prose(rng, 30)), (2, " ".join(item.split()[:200])), (3, prose(rng, 500))]
    got = decontamination.leaks(frame(spark, docs), frame(spark, [(7, item)], "item_id bigint, text string")).collect()
    assert [(r.doc_id, r.item_id, r.overlap) for r in got] == [(1, 7, 1.0)]


def test_leaks_agree_with_whole_documents(spark):
    """Items of 65 to 400 words of which 75 to 95 % are present, at one end, with words changed or in pieces far apart."""
    rng = random.Random(11)
    items = [(i, prose(rng, n)) for i, n in enumerate([65] * 8 + [rng.randint(66, 400) for _ in range(32)] + [30] * 10)]
    items += [(60, " ".join([prose(rng, 40)] * 3)), (61, "one two three four five " * 20 + prose(rng, 60))]
    docs = [(0, prose(rng, 20) + " " + " ".join(items[0][1].split()[:56]) + " " + prose(rng, 20))]
    for i in range(1, 300):
        words = rng.choice(items)[1].split()
        keep = round(len(words) * rng.uniform(0.75, 0.95))
        if i % 3 == 0:
            words = words[:keep]
        elif i % 3 == 1:
            for at in rng.sample(range(len(words)), max(1, (len(words) - keep) // 4)):
                words[at] = "changed"
        cut = sorted(rng.sample(range(len(words)), rng.randint(0, 3)))
        pieces = [" ".join(words[a:b]) for a, b in zip([0, *cut], [*cut, len(words)], strict=True)]
        docs.append((i, f" {prose(rng, rng.choice([90, 200]))} ".join(["", *pieces, ""])))
    held = {d: decontamination.shingles(decontamination.words_of(t)) for d, t in docs}
    wanted = {i: decontamination.shingles(decontamination.words_of(t)) for i, t in items}
    want = {(d, i, len(w & h) / len(w)) for d, h in held.items() for i, w in wanted.items() if 10 * len(w & h) >= 8 * len(w)}
    bench = frame(spark, items, "item_id bigint, text string")
    got = [(r.doc_id, r.item_id, r.overlap) for r in decontamination.leaks(frame(spark, docs), bench).collect()]
    assert Counter(got) == Counter(want) and 60 < len(want) < 290 and any(d == 0 for d, _, _ in want)
    left = {r.doc_id for r in decontamination.clean(frame(spark, docs), bench).collect()}
    assert left == held.keys() - {d for d, _, _ in want}


def test_parts_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = lambda: {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    whole = pairs()
    monkeypatch.setattr(decontamination, "INDEX_ITEMS", 13)
    assert pairs() == whole


def test_pipeline_stages(spark):
    """Each stage against brute force on what the one before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        kept[name] = docs
        assert name == "byte_bpe" or docs.columns == names
    rows = {n: [(r.doc_id, r.text) for r in d.collect()] for n, d in kept.items() if n != "byte_bpe"}
    source = dict(rows["toxicity"])
    assert dict(rows["line_dedup"]) == brute_lines(list(source.items()), 10)
    classes = brute_classes(rows["line_dedup"], 2)
    assert {d for d, _ in rows["near_dedup"]} == {d for d, c in classes.items() if c[3]}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute_leaks(rows["near_dedup"], bench)}
    assert {d for d, _ in rows["decontamination"]} == {d for d, _ in rows["near_dedup"]} - leaked
    digest = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows["decontamination"]}
    assert {r.doc_id: r.decoded_sha256 for r in kept["byte_bpe"].collect()} == digest
    assert defaultdict(int, {r.doc_id: 1 for r in corpus_pipeline.run(spark, SMALL).collect()}) == {d: 1 for d in digest}


def test_registered():
    names = set(entry_points.queries())
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {n.split("_")[0] for n in names}


def test_refinement_begins_with_one_row_for_each_window():
    rng, shards = np.random.default_rng(3), suffix_dedup.Shards(1)
    passage = bytes(rng.integers(97, 101, 200).astype(np.uint8))
    texts = [bytes(rng.integers(97, 101, n).astype(np.uint8)) + passage + b"x" * n for n in (0, 30, 90)]
    windows = set()
    for doc, text in enumerate(texts):
        at, key = suffix_dedup.runs(np.frombuffer(text, np.uint8))
        shards.add(doc, text, at[:-1], at[1:], key, {})
        windows |= {(text[a : b + suffix_dedup.WINDOW - 1], k) for a, b in zip(at[:-1], at[1:], strict=True) for k in range(b - a)}
    merge = suffix_dedup.Merge(list(shards.rows()))
    assert len(merge.begun()) == len(windows) < len(merge.before)
    assert {int(n) for n in merge.length} == {len(segment) for segment, _ in windows}


def test_suffixes_are_sorted_part_by_part():
    rng = random.Random(6)
    parts = ["".join(rng.choice("ab\0") for _ in range(rng.randint(1, 40))).encode() for _ in range(60)]
    text, length = np.frombuffer(b"".join(parts), np.uint8), [len(p) for p in parts]
    left = np.repeat(np.cumsum(length), length) - np.arange(len(text))
    part = np.repeat(np.arange(60) // 7, length)
    want = sorted(range(len(text)), key=lambda i: (part[i], bytes(text[i : i + left[i]]), i))
    assert suffix_dedup.suffix_order(text, left, part).tolist() == want


def test_equal_segments_are_settled_before_any_is_sorted(spark):
    """Of a passage in other surroundings each time, only segments at its ends differ and have to be sorted."""
    rng = random.Random(8)
    passage = prose(rng, 300)
    rows = [(i, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for i in (5, 3, 9, 7)]
    found = defaultdict(list)
    for r in suffix_dedup.repeated_segments(frame(spark, rows), 8).collect():
        found[r.id].append(r.segment & 1)
    in_passage = len(suffix_dedup.runs(np.frombuffer(passage.encode(), np.uint8))[1])
    assert sorted(found) == [3, 5, 7, 9] and all(sum(v) <= 6 for v in found.values())
    assert not found[3].count(0) and all(found[i].count(0) >= in_passage - 6 > 40 for i in (5, 7, 9))
    assert {r.doc_id: tuple(r) for r in suffix_dedup.removed(frame(spark, rows)).drop("kept").collect()} == brute_substrings(rows)


def test_texts_are_dealt_once(spark):
    out = suffix_dedup.removed(frame(spark, corpus(3)))
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
