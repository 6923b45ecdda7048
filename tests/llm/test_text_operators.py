"""Tokens, main text, quality rules, toxicity, personal data: against libraries, brute force and hand-made cases."""

import base64
import hashlib
import html
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumisift.llm import byte_bpe, html_text, pii, quality, toxicity
from lumisift.llm.token_counts import counter, fits, token_counts, truncated

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = "a é 's ' l ll 'll 1 ² Ⅷ ! ? <|endoftext|> <|endof 😀 𐐀 中 don't the ing tion ▁ <unk>".split() + [" ", "  ", "\n", "\x1c", "\x00", "　", "\x85"]
SMALL = "/root/testdata/sf0.001"


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def edge_rows():
    """Null, empty, very long, repeated and tied texts, with a null id."""
    return [(1, None), (2, ""), (3, "word " * 30_000), (4, "same text"), (4, "same text"), (None, "no id"), (5, "same text")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_counts_agree_with_the_library_at_every_prefix(library):
    own = counter(JSON)
    size = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    for text in odd_texts(300, 1):
        assert own.prefixes(text) == [size(text[:i]) for i in range(len(text) + 1)]
        assert own.count_all([text, " " + text, text + " a  b"]) == [size(text), size(" " + text), size(text + " a  b")]


def test_counts_survive_forgetting(library, monkeypatch):
    monkeypatch.setattr("lumisift.llm.token_counts.REMEMBERED", 3)
    texts = odd_texts(50, 2)
    assert counter(JSON).count_all(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_truncation_is_the_longest_prefix_in_budget(spark, library):
    table = counter(JSON).prefixes("the thing, the tion  and more")
    for budget in range(8):
        n = fits(table, budget)
        assert table[n] <= budget and all(x > budget for x in table[n + 1 :])
    cut = truncated(frame(spark, [(1, "one two three four"), (2, None)]), JSON, 2).orderBy("doc_id").collect()
    assert [(r.text, r.n_tokens) for r in cut] == [("one two", 2), ("", 0)]


def test_token_table_cases(spark, library):
    rows = [(i, t, "x", 9) for i, t in edge_rows()]
    out = token_counts(frame(spark, rows, "doc_id bigint, text string, n_tokens string, id int"), JSON, 1024)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = Counter(map(tuple, out.collect()))
    size = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == Counter((i, len((t or "").encode()), size(t), size(t) > 1024) for i, t in edge_rows())
    assert token_counts(frame(spark, []), JSON, 1).count() == 0


@pytest.fixture(scope="module")
def rank_encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_agrees_with_the_library(rank_encoder):
    own = byte_bpe.coder(RANKS)
    texts = odd_texts(2000, 3)
    for text, packed in zip(texts, own.encode_all(texts), strict=True):
        assert list(memoryview(packed).cast("I")) == rank_encoder.encode_ordinary(text)
        assert own.decode(packed) == text.encode()


def test_every_token_of_the_vocabulary_is_itself():
    own = byte_bpe.coder(RANKS)
    whole = [t.decode() for t in own.tokens if t.decode("utf-8", "ignore").encode() == t]
    single = [t for t in whole if own.pieces(t) == [t]]
    assert len(single) > 40_000
    assert [own.encode(t) for t in single[:3000]] == [[own.ids[t.encode()]] for t in single[:3000]]


def test_encoding_table_cases(spark, rank_encoder):
    rows = [(i, t, "x") for i, t in edge_rows()]
    docs = frame(spark, rows, "doc_id bigint, text string, ids string")
    got = Counter(map(tuple, byte_bpe.digests(docs, RANKS).collect()))
    pack = lambda t: np.array(rank_encoder.encode_ordinary(t or ""), "<u4").tobytes()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == Counter((i, len(pack(t)) // 4, sha(pack(t)), sha((t or "").encode())) for i, t in edge_rows())
    back = byte_bpe.decoded(byte_bpe.encoded(docs, RANKS), RANKS).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t in edge_rows())
    assert byte_bpe.encoded(frame(spark, []), RANKS).count() == 0


PAGES = [
    ("<body><nav>x y</nav><div>One <b>bo</b>ld&nbsp;&amp amp<br>two<p>three</div><!-- c --><script>if(a<b){'</p>'}</script>tail", "One bold & amp two three tail"),
    ("<article><header>By me<h1>Title</h1></header><p>a<aside>b</aside>c<p class='ad'>x</p><div id=comments><p>no</p></div><form>f</form>d</article>after", "Title a c d"),
    ("<main>x<article>y</article>z</main>w", "x y z"),
    ("<div hidden>h</div>v<img alt='a>b'>w<!-- open", "vw"),
    ("a < b <", "a < b <"), ("", ""), (None, ""),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text_by_markup(page, text):
    main, words, open_ = html_text.tokens(page)
    assert (" ".join(w for w, o in zip(words, open_, strict=True) if o) if main is None else main) == text


def test_repeated_runs_of_a_host_go_and_unique_ones_stay(spark):
    menu = "home news about us contact imprint terms"
    rows = [(i, "http://a.example/x", f"<body><p>{menu}<p>p{i} has only words{i} of{i} its own{i}</body>") for i in range(4)]
    rows += [(9, "http://b.example/", f"<p>{menu}"), (10, None, None), (11, "http://[bad", "<article>kept " + menu)]
    rows += [rows[0]]
    out = html_text.main_text(frame(spark, [(*r, "x") for r in rows], "page_id bigint, url string, html string, text string"))
    got = Counter((r.page_id, r.text, r.n_chars) for r in out.collect())
    want = [(i, f"p{i} has only words{i} of{i} its own{i}") for i in range(4)] + [(9, menu), (10, ""), (11, "kept " + menu), (0, "p0 has only words0 of0 its own0")]
    assert got == Counter((i, t, len(t)) for i, t in want)
    assert html_text.main_text(frame(spark, [], "page_id bigint, url string, html string")).count() == 0


def test_pages_without_article_agree_with_ranked_suffixes(spark):
    """Suffixes of each host are sorted; where neighbours' common prefix is six tokens or more in a row and they begin
    on distinct pages, those six tokens of all of them go."""
    rng = random.Random(4)
    pages = {}
    for i in range(60):
        shared = [" ".join(f"s{k}w{j}" for j in range(3 + 2 * k)) for k in range(5)]
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(f"u{rng.randint(0, 3)}" for _ in range(rng.randint(1, 9))) for _ in range(6)]
        pages[i] = (f"http://h{i % 3}.example/{i}", parts)
    want, n = {}, html_text.RUN
    for host in range(3):
        words = {i: " ".join(parts).split() for i, (_, parts) in pages.items() if i % 3 == host}
        order = sorted((w[k:], i, k) for i, w in words.items() for k in range(len(w)))
        gone, group = set(), []
        for x in [*order, ([], None, 0)]:
            if group and (len(x[0]) < n or x[0][:n] != group[-1][0][:n]):
                if len({i for _, i, _ in group}) > 1:
                    gone |= {(i, k + d) for _, i, k in group for d in range(n)}
                group = []
            group += [x] if len(x[0]) >= n else []
        want |= {i: " ".join(w for k, w in enumerate(ws) if (i, k) not in gone) for i, ws in words.items()}
    rows = [(i, url, "<body>" + "".join(f"<p>{p}</p>" for p in parts) + "</body>") for i, (url, parts) in pages.items()]
    got = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows, "page_id bigint, url string, html string")).collect()}
    assert got == want and any(want.values()) and want != {i: " ".join(p) for i, (_, p) in pages.items()}


def test_suffix_arrays_are_sorted_with_common_prefixes(spark):
    rng = random.Random(6)
    texts = {i: [f"u{rng.randint(0, 2)}" for _ in range(rng.randint(0, 40))] for i in range(40)}
    pages = [(i, 0, f"http://h{i % 2}.example/", "<p>" + " ".join(words)) for i, words in texts.items()]
    found = html_text.suffixes(frame(spark, pages, "id bigint, version bigint, url string, html string"))
    rows = sorted(html_text.suffix_array(found).collect(), key=lambda r: r["rank"])
    cut = lambda i: {tuple(texts[i][k : k + html_text.DEPTH]) for k in range(len(texts[i]) - html_text.RUN + 1)}
    want = sorted({(f"h{i % 2}.example", *suffix) for i in texts for suffix in cut(i)})
    got = [(r.host, *r.suffix.decode().split("\x1f")) for r in rows]
    assert got == want
    for r, row in zip(rows, want, strict=True):
        held = [i for i in texts if f"h{i % 2}.example" == row[0] and row[1:] in cut(i)]
        assert (r.a, r.b) == (min(held), max(held))
    for (x, y), above, r in zip(zip(want, want[1:]), rows, rows[1:]):  # noqa: B905
        shared = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y))) - 1 if x[0] == y[0] else 0  # noqa: B905
        assert r.common == (shared if above["rank"] + 1 == r["rank"] else 0)
    repeated = {(r.host, r.key) for r in html_text.repeated_runs(html_text.suffix_array(found)).collect()}
    pages_of = {}
    for r in found.collect():
        pages_of.setdefault((r.host, r.key), set()).add(r.id)
    assert repeated == {k for k, ids in pages_of.items() if len(ids) > 1} and len(repeated) < len(pages_of)


LOST = [
    ("<article><p class='ad'>buy<p>real text<p>more</article>", "real text more"),
    ("<article><ul><li class=share>s<li>real <b>item</ul>end</article>", "real item end"),
    ("<article><table><tr><td class=ad>x<td>y<tr><td>z</table><dl><dt class=promo>p<dd>q</dl></article>", "y z q"),
    ("<main> </main><p>all of it", "all of it"),
    ("<article><div class=comments><p>a<div>b</div><p>c</div>d</article>", "d"),
]


@pytest.mark.parametrize("page,text", LOST)
def test_main_text_behind_implied_ends_and_empty_elements(page, text):
    main, words, open_ = html_text.tokens(page)
    assert (" ".join(w for w, o in zip(words, open_, strict=True) if o) if main is None else main) == text


def test_many_stray_end_tags_take_no_time():
    page = "<b>" * 20_000 + "</i>" * 20_000 + "<p>x"
    began = time.monotonic()
    assert html_text.tokens(page)[1] == ["x"] and time.monotonic() - began < 5


def test_whole_pages_take_part_in_the_suffixes_of_a_host(spark):
    """Main text is there with everything else: what is on half of the host's pages goes, passages that a few share stay,
    and open text stays if another page has it as main text."""
    notice, shared = "sign up here for our weekly letter today", "as the old saying goes there is no free lunch"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(8))
    rows = [(i, "http://a.example/", f"<nav>n{i} m</nav><article><p>{own(i)}<p>{notice if i < 10 else 'z'}<p>{shared if i < 7 else 'z'}</article>") for i in range(18)]
    rows += [(i, "http://a.example/", f"<p>{own(i)}<p>{shared}<p>q{i}<p>{notice}") for i in (18, 19)]
    rows += [(20 + i, "http://b.example/", f"<article>{own(i)} {notice}</article>") for i in range(9)]
    got = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows, "page_id bigint, url string, html string")).collect()}
    want = {i: f"{own(i)}{'' if i < 10 else ' z'} {shared if i < 7 else 'z'}" for i in range(18)}
    want |= {i: f"{own(i)} {shared} q{i}" for i in (18, 19)} | {20 + i: f"{own(i)} {notice}" for i in range(9)}
    assert got == want
    pages = [(i, 0, url, page) for i, url, page in rows]
    found = html_text.suffixes(frame(spark, pages, "id bigint, version bigint, url string, html string")).collect()
    words = {i: html_text.marked(page)[0] for i, _, page in rows}
    assert sorted((r.id, r.start) for r in found) == sorted((i, k) for i in words for k in range(len(words[i]) - html_text.RUN + 1))


def test_main_text_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.main_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = re.sub(r"<(p|/p|h1|/h1|br)>", " ", article).replace("<b>", "").replace("</b>", "")
        assert r.text == " ".join(html.unescape(blocks).split())


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "é#", "\n", "x|y", "\x0b", "\xa0"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += edge_rows()
    docs = frame(spark, [(i, t, None, "x") for i, t in rows], "doc_id bigint, text string, lang string, stratum string")
    labels = frame(spark, [], "doc_id bigint, quality int")
    got = Counter(tuple(r)[:6] for r in quality.quality(docs, labels).collect())
    assert got == Counter((i, *brute_counts(t)) for i, t in rows)
    assert quality.quality(docs.limit(0), labels).count() == 0


def binomial_tail(n, k, p):
    from math import comb

    return sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_binomial_tail(spark):
    rows = frame(spark, [(50, 0), (200, 3), (900, 20)], "n bigint, k bigint")
    for r in rows.select("n", "k", F.exp(quality.log_tail(F.col("n"), F.col("k"), F.lit(0.05))).alias("p")).collect():
        assert r.p == pytest.approx(binomial_tail(r.n, r.k, 0.05), rel=1e-9)


def test_cutoffs_are_those_of_the_fixed_sequence(spark):
    rng = random.Random(8)
    rows = [(i, "w " * 60 + "!" * (rng.randint(0, 9) * (i % 40 == 0)), "l0" if i % 3 else "l1") for i in range(6000)]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string")
    labels = frame(spark, [(i, 1) for i, _, _ in rows] + [(0, 0), (7, None), (99999, 1)], "doc_id bigint, quality int")
    got = {(r.stratum, r.rule): r.cutoff for r in quality.cutoffs(quality.signals(docs), labels, 0.05, 0.05).collect()}
    share, error = 0.05 / len(quality.GRID), 0.05 / len(quality.GRID) / 2
    for stratum in ("l0", "l1"):
        values = [t.count("!") / len(t.split()) for i, t, s in rows if s == stratum and i != 0]
        best = None
        for cut in quality.GRID["shouts_per_word"]:
            if binomial_tail(len(values), sum(v > cut for v in values), share) > error:
                break
            best = cut
        assert got.get((stratum, "shouts_per_word")) == best


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(3)
    bad = ["zorg", "vlim", "quash"]
    rows, labels = [], []
    for i in range(1500):
        words = [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randint(0, 59)] = rng.choice(bad)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows + [(5000, None, None), (5001, "", "xx"), (5002, "b " * 250_000 + "zorg", "en"), (None, "a", "en")], "doc_id bigint, text string, lang string")
    marks = frame(spark, labels + [(3, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks, lang_col="lang")
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert len(scores) == 1504 and all(0 <= s <= 1 for s in scores.values())
    held = {r.doc_id for r in docs.where(toxicity.remainder("doc_id") == 1).select("doc_id").collect()} & set(range(1500))
    right = sum((scores[i] >= 0.7) == (i % 4 == 0) for i in held)
    assert len(held) > 400 and right / len(held) > 0.95
    assert scores[5002] > 0.7 > scores[5000] == scores[5001]
    assert 0.05 <= model.thresholds["en"] <= 0.95
    empty = toxicity.fit(docs, marks.limit(0))
    assert all(r.score < 0.5 for r in toxicity.scored(docs, empty).collect())
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_toxicity_gradients(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 20)
    model = toxicity.Convolution(1)
    model.table = np.random.default_rng(0).normal(0, 1, (21, toxicity.DIM)).astype(np.float32)
    model.table[20] = 0
    docs = [np.array([[1, 2, 3], [4, 5, 6]]), np.array([[7, 8, 9]] * 5), np.zeros((0, 3), int)]
    logits = model.logits([model.project(d) if len(d) else np.zeros((0, toxicity.FILTERS * 6), np.float32) for d in docs])
    memory: list = []
    loss = model.step(docs, np.array([1, 0, 0], np.float32), 0.0, memory)
    p = 1 / (1 + np.exp(-logits))
    assert loss == pytest.approx(-np.mean([np.log(p[0]), np.log(1 - p[1]), np.log(1 - p[2])]), rel=1e-3)
    before = model.step(docs, np.array([1, 0, 0], np.float32), 0.05, memory)
    for _ in range(20):
        after = model.step(docs, np.array([1, 0, 0], np.float32), 0.05, memory)
    assert after < before


MAIL = "Mr. John Smith wrote to maria.lopez@mail.example.com, +1 (487) 555-7209 or 4111 1111 1111 1111; Frau Weber at 10.1.2.3."


def test_surrogates_keep_type_format_and_coreference():
    maker = pii.Surrogates("k")
    found = pii.entities(MAIL + ' Пётр Иванов. TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" GB82 WEST 1234 5698 7654 32')
    made = {k: [] for k in pii.KINDS}
    for kind, value, a, b in found:
        text = (MAIL + ' Пётр Иванов. TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" GB82 WEST 1234 5698 7654 32')[a:b]
        new = maker.of(kind, value, text)
        assert new != text
        made[kind].append(new)
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", made["phone"][0])
    assert pii._luhn([int(c) for c in made["card"][0] if c.isdigit()]) and re.fullmatch(r"\d{4}( \d{4}){3}", made["card"][0])
    assert made["email"][0].endswith(".com") and pii._mod97(made["iban"][0].replace(" ", "")) == 1
    assert made["secret"][0].isupper() and len(made["secret"][0]) == 40
    assert made["name"][0].split()[0] in pii.GIVEN["latin", "m"] and made["name"][2].split()[0] in pii.GIVEN["cyrillic", "m"]
    assert maker.of("email", "a@b.example", "a@b.example").upper() == maker.of("email", "a@b.example", "A@B.EXAMPLE")
    assert maker.of("name", "latin|m|John|smith", "John Smith").split()[0] == maker.of("name", "latin|m|John|", "John")
    assert [e[0] for e in pii.entities("see 233.233.171.252, version 3.0.")] == ["ip"] and pii.entities("") == []


def test_names_next_to_punctuation():
    """No name stands as a word between spaces; each is found by itself and where an unrelated name does so."""
    names = {"Maria Lopez": "latin|f|Maria|lopez", "Anna": "latin|f|Anna|", "John Smith": "latin|m|John|smith", "Пётр": "cyrillic|m|Пётр|"}
    signs = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "_"] + list("«»“”„‘’—–…¿¡、。\u00a0\u200b")
    for name, value in names.items():
        for c in signs:
            for text in (f"{c}{name}{c}", f"from {name.split()[0]}{c}" if " " not in name else f"Name{c}{name}{c}", f"{c}{name}"):
                assert [e[1] for e in pii.entities(text) if e[0] == "name"] == [value], text
                assert [e[1] for e in pii.entities(text + " and Karl here") if e[0] == "name"] == [value, "latin|m|Karl|"]
    for title in pii.ADDRESS:
        assert [e[1].split("|")[3] for e in pii.entities(f'("{title} Weber")')] == ["weber"], title
    assert pii.entities("Annabel, _Anna_ Anna1 Mariano") == []


def test_given_names_keep_apart(spark):
    for key in map(str, range(50)):
        maker = pii.Surrogates(key)
        for (script, gender), names in pii.GIVEN.items():
            made = [maker.of("name", f"{script}|{gender}|{n}|", n) for n in names]
            assert sorted(made) == sorted(names) and all(a != b for a, b in zip(made, names, strict=True))
            whole = [maker.of("name", f"{script}|{gender}|{n}|weber", f"{n} Weber").split()[0] for n in names]
            assert whole == made
    assert len({pii.Surrogates(key).given["Anna"] for key in map(str, range(50))}) > 10
    names = pii.GIVEN["latin", "f"]
    out = pii.pseudonymised(frame(spark, [(1, ", ".join(names) + "."), (2, f"({names[0]})")]), "k").orderBy("doc_id").collect()
    made = re.findall(r"\w+", out[0].text)
    assert out[0].n_name == len(set(made)) == len(names) and out[1].text == f"({made[0]})"


def test_collisions_are_drawn_again(spark):
    """Thirty of a hundred two-digit numbers leave seventy surrogates, so many draws collide."""
    values = [f"{i:02d}" for i in range(30)]
    found = frame(spark, [(i, "number", v) for i, v in enumerate(values)] * 2, "id bigint, kind string, value string")
    again = {r.value: r.attempt for r in pii.replacements(found, "k").collect()}
    made = [pii.Surrogates("k").of("number", v, v, again.get(v, 0)) for v in values]
    assert again and len(set(made)) == len(made) and not set(made) & set(values)


def test_pseudonymised_table(spark):
    rows = edge_rows() + [(20, MAIL), (21, "again maria.lopez@mail.example.com"), (None, "1.2.3.4")]
    out = pii.pseudonymised(frame(spark, [(i, t, "x") for i, t in rows], "doc_id bigint, text string, kind string"), "k")
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].text is None and by[4].text == "same text" and by[20].n_entities == 6 and by[20].n_email == 1
    mail = re.search(r"\S+@\S+[a-z]", by[20].text)[0]
    assert mail != "maria.lopez@mail.example.com" and by[21].text == f"again {mail}"
    assert not any(x in by[20].text for x in ("John", "Smith", "Weber", "4111", "10.1.2.3"))
    assert sorted(r.n_ip for r in got if r.doc_id is None) == [0, 1]
    assert pii.pseudonymised(frame(spark, []), "k").count() == 0
