"""Language identification: windows, the network against a plain computation, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pyarrow as pa

from lumisift.llm import language, queries
from lumisift.llm.byte_words import flat

SMALL = "/root/testdata/sf0.01"


def test_windows_cover_every_run_of_bytes():
    for size in (0, 1, 3, 255, 256, 257, 300, 1000, 5000):
        raw, at = flat(pa.array(["x" * 7, "y" * size, "z"]))
        first, end, text = language.windows(raw, at)
        own = [(a, b) for a, b, t in zip(first.tolist(), end.tolist(), text.tolist(), strict=True) if t == 1]
        assert all(7 <= a < b <= 7 + size and b - a <= language.WINDOW for a, b in own)
        starts = {s for a, b in own for s in range(a, b - max(language.WIDTHS) + 1)}
        assert starts == set(range(7, 7 + size - max(language.WIDTHS) + 1)) and bool(own) == (size > 0)


def test_responses_are_those_of_filters_of_each_width():
    model = language.ByteConvolution(["a", "b"])
    raw, at = flat(pa.array(["héllo wörld " * 40]))
    ids = language.block(raw, *language.windows(raw, at)[:2])
    top = model.top(ids)
    for j in range(ids.shape[1]):
        x = model.table[ids[:, j]]
        for i, w in enumerate(language.WIDTHS):
            f = model.filters[:w, :, i * language.FILTERS : (i + 1) * language.FILTERS]
            y = np.stack([np.einsum("kd,kdf->f", x[s : s + w], f) for s in range(language.WINDOW - max(language.WIDTHS) + 1)])
            assert np.allclose(np.maximum(y.max(0), 0), top[j, i * language.FILTERS : (i + 1) * language.FILTERS], atol=1e-4)


def test_gradients_agree_with_differences():
    model = language.ByteConvolution(["a", "b", "c"])
    rng = np.random.default_rng(1)
    ids, lang, weight = rng.integers(0, 257, (language.WINDOW, 5)), np.array([0, 1, 2, 0, 1]), np.ones(5)
    loss = lambda: -np.mean(model.log_probabilities(ids)[np.arange(5), lang])
    model.table, model.filters = model.table.astype(np.float64), model.filters.astype(np.float64)
    grads = dict(zip(["table", "filters", "bias", "out", "shift"], model._gradients(ids, lang, weight), strict=True))
    for name, at in [("table", (65, 2)), ("filters", (1, 3, 20)), ("bias", (7,)), ("out", (5, 1)), ("shift", (2,))]:
        value = getattr(model, name).astype(np.float64)
        setattr(model, name, value)
        kept, step = value[at], 1e-5
        value[at] = kept + step
        up = loss()
        value[at] = kept - step
        down = loss()
        value[at] = kept
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-3


def test_held_out_languages_are_recognised(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = queries.QUERIES["op11_language_id"](spark, SMALL).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r for r in rows if r.held_out and len(r.text) >= 40]
    assert len(judged) > 100 and sum(r.lang == r.lang_pred for r in judged) >= 0.97 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, x, "clash") for i, t, x in rows], "doc_id bigint, text string, lang string, id string")


def test_edge_cases(spark):
    prose = {"en": "the cat and the dog went to the house ", "de": "der Hund und die Katze gingen nach Hause "}
    learnt = [(i, prose[x] * (1 + i % 3), x) for i in range(200) for x in (("en", "de")[i % 2],)]
    odd = [(900, None, "en"), (901, "", "de"), (902, " 12 .,;", "en"), (None, prose["de"], "de"), (903, prose["de"] * 20_000, None), (903, prose["en"], "en")]
    docs = documents(spark, learnt + odd)
    model = language.fit(docs)
    assert model.langs == ["de", "en"]
    rows = language.identified(docs, model).collect()
    assert len(rows) == 206
    got = [(r.doc_id, r.lang_pred) for r in rows if r.doc_id is None or r.doc_id >= 900]
    assert sorted(got, key=str) == sorted([(900, "und"), (901, "und"), (902, "und"), (None, "de"), (903, "de"), (903, "en")], key=str)
    empty = documents(spark, [])
    assert language.identified(empty, language.fit(empty)).count() == 0
    none = language.fit(documents(spark, [(1, "text", None)]))
    assert [tuple(r) for r in language.identified(documents(spark, [(1, "text", None)]), none).collect()] == [(1, "und", 0.0)]
    one = language.fit(documents(spark, [(1, "text", "xx"), (2, "text", "xx"), (3, "text", "xx")]))
    assert [tuple(r) for r in language.identified(documents(spark, [(1, "text", None)]), one).collect()] == [(1, "xx", 1.0)]
