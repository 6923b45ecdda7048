"""Language identification: a convolutional network over bytes, trained in numpy, applied to windows of fixed length.

A byte has an embedding; filters of several widths slide over a window of `WINDOW` bytes, each keeps its largest
response, and a softmax layer over those gives the languages' probabilities. Windows of a text overlap by the widest
filter less one byte, so every run of bytes that a filter can see lies in one of them, however long the text is. A
text's language has the largest mean log-probability over its windows, weighted by how many bytes they hold.

The model is fitted on the driver on a bounded sample: at most `FIT_DOCS` documents of a language, at most `FIT_ALL` in
all, at most `FIT_WINDOWS` windows of a document, spread over its whole text. Scoring is a map over all documents:
windows are cut from a whole Arrow batch at once and go through the network in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.llm.byte_pieces import small
from lumisift.llm.byte_words import flat
from lumisift.llm.workers import hold
from lumisift.operators.topk import top_n_per_group

#: Bytes of a window, width of an embedding, filters of each width, and the widths.
WINDOW, DIM, FILTERS, WIDTHS = 256, 8, 16, (2, 3, 4)
#: Bounds of the sample: documents of a language, documents in all, windows of a document.
FIT_DOCS, FIT_ALL, FIT_WINDOWS = 400, 20_000, 6
#: Windows that go through the network together.
BLOCK = 128
#: Stands behind the end of a text; byte values are below.
PAD = 256
#: The language of a text without letters.
UNDETERMINED = "und"
_EDGE = max(WIDTHS) - 1
_STRIDE = WINDOW - _EDGE


def remainder(id_col: str | Column) -> Column:
    """crc32 of an id as text, modulo 5: 0 is held out. A null id counts as the empty text, which is held out."""
    of = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(of.cast("string"), F.lit("")).cast("binary")) % 5


def windows(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text of every window of texts that begin and end at `at`; an empty text has none."""
    size = np.diff(at)
    many = np.where(size > 0, np.maximum(1, -(-(size - _EDGE) // _STRIDE)), 0)
    text = np.repeat(np.arange(len(size)), many)
    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    first = at[text] + place * _STRIDE
    return first, np.minimum(first + WINDOW, at[text + 1]), text


def block(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(WINDOW x windows) bytes, `PAD` behind a window's end."""
    place = first + np.arange(WINDOW)[:, None]
    return np.where(place < end, raw[np.minimum(place, len(raw) - 1)], PAD)


class ByteConvolution:
    """Embeddings of bytes, filters, and a softmax layer over the languages."""

    def __init__(self, langs: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.table = np.concatenate([rng.normal(0, 0.5, (256, DIM)), np.zeros((1, DIM))]).astype(np.float32)
        # row k of a filter meets the byte k behind its place; narrower filters have zeros in the rows beyond their width
        self.filters = rng.normal(0, 0.3, (max(WIDTHS), DIM, FILTERS * len(WIDTHS))).astype(np.float32)
        self.mask = np.zeros_like(self.filters)
        for i, w in enumerate(WIDTHS):
            self.mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.filters *= self.mask
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.shift = np.zeros(len(langs), np.float32)

    def responses(self, ids: np.ndarray) -> np.ndarray:
        """(places x windows x filters), before the bias; the filters of a place see the bytes from there on."""
        x = self.table[ids]
        wide = np.concatenate([x[k : WINDOW - _EDGE + k] for k in range(_EDGE + 1)], 2)
        return wide @ self.filters.reshape(-1, self.filters.shape[2])

    def top(self, ids: np.ndarray) -> np.ndarray:
        return np.maximum(self.responses(ids).max(0) + self.bias, 0)

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        logit = self.top(ids) @ self.out + self.shift
        logit -= logit.max(1, keepdims=True)
        return logit - np.log(np.exp(logit).sum(1, keepdims=True))

    def fit(self, ids: np.ndarray, lang: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.004, steps: int = 300) -> None:
        """Adaptive gradient steps on shuffled windows, at least `steps` of them; gradients flow through the largest
        responses."""
        rng = np.random.default_rng(9)
        share = len(lang) / (len(self.langs) * np.maximum(1, np.bincount(lang, minlength=len(self.langs))))
        names = ["table", "filters", "bias", "out", "shift"]
        mean = {n: np.zeros_like(getattr(self, n)) for n in names}
        square = {n: np.zeros_like(getattr(self, n)) for n in names}
        step = 0
        for _ in range(max(epochs, -(-steps // -(-len(lang) // batch)))):
            order = rng.permutation(len(lang))
            for i in range(0, len(order), batch):
                step += 1
                own = order[i : i + batch]
                for name, grad in zip(names, self._gradients(ids[:, own], lang[own], share[lang[own]]), strict=True):
                    mean[name] = 0.9 * mean[name] + 0.1 * grad
                    square[name] = 0.999 * square[name] + 0.001 * grad * grad
                    move = rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-7)
                    setattr(self, name, (getattr(self, name) - move).astype(np.float32))
                self.filters *= self.mask
                self.table[PAD] = 0

    def _gradients(self, ids: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        y = self.responses(ids)
        at = y.argmax(0)
        raw = np.take_along_axis(y, at[None], 0)[0] + self.bias
        top = np.maximum(raw, 0)
        logit = top @ self.out + self.shift
        p = np.exp(logit - logit.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(lang)), lang] -= 1
        d = (p * weight[:, None] / len(lang)).astype(np.float32)
        d_top = (d @ self.out.T) * (raw > 0)
        d_filters, d_table = np.zeros_like(self.filters), np.zeros_like(self.table)
        column = np.arange(ids.shape[1])[:, None]
        for k in range(_EDGE + 1):
            seen = ids[at + k, column]
            d_filters[k] = np.einsum("nfd,nf->df", self.table[seen], d_top)
            np.add.at(d_table, seen, d_top[:, :, None] * self.filters[k].T)
        return [d_table, d_filters, d_top.sum(0), top.T @ d, d.sum(0)]

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and its probability for every text of a column; empty texts take the first."""
        raw, at = flat(column)
        first, end, text = windows(raw, at)
        total, weight = np.zeros((len(column), len(self.langs))), np.zeros(len(column))
        for i in range(0, len(first), BLOCK):
            part = slice(i, i + BLOCK)
            size = (end[part] - first[part]).astype(float)
            np.add.at(total, text[part], self.log_probabilities(block(raw, first[part], end[part])) * size[:, None])
            np.add.at(weight, text[part], size)
        mean = total / np.maximum(weight, 1)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def _spread(many: int) -> list[int]:
    """Windows that a text of `many` gives to the sample: all, or `FIT_WINDOWS` at equal distances over the whole text."""
    return list(range(many)) if many <= FIT_WINDOWS else [(2 * i + 1) * many // (2 * FIT_WINDOWS) for i in range(FIT_WINDOWS)]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteConvolution:
    """A model fitted on a bounded sample of documents outside the held-out fifth, with a language and a text that has a
    letter. Documents are taken in the order of a hash of their id, so the sample does not depend on how rows are dealt;
    of repeated ids any row may be taken."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    known = known.where(F.col("lang").isNotNull() & (remainder("id") != 0) & F.col("text").rlike(r"\p{L}"))
    names = known.select("id", "lang").distinct()
    ranked = top_n_per_group(names, ["lang"], [F.xxhash64("id"), F.col("id")], FIT_DOCS, ["id"])
    chosen = ranked.orderBy("rank", "lang").limit(FIT_ALL).select("id", "lang")
    few = known.join(F.broadcast(chosen), ["id", "lang"])  # at most FIT_ALL rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 100):
            raw, at = flat(batch.column(1))
            first, end, text = windows(raw, at)
            begin = np.searchsorted(text, np.arange(batch.num_rows + 1))
            own = [begin[i] + j for i in range(batch.num_rows) for j in _spread(int(begin[i + 1] - begin[i]))]
            cuts = [raw[first[i] : end[i]].tobytes() for i in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[own])), pa.array(cuts, pa.binary())], ["lang", "bytes"])

    sample = few.select(F.col("lang").cast("string"), "text").mapInArrow(cut, "lang string, bytes binary").distinct().toArrow()
    langs = sorted(set(sample["lang"].to_pylist()))
    model = ByteConvolution(langs)
    if len(langs) > 1:
        sample = sample.sort_by([("lang", "ascending"), ("bytes", "ascending")])
        raw, at = flat(sample["bytes"].combine_chunks().cast(pa.large_binary()))
        place = {lang: i for i, lang in enumerate(langs)}
        model.fit(block(raw, at[:-1], at[1:]).astype(np.int16), np.array([place[x] for x in sample["lang"].to_pylist()]))
    return model


def identified(docs: DataFrame, model: ByteConvolution, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every text and how probable it is (`id, lang_pred, score`).

    A null text and one without a letter are `und` with score 0, as is everything if the model knows no language; a model
    of one language gives it with score 1. Texts of any length are read whole; repeated rows stay, other columns are
    left out whatever their names, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of constant size but for the names of the languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("language", int)
        own = shared.value
        for batch in small(batches):
            text = batch.column(1)
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            lang, score = np.array([UNDETERMINED] * len(text), object), np.zeros(len(text))
            if own.langs:
                best, p = own.predict(text)
                lang[letters], score[letters] = np.array(own.langs, object)[best[letters]], p[letters]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
