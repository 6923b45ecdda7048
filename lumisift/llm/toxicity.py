"""Toxicity: a small convolutional text classifier in numpy, with thresholds calibrated by language.

A word's embedding is the sum of three rows of one table: two hashes of the word, so that two words rarely share both,
and one of its first four characters, so that unseen inflections of a known word are near it. Filters one, two and
three words wide slide over the whole text, each keeps its largest response, and a logistic layer weighs them. The
model is fitted in one task on a bounded sample of labelled documents (`FIT_ROWS` of either label), whose words arrive
as hashes. Of a longer one that isn't toxic `FIT_WORDS` words are used, in stretches at equal distances over the whole
text, as every part of it is not toxic either; a toxic one whose toxic part isn't known takes part in calibration only.
Calibration and thresholds rest on all labelled documents it was not fitted on, whole texts of every length, scored in Spark. Scoring is a map over all documents, whole texts of any
length, in pieces that overlap by the widest filter.

The first embedding dimension starts from how much more often a feature is seen in toxic documents of the sample
(each group of near copies counting once), the rest at random, and gradients flow through the largest responses only.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lumisift.llm.stored import stored
from lumisift.llm.workers import hold

#: Rows of the embedding table, its width, filters of each width, and the widths.
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 17, 8, 6, (1, 2, 3)
#: Bounds of the sample: documents of each label, words a document is fitted with, and stretches these are taken from.
FIT_ROWS, FIT_WORDS, STRETCHES = 5_000, 3_000, 6
#: Threshold of languages with fewer than `LEAST` toxic or other documents to calibrate on.
DEFAULT, LEAST = 0.7, 20
#: Words a worker remembers, and words scored at a time; both bound memory, never the result.
REMEMBERED, STRIDE = 150_000, 100_000
_WORD = re.compile(r"\w+")
_EDGE = max(WIDTHS) - 1


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> tuple[int, int, int]:
    raw = word.encode("utf-8", "replace")
    return zlib.crc32(raw) % BUCKETS, zlib.crc32(b"#" + raw) % BUCKETS, zlib.crc32(b"^" + word[:4].encode("utf-8", "replace")) % BUCKETS


def remainder(id_col: str | Column) -> Column:
    """crc32 of an id as text, modulo 3: 0 and 2 may be learnt from, 1 is held out."""
    return F.crc32(F.coalesce(F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(-1)).cast("string").cast("binary")) % 3


class Convolution:
    """Embeddings, filters and the logistic layer."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.table = np.concatenate([normal(BUCKETS, DIM) * 0.1, np.zeros((1, DIM), np.float32)])  # the last row pads
        self.filters = [normal(w, DIM, FILTERS) for w in WIDTHS]
        for f in self.filters:
            f[:, 0, :] += 0.5 / len(f)
        self.bias = [np.full(FILTERS, -0.3, np.float32) for _ in WIDTHS]
        self.out = np.full(FILTERS * len(WIDTHS), 0.5, np.float32)
        self.shift = np.float32(-1.0)
        self.scale = (1.0, 0.0)  # of the logit, set by calibration
        self.thresholds: dict[str, float] = {}  # by language, set by calibration

    def start(self, docs: list[np.ndarray], toxic: np.ndarray) -> None:
        """Set the first dimension from how far a feature's share of toxic documents is above its share of others."""
        sketch = [hash((bool(t), *np.sort(np.unique(d[:, 0].astype(np.int64) * 2654435761 % 4294967296))[:2].tolist())) for d, t in zip(docs, toxic, strict=True)]
        once = np.unique(sketch, return_index=True)[1]
        seen = [np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)]
        for i in once:
            seen[int(toxic[i])][np.unique(docs[i])] += 1
        n = [max(1, int((toxic[once] == t).sum())) for t in (0, 1)]
        share = (seen[0] + seen[1] + 0.5) / (n[0] + n[1] + 1)
        z = (seen[1] / n[1] - seen[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
        self.table[:BUCKETS, 0] = np.clip(z[:BUCKETS] / 8, -0.5, 1.5)

    def step(self, docs: list[np.ndarray], toxic: np.ndarray, rate: float, memory: list) -> float:
        """One pass over a batch: forward, backward, adaptive steps. Returns the loss."""
        size = np.array([max(len(d), 1) + _EDGE for d in docs])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        ids = np.full((size.sum(), 3), BUCKETS)
        for d, s in zip(docs, starts, strict=True):
            ids[s : s + len(d)] = d
        x = self.table[ids].sum(1)
        pooled, places = [], []
        for f, b in zip(self.filters, self.bias, strict=True):
            y = sum(x[k : len(x) - len(f) + 1 + k] @ f[k] for k in range(len(f))) + b
            ends = starts + size - _EDGE
            at = np.stack([s + y[s:e].argmax(0) for s, e in zip(starts, ends, strict=True)])
            places.append(at)
            pooled.append(np.take_along_axis(y, at, 0))
        top = np.concatenate(pooled, 1)
        active = np.maximum(top, 0)
        logit = active @ self.out + self.shift
        p = 1 / (1 + np.exp(-logit))
        d_logit = ((p - toxic) / len(docs)).astype(np.float32)
        d_top = d_logit[:, None] * self.out * (top > 0)
        grads = [active.T @ d_logit, d_logit.sum()]
        rows, steps = [], []
        for i, (f, at) in enumerate(zip(self.filters, places, strict=True)):
            d = d_top[:, i * FILTERS : (i + 1) * FILTERS]
            grad = np.stack([np.einsum("nfd,nf->df", x[at + k], d) for k in range(len(f))])
            for k in range(len(f)):
                rows.append(ids[at + k].reshape(-1, 3))
                steps.append(np.einsum("nf,df->nfd", d, f[k]).reshape(-1, DIM))
            grads += [grad, d.sum(0)]
        if not memory:
            memory += [np.zeros_like(self.table), *(np.zeros_like(g) for g in grads)]

        def move(value: np.ndarray, grad: np.ndarray, kept: np.ndarray) -> np.ndarray:
            kept += grad * grad
            return value - rate * grad / (np.sqrt(kept) + 1e-6)

        self.out = move(self.out, grads[0], memory[1])
        memory[2] = memory[2] + grads[1] ** 2
        self.shift = np.float32(self.shift - rate * grads[1] / (np.sqrt(memory[2]) + 1e-6))
        for i in range(len(WIDTHS)):
            self.filters[i] = move(self.filters[i], grads[2 + 2 * i], memory[3 + 2 * i])
            self.bias[i] = move(self.bias[i], grads[3 + 2 * i], memory[4 + 2 * i])
        rows, steps = np.concatenate(rows), np.concatenate(steps)
        flat, step = rows.reshape(-1), np.repeat(steps, 3, 0)
        used, inverse = np.unique(flat, return_inverse=True)
        total = np.zeros((len(used), DIM), np.float32)
        np.add.at(total, inverse, step)
        total[used == BUCKETS] = 0
        kept = memory[0]
        kept[used] += total * total
        self.table[used] -= rate * total / (np.sqrt(kept[used]) + 1e-4)
        return float(-np.mean(toxic * np.log(p + 1e-9) + (1 - toxic) * np.log(1 - p + 1e-9)))

    def fit(self, docs: list[np.ndarray], toxic: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.02) -> None:
        self.start(docs, toxic)
        rng, memory = np.random.default_rng(11), []
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for i in range(0, len(order), batch):
                part = order[i : i + batch]
                self.step([docs[j] for j in part], toxic[part].astype(np.float32), rate, memory)

    def project(self, ids: np.ndarray) -> np.ndarray:
        """What a word adds to each filter at each of its places, for rows of feature ids."""
        x = self.table[ids].sum(1)
        return np.concatenate([x @ f[k] for f in self.filters for k in range(len(f))], 1)

    def logits(self, projected: Iterable[np.ndarray]) -> np.ndarray:
        return np.array([self.logit(iter([p])) for p in projected])

    def logit(self, pieces: Iterator[np.ndarray]) -> float:
        """Uncalibrated logit of a document whose projected words come in pieces."""
        zeros = np.zeros((_EDGE, FILTERS * sum(WIDTHS)), np.float32)
        best, carry, seen = np.full(len(self.out), -np.inf, np.float32), zeros[:0], False
        pieces = iter(pieces)
        piece = next(pieces, None)
        while piece is not None:
            after = next(pieces, None)
            seen = seen or len(piece) > 0
            rows = np.concatenate([carry, piece, *([zeros] if after is None else [])])
            if after is None and not seen:
                rows = zeros[[0] * (_EDGE + 1)]
            column = 0
            for i, w in enumerate(WIDTHS):
                n = len(rows) - _EDGE
                if n > 0:
                    y = sum(rows[k : n + k, column + k * FILTERS : column + (k + 1) * FILTERS] for k in range(w)) + self.bias[i]
                    best[i * FILTERS : (i + 1) * FILTERS] = np.maximum(best[i * FILTERS : (i + 1) * FILTERS], y.max(0))
                column += w * FILTERS
            carry, piece = rows[len(rows) - _EDGE :] if after is not None else zeros[:0], after
        return float(np.maximum(best, 0) @ self.out + self.shift)


class Scorer:
    """A model and the projections of words met so far."""

    def __init__(self, model: Convolution):
        self.model, self.place, self.rows = model, {}, np.zeros((0, FILTERS * sum(WIDTHS)), np.float32)

    def logit(self, text: str) -> float:
        return self.model.logit(self._pieces(words_of(text)))

    def score(self, text: str) -> float:
        a, b = self.model.scale
        return float(1 / (1 + np.exp(-np.clip(a * self.logit(text) + b, -30, 30))))

    def _pieces(self, words: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, max(1, len(words)), STRIDE):
            part = words[i : i + STRIDE]
            yield self._projected(part)

    def learn(self, words: set[str]) -> None:
        if len(self.place) + len(words) > REMEMBERED:
            self.place, self.rows = {}, self.rows[:0]
        new = [w for w in words if w not in self.place]
        if new:
            made = self.model.project(np.array([features(w) for w in new]))
            used = len(self.place)
            if used + len(new) > len(self.rows):
                more = max(len(new), min(used, 20_000))
                self.rows = np.concatenate([self.rows[:used], np.zeros((more, self.rows.shape[1]), np.float32)])
            self.rows[used : used + len(new)] = made
            self.place.update(zip(new, range(used, used + len(new)), strict=True))

    def _projected(self, words: list[str]) -> np.ndarray:
        try:
            at = list(map(self.place.__getitem__, words))
        except KeyError:
            self.learn(set(words))
            at = list(map(self.place.__getitem__, words))
        return self.rows[np.array(at, np.int64)]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str | None = None
) -> Convolution:
    """Fit a model on a bounded sample of labelled documents outside the held-out third, calibrate it on all others.

    Documents labelled more than once are toxic if any label is 1; null labels, ids and texts are not learnt from. Of
    the sample a fifth is not fitted on. Calibration, also of a threshold for each language if `lang_col` is given, rests on
    that and on every labelled document outside the sample; languages never enter a score. Without labels of both kinds the model scores everything below 0.5.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col) != 1))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    one, other = (known.where(F.col("toxic") == t).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(FIT_ROWS) for t in (0, 1))
    lang = F.coalesce(F.col(lang_col), F.lit("")) if lang_col else F.lit("")
    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang")).where("text is not null")
    few = few.join(F.broadcast(one.union(other)), "id").dropDuplicates(["id"])  # at most 2 * FIT_ROWS rows
    aside = F.crc32(F.concat(F.lit("calibrate "), F.col("id").cast("string")).cast("binary")) % 5 == 0
    few = stored(few.withColumn("aside", aside), "labelled")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, text, toxic in zip(batch["id"], batch["text"], batch["toxic"], strict=True):
                words = words_of(text)
                if len(words) > FIT_WORDS:
                    if toxic:  # its parts need not be
                        continue
                    starts = np.linspace(0, len(words) - FIT_WORDS // STRETCHES, STRETCHES).astype(int)
                    words = [w for i in starts for w in words[i : i + FIT_WORDS // STRETCHES]]
                yield pd.DataFrame({"id": [doc], "toxic": [toxic], "words": [np.array([features(w) for w in words], np.int32).tobytes()]})

    def train(sample: pd.DataFrame) -> pd.DataFrame:
        hold("toxicity", int)
        sample = sample.sort_values("id", ignore_index=True)
        toxic, model = sample["toxic"].to_numpy(), Convolution()
        if len(set(toxic)) == 2:
            model.fit([np.frombuffer(w, np.int32).reshape(-1, 3) for w in sample["words"]], toxic)
        return pd.DataFrame({"model": [pickle.dumps((len(set(toxic)) == 2, model))]})

    kind = docs.schema[id_col].dataType.simpleString()
    sample = few.where("not aside").select("id", "text", "toxic").mapInPandas(hashed, f"id {kind}, toxic int, words binary")
    made = sample.groupBy().applyInPandas(train, "model binary").collect()  # one task trains on the bounded sample
    fitted, model = pickle.loads(made[0].model) if made else (False, Convolution())
    if not fitted:
        return model
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def logit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold("toxicity", int)
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.logit(text) for text in texts], dtype=float)

    # texts are scored where they lie and only numbers meet the labels; what was fitted on goes
    given = F.col("text").isNotNull() & F.col("id").isNotNull() & (remainder("id") != 1)
    rest = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang")).where(given)
    rest = stored(rest.select("id", "lang", logit("text").alias("logit")), "logits").join(known, "id")
    rest = rest.join(F.broadcast(few.where("not aside").select("id")), "id", "left_anti")  # at most 2 * FIT_ROWS rows
    marked = stored(rest.select("id", "toxic", "lang", "logit").dropDuplicates(["id"]), "calibration")
    shared.destroy()
    seen = dict.fromkeys((0, 1), 0) | {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if seen[0] and seen[1]:
        model.scale = a, b = _logistic(marked, seen[1], seen[0])
        if lang_col:
            model.thresholds = _thresholds(marked.withColumn("score", _probability(a, b)))
    return model


def _probability(a: float, b: float) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") * a + b))))


CUTS = np.arange(5, 96) / 100


def _thresholds(scored: DataFrame) -> dict[str, float]:
    """The best threshold of each language, of all documents `lang, toxic, score`: what comes back is how many documents of a
    language and label have a score between two cuts."""
    passed = F.size(F.filter(F.array(*map(F.lit, CUTS.tolist())), lambda c: c <= F.col("score")))
    counts: dict[str, np.ndarray] = {}
    for r in scored.groupBy("lang", "toxic", passed.alias("passed")).count().collect():
        counts.setdefault(r.lang, np.zeros((2, len(CUTS) + 1), np.int64))[r.toxic, r.passed] = r["count"]
    return {lang: _best_threshold(n) for lang, n in counts.items() if n.sum(1).min() >= LEAST}


def _best_threshold(counts: np.ndarray) -> float:
    """The threshold in hundredths with the best F1, of equally good ones the nearest to the default, given how many
    documents of either label pass so many cuts."""
    wrong, hit = counts[:, ::-1].cumsum(1)[:, ::-1][:, 1:]
    f1 = 2 * hit / (hit + wrong + counts[1].sum())
    good = CUTS[f1 >= f1.max() - 1e-12]
    return float(good[np.abs(good - DEFAULT).argmin()])


def _logistic(marked: DataFrame, n1: int, n0: int, steps: int = 200) -> tuple[float, float]:
    """Scale and shift that make logits probabilities where both labels are equally frequent, by Newton steps with
    smoothed targets; the sums of a step are taken over all documents `toxic, logit`."""
    yes, x = F.col("toxic") == 1, F.col("logit")
    target = F.when(yes, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
    share = F.when(yes, (n1 + n0) / 2 / n1).otherwise((n1 + n0) / 2 / n0)
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = _probability(a, b)
        off, w = share * (p - target), share * p * (1 - p) + 1e-9
        g0, g1, h00, h01, h11 = marked.agg(*[F.sum(v).alias(f"s{k}") for k, v in enumerate((off * x, off, w * x * x, w * x, w))]).head()
        g = np.array([g0 + 1e-3 * (a - 1), g1])
        h = np.array([[h00 + 1e-3, h01], [h01, h11]])
        d = np.clip(np.linalg.solve(h + 1e-9 * np.eye(2), g), -0.5, 0.5)
        a, b = float(a - d[0]), float(b - d[1])
        if np.abs(d).max() < 1e-6:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def score_column(model: Convolution, spark: SparkSession, text: Column) -> Column:
    """The score of a whole text, between 0 and 1, from the text alone; a null text counts as empty."""
    shared = spark.sparkContext.broadcast(model)  # the size of the embedding table, a constant

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold("toxicity", int)  # what others left goes; a scorer ends with its task
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.score(text or "") for text in texts], dtype=float)

    return score(text)


def scored(docs: DataFrame, model: Convolution, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents (`id, score`). Repeated rows stay, other columns are left out; an empty table gives no
    rows."""
    return docs.select(id_col, score_column(model, docs.sparkSession, F.col(text_col)).alias("score"))


def threshold_of(model: Convolution, lang: Column) -> Column:
    """The model's threshold for a document's language, or the default."""
    known = [x for pair in model.thresholds.items() for x in map(F.lit, pair)]
    return F.coalesce(F.create_map(*known)[F.coalesce(lang, F.lit(""))], F.lit(DEFAULT)) if known else F.lit(DEFAULT)
