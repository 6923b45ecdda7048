"""Line de-duplication: repeated runs of lines by prefix doubling over line-id sequences.

A text is the sequence of its lines that have a word. A run of at least `MIN_WORDS` words is repeated if the same lines
in a row begin at an earlier place, by document id and line; all its lines are deleted, so the first copy of every run
stays. Lines too short to say anything go only as part of a longer repeated run.

Suffixes are named instead of ranked: the name of a suffix at depth n is the first place that begins with the same n
lines, so suffixes of one name are an interval of the suffix array whose common prefix is n lines or more. Depth 2n
follows from depth n by grouping pairs of names, as in prefix doubling, and names of any depth between are pairs of
overlapping ones. A suffix alone in its interval leaves. Every maximal repeated run is the union of the windows that
reach `MIN_WORDS` words with the fewest lines from one of its lines on, or back from one, so depths up to `MIN_WORDS`
lines are all that is needed, however long the runs are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.llm.stored import stored
from lumisift.llm.workers import hold

#: Words that a repeated run must have.
MIN_WORDS = 10
#: Documents made into lines at a time; bounds memory, never the result.
STRIDE = 1_000


def split_lines(text: str | None) -> tuple[list[str], list[int]]:
    """All lines of a text and the places of those with a word."""
    lines = (text or "").split("\n")
    return lines, [i for i, line in enumerate(lines) if line.encode().strip()]


def windows(words: list[int], least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """For each line the fewest lines from it on, and back from it, that have `least` words; 0 if there are not so many."""
    total = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    at = np.arange(len(words))
    end = np.searchsorted(total, total[:-1] + least)
    begin = np.searchsorted(total, total[1:] - least, side="right") - 1
    return np.where(end <= len(words), end - at, 0), np.where(total[1:] >= least, at - begin + 1, 0)


def version(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """`id, version, i, high, low, ahead, back`: the lines with a word of documents `id, text`; versions tell texts of
    one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("line_dedup", int)  # what others left goes
        for batch in (whole.slice(k, STRIDE) for whole in batches for k in range(0, whole.num_rows, STRIDE)):
            many, places, digests, ahead, back = [], [], [], [], []
            for text in batch.column(2):
                lines, used = split_lines(text.as_py())
                words = [len(lines[i].encode().split()) for i in used]
                a, b = windows(words, min_words)
                many.append(len(used))
                places += range(len(used))
                digests += [xxhash.xxh3_128_digest(lines[i].encode()) for i in used]
                ahead.append(a)
                back.append(b)
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            row = pa.array(np.repeat(np.arange(len(many)), many))
            columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(places, pa.int32())]
            columns += [pa.array(np.ascontiguousarray(c)) for c in (both[:, 0], both[:, 1])]
            columns += [pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int32)) for x in (ahead, back)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "version", "i", "high", "low", "ahead", "back"])

    own = docs.select(F.col("id").cast("long").alias("id"), version(F.col("text")).alias("version"), "text")
    return own.mapInArrow(run, "id bigint, version bigint, i int, high bigint, low bigint, ahead int, back int")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur more than once, with the first place that has them as `name`."""
    place = F.struct("id", "version", "i")
    first = rows.groupBy(*keys).agg(F.min(place).alias("name"), F.max(place).alias("last")).where("name <> last").drop("last")
    return rows.join(first, keys)


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Places of lines to delete, among a document's lines with a word, of documents `id, text`: `id, version, gone`."""
    lines = stored(line_table(docs, min_words), "lines")
    level = _named(lines, ["high", "low"]).select("id", "version", "i", "ahead", "back", "name").dropDuplicates(["id", "version", "i"])
    level = stored(level, "names")
    ask = level.select("id", "version", F.explode(F.array(
        F.struct(F.col("i").alias("start"), F.col("ahead").alias("n")),
        F.struct((F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("n")),
    )).alias("w")).select("id", "version", "w.start", "w.n").where("n > 0").distinct()
    hit, depth = None, 1
    while True:
        # windows of depth to 2 * depth - 1 lines: the names of their first and of their last `depth` lines
        now = ask.where(F.col("n").between(depth, 2 * depth - 1))
        names = level.select("id", "version", "i", "name")
        head = now.join(names.withColumnsRenamed({"i": "start", "name": "head"}), ["id", "version", "start"])
        tail = names.select("id", "version", F.col("i").alias("at"), F.col("name").alias("tail"))
        both = head.withColumn("at", F.col("start") + F.col("n") - depth).join(tail, ["id", "version", "at"])
        both = both.select("id", "version", F.col("start").alias("i"), "n", "head", "tail")
        later = _named(both, ["n", "head", "tail"]).where(F.struct("id", "version", "i") > F.col("name")).select("id", "version", "i", "n")
        later = stored(later, "hits")
        hit = later if hit is None else hit.union(later)
        if 2 * depth > min_words:
            break
        after = names.select("id", "version", (F.col("i") - depth).alias("i"), F.col("name").alias("next"))
        pairs = names.join(after, ["id", "version", "i"])
        level = stored(_named(pairs.withColumnRenamed("name", "first"), ["first", "next"]).select("id", "version", "i", "name"), "names")
        depth *= 2
    spans = hit.select("id", "version", F.sequence(F.col("i"), F.col("i") + F.col("n") - 1).alias("gone"))
    return spans.groupBy("id", "version").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))  # a document's own lines


def rest(text: Column, gone: Column) -> Column:
    """A text without the lines at the places `gone` among its lines with a word; whole if that is null.

    The lines between two deleted ones are taken as one slice, so the work is linear in a text's lines. What several
    steps need is the argument of a function, as an expression would be worked out again for every line.
    """

    def given(value: Column, then: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), then), 0)

    def left(lines: Column) -> Column:
        used = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(r"[^\x20\x09-\x0D]"))
        places = given(used, lambda u: F.transform(F.sort_array(gone), lambda i: F.get(u, i)))
        ends = F.concat(F.array(F.lit(-1)), places, F.array(F.size(lines)))
        between = lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda k: F.slice(lines, F.get(e, k - 1) + 2, F.get(e, k) - F.get(e, k - 1) - 1))
        return F.array_join(F.flatten(given(ends, between)), "\n")

    return F.when(text.isNull() | gone.isNull(), text).otherwise(given(F.split(text, "\n"), left))


def without_repeats(df: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with later copies of repeated runs of lines deleted from its texts, and `n_lines` (all lines) and
    `n_removed`.

    Null texts stay null and have no lines; lines without a word always stay. Ids are integers; a row with a
    null one keeps its text and deletes nothing. Rows with equal id and text are one document; of rows with equal ids the texts' order is arbitrary but
    fixed. Columns of the input named like the new ones are replaced, all others stay; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    gone = stored(deleted_lines(docs.where("id is not null"), min_words), "gone").withColumnsRenamed({"id": "__id", "version": "__version", "gone": "__gone"})
    own = df.withColumn("__own", version(F.col(text_col)))
    both = own.join(gone, (F.col(id_col).cast("long") == F.col("__id")) & (F.col("__own") == F.col("__version")), "left")
    lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(F.col(text_col), "\n")))
    both = both.withColumns({"n_lines": lines.cast("long"), "n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")})
    return both.withColumn(text_col, rest(F.col(text_col), F.col("__gone"))).drop("__own", "__id", "__version", "__gone")
