"""Quality rules whose cutoffs carry a guarantee on false rejection.

Each document has a handful of signals; a rule rejects it if a signal is above a cutoff. For every stratum and rule the
cutoffs of a fixed grid are tested from the most lenient to the strictest against labelled documents: a cutoff passes
if, were the true share of good documents it rejects as high as allowed, so few rejections as seen would have a
probability of at most the error level (the exact binomial tail). The first cutoff that does not pass ends the
sequence, so testing a whole grid costs nothing; the error level is divided by strata and rules, and the allowed share
by rules. So with the stated confidence, in every stratum at once, all rules together reject no more than the allowed
share of good documents. A rule that cannot be shown to be safe is not applied.

Everything is DataFrame functions; the signals of a document come from its own row alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumisift.llm.stored import stored

#: ASCII white space, the separators of words.
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
#: Cutoffs of every rule, most lenient first.
GRID = {
    "symbols_per_word": [3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "repeat_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "long_words": [20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.5, 6.0],
    "short_words": [-1.0, -1.5, -2.0, -2.5, -3.0, -3.5, -4.0, -4.25],
    "capital_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "shouts_per_word": [3.0, 2.0, 1.5, 1.0, 0.5, 0.3, 0.2, 0.1],
}
#: Strata up to which the table of cutoffs is broadcast; beyond, it is joined by key.
BROADCAST_STRATA = 10_000


def signals(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """Counts and signals of every document: id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and the signals of `GRID`.

    A null text counts as empty, a null stratum as the stratum ''. A document without words has all signals 0.
    Columns of other names are left out, and none of the input's names can clash with the output's.
    """
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    base = df.select(F.col(id_col).alias("id"), stratum.alias("stratum"), F.coalesce(text_col, F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(BLANK))
    base = base.select(
        "id", "stratum",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("capitals"),
        F.regexp_count("text", F.lit("!")).alias("shouts"),
    )
    n = F.size("words")
    base = base.select(
        "id", "stratum", "n_symbols", "capitals", "shouts", "words", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n < 3, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.concat_ws(" ", *(F.get("words", i + k) for k in range(3))))
        ).alias("windows"),
    ).drop("words")
    # windows next to each other in sorted order are equal or occur once; most documents have no equal ones to look for
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    base = base.withColumn("ordered", F.when(repeated, F.array_sort(placed)).otherwise(F.array().cast("array<struct<w:string,i:int>>")))
    same = lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))
    base = base.withColumn(
        "found",
        F.array_sort(F.array_compact(F.transform("ordered", lambda x, k: F.when(
            same(x, F.get("ordered", k - 1)) | same(x, F.get("ordered", k + 1)), x["i"])))),
    ).drop("windows", "ordered")
    base = base.withColumn(
        "n_repeat_words",
        F.aggregate(
            F.transform("found", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("found", k + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"), lambda total, x: total + x,
        ),
    ).drop("found")
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return base.select(
        "id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("n_symbols", "n_words").alias("symbols_per_word"), per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"), per("word_chars", "n_words").alias("long_words"),
        (-per("word_chars", "n_words")).alias("short_words"), per("capitals", "word_chars").alias("capital_share"),
        per("shouts", "n_words").alias("shouts_per_word"),
    )


def log_tail(n: Column, k: Column, share: Column) -> Column:
    """Natural logarithm of the probability of at most k successes in n trials, exact up to rounding; k < n."""
    state = F.struct((n * F.log1p(-share)).alias("term"), (n * F.log1p(-share)).alias("total"))

    def add(at: Column, j: Column) -> Column:
        term = at["term"] + F.log((n - j + 1) / j) + F.log(share) - F.log1p(-share)
        most, least = F.greatest(at["total"], term), F.least(at["total"], term)
        return F.struct(term.alias("term"), (most + F.log1p(F.exp(least - most))).alias("total"))

    return F.aggregate(F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")), state, add, lambda at: at["total"])


def cutoffs(found: DataFrame, labels: DataFrame, allowed: float, error: float, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The strictest cutoff of each stratum and rule that passes (`stratum, rule, cutoff`); rules that cannot be shown
    to be safe have no row.

    A document labelled more than once is good only if all its labels are 1; null labels and documents without a label
    count for nothing.
    """
    good = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    good = good.agg(F.min(label_col).alias("label")).where("label = 1").select("id")
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("value"), F.lit(c).cast("array<double>").alias("grid")) for r, c in GRID.items()))
    seen = found.dropDuplicates(["id"]).join(good, "id").select("stratum", F.inline(rules))
    # how many of the cutoffs, lenient to strict, a value is below or at: it is rejected by those after them
    place = F.size(F.filter("grid", lambda c: F.col("value") <= c))
    counted = seen.groupBy("stratum", "rule", place.alias("place")).agg(F.count("*").alias("docs"))
    steps = counted.groupBy("stratum", "rule").agg(
        F.sum("docs").alias("n"), F.collect_list(F.struct("place", "docs")).alias("places")  # at most a grid's length
    )
    strata = counted.agg(F.countDistinct("stratum").alias("strata"))
    share = F.lit(allowed / len(GRID))
    grid = F.create_map(*(x for r, c in GRID.items() for x in (F.lit(r), F.lit(c).cast("array<double>"))))
    tests = steps.crossJoin(F.broadcast(strata)).select(  # one row of one number
        "stratum", "rule", "n", "strata", "places", F.posexplode(grid[F.col("rule")]).alias("step", "cutoff")
    )
    rejected = F.aggregate(
        F.filter("places", lambda p: p["place"] <= F.col("step")), F.lit(0).cast("long"), lambda total, p: total + p["docs"]
    )
    tests = tests.withColumn("k", rejected)
    passes = F.when(F.col("k") < share * F.col("n"), log_tail(F.col("n"), F.col("k"), share) <= F.log(F.lit(error / len(GRID)) / F.col("strata")))
    tests = tests.withColumn("fails", F.when(F.coalesce(passes, F.lit(False)), 0).otherwise(1))
    before = Window.partitionBy("stratum", "rule").orderBy("step")  # a grid's length of rows
    tests = tests.withColumn("failed", F.sum("fails").over(before)).where("failed = 0")
    return tests.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def quality(
    df: DataFrame, labels: DataFrame, allowed: float = 0.05, error: float = 0.05, id_col: str = "doc_id", text_col: str = "text",
    stratum_col: str | None = "lang", label_col: str = "quality",
) -> DataFrame:
    """Counts of every document, whether it fails the base rules (under 50 words, or over half its words in repeated
    windows of three), and whether it is kept: it passes them and every rule with a certified cutoff in its stratum.

    Nulls, empty texts and repeated rows are as in `signals` and `cutoffs`; with empty labels no rule is certified.
    """
    found = stored(signals(df, id_col, text_col, stratum_col), "quality")
    cuts = stored(cutoffs(found, labels, allowed, error, id_col, label_col), "cutoffs")
    cuts = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))  # a row for each rule
    few = cuts.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    judged = found.join(F.broadcast(cuts) if few else cuts, "stratum", "left")
    over = F.lit(False)
    for rule in GRID:
        over = over | F.coalesce(F.col(rule) > F.col("cuts")[rule], F.lit(False))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~over).alias("kept"),
    )
