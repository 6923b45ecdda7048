"""Toxicity is calibrated on all labelled documents, however few the model is fitted on."""

import numpy as np
from pyspark.sql import functions as F

from lumisift.llm import toxicity


def test_calibration_uses_every_labelled_document(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and more" + (" vile scum" if i % 3 == 0 else " kind words"), "en" if i % 2 else None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id bigint, toxic int")
    kept, store = {}, toxicity.stored
    monkeypatch.setattr(toxicity, "FIT_ROWS", 20)
    monkeypatch.setattr(toxicity, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    model = toxicity.fit(docs, labels, lang_col="lang")
    known = {r.doc_id for r in docs.where(toxicity.remainder("doc_id") != 1).collect()}
    fitted = {r.id for r in kept["labelled"].where("not aside").collect()}
    assert {r.id for r in kept["calibration"].collect()} == known - fitted and len(fitted) < 40
    assert set(model.thresholds) == {"", "en"}  # 20 documents of either label are too few for any


def test_thresholds_of_counts_are_those_of_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, int(t), float(np.clip(rng.normal(0.35 + 0.3 * t, 0.2), 0, 1))) for lang in ("de", "en") for t in rng.integers(0, 2, 300)]
    rows += [("en", 1, 0.35), ("en", 0, 0.35), ("fr", 1, 0.9)]
    got = toxicity._thresholds(spark.createDataFrame(rows, "lang string, toxic int, score double").where(F.lit(True)))
    for lang in ("de", "en"):
        f1 = {}
        for c in toxicity.CUTS:
            hit, wrong = (sum(r[0] == lang and r[1] == t and r[2] >= c for r in rows) for t in (1, 0))
            f1[c] = 2 * hit / (hit + wrong + sum(r[0] == lang and r[1] == 1 for r in rows))
        best = [c for c, v in f1.items() if v >= max(f1.values()) - 1e-12]
        assert got[lang] == min(best, key=lambda c: abs(c - toxicity.DEFAULT))
    assert "fr" not in got


def test_texts_are_scored_where_they_lie(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and more" + (" vile scum" if i % 3 == 0 else " kind words"), "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    plans, store = [], toxicity.stored
    monkeypatch.setattr(toxicity, "FIT_ROWS", 20)
    monkeypatch.setattr(toxicity, "stored", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or store(df, name))
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many labels
    try:
        toxicity.fit(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    scoring = [plan for plan in plans if "ArrowEvalPython" in plan.split("== Physical Plan ==")[1]]
    assert scoring and not any("Exchange" in plan for plan in scoring)
