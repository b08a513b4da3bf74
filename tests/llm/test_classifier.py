import zlib

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm.classifier import Network, classify

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_untouched_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in classify(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    mine = [(rows[i]["score"], q) for i, q in truth.items() if rows[i]["held_out"]]
    accuracy = np.mean([(s >= 0.5) == q for s, q in mine])
    assert accuracy > max(np.mean([q for _, q in mine]), 0.9)
    # labels of held-out rows and other columns change nothing
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).withColumn("score", F.lit(0))
    again = {r["doc_id"]: r["score"] for r in classify(other, flipped).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-6 for i, r in rows.items())


def test_odd_rows(spark, docs_of, odd_texts):
    docs = docs_of([*enumerate(odd_texts), (None, "a b"), (3, "one")])
    labels = spark.createDataFrame([(0, 1), (1, None), (2, 1), (None, 1), (5, 0), (5, 1)], "doc_id long, quality int")
    rows = classify(docs, labels).collect()
    assert len(rows) == len(odd_texts) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in classify(docs, labels.limit(0)).collect()} == {0.5}
    assert classify(docs.limit(0), labels).count() == 0


def test_temperature_calibrates():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 20))
    y = (x[:, 0] + r.normal(size=600) > 0).astype(float)
    net = Network(x[:200], y[:200], epochs=200, decay=0.0)
    loss = lambda p: -np.mean(y[400:] * np.log(p + 1e-12) + (1 - y[400:]) * np.log(1 - p + 1e-12))
    before = loss(net.scores(x[400:]))
    net.calibrate(x[200:400], y[200:400])
    assert net.temperature > 1 and loss(net.scores(x[400:])) < before
