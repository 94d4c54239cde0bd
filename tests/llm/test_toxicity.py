import random

import numpy as np
from llm_cases import awkward, empty, sentence
from pyspark.sql import functions as F
from tessera.llm import toxicity as T
from tessera.llm.scratch import crc_mod


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = T.fit(docs, labels, crc_mod("doc_id", 3) != 1)
    rows = T.score(docs, model).join(labels.where(crc_mod("doc_id", 3) == 1), "doc_id").select("toxic", "predicted").collect()
    wrong = [r["toxic"] for r in rows if r["toxic"] != r["predicted"]]     # some labels are noise: texts without a telling word
    assert len(rows) > 1000 and sum(wrong) <= 0.015 * len(rows) and len(wrong) - sum(wrong) <= 0.01 * len(rows)


def test_the_machine_learns_a_pair_that_weights_cannot():
    """Either word alone is clean, both together are toxic, as are neither: no additive score fits."""
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(1200):
        a, b = rng.integers(2), rng.integers(2)
        labels.append(int(a == b))
        texts.append(np.array([7] * a + [9] * b + [11] * (1 - a) + [13] * (1 - b) + sorted({20 + int(x) for x in rng.integers(0, 9, 3)})))
    y = np.array(labels)
    import unittest.mock as mock

    with mock.patch.object(T, "LEAST_G", 1e-9):
        model = T.train(texts, y, np.ones(len(y)), drop=0.0)
    rows = np.concatenate([np.full(len(t), i) for i, t in enumerate(texts)])
    p = model.margins(rows, model.index[np.concatenate(texts)], len(texts)) > 0
    assert (p == y).mean() > 0.98


def test_labels_outside_the_training_rows_are_not_used(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, sentence(rng, 30, 200) + (" vile" if i % 5 == 0 else "")) for i in range(300)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", F.col("text").endswith("vile").cast("int").alias("toxic"))
    held = crc_mod("doc_id", 3) == 1
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (T.score(docs, T.fit(docs, x, ~held)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b and all((r["predicted"] == 1) == r["text"].endswith("vile") for r in a)


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (5, 0), (99, 1)], "doc_id long, toxic int")
    model = T.fit(docs, labels, F.lit(True))
    out = T.score(docs, model)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    rows = out.collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= T.THRESHOLD) for r in rows)
    assert T.score(empty(spark), model).count() == 0
    none = T.fit(docs, labels.limit(0), F.lit(True))
    assert all(r["score"] < 1e-6 for r in T.score(docs, none).collect())
    one = T.fit(docs, labels.where("toxic = 1"), F.lit(True))
    assert all(r["predicted"] == 1 for r in T.score(docs, one).collect())
    assert T.fit(empty(spark), labels, F.lit(True)).weights.size == 0
