import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from sitepulse.llm import toxicity

TOXIC, PLAIN = ["idiot", "scum", "moron"], ["tree", "house", "river", "cloud", "stone", "light"]


def corpus(spark, n=900):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = list(rng.choice(PLAIN, 30)) + (list(rng.choice(TOXIC, 3)) if bad else [])
        docs.append((i, " ".join(rng.permutation(words)), None, None, None))
        labels.append((i, 1, int(bad)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return (spark.createDataFrame(docs, schema),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    found = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    held = [d for d, r in found.items() if r["held_out"]]
    assert {d for d in found if zlib.crc32(str(d).encode()) % 3 == 1} == set(held)
    right = sum(found[d]["predicted"] == (d % 4 == 0) for d in held)
    assert right / len(held) > 0.97


def test_held_out_labels_never_train(spark):
    docs, labels = corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    assert np.array_equal(toxicity.train(docs, labels), toxicity.train(docs, flipped))


def test_odd_rows(spark):
    docs, labels = corpus(spark, 300)
    odd = spark.createDataFrame(
        [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "idiot " * 50_000), (None, "tree"),
         (10**6 + 3, "tree"), (10**6 + 3, "tree")],
        "doc_id long, text string")
    more = docs.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("x"))
    junk = spark.createDataFrame([(0, None, None), (10**7, 1, 1), (None, 1, 1), (4, 1, 1)],
                                 labels.schema)
    out = toxicity.score(more, toxicity.train(more, labels.unionByName(junk)))
    rows = out.where("doc_id >= 1000000 or doc_id is null").collect()
    assert len(rows) == 6
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[10**6]["score"] == by_id[10**6 + 1]["score"]
    assert by_id[10**6 + 2]["predicted"] == 1
    assert by_id[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_empty_tables(spark):
    docs, labels = corpus(spark, 10)
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0
    weights = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, weights).collect()} == {0.5}


def test_weights_are_sparse_and_sample_is_bounded(spark):
    docs, labels = corpus(spark)
    weights = toxicity.train(docs, labels)
    assert 0 < np.count_nonzero(weights) < 2000
    assert toxicity.training_rows(docs, labels, 50).count() == 50


def test_stage_drops_toxic_documents_only(spark, folder):
    docs, labels = corpus(spark)
    out = toxicity.toxicity_stage(spark, docs, folder(labels=labels))
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    predicted = {r["doc_id"] for r in toxicity.score(docs, toxicity.train(docs, labels)).where(
        "predicted = 0").collect()}
    assert kept == predicted
    assert {d for d in range(900) if d % 4} <= kept
    assert sum(d % 4 == 0 for d in kept) < 10


def slow_ftrl(rows, epochs, alpha, beta, l1, l2):
    """The update rule of FTRL-proximal written out per coordinate with plain numbers."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for places, label in rows:
            w = {i: weight(i) for i in places}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values())))))
            g = p - label
            for i in places:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_is_ftrl_proximal(spark):
    """Weights of the query's training task against the rule above, on the same rows in order."""
    docs, labels = corpus(spark, 160)
    rows = sorted(((r["place"], r["doc_id"], toxicity.features(r["text"]), r["toxic"])
                   for r in toxicity.training_rows(docs, labels).collect()),
                  key=lambda r: r[:2])
    last = 1 << toxicity.PLACES_LOG2
    expected = slow_ftrl([([*f.tolist(), last], y) for _, _, f, y in rows], toxicity.EPOCHS,
                         1.0, 1.0, 8.0, 1e-3)
    weights = toxicity.train(docs, labels)
    assert {int(i) for i in np.flatnonzero(weights)} == {i for i, w in expected.items() if w}
    assert all(abs(weights[i] - w) < 1e-4 for i, w in expected.items())


def test_sample_is_of_documents(spark):
    """Labels without a document take no place, and repeated rows take one."""
    docs, labels = corpus(spark, 40)
    lone = spark.range(10**6, 10**6 + 2000).selectExpr("id as doc_id", "1 as quality", "1 as toxic")
    one = docs.where(~toxicity.is_held_out()).agg(F.min("doc_id")).first()[0]
    usable = labels.where(F.col("doc_id") == one)
    rows = toxicity.training_rows(docs, lone.unionByName(usable), 20).collect()
    assert [r["doc_id"] for r in rows] == [one]
    many = docs.where(F.col("doc_id") == one)
    for _ in range(6):
        many = many.unionByName(many)
    two = docs.where(F.col("doc_id") != one).unionByName(many)
    assert toxicity.training_rows(two, labels, 2).count() <= 2
    assert toxicity.training_rows(many, labels, 20).count() == 1


def test_recall_of_the_query_on_held_out_rows(spark):
    at = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{at}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op2_toxicity(spark, at).join(truth, "doc_id").where(
        "held_out and toxic is not null").collect()
    bad = [r for r in rows if r["toxic"] == 1]
    assert len(bad) > 100
    # A few hundred toxic texts train here; on check_s, with 1,400 of them, it is 0.93.
    assert sum(r["predicted"] for r in bad) / len(bad) > 0.65
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.01
