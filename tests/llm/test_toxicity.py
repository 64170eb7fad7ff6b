import random

import numpy as np
from corpora import prose

from ledgerloom.llm import toxicity

BAD = ["scumbag", "patheticus", "trashling"]


def texts(n, seed, words=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = prose(seed + i, words).split()
        if i % 3 == 0:
            for _ in range(2):
                own.insert(rng.randrange(len(own)), rng.choice(BAD))
        out.append((i, " ".join(own), int(i % 3 == 0)))
    return out


def sample(spark, n, seed):
    return spark.createDataFrame([(t, y) for _, t, y in texts(n, seed)], "text string, label int")


def test_held_out_toxicity(spark):
    model = toxicity.fit(sample(spark, 300, 0))
    rows = toxicity.score(sample(spark, 120, 5000), model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.score >= 0.7) == bool(r.label) for r in rows]) > 0.97


def test_learning_is_the_same_for_any_order(spark):
    a, b = (toxicity.fit(sample(spark, 120, 0).repartition(n)) for n in (1, 5))
    assert np.allclose(a.weight, b.weight, atol=1e-4) and abs(a.intercept - b.intercept) < 1e-4


def test_scores_agree_with_a_sum_over_features(spark):
    model = toxicity.fit(sample(spark, 120, 0))
    rows = toxicity.score(sample(spark, 20, 900), model).collect()
    for r in rows:
        _, bucket = toxicity.present([r.text], toxicity.all_buckets())
        assert len(set(bucket.tolist())) == len(bucket)
        assert abs(r.score - 1 / (1 + np.exp(-(model.weight[bucket].sum() + model.intercept)))) < 1e-5


def test_labels_that_are_odd(spark, docs):
    rows = docs(*[(i, t) for i, t, _ in texts(30, 0)], (None, "x"))
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (2, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(rows, labels, "toxic", 100).collect()
    assert sorted(r.label for r in got) == [0, 1]


def test_bounded_sample(spark, docs):
    labels = spark.range(4000).selectExpr("id AS doc_id", "int(id % 4 = 0) AS toxic")
    rows = spark.range(4000).selectExpr("id AS doc_id", "'x' AS text")
    got = {r.label: r["count"] for r in toxicity.labelled_sample(rows, labels, "toxic", 500).groupBy("label").count().collect()}
    assert 400 < got[0] < 600 and 400 < got[1] < 600


def test_odd_rows(odd, spark):
    model = toxicity.fit(sample(spark, 60, 0))
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count()
    empty = 1 / (1 + np.exp(-model.intercept))
    assert all(abs(r.score - empty) < 1e-9 for r in rows if not r.text)
    assert toxicity.score(odd.limit(0), model).collect() == []


def test_one_class_teaches_nothing(odd, spark):
    model = toxicity.fit(sample(spark, 30, 0).filter("label = 0"))
    assert {r.score for r in toxicity.score(odd, model).collect()} == {0.0}


def test_an_id_that_many_rows_share_doesn_t_break_the_bound(spark, docs):
    rows = docs(*[(1, f"copy {k}") for k in range(10_000)], *[(k, f"text {k}") for k in range(2, 40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)], "doc_id long, toxic int")
    got = {r.label: r["count"] for r in toxicity.labelled_sample(rows, labels, "toxic", 50).groupBy("label").count().collect()}
    assert got[0] == 19 and got[1] < 150
