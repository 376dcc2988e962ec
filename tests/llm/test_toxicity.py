import math

import numpy as np
from helpers_llm import documents, prose

from modspark.llm import toxicity as t


def held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{x}.parquet") for x in ("documents", "labels"))
    model = t.label_model(docs, labels.filter("doc_id % 5 <> 0"))
    got = t.severity_scores(docs, model).join(labels.filter("doc_id % 5 = 0").withColumnRenamed("toxic", "label"), "doc_id").collect()
    return [r.toxic for r in got if r.label == 0], [r.toxic for r in got if r.label == 1]


def test_held_out_accuracy(spark):
    """At most 1 % of clean documents are rejected.  65 of them cannot show that by their share, so there
    the number of rejections must not speak against 1 % (exact binomial test, level 5 %)."""
    clean, bad = held_out(spark, "0.01")
    n, k = len(clean), sum(clean)
    as_many = sum(math.comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k, n + 1))
    assert as_many > 0.05 and sum(bad) >= 0.6 * len(bad)


def test_held_out_accuracy_where_one_percent_is_several_documents(spark):
    clean, bad = held_out(spark, "0.1")
    assert len(clean) > 700 and sum(clean) <= 0.01 * len(clean) and sum(bad) >= 0.9 * len(bad)


def graded_rows():
    return [(prose(i, 30) + " vile" * (i % 4 > 0) + " worse" * (i % 4 > 1) + " worst" * (i % 4 > 2), i % 4) for i in range(400)]


def test_grades_are_learned_with_shared_weights_and_ordered_cuts(spark):
    model = t.fit_severity(spark.createDataFrame(graded_rows(), "text string, grade int"))
    assert len(model.cuts) == 3 and (np.diff(model.cuts) > 0).all()
    texts = [(i, x) for i, (x, _) in enumerate(graded_rows())]
    got = {r.doc_id: r for r in t.severity_scores(documents(spark, texts), model).collect()}
    right = [got[i].grade == i % 4 for i in got]
    assert sum(right) > 0.95 * len(right)
    means = [np.mean([got[i].severity for i in got if i % 4 == g]) for g in range(4)]
    assert means == sorted(means)
    again = t.fit_severity(spark.createDataFrame(graded_rows()[::-1], "text string, grade int"))
    assert np.allclose(model.weights, again.weights) and np.allclose(model.cuts, again.cuts)


def test_gradient_is_the_slope_of_the_likelihood():
    r = np.random.default_rng(1)
    grades = r.integers(0, 4, 300)
    text = np.repeat(np.arange(300), 3)
    number = (grades[text] * 5 + r.integers(0, 8, 900)) % 20
    w, cuts = t._fit(grades, text, number, 20, 1e-4, 400)

    def loss(w, cuts):
        score = np.bincount(text, weights=w[number], minlength=300)
        p = 1 / (1 + np.exp(cuts[None, :] - score[:, None]))
        full = np.concatenate([np.ones((300, 1)), p, np.zeros((300, 1))], axis=1)
        row = np.arange(300)
        return -np.log(full[row, grades] - full[row, grades + 1]).mean() + 0.5e-4 * (w**2).sum()

    best = loss(w, cuts)
    for k in range(20):
        for step in (-0.05, 0.05):
            moved = w.copy()
            moved[k] += step
            assert loss(moved, cuts) > best - 1e-4
    for k in range(3):
        for step in (-0.05, 0.05):
            moved = cuts.copy()
            moved[k] += step
            assert loss(w, moved) > best - 1e-4


def test_missing_values_repeats_and_nothing_to_learn(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "vile worse worst"), (2, "x"), (2, "x"), (3, "vile " * 100_000)])
    none = t.label_model(docs, spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int"))
    got = t.severity_scores(docs, none).collect()
    assert len(got) == 6 and not any(r.toxic for r in got)
    model = t.fit_severity(spark.createDataFrame(graded_rows(), "text string, grade int"))
    kept = t.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "2", "2"]
    assert t.drop_toxic(docs.limit(0), model).count() == 0
