import random

import numpy as np

from hearthline.llm import quality, queries

SF = "/root/testdata/sf0.1"


def _graded(rng, n):
    rows = []
    for i in range(n):
        grade = rng.randrange(5)
        words = rng.choices([f"common{k}" for k in range(50)], k=60)
        words += rng.choices(["awful", "bad", "plain", "good", "great"], weights=[
            1 / (1 + 3 * abs(grade - k)) ** 2 for k in range(5)], k=20)
        rng.shuffle(words)
        rows.append((i, " ".join(words), grade))
    return rows


def test_gradient_lowers_the_loss_and_orders_thresholds():
    rng = random.Random(9)
    rows = _graded(rng, 600)
    found = [quality.features(t.encode()) for _, t, _ in rows]
    grades = np.array([g for _, _, g in rows])
    weights, thresholds = quality.fit(found, grades, 5)
    assert np.all(np.diff(thresholds) > 0) and len(thresholds) == 4
    scores = np.array([weights[s] @ v for s, v in found])
    tails = quality.probabilities(scores, thresholds)
    assert np.all(np.diff(tails, axis=1) < 0)
    assert np.corrcoef(tails.sum(axis=1), grades)[0, 1] > 0.8


def test_held_out_grades(spark):
    rows = _graded(random.Random(10), 900)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, g * 0.5) for i, _, g in rows if i < 600], "doc_id long, grade double")
    model = quality.train(docs, marks)
    out = quality.grade_documents(docs, model, cut=1.0).where("doc_id >= 600").collect()
    truth = {i: g * 0.5 for i, _, g in rows}
    assert np.mean([abs(r.expected_grade - truth[r.doc_id]) for r in out]) < 0.4
    assert np.mean([(r.tail >= 0.5) == (truth[r.doc_id] >= 1.0) for r in out]) > 0.85


def test_awkward_rows(spark, texts_frame):
    docs = texts_frame([(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (4, "word " * 60_000)])
    marks = spark.createDataFrame([(3, 1.0), (3, 0.0), (4, 2.0), (None, 1.0), (2, None), (9, 1.0), (1, float("nan"))],
                                  "doc_id long, grade double")
    out = quality.grade_documents(docs, quality.train(docs, marks), cut=1.0)
    assert out.columns == [*docs.columns, "expected_grade", "tail"]
    rows = out.collect()
    assert len(rows) == 6 and all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert quality.train(docs, marks.limit(0)) is None
    assert all(r.tail is None for r in quality.grade_documents(docs, None, 1.0).collect())
    one = quality.train(docs, marks.where("doc_id = 4"))
    assert all(r.tail == 1 and r.expected_grade == 2 for r in quality.grade_documents(docs, one, 1.0).collect())
    assert quality.grade_documents(docs.limit(0), one, 1.0).count() == 0


def test_query_keeps_good_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES["op1_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    good = [r.keep for r in rows if labels.get(r.doc_id) == 1]
    poor = [r.keep for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.99 and np.mean(poor) < 0.05


def test_held_out_accuracy_on_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = queries.ratings(spark, SF)
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    rows = (quality.grade_documents(docs, model, 1.0).join(labels.where("doc_id % 2 = 1"), "doc_id")
            .select("grade", "tail").collect())
    assert np.mean([(r.tail >= 0.5) == (r.grade >= 1) for r in rows]) > 0.97
