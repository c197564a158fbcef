import random

import numpy as np

from hearthline.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def _rows(n, seed):
    """Category a by a word; category b by another word, and always where a holds."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choices([f"common{k}" for k in range(300)], k=80)
        a, b = rng.random() < 0.3, rng.random() < 0.2
        words += ["vile"] * a + ["nasty"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a), int(a or b)))
    return rows


def test_chain_passes_earlier_categories_on():
    rows = _rows(800, 11)
    found = [toxicity.features(t.encode()) for _, t, _, _ in rows]
    y = np.array([(a, b) for *_, a, b in rows], float)
    models = toxicity.fit_chain(found[:600], y[:600], np.arange(600) % 5)
    p = toxicity.predict_chain(models, found[600:])
    assert ((p >= 0.5) == (y[600:] == 1)).mean() > 0.97
    assert models[0]["theta"].size == len(models[0]["chosen"]) + 1
    assert models[1]["theta"][len(models[1]["chosen"])] > 1  # the weight of the earlier category


def test_telling_is_chi_square():
    rows = [np.array([0, 1]), np.array([0]), np.array([0, 1]), np.array([0])] * 50
    assert toxicity.telling(rows, np.array([1, 0, 1, 0] * 50)).tolist() == [1]
    assert toxicity.telling(rows, np.zeros(200)).size == 0


def test_awkward_rows(spark, texts_frame):
    docs = texts_frame([(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (4, "word " * 60_000)])
    labels = spark.createDataFrame([(1, 0, 1), (2, None, 1), (3, 1, None), (4, 0, 0), (None, 1, 1)],
                                   "doc_id long, first int, second int")
    models = toxicity.train(docs, labels, ["first", "second"])
    out = toxicity.judge(docs, models, ["p1", "p2"])
    assert out.columns == [*docs.columns, "p1", "p2"]
    rows = out.collect()
    assert len(rows) == 6 and all(0 <= r.p1 <= 1 and 0 <= r.p2 <= 1 for r in rows)
    assert toxicity.train(docs, labels.limit(0), ["first", "second"]) is None
    assert all(r.p1 is None for r in toxicity.judge(docs, None, ["p1", "p2"]).collect())
    assert toxicity.judge(docs.limit(0), models, ["p1", "p2"]).count() == 0


def test_query_on_labels(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES["op7_toxicity"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    toxic = [r.toxic for r in rows if labels.get(r.doc_id) == 1]
    clean = [r.toxic for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.005
