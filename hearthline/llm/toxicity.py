"""Toxicity categories by a classifier chain.

Categories are predicted one after the other. The linear model of each sees the
text's hashed features and the probabilities of all earlier categories. In
training these are out-of-fold: each rated text's earlier probability comes from
a model that has not seen it, as will be the case for new texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.texts import WordTable, as_bytes, hash64, small

BITS = 22
#: Labelled texts the chain is fitted on, at most; taken in hash order of the id.
SAMPLE = 10_000
FOLDS = 5
#: Chi-square from which a feature takes part.
EVIDENCE = 25.0
STEPS = 200
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _slots(word: bytes) -> bytes:
    """The word's letters, its beginnings of four to six bytes, and the marks after it."""
    letters = word.strip(_MARKS).lower()
    names = [b"w" + letters, *(b"p" + letters[:k] for k in (4, 5, 6)), b"m" + word[len(word.rstrip(_MARKS)):][:3]]
    return np.array([hash64(n) & ((1 << BITS) - 1) for n in names], np.int32).tobytes()


_TABLE = WordTable(_slots)


def features(text: bytes) -> np.ndarray:
    """Slots that the text has, each once, in order: of its words, and of how much it repeats itself."""
    found = text.split()
    different = set(found)
    slots = b"".join(map(_TABLE.__getitem__, different))
    if found:
        again = sum(map(eq, found, found[1:]))
        slots += _TABLE[b"\n%d" % (10 * again // len(found))] + _TABLE[b"\t%d" % (10 * len(different) // len(found))]
    return np.unique(np.frombuffer(slots, np.int32))


def telling(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Slots whose presence goes with the category or against it."""
    n, positive = len(y), int(y.sum())
    if not 0 < positive < n:
        return np.empty(0, np.int32)
    every, with_y = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for slots, own in zip(rows, y):
        every[slots] += 1
        if own:
            with_y[slots] += 1
    expected = every * positive / n
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (with_y - expected) ** 2 * n ** 2 / (expected * (n - positive) * (n - every))
    return np.flatnonzero(np.nan_to_num(chi, nan=0.0, posinf=1e9) >= EVIDENCE).astype(np.int32)


def matrix(rows: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every chosen slot that a text has."""
    at, columns = [], []
    for i, slots in enumerate(rows):
        found = np.searchsorted(chosen, slots)
        found = found[(found < len(chosen)) & (chosen[np.minimum(found, max(0, len(chosen) - 1))] == slots)] \
            if len(chosen) else found[:0]
        at.append(np.full(len(found), i))
        columns.append(found)
    return np.concatenate(at or [np.empty(0, int)]), np.concatenate(columns or [np.empty(0, int)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray) -> dict:
    """Logistic model of the telling slots and the earlier probabilities (Adam, all rows a step)."""
    chosen = telling(rows, y)
    at, columns = matrix(rows, chosen)
    n, k = len(y), len(chosen)
    theta = np.zeros(k + earlier.shape[1] + 1)
    theta[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        p = sigmoid(np.bincount(at, theta[columns], n) + earlier @ theta[k:-1] + theta[-1])
        error = (p - y) / n
        grad = np.concatenate([np.bincount(columns, error[at], k), earlier.T @ error, [error.sum()]])
        grad[:-1] += 1e-4 * theta[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad ** 2
        theta -= 0.1 * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return {"chosen": chosen, "theta": theta}


def predict(model: dict, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
    at, columns = matrix(rows, model["chosen"])
    theta, k = model["theta"], len(model["chosen"])
    return sigmoid(np.bincount(at, theta[columns], len(rows)) + earlier @ theta[k:-1] + theta[-1])


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[dict]:
    """A model for each column of ``labels``; a missing label (NaN) leaves the row out of that column's fit."""
    n = len(rows)
    models, earlier = [], np.empty((n, 0))
    for y in labels.T:
        known = ~np.isnan(y)
        held_out = np.zeros(n)
        for fold in range(FOLDS):
            own = folds == fold
            use = np.flatnonzero(known & ~own)
            if own.any():
                part = fit([rows[i] for i in use], earlier[use], y[use])
                held_out[own] = predict(part, [rows[i] for i in np.flatnonzero(own)], earlier[own])
        use = np.flatnonzero(known)
        models.append(fit([rows[i] for i in use], earlier[use], y[use]))
        earlier = np.column_stack([earlier, held_out])
    return models


def predict_chain(models: list[dict], rows: list[np.ndarray]) -> np.ndarray:
    """A column of probabilities for each category."""
    earlier = np.empty((len(rows), 0))
    for model in models:
        earlier = np.column_stack([earlier, predict(model, rows, earlier)])
    return earlier


def train(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text: str = "text",
          sample: int = SAMPLE) -> list[dict] | None:
    """Chain over the 0/1 columns ``categories`` of ``labels``, in this order; None without a labelled text.

    At most ``sample`` labelled rows are used, in hash order of their id, and at most
    as many texts, fitted in one task. A null label leaves its row out for its category.
    """
    rated = (labels.select(F.col(f"`{id_col}`").alias("id"),
                           F.array(*[F.col(f"`{c}`").cast("double") for c in categories]).alias("y"))
             .where("id is not null").orderBy(F.xxhash64("id"), "id", "y").limit(sample))
    # At most sample rows of a few numbers.
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"))
    joined = texts.join(F.broadcast(rated), "id").select(
        "y", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), "body")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, table=_TABLE):
            slots = [features(t).tobytes() for t in as_bytes(batch, "body")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("fold"), pa.array(slots, pa.binary())],
                                             ["y", "fold", "slots"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("fold", "slots", "y")))]
        if not found:
            return
        # The fit does not depend on the order in which rows arrive.
        found.sort(key=lambda r: (r[0], r[1], str(r[2])))
        models = fit_chain([np.frombuffer(s, np.int32) for _, s, _ in found],
                           np.array([y for _, _, y in found], np.float64), np.array([f for f, _, _ in found]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(models)], pa.binary())], ["model"])

    model = (joined.mapInArrow(extract, "y array<double>, fold int, slots binary").limit(sample).repartition(1)
             .mapInArrow(task, "model binary").collect())
    return pickle.loads(model[0]["model"]) if model else None


def judge(docs: DataFrame, models: list[dict] | None, names: list[str], text: str = "text") -> DataFrame:
    """``docs`` with one more column of probabilities, named as given, for each category.

    All rows and columns are kept. Null and empty texts have no words and get the
    probability that follows from that; without models all columns are null.
    """
    columns = docs.columns
    if models is None:
        return docs.select(*[F.col(f"`{c}`") for c in columns], *[F.lit(None).cast("double").alias(n) for n in names])
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(f"`{text}`").alias("body"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, table=_TABLE):
            if batch.num_rows:
                p = predict_chain(models, [features(t) for t in as_bytes(batch, "body")])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc"), pa.array(list(p), pa.list_(pa.float64()))], ["doc", "p"])

    judged = held.mapInArrow(task, held.select("doc").schema.add("p", T.ArrayType(T.DoubleType())))
    return judged.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns],
                         *[F.col("p")[k].alias(n) for k, n in enumerate(names)])
