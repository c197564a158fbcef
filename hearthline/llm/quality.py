"""Quality grades by ordinal regression with a cumulative logistic link.

One weight per hashed text feature is shared by all grades; grades differ in
ordered thresholds only: P(grade <= k) = 1 / (1 + exp(score - threshold_k)).
The model gives a text's expected grade and the probability that its grade
reaches a cut, by which documents are selected.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.texts import WordTable, as_bytes, hash64, small

BITS = 18
#: Labelled rows the model is fitted on, at most; taken in hash order of the id.
SAMPLE = 20_000
EPOCHS = 8
#: Steps taken at least; few rows are gone over more often.
STEPS = 500
RATE = 0.3
BATCH = 256
SEED = 7


def _shape(word: bytes) -> bytes:
    """Case and marks of a word, without its letters."""
    letters = word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    case = (b"0" if letters.isdigit() else b"U" if len(letters) > 1 and letters.isupper()
            else b"T" if letters[:1].isupper() else b"l" if letters else b"-")
    return b"shape " + case + b" " + word[len(word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")):][:3]


def _both(word: bytes) -> int:
    mask = (1 << BITS) - 1
    return (hash64(b"word " + word.lower()) & mask) | (hash64(_shape(word)) & mask) << 32


_SLOTS = WordTable(_both)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: words, shapes and word repetition, each group of length 1."""
    found = text.split()
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    both = np.fromiter(map(_SLOTS.__getitem__, found), np.uint64, len(found))
    groups = []
    for part in (both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)):
        slots, counts = np.unique(part, return_counts=True)
        values = counts.astype(np.float64)
        groups.append((slots, values / np.sqrt((values ** 2).sum())))
    runs = int((both[1:] == both[:-1]).sum())
    share = len(groups[0][0]) / len(found)
    marks = [b"again %d" % min(9, 10 * runs // len(found)), b"varied %d" % int(10 * share),
             b"size %d" % min(12, int(np.log2(len(found))))]
    slots = np.array([hash64(m) & ((1 << BITS) - 1) for m in marks], np.uint64)
    groups.append((slots, np.full(len(marks), 0.5)))
    return (np.concatenate([g[0] for g in groups]).astype(np.int32),
            np.concatenate([g[1] for g in groups]).astype(np.float32))


def probabilities(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade index >= k) for k from 1 to the last, a column each."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - scores[:, None], -60, 60)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int,
        epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by mini-batch Adagrad on the likelihood."""
    weights = np.zeros(1 << BITS)
    shares = np.cumsum(np.bincount(grades, minlength=n_grades)[:-1] + 0.5) / (len(grades) + 0.5 * n_grades)
    first = np.log(shares / (1 - shares))
    # Thresholds are the first and the logarithms of the gaps, so that they stay in order.
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    squares, free_squares = np.full(1 << BITS, 1e-3), np.full(n_grades - 1, 1e-3)
    order = np.random.default_rng(SEED)
    batches = max(1, len(rows) // BATCH)
    for _ in range(max(epochs, -(-STEPS // batches))):
        for batch in np.array_split(order.permutation(len(rows)), batches):
            at = np.concatenate([np.full(len(rows[i][0]), k) for k, i in enumerate(batch)])
            slots = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            scores = np.bincount(at, weights[slots] * values, len(batch))
            y = grades[batch]
            below = 1 / (1 + np.exp(np.clip(scores[:, None] - thresholds[None, :], -60, 60)))
            below = np.concatenate([np.zeros((len(y), 1)), below, np.ones((len(y), 1))], axis=1)
            high, low = below[np.arange(len(y)), y + 1], below[np.arange(len(y)), y]
            span = np.maximum(high - low, 1e-9)
            slope = (1 - high - low) / len(y)
            by_slot, inverse = np.unique(slots, return_inverse=True)
            grad = np.bincount(inverse, slope[at] * values, len(by_slot))
            squares[by_slot] += grad ** 2
            weights[by_slot] -= rate * grad / np.sqrt(squares[by_slot])
            pull = np.zeros(n_grades + 1)
            np.add.at(pull, y + 1, -high * (1 - high) / span / len(y))
            np.add.at(pull, y, low * (1 - low) / span / len(y))
            pull = pull[1:-1]
            free_grad = np.cumsum(pull[::-1])[::-1] * np.concatenate([[1], np.exp(free[1:])])
            free_squares += free_grad ** 2
            free -= rate * free_grad / np.sqrt(free_squares)
    return weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, table=_SLOTS):
        found = [features(t) for t in as_bytes(batch, "body")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array([s.tobytes() for s, _ in found], pa.binary()),
             pa.array([v.tobytes() for _, v in found], pa.binary())], ["grade", "slots", "amounts"])


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text: str = "text", grade: str = "grade",
          sample: int = SAMPLE) -> dict | None:
    """Model of the ``grade`` numbers that ``ratings`` gives by ``id_col``; None without a rated text.

    At most ``sample`` ratings are used, in hash order of their id, and at most as
    many texts, fitted in one task.
    """
    rated = (ratings.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{grade}`").cast("double").alias("grade"))
             .where("id is not null and grade is not null and not isnan(grade)")
             .orderBy(F.xxhash64("id"), "id", "grade").limit(sample))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"))
    # At most sample rows of two numbers.
    rows = (texts.join(F.broadcast(rated), "id").select("grade", "body")
            .mapInArrow(_extract, "grade double, slots binary, amounts binary").limit(sample).repartition(1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(g, np.frombuffer(s, np.int32), np.frombuffer(v, np.float32)) for b in batches
                 for g, s, v in zip(*(b.column(c).to_pylist() for c in ("grade", "slots", "amounts")))]
        if not found:
            return
        # The fit does not depend on the order in which rows arrive.
        found.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
        levels, index = np.unique([g for g, _, _ in found], return_inverse=True)
        if len(levels) == 1:
            weights, thresholds = np.zeros(1 << BITS), np.empty(0)
        else:
            weights, thresholds = fit([(s, v) for _, s, v in found], index, len(levels))
        yield pa.RecordBatch.from_arrays(
            [pa.array([json.dumps(levels.tolist())]), pa.array([thresholds.tobytes()], pa.binary()),
             pa.array([weights.astype(np.float32).tobytes()], pa.binary())], ["levels", "thresholds", "weights"])

    model = rows.mapInArrow(task, "levels string, thresholds binary, weights binary").collect()
    if not model:
        return None
    return {"levels": np.array(json.loads(model[0]["levels"])), "thresholds": np.frombuffer(model[0]["thresholds"]),
            "weights": np.frombuffer(model[0]["weights"], np.float32)}


def score_text(model: dict, found: list[tuple[np.ndarray, np.ndarray]], cut: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and probability of a grade of ``cut`` or more."""
    levels = model["levels"]
    scores = np.array([float(model["weights"][s].astype(np.float64) @ v) for s, v in found])
    tails = np.concatenate([np.ones((len(found), 1)), probabilities(scores, model["thresholds"]),
                            np.zeros((len(found), 1))], axis=1)
    expected = (tails[:, :-1] - tails[:, 1:]) @ levels
    return expected, tails[:, int(np.searchsorted(levels, cut))]


def grade_documents(docs: DataFrame, model: dict | None, cut: float, text: str = "text",
                    names: tuple[str, str] = ("expected_grade", "tail")) -> DataFrame:
    """``docs`` with two more columns: expected grade and probability of a grade of ``cut`` or more.

    All rows and columns are kept. Null and empty texts have no features and get the
    grade that the thresholds alone give; without a model both columns are null; a
    model of one grade gives that grade with certainty.
    """
    columns = docs.columns
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in columns], *[F.lit(None).cast("double").alias(n) for n in names])
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(f"`{text}`").alias("body"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, table=_SLOTS):
            if batch.num_rows:
                expected, tail = score_text(model, [features(t) for t in as_bytes(batch, "body")], cut)
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(expected), pa.array(tail)],
                                                 ["doc", "expected", "tail"])

    schema = held.select("doc").schema.add("expected", "double").add("tail", "double")
    return held.mapInArrow(task, schema).select(*[F.col(f"doc.`{c}`").alias(c) for c in columns],
                                                F.col("expected").alias(names[0]), F.col("tail").alias(names[1]))
