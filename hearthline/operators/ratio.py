"""Insert-delete ratio of texts, and joins on it that lose no pair.

The ratio of two texts is twice the length of their longest common subsequence as
a share of both lengths, in whole hundredths: what counts are insertions and
deletions, a replaced character being one of each. Subsequences are found by
bit-parallel steps, one machine word per pair and character, for many pairs at once.

Joins compare only pairs that must be compared. Texts are taken apart into pairs
of neighbouring characters, both ends marked. An insertion breaks one of them, a
deletion two, so a pair of texts at a given ratio shares a number of them that
only depends on its lengths. With all in one order of rarity it is then enough
that the rarest few of both texts have one in common. Those are joined, the
frequent ones dealt over several tasks, and what meets is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthline.operators.text import token_sort_key

#: Texts under one pair of characters that meet in one task.
GROUP = 2_000
#: Pairs that are compared side by side.
PAIRS = 4_096
WORD = 63


def _numbers(texts: list[str], width: int) -> np.ndarray:
    """Code points, one row per text; behind a text are zeros."""
    data = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le"), np.uint32)
    return data.reshape(len(texts), width)


def _long_common(a: str, b: str) -> int:
    """Length of the longest common subsequence of texts of any length."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    mask = (1 << len(a)) - 1
    row = mask
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def common_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    found = np.zeros(len(left), np.int64)
    short = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right)]
    words = np.array([len(a) <= WORD for a, _ in short], bool) if short else np.zeros(0, bool)
    for k in np.flatnonzero(~words).tolist():
        found[k] = _long_common(*short[k])
    # Like lengths together, so that little is computed for the room behind texts.
    order = sorted(np.flatnonzero(words).tolist(), key=lambda k: (len(short[k][1]), len(short[k][0])))
    for at in range(0, len(order), PAIRS):
        part = order[at:at + PAIRS]
        a, b = [short[k][0] for k in part], [short[k][1] for k in part]
        wide, steps = max(map(len, a), default=0), max(map(len, b), default=0)
        if not wide or not steps:
            continue
        rows, columns = _numbers(a, wide), _numbers(b, steps)
        weights = np.uint64(1) << np.arange(wide, dtype=np.uint64)
        row = np.full(len(part), (1 << wide) - 1, np.uint64)
        mask = row.copy()
        # Zeros behind a text must meet nothing.
        rows = np.where(rows == 0, np.uint32(0xFFFFFFFF), rows)
        for j in range(steps):
            hit = ((rows == columns[:, j:j + 1]) * weights).sum(axis=1, dtype=np.uint64) & row
            row = ((row + hit) | (row - hit)) & mask
        found[part] = wide - np.bitwise_count(row)
    return found


def hundredths(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Ratio in whole hundredths, halves to the even number; two empty texts are equal."""
    total = np.asarray(total, np.int64)
    ratio = 200 * np.asarray(common, np.int64)
    whole, rest = ratio // np.maximum(total, 1), ratio % np.maximum(total, 1)
    up = (2 * rest > total) | ((2 * rest == total) & (whole % 2 == 1))
    return np.where(total == 0, 100, whole + up)


def _scored(left: str, right: str, threshold: int | None, out: str):
    """Adds the ratio of two columns to batches; with a threshold only rows that reach it stay."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in (left, right))
            known = [x is not None and y is not None for x, y in zip(a, b)]
            a, b = ([v or "" for v in side] for side in (a, b))
            total = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64)
            ratio = hundredths(common_lengths(a, b), total) if len(a) else total
            full = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ratio, pa.int64(), mask=~np.array(known, bool))], [*batch.schema.names, out])
            yield full if threshold is None else full.filter(pa.array(ratio >= threshold) if len(a) else pa.array([], pa.bool_()))
    return task


def with_ratio(df: DataFrame, a: str, b: str, out: str = "ratio") -> DataFrame:
    """``df`` with the token-sort ratio of two columns, 0 to 100; null if one of them is null."""
    keyed = df.withColumns({"_key_a": token_sort_key(a), "_key_b": token_sort_key(b)})
    schema = keyed.select("*").schema.add(out, "long")
    return keyed.mapInArrow(_scored("_key_a", "_key_b", None, out), schema).drop("_key_a", "_key_b")


def closest_by_ratio(df: DataFrame, column: str, phrase: str, k: int = 5) -> DataFrame:
    """The ``k`` distinct values with the highest ratio to a phrase, ties in order of the value."""
    scored = with_ratio(df.select(column).distinct().withColumn("_phrase", F.lit(phrase)), column, "_phrase")
    return scored.drop("_phrase").orderBy(F.desc_nulls_last("ratio"), column).limit(k)


# --- joins ----------------------------------------------------------------------------------------


def _allowed(total: Column, threshold: int) -> Column:
    """Most insertions and deletions of a pair of so many characters that rounds to the threshold or more.

    A ratio of t - 0.5 rounds to t only if t is even, which the bound includes.
    """
    return F.floor(total * F.lit(201 - 2 * threshold) / 200).cast("int")


def _width(threshold: int) -> int:
    """Characters of a piece: pairs while the shared number stays positive for all lengths, else single ones."""
    return 2 if threshold >= 68 else 1


def _pieces(keyed: DataFrame, threshold: int) -> DataFrame:
    """``side, id, key, gram`` of all pieces; the n-th occurrence of a piece is another piece."""
    if _width(threshold) == 2:
        marked = F.concat(F.lit("\x02"), F.col("key"), F.lit("\x03"))
        last = F.length("key") + 1
    else:
        marked, last = F.col("key"), F.length("key")
    single = keyed.select("side", "id", "key", F.explode(F.transform(
        F.sequence(F.lit(1), last), lambda k: F.substring(marked, k, F.lit(_width(threshold))))).alias("piece"))
    turn = F.row_number().over(W.partitionBy("side", "id", "piece").orderBy(F.lit(1)))
    return single.select("side", "id", "key", F.concat_ws("\x01", "piece", turn.cast("string")).alias("gram"))


def _rarest(keyed: DataFrame, threshold: int) -> DataFrame:
    """Of each text the rarest pieces, as many as make sure that similar texts share one, with their frequency."""
    pieces = _pieces(keyed, threshold)
    often = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    size = F.length("key")
    # Over all lengths in reach the fewest pieces that a partner shares.
    share = (201 - 2 * threshold) / 200
    reach = F.sequence(F.ceil(size * (1 - share) / (1 + share)).cast("int"), F.floor(size * (1 + share) / (1 - share)).cast("int"))
    if _width(threshold) == 2:
        # Half pieces: (a + b) / 2 + 1 - 1.5 edits, doubled.
        least = F.array_min(F.transform(reach, lambda b: size + b + 2 - 3 * _allowed(size + b, threshold)))
        kept = size + 1 - F.ceil(least / 2) + 1
    else:
        least = F.array_min(F.transform(reach, lambda b: size + b - _allowed(size + b, threshold)))
        kept = size - F.ceil(least / 2) + 1
    rank = F.row_number().over(W.partitionBy("side", "id").orderBy("n", "gram"))
    return (pieces.join(often, "gram").withColumn("rank", rank).where(F.col("rank") <= kept)
            .select("side", "id", "key", "gram", "n"))


def _pairs(keyed: DataFrame, threshold: int, left: int, right: int) -> DataFrame:
    """``id_a, id_b, ratio`` of pairs of a left and a right text at the threshold or above."""
    if not 1 <= threshold <= 100:
        raise ValueError("a threshold is 1 to 100")
    rare = _rarest(keyed, threshold)
    copies = F.ceil(F.col("n") / GROUP).cast("int")
    a = (rare.where(F.col("side") == left).withColumn("salt", F.pmod(F.xxhash64("id"), copies).cast("int"))
         .select("gram", "salt", F.col("id").alias("id_a"), F.col("key").alias("key_a")))
    b = (rare.where(F.col("side") == right).withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1)))
         .select("gram", "salt", F.col("id").alias("id_b"), F.col("key").alias("key_b")))
    total = F.length("key_a") + F.length("key_b")
    edits = _allowed(total, threshold)
    near = (F.abs(F.length("key_a") - F.length("key_b")) <= edits) & (F.levenshtein("key_a", "key_b") <= edits)
    if left == right:
        near = near & (F.col("id_a") < F.col("id_b"))
    met = a.join(b, ["gram", "salt"]).where(near).select("id_a", "id_b", "key_a", "key_b")
    schema = met.select("*").schema.add("ratio", "long")
    return met.mapInArrow(_scored("key_a", "key_b", threshold, "ratio"), schema).select("id_a", "id_b", "ratio").distinct()


def _keyed(words: DataFrame, column: str, side: int) -> DataFrame:
    return (words.select(F.col(column).alias("id")).where(F.col("id").isNotNull()).distinct()
            .select(F.lit(side).alias("side"), "id", token_sort_key("id").alias("key")).where(F.length("key") > 0))


def ratio_pairs(words: DataFrame, column: str, threshold: int) -> DataFrame:
    """``word_a, word_b, similarity``: distinct texts whose token-sort ratio is at least ``threshold``.

    Texts without a letter or digit, and nulls, are in no pair.
    """
    return _pairs(_keyed(words, column, 0), threshold, 0, 0).toDF("word_a", "word_b", "similarity")


def ratio_join(keywords: DataFrame, column: str, dictionary: DataFrame, word: str, threshold: int) -> DataFrame:
    """Dictionary words whose ratio to a keyword is at least ``threshold``, with the ratio as ``similarity``."""
    keyed = _keyed(keywords, column, 0).unionByName(_keyed(dictionary, word, 1))
    return _pairs(keyed, threshold, 0, 1).toDF(column, word, "similarity")
