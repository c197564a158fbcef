"""Benchmark decontamination by spaced seeds.

A mask slides over the words of a text; the hash at a position covers only the
words under the mask's ones, so a changed word under a zero does not matter. The
hashes of test items and of documents are joined, and every hit is checked: on
its diagonal, test item and document are compared word by word.

Document hashes first pass a bitmap of the test items' hashes. Its size is fixed
whatever the test set; it only lets through what could join, and the join
decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.texts import WORD_HASHES, as_bytes, mix, small, word_hashes
from hearthline.session import cut_lineage

#: Together they hit every overlap of 13 words with up to two changed words, and of
#: 15 words with up to three, wherever the changes are.
MASKS = ("111001101", "11010111", "111000001101")
LEAST_WORDS = 13
SHARE = 0.8
#: Bits of the bitmap, a power of two, and where in a hash its three places stand.
FILTER_BITS = 1 << 22
PROBES = (0, 21, 42)


def seeds(hashes: np.ndarray, masks: tuple[str, ...] = MASKS) -> tuple[np.ndarray, np.ndarray]:
    """Position and masked hash of every place where a mask fits."""
    places, found = [], []
    for k, mask in enumerate(masks):
        n = len(hashes) - len(mask) + 1
        if n <= 0:
            continue
        total = np.full(n, k + 1, np.uint64)
        for at in [i for i, c in enumerate(mask) if c == "1"]:
            total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[at:at + n]
            total ^= total >> np.uint64(29)
        places.append(np.arange(n))
        found.append(mix(total))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(places), np.concatenate(found)


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, least: int, share: float) -> tuple[int, int, int, int] | None:
    """Longest stretch of the diagonal with at least ``share`` of its words equal.

    Gives its first word in the document and in the item, its words and its equal
    words, or None below ``least`` words. ``diagonal`` is the document's position
    minus the item's.
    """
    low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if high - low < least:
        return None
    equal = doc[low + diagonal:high + diagonal] == item[low:high]
    gain = np.concatenate([[0], np.cumsum(np.where(equal, 1 - share, -share))])
    lowest = np.minimum.accumulate(gain)
    highest = np.maximum.accumulate(gain[::-1])[::-1]
    best = start = i = j = 0
    while j < len(gain):
        if highest[j] >= lowest[i] - 1e-9:
            if j - i > best:
                best, start = j - i, i
            j += 1
        else:
            i += 1
    if best < least:
        return None
    # Reported from its first to its last equal word.
    inside = np.flatnonzero(equal[start:start + best])
    first, last = start + int(inside[0]), start + int(inside[-1]) + 1
    return low + first + diagonal, low + first, last - first, int(equal[first:last].sum())


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, places, found = [], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for i, words in enumerate(batch.column("words").to_pylist()):
            p, h = seeds(np.frombuffer(words, np.uint64))
            at += [i] * len(p)
            places.append(p)
            found.append(h)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item").take(pa.array(at, pa.int64())), pa.array(np.concatenate(places)),
             pa.array(np.concatenate(found).view(np.int64))], ["item", "at", "seed"])


def _words(keys: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, table=WORD_HASHES):
            words = [word_hashes(t).tobytes() for t in as_bytes(batch, "body")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(words, pa.binary())],
                                             [*keys, "words"])
    return task


def _survivors(bitmap: np.ndarray, bits: int):
    """Documents with a place whose hash is in the bitmap, with these places."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, table=WORD_HASHES):
            index, words, hits = [], [], []
            for i, text in enumerate(as_bytes(batch, "body")):
                own = word_hashes(text)
                places, found = seeds(own)
                inside = np.ones(len(found), bool)
                for shift in PROBES:
                    slot = found >> np.uint64(shift) & np.uint64(bits - 1)
                    inside &= bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1) == 1
                if inside.any():
                    index.append(i)
                    words.append(own.tobytes())
                    hits.append([{"place": int(p), "seed": int(h)} for p, h in
                                 zip(places[inside], found[inside].view(np.int64))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(index, pa.int64())), pa.array(words, pa.binary()),
                 pa.array(hits, pa.list_(pa.struct([("place", pa.int64()), ("seed", pa.int64())])))],
                ["id", "words", "hits"])
    return task


def _verified(least: int, share: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, found = [], []
            for i, (doc, item, diagonals) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "words", "item_words", "diagonals")))):
                doc, item = np.frombuffer(doc, np.uint64), np.frombuffer(item, np.uint64)
                overlaps = [o for o in (overlap(doc, item, d, least, share) for d in diagonals) if o]
                if overlaps:
                    index.append(i)
                    found.append(max(overlaps, key=lambda o: (o[3], -o[0])))
            keys = pa.array(index, pa.int64())
            columns = list(zip(*found)) if found else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(keys) for c in ("row", "id", "item_id")),
                 *(pa.array(c, pa.int64()) for c in columns)],
                ["row", "id", "item_id", "doc_start", "item_start", "words", "equal_words"])
    return task


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
             text: str = "text", item_text: str = "text", least: int = LEAST_WORDS, share: float = SHARE,
             filter_bits: int = FILTER_BITS) -> DataFrame:
    """Documents that contain wording of a test item, one row per document row and item.

    ``<id>, <item>, doc_start, item_start, words, equal_words``: the longest stretch
    of consecutive words of which ``share`` are equal place by place, with at least
    ``least`` words, reported from its first to its last equal word. A passage with a word put in or left out is two stretches. Texts
    and items that are null, empty or shorter than ``least`` words overlap with
    nothing; repeated items and ids give a row each.
    """
    document = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"))
    test = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").alias("body"),
                        F.monotonically_increasing_id().alias("item"))
    kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((document, "id"), (test, "item_id")))
    tests = cut_lineage(test.mapInArrow(_words(["item_id", "item"]), f"item_id {item_kind}, item long, words binary")
                        .where(F.length("words") >= 8 * least))
    item_seeds = cut_lineage(tests.select("item", "words").mapInArrow(_item_seeds, "item long, at long, seed long"))
    # At most filter_bits / 64 numbers, whatever the items.
    slot = F.explode(F.array(*[F.shiftrightunsigned("seed", s).bitwiseAND(F.lit(filter_bits - 1)) for s in PROBES]))
    parts = item_seeds.select(slot.alias("slot")).select(
        F.shiftright("slot", 6).cast("int").alias("part"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
    bitmap = np.zeros(filter_bits // 64, np.uint64)
    for r in parts.groupBy("part").agg(F.bit_or("bit").alias("bits")).collect():
        bitmap[r["part"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    hit = document.mapInArrow(_survivors(bitmap, filter_bits), f"id {kind}, words binary, hits array<struct<place: long, seed: long>>")
    hit = cut_lineage(hit.withColumn("row", F.monotonically_increasing_id()))
    met = (hit.select("row", F.explode("hits").alias("h")).select("row", "h.place", "h.seed")
           .join(item_seeds, "seed").select("row", "item", (F.col("place") - F.col("at")).alias("diagonal"))
           .groupBy("row", "item").agg(F.collect_set("diagonal").alias("diagonals")))
    pairs = (met.join(hit.select("row", "id", "words"), "row")
             .join(tests.select("item", "item_id", F.col("words").alias("item_words")), "item"))
    found = pairs.mapInArrow(_verified(least, share),
                             f"row long, id {kind}, item_id {item_kind}, doc_start long, item_start long, "
                             "words long, equal_words long")
    return found.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col),
                        "doc_start", "item_start", "words", "equal_words")
