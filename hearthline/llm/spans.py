"""Substring deduplication over sliding runs of sentences.

Every run of ``run`` consecutive sentences of every text is hashed. Runs with
equal hashes meet in one global aggregation that keeps each one's first place;
all later places lose the sentences the run covers. Only hashes and positions
are shuffled. A run that half the corpus shares is reduced before it moves, and
in the join back its places are split by adaptive execution.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.texts import hash64, small
from hearthline.session import cut_lineage, discard

RUN = 3
#: A sentence of more words counts as several, of at least and at most so many words.
LONG = 16
PIECE, PIECE_MOST = 5, 10
#: Runs of fewer words are too common to mean a copy.
LEAST_WORDS = 8

_END = re.compile(r"[.!?]+\s+|[。！？]+\s*|\n\s*")
_WORD = re.compile(r"\S+")


def word_cuts(words: list[bytes]) -> list[int]:
    """Places where a long sentence is cut, which the words around each place decide.

    A place is a cut if the hash of the two words after it is the smallest within
    ``PIECE - 1`` places on either side; the first of equal ones counts. What is longer
    than ``PIECE_MOST`` words between two cuts is cut again from the left, at the
    smallest hash in reach. Equal passages are therefore cut alike a few words after
    their beginning, whatever stands before them.
    """
    n, near = len(words), PIECE - 1
    codes = [hash64(b" ".join(words[p:p + 2])) for p in range(n)]
    lowest = [p for p in range(PIECE, n - near) if codes[p] < min(codes[p - near:p])
              and codes[p] <= min(codes[p:p + PIECE])]
    cuts, at = [], 0
    for stop in [*lowest, n]:
        while stop - at > PIECE_MOST:
            at = min(range(at + PIECE, min(at + PIECE_MOST, stop - PIECE) + 1), key=codes.__getitem__)
            cuts.append(at)
        if stop < n:
            cuts.append(stop)
        at = stop
    return cuts


def sentences(text: str) -> list[str]:
    """The text cut after each sentence and line; the pieces together are the text.

    A cut follows ``.``, ``!`` or ``?`` with white space after it, the full-width
    marks, or a line end. A piece of over ``LONG`` words is cut again by ``word_cuts``.
    Pieces without words join the one before.
    """
    cuts, at = [], 0
    for mark in [m.end() for m in _END.finditer(text)] + [len(text)]:
        piece = text[at:mark]
        n = len(piece.split())
        if n > LONG:
            found = list(_WORD.finditer(piece))
            starts = [found[k].start() for k in word_cuts([m.group().encode().lower() for m in found])]
            bounds = [0, *starts, len(piece)]
            cuts += [piece[a:b] for a, b in zip(bounds, bounds[1:])]
        elif n == 0 and cuts:
            cuts[-1] += piece
        elif piece:
            cuts.append(piece)
        at = mark
    return cuts


def run_hashes(text: str, run: int, least: int) -> list[tuple[int, int]]:
    """First sentence and hash of every run that has at least ``least`` words.

    Case of A-Z and the amount of white space make no difference.
    """
    parts = [p.encode().lower().split() for p in sentences(text)]
    sizes = [len(p) for p in parts]
    joined = [b" ".join(p) for p in parts]
    return [(i, hash64(b"\n".join(joined[i:i + run]))) for i in range(len(parts) - run + 1)
            if sum(sizes[i:i + run]) >= least]


def _runs(run: int, least: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at, place, found = [], [], []
            for i, text in enumerate(batch.column("body").to_pylist()):
                for p, h in run_hashes(text, run, least):
                    at.append(i)
                    place.append(p)
                    found.append(h)
            index = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(found, np.uint64).view(np.int64)), batch.column("id").take(index),
                 batch.column("body_hash").take(index), pa.array(place, pa.int32())], ["hash", "id", "body_hash", "place"])
    return task


def without(text: str, places: list[int], run: int) -> tuple[str, int]:
    """The text without the sentences of the runs at ``places``, and how many went."""
    parts = sentences(text)
    gone = {p + k for p in places for k in range(run)}
    return "".join(p for i, p in enumerate(parts) if i not in gone), len(gone)


def _cleaned(run: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts, counts = [], []
            for text, places in zip(batch.column("body").to_pylist(), batch.column("places").to_pylist()):
                if places:
                    text, n = without(text, places, run)
                else:
                    n = 0
                texts.append(text)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                ["doc", "body", "removed"])
    return task


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", run: int = RUN,
                   least: int = LEAST_WORDS, removed: str | None = "removed_sentences") -> DataFrame:
    """``docs`` with every sentence removed that a repeated run covers at a later place.

    Places are ordered by id (nulls last), then position in the text, and the first
    place of a run keeps it; copies inside one text count too. Rows with the same id
    and the same text are one document and are treated alike; the texts of one id are
    ordered by their hash. All columns and rows are kept. Null texts stay null; texts
    of fewer than ``run`` sentences have no run; a text may become empty. ``removed``
    names a further column with the number of sentences taken out.
    """
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
                       F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"),
                       F.xxhash64(f"`{text}`").alias("body_hash"))
    bodies = held.where("body is not null").select("id", "body_hash", "body")
    kind = bodies.schema["id"].dataType.simpleString()
    runs = cut_lineage(bodies.mapInArrow(_runs(run, least), f"hash long, id {kind}, body_hash long, place int"))
    spot = F.struct(F.col("id").isNull().alias("none"), "id", "body_hash", "place")
    firsts = cut_lineage(runs.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("first"))
                         .where("n > 1").select("hash", "first"))
    later = cut_lineage(runs.join(firsts, "hash").where(spot != F.col("first"))
                        .groupBy(F.col("id").alias("own"), "body_hash").agg(F.collect_set("place").alias("places")))
    discard(runs, firsts)
    same = held["id"].eqNullSafe(later["own"]) & (held["body_hash"] == later["body_hash"])
    found = held.join(later, same, "left").select("doc", "body", "places")
    schema = found.select("doc", "body").schema.add("removed", "integer")
    cleaned = found.mapInArrow(_cleaned(run), schema)
    values = [F.col("body").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in columns]
    return cleaned.select(*values, *([F.col("removed").alias(removed)] if removed else []))
