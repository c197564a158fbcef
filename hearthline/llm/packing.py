"""Best-fit packing by minimum bin slack.

A bin is seeded with the longest piece that is left; a subset sum over the
remaining lengths, kept as bits of one integer, finds the combination that fills
the rest best; its pieces are removed. How well a bin can be filled depends only
on how many pieces of each length are left, so the search runs over the table of
lengths (at most as many rows as a bin has tokens, whatever the corpus) and a
combination is repeated while its pieces last. Which piece goes where is then
arithmetic on a piece's rank among those of its length, done on executors.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthline.llm.texts import WordTable, needed, small
from hearthline.session import cut_lineage

CAPACITY = 2_048
#: Pieces of one length are ranked in so many parts.
PARTS = 64
#: Bytes of text whose words are looked up together.
TEXT_BYTES = 4 << 20
#: Entries of a worker's table of ids, of about 200 bytes each.
TABLE_LIMIT = 800_000
#: Strings that the tokenizer takes at once; its results are of about 1,000 bytes each.
STRINGS = 2_048
PIECES = (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"))


def best_fill(counts: dict[int, int], space: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``space``."""
    limit = (1 << (space + 1)) - 1
    reach, trail = 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= space), reverse=True):
        copies = min(counts[length], space // length)
        part = 1
        while copies:
            take = min(part, copies)
            grown = reach | (reach << (take * length)) & limit
            if grown != reach:
                trail.append((length, take, reach))
                reach = grown
            copies -= take
            part *= 2
        if reach >> space & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations with the number of bins each is used for. Every one uses up a length."""
    left = {n: c for n, c in counts.items() if c}
    found = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        content = best_fill(rest, capacity - longest)
        content[longest] = content.get(longest, 0) + 1
        times = min(left[n] // used for n, used in content.items())
        for n, used in content.items():
            left[n] -= used * times
            if not left[n]:
                del left[n]
        found.append((content, times))
    return found


def layout(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """For each length and run of ranks: the first bin, pieces per bin, first offset; sorted."""
    rows, bins, given = [], 0, {}
    for content, times in patterns(counts, capacity):
        offset = 0
        for length in sorted(content, reverse=True):
            used = content[length]
            begin = given.get(length, 0)
            rows.append((length, begin, bins, used, offset))
            given[length] = begin + used * times
            offset += used * length
        bins += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "begin", "bin", "used", "offset"), table.T))


def place(found: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of the pieces of given length and rank."""
    at = np.empty(len(length), np.int64)
    for n in np.unique(length):
        low, high = np.searchsorted(found["length"], [n, n + 1])
        own = length == n
        at[own] = low + np.searchsorted(found["begin"][low:high], rank[own], "right") - 1
    step, used = rank - found["begin"][at], found["used"][at]
    return found["bin"][at] + step // used, found["offset"][at] + step % used * length


def pieces_of(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """Piece, start, length and CRC-32 of a document's little-endian 32-bit ids."""
    step = capacity * 4
    return [(k, at // 4, min(step, len(ids) - at) // 4, zlib.crc32(ids[at:at + step]))
            for k, at in enumerate(range(0, len(ids), step))]


PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS_AFTER = r"^.*?([!-/:-@\[-`{-~]*)$"


def _encoder(path: str):
    """Function from a column of texts to their ids, an array of 32-bit numbers each.

    The vocabulary ignores case and never joins letters with ASCII punctuation, nor
    anything across white space. So texts are cut at ASCII white space, the different
    strings are looked up per worker, and those of new strings are put together from
    their letters and the punctuation after them; new letters go to the tokenizer at
    once. A text that may hold a special token goes there as it is.
    """
    # One thread a task: those of the tokenizer would take cores, and keep memory, of other tasks.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    table: dict[bytes, bytes] = {}

    def batch(found: list[bytes]) -> list[bytes]:
        ids = []
        for first in range(0, len(found), STRINGS):
            encoded = tokenizer.encode_batch_fast([f.decode() for f in found[first:first + STRINGS]],
                                                  add_special_tokens=False)
            ids += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return ids

    def lookup(found: list[bytes]) -> list[bytes]:
        if len(table) > TABLE_LIMIT:
            table.clear()
        new = [p for p in found if p not in table]
        table.update(zip(new, batch(new)))
        return [table[p] for p in found]

    def encode(texts: pa.StringArray) -> list[np.ndarray]:
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = lists.flatten().dictionary_encode()
        # Different strings become letters and marks, or stay as they are with no marks.
        strings = words.dictionary
        trimmed = pc.ascii_rtrim(strings, PUNCTUATION)
        apart = pc.utf8_is_alpha(trimmed)
        letters = pc.if_else(apart, trimmed, strings).dictionary_encode()
        marks = pc.if_else(apart, pc.replace_substring_regex(strings, _MARKS_AFTER, r"\1"), "").dictionary_encode()
        ids = lookup([p for d in (letters, marks) for p in d.dictionary.cast(pa.binary()).to_pylist()])
        flat, sizes = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        pairs = np.stack([letters.indices.to_numpy(), marks.indices.to_numpy() + len(letters.dictionary)], axis=1)
        index = pairs[words.indices.to_numpy()].ravel()
        ends = np.cumsum(sizes[index])
        step = np.repeat(starts[index] - (ends - sizes[index]), sizes[index])
        tokens = flat[step + np.arange(len(step))]
        cuts = np.append(0, ends)[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())]
        return [np.frombuffer(batch([texts[i].as_py().encode()])[0], "<u4") if special[i] else tokens[a:b]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    return encode


#: By path; the tokenizer and its table go when a task of another operator begins.
_ENCODERS = WordTable(_encoder)


def encoder(path: str):
    """What ``_encoder`` gives, made once per worker."""
    return _ENCODERS[path]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A function of the module finds the worker's own encoders; a closure would carry a copy of them.
    return small(batches, 4_000, _ENCODERS)


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """One row per piece: ``<id>, piece, start, length, ids_crc32``.

    A document is its ids and then ``end``; only one longer than ``capacity`` is cut.
    A null or empty text is the id ``end`` alone. ``tokenizer`` is the path of a
    tokenizers file whose pre-tokenization never joins text across white space.
    """
    source = needed(docs, id_col, text)
    tail = np.array([end], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            encode = encoder(tokenizer)
            rows, at = [], []
            texts = batch.column(text).fill_null("")
            group = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // TEXT_BYTES
            for first, stop in zip(*(np.searchsorted(group, np.unique(group), side) for side in ("left", "right"))):
                for i, ids in enumerate(encode(texts.slice(first, stop - first)), first):
                    found = pieces_of(ids.tobytes() + tail, capacity)
                    rows += found
                    at += [i] * len(found)
            piece, start, length, crc = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                [id_col, "piece", "start", "length", "ids_crc32"])

    schema = needed(source, id_col).schema
    for name, kind in PIECES:
        schema = schema.add(name, kind)
    return source.mapInArrow(task, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` from 1 to ``capacity``) plus ``sequence_id`` and ``offset``.

    Every column is kept. Repeated rows are packed as often as they occur; an empty
    table gives no rows.
    """
    held = cut_lineage(pieces.withColumn("_part", F.pmod(F.xxhash64(*pieces.columns), F.lit(PARTS)).cast("int"))
                       .withColumn("_row", F.monotonically_increasing_id())
                       .withColumn("_part", F.pmod(F.col("_part") + F.col("_row"), F.lit(PARTS)).cast("int")))
    # At most capacity x PARTS rows, whatever the corpus.
    sizes = cut_lineage(held.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("length", "_part").orderBy("_row"))
    ranked = (held.withColumn("_own", own).join(offsets, ["length", "_part"])
              .withColumn("_rank", F.col("_before") + F.col("_own") - 1)
              .select(*pieces.columns, "_rank"))
    table = layout(counts, capacity)
    names = pieces.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, offset = place(table, batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(bins), pa.array(offset)],
                [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(task, pieces.select("*").schema.add("sequence_id", "long").add("offset", "long"))
