"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming distance.

A fingerprint is cut into equal blocks. Two fingerprints that differ in at most
``blocks - agree`` bits agree on at least ``agree`` blocks, so every such pair
meets under one of the keys made of ``agree`` blocks, and no other pair has to
be looked at. The rows that share a key are compared on executors; a key gives
the edges of a minimum spanning forest of its rows, never all pairs. A key with
more than ``chunk`` rows is dealt into chunks and every pair of chunks is
compared by a task of its own, so no task holds more than two chunks and no
link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.texts import as_bytes, hash64, mix, needed, shingle_hashes, small
from hearthline.operators.components import connected_components
from hearthline.session import cut_lineage, discard

#: Rows of one key that are compared in one block.
CHUNK = 1_024
EDGES = "a long, b long, distance int"


def majority(hashes: np.ndarray) -> np.ndarray:
    """64 truth values: the bits set in over half of the hashes."""
    n = len(hashes)
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(n, 64)
    # Bytes are added eight at a time; 255 rows cannot overflow a byte.
    whole = n // 255 * 255
    counts = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        sums = bits[:whole].view(np.uint64).reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return counts * 2 > n


def fingerprint(hashes: np.ndarray, bits: int) -> bytes:
    """``bits / 8`` bytes, lowest bit first; zero for no hashes."""
    if not len(hashes):
        return bytes(bits // 8)
    parts = [majority(hashes if k == 0 else mix(hashes, k)) for k in range(bits // 64)]
    return np.packbits(np.concatenate(parts), bitorder="little").tobytes()


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", width: int = 3,
                 bits: int = 64) -> DataFrame:
    """The ``keys`` of every row with its fingerprint ``fp`` (binary) over runs of ``width`` words, repeats included.

    Null text, empty text and blanks have the zero fingerprint.
    """
    source = needed(docs, *keys, text)
    kept = needed(source, *keys).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [fingerprint(shingle_hashes(t, width), bits) for t in as_bytes(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(found, pa.binary())], [*keys, "fp"])

    return source.mapInArrow(task, kept.add("fp", "binary"))


def forest(nodes: list[int], prints: list[bytes], most: int) -> list[tuple[int, int, int]]:
    """Minimum spanning forest over the pairs at distance ``most`` or less (Prim's rule)."""
    codes = np.frombuffer(b"".join(prints), np.uint64).reshape(len(nodes), -1)
    left = np.arange(len(nodes))
    best = np.full(len(nodes), most + 1)
    parent = np.zeros(len(nodes), np.int64)
    edges = []
    while len(left):
        at = int(best.argmin())
        now = int(left[at])
        if best[at] <= most:
            edges.append((nodes[int(parent[at])], nodes[now], int(best[at])))
        keep = np.arange(len(left)) != at
        left, best, parent = left[keep], best[keep], parent[keep]
        apart = np.bitwise_count(codes[left] ^ codes[now]).sum(axis=1, dtype=np.int64)
        nearer = apart < best
        best[nearer], parent[nearer] = apart[nearer], now
    return edges


def _forests(most: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for members in batch.column("members").to_pylist():
                edges += forest([m["node"] for m in members], [m["fp"] for m in members], most)
            a, b, distance = zip(*edges) if edges else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(distance, pa.int32())],
                ["a", "b", "distance"])
    return task


def links(prints: DataFrame, bits: int = 64, blocks: int = 4, agree: int = 2, most: int = 2,
          chunk: int = CHUNK) -> DataFrame:
    """Edges ``a, b, distance`` that connect exactly what pairs at ``most`` bits connect.

    ``prints`` has one row ``node, fp`` per different fingerprint. All pairs at
    ``blocks - agree`` bits or less are certain to meet; beyond that a pair meets
    if ``agree`` of its blocks are equal.
    """
    size = bits // 8 // blocks
    keys = [F.concat(F.lit(bytes([i // 256, i % 256])), *[F.substring("fp", k * size + 1, size) for k in chosen])
            for i, chosen in enumerate(combinations(range(blocks), agree))]
    keyed = prints.select("node", F.explode(F.array(*keys)).alias("key"))
    shared = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))
    dealt = keyed.join(shared, "key").withColumn(
        "c", F.pmod(F.xxhash64("node", "key"), F.col("chunks")).cast("int"))
    # Chunk c meets every other chunk; a lone chunk meets itself.
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("chunks") - 1), F.col("c")))
    paired = (dealt.withColumn("d", F.explode(other))
              .select("node", "key", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j")))
    gathered = (paired.join(prints, "node").groupBy("key", "i", "j")
                .agg(F.collect_list(F.struct("node", "fp")).alias("members"))
                .where(F.size("members") > 1).select("members"))
    return (gathered.mapInArrow(_forests(most), EDGES)
            .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .agg(F.min("distance").alias("distance")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3,
                   bits: int = 64, blocks: int = 4, agree: int = 2, most: int = 2) -> DataFrame:
    """Fingerprint and linked group of every row: ``<id>, fp, component``.

    ``component`` is the smallest id reachable over links, the row's own included.
    Every row is a vertex of its own: equal ids and null ids do not link rows, and a
    group whose ids are all null has a null component. Rows with equal fingerprints,
    among them all texts without words, are one group. An empty table gives no rows.
    """
    rows = cut_lineage(fingerprints(
        needed(docs, id_col, text).withColumn("row", F.monotonically_increasing_id()),
        [id_col, "row"], text, width, bits))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("row").alias("node"), F.min(id_col).alias("low")))
    found = connected_components(links(nodes.select("node", "fp"), bits, blocks, agree, most), "a", "b")
    placed = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = placed.groupBy("component").agg(F.min("low").alias("lowest"))
    named = cut_lineage(placed.join(lows, "component").select("fp", F.col("lowest").alias("component")))
    discard(nodes)
    return rows.join(named, "fp").select(id_col, "fp", "component")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3,
                       bits: int = 64, blocks: int = 4, agree: int = 2, most: int = 2) -> DataFrame:
    """``docs`` with one row of each group that ``simhash_groups`` links.

    The row of the smallest id stays, null ids last, the first one read among equal
    ids. Texts without words are one group. Columns may have any names.
    """
    # Rows are numbered once and stored with their number, so that it means the same row later.
    held = cut_lineage(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("id"),
        F.monotonically_increasing_id().alias("row")))
    texts = held.select("id", "row", F.col(f"doc.`{text}`").alias("text"))
    rows = cut_lineage(fingerprints(texts, ["id", "row"], "text", width, bits))
    nodes = cut_lineage(rows.groupBy("fp").agg(
        F.min("row").alias("node"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")))
    found = connected_components(links(nodes.select("node", "fp"), bits, blocks, agree, most), "a", "b")
    placed = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    stays = placed.groupBy("component").agg(F.min("first").alias("stays"))
    named = placed.join(stays, "component").select("fp", F.col("stays.row").alias("stays"))
    gone = cut_lineage(rows.join(named, "fp").where("row <> stays").select("row"))
    discard(rows, nodes)
    return held.join(gone, "row", "left_anti").select("doc.*")
