"""Cheapest repair of conversation structure, with the least audit among the cheapest.

A repaired conversation alternates user and assistant, may begin with one system
row, and ends with the assistant. Its four states (begun, system, user, assistant)
times the places between rows are the nodes of a graph whose arcs are edits. A cost
pass from the end finds what every node still costs; arcs on a cheapest path stay.
Those arcs are then ranked by prefix doubling: by their first letter, by their
first two, four, eight letters and so on, the rank of twice as many letters being
the pair of the ranks of both halves, and a pointer leading that many letters on.
The arc of the least rank at the start is the least audit, and the pointers of its
length's binary digits give any of its letters at once.

Rows of a conversation are ordered on all executors by ranges, and cut into segments
of bounded length. Segments exchange only small things: a table of costs from
state to state, and the state in which the least path leaves. A conversation that
holds most of all rows is therefore worked on by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.texts import small
from hearthline.session import cut_lineage, discard

#: Rows of a segment, and places that one round of ranking covers.
SEGMENT = 4_096
CELLS = 200_000
BLANKS = " \t\n\x0b\x0c\r"
DELETE, RETAIN, REROLE, INSERT, TRUNCATED = 3, 0, 2, 2, 1
FAR = 1 << 40
# States: begun, system, user, assistant. A spoken row leads from each to this one.
NEXT = np.array([2, 2, 3, 2])
#: Cost of the rows to be added behind the last one, and the rows.
TAIL = np.array([0, 2 * INSERT, INSERT, 0])
ADDED = ["", "ua", "a", ""]
FITS, MUST_GO, CUT = 0, 1, 2


def _less(at_next: np.ndarray, initial: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Cost from every state before a row, given those behind it; axis 1 is the state."""
    shape = (len(initial),) + (1,) * (at_next.ndim - 2)
    extra = np.where(kind == CUT, TRUNCATED, 0) + np.where(kind == MUST_GO, FAR, 0)
    extra, initial = extra.reshape(shape), initial.reshape(shape)
    cost = at_next + DELETE
    spoken = at_next[:, NEXT]
    for state in range(4):
        role = 2 if state == 2 else 1
        heard = spoken[:, state] + extra
        best = np.where(initial == role, heard + RETAIN, heard + REROLE)
        if state == 0:
            best = np.where(initial == 0, np.minimum(best, at_next[:, 1] + extra + RETAIN), best)
        cost[:, state] = np.minimum(cost[:, state], best)
    user, assistant = cost[:, 2].copy(), cost[:, 3].copy()
    cost[:, 2] = np.minimum(user, assistant + INSERT)
    cost[:, 3] = np.minimum(assistant, user + INSERT)
    for state in (0, 1):
        cost[:, state] = np.minimum(cost[:, state], cost[:, 2] + INSERT)
    return np.minimum(cost, FAR)


def _waves(codes: list[np.ndarray]) -> Iterator[list[int]]:
    """Segments of like length together, within a bound on padded places."""
    order = sorted(range(len(codes)), key=lambda k: len(codes[k]))
    wave: list[int] = []
    for k in order:
        if wave and (len(wave) + 1) * (len(codes[k]) + 1) > CELLS:
            yield wave
            wave = []
        wave.append(k)
    if wave:
        yield wave


def _padded(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roles and kinds, right-aligned: all segments end at the last column. First column of each."""
    longest = max(map(len, codes))
    table = np.full((len(codes), longest), -1, np.int64)
    for row, own in zip(table, codes):
        row[longest - len(own):] = own
    return table // 3, table % 3, longest - np.array([len(c) for c in codes])


def transfers(codes: list[np.ndarray]) -> np.ndarray:
    """For each segment the cheapest cost from every state before it to every state behind it."""
    out = np.empty((len(codes), 4, 4), np.int64)
    for wave in _waves(codes):
        initial, kind, first = _padded([codes[k] for k in wave])
        cost = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, FAR), (len(wave), 4, 4)).copy()
        for i in range(initial.shape[1] - 1, -1, -1):
            on = first <= i
            cost[on] = _less(cost[on], initial[on, i], kind[on, i])
        out[wave] = cost
    return out


def least_audits(codes: list[np.ndarray], behind: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """For each segment and entry state the least of the cheapest audits and the state it leaves in.

    ``behind`` is what every state behind a segment still costs.
    """
    audits: list[list[str]] = [[] for _ in codes]
    leaves = np.empty((len(codes), 4), np.int64)
    for wave in _waves(codes):
        initial, kind, first = _padded([codes[k] for k in wave])
        lanes, n = initial.shape
        cost = np.empty((lanes, n + 1, 4), np.int64)
        cost[:, n] = behind[wave]
        for i in range(n - 1, -1, -1):
            on = first <= i
            cost[:, i] = 0
            cost[on, i] = _less(cost[on, i + 1], initial[on, i], kind[on, i])
        ranked = _Arcs(initial, kind, first, cost)
        found, states = ranked.paths()
        for k, own, state in zip(wave, found, states):
            audits[k], leaves[k] = own, state
    return audits, leaves


class _Arcs:
    """Arcs on cheapest paths, ranked by their first 1, 2, 4, ... letters."""

    LETTERS = np.frombuffer(b"\0DIKR", np.uint8)

    def __init__(self, initial, kind, first, cost):
        lanes, n = initial.shape
        node = np.arange(lanes * (n + 1) * 4).reshape(lanes, n + 1, 4)
        self.starts = node[np.arange(lanes), first]
        live = (np.arange(n)[None, :] >= first[:, None])
        extra = np.where(kind == CUT, TRUNCATED, 0)
        stays = live & (kind != MUST_GO)
        tails, heads, letters = [node[:, n].ravel()], [node[:, n].ravel()], [np.zeros(lanes * 4, np.int64)]

        def arcs(where, state, head, letter):
            tails.append(node[:, :n, state][where])
            heads.append(head[where])
            letters.append(np.full(int(where.sum()), letter))

        for s in range(4):
            here, role, to = cost[:, :n, s], 2 if s == 2 else 1, int(NEXT[s])
            arcs(live & (here == cost[:, 1:, s] + DELETE), s, node[:, 1:, s], 1)
            arcs(live & (here == cost[:, :n, to] + INSERT), s, node[:, :n, to], 2)
            heard = cost[:, 1:, to] + extra
            arcs(stays & (initial == role) & (here == heard + RETAIN), s, node[:, 1:, to], 3)
            if s == 0:
                arcs(stays & (initial == 0) & (here == cost[:, 1:, 1] + extra + RETAIN), s, node[:, 1:, 1], 3)
            arcs(stays & (here == heard + REROLE), s, node[:, 1:, to], 4)
        self.tail, self.head, self.letter = map(np.concatenate, (tails, heads, letters))
        self.nodes = node.size

    def least(self, rank: np.ndarray) -> np.ndarray:
        """The arc of the smallest rank that leaves each node."""
        order = np.lexsort((rank, self.tail))
        tail = self.tail[order]
        begins = np.flatnonzero(np.concatenate([[True], tail[1:] != tail[:-1]]))
        found = np.zeros(self.nodes, np.int64)
        found[tail[begins]] = order[begins]
        return found

    def paths(self) -> tuple[list[list[str]], np.ndarray]:
        rank = self.letter
        onward = self.least(rank)[self.head]
        pointers = [onward]
        while (self.letter[onward] != 0).any():
            pair = rank * (int(rank.max()) + 1) + rank[onward]
            rank = np.unique(pair, return_inverse=True)[1]
            onward = onward[onward]
            pointers.append(onward)
        begin = self.least(rank)[self.starts].ravel()
        # How many letters follow, by the largest jumps that do not end the path.
        at, length = begin.copy(), (self.letter[begin] != 0).astype(np.int64)
        for k in range(len(pointers) - 1, -1, -1):
            further = pointers[k][at]
            on = self.letter[further] != 0
            at[on] = further[on]
            length[on] += 1 << k
        last = np.where(self.letter[at] == 0, at, pointers[0][at])
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        arc = np.repeat(begin, length)
        for k, pointer in enumerate(pointers):
            on = (place >> k) & 1 == 1
            arc[on] = pointer[arc[on]]
        text = self.LETTERS[self.letter[arc]].tobytes().decode()
        ends = np.cumsum(length)
        words = [text[e - m:e] for e, m in zip(ends.tolist(), length.tolist())]
        return [words[k:k + 4] for k in range(0, len(words), 4)], (self.tail[last] % 4).reshape(-1, 4)


# --- Spark ---------------------------------------------------------------------------------------


@dataclass
class Repair:
    """``found``: one row per conversation. ``merged``: rows and edits, in order, for ``lines`` and ``digests``."""

    found: DataFrame
    merged: DataFrame


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.array(c, np.int64) for c in batch.column("codes").to_pylist()]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    legal = np.zeros((4, 4), bool)
    legal[[0, 1, 2], [1, 2, 1]] = True
    for batch in small(batches, 500):
        codes = _codes(batch)
        roles = [c // 3 for c in codes]
        wrong = [int((~legal[r[:-1], r[1:]]).sum()) for r in roles]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("seg"), batch.column("blank"), batch.column("duplicate"), batch.column("truncated"),
             pa.array(wrong, pa.int64()), pa.array([int(r[0]) for r in roles], pa.int32()),
             pa.array([int(r[-1]) for r in roles], pa.int32()),
             pa.array(transfers(codes).reshape(len(codes), 16).tolist(), pa.list_(pa.int64()))],
            ["conv", "seg", "blank", "duplicate", "truncated", "wrong", "head", "rear", "costs"])


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: what every segment's end still costs, faults between segments, and the whole cost."""
    for batch in small(batches, 500):
        out = []
        for parts in batch.column("parts").to_pylist():
            after, ends = TAIL, []
            for p in reversed(parts):
                ends.append(after)
                after = np.minimum((np.array(p["costs"]).reshape(4, 4) + after[None, :]).min(axis=1), FAR)
            seams = sum((a["rear"], b["head"]) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(parts, parts[1:]))
            out.append((*(sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")),
                        sum(p["wrong"] for p in parts) + seams, int(after[0]),
                        [{"seg": p["seg"], "behind": e.tolist()} for p, e in zip(parts, reversed(ends))]))
        columns = list(zip(*out)) if out else [()] * 6
        part = pa.list_(pa.struct([("seg", pa.int64()), ("behind", pa.list_(pa.int64()))]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], part)],
            ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "ends"])


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 500):
        audits, leaves = least_audits(_codes(batch), np.array(batch.column("behind").to_pylist(), np.int64).reshape(-1, 4))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("seg"), batch.column("places"), batch.column("codes"),
             pa.array(audits, pa.list_(pa.string())), pa.array(leaves.tolist(), pa.list_(pa.int32()))],
            ["conv", "seg", "places", "codes", "audits", "leaves"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which the path enters every segment; of the last one, what is added behind it."""
    for batch in small(batches, 500):
        segs, entries, added = [], [], []
        for parts in batch.column("parts").to_pylist():
            state = 0
            for p in parts:
                segs.append(p["seg"])
                entries.append(state)
                added.append("")
                state = p["leaves"][state]
            added[-1] = ADDED[state]
        yield pa.RecordBatch.from_arrays([pa.array(segs, pa.int64()), pa.array(entries, pa.int32()),
                                          pa.array(added, pa.string())], ["seg", "entry", "added"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row that something happens to: roles inserted before it, and what becomes of it."""
    for batch in small(batches, 500):
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("conv", "places", "codes", "audit", "entry", "added"))
        for conv, places, codes, audit, state, added in zip(*columns):
            at, before = 0, ""
            for letter in audit:
                if letter == "I":
                    state = int(NEXT[state])
                    before += "-sua"[state]
                    continue
                act = letter
                if letter == "K":
                    state = codes[at] // 3 + 1
                elif letter == "R":
                    state = int(NEXT[state])
                    act = "-sua"[state]
                if before or act != "D":
                    out.append((conv, places[at], 0, before, act))
                at, before = at + 1, ""
            # Inserts at the end of a segment belong to the next one's first row or to the tail.
            if before + added:
                out.append((conv, places[-1], 2, before + added, "D"))
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], batch.schema.field("conv").type), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string())],
            ["conv", "pos", "part", "before", "act"])


ROLES = {"u": "user", "a": "assistant"}


def _spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Conversation and line of every repaired row; a line of None opens a conversation."""
    now, action = object(), None
    for batch in small(batches):
        columns = (batch.column(c).to_pylist() for c in ("conv", "pos", "part", "before", "act", "role", "text"))
        for conv, pos, part, before, act, role, text in zip(*columns):
            if conv != now:
                now, action = conv, None
                yield conv, None
            if part != 1:
                for letter in before:
                    yield conv, (ROLES[letter], "")
                action = (pos, act)
            elif action is not None and action[0] == pos and action[1] != "D":
                yield conv, (ROLES.get(action[1], role), text)


def _digested(kind: pa.DataType):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, digests, state, begun = [], [], None, False
        for conv, line in _spoken(batches):
            if line is None:
                if state is not None:
                    digests.append(state.hexdigest())
                convs.append(conv)
                state, begun = hashlib.sha256(), False
                continue
            state.update(("\n" * begun + f"{line[0]}:{line[1]}").encode())
            begun = True
        if state is not None:
            digests.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(digests, pa.string())], ["conv", "digest"])
    return task


def _lines(kind: pa.DataType):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows):
            conv, at, role, text = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(conv, kind), pa.array(at, pa.int64()), pa.array(role, pa.string()),
                                               pa.array(text, pa.string())], ["conv", "at", "role", "text"])
        rows, at = [], 0
        for conv, line in _spoken(batches):
            if line is None:
                at = 0
                continue
            rows.append((conv, at, *line))
            at += 1
            if len(rows) == 1_000:
                yield packed(rows)
                rows = []
        if rows:
            yield packed(rows)
    return task


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> Repair:
    """Cheapest edits of every conversation.

    ``found`` has ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    Rows stand by turn, nulls first; equal turns by role, then by the MD5 of the text, so a table
    gives one result whatever order it is read in. A null role or text is one space. A row is
    blank, else a duplicate (same role and text before it in its conversation),
    else truncated (its last character that is no blank does not end a sentence); blank rows and
    duplicates are deleted. A null id is a conversation of its own; an empty table gives no rows.
    Texts of any length only pass through. An audit is one cell, as long as its conversation has edits.
    """
    named = rows.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    named = named.withColumn("digest", F.md5("text")).withColumn("twin", F.monotonically_increasing_id())
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest", "twin"]
    # Ranges follow each other, so a running number over partitions is the order of the whole table.
    stored = cut_lineage(named.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("pos", F.monotonically_increasing_id()).drop("twin"))
    # Blanks are taken off in the JVM; the last character left decides.
    bare = F.rtrim("text", F.lit(BLANKS))
    flags = stored.select("conv", "pos", "role", "digest", (bare == "").alias("blank"),
                          (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"))
    first = flags.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos"))
    marked = flags.join(first.select("pos", F.lit(True).alias("fresh")), "pos", "left")
    twice = ~F.col("blank") & F.col("fresh").isNull()
    cut = F.col("fresh").isNotNull() & F.col("open")
    initial = F.left("role", F.lit(1))
    code = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) * 3
            + F.when(F.col("blank") | twice, MUST_GO).when(cut, CUT).otherwise(FITS))
    coded = marked.select("conv", "pos", code.alias("code"), F.col("blank").cast("long").alias("blank"),
                          twice.cast("long").alias("duplicate"), cut.cast("long").alias("truncated"))
    # The low 33 bits of a running number count within a partition.
    block = F.shiftright("pos", 33) * (1 << 33) + F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / SEGMENT)
    held = (coded.groupBy("conv", block.alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"), F.min("pos").alias("seg"),
                 *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]))
    segments = cut_lineage(held.select("conv", "seg", F.col("rows.pos").alias("places"), F.col("rows.code").alias("codes"),
                                       "blank", "duplicate", "truncated"))
    conv = stored.schema["conv"].dataType.simpleString()
    summed = segments.mapInArrow(_summaries, f"conv {conv}, seg long, blank long, duplicate long, truncated long, "
                                             "wrong long, head int, rear int, costs array<long>")

    def gathered(frame, *columns):
        return frame.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", *columns))).alias("parts"))

    whole = cut_lineage(
        gathered(summed, "blank", "duplicate", "truncated", "wrong", "head", "rear", "costs")
        .mapInArrow(_behind, f"conv {conv}, blank long, duplicate long, truncated long, illegal long, cost long, "
                             "ends array<struct<seg: long, behind: array<long>>>"))
    ends = whole.select(F.explode("ends").alias("e")).select("e.seg", "e.behind")
    ranked = cut_lineage(segments.join(ends, "seg").mapInArrow(
        _ranked, f"conv {conv}, seg long, places array<long>, codes array<int>, audits array<string>, leaves array<int>"))
    entered = gathered(ranked, "leaves").mapInArrow(_entries, "seg long, entry int, added string")
    chosen = cut_lineage(ranked.join(entered, "seg").select(
        "conv", "seg", "places", "codes", F.col("audits")[F.col("entry")].alias("audit"), "entry", "added"))
    edits = cut_lineage(chosen.mapInArrow(_edits, f"conv {conv}, pos long, part int, before string, act string"))
    letters = F.concat("audit", F.repeat(F.lit("I"), F.length("added")))
    audits = (chosen.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", letters.alias("l")))).alias("p"))
              .select("conv", F.concat_ws("", "p.l").alias("audit")))
    turns = stored.groupBy("conv").agg((F.max("turn").cast("long") - F.min("turn").cast("long") + 1
                                        - F.count_distinct("turn")).alias("gaps"))
    # Nulls group as one value, so parts are brought together by grouping.
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    none = F.lit(None)
    parts = (whole.select("conv", *sums, none.cast("long").alias("gaps"), none.cast("string").alias("audit"))
             .unionByName(turns.select("conv", "gaps"), allowMissingColumns=True)
             .unionByName(audits, allowMissingColumns=True))
    found = cut_lineage(parts.groupBy("conv").agg(
        F.coalesce(F.max("gaps"), F.lit(0).cast("long")).alias("gaps"), *[F.max(c).alias(c) for c in sums],
        F.max("audit").alias("audit")))
    discard(segments, whole, ranked, chosen)
    nothing = [none.cast("string").alias(c) for c in ("before", "act")]
    texts = stored.select("conv", "pos", F.lit(1).alias("part"), *nothing, "role", "text")
    merged = (texts.unionByName(edits, allowMissingColumns=True).repartition("conv")
              .sortWithinPartitions("conv", "pos", "part"))
    return Repair(found, merged)


def _kind(df: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    kind = df.schema["conv"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def lines(found: Repair) -> DataFrame:
    """The repaired conversations: ``conv, at, role, text``, places from 0 without gaps."""
    name, kind = _kind(found.merged)
    return found.merged.mapInArrow(_lines(kind), f"conv {name}, at long, role string, text string")


def digests(found: Repair) -> DataFrame:
    """``conv, digest``: SHA-256 of a repaired conversation's ``role:text`` lines.

    Rows stream through one hash per conversation; none is kept.
    """
    name, kind = _kind(found.merged)
    return found.merged.mapInArrow(_digested(kind), f"conv {name}, digest string")
