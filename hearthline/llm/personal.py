"""Personal data: exact patterns, and a linear-chain conditional random field for what they miss.

The field labels words (runs without blanks) as nothing or one of the kinds. Its
features are word shapes: the classes of a word's characters with repeats drawn
together and digits counted, of the word and of two words on either side, pairs of
neighbouring shapes, and the few plain words that the labelled table knows. It is
trained by gradient ascent on the exact log-likelihood (forward and backward sums).

Decoding is Viterbi's algorithm over many words at once. A word is certainly
nothing if that label beats every other by more than all transitions around it
could make up for; such words cut a text into short chains, which are decoded side
by side. The result is that of decoding whole texts.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.llm.texts import needed, small

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["", *KINDS]
#: Rows of the labelled table that training reads at most, in the order of their MD5.
MOST_LABELLED = 10_000
#: Bytes that are taken apart at a time, and words that are scored at a time.
PIECE = 1 << 20
WORDS = 100_000
CELLS = 200_000

# --- exact patterns -------------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits whose beginning has failed, hence the look back.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and a dotted domain, found from each ``@``."""
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            end = domain.end()
            yield begin, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def patterns(text: str) -> list[tuple[int, int, int]]:
    """``kind, start, end`` of every match, by kind as listed, then start; code points, end exclusive."""
    found = [(0, b, e) for b, e in emails(text)]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
                found.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(DIGITS.findall(m.group())) <= 15:
                    found.append((3, *m.span()))
    return found


# --- words and shapes -----------------------------------------------------------------------------

# Classes of bytes: blank, capital, small letter, digit, others by sign, rest together.
_SIGNS = b"@.-+()[]<>:/_=,;\"'"
CLASS = np.full(256, 4, np.uint8)
CLASS[list(b" \t\n\x0b\x0c\r")] = 0
CLASS[ord("A"):ord("Z") + 1] = 1
CLASS[ord("a"):ord("z") + 1] = 2
CLASS[0x80:] = 2
CLASS[ord("0"):ord("9") + 1] = 3
for _k, _sign in enumerate(_SIGNS):
    CLASS[_sign] = 5 + _k
LETTER = np.zeros(256, np.uint8)
LETTER[ord("A"):ord("Z") + 1] = LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
LONGEST_RUN = 7
_BASE = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(4_096, _BASE, np.uint64), dtype=np.uint64)


def _rolled(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """A hash of each group's values in order; ``group`` is ascending. Empty groups are zero."""
    out = np.zeros(groups, np.uint64)
    if len(values):
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        place = np.arange(len(values)) - np.repeat(begins, np.diff(np.append(begins, len(values))))
        out[group[begins]] = np.add.reduceat((values.astype(np.uint64) + np.uint64(1)) * POWERS[place % len(POWERS)], begins)
    return out


def _pieces(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of the data that end at a blank."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + PIECE)
        while end < len(data) and CLASS[data[end]] != 0:
            end += 1
        yield begin, np.frombuffer(data, np.uint8, end - begin, begin)
        begin = end


def shapes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte (exclusive), hash of the shape and hash of the letters of every word."""
    parts: list[tuple] = []
    for begin, codes in _pieces(data):
        kinds = CLASS[codes]
        shown = np.concatenate([[False], kinds != 0, [False]])
        edges = np.flatnonzero(shown[1:] != shown[:-1])
        first, last = edges[::2], edges[1::2]
        if not len(first):
            continue
        change = np.concatenate([[True], kinds[1:] != kinds[:-1]])
        runs = np.flatnonzero(change & (kinds != 0))
        ends = np.append(np.flatnonzero(change)[1:], len(kinds))[np.searchsorted(np.flatnonzero(change), runs)]
        length = np.where(kinds[runs] == 3, np.minimum(ends - runs, LONGEST_RUN), 1)
        shape = _rolled(kinds[runs].astype(np.int64) * 8 + length, np.searchsorted(first, runs, "right") - 1, len(first))
        at = np.flatnonzero(LETTER[codes])
        name = _rolled(LETTER[codes[at]], np.searchsorted(first, at, "right") - 1, len(first))
        parts.append((first + begin, last + begin, shape, name))
    if not parts:
        return (*(np.empty(0, np.int64),) * 2, *(np.empty(0, np.uint64),) * 2)
    return tuple(np.concatenate(c) for c in zip(*parts))


# --- the field ------------------------------------------------------------------------------------

REACH = (-2, -1, 0, 1, 2)
UNKNOWN, OUTSIDE = 0, 1


class Field:
    """Weights of the field: tables by shape, by known word and by pair of shapes, and transitions."""

    def __init__(self, shape_names: np.ndarray, word_names: np.ndarray):
        self.shape_names, self.word_names = shape_names, word_names
        s, w, k = len(shape_names) + 2, len(word_names) + 2, len(LABELS)
        self.by_shape = np.zeros((len(REACH), s, k))
        self.by_word = np.zeros((len(REACH), w, k))
        self.by_pair = np.zeros((2, s * s, k))
        self.moves = np.zeros((k, k))

    def weights(self) -> list[np.ndarray]:
        return [self.by_shape, self.by_word, self.by_pair, self.moves]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, self.shape_names, self.word_names, *self.weights())
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Field:
        held = np.load(io.BytesIO(data))
        own = cls(held["arr_0"], held["arr_1"])
        own.by_shape, own.by_word, own.by_pair, own.moves = (held[f"arr_{k}"] for k in range(2, 6))
        return own

    @staticmethod
    def _numbers(names: np.ndarray, found: np.ndarray) -> np.ndarray:
        if not len(names):
            return np.full(len(found), UNKNOWN)
        at = np.minimum(np.searchsorted(names, found), len(names) - 1)
        return np.where(names[at] == found, at + 2, UNKNOWN)

    def features(self, text_of: np.ndarray, shape: np.ndarray, word: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Numbers of shapes and words around every word; beyond its text lies ``OUTSIDE``."""
        n, shape, word = len(shape), self._numbers(self.shape_names, shape), self._numbers(self.word_names, word)
        around: tuple[list, list] = ([], [])
        for d in REACH:
            at = np.arange(n) + d
            inside = (at >= 0) & (at < n)
            at = np.clip(at, 0, max(n - 1, 0))
            inside &= text_of[at] == text_of
            for own, out in zip((shape, word), around):
                out.append(np.where(inside, own[at], OUTSIDE))
        return around

    def pairs(self, shape: list[np.ndarray]) -> list[np.ndarray]:
        s = self.by_shape.shape[1]
        return [shape[1] * s + shape[2], shape[2] * s + shape[3]]

    def scores(self, shape: list[np.ndarray], word: list[np.ndarray]) -> np.ndarray:
        out = sum(t[k] for t, k in zip(self.by_shape, shape)) + sum(t[k] for t, k in zip(self.by_word, word))
        return out + sum(t[k] for t, k in zip(self.by_pair, self.pairs(shape)))

    def needed(self) -> np.ndarray:
        """By how much "nothing" must lead every label to be certain whatever the neighbours are."""
        t = self.moves
        return (t - t[:, :1]).max(axis=0) + (t - t[:1, :]).max(axis=1)

    def decode(self, score: np.ndarray, chain: np.ndarray) -> np.ndarray:
        """Best labels of chains (``chain`` is ascending); on both sides of a chain is nothing."""
        labels = np.zeros(len(score), np.int64)
        if not len(score):
            return labels
        begins = np.flatnonzero(np.concatenate([[True], chain[1:] != chain[:-1]]))
        length = np.diff(np.append(begins, len(chain)))
        order = np.argsort(length, kind="stable")
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * length[order[stop]] <= CELLS:
                stop += 1
            lanes = order[at:stop]
            at = stop
            self._viterbi(score, begins[lanes], length[lanes], labels)
        return labels

    def _viterbi(self, score, begins, length, labels) -> None:
        n, lanes = int(length.max()), np.arange(len(begins))
        best = self.moves[0] + score[begins]
        back = np.zeros((n, len(begins), len(LABELS)), np.int8)
        for t in range(1, n):
            on = length > t
            ways = best[on][:, :, None] + self.moves
            back[t, on] = ways.argmax(axis=1)
            best[on] = ways.max(axis=1) + score[begins[on] + t]
        state = (best + self.moves[:, 0]).argmax(axis=1)
        for t in range(n - 1, -1, -1):
            on = length > t
            labels[begins[on] + t] = state[on]
            state = np.where(on, back[t, lanes, state], state)


# --- training -------------------------------------------------------------------------------------

MARK = re.compile(r"\{(email|ip|card|phone)\|([^}]*)\}")


def read_marks(line: str) -> tuple[bytes, list[tuple[int, int, int]]]:
    """A line of the labelled table as text, and ``label, start, end`` of its marks in bytes."""
    text, marks, at = b"", [], 0
    for m in MARK.finditer(line):
        text += line[at:m.start()].encode()
        marks.append((LABELS.index(m.group(1)), len(text), len(text) + len(m.group(2).encode())))
        text += m.group(2).encode()
        at = m.end()
    return text + line[at:].encode(), marks


def _beside(text: bytes, marks: list[tuple[int, int, int]]) -> set[bytes]:
    """Words of letters within marks, or at most two words from one."""
    words = [(m.start(), m.end(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    inside = [any(b < e and a > s for _, s, e in marks) for b, a, _ in words]
    near = [any(inside[max(0, k - 2):k + 3]) for k in range(len(words))]
    found = (re.sub(rb"[^A-Za-z]", b"", w).lower() for (_, _, w), n in zip(words, near) if n)
    return {w for w in found if w}


def train_field(lines: list[str], rounds: int = 200, rate: float = 0.1, shrink: float = 0.01) -> Field:
    """A field fitted to marked lines (Adam on the penalised log-likelihood). No lines: everything is nothing."""
    rows = [read_marks(line) for line in lines]
    # A known word alone, however often, says nothing.
    alone = sorted({w for text, marks in rows for w in _beside(text, marks)})
    rows += [(line, []) for w in alone for line in (b" ".join([w] * 5) + b".", b", ".join([w.title()] * 5))]
    data = b"\n".join(text for text, _ in rows)
    starts = np.cumsum([0, *[len(text) + 1 for text, _ in rows]])[:-1] if rows else np.empty(0, np.int64)
    first, last, shape, word = shapes(data)
    text_of = np.searchsorted(starts, first, "right") - 1
    truth = np.zeros(len(first), np.int64)
    for begin, (_, marks) in zip(starts, rows):
        for label, b, e in marks:
            truth[(first < begin + e) & (last > begin + b)] = label
    # Only words next to or within marks, in two lines or more, are worth knowing by name.
    near = np.zeros(len(first), bool)
    for d in REACH:
        near |= np.roll(truth, d) > 0
    known, lines_with = np.unique(np.unique(np.stack([word[near & (word != 0)], text_of[near & (word != 0)].astype(np.uint64)]),
                                            axis=1)[0], return_counts=True)
    # Shapes seen once and outside marks stand for all shapes that are never seen.
    names, counts = np.unique(shape, return_counts=True)
    marked = np.unique(shape[truth > 0])
    field = Field(names[(counts > 1) | np.isin(names, marked)], known[lines_with > 1])
    field.by_shape[2, UNKNOWN, 0] = 4.0
    if not len(first):
        return field
    around, known = field.features(text_of, shape, word)
    pairs = field.pairs(around)
    length = np.bincount(text_of, minlength=len(rows))
    lanes = np.flatnonzero(length)
    begins = np.cumsum(length)[lanes] - length[lanes]
    length = length[lanes]
    mean, square = [np.zeros_like(w) for w in field.weights()], [np.zeros_like(w) for w in field.weights()]
    for step in range(1, rounds + 1):
        score = field.scores(around, known)
        share, moved = _expected(score, field.moves, begins, length)
        gap = -share
        gap[np.arange(len(truth)), truth] += 1
        slopes = [np.zeros_like(w) for w in field.weights()]
        for table, own in ((slopes[0], around), (slopes[1], known), (slopes[2], pairs)):
            for part, k in zip(table, own):
                for label in range(len(LABELS)):
                    part[:, label] = np.bincount(k, gap[:, label], len(part))
        slopes[3] = _moves(truth, begins, length) - moved
        for w, g, m, v in zip(field.weights(), slopes, mean, square):
            g -= shrink * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def _moves(truth: np.ndarray, begins: np.ndarray, length: np.ndarray) -> np.ndarray:
    k = len(LABELS)
    out = np.zeros((k, k))
    for b, n in zip(begins, length):
        own = np.concatenate([[0], truth[b:b + n], [0]])
        np.add.at(out, (own[:-1], own[1:]), 1)
    return out


def _expected(score, moves, begins, length) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label of each word, and expected number of each transition."""
    def total(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    lanes, n, k = len(begins), int(length.max()), len(LABELS)
    at = np.minimum(begins[:, None] + np.arange(n), len(score) - 1)
    held = score[at]
    ahead = np.empty((lanes, n, k))
    ahead[:, 0] = moves[0] + held[:, 0]
    for t in range(1, n):
        ahead[:, t] = total(ahead[:, t - 1][:, :, None] + moves, 1) + held[:, t]
    behind = np.empty((lanes, n, k))
    for t in range(n - 1, -1, -1):
        if t == n - 1:
            behind[:, t] = moves[:, 0]
        else:
            inner = total(moves[None] + (held[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where((length == t + 1)[:, None], moves[:, 0], inner)
    whole = total(ahead[np.arange(lanes), length - 1] + moves[:, 0], 1)
    live = np.arange(n)[None, :] < length[:, None]
    share = np.exp(ahead + behind - whole[:, None, None])
    moved = np.zeros((k, k))
    moved[0] += share[:, 0].sum(axis=0)
    moved[:, 0] += share[np.arange(lanes), length - 1].sum(axis=0)
    if n > 1:
        steps = np.exp(ahead[:, :-1, :, None] + moves + (held + behind)[:, 1:, None, :] - whole[:, None, None, None])
        moved += steps[live[:, 1:]].sum(axis=0)
    return share[live], moved


def train(labelled: DataFrame, column: str = "line", most: int = MOST_LABELLED) -> bytes:
    """The field as bytes, fitted in one task on at most ``most`` lines. Null lines take no part."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = sorted({v for b in batches for v in b.column("line").to_pylist() if v is not None})
        yield pa.RecordBatch.from_arrays([pa.array([train_field(lines).dump()], pa.binary())], ["field"])

    rows = (labelled.select(F.col(f"`{column}`").alias("line")).where("line is not null")
            .orderBy(F.md5("line"), "line").limit(most).coalesce(1))
    found = rows.mapInArrow(task, "field binary").first()
    return found["field"] if found else train_field([]).dump()


# --- search ---------------------------------------------------------------------------------------


def modelled(texts: list[bytes], field: Field) -> list[list[tuple[int, int, int]]]:
    """``kind, first byte, last byte`` (exclusive) of the field's spans in every text."""
    found: list[list] = [[] for _ in texts]
    data = b"\n".join(texts)
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    first, last, shape, word = shapes(data)
    text_of = np.searchsorted(starts, first, "right") - 1
    lead, open_words, open_scores = field.needed(), [], []
    for begin in range(0, len(first), WORDS):
        # Two more words on either side are the context of those in between.
        low, high = max(0, begin - 2), min(len(first), begin + WORDS + 2)
        score = field.scores(*field.features(text_of[low:high], shape[low:high], word[low:high]))
        score = score[begin - low:begin - low + WORDS]
        open_ = ((score[:, :1] - score)[:, 1:] <= lead[1:]).any(axis=1)
        open_words.append(np.flatnonzero(open_) + begin)
        open_scores.append(score[open_])
    if not open_words:
        return found
    at, score = np.concatenate(open_words), np.concatenate(open_scores)
    apart = np.ones(len(at), bool)
    apart[1:] = (at[1:] != at[:-1] + 1) | (text_of[at[1:]] != text_of[at[:-1]])
    labels = field.decode(score, np.cumsum(apart))
    previous = (-2, 0)
    for k, label in zip(at[labels > 0].tolist(), labels[labels > 0].tolist()):
        own = found[text_of[k]]
        if own and previous == (k - 1, label):
            own[-1][2] = int(last[k] - starts[text_of[k]])
        else:
            own.append([label - 1, int(first[k] - starts[text_of[k]]), int(last[k] - starts[text_of[k]])])
        previous = (k, label)
    return found


# What a span of the field must hold: signs of its kind, and no more than a line's worth of words.
PLAUSIBLE = [re.compile(r"(?i)(?=.*(@|\bat\b|[(\[]\s*a\s*[)\]]))(?=.*(\S\.\S|\b(dot|point|punkt|punto)\b))(\S+\s+){0,8}\S+"),
             re.compile(r"(?s)(?=(.*[.:]){2})(?=.*[0-9]).{3,60}"),
             re.compile(r"(?s)(?=(.*?[0-9]){12})(?!(.*?[0-9]){20}).{12,60}"),
             re.compile(r"(?s)(?=(.*?[0-9]){6})(?!(.*?[0-9]){16}).{6,60}")]
# Signs that are cut off a span's ends.
_STRIP_LEFT = bytes(b for b in range(128) if not (chr(b).isalnum() or chr(b) in "+("))
_STRIP_RIGHT = bytes(b for b in range(128) if not (chr(b).isalnum() or chr(b) == ")"))


def spans_of(text: bytes, base: list[tuple[int, int, int]], added: list[list[int]]) -> list[tuple[int, int, int, bool]]:
    """``kind, start, end, whether a pattern found it`` in code points; the field's spans only where no pattern matched."""
    out = [(*b, True) for b in base]
    if added:
        place = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
        taken = sorted((b, e) for _, b, e in base)
        begins = [b for b, _ in taken]
        ends = np.maximum.accumulate([e for _, e in taken]) if taken else []
        for kind, b, e in added:
            own = text[b:e]
            left = len(own) - len(own.lstrip(_STRIP_LEFT))
            right = len(own.rstrip(_STRIP_RIGHT))
            if left >= right:
                continue
            told = own[left:right].decode()
            if len(told) > 400 or not PLAUSIBLE[kind].fullmatch(told):
                continue
            if KINDS[kind] == "card" and not luhn("".join(DIGITS.findall(told))):
                continue
            start, end = int(place[b + left]), int(place[b + right])
            before = int(np.searchsorted(begins, end)) if begins else 0
            if not before or ends[before - 1] <= start:
                out.append((kind, start, end, False))
    return sorted(out)


FOUND = "spans array<struct<kind: string, start: long, end: long, base: boolean>>"


def find(docs: DataFrame, field: bytes, keys: list[str], text: str = "text") -> DataFrame:
    """The ``keys`` of every row with ``spans``: kind, start, end (code points, exclusive), whether a pattern found it.

    Patterns match per kind, leftmost first and without overlap; the field adds spans that meet
    none of theirs. Spans stand by kind as listed, then start. A null text is empty; empty
    texts, blanks and an empty table give no spans; texts of any length are read whole, a
    megabyte of bytes at a time; repeated rows are rows like others.
    """
    source = needed(docs, *keys, text)
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field.load(field)
        for batch in small(batches, 500):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            codes = [t.encode() for t in texts]
            added = modelled(codes, own)
            rows = [[{"kind": KINDS[k], "start": b, "end": e, "base": p} for k, b, e, p in spans_of(c, patterns(t), a)]
                    for t, c, a in zip(texts, codes, added)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(rows, pa.list_(struct))],
                                             [*keys, "spans"])

    kept = needed(source, *keys).schema
    return source.mapInArrow(task, StructType([*kept.fields, *StructType.fromDDL(FOUND).fields]))
