"""Log-likelihood of whole texts by a gated recurrent language model.

Counts of all training words are gathered from the whole corpus. The most
frequent words are predicted one by one, all others by a class (how the word ends,
its script, how often it was seen) and their share of that class; a word that
training has not seen is a class of its own. The output softmax is factored: first
the class, then the word inside the class.

The model is trained by truncated backpropagation in numpy. In each round every
task trains on its part of that round's texts, starting from the same model, and
the models are averaged by tokens; the rounds together cover every training text once.
A window of few tokens waits for the next ones before the model takes a step. In training
and scoring the state runs on from window to window to the end of a text; a text starts
from the zero state.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.blas import one_thread
from hearthline.llm.texts import hash64, only
from hearthline.session import cut_lineage, discard

#: Words predicted one by one, and how many share a class.
HEAD, CLASS = 1_024, 32
#: Classes of all other words: 8 shapes, and counts from 1, 2, 4, 11 and 51.
BOUNDS = (2, 4, 11, 51)
TAIL = 8 * (len(BOUNDS) + 1)
UNSEEN = HEAD + TAIL
WIDTH, HIDDEN = 16, 16
CLASSES = HEAD // CLASS + TAIL + 1

BLOCK_BYTES = 32 << 20
#: Rounds of training; each uses another part of the training texts, all of them together once.
ROUNDS = 3
WINDOW, LANES = 16, 256
SCORE_WINDOW, SCORE_LANES, SCORE_TOKENS = 64, 256, 1_000_000
#: Text whose words are taken apart at once.
PIECE_BYTES = 4 << 20
#: Rows of one class that meet its words in one product.
SHEET = 32
RATE = 4e-3
SEED = 5


#: Ending of a word by its last byte: a letter or no ASCII, a full stop, a comma, anything else.
ENDINGS = np.full(256, 3, np.uint8)
ENDINGS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = 0
ENDINGS[[ord("."), ord(",")]] = 1, 2


def _word_codes(found: pa.Array) -> np.ndarray:
    """61 bits of each word's hash and 3 bits of its shape, as signed numbers; no word may be empty."""
    if not len(found):
        return np.empty(0, np.int64)
    plain = found.cast(pa.binary()).to_numpy(zero_copy_only=False)
    data = np.frombuffer(b"".join(plain), np.uint8)
    ends = np.cumsum(pc.binary_length(found).to_numpy(), dtype=np.int64)
    beyond = np.maximum.reduceat(data, np.append(0, ends[:-1])) >= 0x80
    shape = 4 * beyond.astype(np.uint64) + ENDINGS[data[ends - 1]]
    return (np.fromiter(map(hash64, plain), np.uint64, len(plain)) & ~np.uint64(7) | shape).view(np.int64)


def _code(word: bytes) -> int:
    return int(_word_codes(pa.array([word], pa.string()))[0])


#: White space is no word, so this is none's code.
END = _code(b"\n")


def coded(body: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the different words of some texts, first that of the end; the place there of
    every text's words and end, in order; and how many those are by text.

    Arrow's ASCII rules are those of ``texts.words``: A-Z are lowered, words end at 0x20 and 0x09-0x0D.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(body))
    found = split.flatten()
    held = pc.binary_length(found).to_numpy() > 0
    before = np.append(0, np.cumsum(held))
    sizes = np.diff(before[split.offsets.to_numpy()]) + 1
    # White space at either side of a text leaves empty pieces.
    listed = (found if held.all() else found.filter(pa.array(held))).dictionary_encode()
    places = np.zeros(int(sizes.sum()), np.int32)
    inside = np.ones(len(places), bool)
    inside[np.cumsum(sizes) - 1] = False
    places[inside] = listed.indices.to_numpy() + 1
    return np.append(END, _word_codes(listed.dictionary)), places, sizes


# --- the model --------------------------------------------------------------------------------

SHAPES = {"embed": (UNSEEN + 1, WIDTH), "inner": (WIDTH, 3 * HIDDEN), "state": (HIDDEN, 3 * HIDDEN),
          "bias": (3 * HIDDEN,), "by_class": (HIDDEN, CLASSES), "class_bias": (CLASSES,),
          "by_word": (HEAD, HIDDEN), "word_bias": (HEAD,)}


def class_of(tokens: np.ndarray) -> np.ndarray:
    return np.where(tokens < HEAD, tokens // CLASS, tokens - HEAD + HEAD // CLASS)


def initial(class_shares: np.ndarray, word_counts: np.ndarray) -> dict[str, np.ndarray]:
    """A model that predicts the given shares whatever came before."""
    draw = np.random.default_rng(SEED)
    model = {k: (draw.normal(0, 0.15, s) if len(s) == 2 else np.zeros(s)).astype(np.float32)
             for k, s in SHAPES.items()}
    model["by_class"] *= 0.1
    model["by_word"] *= 0.1
    model["class_bias"] = np.log(np.maximum(class_shares, 1e-9)).astype(np.float32)
    model["word_bias"] = np.log(word_counts + 1e-3).astype(np.float32)
    return model


def packed(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in SHAPES])


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1]
    return {k: part.reshape(s) for (k, s), part in zip(SHAPES.items(), np.split(flat, sizes))}


def by_gate(values: np.ndarray) -> np.ndarray:
    """Rows of three gates side by side as one block for each gate."""
    return np.ascontiguousarray(values.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))


def forward(model, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each step of a window (steps x lanes x hidden).

    ``keep`` is zero where a text begins, which clears the lane's state.
    """
    h = HIDDEN
    steps, lanes = inputs.shape
    # Gates are 0.5 * tanh(x / 2) + 0.5; the half is in the weights. Reset, update and new lie apart.
    half = np.array([0.5, 0.5, 1], model["state"].dtype)[:, None, None]
    drive = np.take(by_gate(model["embed"] @ model["inner"] + model["bias"]) * half, inputs, axis=1)
    weights = by_gate(model["state"]) * half
    states = np.empty((steps, lanes, h), drive.dtype)
    begins = (keep == 0).any(axis=1)
    kept = None if trace is None else np.empty((5, steps, lanes, h), drive.dtype)
    for t in range(steps):
        before = state * keep[t][:, None] if begins[t] else state
        u = before @ weights
        gates = drive[:2, t] + u[:2]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        reset, update = gates
        new = reset * u[2]
        new += drive[2, t]
        np.tanh(new, out=new)
        state = np.subtract(before, new, out=states[t])
        state *= update
        state += new
        if kept is not None:
            kept[0, t], kept[1:3, t], kept[3, t], kept[4, t] = before, gates, new, u[2]
    if trace is not None:
        trace.append(kept)
    return states


def _exponentials(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of ``x`` (changed in place) and their sums by row; ``x`` is lowered if they could overflow.

    States lie between -1 and 1, which bounds every sum of products.
    """
    if (np.abs(weights).sum(axis=0) + np.abs(bias)).max(initial=0) > 60:
        x -= x.max(axis=1, keepdims=True)
    values = np.exp(x)
    return values, values @ np.ones(values.shape[1], values.dtype)


def outputs(model, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Natural log-probability of each target (class, then word), and the slope of the loss by state.

    ``states`` is tokens x hidden. With ``grads`` the slopes of the mean loss are added to it.
    """
    n = len(targets)
    rows_of = np.arange(n)
    wanted = class_of(targets)
    logits = states @ model["by_class"] + model["class_bias"]
    values, sums = _exponentials(logits, model["by_class"], model["class_bias"])
    result = (logits[rows_of, wanted] - np.log(sums)).astype(np.float64)
    slope = None
    if grads is not None:
        values *= (1 / (sums * n))[:, None]
        values[rows_of, wanted] -= 1 / n
        grads["by_class"] += states.T @ values
        grads["class_bias"] += values.sum(axis=0)
        slope = values @ model["by_class"].T
    # Words of the head, class by class in sheets of SHEET rows; the rest of a class's last sheet stays empty.
    order = np.argsort(wanted.astype(np.uint8), kind="stable")
    sizes = np.bincount(wanted, minlength=CLASSES)[:HEAD // CLASS]
    order = order[:sizes.sum()]
    if not len(order):
        return result, slope
    sheets = -(-sizes // SHEET)
    kinds = np.repeat(np.arange(HEAD // CLASS), sheets)
    lines = np.arange(len(order)) + np.repeat((np.cumsum(sheets) - sheets) * SHEET - (np.cumsum(sizes) - sizes), sizes)
    filled = np.zeros((len(kinds), SHEET, states.shape[1]), states.dtype)
    filled.reshape(-1, states.shape[1])[lines] = states[order]
    weights = model["by_word"].reshape(-1, CLASS, HIDDEN)[kinds]
    logits = filled @ weights.transpose(0, 2, 1)
    logits += model["word_bias"].reshape(-1, 1, CLASS)[kinds]
    logits = logits.reshape(-1, CLASS)
    values, sums = _exponentials(logits, model["by_word"].T, model["word_bias"])
    at = targets[order] % CLASS
    result[order] += logits[lines, at] - np.log(sums[lines])
    if grads is not None:
        share = np.zeros_like(sums)
        share[lines] = 1 / (sums[lines] * n)
        values *= share[:, None]
        values[lines, at] -= 1 / n
        values = values.reshape(-1, SHEET, CLASS)
        present, first = np.unique(kinds, return_index=True)
        by_word = np.add.reduceat(values.transpose(0, 2, 1) @ filled, first)
        grads["by_word"].reshape(-1, CLASS, HIDDEN)[present] += by_word
        grads["word_bias"].reshape(-1, CLASS)[present] += np.add.reduceat(values.sum(axis=1), first)
        slope[order] += (values @ weights).reshape(-1, HIDDEN)[lines]
    return result, slope


def backward(model, inputs: np.ndarray, keep: np.ndarray, trace: list, slopes: np.ndarray, grads: dict) -> None:
    """Slopes through the window; they end at its first step."""
    steps, lanes = inputs.shape
    before, reset, update, new, u = trace[0]
    # How far a slope by state reaches the sums inside new, update and (over new) reset.
    to_new = (1 - update) * (1 - new * new)
    to_update = (before - new) * update * (1 - update)
    to_reset = u * reset * (1 - reset)
    by_input = np.empty((3, steps, lanes, HIDDEN), before.dtype)
    by_state = np.empty_like(by_input)
    weights = np.ascontiguousarray(by_gate(model["state"]).transpose(0, 2, 1))
    carried = np.zeros((lanes, HIDDEN), before.dtype)
    ends = (keep == 0).any(axis=1)
    for t in range(steps - 1, -1, -1):
        total = slopes[t] + carried
        d_new = np.multiply(total, to_new[t], out=by_input[2, t])
        np.multiply(d_new, to_reset[t], out=by_state[0, t])
        np.multiply(total, to_update[t], out=by_state[1, t])
        np.multiply(d_new, reset[t], out=by_state[2, t])
        reached = by_state[:, t] @ weights
        total *= update[t]
        carried = total + reached[0] + reached[1] + reached[2]
        if ends[t]:
            carried *= keep[t][:, None]
    by_input[:2] = by_state[:2]
    n = steps * lanes
    grads["state"] += _side_by_side(before.reshape(n, -1).T @ by_state.reshape(3, n, -1))
    # Slopes are added up by word before they meet the weights.
    ids = inputs.ravel()
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=-1))
    used = ids[order[first]]
    sums = np.add.reduceat(_side_by_side(by_input.reshape(3, n, -1)).take(order, axis=0), first)
    grads["inner"] += model["embed"][used].T @ sums
    grads["bias"] += sums.sum(axis=0)
    grads["embed"][used] += sums @ model["inner"].T


def _side_by_side(values: np.ndarray) -> np.ndarray:
    """The other way round than ``by_gate``."""
    return values.transpose(1, 0, 2).reshape(values.shape[1], -1)


def lanes_of(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Texts dealt to lanes so that the lanes are about equally long, longest lane first."""
    lanes = [(0, k, []) for k in range(min(count, len(lengths)))]
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, k, own = heapq.heappop(lanes)
        own.append(i)
        heapq.heappush(lanes, (size + int(lengths[i]), k, own))
    return [own for _, _, own in sorted(lanes, key=lambda x: (-x[0], x[1]))]


def windows(texts: list[np.ndarray], count: int, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Inputs, targets, keep and text numbers (steps x lanes) of one window after the other.

    A lane holds texts one after the other and knows where it is in them; lanes that
    have ended are left out, the longest come first. A text's first input is the
    end of a text; text number -1 marks the room after a lane.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    lanes = lanes_of(lengths, count)
    sizes = np.array([lengths[own].sum() for own in lanes], np.int64)
    if not sizes.sum():
        return
    # All lanes one after the other; the text of every token, and of a token before the first.
    line = np.concatenate([texts[i] for own in lanes for i in own])
    turn = np.array([i for own in lanes for i in own], np.int32)
    owner = np.repeat(np.append(np.int32(-1), turn), np.append(1, lengths[turn]))
    last = np.array([t[-1] if len(t) else 0 for t in texts], np.int32)
    begin = np.cumsum(sizes) - sizes
    for done in range(0, int(sizes[0]), steps):
        live = int((sizes > done).sum())
        step = done + np.arange(steps)[:, None]
        used = step < sizes[:live]
        at = np.where(used, begin[:live] + step, 0)
        numbers = owner[at + 1]
        starts = (owner[at] != numbers) & used
        # A lane's first text may follow another lane's last one, never itself.
        inputs = np.where(starts, last[numbers], line[at - 1]).astype(np.int32)
        targets = line[at].astype(np.int32)
        inputs[~used], targets[~used], numbers[~used] = 0, 0, -1
        yield inputs, targets, 1 - starts.astype(np.float32), numbers


def train_on(model: dict, texts: list[np.ndarray], rate: float = RATE) -> dict:
    """One pass over the texts by truncated backpropagation (Adam)."""
    flat = packed(model)
    # Names are views of one vector, which is moved as a whole.
    model, grad = unpacked(flat), np.zeros_like(flat)
    grads = unpacked(grad)
    total, first, second = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    state, step, size, waiting = None, 0, 0, 0
    left = sum(map(len, texts))
    for inputs, targets, keep, numbers in windows(texts, LANES, WINDOW):
        live = inputs.shape[1]
        state = np.zeros((live, HIDDEN), np.float32) if state is None else state[:live]
        own = numbers.ravel() >= 0
        n = int(own.sum())
        trace: list = []
        states = forward(model, inputs, keep, state, trace)
        grad[:] = 0
        _, slope = outputs(model, states.reshape(-1, HIDDEN)[own], targets.ravel()[own], grads)
        slopes = np.zeros((states.shape[0] * live, HIDDEN), np.float32)
        slopes[own] = slope
        backward(model, inputs, keep, trace, slopes.reshape(states.shape), grads)
        state = states[-1]
        grad *= n
        total += grad
        waiting, left, size = waiting + n, left - n, size or n
        # When few lanes are left, their windows wait for each other: no step hangs on a few tokens.
        if 2 * waiting < size and left:
            continue
        total /= waiting
        total *= min(1.0, 1.0 / (np.sqrt(float(np.vdot(total, total))) + 1e-12))
        step += 1
        shrink = rate / (1 - 0.9 ** step) * np.sqrt(1 - 0.999 ** step)
        first *= 0.9
        first += 0.1 * total
        total *= total
        second *= 0.999
        second += 0.001 * total
        np.sqrt(second, out=grad)
        grad += 1e-8
        np.divide(first, grad, out=grad)
        grad *= shrink
        flat -= grad
        total[:], waiting = 0, 0
    return model


def score(model: dict, texts: list[np.ndarray]) -> np.ndarray:
    """Base-10 log-probability of each whole text."""
    total, state = np.zeros(len(texts)), None
    for inputs, targets, keep, numbers in windows(texts, SCORE_LANES, SCORE_WINDOW):
        live = inputs.shape[1]
        state = np.zeros((live, HIDDEN), np.float32) if state is None else state[:live]
        states = forward(model, inputs, keep, state)
        state = states[-1]
        own = numbers.ravel()
        used = own >= 0
        logs, _ = outputs(model, states.reshape(-1, HIDDEN)[used], targets.ravel()[used])
        total += np.bincount(own[used], logs, len(texts))
    return total / np.log(10)


# --- counts and encoding ----------------------------------------------------------------------

def _blocks(block_bytes: int):
    """Adds the block: consecutive rows of a task, of about so many bytes."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ends = size + np.cumsum(pc.binary_length(batch.column("body")).to_numpy() + 1, dtype=np.int64)
            size = int(ends[-1]) if len(ends) else size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base + ends // block_bytes, pa.int64())],
                                             [*batch.schema.names, "block"])
    return task


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of one block and about PIECE_BYTES of text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("body")).to_numpy() + 1, dtype=np.int64) // PIECE_BYTES
        new = np.diff(ends, prepend=-1) > 0
        if "block" in batch.schema.names:
            new |= np.diff(batch.column("block").to_numpy(), prepend=-1) != 0
        cuts = np.flatnonzero(new)
        for first, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
            yield batch.slice(first, stop - first)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words of each block with their number in its training texts."""
    def rows(block, tallies):
        found, times = (np.concatenate(x) for x in zip(*tallies))
        order = np.argsort(found)
        found, times = found[order], times[order]
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), block)), pa.array(found[first]),
                                           pa.array(np.add.reduceat(times, first))], ["block", "code", "n"])

    only(None)
    now, tallies = None, []
    for piece in _pieces(batches):
        block = piece.column("block")[0].as_py()
        if block != now and tallies:
            yield rows(now, tallies)
            tallies = []
        found, places, sizes = coded(piece.column("body"))
        out = piece.column("held_out").to_numpy(zero_copy_only=False)
        now = block
        tallies.append((found, np.bincount(places[np.repeat(~out, sizes)], minlength=len(found))))
    if tallies:
        yield rows(now, tallies)


ENCODED = (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("fixed", "double"),
           ("tokens", "binary"), ("hidden", "binary"))


def _alone(places: np.ndarray, sizes: np.ndarray, practice: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether all occurrences of a word that training counts are in one training text of these."""
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    learnt = practice[text]
    places, text = places[learnt], text[learnt]
    first, last = np.full(len(counts), -1, np.int32), np.full(len(counts), -1, np.int32)
    last[places] = text
    first[places[::-1]] = text[::-1]
    return (np.bincount(places, minlength=len(counts)) == counts) & (first == last)


def _encoder(head: np.ndarray, sums: np.ndarray, total: int, kinds: int, unseen: int):
    """Texts of a block and the counts of its words become token numbers and word-count scores.

    Words of a class share it by their counts; as many unseen words as there are
    words seen once, and one more, share theirs evenly.
    """
    ranks = np.argsort(head)
    in_order = head[ranks]

    def tokens_of(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        shape = found & 7
        tokens = HEAD + shape * (len(BOUNDS) + 1) + np.digitize(counts, BOUNDS)
        if len(head):
            at = np.minimum(np.searchsorted(in_order, found), len(head) - 1)
            tokens = np.where(in_order[at] == found, ranks[at], tokens)
        return np.where(counts == 0, UNSEEN, tokens)

    def task(texts: pa.Table, table: pa.Table) -> pa.Table:
        known, at = np.unique(table.column("code").to_numpy(), return_index=True)
        counts = table.column("c").to_numpy()[at]
        tokens = tokens_of(known, counts)
        tail = tokens >= HEAD
        base = np.log10((np.append(counts, 0) + 0.1) / (total + 0.1 * (kinds + 1)))
        fixed = np.zeros(len(known) + 1)
        fixed[:-1][tail] = np.log10((counts[tail] + 0.1) / sums[np.minimum(tokens[tail], UNSEEN - 1) - HEAD])
        fixed[:-1][tokens == UNSEEN] = fixed[-1] = -np.log10(unseen)
        tokens = np.append(tokens, UNSEEN).astype(np.uint16)
        counts = np.append(counts, 0)
        out = {name: [] for name, _ in ENCODED}
        for piece in _pieces(texts.to_batches()):
            found, places, sizes = coded(piece.column("body"))
            # Different words are looked up once a piece, in order.
            order = np.argsort(found)
            place = np.empty(len(found), np.int64)
            place[order] = np.searchsorted(known, found[order])
            place[place == len(known)] = 0
            seen = known[place] == found if len(known) else np.zeros(len(found), bool)
            place = np.where(seen, place, len(known))
            stops = np.cumsum(sizes)
            starts = stops - sizes
            out["n_tokens"].extend(sizes.tolist())
            out["n_known"].extend(np.add.reduceat(seen[places], starts, dtype=np.int64).tolist())
            out["base_score"].extend(np.add.reduceat(base[place][places], starts).tolist())
            out["fixed"].extend(np.add.reduceat(fixed[place][places], starts).tolist())
            # To a text in training, words of no other training text are unseen: one bit a word.
            practice = pc.is_valid(piece.column("round")).to_numpy(zero_copy_only=False)
            alone = _alone(places, sizes, practice, counts[place])[places]
            numbers = tokens[place][places]
            for a, b, learns in zip(starts.tolist(), stops.tolist(), practice.tolist()):
                out["tokens"].append(numbers[a:b].tobytes())
                out["hidden"].append(np.packbits(alone[a:b]).tobytes() if learns else None)
        kinds_of = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
        return pa.table({**{c: texts.column(c) for c in ("id", "row", "held_out", "round")},
                         **{n: pa.array(out[n], kinds_of[k]) for n, k in ENCODED}})
    return task


def _trainer(flat: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("row", "tokens", "hidden")))]
        if not rows:
            return
        rows.sort()
        texts = []
        for _, tokens, hidden in rows:
            text = np.frombuffer(tokens, np.uint16)
            mask = np.unpackbits(np.frombuffer(hidden, np.uint8), count=len(text)).view(bool)
            texts.append(np.where(mask, np.uint16(UNSEEN), text))
        n = sum(map(len, texts))
        model = packed(train_on(unpacked(flat), texts)).astype(np.float64) * n
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 64], pa.int32()),
                                          pa.array([float(n)]), pa.array([model.tobytes()], pa.binary())],
                                         ["part", "n", "model"])
    return task


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(m) for m in rows.column("model").to_pylist())
    return pa.table({"part": rows.column("part")[:1], "n": [sum(rows.column("n").to_pylist())],
                     "model": pa.array([total.tobytes()], pa.binary())})


def _scorer(flat: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        model = unpacked(flat)
        for batch in batches:
            texts = [np.frombuffer(t, np.uint16) for t in batch.column("tokens").to_pylist()]
            # Texts are scored together up to about so many tokens.
            group = np.cumsum([len(t) for t in texts]) // SCORE_TOKENS
            found = [score(model, texts[a:b]) for a, b in
                     zip(np.searchsorted(group, np.unique(group)), np.searchsorted(group, np.unique(group), "right"))]
            total = pa.array(np.concatenate([np.empty(0), *found]) + batch.column("fixed").to_numpy())
            keep = [c for c in batch.schema.names if c not in ("tokens", "fixed")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), total], [*keep, "score"])
    return task


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all whole texts, learned from those whose CRC-32 of the id, as text, is not divisible by 10.

    ``<id>, held_out, n_tokens, n_known, train_tokens, base_score, score``, logarithms
    to base 10 over the words and the end. Counts cover all training texts, and so
    does the network: each of the ``rounds`` trains on another part of them, whole. A null text is empty and has only its
    end; a null id is not held out; repeated rows count as often as they occur. Without
    training texts all words are unseen.
    """
    out = F.coalesce(F.crc32(F.col("id").cast("string")) % 10 == 0, F.lit(False))
    drawn = F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(rounds)).cast("int")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"),
                         F.monotonically_increasing_id().alias("row"))
    source = source.select("id", "row", "body", out.alias("held_out"),
                           F.when(~out, drawn).alias("round"))
    held = cut_lineage(source.mapInArrow(_blocks(block_bytes), source.select("*").schema.add("block", "long")))
    pairs = cut_lineage(held.select("block", "body", "held_out").mapInArrow(_counted, "block long, code long, n long"))
    counts = cut_lineage(pairs.where("n > 0").groupBy("code").agg(F.sum("n").alias("c")))

    # A few numbers for each class, and the most frequent words.
    bin_of = sum((F.when(F.col("c") >= b, 1).otherwise(0) for b in BOUNDS), F.lit(0))
    slot = F.expr("cast(code & 7 as int)") * (len(BOUNDS) + 1) + bin_of
    by_class = counts.groupBy(slot.alias("slot")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds"),
                                                      F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()
    total, kinds = sum(r["c"] for r in by_class), sum(r["kinds"] for r in by_class)
    top = counts.orderBy(F.desc("c"), "code").limit(HEAD).collect()
    head, head_counts = np.array([r["code"] for r in top], np.int64), np.zeros(HEAD)
    head_counts[:len(top)] = [r["c"] for r in top]
    mass, sums = np.zeros(TAIL), np.zeros(TAIL)
    for r in by_class:
        mass[r["slot"]], sums[r["slot"]] = r["c"], r["c"] + 0.1 * r["kinds"]
    for r in top:
        own = (r["code"] & 7) * (len(BOUNDS) + 1) + int(np.digitize(r["c"], BOUNDS))
        mass[own] -= r["c"]
        sums[own] -= r["c"] + 0.1
    unseen = sum(r["once"] for r in by_class) + 1
    shares = np.concatenate([head_counts.reshape(-1, CLASS).sum(axis=1), mass, [unseen]]) / (total + unseen)
    flat = packed(initial(shares, head_counts))

    fields = held.select("id", "row", "held_out", "round").schema
    for name, kind in ENCODED:
        fields = fields.add(name, kind)
    tables = pairs.select("block", "code").join(counts, "code")
    encoded = cut_lineage(held.groupBy("block").cogroup(tables.groupBy("block")).applyInArrow(
        _encoder(head, np.maximum(sums, 1e-9), total, kinds, unseen), fields))

    discard(held, pairs, counts)
    for k in range(rounds):
        # A trainer takes what lies in one split of the stored table, so nothing moves but models.
        parts = (encoded.where(F.col("round") == k).select("row", "tokens", "hidden")
                 .mapInArrow(_trainer(flat), "part int, n double, model binary")
                 .groupBy("part").applyInArrow(_added, "part int, n double, model binary").collect())
        if parts:
            flat = (sum(np.frombuffer(p["model"]) for p in parts) / sum(p["n"] for p in parts)).astype(np.float32)

    kept = encoded.select("id", "held_out", "n_tokens", "n_known", "base_score", "fixed", "tokens")
    schema = kept.drop("fixed", "tokens").schema.add("score", "double")
    return kept.mapInArrow(_scorer(flat), schema).select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
