import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from hearthline.llm import gru, queries

SF = "/root/testdata/sf0.01"


def _model(seed=0):
    draw = np.random.default_rng(seed)
    return {k: draw.normal(0, 0.3, s) for k, s in gru.SHAPES.items()}


def _texts(seed, lengths):
    draw = np.random.default_rng(seed)
    return [draw.integers(0, gru.UNSEEN + 1, n) for n in lengths]


def plain_score(model, text):
    """Step by step over one text, with the softmax over all words written out."""
    h, total, before = np.zeros(gru.HIDDEN), 0.0, text[-1]
    n = gru.HIDDEN
    for token in text:
        x = model["embed"][before] @ model["inner"] + model["bias"]
        u = h @ model["state"]
        r, z = 1 / (1 + np.exp(-(x + u)[:n])), 1 / (1 + np.exp(-(x + u)[n:2 * n]))
        h = z * h + (1 - z) * np.tanh(x[2 * n:] + r * u[2 * n:])
        logits = h @ model["by_class"] + model["class_bias"]
        c = int(gru.class_of(np.array([token]))[0])
        total += logits[c] - np.log(np.exp(logits).sum())
        if token < gru.HEAD:
            rows = slice(c * gru.CLASS, (c + 1) * gru.CLASS)
            inside = model["by_word"][rows] @ h + model["word_bias"][rows]
            total += inside[token - c * gru.CLASS] - np.log(np.exp(inside).sum())
        before = token
    return total / math.log(10)


def test_state_runs_over_windows_and_starts_anew(monkeypatch):
    model, texts = _model(), _texts(1, [1, 5, 40, 150, 3, 64, 65])
    want = [plain_score(model, t) for t in texts]
    for lanes in (2, 256):
        monkeypatch.setattr(gru, "SCORE_LANES", lanes)
        assert np.allclose(gru.score(model, texts), want, rtol=1e-4)
    assert gru.score(model, []).size == 0


def test_tokens_are_a_distribution():
    model = _model()
    states = np.random.default_rng(2).normal(size=(1, gru.HIDDEN))
    logs = [gru.outputs(model, states, np.array([t]))[0][0] for t in range(gru.UNSEEN + 1)]
    assert abs(np.exp(logs).sum() - 1) < 1e-9


def test_gradients():
    model, texts = _model(3), _texts(4, [7, 9, 4])
    inputs, targets, keep, numbers = next(gru.windows(texts, 2, 11))
    used = numbers.ravel() >= 0

    def loss():
        states = gru.forward(model, inputs, keep, np.zeros((2, gru.HIDDEN)))
        return -gru.outputs(model, states.reshape(-1, gru.HIDDEN)[used].astype(float), targets.ravel()[used])[0].mean()

    trace, grads = [], {k: np.zeros_like(v) for k, v in model.items()}
    states = gru.forward(model, inputs, keep, np.zeros((2, gru.HIDDEN)), trace)
    _, slope = gru.outputs(model, states.reshape(-1, gru.HIDDEN)[used], targets.ravel()[used], grads)
    slopes = np.zeros((states.shape[0] * 2, gru.HIDDEN))
    slopes[used] = slope
    gru.backward(model, inputs, keep, trace, slopes.reshape(states.shape), grads)
    draw = np.random.default_rng(5)
    for name, value in model.items():
        flat, own = value.reshape(-1), grads[name].reshape(-1)
        for i in {int(np.abs(own).argmax()), int(draw.integers(len(flat)))}:
            old, step = flat[i], 1e-3
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - own[i]) < 2e-4 + 0.02 * abs(own[i]), name


def test_training_learns_an_order():
    draw = np.random.default_rng(6)
    texts = []
    for _ in range(300):
        start = int(draw.integers(0, 8))
        texts.append(np.array([(start + k) % 8 * 40 for k in range(int(draw.integers(20, 60)))] + [900]))
    counts = np.bincount(np.concatenate(texts), minlength=gru.HEAD).astype(float)
    shares = np.concatenate([counts.reshape(-1, gru.CLASS).sum(axis=1), np.zeros(gru.TAIL + 1)]) / counts.sum()
    model = gru.initial(shares, counts)
    before = gru.score(model, texts[:50]).sum()
    for _ in range(4):
        model = gru.train_on(model, texts[50:], rate=2e-2)
    assert gru.score(model, texts[:50]).sum() > 0.5 * before


def plain_base(docs):
    """Counts, sizes and base scores by dictionaries."""
    out = {d: (d is not None and zlib.crc32(str(d).encode()) % 10 == 0) for d, _ in docs}
    words = [(d, (t or "").encode().lower().split() + [None]) for d, t in docs]
    counts = Counter(w for d, ws in words if not out[d] for w in ws)
    total = sum(counts.values())
    bottom = total + 0.1 * (len(counts) + 1)
    return total, [(d, out[d], len(ws), sum(w in counts for w in ws),
                    sum(math.log10((counts[w] + 0.1) / bottom) for w in ws)) for d, ws in words]


def _agree(rows, docs):
    total, want = plain_base(docs)
    assert all(r.train_tokens == total for r in rows)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows), key=str)
    assert got == sorted(((*w[:4], round(w[4], 5)) for w in want), key=str)


@pytest.mark.parametrize("block_bytes", [300, 1 << 25])
def test_awkward_rows(spark, texts_frame, block_bytes):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("a b, c. d é f! the of".split(), k=rng.randrange(30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a b"), (7, "a b"), (7, "a b"), (102, "long words " * 20_000)]
    found = gru.score_documents(texts_frame(rows), block_bytes=block_bytes).collect()
    _agree(found, rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert gru.score_documents(texts_frame(rows).limit(0)).count() == 0
    only = [(i, "x y") for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    _agree(gru.score_documents(texts_frame(only)).collect(), only)


def test_query_and_held_out_likelihood(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op8_gru"](spark, SF).collect()
    _agree(rows, docs)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    other = [r for r in rows if not r.held_out]
    assert sum(r.score for r in other) > 1.2 * sum(r.base_score for r in other)


def test_windows_hold_every_token_once():
    texts = _texts(8, [1, 5, 700, 3, 64, 65, 2])
    for lanes, steps in ((2, 7), (256, 64)):
        found = [[] for _ in texts]
        for inputs, targets, keep, numbers in gru.windows(texts, lanes, steps):
            assert inputs.shape == targets.shape == keep.shape == numbers.shape and len(inputs) == steps
            for t, k in zip(*np.nonzero(numbers >= 0)):
                found[numbers[t, k]].append((inputs[t, k], targets[t, k], keep[t, k]))
        for text, own in zip(texts, found):
            assert [b for _, b, _ in own] == list(text)
            assert [a for a, _, _ in own] == [text[-1], *text[:-1]]
            assert [c for _, _, c in own] == [0] + [1] * (len(text) - 1)


def test_windows_of_a_very_long_text_stay_small():
    """Two million words beside short texts: no array of all steps by all lanes."""
    import tracemalloc
    texts = [np.zeros(2_000_000, np.uint16)] + [np.zeros(100, np.uint16)] * 2_000
    tracemalloc.start()
    tokens = sum(int((numbers >= 0).sum()) for _, _, _, numbers in gru.windows(texts, 256, 64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens == 2_200_000 and peak < 20 << 20


def test_words_share_their_class_wholly():
    """Known words and as many unseen ones as the model counts on: probabilities sum to one."""
    import pyarrow as pa
    rng = random.Random(9)
    counts = Counter({f"w{i}{rng.choice(['', '.', ',', '!', 'é'])}": rng.choice([1, 1, 1, 2, 3, 8, 20, 90]) for i in range(1_500)})
    code_of = {w: gru._code(w.encode()) for w in counts}
    code_of[None] = gru.END
    counts[None] = 50
    top = sorted(counts, key=lambda w: (-counts[w], code_of[w]))[:gru.HEAD]
    head = np.array([code_of[w] for w in top], np.int64)
    sums = np.zeros(gru.TAIL)
    for w, c in counts.items():
        if w not in top:
            sums[(code_of[w] & 7) * (len(gru.BOUNDS) + 1) + int(np.digitize(c, gru.BOUNDS))] += c + 0.1
    unseen = sum(c == 1 for c in counts.values()) + 1
    table = pa.table({"code": pa.array([code_of[w] for w in counts], pa.int64()), "c": pa.array(list(counts.values()), pa.int64())})
    words = [w for w in counts if w is not None] + ["never seen".replace(" ", "")]
    rows = pa.table({"id": words, "row": list(range(len(words))), "held_out": [True] * len(words),
                     "round": pa.array([None] * len(words), pa.int32()), "body": words})
    found = gru._encoder(head, np.maximum(sums, 1e-9), sum(counts.values()), len(counts), unseen)(rows, table)
    model = _model(10)
    states = np.random.default_rng(11).uniform(-1, 1, (1, gru.HIDDEN))
    total, end_seen = 0.0, False
    for word, tokens, fixed in zip(words, found.column("tokens").to_pylist(), found.column("fixed").to_pylist()):
        token, end = np.frombuffer(tokens, np.uint16)
        logs = [gru.outputs(model, states, np.array([t]))[0][0] for t in (token, end)]
        total += math.exp(logs[0]) * 10 ** fixed * (unseen if word == words[-1] else 1)
        if not end_seen:
            total, end_seen = total + math.exp(logs[1]), True
    # Classes that no word is in keep their share.
    empty = {gru.HEAD + k for k in range(gru.TAIL) if sums[k] == 0}
    total += sum(math.exp(gru.outputs(model, states, np.array([t]))[0][0]) for t in empty)
    assert abs(total - 1) < 1e-6


def test_unseen_words_score_below_the_class(spark, texts_frame):
    rows = [(i, f"common words here again and w{i}") for i in range(200)]
    out = next(i for i in range(1_000, 2_000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows.append((out, " ".join(f"invented{k}" for k in range(100))))
    found = {r.doc_id: r for r in gru.score_documents(texts_frame(rows)).collect()}
    assert found[out].n_known == 1 and found[out].score < -100 * math.log10(150)


def test_rounds_cover_all_training_texts(spark, texts_frame, monkeypatch):
    """Every training text is in one round, whole; held-out texts are in none."""
    seen = []
    plain = gru._trainer
    monkeypatch.setattr(gru, "_trainer", lambda flat: seen.append(flat) or plain(flat))
    rows = [(i, "one two three " * (i % 5)) for i in range(100)]
    gru.score_documents(texts_frame(rows)).count()
    assert len(seen) == gru.ROUNDS and not any((a == b).all() for a, b in zip(seen, seen[1:]))


def test_words_of_pieces_are_those_of_the_word_rule(monkeypatch):
    """Same words as ``texts.words``, one code each, whatever white space, letters and sizes of pieces."""
    import pyarrow as pa
    from hearthline.llm import texts
    draw = np.random.default_rng(12)
    alphabet = list("ab.,!Zé日Å\x1c\x85\xa0   \t\n\x0b\x0c\r")
    rows = ["".join(draw.choice(alphabet, draw.integers(0, 50))) for _ in range(500)] + ["", " ", " a", "A a\n", "", ""]
    want = [[gru._code(w) for w in texts.words(r.encode())] + [gru.END] for r in rows]
    assert len({c for w in want for c in w}) == len({w for r in rows for w in texts.words(r.encode())}) + 1
    for size in (1, 90, 4 << 20):
        monkeypatch.setattr(gru, "PIECE_BYTES", size)
        got = []
        for piece in gru._pieces([pa.record_batch({"body": rows[:300]}), pa.record_batch({"body": rows[300:]})]):
            found, places, sizes = gru.coded(piece.column("body"))
            got += [part.tolist() for part in np.split(found[places], np.cumsum(sizes)[:-1])]
        assert got == want


def test_each_different_word_is_hashed_once_a_piece(monkeypatch):
    """More words than a word table holds, twice over: hashing goes by different words, not by tokens."""
    import pyarrow as pa
    calls, plain = [], gru.hash64
    monkeypatch.setattr(gru, "hash64", lambda word: calls.append(1) or plain(word))
    words = [f"{k:x}" for k in range(160_000)]
    batch = pa.record_batch({"block": pa.array([0, 0], pa.int64()), "body": [" ".join(words)] * 2, "held_out": [False, True]})
    found = pa.Table.from_batches(gru._counted(iter([batch])))
    assert found.num_rows == 160_001 and found.column("n").to_pylist() == [1] * 160_001
    assert len(calls) <= 160_001


def test_output_sheets(monkeypatch):
    """Two softmaxes a window, not one for each class; probabilities and slopes as written out token by token."""
    calls, plain = [], gru._exponentials
    monkeypatch.setattr(gru, "_exponentials", lambda *a: calls.append(1) or plain(*a))
    draw = np.random.default_rng(13)
    model = _model(14)
    # Classes of many sheets, of one row, of a full sheet and of none.
    targets = np.concatenate([draw.integers(0, 32, 200), [40], draw.integers(64, 96, gru.SHEET),
                              draw.integers(128, gru.UNSEEN + 1, 300)])
    draw.shuffle(targets)
    states = draw.uniform(-1, 1, (len(targets), gru.HIDDEN))
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    logs, slope = gru.outputs(model, states, targets, grads)
    assert len(calls) == 2
    by_word, word_bias = np.zeros_like(model["by_word"]), np.zeros(gru.HEAD)
    for k, (state, token) in enumerate(zip(states, targets)):
        c = int(gru.class_of(np.array([token]))[0])
        shares = np.exp(state @ model["by_class"] + model["class_bias"])
        shares /= shares.sum()
        log = np.log(shares[c])
        shares[c] -= 1
        down = model["by_class"] @ shares
        if token < gru.HEAD:
            rows = slice(c * gru.CLASS, (c + 1) * gru.CLASS)
            inside = np.exp(model["by_word"][rows] @ state + model["word_bias"][rows])
            inside /= inside.sum()
            log += np.log(inside[token % gru.CLASS])
            inside[token % gru.CLASS] -= 1
            by_word[rows] += np.outer(inside, state)
            word_bias[rows] += inside
            down = down + inside @ model["by_word"][rows]
        assert abs(logs[k] - log) < 1e-9 and np.allclose(slope[k] * len(targets), down)
    assert np.allclose(grads["by_word"] * len(targets), by_word) and np.allclose(grads["word_bias"] * len(targets), word_bias)


def test_words_of_one_training_text_alone():
    """As counted by dictionaries; held-out texts and words that occur elsewhere do not count."""
    rng = random.Random(15)
    for _ in range(50):
        texts = [[rng.randrange(30) for _ in range(rng.randrange(1, 8))] for _ in range(12)]
        practice = np.array([rng.random() < 0.8 for _ in texts])
        here = Counter(w for t, p in zip(texts, practice) if p for w in t)
        counts = np.array([here[w] + rng.choice([0, 0, 1]) for w in range(30)])
        found = gru._alone(np.concatenate(texts), np.array([len(t) for t in texts]), practice, counts)
        for text, learns in zip(texts, practice):
            if learns:
                assert [bool(found[w]) for w in text] == [Counter(text)[w] == counts[w] for w in text]


def test_a_long_text_at_the_end_does_not_undo_training():
    """Lanes that outlast the others by far take no step for every few tokens of theirs."""
    draw = np.random.default_rng(16)

    def cycle(n):
        start = int(draw.integers(0, 8))
        return np.array([(start + k) % 8 * 40 for k in range(n)] + [900])

    texts, fresh = [cycle(60) for _ in range(600)], [cycle(60) for _ in range(50)]
    long = np.append(draw.integers(gru.HEAD, gru.UNSEEN, 12_000), 900)
    counts = np.bincount(np.concatenate(texts), minlength=gru.HEAD).astype(float)
    shares = np.concatenate([counts.reshape(-1, gru.CLASS).sum(axis=1), np.full(gru.TAIL + 1, 10.0)])
    model = gru.initial(shares / shares.sum(), counts)
    without = gru.score(gru.train_on(model, texts, rate=2e-2), fresh).sum()
    beside = gru.score(gru.train_on(model, [*texts, long], rate=2e-2), fresh).sum()
    assert gru.score(model, fresh).sum() < 1.5 * without
    assert beside > 1.5 * without, (beside, without)
