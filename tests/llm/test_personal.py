import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.llm import personal, personal_labels, queries

SF = "/root/testdata/sf0.001"
RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    """The four patterns as they stand, with their conditions."""
    found = []
    for kind, rule in RULES:
        for m in re.finditer(rule, text):
            digits = [int(d) for d in re.findall("[0-9]", m.group())]
            doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                found.append((kind, *m.span()))
    return found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1.@+-_ 49()é\n", max_size=60))
def test_patterns(text):
    assert [(personal.KINDS[k], b, e) for k, b, e in personal.patterns(text)] == plain(text)


def test_patterns_on_numbers():
    rng = random.Random(1)
    for _ in range(3_000):
        text = " ".join(rng.choice([str(rng.randrange(10**16, 10**17))[:rng.randint(14, 17)], "4111 1111 1111 1111", "4111-1111-1111-1111",
                                    f"{rng.randrange(300)}.{rng.randrange(300)}.0{rng.randrange(99)}.1", "+1 (555) 123-4567",
                                    "a.b@c.d.e", "x@y@z.org", "@", "+", "1.2.3.4.5.6.7.8", "é@é.org"]) for _ in range(4))
        assert [(personal.KINDS[k], b, e) for k, b, e in personal.patterns(text)] == plain(text)


def test_patterns_are_linear():
    for part in ("a", "1", "1.", "1 ", "+1 ", "a@", "@", "."):
        personal.patterns(part * 300_000)


@pytest.fixture(scope="module")
def field():
    return personal.train_field(personal_labels.LINES)


def labels_of(field, text):
    return [(personal.KINDS[k], text.encode()[b:e].decode()) for k, b, e in personal.modelled([text.encode()], field)[0]]


def test_viterbi_is_the_best_path(field):
    rng = np.random.default_rng(2)
    for n in range(1, 6):
        score = rng.normal(0, 3, (n, 5))
        best = max(itertools.product(range(5), repeat=n), key=lambda p: sum(score[k, x] for k, x in enumerate(p)) + sum(
            field.moves[a, b] for a, b in zip((0, *p), (*p, 0))))
        assert tuple(field.decode(score, np.zeros(n, int))) == best
    score = rng.normal(0, 3, (200, 5))
    chain = np.sort(rng.integers(0, 30, 200))
    apart = np.concatenate([field.decode(score[chain == c], chain[chain == c]) for c in np.unique(chain)])
    assert (field.decode(score, chain) == apart).all()


def test_certain_words_change_nothing(field):
    """Short chains between certain words give what whole texts give."""
    rng = random.Random(3)
    words = " ".join(personal_labels.LINES).replace("{", "").replace("}", "").split() + ["Tel.", "555", "at", "dot"]
    for _ in range(60):
        text = " ".join(rng.choices(words, k=40)).encode()
        first, last, shape, word = personal.shapes(text)
        score = field.scores(*field.features(np.zeros(len(first), int), shape, word))
        labels = field.decode(score, np.zeros(len(first), int))
        found = personal.modelled([text], field)[0]
        marked = np.zeros(len(first), int)
        for kind, b, e in found:
            marked[(first >= b) & (last <= e)] = kind + 1
        assert (marked == labels).all()


def test_expected_counts():
    """Against sums over all labellings."""
    rng = np.random.default_rng(4)
    score, moves = rng.normal(0, 1, (5, 5)), rng.normal(0, 1, (5, 5))
    share, moved = personal._expected(score, moves, np.array([0, 3]), np.array([3, 2]))
    exact, steps = np.zeros((5, 5)), np.zeros((5, 5))
    for begin, n in ((0, 3), (3, 2)):
        ways = list(itertools.product(range(5), repeat=n))
        weight = np.array([np.exp(sum(score[begin + k, x] for k, x in enumerate(p)) + sum(
            moves[a, b] for a, b in zip((0, *p), (*p, 0)))) for p in ways])
        for p, w in zip(ways, weight / weight.sum()):
            for k, x in enumerate(p):
                exact[begin + k, x] += w
            for a, b in zip((0, *p), (*p, 0)):
                steps[a, b] += w
    assert np.allclose(share, exact) and np.allclose(moved, steps)


def test_held_out(field):
    """Formats of the labelled table with other names and numbers, between other words."""
    rng = random.Random(5)

    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def name():
        return "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(4, 8)))

    makers = [lambda: f"({number(3)}) {number(3)}-{number(4)}", lambda: f"{name()} at {name()} dot org",
              lambda: f"{name()} [at] {name()} [dot] com", lambda: f"({number(4)}) {number(7)}"]
    caught = wrong = 0
    for _ in range(300):
        told, words = rng.choice(makers)(), [name() for _ in range(12)]
        text = " ".join([*words[:6], told, *words[6:]])
        caught += [t for _, t in labels_of(field, text)] == [told]
        wrong += bool(labels_of(field, " ".join([*words, number(5), "12.50", f"{number(2)}:{number(2)}", *words])))
    assert caught >= 285 and wrong <= 3


def test_pieces_and_groups_change_nothing(field, monkeypatch):
    texts = [line.replace("{", "").replace("}", "").replace("|", " ").encode() for line in personal_labels.LINES] + [b"", b" \n "]
    whole = personal.modelled(texts, field)
    monkeypatch.setattr(personal, "PIECE", 50)
    monkeypatch.setattr(personal, "WORDS", 7)
    monkeypatch.setattr(personal, "CELLS", 10)
    assert personal.modelled(texts, field) == whole
    assert [personal.modelled([t], field)[0] for t in texts] == whole


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_plain(spark, field):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op12_personal"](spark, SF)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    expected = []
    for d in docs:
        base = plain(d.text or "")
        written = ",".join(f"{k}:{b}:{e}" for k, b, e in base)
        expected.append((d.doc_id, *(sum(k == kind for k, _, _ in base) for kind in personal.KINDS), digest(written)))
    rows = found.collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(expected)
    texts = {d.doc_id: d.text or "" for d in docs}
    for r in rows:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {(k, int(b), int(e)) for k, b, e in spans} >= set(plain(texts[r.doc_id]))
        assert [personal.KINDS.index(k) for k, _, _ in spans] == sorted(personal.KINDS.index(k) for k, _, _ in spans)


def test_awkward_rows(spark, texts_frame, field):
    long = "word " * 300_000 + "me@example.org, ring (555) 123-4567 now" + " word" * 300_000
    docs = texts_frame([(1, None), (2, ""), (3, " \n"), (4, "é mail bob at foo dot org, é"), (4, "é mail bob at foo dot org, é"),
                        (None, "1.2.3.4"), (5, long), (6, "x" * 2_000_000)])
    rows = personal.find(docs, field.dump(), ["doc_id"]).collect()
    found = sorted(((r.doc_id, [(s.kind, s.start, s.end, s.base) for s in r.spans]) for r in rows), key=str)
    assert found == sorted([
        (1, []), (2, []), (3, []), (4, [("email", 7, 25, False)]), (4, [("email", 7, 25, False)]), (None, [("ip", 0, 7, True)]),
        (5, [("email", 1_500_000, 1_500_014, True), ("phone", 1_500_021, 1_500_035, False)]), (6, [])], key=str)
    assert personal.find(docs.limit(0), field.dump(), ["doc_id"]).count() == 0
    none = personal.train(spark.createDataFrame([(None, 1)], "line string, field int"))
    assert all(s.base for r in personal.find(docs, none, ["doc_id"]).collect() for s in r.spans)
