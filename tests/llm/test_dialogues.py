import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from hearthline.llm import dialogues, queries

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string, pos long, seg string"


def cheapest(rows):
    """(cost, audit, repaired) of ``(role, text, kind)`` rows; kind 0 fits, 1 must go, 2 is cut. Plain recursion by rows."""
    after = {"": "u", "s": "u", "a": "u", "u": "a"}
    full = {"u": "user", "a": "assistant"}
    # best[state] from the end: (cost, audit, lines)
    best = {"": (0, "", ()), "a": (0, "", ()), "u": (2, "I", ("assistant:",)), "s": (4, "II", ("user:", "assistant:"))}
    for role, text, kind in reversed(rows):
        here = {}
        for state in after:
            ways = [(best[state][0] + 3, "D" + best[state][1], best[state][2])]
            if kind != 1:
                extra = 1 if kind == 2 else 0
                to = after[state]
                if role[:1] == to or (role[:1] == "s" and state == ""):
                    c, a, t = best[role[:1]]
                    ways.append((c + extra, "K" + a, (f"{role}:{text}",) + t))
                c, a, t = best[to]
                ways.append((c + 2 + extra, "R" + a, (f"{full[to]}:{text}",) + t))
            here[state] = min(ways, key=lambda w: w[:2])
        for _ in range(3):
            for state, to in after.items():
                c, a, t = here[to]
                here[state] = min(here[state], (c + 2, "I" + a, (f"{full[to]}:",) + t), key=lambda w: w[:2])
        best = here
    return best[""]


def plain(rows):
    """Rows ``(conv, turn, role, text)`` to the query's columns, without damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, kinds, count = set(), [], [0, 0, 0]
        for _, role, text in own:
            shown = BLANK.findall(text)
            if not shown:
                fault, kind = 0, 1
            elif (role, text) in seen:
                fault, kind = 1, 1
            elif shown[-1] not in ".!?":
                fault, kind = 2, 2
            else:
                fault, kind = None, 0
            if fault is not None:
                count[fault] += 1
            seen.add((role, text))
            kinds.append((role, text, kind))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(kinds)
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        out += [(conv, turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    return out


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    found = dialogues.repair(df)
    left = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in found.found.collect()}
    right = {r.conv: r.digest for r in dialogues.digests(found).collect()}
    texts = {}
    for r in sorted(dialogues.lines(found).collect(), key=lambda r: r.at):
        texts.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, digest in right.items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == digest
    assert set(left) == set(right)
    return {c: (*left[c], right[c]) for c in left}


def some_rows(rng, convs, most):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            text = rng.choice(["Hello.", "Hello", " \t", "", None, "What? ", "Yes!\n", "Right, so", f"Number {turn}.", f"{turn}"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    return rows


def test_random_conversations(spark):
    rows = some_rows(random.Random(1), 300, 12)
    assert repaired(spark, rows) == plain(rows)


@pytest.mark.parametrize("segment", [1, 3])
def test_segments_change_nothing(spark, monkeypatch, segment):
    monkeypatch.setattr(dialogues, "SEGMENT", segment)
    monkeypatch.setattr(dialogues, "CELLS", 40)
    rows = some_rows(random.Random(2), 40, 14)
    assert repaired(spark, rows) == plain(rows)


def test_hot_conversation_and_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"Words {t}" + rng.choice([".", ""])) for t in range(9_000)]
    rows += [(None, 1, "user", "Here."), (None, 2, "assistant", "There."), (8, None, None, None), (9, None, "user", "a" * 300_000),
             (10, 2**40, "system", "Only this."), (10, 1, "system", "Only this.")]
    assert repaired(spark, rows) == plain(rows)
    assert repaired(spark, []) == {}


def test_audit_by_enumeration():
    """Every string of edits, on short conversations."""
    rng = random.Random(4)
    codes = [np.array([rng.randrange(4) * 3 + rng.randrange(3) for _ in range(rng.randint(1, 3))]) for _ in range(40)]
    audits, leaves = dialogues.least_audits(codes, np.tile(dialogues.TAIL, (len(codes), 1)))
    for own, audit, leave in zip(codes, audits, leaves):
        found = []

        def go(i, state, text, cost):
            if len(text) > 3 * len(own) + 2 or cost > 12:
                return
            to = {"": "u", "s": "u", "a": "u", "u": "a"}[state]
            if i == len(own) and state in ("", "a"):
                found.append((cost, text))
            go(i, to, text + "I", cost + 2)
            if i < len(own):
                go(i + 1, state, text + "D", cost + 3)
                role, kind = "suat"[own[i] // 3], own[i] % 3
                if kind != 1:
                    if role == to or role == "s" and state == "":
                        go(i + 1, role, text + "K", cost + (kind == 2))
                    go(i + 1, to, text + "R", cost + 2 + (kind == 2))
        go(0, "", "", 0)
        assert min(found)[1] == audit[0] + "I" * len(dialogues.ADDED[leave[0]])


def test_query_against_plain(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    expected = plain(damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = queries.QUERIES["op11_repair"](spark, SF)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {c: expected.get(c, nothing) for c in {r[0] for r in rows}}


def test_query_on_awkward_tables(spark, tmp_path):
    rng = random.Random(5)
    rows = some_rows(rng, 60, 6) + [(None, t, "user", "Hm.") for t in range(5)] + [(c, 0, "user", "One.") for c in range(100, 160)]
    for folder, own in (("some", rows), ("none", [])):
        spark.createDataFrame([(*r, 1, "x") for r in own], SCHEMA).write.parquet(f"{tmp_path}/{folder}/conversations.parquet")
        expected = plain(damage(own))
        nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        found = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op11_repair"](spark, f"{tmp_path}/{folder}").collect()}
        assert found == {c: expected.get(c, nothing) for c in {r[0] for r in own}}
