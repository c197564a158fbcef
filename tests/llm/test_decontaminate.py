import itertools
import random

import numpy as np
import pytest

from hearthline.llm import decontaminate as d
from hearthline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("length,changes", [(13, 1), (13, 2), (15, 3)])
def test_masks_hit_every_overlap(length, changes):
    starts = [(m, o) for m in d.MASKS for o in range(length - len(m) + 1)]
    covers = [sum(1 << (o + i) for i, c in enumerate(m) if c == "1") for m, o in starts]
    for where in itertools.combinations(range(length), changes):
        changed = sum(1 << w for w in where)
        assert any(not cover & changed for cover in covers)


def plain_overlap(doc, item, least=d.LEAST_WORDS, share=d.SHARE):
    """Length of the longest stretch on any diagonal with enough equal words; 0 if below ``least``."""
    best = 0
    for diagonal in range(-len(item), len(doc)):
        low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
        equal = [doc[i + diagonal] == item[i] for i in range(low, high)]
        for a in range(len(equal)):
            for b in range(a + max(least, best + 1), len(equal) + 1):
                if sum(equal[a:b]) >= share * (b - a) - 1e-9:
                    best = b - a
    return best


def test_overlap_against_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        item = [rng.randrange(50) for _ in range(rng.randint(5, 30))]
        doc = [rng.randrange(50) for _ in range(40)]
        at = rng.randrange(20)
        doc[at:at + len(item)] = [w if rng.random() < 0.85 else 99 for w in item]
        found = max((d.overlap(np.array(doc, np.uint64), np.array(item, np.uint64), k, 13, 0.8) or (0, 0, 0, 0)
                     for k in range(-len(item), len(doc))), key=lambda o: o[2])
        want = plain_overlap(doc, item)
        assert (found[2] > 0) == (want > 0) and found[2] <= want


def test_planted_passages(spark, texts_frame):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    items = [rng.choices(words, k=rng.randint(13, 50)) for _ in range(30)]
    rows, expected = [], set()
    for i in range(120):
        own = rng.choices(words, k=rng.randint(0, 150))
        at = rng.randint(0, len(own))
        if i % 2:
            part = list(items[i % 30])
            for k in rng.sample(range(len(part)), len(part) // 8):
                part[k] = "changed"
            own[at:at] = part
            expected.add((i, i % 30))
        rows.append((i, " ".join(own).upper() if i % 4 == 1 else " ".join(own)))
    rows += [(200, None), (201, ""), (202, " ".join(items[0][:8])), (None, " ".join(items[3]))]
    tests = spark.createDataFrame([(k, " ".join(t), 1) for k, t in enumerate(items)] + [
        (90, None, 1), (91, "", 1), (92, "w1", 1), (93, " ".join(items[5]), 1)],
        "item_id long, text string, row long")
    found = d.overlaps(texts_frame(rows), tests).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == expected | {(None, 3)} | {(i, 93) for i, k in expected if k == 5}
    assert all(r.equal_words >= 0.8 * r.words - 1 for r in found)
    assert d.overlaps(texts_frame([(1, "a")]).limit(0), tests).count() == 0
    assert d.overlaps(texts_frame(rows), tests.limit(0)).count() == 0


def test_small_bitmap_loses_nothing(spark, texts_frame):
    text = " ".join(f"t{k}" for k in range(60))
    tests = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = texts_frame([(1, "x y " + text), (2, "nothing of it at all " * 10)])
    assert [r.doc_id for r in d.overlaps(docs, tests, filter_bits=64).collect()] == [1]


def plain_items(words, tests):
    """Keys of the test items of which 13 words or more stand in ``words``, four fifths of them equal."""
    places, found = {}, set()
    for k, w in enumerate(words):
        places.setdefault(w, []).append(k)
    for key, item in tests.items():
        for g in {p - i for i, w in enumerate(item) for p in places.get(w, [])}:
            low, high = max(0, -g), min(len(item), len(words) - g)
            equal = [words[i + g] == item[i] for i in range(low, high)]
            if sum(equal) >= 11 and any(sum(equal[a:a + n]) >= 0.8 * n for n in range(13, len(equal) + 1)
                                        for a in range(len(equal) - n + 1)):
                found.add(key)
    return found


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    tests = {i.item_id: i.text.encode().lower().split() for i in items}
    expected = {(row.doc_id, key) for row in docs
                for key in plain_items((row.text or "").encode().lower().split(), tests)}
    rows = queries.QUERIES["op2_decontaminate"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(rows) == len(expected)
